import os
import random

import pyarrow as pa

from termloom.llm import common, components, jaccard
from termloom.llm.queries import QUERIES
from termloom.session import scratch_folder
from tests.llm import plain

SCHEMA = "doc_id bigint, text string, n bigint, digest string"


def joined(spark, docs):
    rows = jaccard.jaccard_join(spark.createDataFrame([(*d, 1, "clash") for d in docs], SCHEMA).repartition(3)).collect()
    return sorted(map(tuple, rows), key=str)


def test_query_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op8_jaccard"](spark, sf).collect())) == sorted(plain.jaccard(docs))


def test_near_copies_around_the_threshold_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_DOCUMENTS", 8)
    rng = random.Random(3)
    docs = []
    for family in range(4):
        words = [f"f{family}w{i}" for i in range(60)]
        for _ in range(25):
            changed = list(words)
            for _ in range(rng.randint(0, 3)):
                changed[rng.randrange(60)] = f"new{rng.random()}"
            docs.append((rng.randrange(10**9), " ".join(changed[: rng.randint(45, 60)])))
    want = sorted(plain.jaccard(docs), key=str)
    assert joined(spark, docs) == want
    assert 4 <= len({r[2] for r in want}) < len(docs)


def mislead(sketch):
    """Have a sketch take all shingles for equally rare."""
    sketch.cells.fill(0)
    sketch.long = jaccard.LONG


def with_passage(groups, copies, own, passage=70):
    """Groups of near copies; every document holds the same passage."""
    rng = random.Random(groups)
    shared = " ".join(f"p{i}" for i in range(passage))
    for group in range(groups):
        words = [f"g{group}w{i}" for i in range(own)]
        for copy in range(copies):
            yield group * 1_000 + rng.randrange(1_000), f"{shared} {' '.join(words)} end{copy}"


def test_families_are_the_true_groups_however_the_sketch_errs(spark, monkeypatch):
    monkeypatch.setattr(jaccard.Sketch, "_level", mislead)
    monkeypatch.setattr(jaccard, "TILE_DOCUMENTS", 16)
    docs = list(with_passage(30, 4, 30))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    sets = jaccard._sets(frame).cache()
    known = sets.where("n > 0").selectExpr("doc_id", "doc_id as leader")
    edges = jaccard._shared_prefixes(frame, jaccard.Sketch(sets), jaccard.PERCENT)
    families = jaccard.connected_components(edges).toDF("doc_id", "family")
    families = families.union(families.select("family", "family")).distinct()
    assert families.groupBy("family").count().agg({"count": "max"}).first()[0] > 100
    members = jaccard._members(jaccard._leaders_of(families, known), sets).cache()
    narrowed = jaccard._narrowed(members, sets, jaccard._with_sets(frame, members).cache(), jaccard.PERCENT)
    found = {}
    for r in narrowed.collect():
        found.setdefault(r.family, set()).add(r.doc_id)
    want = {}
    for doc_id, _ in docs:
        want.setdefault(doc_id // 1_000, set()).add(doc_id)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_no_link_is_lost_when_large_families_are_dealt_out_again(spark, monkeypatch):
    monkeypatch.setattr(jaccard.Sketch, "_level", mislead)
    monkeypatch.setattr(jaccard, "TILE_DOCUMENTS", 4)
    monkeypatch.setattr(jaccard, "SHORT", 3)
    rng = random.Random(9)
    docs = list(with_passage(6, 5, 9)) + list(with_passage(4, 3, 16))
    for family in range(3):
        words = [f"f{family}w{i}" for i in range(50)]
        for _ in range(20):
            changed = [w if rng.random() > 0.015 else f"new{rng.random()}" for w in words]
            docs.append((rng.randrange(10**6, 10**9), " ".join(changed[rng.randint(0, 4) : rng.randint(42, 50)])))
    docs += [(5_000_000_000 + i, docs[0][1]) for i in range(3)] + [docs[1], (docs[2][0], "another text of document two in six")]
    docs += [(6_000_000_000, None), (None, docs[0][1])]
    want = sorted(plain.jaccard(docs), key=str)
    assert joined(spark, docs) == want
    assert 5 <= len({r[2] for r in want}) < len(docs) - 20


def test_families_that_hardly_shrink_are_not_dealt_out_again(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_DOCUMENTS", 4)
    rounds = []

    def all_but_one(sets, percent):
        ids = sorted(r.doc_id for r in sets.select("doc_id").distinct().collect())
        rounds.append(len(ids))
        return spark.createDataFrame([(ids[0], i) for i in ids[1:-1]], "a bigint, b bigint")

    monkeypatch.setattr(jaccard, "_exact_prefixes", all_but_one)
    sets = spark.range(40).selectExpr("id as doc_id", "1L as n")
    members = jaccard._members(spark.range(40).selectExpr("id as doc_id", "0L as family"), sets)
    texts = spark.range(40).selectExpr("id as doc_id", "array(id) as set")
    assert jaccard._narrowed(members, sets, texts, jaccard.PERCENT).count() == 39
    assert rounds == [40]


def test_rounds_over_few_edges_take_few_tasks(spark, monkeypatch):
    """Five trees of 100 nodes, each node led to the one of half its number."""
    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in changed}
    edges = spark.range(500).selectExpr("id as a", "id - id % 100 + (id % 100) div 2 as b")
    want = [(i, i - i % 100) for i in range(500) if i % 100]
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        for most in (50_000, 100):
            monkeypatch.setattr(components, "TASK_EDGES", most)
            found = components.connected_components(edges)
            assert len(found.inputFiles()) <= -(-len(want) // most)
            assert sorted(map(tuple, found.collect())) == want
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_edges(spark):
    text = "Red green blue white black"
    docs = [
        (4, text), (9, text.upper() + " \t\n"), (9, "other words in a second row of nine"), (3, None), (2, ""), (1, "  \n"),
        (None, text), (7, "one two"), (6, "ONE\x0btwo"), (5, "two one"), (8, "É deux"), (10, "é deux"), (11, text), (11, text),
    ]
    assert joined(spark, docs) == sorted(plain.jaccard(docs), key=str)
    assert jaccard.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_search_finds_what_reaches_the_overlap():
    import numpy as np

    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(80)]
    index = jaccard.Index(sets)
    for query in sets:
        for least in (1, 3, 10):
            if least <= len(query):
                found, common = index.search(query, least)
                want = {i: len(np.intersect1d(query, s)) for i, s in enumerate(sets)}
                assert dict(zip(found.tolist(), common.tolist())) == {i: n for i, n in want.items() if n >= least}


def test_long_words_that_differ_in_a_regular_way_are_apart(spark):
    """A word of two letters in the order of bit counts, and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    rows = [(i, "".join(letters[b] for b in bits)) for i, letters in enumerate(("ab", "ba", "ab"))]
    assert joined(spark, rows) == [(0, 1, 0), (1, 1, 1), (2, 1, 0)]


def test_a_full_sketch_still_knows_what_stands_out():
    import numpy as np

    rng = np.random.default_rng(4)
    few, hot = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (20_000_000, 100))
    sketch = jaccard.Sketch.__new__(jaccard.Sketch)
    size = 1 << jaccard.CELL_BITS
    rows = [np.bincount(jaccard._cells(few, r), minlength=size) * 500 + np.bincount(jaccard._cells(hot, r), minlength=size) * 100_000 for r in range(jaccard.DEPTH)]
    sketch.cells = np.array(rows, np.uint32)
    assert (sketch.estimate(few[:1000]) > jaccard.LONG).mean() > 0.9
    sketch._level()
    assert (sketch.estimate(hot) > sketch.long).all()
    assert (sketch.estimate(few[:100_000]) > sketch.long).mean() < 0.001


def test_sets_are_those_of_words_as_defined():
    import re

    rng = random.Random(5)
    parts = ["a", "B", "é", "É", "ab", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\x00"]
    texts = ["", " ", "\t x"] + ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(2_000)]
    seen = {}
    for text, made in zip(texts, jaccard.shingle_sets(pa.array(texts)), strict=True):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall("[^\x20\x09-\x0d]+", lower)
        want = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
        assert len(made) == len(want)
        seen.setdefault(frozenset(want), set()).add(made.tobytes())
    assert all(len(v) == 1 for v in seen.values()) and len(set.union(*seen.values())) == len(seen)
    assert list(jaccard.shingle_sets(pa.array([], pa.string()))) == []


def test_copies_are_not_dealt_out(spark, monkeypatch):
    """Texts that have nothing in common, each in every partition."""
    rows = {}

    def counted(relation, name):
        made = common.stored(relation, name)
        rows[name] = made.count()
        return made

    monkeypatch.setattr(jaccard, "stored", counted)
    docs = [(100 * copy + i, " ".join(f"w{i}x{k}" for k in range(40))) for copy in range(6) for i in range(30)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(docs, 6), "doc_id bigint, text string")
    assert sorted(map(tuple, jaccard.jaccard_join(frame).collect())) == [(i, 36, i % 100) for i, _ in docs]
    assert rows["jaccard-prefixes"] == 0


def test_what_was_stored_on_the_way_is_gone(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_DOCUMENTS", 4)
    docs = [*with_passage(3, 6, 90), *((9_000 + i, f"alone{i} " * 9) for i in range(5))]
    before = set(os.listdir(scratch_folder(spark)))
    assert joined(spark, docs) == sorted(plain.jaccard(docs), key=str)
    names = {name.rsplit("-", 1)[0] for name in set(os.listdir(scratch_folder(spark))) - before}
    assert names <= {"jaccard-sets", "jaccard-classes", "jaccard-families", "jaccard-links", "edges"}


def test_long_texts_that_repeat_themselves(spark, monkeypatch):
    """Families of whose texts some go as sets: they find the same links."""
    rng = random.Random(11)
    docs = []
    for group in range(4):
        words = [f"g{group}w{i}" for i in range(40)]
        for i in range(6):
            text = " ".join([*words, f"end{rng.randrange(3)}"])
            docs.append((100 * group + i, " ".join([text] * rng.choice((1, 1, 30)))))
    docs += [(1_000, docs[0][1] * 9), (1_000, "another text of the same document"), (1_001, None)]
    monkeypatch.setattr(jaccard, "SENT_BYTES", 600)
    sent = jaccard._sent(spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("0L as family", "doc_id", "coalesce(text, '') as text"))
    assert {r["set"] is None for r in sent.collect()} == {True, False}
    assert joined(spark, docs) == sorted(plain.jaccard(docs), key=str)


def test_an_id_that_is_marked_is_found(spark):
    marks = jaccard.Marks(spark.range(-500, 10_000, 3, 5).toDF("doc_id"))
    batch = pa.RecordBatch.from_arrays([pa.array(range(-500, 10_000), pa.int64())], names=["doc_id"])
    found = set(marks.among(batch).column(0).to_pylist())
    assert found >= set(range(-500, 10_000, 3)) and len(found) < 4_000
    assert marks.among(batch.slice(0, 0)).num_rows == 0
