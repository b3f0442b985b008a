import random

import numpy as np

from termloom.llm import suffix_dedup
from termloom.llm.queries import QUERIES
from tests.llm import plain

SCHEMA = "doc_id bigint, text string, start int, spans string"


def removed(spark, docs):
    rows = suffix_dedup.remove_repeats(spark.createDataFrame([(*d, 1, "clash") for d in docs], SCHEMA).repartition(3)).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, plain.hashlib.sha256(r.kept).hexdigest()) for r in rows), key=str)


def test_query_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op7_suffix_dedup"](spark, sf).collect())) == sorted(plain.kept_bytes(docs))


def test_random_texts_of_few_letters(spark):
    rng = random.Random(7)
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randint(1, 90))) for _ in range(12)]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    assert removed(spark, docs) == sorted(plain.kept_bytes(docs), key=str)


def test_edges(spark):
    line = "A line of exactly this many letters, long enough to go."
    docs = [
        (5, line), (5, line), (5, "x" + line), (7, line[:49]), (8, line[:50]), (9, line + line), (3, None), (4, ""), (None, line),
        (10, "a" * 400), (11, "a" * 333), (12, "ab" * 200 + line), (2, "short"),
    ]
    assert removed(spark, docs) == sorted(plain.kept_bytes(docs), key=str)
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sorter_sorts_as_bytes_do():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    start = rng.permutation(2900)
    segment = rng.integers(0, 5, len(start))
    made = suffix_dedup.SuffixSorter(suffix_dedup.Bytes(data), start, segment).sorted()
    keys = [(segment[i], data[start[i] : start[i] + 50].tobytes()) for i in made]
    assert keys == sorted(keys) and sorted(made) == list(range(len(start)))


def test_a_common_key_is_not_one_group(spark, monkeypatch):
    rng = random.Random(3)
    passage = "A passage that nearly every document holds, and which is followed by other words each time: "
    tails = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(400)]
    docs = [(i, f"{rng.random()} {passage}{tails[i % 400]}") for i in range(600)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    anchors = suffix_dedup._first_pass(rows).where("place >= 0").groupBy("anchor").count()
    assert anchors.agg({"count": "max"}).first()[0] < 60
    monkeypatch.setattr(suffix_dedup, "BUCKET_STRETCHES", 50)
    whole = suffix_dedup._bucket

    def bounded(table):
        assert table.num_rows < 400, table.num_rows
        return whole(table)

    monkeypatch.setattr(suffix_dedup, "_bucket", bounded)
    assert removed(spark, docs) == sorted(plain.kept_bytes(docs), key=str)
