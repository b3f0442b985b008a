import itertools
import math
import random

from termloom.llm import decontamination
from termloom.llm.queries import QUERIES
from tests.llm import plain

DOCS = "doc_id bigint, text string, item_id string, seed int"
ITEMS = "item_id bigint, text string, doc_id string, words int"


def test_query_is_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id, r.agreeing, r.words) for r in QUERIES["op6_decontamination"](spark, sf).collect()}
    assert got == plain.contaminated(docs, items)
    assert got


def test_any_two_substitutions_in_a_window_are_tolerated(spark):
    rng = random.Random(5)
    item = [f"w{i}" for i in range(13)]
    docs = []
    for a in range(13):
        for b in range(a):
            text = ["other" if i in (a, b) else w.upper() + "," for i, w in enumerate(item)]
            docs.append((len(docs), " ".join([f"x{rng.random()}" for _ in range(a)] + text + ["end"]), "", 0))
    found = decontamination.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(7, " ".join(item), "", 1)], ITEMS))
    assert {r.doc_id for r in found.collect()} == set(range(len(docs)))


def test_edges(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = [(0, None), (1, ""), (2, text), (2, text), (None, text), (3, "..."), (4, "alpha beta."), (5, "alpha gamma beta"), (6, text[:40])]
    items = [(0, text), (1, text), (2, None), (None, text), (3, "Alpha, beta"), (4, "")]
    found = decontamination.contamination(
        spark.createDataFrame([(*d, "clash", 0) for d in docs], DOCS), spark.createDataFrame([(*i, "clash", 0) for i in items], ITEMS)
    )
    got = {(r.doc_id, r.item_id, r.agreeing, r.words) for r in found.collect()}
    assert got == plain.contaminated(docs, items) == {(2, 0, 13, 13), (2, 1, 13, 13), (4, 3, 2, 2)}
    assert found.count() == len(got)
    empty = spark.createDataFrame([], ITEMS)
    assert decontamination.contamination(spark.createDataFrame([(0, text, "", 0)], DOCS), empty).count() == 0


def test_many_seeds_are_joined_without_sending_them(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SENT_SEEDS", 0)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {tuple(r) for r in decontamination.contamination(docs, items).collect()}
    assert got == {tuple(r) for r in QUERIES["op6_decontamination"](spark, sf).collect()}


def every_window(docs: list, items: list) -> set:
    """(doc_id, item_id, agreeing, window) by sliding every window of every item over every place, without masks."""
    best: dict = {}
    for (doc_id, text), (item_id, passage) in itertools.product(docs, items):
        d, t = text.split(), passage.split()
        w = min(decontamination.WINDOW, len(t))
        for s, i in itertools.product(range(len(t) - w + 1), range(len(d) - w + 1)):
            n = sum(a == b for a, b in zip(t[s : s + w], d[i : i + w]))
            if n >= math.ceil(w * decontamination.AGREEMENT):
                best[doc_id, item_id] = max(best.get((doc_id, item_id), (0, w)), (n, w))
    return {(*key, *value) for key, value in best.items()}


def test_short_items_with_every_allowed_substitution(spark):
    docs, items = [], []
    for n in range(1, 15):
        item = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        wrong = min(n, 13) - math.ceil(min(n, 13) * decontamination.AGREEMENT)
        for size in (wrong, wrong + 1):
            for places in itertools.combinations(range(n), size):
                text = ["other" if i in places else w for i, w in enumerate(item)]
                docs.append((len(docs), " ".join(["start"] * (len(docs) % 3) + text + ["end"] * (len(docs) % 2))))
    docs.append((len(docs), "w5x0 w5x1 w5x2 w5x3"))
    found = decontamination.contamination(
        spark.createDataFrame([(*d, "", 0) for d in docs], DOCS), spark.createDataFrame([(*i, "", 1) for i in items], ITEMS)
    )
    got = sorted((r.doc_id, r.item_id, r.agreeing, r.words) for r in found.collect())
    assert got == sorted(every_window(docs, items)) and {r[1] for r in got} == set(range(1, 15))
