from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom import Corpus, operators, plans
from termloom.operators import join_split, split_join
from tests.samples import corpus


@pytest.fixture
def skewed(spark):
    """3,000 rows: a third have one key, one more key has 300 rows, the rest have few."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 10 == 1, F.lit("warm"))
        .otherwise(F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(400)).cast("string")))
    )
    rows = spark.range(3000).select(key.alias("key"), F.col("id").cast("string").alias("name"))
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"))
    return rows, lookup


@pytest.mark.parametrize("split_rows", [1, 20, 100, 10_000])
def test_same_rows_as_a_plain_join(skewed, split_rows):
    rows, lookup = skewed
    split = join_split(rows, lookup, "key", "n", "name", split_rows)
    plain = rows.join(lookup, "key")
    assert split.columns == plain.columns
    assert sorted(split.collect()) == sorted(plain.collect())


def _largest_task(frame) -> int:
    sizes = frame.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count"))
    return sizes.first()[0]


def test_heavy_keys_are_dealt_over_tasks(spark, skewed):
    rows, lookup = skewed
    changed = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # A small lookup would be sent to the tasks as the rows happen to lie.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        assert _largest_task(join_split(rows, lookup, "key", "n", "name", 10_000)) >= 1000
        assert _largest_task(join_split(rows, lookup, "key", "n", "name", 20)) < 300
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_number_of_split_keys_and_pieces_are_bounded(spark, monkeypatch):
    """However small the split size, no more keys are broadcast than the bound."""
    monkeypatch.setattr(split_join, "MAX_SPLIT_KEYS", 10)
    sent = []
    monkeypatch.setattr(split_join.F, "broadcast", lambda table: sent.append(table) or table)
    sizes = {f"k{i}": 10 for i in range(100)} | {f"h{i}": 300 for i in range(5)}
    rows = spark.createDataFrame([(k, str(i)) for k, n in sizes.items() for i in range(n)], "key string, name string")
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"))
    joined = join_split(rows, lookup, "key", "n", "name", split_rows=1)
    assert Counter(r.key for r in joined.collect()) == sizes
    # A share is 2500 / 10 rows: only the five keys of 300 rows are above it.
    heavy = sent[0].collect()
    assert len(heavy) == 5 <= 10
    assert all(r["_pieces"] == 2 for r in heavy)


def test_no_rows(spark):
    c = corpus(spark, {"p": "", "q": " "})
    assert plans.tfidf(c).collect() == []
    assert operators.postings(c).collect() == []


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_posting_blocks_make_up_the_list(spark, block_rows):
    c = corpus(spark, {f"d{i}": "every " + f"w{i % 4}" for i in range(40)})
    index = operators.postings(c, block_rows=block_rows, split_rows=5)
    lists = {}
    for r in index.collect():
        assert 0 <= r.block < r.blocks == 1 << (-(-r.df // block_rows) - 1).bit_length()
        names = [p.document for p in r.postings]
        assert names == sorted(names)
        lists.setdefault(r.word, []).extend(names)
    assert sorted(lists.pop("every")) == sorted(f"d{i}" for i in range(40))
    for word, names in lists.items():
        assert sorted(names) == sorted(f"d{i}" for i in range(40) if f"w{i % 4}" == word)
    expanded = operators.expand_postings(index, c)
    assert expanded.count() == 80
    assert {(r.num_docs, r.df) for r in expanded.collect()} == {(40, 40), (40, 10)}


@pytest.mark.parametrize("block_rows", [1, 7, 20, 1000])
def test_blocks_do_not_depend_on_how_the_work_is_split(spark, block_rows):
    c = corpus(spark, {f"d{i}": "a every " + f"w{i % 4}" for i in range(40)})
    whole = sorted(operators.postings(c, block_rows=block_rows).collect())
    for split_rows in (1, 3, 5, 10, 39):
        index = operators.postings(c, block_rows=block_rows, split_rows=split_rows)
        assert sorted(index.collect()) == whole
    lines = corpus(spark, [("p", f"w{i}") for i in range(40)] + [("q", "x y")])
    whole = sorted(operators.forward_index(lines, block_rows=block_rows).collect())
    for split_rows in (1, 3, 39):
        index = operators.forward_index(lines, block_rows=block_rows, split_rows=split_rows)
        assert sorted(index.collect()) == whole


def test_powers_of_two(spark):
    rows = spark.range(0, 70).union(spark.createDataFrame([(2**40,), (2**40 + 1,)], "id bigint"))
    for n, made in rows.select("id", split_join.power_of_two(F.col("id"))).collect():
        assert made == 1 << max(n - 1, 0).bit_length()


@pytest.mark.parametrize("block_rows", [2, 1000])
def test_forward_index_of_many_rows(spark, block_rows):
    texts = [("p", "a b a"), ("p", "c a"), ("q", "b"), ("r", "")]
    found = {}
    for r in operators.forward_index(corpus(spark, texts), block_rows=block_rows).collect():
        distinct = {"p": 3, "q": 1}[r.document]
        assert r.blocks == 1 << (-(-distinct // block_rows) - 1).bit_length()
        found.setdefault((r.document, r.doc_size), {}).update(
            {e.word: e.word_count for e in r.words}
        )
    assert found == {("p", 5): {"a": 3, "b": 1, "c": 1}, ("q", 1): {"b": 1}}


def test_forward_index_of_one_row(spark):
    c = corpus(spark, {"p": "b a b", "q": " "})
    [r] = operators.forward_index(c).collect()
    assert (r.document, r.doc_size, r.block, r.blocks) == ("p", 3, 0, 1)
    assert [tuple(e) for e in r.words] == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("block_rows", [1, 2, 7, 1000])
def test_forward_index_does_not_depend_on_the_form_of_the_rows(spark, block_rows):
    texts = {"p": "a " * 10 + "b", "q": " ".join(f"w{i}" for i in range(40)), "r": "", "s": "x x"}
    merged = operators.forward_index(corpus(spark, list(texts.items())), block_rows=block_rows)
    inside = operators.forward_index(corpus(spark, texts), block_rows=block_rows)
    assert sorted(merged.collect()) == sorted(inside.collect())


def test_claim_of_one_row_per_document_can_be_checked(spark):
    rows = corpus(spark, [("p", "a"), ("p", "b")]).rows
    with pytest.raises(ValueError, match="'p' has 2 rows"):
        Corpus(rows, one_row_per_document=True).require_unique_documents()
    Corpus(rows).require_unique_documents()


def test_tokens_know_the_size_in_both_forms(spark):
    merged = operators.tokens(corpus(spark, [("p", "a b"), ("p", "a"), ("q", "c")]), split_rows=1)
    inside = operators.tokens(corpus(spark, {"p": "a b a", "q": "c"}))
    assert merged.columns == inside.columns == ["document", "doc_size", "word"]
    assert sorted(merged.collect()) == sorted(inside.collect())
