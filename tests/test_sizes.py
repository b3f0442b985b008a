"""What holds only while tables are small, on tables that are just large enough."""

import glob

from pyspark.sql import functions as F

import __spark_entry__ as entries
from termloom.functions import render
from termloom.functions.tokenize import MODES
from termloom.operators import indexes, word_counts, word_totals
from termloom.session import MEASURED, scratch, scratch_folder
from tests.oracle import compare, connect
from tests.samples import corpus
from tests.test_plans import final_plan

SF = "/root/testdata/sf0.001"


def _short_documents(spark, path, rows):
    text = F.concat(F.lit("a b"), (F.col("id") % 7).cast("string"))
    spark.range(rows).select(F.col("id").alias("doc_id"), text.alias("text")).write.parquet(f"{path}/documents.parquet")
    con = connect(SF)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    return con


def test_whole_lists_stay_whole_however_long(spark, tmp_path):
    con = _short_documents(spark, tmp_path, indexes.BLOCK_ROWS + 1)
    name = "postings_whole"
    assert compare(spark, con, entries.queries()[name], entries.oracle_sql()[name], str(tmp_path)) == ""


def test_files_read_whole_do_not_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(entries, "FILE_ROWS", 3)
    for name in ("text_folder_written_twice", "text_files_word_totals"):
        with scratch(spark):
            entries.queries()[name](spark, SF)
            assert len(glob.glob(f"{scratch_folder(spark)}/t*/part-*")) >= 200 / 3


def test_totals_are_the_sums_of_the_counts(spark):
    texts = {"a": "x y\n\n x\r\n", "b": "", "c": "\n", "d": " y\x0b x\ty\n", "e": "x\u2028z", "f": "\x01 \x01x"}
    for one_row in (True, False):
        c = corpus(spark, texts, one_row_per_document=one_row)
        for mode in MODES:
            sums = word_counts(c, mode).groupBy("word").agg(F.sum("word_count").alias("total"))
            assert sorted(word_totals(c, mode).collect()) == sorted(sums.collect()), mode


def test_rounded_numbers_and_their_texts_are_those_of_exact_decimals(spark):
    odd = [0.0, 5e-324, 5e-11, 1.5e-10, 0.99999999995, 0.9999999999, 2.5, 109.9511627776, 110.0, 1e9, 1e30, -1.5, -1e-12]
    odd += [float("inf"), float("nan"), None]
    some = spark.range(20_000).select(F.explode(F.array((F.col("id") + 1) / 997, F.ln(F.col("id") + 1), (2 * F.col("id") + 1) / F.lit(2e10))).alias("v"))
    values = some.unionByName(spark.createDataFrame([(v,) for v in odd], "v double"))
    v = F.col("v")
    pairs = (render.rounded(v, 10), F.round(v, 10)), (render.places(v, 10), render.fixed(v, "%.10f"))
    for got, want in pairs:
        assert values.where(~got.eqNullSafe(want)).count() == 0


def test_queries_hash_joins_in_a_session_that_says_nothing(spark):
    before = spark.conf.get(MEASURED)
    broadcast = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    sent = spark.conf.get(broadcast)
    try:
        spark.conf.unset(MEASURED)
        spark.conf.set(broadcast, "-1")
        plan = final_plan(entries.queries()["tfidf_join"](spark, SF))
        assert "ShuffledHashJoin [word" in plan and "SortMergeJoin" not in plan
        spark.conf.set(MEASURED, "0")
        assert "SortMergeJoin [word" in final_plan(entries.queries()["tfidf_join"](spark, SF))
    finally:
        spark.conf.set(MEASURED, before)
        spark.conf.set(broadcast, sent)
