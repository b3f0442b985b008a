"""Key and value reports over the weights."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import render


def tf_report(term_counts: DataFrame) -> DataFrame:
    """``key = word@document``, ``value = word_count/doc_size``"""
    return term_counts.select(
        render.key(F.col("word"), F.col("document")).alias("key"),
        render.ratio(F.col("word_count"), F.col("doc_size")).alias("value"),
    )


def idf_report(weighted: DataFrame) -> DataFrame:
    """``key = word@document``, ``value = num_docs/df``"""
    return weighted.select(
        render.key(F.col("word"), F.col("document")).alias("key"),
        render.ratio(F.col("num_docs"), F.col("df")).alias("value"),
    )


def tfidf_report(
    weighted: DataFrame, rendered: Callable[[Column], Column] = render.shortest
) -> DataFrame:
    """``key = document@word``, ``value`` the rendered weight, in byte order of the key.

    The order is that of the whole key, which is not that of its parts:
    ``doc10@a`` comes before ``doc1@a``. Sorting is by ranges of the key over
    all tasks: rows of a key are in one of them, where their values settle the order. Spark
    goes over the weights once more to find the ranges, so values are made after that.
    """
    keyed = weighted.select(render.key(F.col("document"), F.col("word")).alias("key"), "tfidf")
    dealt = keyed.repartitionByRange("key").select("key", rendered(F.col("tfidf")).alias("value"))
    return dealt.sortWithinPartitions("key", "value")
