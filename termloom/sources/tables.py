"""Corpora held in tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.corpus import Corpus
from termloom.sources.layout import spread_scan


def table_corpus(
    spark: SparkSession,
    path: str,
    document: str,
    text: str,
    one_row_per_document: bool = False,
    format: str = "parquet",
) -> Corpus:
    """A corpus from two columns of a stored table; no other column is read.

    Pass ``one_row_per_document=True`` where ``document`` is a key of the table.
    """
    scan = spark.read.format(format).load(path)
    return Corpus(spread_scan(corpus_columns(scan, document, text)), one_row_per_document)


def corpus_columns(table: DataFrame, document: str, text: str) -> DataFrame:
    return table.select(
        F.col(document).cast("string").alias("document"),
        F.col(text).cast("string").alias("text"),
    )
