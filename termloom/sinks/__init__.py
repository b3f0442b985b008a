"""Writing reports and relations, replacing what was there."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions import render


def write_report(report: DataFrame, path: str, **options) -> None:
    """``key<TAB>value`` lines; the order of a sorted report is that of the part files."""
    line = render.line(F.col("key"), F.col("value"))
    report.select(line.alias("value")).write.mode("overwrite").options(**options).text(path)


def store(relation: DataFrame, path: str) -> DataFrame:
    """Write a relation as parquet and return it as read back."""
    relation.write.mode("overwrite").parquet(path)
    return relation.sparkSession.read.parquet(path)
