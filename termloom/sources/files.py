"""Corpora held in directories of plain text files, one document per file."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.corpus import Corpus
from termloom.functions.tokenize import WHITESPACE
from termloom.sources.layout import spread_scan


def _file_name(name: Column) -> Column:
    """The last path component as the file system has it: it comes percent-encoded."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _may_repeat_names(spark: SparkSession, paths: str | list[str], **options) -> bool:
    """Can two files have one name? Not in a single directory without subdirectories to read."""
    if not isinstance(paths, str) or any(c in paths for c in "*?[{"):
        return True
    recursive = {k.lower(): str(v).lower() for k, v in options.items()}.get("recursivefilelookup")
    # Partition directories show as columns.
    return recursive == "true" or spark.read.options(**options).text(paths).columns != ["value"]


def _path(path: Column) -> Column:
    """The path below the root of its file system; the scheme may be written in several ways."""
    return F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/")


def _document() -> Column:
    return F.element_at(F.split("path", "/"), -1).alias("document")


def _empty_files(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """``document`` of the zero-length files, which Spark's scans leave out.

    They still count as documents. Spark's file index holds the status of every file in the
    driver's JVM before any scan; those without content are picked there, and only their
    names become rows.
    """
    jvm = spark._jvm
    functors = jvm.org.apache.commons.collections4.functors
    files = spark.read.format("binaryFile").options(**options).load(paths)
    index = files._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    statuses = jvm.scala.jdk.javaapi.CollectionConverters.asJava(index.allFiles())

    def asked(method: str):
        return functors.InvokerTransformer.invokerTransformer(method)

    written = functors.StringValueTransformer.stringValueTransformer()
    length = functors.TransformedPredicate.transformedPredicate(
        asked("getLen"),
        functors.TransformedPredicate.transformedPredicate(written, functors.EqualPredicate.equalPredicate("0")),
    )
    utilities = jvm.org.apache.commons.collections4.CollectionUtils
    empty = utilities.collect(utilities.collect(utilities.select(statuses, length), asked("getPath")), written)
    rows = spark._jsparkSession.createDataset(empty, jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(rows.toDF(), spark).select(_path(F.col("value")).alias("path")).select(_document())


def _names(spark: SparkSession, paths: str | list[str], empty: DataFrame, **options) -> DataFrame:
    """``document`` of every file: of those with content from a scan that opens none of them."""
    files = spark.read.format("binaryFile").options(**options).load(paths)
    return files.select(_path(F.col("path")).alias("path")).select(_document()).unionByName(empty)


def _leading(spark: SparkSession, paths: str | list[str], empty: DataFrame, **options) -> DataFrame:
    """``document`` and an empty text for each file that is empty or begins with white space before a word.

    A line's place in its file is where its split begins, then its number among the rows of the
    task, which reads a split in order.
    """
    line = spark.read.options(**options).text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        _file_name(F.col("_metadata.file_name")).alias("document"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("number"),
        "value",
    )
    bare = F.ltrim("value", F.lit(WHITESPACE))
    place = F.struct("split", "number")
    with_word = F.when(bare != "", F.struct(place.alias("place"), (F.length(bare) < F.length("value")).alias("indented")))
    files = line.groupBy("file", "document").agg(F.min(place).alias("first"), F.min(with_word).alias("word"))
    begun = F.col("word.indented") | (F.col("first") < F.col("word.place"))
    return files.where(begun).select("document").unionByName(empty).withColumn("text", F.lit(""))


def text_files(spark: SparkSession, paths: str | list[str], **options) -> Corpus:
    """One row per file: its name and its whole content.

    Any file name is a document; names starting with ``.`` or ``_`` and
    subdirectories are skipped. Files of the same name in several directories
    are one document. A file must fit in one row (2 GB); use ``text_lines`` for
    larger ones.
    """
    whole = spark.read.options(**options).text(paths, wholetext=True).select(
        _file_name(F.col("_metadata.file_name")).alias("document"), F.col("value").alias("text")
    )
    empty = _empty_files(spark, paths, **options)
    return Corpus(
        spread_scan(whole).unionByName(empty.withColumn("text", F.lit(""))),
        one_row_per_document=not _may_repeat_names(spark, paths, **options),
        names=_names(spark, paths, empty, **options),
    )


def text_lines(spark: SparkSession, paths: str | list[str], **options) -> Corpus:
    """One row per line, with the name of its file; files may be of any size."""
    lines = spark.read.options(**options).text(paths).select(
        _file_name(F.col("_metadata.file_name")).alias("document"), F.col("value").alias("text")
    )
    # A NULL text: the document exists but has no line, not even a blank one.
    empty = _empty_files(spark, paths, **options)
    return Corpus(
        spread_scan(lines).unionByName(empty.withColumn("text", F.lit(None).cast("string"))),
        rows_are_lines=True,
        names=_names(spark, paths, empty, **options),
        leading=_leading(spark, paths, empty, **options),
    )
