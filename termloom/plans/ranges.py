"""Ranges of documents whose reports follow each other."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.corpus import Corpus
from termloom.functions import render

# Bytes of texts to a range, and ranges of one report, at most.
RANGE_BYTES = 64 * 1024 * 1024
MOST_RANGES = 5
# About so many names say where ranges begin.
NAMES = 10_000


def _lead(document: Column) -> Column:
    """What the keys ``document@word`` begin with, up to the first separator.

    No lead begins another one, so keys of different leads are in the order of these,
    whatever the rest of the name or the word is.
    """
    return F.concat(F.substring_index(document, render.KEY_SEPARATOR, 1), F.lit(render.KEY_SEPARATOR))


def document_ranges(corpus: Corpus, most: int | None = None) -> list[Column]:
    """Conditions on ``document``, each document meeting one of them, for reports in parts.

    All keys ``document@word`` of a range come before those of the next. The ranges have about
    as many bytes of texts each: names are picked by a digest and weighed to say where they
    begin, which changes no row of the report.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    names = corpus.texts.select(_lead(F.col("document")).alias("lead"), size.alias("size")).groupBy("lead").agg(F.sum("size").alias("size"))
    many, total = names.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(most or MOST_RANGES, -(-total // RANGE_BYTES))
    if ranges <= 1:
        return [F.lit(True)]
    picked = names.where(F.pmod(F.xxhash64("lead"), F.lit(-(-many // NAMES))) == 0).collect()
    share, seen, bounds = sum(r["size"] for r in picked) / ranges, 0, []
    # Spark compares strings by their bytes.
    for r in sorted(picked, key=lambda r: r["lead"].encode()):
        if seen >= share * (len(bounds) + 1):
            bounds.append(r["lead"])
        seen += r["size"]
    lead = _lead(F.col("document"))
    lower = [None, *bounds]
    upper = [*bounds, None]
    return [_between(lead, low, high) for low, high in zip(lower, upper)]


def _between(value: Column, low: str | None, high: str | None) -> Column:
    above = F.lit(True) if low is None else value >= F.lit(low)
    return above if high is None else above & (value < F.lit(high))
