"""Documents that hold passages of a benchmark, found by spaced seeds.

Words are runs of letters and digits, in lower case. A mask of ones and zeros laid at
a word hashes the words under its ones, so it does not see a substituted word under a
zero. The hashes of all masks at all places of the benchmark are joined to those of
the documents. Around each hit the two are compared word by word at the same distance:
a window of `WINDOW` words over the hit, or the whole item if it is shorter, must
agree in `AGREEMENT` of its words. The masks miss no window of 12 or 13 words with two
substitutions. An item of fewer words has masks of its own, as long as the item: for each
set of words that may be substituted, one that has no ones there. Words are compared by
64-bit hashes.

The benchmark's hashes are sent to all tasks if they are known to be few; else both
sides are shuffled by hash. Null texts and null ids: a null or empty text has no
words, and rows without doc_id or item_id are in no result. Items or documents with
one id are judged apart and reported together.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ("111111", "1010001111", "1101011001")
WINDOW = 13
AGREEMENT = 0.8
COVERED = 12  # words from which MASKS miss nothing
WEIGHT = 6  # ones that a mask of a shorter item has at least, if that leaves it enough zeros
SENT_SEEDS = 300_000  # rows of some 250 bytes that may be sent to every task


def words(text: Column) -> Column:
    """64-bit hashes of the words."""
    found = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def _own_masks(n: int) -> tuple[str, ...]:
    """Masks for items of n words, few and heavy ones.

    The words are cut into blocks; each mask has zeros in as many blocks as words may be
    substituted, and there is a mask for every choice of these blocks.
    """
    wrong = n - math.ceil(n * AGREEMENT)
    for blocks in range(wrong + 1, n + 1):
        of = [i * blocks // n for i in range(n)]
        masks = ["".join("0" if b in zeros else "1" for b in of) for zeros in combinations(range(blocks), wrong)]
        if min(m.count("1") for m in masks) >= min(WEIGHT, n - wrong):
            break
    return tuple(masks)


def _seed(words: Column, at: Column, mask: str) -> Column:
    """The hash under a mask at a place, null where the mask goes beyond the end."""
    picked = [F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.when(F.get(words, at + len(mask) - 1).isNotNull(), F.xxhash64(F.lit(mask), *picked))


def _seeds(rows: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """`rows` with words, by place and mask: at, mask, seed.

    The outer form of explode keeps the optimizer from splitting the text once more
    for a filter on the size.
    """
    last = F.size("words") - min(map(len, masks))
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    at = rows.select("*", F.explode_outer(places).alias("at"))
    each = F.array(*(_seed(F.col("words"), F.col("at"), m) for m in masks))
    return at.select("*", F.posexplode_outer(each).alias("mask", "seed")).where("at is not null and seed is not null")


def _benchmark_seeds(benchmark: DataFrame, masks: tuple[str, ...], own: tuple[str, ...]) -> DataFrame:
    """The seeds of the items, with the words around each that a window over it can reach."""
    rows = benchmark.select("item_id", words(F.col("text")).alias("words")).where("item_id is not null").withColumn("size", F.size("words"))
    spans = F.array(*(F.lit(len(m)) for m in masks + own))
    span = F.get(spans, F.col("mask"))
    window = F.least(F.lit(WINDOW), F.col("size"))
    first = F.greatest(F.lit(0), F.col("at") + span - window)
    end = F.least(F.col("size"), F.col("at") + window)
    # Items have either the seeds of their size or those of all others.
    general = F.col("mask") < len(masks)
    apart = F.col("size") < COVERED
    return (
        _seeds(rows, masks + own)
        .where((general & ~apart) | (~general & (F.col("size") == span)))
        .select(
            "seed",
            "item_id",
            span.alias("span"),
            window.alias("window"),
            (F.col("at") - first).alias("before"),
            F.slice("words", first + 1, end - first).alias("around"),
        )
        .distinct()
    )


def _near(hits: DataFrame) -> DataFrame:
    """Hits with the words around them in the document and, at the same distance, in the item.

    Only these few words leave the stage that makes the seeds, never a text's whole array.
    """
    shift = F.least("before", "at")  # words before the hit that both have
    ours = F.slice("words", F.col("at") - shift + 1, shift + F.size("around") - F.col("before"))
    theirs = F.slice("around", F.col("before") - shift + 1, F.size("around"))
    return hits.select("doc_id", "item_id", "window", ours.alias("ours"), theirs.alias("theirs"))


def _agreeing() -> Column:
    """Words that agree in the best window over a hit; -1 where no window fits into the document."""
    both = F.least(F.size("ours"), F.size("theirs"))
    same = F.zip_with(F.slice("ours", F.lit(1), both), F.slice("theirs", F.lit(1), both), lambda a, b: (a == b).cast("int"))
    sums = F.transform(
        F.array(same),
        lambda s: F.when(
            F.size(s) >= F.col("window"),
            F.array_max(
                F.transform(
                    F.sequence(F.lit(1), F.size(s) - F.col("window") + 1),
                    lambda i: F.aggregate(F.slice(s, i, F.col("window")), F.lit(0), lambda x, y: x + y),
                )
            ),
        ).otherwise(F.lit(-1)),
    )
    return sums[0]


def contamination(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """doc_id, item_id, the words that agree in the best window, and the window's words.

    One row for each pair of a document and an item whose passage it holds.
    """
    sizes = benchmark.select(F.size(words(F.col("text"))).alias("n")).where(F.col("n").between(1, COVERED - 1))
    own = tuple(m for n in sorted(r.n for r in sizes.distinct().collect()) for m in _own_masks(n))
    seeds = _benchmark_seeds(benchmark, masks, own)
    seeds = F.broadcast(seeds) if seeds.count() <= SENT_SEEDS else seeds.hint("merge")
    texts = docs.where("doc_id is not null").select("doc_id", words(F.col("text")).alias("words"))
    hits = _near(_seeds(texts, masks + own).join(seeds, "seed"))
    # Aggregated before it is filtered: a filter would move into the join and take it
    # out of the stage that makes the seeds.
    best = hits.groupBy("doc_id", "item_id", "window").agg(F.max(_agreeing()).alias("agreeing"))
    return (
        best.where(F.col("agreeing") >= F.ceil(F.col("window") * AGREEMENT))
        .groupBy("doc_id", "item_id")
        .agg(F.max("agreeing").alias("agreeing"), F.max("window").alias("words"))
    )
