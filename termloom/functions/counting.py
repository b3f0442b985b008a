"""Counting the words of one text inside its own row."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_starts(ordered: Column) -> Column:
    """ARRAY<INT>: where each run of equal words begins, of words in order."""
    begun = F.transform(
        ordered, lambda w, i: F.when(w.eqNullSafe(F.get(ordered, i - 1)), F.lit(-1)).otherwise(i)
    )
    return F.array_remove(begun, -1)


def word_runs(words: Column) -> Column:
    """ARRAY<STRUCT<word STRING, word_count BIGINT>>, one entry per distinct word.

    The words are sorted and each run of equal words becomes one entry, in word
    order. All of it happens inside the row: no shuffle, and a memory need that
    depends on the text alone.
    """

    def runs(ordered: Column) -> Column:
        return _bind(
            run_starts(ordered),
            lambda at: F.transform(
                at,
                lambda p, k: F.struct(
                    F.get(ordered, p).alias("word"),
                    (F.coalesce(F.get(at, k + 1), F.size(ordered)) - p)
                    .cast("bigint")
                    .alias("word_count"),
                ),
            ),
        )

    return _bind(F.sort_array(words), runs)
