"""An equi-join that splits heavy keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most this many keys are split, whatever the data.
MAX_SPLIT_KEYS = 200_000
# Keys with fewer rows than this are never worth splitting.
SPLIT_ROWS = 1_000_000


def power_of_two(least: Column) -> Column:
    """The smallest power of two that is at least ``least``, a whole number; as BIGINT."""
    return F.when(least <= 1, F.lit(1).cast("bigint")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(least - 1)))
    )


def join_split(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    spread: str | tuple[str, ...] | Column,
    split_rows: int = SPLIT_ROWS,
    most_pieces: Column | None = None,
    keep_pieces: bool = False,
) -> DataFrame:
    """``rows`` joined with ``lookup`` on ``key``, no key being one task's work.

    ``lookup`` has one row per key; its column ``weight`` is (at least) the
    number of rows with that key. Keys with more than ``split_rows`` rows are
    candidates for splitting. A candidate is heavy when it has more than a
    ``1 / MAX_SPLIT_KEYS`` share of all the candidates' rows, so there can be no
    more than ``MAX_SPLIT_KEYS`` heavy keys. The rows of a heavy key are dealt
    over as many pieces as it takes to bring each one down to that share, by a
    hash of the columns ``spread``, and its lookup row is copied to every piece. The number
    of pieces is a power of two, so copies add at most ``4 * MAX_SPLIT_KEYS`` rows. Rows of
    other keys are in piece 0.

    The heavy keys travel in a broadcast table. A key of n bytes in it stands for more than
    ``split_rows`` rows that hold them too, so their bytes are no more than those of the
    rows divided by ``split_rows``.

    ``most_pieces``, a power of two from columns of ``lookup``, bounds the pieces of a key.
    With ``keep_pieces`` the columns ``_piece`` and ``_pieces`` stay. The joined rows lie by
    key and piece, so grouping by both, and by whatever refines them, needs no
    shuffle. ``spread`` may be a whole number to deal by, instead of columns to hash; it is
    worked out for the rows of heavy keys only.

    The pieces follow from the data alone, so a recomputed task makes the same
    ones.
    """
    candidates = lookup.where(F.col(weight) > split_rows)
    share = candidates.agg(
        F.greatest(F.sum(weight) / MAX_SPLIT_KEYS, F.lit(float(split_rows)))
    ).scalar()
    pieces = power_of_two(F.ceil(F.col(weight) / share))
    if most_pieces is not None:
        pieces = F.least(pieces, most_pieces)
    heavy = candidates.select(key, pieces.alias("_pieces")).where(F.col("_pieces") > 1)
    one = F.lit(1).cast("bigint")

    def with_pieces(side: DataFrame) -> DataFrame:
        return side.join(F.broadcast(heavy), key, "left").withColumn(
            "_pieces", F.coalesce("_pieces", one)
        )

    if isinstance(spread, str):
        spread = (spread,)
    number = spread if isinstance(spread, Column) else F.xxhash64(*spread)
    piece = F.when(F.col("_pieces") > 1, F.pmod(number, F.col("_pieces"))).otherwise(one - 1)
    dealt = with_pieces(rows).withColumn("_piece", piece)
    copied = with_pieces(lookup).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1))
    )
    # No hint: the sizes that adaptive execution measures decide. A partition's
    # share of the lookup is hashed where that is small, else both sides are sorted,
    # which spills. The settings of build_session keep estimates out of it.
    joined = dealt.drop("_pieces").join(copied, [key, "_piece"])
    return joined if keep_pieces else joined.drop("_piece", "_pieces")
