"""Quality rules: plain limits on counts, and robust multivariate outliers for the rest.

All of it is column expressions and aggregations. A text is counted inside its row.
A text with too few words, or too much of which repeats, fails the plain rules. Of
each other one a vector of transformed counts is taken: the logarithms of its length, of
its mean word length and of its symbols a hundred words, the share of its lines that
repeat and the share of its words in repeated windows.

For each language and source the minimum covariance determinant says how these vectors
usually lie: the mean and covariance of that share `SUBSET` of them whose covariance has
the least determinant. It is sought by concentration steps from two starts, a diagonal
one from medians and one from signs about the median: all vectors are measured by the
estimate in hand, the nearest share is kept, and its mean and covariance are the next
estimate, until the determinants rest. A last estimate is made of all vectors that
the best one finds near. Texts beyond `CUTOFF` of it are rejected.

How it scales. A step is one pass over a stored table of five numbers a text, and one
shuffle of partial sums: distances fall into cells a 32nd of a power of two wide, each task sums
its vectors by cell, and the nearest share is that of all cells up to the one in which it
is reached. So no group is sorted or collected; a group with a third of all rows is some hundred
cells. The estimates of groups are sent to all tasks while they are `SENT_GROUPS` at most, else
joined by a shuffle that splits large groups.

Equal vectors of one language and source count once, so that copies of a text do not make
up the estimate. `LEAST_SPREAD` is added to every covariance: a count that is zero in
nearly all texts has no spread otherwise, and nothing but zero would be usual. Sources
with fewer than `LEAST_ROWS` such vectors are pooled with the others of their language, and
what is still fewer with all such rest; in a pool that is too small nothing is rejected.

Null texts have no words. Null languages and sources are values like any other. Every row
gives one row, repeated ones too; a row without doc_id is judged like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.counting import _bind
from termloom.functions.tokenize import WHITESPACE, words
from termloom.llm.common import stored
from termloom.operators import join_split

# The plain rules; fixed values.
LEAST_WORDS = 20
MOST_REPEATED = 30  # of 100 words
WINDOW = 8
NO_SYMBOL = "[^#*$%&|<>]+"

SIZE = 5
# Spread that a vector's entries have at least: logarithms of length, word length and symbols, two shares.
LEAST_SPREAD = (0.25, 0.03, 0.5, 0.15, 0.1)
SUBSET = 0.75
LEAST_ROWS = 50
STEPS = 12
RESTING = 1e-6
CELLS = 32  # to a power of two of the squared distance
MEDIAN_CELLS = 8  # to the least spread
NEAR = 0.975  # share of a normal distribution that the last estimate is made of
TAIL = 1e-6  # share of a normal distribution that is rejected
SENT_GROUPS = 20_000  # estimates of some 300 bytes

_X = [f"x{i}" for i in range(SIZE)]
_PAIRS = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]


def _chi_square(x: float, k: int) -> float:
    """Share of a chi-square distribution of k degrees below x, by its power series."""
    a, half = k / 2, x / 2
    if half <= 0:
        return 0.0
    term = total = math.exp(a * math.log(half) - half - math.lgamma(a + 1))
    n = 0
    while term > total * 1e-17:
        n += 1
        term *= half / (a + n)
        total += term
    return total


def _quantile(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, k) < share else (low, middle)
    return low


def _consistency(share: float) -> float:
    """What a covariance of the nearest share must be multiplied by to be that of all of a normal distribution."""
    return share / _chi_square(_quantile(share, SIZE), SIZE + 2)


CUTOFF = _quantile(1 - TAIL, SIZE)


def _windows(found: Column, of) -> Column:
    """`of` each window of words."""
    return F.transform(F.sequence(F.lit(1), F.size(found) - (WINDOW - 1)), lambda i: of(F.slice(found, i, WINDOW), i))


def _repeated(found: Column) -> Column:
    """Words in windows that come twice or more: windows are looked at by hash, and if any repeat, by their words."""

    def covered(ordered: Column) -> Column:
        same = lambda e, k: e["window"].eqNullSafe(F.get(ordered, k)["window"])
        places = F.transform(ordered, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["at"]))
        return _bind(
            F.sort_array(F.array_compact(places)),
            lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    hashed = _bind(F.transform(found, lambda w: F.xxhash64(w)), lambda h: _windows(h, lambda window, _: F.xxhash64(window)))
    repeats = _bind(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    exact = _bind(
        F.sort_array(_windows(found, lambda window, i: F.struct(F.array_join(window, " ").alias("window"), i.alias("at")))), covered
    )
    return F.when(F.size(found) < WINDOW, F.lit(0)).when(repeats, exact).otherwise(F.lit(0))


def counted(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """`columns` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.

    n_lines are the lines with a word.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    of_words = _bind(
        words(whole),
        lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), _repeated(w).alias("n_repeat_words")),
    )
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.btrim(line, F.lit(WHITESPACE))) > 0)
    of_lines = _bind(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    made = docs.select(
        *(F.col(c) for c in columns),
        of_words.alias("__words"),
        F.length(F.regexp_replace(whole, NO_SYMBOL, "")).alias("__symbols"),
        of_lines.alias("__lines"),
    )
    long = lambda c: F.col(c).cast("long")
    failed = (F.col("__words.n_words") < LEAST_WORDS) | (
        100 * long("__words.n_repeat_words") > MOST_REPEATED * long("__words.n_words")
    )
    return made.select(
        *(F.col(c) for c in columns),
        long("__words.n_words").alias("n_words"),
        long("__words.word_chars").alias("word_chars"),
        long("__symbols").alias("n_symbols"),
        long("__lines.n_lines").alias("n_lines"),
        long("__lines.n_dup_lines").alias("n_dup_lines"),
        long("__words.n_repeat_words").alias("n_repeat_words"),
        failed.alias("base_failed"),
    )


def _vector() -> list[Column]:
    """The transformed counts; those that logarithms are taken of are at least 1 in texts that did not fail."""
    n, one = F.greatest("n_words", F.lit(1)), F.lit(1)
    return [
        F.ln(n),
        F.ln(F.greatest("word_chars", one) / n),
        F.log1p(100 * F.col("n_symbols") / n),
        F.col("n_dup_lines") / F.greatest("n_lines", one),
        F.col("n_repeat_words") / n,
    ]


def _with(rows: DataFrame, table: DataFrame, key: str, spread: tuple[str, ...]) -> DataFrame:
    """`rows` with their group's row of `table`, whose column n is the number of them at least."""
    if table.count() <= SENT_GROUPS:
        return rows.join(F.broadcast(table), key)
    return join_split(rows, table, key=key, weight="n", spread=spread)


# Written as SQL text: a column expression of this size is thousands of calls to the JVM.
def _away() -> list[Column]:
    return [F.expr(f"x{i} - mean[{i}] AS y{i}") for i in range(SIZE)]


def _distance() -> Column:
    """The squared Mahalanobis distance of the vector whose distances from the mean are y0, y1 ..."""
    return F.expr(" + ".join(f"{1 if i == j else 2} * inverse[{i}][{j}] * y{i} * y{j}" for i, j in _PAIRS))


def _sums() -> list[Column]:
    once = [f"sum(y{i}) AS s{i}" for i in range(SIZE)]
    return [F.expr(e) for e in ("count(*) AS m", *once, *(f"sum(y{i} * y{j}) AS q{i}{j}" for i, j in _PAIRS))]


def _resummed() -> list[Column]:
    return [F.expr(f"sum({c}) AS {c}") for c in ("m", *(f"s{i}" for i in range(SIZE)), *(f"q{i}{j}" for i, j in _PAIRS))]


def _matrix(entry: Callable[[int, int], str]) -> str:
    """Of a covariance's entries, with the least spread added."""

    def added(i: int, j: int) -> str:
        own = entry(min(i, j), max(i, j))
        return f"{own} + {LEAST_SPREAD[i] ** 2!r}D" if i == j else own

    return f"array({', '.join('array(' + ', '.join(added(i, j) for j in range(SIZE)) + ')' for i in range(SIZE))})"


def _inverted(matrix: str) -> Column:
    """inverse and log_det of a positive definite matrix, row by row, by exchanging one pivot after the other."""
    pivot = "done.inverse[k][k]"
    entry = (
        f"CASE WHEN i = k AND j = k THEN 1 / {pivot} WHEN i = k THEN v / {pivot} WHEN j = k THEN -v / {pivot}"
        f" ELSE v - row[k] * done.inverse[k][j] / {pivot} END"
    )
    swept = f"transform(done.inverse, (row, i) -> transform(row, (v, j) -> {entry}))"
    step = f"struct({swept} AS inverse, done.log_det + ln({pivot}) AS log_det)"
    return F.expr(f"aggregate(sequence(0, {SIZE - 1}), struct({matrix} AS inverse, 0D AS log_det), (done, k) -> {step}) AS of")


def _estimate(summed: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The estimates that sums about an earlier mean give; `share` of a normal distribution was summed."""
    covariance = _matrix(lambda i, j: f"{_consistency(share)!r}D * (q{i}{j} / m - (s{i} / m) * (s{j} / m))")
    mean = f"array({', '.join(f'mean[{i}] + s{i} / m' for i in range(SIZE))}) AS mean"
    made = summed.select(*keys, "n", F.expr(mean), _inverted(covariance))
    return made.select(*keys, "n", "mean", "of.inverse", "of.log_det")


def _medians(points: DataFrame) -> DataFrame:
    """grouped, n, centre and spread: medians, and median distances from them, of cells of the entries."""
    unit = [s / MEDIAN_CELLS for s in LEAST_SPREAD]
    cells = points.select("grouped", F.posexplode(F.array(*(F.round(F.col(x) / u).cast("long") for x, u in zip(_X, unit)))).alias("i", "cell"))
    counts = cells.groupBy("grouped", "i", "cell").agg(F.count("*").alias("k"))
    of = Window.partitionBy("grouped", "i")

    def median(values: DataFrame, by: str, name: str) -> DataFrame:
        reached = values.withColumn("__reached", F.sum("k").over(of.orderBy(by)))
        return reached.withColumn(name, F.min(F.when(2 * F.col("__reached") >= F.col("n"), F.col(by))).over(of))

    centred = median(counts.withColumn("n", F.sum("k").over(of)), "cell", "centre")
    spread = median(centred.withColumn("away", F.abs(F.col("cell") - F.col("centre"))), "away", "spread")
    each = spread.groupBy("grouped", "i").agg(F.max("n").alias("n"), F.max("centre").alias("centre"), F.max("spread").alias("spread"))
    listed = each.groupBy("grouped").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "centre", "spread"))).alias("of"))
    # Of a normal distribution, the standard deviation is 1.4826 times the median distance.
    centre = ", ".join(f"of[{i}].centre * {u!r}D" for i, u in enumerate(unit))
    spread = ", ".join(f"sqrt(pow(of[{i}].spread * {1.4826 * u!r}D, 2) + {s**2!r}D)" for i, (u, s) in enumerate(zip(unit, LEAST_SPREAD)))
    return listed.select("grouped", "n", F.expr(f"array({centre})").alias("mean"), F.expr(f"array({spread})").alias("spread"))


def _starts(points: DataFrame) -> DataFrame:
    """grouped, start, n, mean, inverse, log_det of the two estimates that concentration begins with."""
    medians = stored(_medians(points).where(F.col("n") >= LEAST_ROWS), "rules-medians")
    diagonal = _matrix(lambda i, j: f"spread[{i}] * spread[{i}]" if i == j else "0D")
    scaled = _with(points, medians, "grouped", tuple(_X)).select("grouped", "n", "mean", "spread", *_away())
    length = " + ".join(f"pow(y{i} / spread[{i}], 2)" for i in range(SIZE))
    signs = scaled.withColumn("length", F.expr(f"sqrt({length})")).where("length > 0")
    signs = signs.select("grouped", "n", "mean", *(F.expr(f"y{i} / length AS y{i}") for i in range(SIZE)))
    summed = signs.groupBy("grouped").agg(F.max("n").alias("n"), F.max("mean").alias("mean"), *_sums())
    by_sign = _matrix(lambda i, j: f"{SIZE} * q{i}{j} / m")
    both = medians.select("grouped", F.lit(0).alias("start"), "n", "mean", F.expr(diagonal).alias("matrix")).unionByName(
        summed.select("grouped", F.lit(1).alias("start"), "n", "mean", F.expr(by_sign).alias("matrix"))
    )
    made = both.select("grouped", "start", "n", "mean", _inverted("matrix"))
    return made.select("grouped", "start", "n", "mean", "of.inverse", "of.log_det")


def _concentrated(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """The next estimates: of the nearest share of each group's vectors."""
    keys = ["grouped", "start"]
    near = _with(points, estimates, "grouped", tuple(_X)).select(*keys, "n", "mean", "inverse", *_away())
    cell = F.floor(CELLS * F.log2(F.greatest(_distance(), F.lit(1e-9))))
    cells = near.withColumn("cell", cell).groupBy(*keys, "cell").agg(F.max("n").alias("n"), F.max("mean").alias("mean"), *_sums())
    before = F.sum("m").over(Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    nearest = cells.withColumn("__before", F.coalesce(before, F.lit(0))).where(F.col("__before") < F.ceil(SUBSET * F.col("n")))
    summed = nearest.groupBy(*keys).agg(F.max("n").alias("n"), F.max("mean").alias("mean"), *_resummed())
    return _estimate(summed, keys, SUBSET)


def usual(points: DataFrame) -> DataFrame:
    """grouped, n, mean and inverse: how the vectors of each large enough group of `points` usually lie."""
    estimates = stored(_starts(points), "rules-estimates")
    before = None
    for _ in range(STEPS):
        now = stored(_concentrated(points, estimates), "rules-estimates")
        total, groups = now.agg(F.sum("log_det"), F.count("*")).first()
        estimates = now
        if not groups or (before is not None and abs(total - before) <= RESTING * groups):
            break
        before = total
    best = estimates.groupBy("grouped").agg(F.min(F.struct("log_det", "start", "n", "mean", "inverse")).alias("b"))
    best = stored(best.select("grouped", "b.n", "b.mean", "b.inverse"), "rules-estimates")
    near = _with(points, best, "grouped", tuple(_X)).select("grouped", "n", "mean", "inverse", *_away())
    summed = near.where(_distance() <= _quantile(NEAR, SIZE)).groupBy("grouped").agg(F.max("n").alias("n"), F.max("mean").alias("mean"), *_sums())
    return _estimate(summed, ["grouped"], NEAR).drop("log_det")


def _pools(points: DataFrame) -> DataFrame:
    """own, n and grouped: the group in which the vectors of each language and source are judged."""
    sizes = points.groupBy("own", "lang").agg(F.count("*").alias("n"))
    few = F.col("n") < LEAST_ROWS
    rest = F.sum(F.when(few, F.col("n"))).over(Window.partitionBy("lang"))
    language = F.to_json(F.struct("lang"), {"ignoreNullFields": "false"})
    pool = F.when(~few, F.col("own")).when(rest >= LEAST_ROWS, language).otherwise(F.lit("{}"))
    return sizes.select("own", "n", pool.alias("grouped"))


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the counts, base_failed, kept and distance of every row of `docs` (doc_id, text, lang, source).

    distance is the squared Mahalanobis distance; null for texts that failed or have no group to be compared with.
    """
    own = F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"})
    named = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    counts = counted(named, ["doc_id", "lang", "source"])
    rows = stored(counts.select("*", own.alias("own"), *(F.when(~F.col("base_failed"), v).alias(x) for x, v in zip(_X, _vector()))), "rules-counts")
    distinct = stored(rows.where(~F.col("base_failed")).select("own", "lang", *_X).distinct(), "rules-vectors")
    pools = stored(_pools(distinct), "rules-pools")
    points = stored(_with(distinct.drop("lang"), pools, "own", tuple(_X)).select("grouped", *_X), "rules-points")
    of_groups = usual(points).drop("n")
    # Every language and source of the table has a row, so that all rows find one.
    sizes = rows.groupBy("own").agg(F.count("*").alias("n"))
    lookup = stored(sizes.join(pools.drop("n"), "own", "left").join(of_groups, "grouped", "left").select("own", "n", "mean", "inverse"), "rules-usual")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    measured = _with(rows, lookup, "own", ("doc_id", "n_words")).select(*names, "inverse", *_away())
    return measured.select(*names, _distance().alias("distance")).select(
        *names, (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"), "distance"
    )
