"""Secrets in texts: three known forms, and strings of high entropy.

All of it is column expressions. Matches of a pattern and the gaps between them give
the places of the matches. Strings of the characters of a class, hexadecimal or
base64, are candidates; a window slides along a candidate, the counts of its
characters change by the one that enters and the one that leaves, and so does the
sum from which its Shannon entropy follows. A candidate with a window of enough
entropy is a span, unless the allow-list knows all its pieces, between marks, as something
harmless. A candidate shorter than the window is a window of its own length, for which
the least entropy is less in proportion to the largest possible; it must have both a
letter and a digit.

Places are code points, ends exclusive. A null or empty text has no spans. Every row
of the input gives one row, repeated ones too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in the order in which they are listed; fixed values.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 24
SHORTEST = 16  # characters of a candidate
# Of each class: its pattern, its characters, and the entropy in bits that a window must have.
CLASSES = {
    "entropy_hex": ("[0-9A-Fa-f]{%d,}" % SHORTEST, "0123456789abcdefABCDEF", 3.0),
    "entropy_base64": (
        "[A-Za-z0-9+/_=-]{%d,}" % SHORTEST,
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        3.9,
    ),
}
MARKS = "[-_/+=]+"
# Harmless pieces: words, numbers, and strings that only show a form.
ALLOWED = r"^([A-Za-z]?[a-z]*|[A-Z]*|[0-9]*)$|(?i:example|placeholder|changeme|0123456789abcdef|abcdefghijklmnop)"
BLOCK = 256  # matches whose places are summed up together
SPAN = "array<struct<start:int,rank:int,end:int,hit:string>>"


def _places(text: Column, pattern: str, rank: int) -> Column:
    """Start, rank, end and string of each match, in order.

    Blocks of matches are summed up before they are put together, as appending to
    an array copies it.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    pieces = F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("hit"), F.length(g).alias("gap")))
    empty = F.from_json(F.lit("[]"), SPAN)

    def add(done: Column, piece: Column) -> Column:
        start = done["at"] + piece["gap"]
        end = start + F.length(piece["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), piece["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def add_block(pieces: Column, done: Column, block: Column) -> Column:
        part = F.slice(pieces, block * BLOCK + 1, F.lit(BLOCK))
        made = F.aggregate(part, F.struct(done["at"].alias("at"), empty.alias("spans")), add)
        return F.transform(
            F.array(made),
            lambda m: F.struct(m["at"].alias("at"), F.concat(done["spans"], m["spans"]).alias("spans")),
        )[0]

    def of(pieces: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int"))
        start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
        return F.aggregate(blocks, start, lambda done, b: add_block(pieces, done, b))["spans"]

    # Bound to a name once, so that the text is not matched anew for each use.
    return F.transform(F.array(pieces), lambda p: F.when(F.size(p) > 0, of(p)).otherwise(empty))[0]


def _greatest_entropy(string: Column, alphabet: str, window: Column) -> Column:
    """The largest entropy of a window of the string, from counts that are kept up to date."""
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(alphabet), c))
    codes = F.filter(codes, lambda c: c > 0)

    def weight(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))

    def slide(codes: Column, done: Column, i: Column) -> Column:
        enters = F.get(codes, i)
        leaves = F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(0))
        more, less = F.get(done["counts"], enters), F.get(done["counts"], leaves)
        same = enters == leaves
        total = F.when(same, done["total"]).otherwise(
            done["total"]
            + weight(more + 1)
            - weight(more)
            + F.when(leaves > 0, weight(less - 1) - weight(less)).otherwise(F.lit(0.0))
        )
        counts = F.transform(
            done["counts"], lambda c, j: c + (j == enters).cast("int") - (j == leaves).cast("int")
        )
        entropy = F.log2(window) - total / window
        best = F.when(i >= window - 1, F.greatest(done["best"], entropy)).otherwise(done["best"])
        return F.struct(counts.alias("counts"), total.alias("total"), best.alias("best"))

    def of(codes: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best")
        )
        places = F.sequence(F.lit(0), F.size(codes) - 1)
        return F.aggregate(places, start, lambda done, i: slide(codes, done, i))["best"]

    return F.transform(F.array(codes), of)[0]


def _known(text: Column) -> Column:
    """The spans of the three known forms."""
    none = F.from_json(F.lit("[]"), SPAN)
    assign = F.filter(_places(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= 8)
    access = F.filter(_places(text, ACCESS, 1), lambda s: F.length(s["hit"]) >= 16)
    # Runs are matched whole, so those that are too short need not be matched at all.
    long_hex = _places(text, "[0-9a-f]{32,}", 2)
    return F.concat(
        F.when(text.contains(":") | text.contains("="), assign).otherwise(none),
        F.when(text.contains("AKIA"), access).otherwise(none),
        F.when(text.rlike("[0-9a-f]{32}"), long_hex).otherwise(none),
    )


def _candidates(text: Column, kind: str) -> Column:
    """Candidates that no allow-list entry explains and that have a window of high entropy."""
    pattern, alphabet, least = CLASSES[kind]

    def secret(hit: Column) -> Column:
        window = F.least(F.lit(WINDOW), F.length(hit))
        harmless = F.forall(F.split(hit, MARKS, -1), lambda piece: piece.rlike(ALLOWED))
        mixed = (F.length(hit) >= WINDOW) | (hit.rlike("[A-Za-z]") & hit.rlike("[0-9]"))
        enough = F.log2(window) * (least / math.log2(WINDOW))
        return ~harmless & mixed & (_greatest_entropy(hit, alphabet, window) >= enough)

    spans = F.filter(_places(text, pattern, KINDS.index(kind)), lambda s: secret(s["hit"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.from_json(F.lit("[]"), SPAN))


def _named(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.transform(
        spans,
        lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit")),
    )


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with `known` and `found`: kind, start, end and string of spans, by start.

    These two take the place of columns of `docs` that have their names.

    `known` are the spans of the three forms alone, `found` all spans.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    spans = docs.withColumn("__known", _known(whole)).withColumn(
        "__more", F.concat(*(_candidates(whole, kind) for kind in CLASSES))
    )
    return spans.select(
        *(F.col(c) for c in docs.columns if c not in ("known", "found")),
        _named(F.array_sort("__known")).alias("known"),
        _named(F.array_sort(F.concat("__known", "__more"))).alias("found"),
    )


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
