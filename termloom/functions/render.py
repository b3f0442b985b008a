"""Text forms of keys, rationals, weights and lists, for reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the reports.
KEY_SEPARATOR = "@"
RATIO_SEPARATOR = "/"
FIELD_SEPARATOR = "\t"
FIXED_FORMAT = "%.16f"


def key(first: Column, second: Column) -> Column:
    """``first@second``. May be ambiguous, so it is for output only."""
    return F.concat(first, F.lit(KEY_SEPARATOR), second)


def ratio(over: Column, under: Column) -> Column:
    return F.concat(over.cast("string"), F.lit(RATIO_SEPARATOR), under.cast("string"))


def shortest(value: Column) -> Column:
    """The shortest decimal that reads back as the same double."""
    return value.cast("string")


def fixed(value: Column, pattern: str = FIXED_FORMAT) -> Column:
    return F.format_string(pattern, value)


def _scaled(value: Column, digits: int) -> tuple[Column, Column]:
    """``value`` times a power of ten, and if its nearest whole number is beyond doubt.

    Below 2**40 the product is off by less than 0.0002, so what lies further than 0.001 from
    the middle of two whole numbers is rounded as the exact decimal is.
    """
    scaled = value * F.lit(10.0**digits)
    middle = F.abs(scaled - F.floor(scaled) - F.lit(0.5))
    return scaled, (scaled >= 0) & (scaled < F.lit(2.0**40)) & (middle > F.lit(0.001))


def rounded(value: Column, digits: int) -> Column:
    """``round(value, digits)``, without decimal arithmetic where the nearest number is plain.

    Both numbers of the division are doubles without error, so it gives the double that is
    nearest to the decimal.
    """
    scaled, plain = _scaled(value, digits)
    return F.when(plain, F.rint(scaled) / F.lit(10.0**digits)).otherwise(F.round(value, digits))


def places(value: Column, digits: int) -> Column:
    """``value`` with so many digits after the point, 1 to 18, as :func:`fixed` has it."""
    scaled, plain = _scaled(value, digits)
    whole = F.rint(scaled).cast("bigint")
    unit = F.lit(10**digits).cast("bigint")
    after = F.lpad((whole % unit).cast("string"), digits, "0")
    shown = F.concat(F.floor(whole / unit).cast("string"), F.lit("."), after)
    return F.when(plain, shown).otherwise(fixed(value, f"%.{digits}f"))


def line(key_column: Column, value: Column) -> Column:
    return F.concat(key_column, F.lit(FIELD_SEPARATOR), value)


def postings_text(postings: Column) -> Column:
    """``document:word_count/doc_size`` joined by commas."""
    return F.array_join(
        F.transform(
            postings,
            lambda p: F.concat(
                p["document"], F.lit(":"), ratio(p["word_count"], p["doc_size"])
            ),
        ),
        ",",
    )


def words_text(entries: Column) -> Column:
    """``word=word_count`` joined by spaces."""
    return F.array_join(
        F.transform(
            entries,
            lambda e: F.concat(e["word"], F.lit("="), e["word_count"].cast("string")),
        ),
        " ",
    )
