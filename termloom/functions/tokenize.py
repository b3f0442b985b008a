"""Words of a text, as Spark array expressions.

Three modes:

* ``whitespace``   non-empty runs between ASCII whitespace (the default);
* ``java_ws``      as Java's ``split("\\s+")``: leading whitespace gives one
                   empty word, as does an empty text, and control characters
                   are trimmed off each word;
* ``single_space`` per line, split at every single space: tabs stay inside
                   words, and doubled or leading spaces and blank lines give
                   empty words.

A NULL text has no words in any mode.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators that define a word in each mode.
WHITESPACE = " \t\n\x0b\f\r"
WHITESPACE_RUN = r"[ \t\n\x0B\f\r]+"
LINE_END = r"\r\n|\n|\r"
LAST_LINE_END = r"(\r\n|\n|\r)\z"
# What is trimmed off words: U+0000 to U+0020, which in a word can only be these.
CONTROLS = "".join(map(chr, [*range(0x09), *range(0x0E, 0x20)]))
# White space with the control characters at the edges of the words on its sides.
EDGE_RUN = r"[\x00-\x08\x0E-\x1F]*[ \t\n\x0B\f\r]+[\x00-\x08\x0E-\x1F]*"

MODES = ("whitespace", "java_ws", "single_space")


def _no_words() -> Column:
    return F.array().cast("array<string>")


def _split_dropping_last_empties(text: Column, run: str, chars: str) -> Column:
    """Split, without empty strings at the end; a text of separators only has none."""
    kept = F.rtrim(text, F.lit(chars))
    return F.when((text != "") & (kept == ""), _no_words()).otherwise(F.split(kept, run))


def lines(text: Column) -> Column:
    """Lines of a text; a final line end does not open another line."""
    whole = F.split(F.regexp_replace(text, LAST_LINE_END, ""), LINE_END)
    return F.when(text == "", _no_words()).otherwise(whole)


def words(text: Column, mode: str = "whitespace", text_is_line: bool = False) -> Column:
    """ARRAY<STRING> of the words of ``text``, in order, never NULL."""
    if mode == "whitespace":
        # array_remove stays in generated code, a filter lambda would not.
        return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITESPACE_RUN), "")
    if mode == "java_ws":
        if text_is_line:
            # Only the first line of a file may begin with the empty word: Corpus.texts_for
            # gives lines as texts without it.
            raise ValueError("mode java_ws needs whole texts, not lines of files")
        # What is trimmed off goes with the white space beside it, or with the ends of the text. A word
        # of nothing else goes with the run before it, and leaves the empty word before the next run.
        # No lambda for each word and no text written anew, so all of it is generated code.
        kept = F.rtrim(text, F.lit(WHITESPACE))
        trimmed = F.split(F.btrim(kept, F.lit(CONTROLS)), EDGE_RUN)
        found = F.when((text != "") & (kept == ""), _no_words()).otherwise(trimmed)
    elif mode == "single_space":
        if text_is_line:
            found = _split_dropping_last_empties(text, " ", " ")
        else:
            found = F.flatten(
                F.transform(lines(text), lambda l: _split_dropping_last_empties(l, " ", " "))
            )
    else:
        raise ValueError(f"unknown tokenizer mode {mode!r}, expected one of {MODES}")
    return F.coalesce(found, _no_words())
