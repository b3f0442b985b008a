import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom.functions.counting import word_runs
from termloom.functions.tokenize import MODES, lines, words

NBSP = "a b"
# text, then its words in the modes whitespace, java_ws and single_space
CASES = [
    ("", [], [""], []),
    ("   ", [], [], []),
    ("  a b  ", ["a", "b"], ["", "a", "b"], ["", "", "a", "b"]),
    ("a  b", ["a", "b"], ["a", "b"], ["a", "", "b"]),
    ("a\tb c", ["a", "b", "c"], ["a", "b", "c"], ["a\tb", "c"]),
    ("a\n\nb\n", ["a", "b"], ["a", "b"], ["a", "", "b"]),
    ("a\r\nb", ["a", "b"], ["a", "b"], ["a", "b"]),
    ("\x01a \x01", ["\x01a", "\x01"], ["a", ""], ["\x01a", "\x01"]),
    ("a\x0bb", ["a", "b"], ["a", "b"], ["a\x0bb"]),
    (NBSP, [NBSP], [NBSP], [NBSP]),
    ("\n", [], [], [""]),
    ("a\rb\n", ["a", "b"], ["a", "b"], ["a", "b"]),
    (" \t\n\x0b\f\r", [], [], ["", "\t", "\x0b\f"]),
    ("x\x00 \x00", ["x\x00", "\x00"], ["x", ""], ["x\x00", "\x00"]),
    ("\u0085é ß\U0001f600", ["\u0085é", "ß\U0001f600"], ["\u0085é", "ß\U0001f600"],
     ["\u0085é", "ß\U0001f600"]),
    (None, [], [], []),
]


@pytest.mark.parametrize("column,mode", list(enumerate(MODES, 1)))
def test_words(spark, column, mode):
    texts = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, text string")
    rows = texts.select("id", words(F.col("text"), mode).alias("w")).collect()
    assert {r.id: r.w for r in rows} == {i: c[column] for i, c in enumerate(CASES)}


def test_a_row_that_is_a_line_may_be_blank(spark):
    texts = spark.createDataFrame([("",), ("a  b",), (None,)], "text string")
    found = texts.select(words(F.col("text"), "single_space", text_is_line=True)).collect()
    assert [r[0] for r in found] == [[""], ["a", "", "b"], []]


def test_lines(spark):
    texts = spark.createDataFrame([("a\nb\n",), ("a\r\n\rb",), ("\n\n",), ("",)], "text string")
    found = [r[0] for r in texts.select(lines(F.col("text"))).collect()]
    assert found == [["a", "b"], ["a", "", "b"], ["", ""], []]


def test_unknown_mode():
    with pytest.raises(ValueError, match="unknown tokenizer mode"):
        words(None, "letters")


def test_word_runs(spark):
    inputs = [[], ["a"], ["b", "a", "b"], ["", "", "x"], ["A", "a", "a"], ["é", "z", "é", "é"]]
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(inputs)], "id int, w array<string>")
    found = {
        r.id: [(e.word, e.word_count) for e in r.runs]
        for r in frame.select("id", word_runs(F.col("w")).alias("runs")).collect()
    }
    assert found == {
        0: [],
        1: [("a", 1)],
        2: [("a", 1), ("b", 2)],
        3: [("", 2), ("x", 1)],
        4: [("A", 1), ("a", 2)],
        5: [("z", 1), ("é", 3)],
    }


def _split(text, run):
    """As Java splits: no empty words at the end, but one for an empty text."""
    if text == "":
        return [""]
    parts = re.split(run, text)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _expected(text, mode):
    if mode == "whitespace":
        return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]
    if mode == "java_ws":
        control = "".join(map(chr, range(33)))
        return [w.strip(control) for w in _split(text, r"[ \t\n\x0b\f\r]+")]
    ends = re.split(r"\r\n|\n|\r", text)
    if ends[-1] == "":
        ends.pop()
    return [w for line in ends for w in _split(line, " ")]


@pytest.mark.parametrize("mode", MODES)
def test_random_texts(spark, mode):
    rng = random.Random(7)
    alphabet = "ab,@=é\U0001f600      \t\n\n\r\x0b\f\x01\x1f\x7f\u0085\u00a0\u2028"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(15))) for _ in range(2000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = frame.select("id", words(F.col("text"), mode).alias("w")).select(
        "id", "w", word_runs(F.col("w")).alias("runs")
    )
    for r in found.collect():
        expected = _expected(texts[r.id], mode)
        assert r.w == expected, repr(texts[r.id])
        assert {e.word: e.word_count for e in r.runs} == Counter(expected)
        assert len(r.runs) == len(set(expected))


def test_java_words_come_from_one_split(spark):
    """No text is written anew for them, and they are those that splitting and trimming each one gives."""
    import random
    import re

    from pyspark.sql import functions as F

    from termloom.functions.tokenize import WHITESPACE, words

    draw = random.Random(7)
    texts = ["".join(draw.choices("ab \x01\x1f\x00\t\n\r", k=draw.randrange(14))) for _ in range(4_000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = frame.select("text", words(F.col("text"), "java_ws").alias("words"))
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString()
    for text, got in found.collect():
        kept = text.rstrip(WHITESPACE)
        parts = [] if text and not kept else re.split(f"[{WHITESPACE}]+", kept)
        assert got == [p.strip("".join(map(chr, range(33)))) for p in parts], repr(text)
