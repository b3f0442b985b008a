"""The vocabulary, and in how many documents each word occurs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.corpus import Corpus
from termloom.operators.split_join import SPLIT_ROWS, join_split
from termloom.operators.terms import _row_words, term_counts, word_counts


def _words_of_documents(corpus: Corpus, mode: str) -> DataFrame:
    """``word``, once for every document that has it."""
    if corpus.one_row_per_document:
        return (
            _row_words(corpus, mode)
            .select(F.explode_outer(F.array_distinct("words")).alias("word"))
            .where(F.col("word").isNotNull())
        )
    # Testing the count keeps it in the aggregation, which then is the one that
    # word_counts makes: its shuffle is reused and not made again for this.
    return word_counts(corpus, mode).where(F.col("word_count") >= 1).select("word")


def vocabulary(corpus: Corpus, mode: str = "whitespace") -> DataFrame:
    """``word``: the distinct words of the corpus."""
    return (
        _row_words(corpus, mode)
        .select(F.explode_outer(F.array_distinct("words")).alias("word"))
        .where(F.col("word").isNotNull())
        .distinct()
    )


def doc_freqs(corpus: Corpus, mode: str = "whitespace") -> DataFrame:
    """``word, df``. Each task counts what it has before the shuffle, so a word
    that occurs everywhere is one row per task."""
    return _words_of_documents(corpus, mode).groupBy("word").agg(F.count("*").alias("df"))


def with_doc_freqs(
    corpus: Corpus,
    mode: str = "whitespace",
    split_rows: int = SPLIT_ROWS,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """``document, word, word_count, doc_size, df``: each pair with its word's total.

    ``frequencies`` is the corpus's :func:`doc_freqs` where it is stored already;
    the texts are then read once.

    A window over the word would read the corpus once instead of twice, but
    would put all documents of a common word into one task. Here the totals
    come from a pre-aggregated pass, and the join splits common words.
    """
    return _with_doc_freqs(corpus, mode, split_rows, frequencies).select(
        "document", "word", "word_count", "doc_size", "df"
    )


def _with_doc_freqs(
    corpus: Corpus, mode: str, split_rows: int, frequencies: DataFrame | None = None
) -> DataFrame:
    """As :func:`with_doc_freqs`, with the columns of :func:`join_split` by which the rows lie."""
    return join_split(
        term_counts(corpus, mode, split_rows),
        doc_freqs(corpus, mode) if frequencies is None else frequencies,
        key="word",
        weight="df",
        spread="document",
        split_rows=split_rows,
        keep_pieces=True,
    )
