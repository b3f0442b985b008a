"""Term weights of a whole corpus."""

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.corpus import Corpus
from termloom.functions import weights
from termloom.operators.document_frequency import _with_doc_freqs, doc_freqs, with_doc_freqs
from termloom.operators.split_join import SPLIT_ROWS
from termloom.operators.terms import num_docs, term_counts

# Largest vocabulary that is broadcast, in words and in bytes of words.
BROADCAST_WORDS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def tf(corpus: Corpus, mode: str = "whitespace", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``document, word, word_count, doc_size, tf``"""
    return term_counts(corpus, mode, split_rows).withColumn(
        "tf", weights.tf(F.col("word_count"), F.col("doc_size"))
    )


def idf(corpus: Corpus, mode: str = "whitespace") -> DataFrame:
    """``word, num_docs, df, idf``"""
    return (
        doc_freqs(corpus, mode)
        .select("word", num_docs(corpus, mode).scalar().alias("num_docs"), "df")
        .withColumn("idf", weights.idf(F.col("num_docs"), F.col("df")))
    )


def _weigh(pairs: DataFrame, corpus: Corpus, mode: str) -> DataFrame:
    """Append num_docs, a scalar subquery of one value, and the three weights."""
    counts = pairs.select(
        "document",
        "word",
        "word_count",
        "doc_size",
        num_docs(corpus, mode).scalar().alias("num_docs"),
        "df",
    )
    word_count, doc_size = F.col("word_count"), F.col("doc_size")
    total, df = F.col("num_docs"), F.col("df")
    return counts.select(
        "*",
        weights.tf(word_count, doc_size).alias("tf"),
        weights.idf(total, df).alias("idf"),
        weights.tfidf(word_count, doc_size, total, df).alias("tfidf"),
    )


def tfidf(
    corpus: Corpus,
    mode: str = "whitespace",
    split_rows: int = SPLIT_ROWS,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """The weight of every word in every document:
    ``document, word, word_count, doc_size, num_docs, df, tf, idf, tfidf``.

    ``frequencies`` may give the corpus's document frequencies, if stored."""
    return _weigh(with_doc_freqs(corpus, mode, split_rows, frequencies), corpus, mode)


def _gated(rows: DataFrame, number: Column, gate: DataFrame) -> DataFrame:
    """All of ``rows``, if ``gate`` has a row, else none; ``number`` is whole and never NULL."""
    keyed = rows.withColumn("_gate", F.pmod(number, F.lit(1)).cast("int"))
    return keyed.join(F.broadcast(gate), "_gate", "left_semi").drop("_gate")


def tfidf_broadcast(
    corpus: Corpus,
    mode: str = "whitespace",
    max_words: int = BROADCAST_WORDS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """As :func:`tfidf`, giving every task the whole vocabulary if it is small.

    The plan has both joins, each behind a gate: a relation of one row or none, from the
    number and the bytes of the words as they are counted. Adaptive execution sends the
    gates first and drops what is behind the empty one, before any text is read for it.
    Nothing runs, and nothing is stored, when the plan is built. Where the vocabulary
    is small no shuffle but its own is left, if a document is one row.
    """
    frequencies = doc_freqs(corpus, mode)
    size = frequencies.agg(
        F.count("*").alias("words"),
        F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes"),
    )
    small = (F.col("words") <= max_words) & (F.col("bytes") <= max_bytes)
    # Keys of which the optimizer does not know that they are 0 in every row.
    key = F.pmod(F.col("words"), F.lit(1)).cast("int").alias("_gate")

    def behind(condition: Column) -> Corpus:
        gate = size.where(condition).select(key)
        leading = None if corpus.leading is None else _gated(corpus.leading, F.length("document"), gate)
        return replace(corpus, rows=_gated(corpus.texts, F.length("document"), gate), leading=leading)

    gate = size.where(small).select(key)
    # By the number that the aggregation makes: a gate for the words would be moved below it, and
    # the words would be counted once more.
    vocabulary = F.broadcast(_gated(frequencies, F.col("df"), gate))
    sent = term_counts(behind(small), mode).join(vocabulary, "word")
    shuffled = with_doc_freqs(behind(~small), mode, frequencies=frequencies)
    columns = "document", "word", "word_count", "doc_size", "df"
    return _weigh(sent.select(*columns).unionByName(shuffled.select(*columns)), corpus, mode)


def tfidf_union(
    corpus: Corpus, mode: str = "whitespace", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """``document, word, tfidf`` from two relations laid over each other.

    One has the tf of each pair, the other its idf. Their union is grouped by
    pair, which brings exactly one of each together. Both are taken from the pairs as the
    join with the totals leaves them, dealt by word, and so are grouped where they lie.
    """
    totals = _with_doc_freqs(corpus, mode, split_rows)
    key = "word", "_piece", "document"
    unknown = F.lit(None).cast("double")
    # Each side asks for the other's numbers as well: both need the same rows of the join.
    there = (F.col("word_count") >= 1) & (F.col("doc_size") >= 1) & (F.col("df") >= 1)
    value_tf = weights.tf(F.col("word_count"), F.col("doc_size"))
    value_idf = weights.idf(num_docs(corpus, mode).scalar(), F.col("df"))
    with_tf = totals.select(*key, F.when(there, value_tf).alias("tf"), unknown.alias("idf"))
    with_idf = totals.select(*key, unknown.alias("tf"), F.when(there, value_idf).alias("idf"))
    return (
        with_tf.unionByName(with_idf)
        .groupBy(*key)
        .agg((F.max("tf") * F.max("idf")).alias("tfidf"))
        .select("document", "word", "tfidf")
    )
