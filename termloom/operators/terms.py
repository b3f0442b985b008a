"""Words of documents and how often they occur."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.corpus import Corpus
from termloom.functions.counting import run_starts
from termloom.functions.tokenize import words
from termloom.operators.split_join import SPLIT_ROWS, join_split


def _row_words(corpus: Corpus, mode: str) -> DataFrame:
    texts, are_lines = corpus.texts_for(mode)
    return texts.select("document", words(F.col("text"), mode, are_lines).alias("words"))


def _row_size() -> Column:
    return F.size("words").cast("bigint")


def _row_counts(corpus: Corpus, mode: str) -> DataFrame:
    """``document, row_size, word, word_count``, counted inside each row: no shuffle.

    The words of a row are sorted; where each run of equal ones begins is a column of its own,
    as an operator with a lambda in it has no generated code, and rows are made only after that.
    posexplode_outer with a filter, because before a plain posexplode the optimizer
    repeats the tokenizing in a filter for empty arrays.
    """
    ordered, starts, start, at = F.col("ordered"), F.col("starts"), F.col("start"), F.col("at")
    end = F.coalesce(F.get(starts, at + 1), F.size(ordered))
    return (
        _row_words(corpus, mode)
        .select("document", F.sort_array("words").alias("ordered"))
        .select("document", "ordered", run_starts(ordered).alias("starts"))
        .select("document", "ordered", "starts", F.posexplode_outer("starts").alias("at", "start"))
        .where(F.col("start").isNotNull())
        .select(
            "document",
            F.size(ordered).cast("bigint").alias("row_size"),
            F.get(ordered, start).alias("word"),
            (end - start).cast("bigint").alias("word_count"),
        )
    )


def num_docs(corpus: Corpus, mode: str = "whitespace") -> DataFrame:
    """One row: the documents of the corpus, those without words included.

    Names that are listed anyway spare reading the texts. Documents of many rows
    are counted after their sizes of this mode are summed, whose shuffle is there
    already wherever the sizes are used.
    """
    if corpus.names is not None:
        return corpus.names.agg(F.count_distinct("document").alias("num_docs"))
    if corpus.one_row_per_document:
        return corpus.rows.agg(F.count("*").alias("num_docs"))
    # Testing the size keeps it in the aggregation, so that it is the one of doc_sizes.
    return doc_sizes(corpus, mode).where("doc_size >= 0").agg(F.count("*").alias("num_docs"))


def tokens(corpus: Corpus, mode: str = "whitespace", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row per word occurrence: ``document, doc_size, word``.

    The size is known in the row where that is the whole document, else it is joined.
    """
    rows = _row_words(corpus, mode)
    if corpus.one_row_per_document:
        found = rows.select("document", _row_size().alias("doc_size"), F.explode_outer("words").alias("word"))
        return found.where(F.col("word").isNotNull())
    found = rows.select("document", F.posexplode_outer("words").alias("_place", "word")).where(F.col("word").isNotNull())
    return join_split(
        found, doc_sizes(corpus, mode), key="document", weight="doc_size", spread=("word", "_place"), split_rows=split_rows
    ).select("document", "doc_size", "word")


def doc_sizes(corpus: Corpus, mode: str = "whitespace") -> DataFrame:
    """``document, doc_size``; 0 for documents without words."""
    sizes = _row_words(corpus, mode).select("document", _row_size().alias("doc_size"))
    if corpus.one_row_per_document:
        return sizes
    return sizes.groupBy("document").agg(F.sum("doc_size").alias("doc_size"))


def word_counts(corpus: Corpus, mode: str = "whitespace") -> DataFrame:
    """``document, word, word_count``, one row per distinct word of a document."""
    counts = _row_counts(corpus, mode).drop("row_size")
    if corpus.one_row_per_document:
        return counts
    return counts.groupBy("document", "word").agg(F.sum("word_count").alias("word_count"))


def word_totals(corpus: Corpus, mode: str = "whitespace") -> DataFrame:
    """``word, total``: how often each word occurs in the corpus.

    The words of a row are counted as they come, whichever document has them: no text is
    sorted, and documents of many rows need no merging. No word of ``whitespace`` goes over
    a line end, so there a row is split line by line, and only one line's words are listed
    at a time.
    """
    if mode == "whitespace":
        cut = corpus.texts.select("document", F.explode_outer(F.split("text", "\n")).alias("text"))
        corpus = Corpus(cut)
    found = _row_words(corpus, mode).select(F.explode_outer("words").alias("word")).where(F.col("word").isNotNull())
    return found.groupBy("word").agg(F.count("*").alias("total"))


def term_counts(
    corpus: Corpus, mode: str = "whitespace", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """``document, word, word_count, doc_size``.

    Where a document is several rows, its size is summed from the rows and then
    given to each of its words. The size is also the weight of the document: it
    has no more distinct words than that.
    """
    if corpus.one_row_per_document:
        return _row_counts(corpus, mode).select(
            "document", "word", "word_count", F.col("row_size").alias("doc_size")
        )
    return join_split(
        word_counts(corpus, mode),
        doc_sizes(corpus, mode),
        key="document",
        weight="doc_size",
        spread="word",
        split_rows=split_rows,
    ).select("document", "word", "word_count", "doc_size")
