"""Inverted and forward index, with lists of bounded length."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.corpus import Corpus
from termloom.functions.counting import _bind, word_runs
from termloom.operators.document_frequency import doc_freqs
from termloom.operators.split_join import SPLIT_ROWS, join_split, power_of_two
from termloom.operators.terms import _row_size, _row_words, num_docs, term_counts, word_counts

# Entries to a list. A list with more is stored as several blocks.
BLOCK_ROWS = 100_000


def _block(entry: Column, blocks: Column) -> Column:
    """The block of an entry, by a digest of its name; 0 where there is only one."""
    return F.when(blocks > 1, F.pmod(_digest(entry), blocks)).otherwise(F.lit(0).cast("bigint"))


def _digest(entry: Column) -> Column:
    return F.conv(F.substring(F.md5(entry), 1, 8), 16, 10).cast("bigint")


def _blocks(entries: Column, block_rows: int | None) -> Column:
    """How many blocks a list of so many entries has: a power of two, and one without ``block_rows``.

    The join deals a long list into pieces by the same digest, and their number is a power of
    two as well, no greater than that of the blocks: so a block is always in one piece.
    """
    return F.lit(1).cast("bigint") if block_rows is None else power_of_two(F.ceil(entries / block_rows))


def postings(
    corpus: Corpus,
    mode: str = "whitespace",
    block_rows: int | None = BLOCK_ROWS,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``word, df, block, blocks, postings``: the documents of each word.

    ``postings`` is ARRAY<STRUCT<document, word_count, doc_size>> in document
    order. The list of a word in more than ``block_rows`` documents is dealt
    over ``blocks`` rows of at most about that length, so that no word needs its whole
    list in one task; together they are the whole list. The blocks follow from ``df``
    and ``block_rows`` alone, and ``split_rows`` only says how the work is spread. With
    ``block_rows`` None every list is whole in one row, which must have room in a task.
    """
    # The lists are made where the join has put the entries.
    pairs = join_split(
        term_counts(corpus, mode, split_rows),
        doc_freqs(corpus, mode),
        key="word",
        weight="df",
        spread=_digest(F.col("document")),
        split_rows=split_rows,
        most_pieces=_blocks(F.col("df"), block_rows),
        keep_pieces=True,
    )
    return (
        pairs.withColumn("blocks", _blocks(F.col("df"), block_rows))
        .withColumn("block", _block(F.col("document"), F.col("blocks")))
        .groupBy("word", "_piece", "df", "block", "blocks")
        .agg(
            F.sort_array(F.collect_list(F.struct("document", "word_count", "doc_size"))).alias(
                "postings"
            )
        )
        .drop("_piece")
    )


def expand_postings(index: DataFrame, corpus: Corpus) -> DataFrame:
    """Back to ``word, document, num_docs, df``, one row per posting."""
    return index.select(
        "word", "df", F.explode("postings.document").alias("document")
    ).select("word", "document", num_docs(corpus).scalar().alias("num_docs"), "df")


def _entry_blocks(corpus: Corpus, mode: str, block_rows: int) -> DataFrame:
    """The forward index of documents that are one row each, made inside the rows.

    Entries of a long list are sorted by block, and each run of them becomes a list: every
    entry is copied once, however many blocks there are.
    """
    rows = _row_words(corpus, mode).select(
        "document", _row_size().alias("doc_size"), word_runs(F.col("words")).alias("entries")
    )
    blocks = _blocks(F.size("entries"), block_rows)

    def cut(dealt: Column) -> Column:
        starts = F.array_compact(
            F.transform(
                dealt,
                lambda d, i: F.when((i == 0) | (d["block"] != F.get(dealt, i - 1)["block"]), i),
            )
        )
        return _bind(
            starts,
            lambda at: F.transform(
                at,
                lambda p, k: F.struct(
                    F.get(dealt, p)["block"].alias("block"),
                    F.transform(
                        F.slice(dealt, p + 1, F.coalesce(F.get(at, k + 1), F.size(dealt)) - p),
                        lambda d: F.struct(d["word"].alias("word"), d["word_count"].alias("word_count")),
                    ).alias("words"),
                ),
            ),
        )

    dealt = F.transform(
        "entries",
        lambda e: F.struct(
            F.pmod(_digest(e["word"]), F.col("blocks")).alias("block"), e["word"].alias("word"), e["word_count"].alias("word_count")
        ),
    )
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("block"), F.col("entries").alias("words")))
    lists = F.when(F.col("blocks") > 1, _bind(F.sort_array(dealt), cut)).otherwise(whole)
    # Documents without words have no list. explode_outer keeps the words from being split
    # again in a filter for empty arrays.
    return (
        rows.withColumn("blocks", blocks)
        .select(
            "document",
            "doc_size",
            "blocks",
            F.explode_outer(F.when(F.size("entries") > 0, lists)).alias("of"),
        )
        .where(F.col("of").isNotNull())
        .select("document", "doc_size", F.col("of.block").alias("block"), "blocks", F.col("of.words").alias("words"))
    )


def forward_index(
    corpus: Corpus,
    mode: str = "whitespace",
    block_rows: int = BLOCK_ROWS,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``document, doc_size, block, blocks, words``: the words of each document.

    ``words`` is ARRAY<STRUCT<word, word_count>> in word order. The distinct words
    of a document are dealt over so many blocks, a power of two, that each has about
    ``block_rows`` at most, by a digest of the word; a block that gets no word has no row. Documents of one row
    and of many have the same index. Documents without words have none.
    """
    if corpus.one_row_per_document:
        return _entry_blocks(corpus, mode, block_rows)
    counts = word_counts(corpus, mode)
    # Testing the count keeps it in the aggregation, whose shuffle then serves both; and testing the
    # size keeps that where the join asks for the numbers of words only, so that these are counted once.
    totals = (
        counts.where(F.col("word_count") >= 1)
        .groupBy("document")
        .agg(F.sum("word_count").alias("doc_size"), F.count("*").alias("distinct"))
        .where(F.col("doc_size") >= 1)
    )
    blocks = _blocks(F.col("distinct"), block_rows)
    # The lists are made where the join has put the entries.
    return (
        join_split(
            counts,
            totals,
            key="document",
            weight="distinct",
            spread=_digest(F.col("word")),
            split_rows=split_rows,
            most_pieces=blocks,
            keep_pieces=True,
        )
        .withColumn("blocks", blocks)
        .withColumn("block", _block(F.col("word"), F.col("blocks")))
        .groupBy("document", "_piece", "doc_size", "block", "blocks")
        .agg(F.sort_array(F.collect_list(F.struct("word", "word_count"))).alias("words"))
        .select("document", "doc_size", "block", "blocks", "words")
    )
