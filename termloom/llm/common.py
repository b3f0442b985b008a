"""What several operators share: reading texts in bounded batches, stored relations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import automaton
from termloom.session import release_shuffles, scratch, scratch_path

# Texts handed to Python at once: so many, and about so many characters.
BATCH_ROWS = 2_000
BATCH_CHARS = 4_000_000
# What bounds the rows that a JVM gathers before it sends them to Python, in bytes.
SENT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(relation: DataFrame, name: str) -> DataFrame:
    """Write a relation to the shared folder and read it back.

    It is computed once, has no lineage to recompute, and outlives executors. It goes with its
    owner: the `scratch` around the call, or the application.
    """
    spark = relation.sparkSession
    path = scratch_path(spark, name)
    relation.write.parquet(path)
    return spark.read.schema(relation.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Let a session that says nothing about it gather 4 MB of rows at a time for Python.

    Spark's own default is 64 MB and 10,000 rows, for which each task takes up to three times as much
    beside the heap while its buffers grow, and its Python worker once more.
    """
    if spark.conf.get(SENT_BYTES, None) is None:
        spark.conf.set(SENT_BYTES, "4m")


def settled(spark: SparkSession, made: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `made` returns, stored; all that it stored or shuffled to get there goes."""
    path = scratch_path(spark, name)
    with scratch(spark):
        relation = made()
        relation.write.parquet(path)
        schema = relation.schema
    del relation
    release_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def slices(texts: list[str | None]) -> Iterator[slice]:
    """Cut a list of texts into runs of at most BATCH_CHARS characters, one text at least."""
    return _runs([len(text or "") for text in texts])


def _runs(sizes: list[int]) -> Iterator[slice]:
    start = chars = 0
    for i, size in enumerate(sizes):
        if i > start and (chars + size > BATCH_CHARS or i - start >= BATCH_ROWS):
            yield slice(start, i)
            start, chars = i, 0
        chars += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def schema_of(docs: DataFrame, columns: list[str], more: dict[str, str]) -> str:
    kinds = dict(docs.dtypes)
    return ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), *(f"`{n}` {kind}" for n, kind in more.items())])


def unused(columns: list[str], name: str) -> str:
    """`name`, lengthened until no column has it, whatever the case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def map_texts(
    docs: DataFrame,
    columns: list[str],
    more: dict[str, str],
    work: Callable[[list[str]], dict[str, list]],
    text: str = "text",
    keeps: str | None = None,
) -> DataFrame:
    """Apply `work` to the texts; its columns follow `columns` of the same row.

    `more` has the types of those columns. A null text is an empty one. Other columns
    of the input never reach Python. `keeps` is the key by which `work` has something
    loaded (automaton.loaded); what other work has loaded in the process goes.
    """
    bound_batches(docs.sparkSession)
    sent = docs.select(*(F.col(c) for c in columns), F.coalesce(F.col(text), F.lit("")).alias(unused(columns, "text")))
    names = list(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton.release(keeps)
        for batch in batches:
            texts = batch.column(len(columns))
            # A batch may be large: only a run of its texts is made of Python's strings at a time.
            for part in _runs(pc.utf8_length(texts).to_pylist()):
                made = work(texts.slice(part.start, part.stop - part.start).to_pylist())
                kept = [batch.column(i).slice(part.start, part.stop - part.start) for i in range(len(columns))]
                arrays = kept + [made[n] if isinstance(made[n], pa.Array) else pa.array(made[n]) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, names=columns + names)
        # A worker outlives its task and may stay idle beside others.
        automaton.give_back()

    return sent.mapInArrow(run, schema_of(docs, columns, more))
