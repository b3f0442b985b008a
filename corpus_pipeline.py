"""From raw documents to token ids: five stages, each a table that the next one reads.

A stage takes (spark, docs, sf_dir) and works on all rows of `docs`, which has the
columns of `documents`; all but the last return those columns.

1. quality: texts that the quality classifier scores below 0.5 go.
2. near_duplicates: of each group of documents with like word shingles, that with the
   smallest doc_id stays.
3. decontamination: documents that hold a passage of the benchmark go.
4. pii: personal data is replaced by its kind in brackets; n_chars follows the text.
5. bpe: the ids of the tokens of each text, and the digests of ids and decoded text.

Rows with a null doc_id cannot be linked or named, so no stage removes them but the
first. Null texts are empty ones, and empty strings after the fourth stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import bpe, decontamination, jaccard, pii, quality
from termloom.llm.common import documents, stored
from termloom.llm.queries import labels_of, remainder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, labels_of(spark, sf_dir, "quality").where(remainder(3) != 1))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = jaccard.jaccard_join(docs).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole = docs.select(F.struct(*docs.columns).alias("of"), "text")
    clean = pii.redacted(whole, ["of"])
    new = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("bigint")}
    return clean.select(*(new[c].alias(c) if c in new else F.col(f"of.`{c}`").alias(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, ["doc_id"], keep_ids=True)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact),
    ("bpe", encode),
]

# Scores, the weights of the field and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
