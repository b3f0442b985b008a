"""The registered queries of this subpackage, one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import alignment, bpe, decontamination, embeddings, jaccard, pii, quality, quality_rules, secret_scan, suffix_dedup, token_counts, toxicity, whitening
from termloom.llm.common import documents
from termloom.llm.oracles import ORACLES  # noqa: F401


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def labels_of(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(column).alias("label"))


def _scored(scores: DataFrame, held_out: Column) -> DataFrame:
    return scores.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = labels_of(spark, sf_dir, "quality").where(remainder(3) != 1)
    return _scored(quality.quality_scores(documents(spark, sf_dir), labels), remainder(3) == 1)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(documents(spark, sf_dir), ["doc_id"])
    return found.select(
        "doc_id",
        *(secret_scan.counted(F.col("known"), kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(pii.written(F.col("known")), 256).alias("base_sha256"),
        pii.written(F.col("found")).alias("spans"),
    )


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(secret_scan.counted(F.col("known"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secret_scan.written(F.col("known")), 256).alias("base_sha256"),
        secret_scan.written(F.col("found")).alias("spans"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = labels_of(spark, sf_dir, "toxic").where(remainder(5) != 0)
    return _scored(toxicity.toxicity_scores(documents(spark, sf_dir), labels), remainder(5) == 0)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(documents(spark, sf_dir), benchmark)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), ["doc_id"])


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), ["doc_id"])


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), ["doc_id"])


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_pii,
        op3_embeddings,
        op4_secrets,
        op5_toxicity,
        op6_decontamination,
        op7_suffix_dedup,
        op8_jaccard,
        op9_bpe,
        op10_token_counts,
        op11_alignment,
        op12_whitening,
        op13_quality_rules,
    )
}

