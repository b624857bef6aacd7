"""The registered queries of the operators: thin digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceflow.llm import (
    byte_bpe,
    embedding_dedup,
    license_scan,
    lm_score,
    merkle,
    minhash_dedup,
    oracle,
    packing,
    quality_classifier,
    quality_rules,
    resampling,
    sharding,
    suffix_dedup,
    toxicity,
)
from priceflow.llm.common import documents


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("spans")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence",
                         F.size("passages").cast("long").alias("n_passages"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir), 85).drop("text_hash", "stays")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(documents(spark, sf_dir))
    rows = quality_rules.apply_policy(rows, "base-1", "base_kept")
    rows = quality_rules.apply_policy(rows, "strict-1")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(documents(spark, sf_dir))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = quality_classifier.score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = resampling.resample(documents(spark, sf_dir), target)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.verify(merkle.manifest(documents(spark, sf_dir)))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_toxicity": op2_toxicity,
        "op3_minhash_dedup": op3_minhash_dedup,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_sharding": op5_sharding,
        "op6_packing": op6_packing,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_lm_score": op10_lm_score,
        "op11_quality_classifier": op11_quality_classifier,
        "op12_resampling": op12_resampling,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return oracle.oracle_sql()
