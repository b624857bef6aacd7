"""The corpus pipeline: filter, de-duplicate and pack the documents table.

Each stage reads what its predecessor kept, as a table in the cluster's shared
folder, and all but the last return the columns of documents.  Rows with a null
id or text, repeated rows and extra columns are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from priceflow.llm import minhash_dedup, packing, quality_rules, suffix_dedup, toxicity
from priceflow.llm.common import documents, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the strict quality policy."""
    return quality_rules.filter_documents(docs, "strict-1")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more."""
    return minhash_dedup.deduplicate(docs, 80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that start anywhere else too."""
    return suffix_dedup.clean_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]
ORACLE_SQL = None  # learned scores, MinHash and packing are tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
