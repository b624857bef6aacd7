"""Row policy, duplicates and limits."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.session import shared_path

DEDUP_KEYS = ("site", "name", "price", "total_unit_quantity", "unit_type", "category", "sub_category",
              "result_date", "result_time")


def row_policy_summary(rows: DataFrame) -> DataFrame:
    """How many cards each site kept, kept partially, or rejected, and why."""
    return rows.groupBy("site", "status", "reason").agg(F.count(F.lit(1)).alias("cards"))


def missing_field_filter(rows: DataFrame, fields: Sequence[str] = ("name", "price")) -> DataFrame:
    """keep rows that have every one of the fields."""
    cond = F.lit(True)
    for f in fields:
        cond = cond & F.col(f).isNotNull()
    return rows.where(cond)


def dedup_rows(rows: DataFrame, keys: Sequence[str] = DEDUP_KEYS,
               order: Sequence[str] = ("page_id", "chunk", "pos")) -> DataFrame:
    """D2 (ours, off by default): one row per (site, name, price, quantity,
    labels, capture time); the copy that comes first in page order is kept.
    Rows without a name are products nobody can tell apart, not copies: each
    stays.

    Two phases, over rows written once to the shared folder (so that a page is
    parsed once).  First the rows are counted by a 64-bit hash of their keys: a
    hash aggregate over two fixed-width columns, combined map-side.  Most
    hashes occur once, and their rows are passed on as they are.  Only rows whose
    hash comes again are grouped by their full keys, where the first is picked
    (a partial aggregate, so a key with many copies is combined map-side too).
    """
    keys = list(keys)
    spark = rows.sparkSession
    path = shared_path(spark, f"dedup-{uuid.uuid4().hex}")
    rest = [c for c in rows.columns if c not in keys]
    rows.withColumn("_hash", F.when(F.col("name").isNotNull(), F.xxhash64(*keys))).write.parquet(path)
    stored = spark.read.parquet(path)
    again = stored.where("_hash IS NOT NULL").groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # both sides of the join read the same narrow table; a hot hash is split by the skew join
    marked = stored.join(again.select("_hash", F.lit(True).alias("_again")), "_hash", "left")
    alone = marked.where("_again IS NULL").select(*keys, *rest, F.lit(1).cast("bigint").alias("copies"))
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order]))
    several = (marked.where("_again").groupBy(*keys).agg(first.alias("_first"), F.count(F.lit(1)).alias("copies"))
               .select(*keys, "_first.*", "copies"))
    return alone.unionByName(several)


def limit_items(rows: DataFrame, n: int, order: Sequence[str] = ("site", "page_id", "chunk", "pos")
                ) -> DataFrame:
    """L1: the first ``n`` rows in a fixed order (exact and repeatable, unlike
    stopping a crawl after about n items).  Spark plans this as a per-task
    top-n followed by a merge, so no task holds more than n rows."""
    return rows.orderBy(*order).limit(n)
