"""Price rows out.

The reference inserts one row at a time into a table named after the
country and commits each row.  Here the country is a partition column of
one table, rows are written by the tasks that made them, and bad rows go to
a second table instead of being lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SINK_COLUMNS = [
    ("name", "string"), ("price", "double"), ("unit_price", "double"),
    ("total_unit_quantity", "double"), ("unit_type", "string"), ("category", "string"),
    ("sub_category", "string"), ("comercial_name", "string"), ("comercial_id", "string"),
    ("result_date", "string"), ("result_time", "string"),
]


def project_sink_row(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 11 columns in their fixed order; a missing one is NULL."""
    present = set(rows.columns)
    cols = [(F.col(c).cast(t) if c in present else F.lit(None).cast(t)).alias(c)
            for c, t in SINK_COLUMNS]
    return rows.select(*cols, *keep)


def route_by_country(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a country go to that country's partition; rows
    without one (a site missing from the site table) are rejects."""
    routed = rows.where(F.col("country").isNotNull())
    unrouted = rows.where(F.col("country").isNull()).withColumn("reason", F.lit("no_country"))
    return routed, unrouted


def isolate_bad_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split kept rows from rejected ones; rejects keep their reason."""
    good = rows.where((F.col("status") != "rejected") & F.col("country").isNotNull())
    bad = rows.where((F.col("status") == "rejected") | F.col("country").isNull()).withColumn(
        "reason", F.coalesce(F.col("reason"), F.lit("no_country")))
    return good, bad


def sink_frame(rows: DataFrame) -> DataFrame:
    """The rows S4 keeps: 11 columns + ``country``."""
    good, _ = isolate_bad_rows(rows)
    return project_sink_row(good, keep=("country",))


TRACE = ("site", "page_id", "chunk", "pos", "reason")   # where a row came from, and why it was rejected


def outcome_frame(rows: DataFrame) -> DataFrame:
    """Kept and rejected rows in one frame: 11 columns, ``TRACE``, and the two
    partition columns ``outcome`` ('kept' or 'rejected') and ``country``."""
    kept = (F.col("status") != "rejected") & F.col("country").isNotNull()
    judged = rows.withColumns({
        "outcome": F.when(kept, F.lit("kept")).otherwise(F.lit("rejected")),
        "reason": F.when(kept, F.col("reason")).otherwise(F.coalesce(F.col("reason"), F.lit("no_country")))})
    return project_sink_row(judged, keep=(*TRACE, "outcome", "country"))


def append_country_table(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S4 + S7: append kept and rejected rows under ``path``, partitioned by
    outcome and country, in one write: every page is parsed once.

    Appends only, like the reference's INSERT (no upsert); rerunning the
    same snapshots appends the same rows again (see ``dedup_rows``).  The
    same frame can go to ``write.jdbc`` instead.
    """
    outcome_frame(rows).write.mode("append").partitionBy("outcome", "country").format(fmt).save(path)


def _table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    columns = [*SINK_COLUMNS, ("site", "string"), ("page_id", "bigint"), ("chunk", "int"), ("pos", "int"),
               ("reason", "string"), ("outcome", "string"), ("country", "string")]
    return spark.read.schema(", ".join(f"{c} {t}" for c, t in columns)).format(fmt).load(path)


def kept_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The kept rows of a sink table: 11 columns + ``country``."""
    rows = _table(spark, path, fmt).where(F.col("outcome") == "kept")
    return rows.select(*[c for c, _ in SINK_COLUMNS], "country")


def rejected_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rejected rows of a sink table, with their place and reason."""
    return _table(spark, path, fmt).where(F.col("outcome") == "rejected").drop("outcome")
