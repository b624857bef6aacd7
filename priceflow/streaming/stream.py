"""Snapshots arrive as files, price rows are appended as they come.

Every step from card extraction to the sink row is stateless (no
aggregation, no window), so the batch transforms run unchanged on a stream:
``readStream`` (parquet, fixed schema) -> ``product_prices`` -> kept and rejected
rows -> ``writeStream`` append, partitioned by outcome and country, with a checkpoint so a
restarted query picks up where it stopped.  ``availableNow`` processes what
is there and stops, which suits a scheduled ingest.  The crawl-log rules
(C10, C12, C14) need row order across pages and stay batch.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from priceflow.operators.products import product_prices
from priceflow.session import shared_path
from priceflow.sources.sink import outcome_frame
from priceflow.sources.snapshots import SNAPSHOT_SCHEMA, write_snapshots


def start_price_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                       site_rule: DataFrame, available_now: bool = True,
                       max_files_per_trigger: int | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    Kept and rejected rows go to one table, partitioned by outcome and
    country (see ``sink.append_country_table``), so nothing is lost and a
    page is parsed once.
    """
    reader = spark.readStream.schema(SNAPSHOT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = outcome_frame(product_prices(reader.parquet(source_dir), site_rule))
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir).partitionBy("outcome", "country"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)


def stream_append(spark: SparkSession, snapshots: DataFrame, site_rule: DataFrame,
                  base_dir: str | None = None, max_files_per_trigger: int | None = None) -> str:
    """Write ``snapshots`` as files (as many as they have partitions), stream
    them into the sink, and return the sink's path.  Folders live under the
    cluster's checkpoint folder (shared storage), a new one per run."""
    base = base_dir or shared_path(spark, "priceflow-stream", uuid.uuid4().hex)
    source, sink, ckpt = (os.path.join(base, x) for x in ("source", "sink", "checkpoint"))
    write_snapshots(snapshots, source)
    query = start_price_stream(spark, source, sink, ckpt, site_rule, max_files_per_trigger=max_files_per_trigger)
    query.awaitTermination()
    return sink
