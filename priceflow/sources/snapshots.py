"""Captured pages as files: the batch reader and writer.

A snapshot table holds one captured listing page per row.  The same fixed
schema serves the batch reader and the stream.

Raw captures are ``.html`` files, as a browser saves them; their place names the
page::

    <root>/<site>/<yyyyMMddTHHmmss>/<page_id>-<chunk>.html

Spark reads each as one row (whole file, UTF-8) with the file's path beside it.
The address is the page's canonical link; labels come from its path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priceflow.functions.labels import label_from_url
from priceflow.operators.crawl_log import next_page
from priceflow.operators.extract import card_array, decode_entities, tag

SNAPSHOT_SCHEMA = ("page_id bigint, chunk int, site string, url string, category string, "
                   "sub_category string, page_number int, captured_at timestamp_ntz, "
                   "n_cards bigint, html string")
SNAPSHOT_COLUMNS = [c.split()[0] for c in SNAPSHOT_SCHEMA.split(", ")]


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Every captured page under ``path`` (parquet); missing columns are NULL."""
    return spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)


def write_snapshots(snapshots: DataFrame, path: str) -> None:
    snapshots.select(*SNAPSHOT_COLUMNS).write.mode("append").parquet(path)


CAPTURE_PATH = r"([^/]+)/(\d{8}T\d{6})/(\d+)-(\d+)\.html?$"
_CANONICAL = tag("link", "rel", "canonical")


def _captures(files: DataFrame) -> DataFrame:
    """Whole files with their paths -> the snapshot schema.

    A path that is none of a capture's gives NULLs for what it should name, and so
    does a missing canonical link; the page itself is kept, so nothing is lost unseen.
    """
    def part(k: int) -> Column:
        found = F.regexp_extract("file_path", CAPTURE_PATH, k)
        return F.when(found != "", found)

    link = F.regexp_extract("html", f"({_CANONICAL})", 1)
    url = F.regexp_extract(link, r'\shref="([^"]*)"', 1)
    read = files.select(
        part(3).try_cast("bigint").alias("page_id"), part(4).try_cast("int").alias("chunk"), part(1).alias("site"),
        decode_entities(F.when(url != "", url)).alias("url"),
        F.try_to_timestamp(part(2), F.lit("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz").alias("captured_at"), "html")
    category, sub_category = label_from_url("url")
    return read.select(
        "page_id", "chunk", "site", "url", category.alias("category"), sub_category.alias("sub_category"),
        next_page("html")[0].alias("page_number"), "captured_at",
        F.size(card_array("html", "site")).cast("bigint").alias("n_cards"), "html")


def _whole_files(reader, path: str) -> DataFrame:
    return (reader.format("text").option("wholetext", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.htm*").load(path)
            .select(F.col("value").alias("html"), F.col("_metadata.file_path").alias("file_path")))


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """S1 on raw captures: every ``.html`` file under ``path``, in the snapshot schema."""
    return _captures(_whole_files(spark.read, path))


def stream_captures(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream: files are read as they arrive."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _captures(_whole_files(reader, path))
