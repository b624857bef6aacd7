"""Helpers shared by the operators: shared folders, text buffers, word hashes.

Word hashing works on the UTF-8 bytes of a whole Arrow batch at once.  A word
is a maximal run of "word bytes" (a 256-entry table) inside one text; its hash
is a polynomial in a fixed odd base modulo 2**64, read off prefix sums, then
mixed.  Nothing is cut to a prefix: long texts are handled in blocks that end
between words.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import priceflow
from priceflow.session import shared_path

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's shared checkpoint location."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage with files that every executor can reach, so a lost
    executor costs nothing that was already finished.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(priceflow.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="priceflow-")) / "priceflow.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))  # the driver serves it; executors fetch their own copy
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- arrays


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of a well-known avalanche hash, in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def word_table(separators: str) -> np.ndarray:
    """True for bytes that belong to words; ``separators`` are ASCII."""
    table = np.ones(256, bool)
    table[list(separators.encode("ascii"))] = False
    return table


#: words ``[^\x20\x09-\x0D]+``
SPACED = word_table(" \t\n\x0b\x0c\r")
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
LETTERS = word_table("".join(chr(c) for c in range(128) if not chr(c).isalnum()))
KEEP_CASE = np.arange(256, dtype=np.uint8)
LOWER = KEEP_CASE.copy()
LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (modulo 2**64); small tables are kept."""
    size = max(BLOCK, 1 << int(n - 1).bit_length())
    if size in _powers:
        return _powers[size]
    out = []
    for b in (BASE, INVERSE):
        p = np.full(size, np.uint64(b))
        p[0] = 1
        out.append(np.cumprod(p))
    if size <= 4 * BLOCK:
        _powers[size] = (out[0], out[1])
    return out[0], out[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: np.ndarray = KEEP_CASE,
          prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(start, end, hash) of every word of every text, in order.

    For each size in ``prefixes`` the hash of the word's first bytes follows (0
    where the word is not longer than that).
    """
    n = len(data)
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]  # words end where their text does
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    heads = [np.zeros(len(starts), np.uint64) for _ in prefixes]
    w = 0
    while w < len(starts):  # whole words, about BLOCK bytes at a time
        lo = starts[w]
        to = max(w + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        hi = ends[to - 1]
        power, inverse = powers(hi - lo + 1)
        terms = lower[data[lo:hi]].astype(np.uint64)
        terms += np.uint64(1)
        terms *= power[:hi - lo]
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(terms, out=sums[1:])
        s, e = starts[w:to] - lo, ends[w:to] - lo
        hashes[w:to] = mix((sums[e] - sums[s]) * inverse[s])
        for size, head in zip(prefixes, heads):
            longer = np.flatnonzero(e - s > size)
            at = s[longer]
            head[w + longer] = mix((sums[at + size] - sums[at]) * inverse[at] ^ np.uint64(size))
        w = to
    return starts, ends, hashes, *heads


def word_hash(word: str, lower: np.ndarray = KEEP_CASE) -> int:
    """The hash that ``words`` gives to this one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    _, _, h = words(data, np.array([0, len(data)]), np.ones(256, bool), lower)
    return int(h[0])


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds of each text's words: text i owns words [out[i], out[i + 1])."""
    return np.searchsorted(starts, offsets, "left")


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = 4 * BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (one text at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    _, offsets = text_buffer(col)
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def crc_remainder(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
