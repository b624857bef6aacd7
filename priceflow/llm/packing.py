"""Best-fit packing into sequences of several permitted lengths (operator 6).

A document's tokens (words by default) are cut into pieces of at most the
longest permitted length; every piece goes whole into one bin.  Pieces are
dealt into groups of about ``GROUP`` pieces, and each group is packed on its
own by best-fit decreasing:

* a piece goes into the open bin that it fills best (least room left);
* if none has room, a new bin is opened at the permitted length that costs
  least per token it can hope to hold: the piece plus the shorter pieces still
  to come, as far as they fit.  A sequence of length c costs
  c + c * c / ``ATTENTION`` + ``OVERHEAD``;
* the preference is optimised jointly: the group is also packed with each
  permitted length as the smallest to open, and the cheapest packing is kept;
* at last each bin is downsized to the shortest permitted length that holds
  its contents.

Texts without tokens get one row of length 0 in no bin (null bin_id, capacity
and offset).  Rows with equal or null ids are packed one by one.  Groups are
drawn from a row's position, so no key can make one large.  An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.llm import common

LENGTHS = (256, 512, 1024, 2048)
ATTENTION = 16384
OVERHEAD = 32
GROUP = 50_000

PACKED = ("doc_id bigint, n_tokens bigint, piece int, piece_start bigint, length int,"
          " bin_id bigint, capacity int, offset int")


def cost(length):
    return length + length * length / ATTENTION + OVERHEAD


def _best_fit(sizes: list[int], lengths: tuple[int, ...], least: int) -> tuple[list[int], list[int]]:
    """Bin of each piece (sizes descending) and contents of each bin; new bins
    have ``least`` or more, 0 meaning by cost."""
    longest = lengths[-1]
    shorter = np.cumsum(np.array(sizes[::-1], np.int64))[::-1].tolist() + [0]  # tokens from piece i on
    by_room: list[list[int]] = [[] for _ in range(longest + 1)]
    rooms = 0  # bit r: some open bin has room r
    bins, used = [], []
    for i, size in enumerate(sizes):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            able = [c for c in lengths if c >= size and c >= least] or [longest]
            room = min(able, key=lambda c: (cost(c) / (size + min(c - size, shorter[i + 1])), c)) \
                if least == 0 else able[0]
            b = len(used)
            used.append(0)
        bins.append(b)
        used[b] += size
        room -= size
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, used


def pack_sizes(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int]]:
    """(bin of each piece, capacity of each bin) of the cheapest packing."""
    fit = np.array(lengths)
    best = None
    for least in (0, *lengths):
        bins, used = _best_fit(sizes, lengths, least)
        capacity = fit[np.searchsorted(fit, used)]
        price = float(cost(capacity).sum())
        if best is None or price < best[0]:
            best = (price, bins, capacity.tolist())
    return best[1], best[2]


def count_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) by words; a null text has none."""
    n = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), n.cast("bigint").alias("n_tokens"))


def pack(counts: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """One row per piece of (doc_id, n_tokens): its bin, the bin's capacity, its offset there."""
    lengths = tuple(sorted(lengths))
    longest = lengths[-1]
    spark = counts.sparkSession
    cut = counts.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"),
                        F.monotonically_increasing_id().alias("row"))
    cut = common.materialize(cut, "packing-rows")
    n_pieces = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / longest))
    total = cut.agg(F.sum(n_pieces).alias("n")).first()["n"] or 0
    groups = max(1, -(-total // GROUP))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), (n_pieces - 1).cast("int"))).alias("piece"))
    start = F.col("piece") * F.lit(longest).cast("bigint")
    cut = cut.select("doc_id", "n_tokens", "row", "piece", start.alias("piece_start"),
                     F.least(F.col("n_tokens") - start, F.lit(longest)).cast("int").alias("length"),
                     F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("group"))

    def pack_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        filled = rows[rows["length"] > 0]
        bins, capacity = pack_sizes(filled["length"].tolist(), lengths)
        bins = np.array(bins, np.int64)
        order = np.argsort(bins, kind="stable")
        size = filled["length"].to_numpy(np.int64)[order]
        ends = np.cumsum(size)
        first = np.searchsorted(bins[order], np.arange(len(capacity)))
        offsets = np.empty(len(bins), np.int64)
        offsets[order] = ends - size - (ends - size)[first][bins[order]] if len(bins) else []
        rows = rows.assign(bin_id=pd.NA, capacity=pd.NA, offset=pd.NA).astype(
            {"bin_id": "Int64", "capacity": "Int32", "offset": "Int32"})
        rows.loc[filled.index, "bin_id"] = (np.int64(key[0]) << np.int64(32)) + bins
        rows.loc[filled.index, "capacity"] = np.array(capacity, np.int64)[bins] if len(bins) else []
        rows.loc[filled.index, "offset"] = offsets
        return rows[["doc_id", "n_tokens", "piece", "piece_start", "length", "bin_id", "capacity", "offset"]]

    common.ship(spark)
    return cut.groupBy("group").applyInPandas(pack_group, PACKED)


def pack_documents(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    return pack(count_tokens(docs), lengths)


