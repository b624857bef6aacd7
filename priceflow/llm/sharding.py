"""Sharding by a consistent-hash ring with bounded loads (operator 5, DataFrame
functions only).

Every shard owns ``vnodes`` points of a ring of 2**60; a row belongs to the arc
that ends at the first point at or after its key's hash.  Loads are bounded: a
shard may hold its even share of the rows (counts differ by at most one).  It
first admits the rows of its own arcs, clockwise.  What room is then left is
opened at its points in even parts, and rows that found their shard full
continue clockwise, first come first served, to the next point with room.
Since room and overflow add up to the same number, the walk has a closed form:
started where the running sum of overflow minus room is least, the u-th
overflowing row takes the u-th free place.  That is worked out on tables of
arcs and pieces, whose size is fixed by the ring (shards x vnodes), never by
the data.

Rows are ranked inside an arc by a hash of their columns, then by the columns,
in slices of that order (see ``operators.numbering``): as many as there are
tasks, at every size, and equal rows fall into different slices by a written row
number, so a key that holds a third of all rows is ranked by many tasks.  Equal
rows are interchangeable, so the result does not depend on the table's layout.
Null keys hash like an empty text; null texts have size 1; repeated rows are
placed one by one; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from priceflow.llm.common import materialize
from priceflow.operators.numbering import sequence_number


def ring_hash(text: Column) -> Column:
    """Ring position: the first 15 hex digits of md5 (60 bits)."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(point, owner) in clockwise order; fixed by the two parameters."""
    return sorted((int(hashlib.md5(f"shard-{s}/{v}".encode()).hexdigest()[:15], 16), s)
                  for s in range(shards) for v in range(vnodes))


def longs(values) -> Column:
    return F.from_json(F.lit(str([int(v) for v in values])), "array<bigint>")


def arc_of(position: Column, points: list[int]) -> Column:
    """Index of the first point >= position (0 beyond the last): binary search."""
    n, table = len(points), longs(points)
    steps = [1 << k for k in reversed(range(n.bit_length()))]
    below = F.aggregate(longs(steps), F.lit(0).cast("long"), lambda at, step: F.when(
        (at + step <= n) & (F.element_at(table, F.least(at + step, F.lit(n)).cast("int")) < position),
        at + step).otherwise(at))
    return (below % n).cast("int")


def _running(column: str, order: W) -> Column:
    """Sum over the rows before this one."""
    return F.coalesce(F.sum(column).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))


def _pieces(arcs: DataFrame, shards: int, vnodes: int) -> DataFrame:
    """(arc, lo, hi, shard, first_slot) from (arc, owner, n): which ranks of an
    arc go where.  Every table here has a few times shards x vnodes rows."""
    everywhere, owner = W.partitionBy(F.lit(0)), W.partitionBy("owner")
    total = F.sum("n").over(everywhere)
    arcs = arcs.withColumn("share", (F.floor(total / shards) + F.when(
        F.col("owner") < total % shards, 1).otherwise(0)).cast("long"))
    arcs = arcs.withColumn("own", F.greatest(F.lit(0), F.least(
        F.col("n"), F.col("share") - _running("n", owner.orderBy("arc")))))
    left = F.col("share") - F.sum("own").over(owner)
    nth = F.row_number().over(owner.orderBy("arc")) - 1
    arcs = arcs.withColumns({
        "over": F.col("n") - F.col("own"),
        "room": (F.floor(left / vnodes) + F.when(nth < left % vnodes, 1).otherwise(0)).cast("long")})
    balance = F.sum(F.col("over") - F.col("room")).over(everywhere.orderBy("arc"))
    arcs = arcs.withColumn("balance", balance)
    lowest = F.min(F.struct("balance", "arc")).over(everywhere)["arc"]
    arcs = arcs.withColumn("at", (F.col("arc") - lowest - 1 + shards * vnodes) % (shards * vnodes))
    arcs = arcs.withColumns({"over_from": _running("over", everywhere.orderBy("at")),
                             "room_from": _running("room", everywhere.orderBy("at"))})
    own = arcs.where("own > 0").select(
        "arc", F.lit(0).cast("long").alias("lo"), F.col("own").alias("hi"), F.col("owner").alias("shard"))
    # both sequences cut the places 0, 1, 2, ... into runs; a piece ends where either does
    cuts = arcs.where("over > 0").select(
        F.col("over_from").alias("cut"),
        F.struct("arc", "own", F.col("over_from").alias("start")).alias("lot"), F.lit(None).cast("int").alias("shard"),
        F.sum("over").over(everywhere).alias("end"))
    cuts = cuts.unionByName(arcs.where("room > 0").select(
        F.col("room_from").alias("cut"), F.lit(None).cast(cuts.schema["lot"].dataType).alias("lot"),
        F.col("owner").alias("shard"), F.sum("room").over(everywhere).alias("end")))
    cuts = cuts.groupBy("cut").agg(F.max("lot").alias("lot"), F.max("shard").alias("shard"), F.max("end").alias("end"))
    order = W.partitionBy(F.lit(0)).orderBy("cut")
    cuts = cuts.select(
        "cut", F.last("lot", True).over(order).alias("lot"), F.last("shard", True).over(order).alias("shard"),
        F.coalesce(F.lead("cut").over(order), F.col("end")).alias("to"))
    lo = F.col("lot.own") + F.col("cut") - F.col("lot.start")
    moved = cuts.select(F.col("lot.arc").alias("arc"), lo.alias("lo"),
                        (lo + F.col("to") - F.col("cut")).alias("hi"), "shard")
    pieces = own.unionByName(moved).withColumn("rows", F.col("hi") - F.col("lo"))
    return pieces.withColumn("first_slot", _running("rows", W.partitionBy("shard").orderBy("arc", "lo"))).drop("rows")


def assign(rows: DataFrame, key: Column, shards: int = 8, vnodes: int = 64) -> DataFrame:
    """rows + shard + slot; ``rows`` should hold narrow columns only (it is written)."""
    table = ring(shards, vnodes)
    arcs = len(table)
    columns = rows.columns
    own = [F.col(f"`{c}`") for c in columns]
    placed = materialize(rows.select(
        "*",
        arc_of(ring_hash(F.coalesce(key.cast("string"), F.lit(""))), [p for p, _ in table]).alias("__arc"),
        F.xxhash64(*own).alias("__hash"), F.monotonically_increasing_id().alias("__row")), "ring-rows")
    owners = F.element_at(longs(o for _, o in table), (F.col("arc") + 1).cast("int")).cast("int")
    loads = placed.groupBy("__arc").agg(F.count("*").alias("n"))
    every = rows.sparkSession.range(arcs).select(F.col("id").cast("int").alias("arc"))
    loads = every.join(F.broadcast(loads.withColumnRenamed("__arc", "arc")), "arc", "left").select(
        "arc", owners.alias("owner"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    pieces = _pieces(loads, shards, vnodes).withColumnRenamed("arc", "__arc")
    ranked = sequence_number(placed, ["__arc"], ["__hash", *columns, "__row"], "__rank")
    ranked = ranked.withColumn("__rank", F.col("__rank") - 1)
    # at most a few times arcs rows: fixed by the parameters
    inside = (ranked["__arc"] == pieces["__arc"]) & (ranked["__rank"] >= pieces["lo"]) & (ranked["__rank"] < pieces["hi"])
    return ranked.join(F.broadcast(pieces), inside).select(
        *[ranked[f"`{c}`"] for c in columns], pieces["shard"].cast("int").alias("shard"),
        (pieces["first_slot"] + ranked["__rank"] - pieces["lo"]).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign(rows, F.col("doc_id"), shards)
