"""Running numbers and totals within a key, safe under key skew.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a
key to one task; when one category holds a third of the crawl, that task
holds a third of the data.  Here the rows of a key are cut into slices
along the order, each slice is numbered on its own, and slices are stitched
together with offsets.  Only keys that are too large for one task are cut:

0. Large keys: those that hold at least two slices' worth of a bounded sample
   of the key columns, so at most half as many as there are slices.  The rows of any other
   key are numbered whole, as slice 0 of their key; without a large key
   steps 1, 2 and 4 are left out.  Which keys count as large decides where rows
   are numbered, never their numbers.
1. Slice bounds: the ``SAMPLE_PER_SLICE`` x slices rows with the least hash
   (a bounded sample, by row position, taken map-side first) are sorted by
   Spark itself and every n-th becomes a bound.  The bounds are one constant
   array, so the plan does not grow with the slice count, and any orderable
   type works, in Spark's own order.
2. A row's slice is a binary search over that array, log2(slices) steps: a
   pure function of the row, so a task re-run after a lost executor puts the
   row in the same slice.  The slice never decreases along (key, order), so
   each slice is a contiguous run of the order; a hot key is spread over
   many slices.
3. A window on (slice, key) gives the running value inside the slice.
4. Per (slice, key) totals are turned into offsets with a window over
   slices (a key spans at most all slices, so these groups are small).
   Only a key that runs over a slice bound has a non-zero offset, and each
   slice starts with at most one such key: the offset table has at most one
   row per slice, a proven bound, so it is broadcast and the rows are not
   shuffled again.

Several running values over one order (page numbers and totals, say) are worked
out in the same pass (``running_values``).

The result equals the plain window exactly, as long as ``order`` is a total
order within the key (add a unique column as the last tie breaker).  Rows
that tie on every order column are interchangeable and may be numbered in
any order among themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_SLICE = 20


_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _sample(df: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows with the least hash of their position, taken map-side first."""
    return df.withColumn("at", F.xxhash64(F.monotonically_increasing_id())).orderBy("at").limit(rows)


def slice_bounds(df: DataFrame, cols: Sequence[str], slices: int) -> Column:
    """Ascending constant array of at most ``slices`` - 1 distinct (cols) values
    that cut ``df`` into about equal parts.

    Any ascending bounds give right numbers, so it does not matter that they
    pass through JSON.
    """
    row = F.struct(*[F.col(c) for c in cols]).alias("row")
    sample = _sample(df.select(row), SAMPLE_PER_SLICE * slices)   # top-k per task, then of those
    ordered = sample.agg(F.sort_array(F.collect_list("row")).alias("rows"))
    n = F.size("rows")
    cuts = F.transform(F.sequence(F.lit(1), F.lit(max(slices - 1, 1))),
                       lambda i: F.get(F.col("rows"), F.floor(i * n / slices).cast("int")))
    bounds = F.when((n > 0) & F.lit(slices > 1), F.array_distinct(cuts)).otherwise(F.slice("rows", 1, 0))
    ordered = ordered.select(bounds.alias("bounds"))
    text = ordered.select(F.to_json("bounds", _JSON)).first()[0]
    return F.from_json(F.lit(text), ordered.schema["bounds"].dataType, _JSON)


def large_keys(df: DataFrame, keys: Sequence[str], slices: int) -> Column | None:
    """Condition: the row's key is too large for one task; None where no key is.

    Only the key columns are read.  Without keys, all rows are one large key.
    """
    if not keys:
        return F.lit(True)
    counts = _sample(df.select(*keys), SAMPLE_PER_SLICE * slices).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = (counts.where(F.col("_n") >= 2 * SAMPLE_PER_SLICE)
             .agg(F.collect_list(F.struct(*keys)).alias("keys"), F.count(F.lit(1)).alias("n")))
    found = large.select(F.to_json("keys", _JSON).alias("text"), "n").first()
    if not found["n"]:
        return None
    listed = F.from_json(F.lit(found["text"]), large.schema["keys"].dataType, _JSON)
    return F.array_contains(listed, F.struct(*[F.col(k) for k in keys]))


def slice_of(cols: Sequence[str], bounds: Column, slices: int) -> Column:
    """Number of bounds <= the row's (cols) value, by binary search."""
    row = F.struct(*[F.col(c) for c in cols])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, slices).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) <= row), at + step).otherwise(at))


def running_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   values: Mapping[str, str | Column], num_slices: int | None = None) -> DataFrame:
    """Add, for each ``out: value``, the sum of ``value`` over rows of the same key up to this one.

    All values share one pass: the same slices, one window, one table of offsets.
    Bounds come from the key and order columns only.  One slice per shuffle
    partition unless ``num_slices`` is given.
    """
    keys, order, outs = list(keys), list(order), list(values)
    slices = num_slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = large_keys(df, keys, slices)
    sliced = df.withColumns({f"_v{k}": F.col(v) if isinstance(v, str) else v for k, v in enumerate(values.values())})
    places = range(len(outs))
    if large is None:
        in_key = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return sliced.withColumns({out: F.sum(f"_v{k}").over(in_key) for k, out in enumerate(outs)}).drop(
            *[f"_v{k}" for k in places])
    bounds = slice_bounds(df.where(large), keys + order, slices)
    sliced = sliced.withColumn("_large", F.coalesce(large, F.lit(False)))
    sliced = sliced.withColumn("_slice", F.when(F.col("_large"), slice_of(keys + order, bounds, slices)).otherwise(0))

    in_slice = (Window.partitionBy("_slice", *keys).orderBy(*order)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sliced.drop("_large").select("*", *[F.sum(f"_v{k}").over(in_slice).alias(f"_local{k}") for k in places])

    totals = sliced.where("_large").groupBy("_slice", *keys).agg(
        *[F.sum(f"_v{k}").alias(f"_total{k}") for k in places])
    before = (Window.partitionBy(*keys).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    names = ["_slice", *keys]
    offsets = totals.select(*[F.col(c).alias(f"_o_{c}") for c in names],
                            *[F.sum(f"_total{k}").over(before).alias(f"_offset{k}") for k in places])
    offsets = offsets.where(reduce(lambda a, b: a | b, [
        F.coalesce(F.col(f"_offset{k}") != 0, F.lit(False)) for k in places]))

    # null-safe: a NULL key is a key like any other here
    cond = F.col("_slice") == F.col("_o__slice")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    joined = local.join(F.broadcast(offsets), cond, "left").withColumns({
        out: F.col(f"_local{k}") + F.coalesce(F.col(f"_offset{k}"), F.lit(0)) for k, out in enumerate(outs)})
    return joined.drop(*names[:1], *[f"_o_{c}" for c in names],
                       *[f"{n}{k}" for n in ("_v", "_local", "_offset") for k in places])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                value: str | Column, out: str, num_slices: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows of the same key up to this one."""
    return running_values(df, keys, order, {out: value}, num_slices)


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    out: str, num_slices: int | None = None) -> DataFrame:
    """Add ``out`` = 1, 2, 3, ... within each key in ``order`` (row_number)."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out, num_slices)
