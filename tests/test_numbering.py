"""Skew-safe numbering equals the plain window, also with one hot key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from priceflow.operators.numbering import running_sum, sequence_number


def test_sequence_number_matches_row_number_under_skew(spark):
    # key 0 holds most rows (a hot key); ties in 'v' are broken by 'id'
    df = spark.range(0, 6000).select(
        F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 7).alias("v"), "id")
    got = sequence_number(df, ["k"], ["v", "id"], "n", num_slices=8)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("bigint"))
    assert got.select("k", "v", "id", "n").exceptAll(ref).count() == 0
    assert got.count() == 6000


def test_running_sum_with_signed_values(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("k"), "id",
                                    (F.col("id") % 5 - 2).alias("x"))
    got = running_sum(df, ["k"], ["id"], "x", "s", num_slices=5)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("s", F.sum("x").over(w))
    assert got.select("k", "id", "x", "s").exceptAll(ref).count() == 0


def test_bounds_follow_spark_order_with_nulls_and_nan(spark):
    base = [(k, v) for k in (None, "a", "b") for v in (None, float("nan"), -1.0, 0.0, 2.5)] * 40
    rows = [(k, v, i) for i, (k, v) in enumerate(base)]
    df = spark.createDataFrame(rows, "k string, v double, id long")
    got = sequence_number(df, ["k"], ["v", "id"], "n", num_slices=6)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("bigint"))
    assert got.select("k", "v", "id", "n").exceptAll(ref.select("k", "v", "id", "n")).count() == 0


def test_any_orderable_type_and_many_slices_in_a_plain_plan(spark):
    df = spark.range(0, 20_000).selectExpr(
        "cast(CASE WHEN id < 15000 THEN 0 ELSE id % 50 END AS decimal(10,2)) AS k",
        "timestamp_seconds(id % 97) AS t", "id")
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")).cast("bigint"))
    for slices in (1, 2, 2000):
        got = sequence_number(df, ["k"], ["t", "id"], "n", num_slices=slices)
        assert got.select("k", "t", "id", "n").exceptAll(ref).count() == 0
        assert got.count() == 20_000


def test_hot_key_is_cut_into_slices_and_empty_input_works(spark):
    from priceflow.operators.numbering import slice_bounds, slice_of
    df = spark.range(0, 5000).selectExpr("0L AS k", "id")
    cut = df.select(slice_of(["k", "id"], slice_bounds(df, ["k", "id"], 10), 10).alias("s")).groupBy("s").count()
    sizes = [r["count"] for r in cut.collect()]
    assert len(sizes) == 10 and max(sizes) < 1500
    assert sequence_number(df.where("id < 0"), ["k"], ["id"], "n").count() == 0


def test_only_large_keys_are_cut_into_slices(spark):
    small = spark.range(0, 4000).select((F.col("id") % 1000).alias("k"), "id")
    hot = small.withColumn("k", F.when(F.col("id") < 2000, None).otherwise(F.col("k")))
    for df, cut in ((small, False), (hot, True)):
        got = sequence_number(df, ["k"], ["id"], "n", num_slices=8)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("_slice" in plan, "Join" in plan) == (cut, cut)
        ref = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("bigint"))
        assert got.exceptAll(ref).count() == 0 and got.count() == 4000
