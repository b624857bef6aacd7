"""Generated methods of the page queries stay small enough for the JVM to compile (FINDINGS_r04, F1-F3)."""

import pytest
from pyspark.sql import functions as F

from priceflow.functions import labels, price, quantity
from priceflow.functions.text import WHITE_SPACE, strip_text
from priceflow.operators import policy
from priceflow.operators.products import product_prices
from priceflow.sources import fixtures as fx
from priceflow.sources.sink import outcome_frame
from priceflow.sources.snapshots import SNAPSHOT_SCHEMA

JIT_LIMIT = 8000  # bytes; the JVM never compiles a larger method


def largest_method(spark, df) -> int:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    try:
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(df.select("*")._jdf.queryExecution().executedPlan())
        return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length()))
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("finding", ["F1", "F2", "F3"])
def test_generated_methods_can_be_compiled(spark, tmp_path, finding):
    spark.createDataFrame([], SNAPSHOT_SCHEMA).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.schema(SNAPSHOT_SCHEMA).parquet(str(tmp_path / "pages"))
    columns = [*policy.DEDUP_KEYS, "page_id", "chunk", "pos", "status"] if finding == "F1" else None
    rows = product_prices(pages, fx.site_rule(spark), columns)
    if finding in ("F2", "F3"):   # the frame that both append
        rows = outcome_frame(rows)
    assert 0 < largest_method(spark, rows) <= JIT_LIMIT


def test_strip_by_column_equals_strip_by_list(spark):
    texts = [None, "", " ", "a", "a b", " a", "a ", " a　", "é", " é ", "\U0001f600", "\x7f", "~!", " a", "a\x85"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(strip_text("t").alias("named"), strip_text(F.concat("t", F.lit(""))).alias("listed")).collect()
    want = [t if t is None else t.strip(WHITE_SPACE) for t in texts]
    assert [r.named for r in got] == want and [r.listed for r in got] == want


def test_prices_with_blanks_around_their_signs(spark):
    df = spark.createDataFrame([(t,) for t in (" $ 12.900,50 ", " $ 5 ", "$", None)], "t string")
    got = df.select(price.price_dot_thousands("t").alias("a"), price.price_dot_thousands_nocomma("t").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(12900.5, None), (5.0, 5.0), (None, None), (None, None)]


def test_unit_price_from_a_kind_that_is_looked_up_once(spark):
    df = spark.createDataFrame([(10.0, 4.0, "GRS"), (10.0, 2.0, "Bandeja"), (10.0, 0.0, "kg"), (10.0, 5.0, "un"),
                                (10.0, None, None), (None, 2.0, "l")], "p double, q double, u string")
    kept = df.withColumns({"tray": F.lower("u") == "bandeja", "kind": quantity.unit_synonyms("u")})
    once = kept.select(*quantity.unit_price_by_unit("p", "q", F.col("tray"), F.col("kind"))).collect()
    assert [tuple(r) for r in once] == [(2.5, 4.0, "g"), (10.0, 2.0, "g"), (10.0, 1.0, "unidad"), (2.0, 5.0, "unidad"),
                                        (10.0, 1.0, "unidad"), (None, 2.0, "l")]


def test_breadcrumb_labels_without_crumbs_or_address(spark):
    df = spark.createDataFrame([(None, None), ([], None), (["a-b"], None), (["a-b", "c-d"], None), ([], "x-y"),
                                ([], "x-y/z"), (["a-b"], "x/y"), (["a-b", "c-d"], "x")], "c array<string>, u string")
    got = [tuple(r) for r in df.select(*labels.breadcrumb_category("c", "u")).collect()]
    assert got == [(None, None), (None, None), ("A B", "A B"), ("a-b", "c-d"), ("X Y", "X Y"), ("X Y", "Z"),
                   ("A B", "A B"), ("a-b", "c-d")]
