"""End to end on the smallest given tables: pages -> price rows -> sink,
batch and stream, and the oracle SQL against DuckDB."""

import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from priceflow.plans import catalog
from priceflow.sources import fixtures as fx
from priceflow.sources import sink
from priceflow.streaming.stream import stream_append

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def rows(spark):
    return catalog.product_rows(spark, SF_SMALL).cache()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["site", "page_id", "chunk", "pos"]
    assert df.count() > 0


def test_every_card_becomes_one_row(spark, rows):
    cards = fx.cards(spark, SF_SMALL).count()
    assert rows.count() == cards
    statuses = {r.status for r in rows.select("status").distinct().collect()}
    assert statuses == {"ok", "partial", "rejected"}
    # rows in = rows kept + rejects
    good, bad = sink.isolate_bad_rows(rows)
    assert good.count() + bad.count() == cards


def test_unit_price_times_quantity_is_price(rows):
    ratio_sites = ["falabella", "falabellacol", "cruzverdecl"]
    bad = (rows.where(F.col("site").isin(ratio_sites) & (F.col("status") == "ok"))
           .where(F.abs(F.col("unit_price") * F.col("total_unit_quantity") - F.col("price"))
                  > 1e-6 * F.col("price")))
    assert bad.count() == 0


def test_rerun_gives_same_rows(spark, rows):
    again = catalog.product_rows(spark, SF_SMALL)
    assert again.exceptAll(rows).count() == 0


def test_sink_appends_kept_and_rejected_in_one_table(spark, rows):
    out = os.path.join(tempfile.mkdtemp(prefix="priceflow-sink-"), "prices")
    sink.append_country_table(rows, out)
    kept, rejected = sink.kept_rows(spark, out), sink.rejected_rows(spark, out)
    assert set(r.country for r in kept.select("country").distinct().collect()) <= {"colombia", "chile", "peru"}
    assert kept.columns == [c for c, _ in sink.SINK_COLUMNS] + ["country"]
    assert kept.count() == rows.where(F.col("status") != "rejected").count()
    assert kept.count() + rejected.count() == rows.count()
    assert rejected.where("reason IS NULL").count() == 0


def test_stream_equals_batch_over_several_micro_batches(spark, rows):
    base = tempfile.mkdtemp(prefix="priceflow-stream-")
    path = stream_append(spark, fx.page_snapshot(spark, SF_SMALL).repartition(3), fx.site_rule(spark), base_dir=base,
                         max_files_per_trigger=1)
    batches = [f for f in os.listdir(os.path.join(base, "checkpoint", "commits")) if f.isdigit()]
    assert len(batches) >= 3
    streamed, batch = sink.kept_rows(spark, path), sink.sink_frame(rows)
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0
    assert streamed.count() + sink.rejected_rows(spark, path).count() == rows.count()


@pytest.mark.parametrize("name", ["product_price", "stop_on_empty_pages", "menu_tree", "next_page"])
def test_matches_duckdb_oracle(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "part", "events", "pages", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = catalog.queries()[name](spark, SF_SMALL)
    rel = con.sql(catalog.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    a = sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect())))
    b = sorted(map(repr, (tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall())))
    assert a == b


def test_sink_row_fills_missing_columns(spark):
    df = spark.createDataFrame([("Arroz", 10.0, "peru")], "name string, price double, country string")
    out = sink.project_sink_row(df, keep=("country",))
    assert out.columns == [c for c, _ in sink.SINK_COLUMNS] + ["country"]
    r = out.first()
    assert (r.name, r.price, r.unit_price, r.comercial_id, r.country) == ("Arroz", 10.0, None, None, "peru")


def test_unknown_site_is_routed_to_rejects(spark):
    from priceflow.operators.products import attach_retailer
    rows = spark.createDataFrame([("jumbo", "ok", None), ("nowhere", "ok", None)],
                                 "site string, status string, reason string")
    routed, unrouted = sink.route_by_country(attach_retailer(rows, fx.site_rule(spark)))
    assert [r.site for r in routed.collect()] == ["jumbo"]
    assert [(r.site, r.reason) for r in unrouted.collect()] == [("nowhere", "no_country")]
    _, bad = sink.isolate_bad_rows(attach_retailer(rows, fx.site_rule(spark)))
    assert [r.site for r in bad.collect()] == ["nowhere"]


def test_filter_on_parsed_column_stays_above_the_parse(spark):
    """The ``inline`` barrier: a filter on ``status`` must not be pushed
    down with the whole parse (regular expressions) inlined into it."""
    rows = catalog.product_rows(spark, SF_SMALL).where(F.col("status") != "rejected")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "status" in line]
    assert filters
    assert all("regexp" not in line.lower() and "rlike" not in line.lower() for line in filters)


def test_site_filter_reaches_the_scan_and_unused_columns_are_not_parsed(spark, tmp_path):
    from priceflow.operators.products import product_prices
    from priceflow.sources.snapshots import read_snapshots, write_snapshots
    write_snapshots(fx.page_snapshot(spark, SF_SMALL), str(tmp_path / "pages"))
    pages, rules = read_snapshots(spark, str(tmp_path / "pages")), fx.site_rule(spark)
    one = product_prices(pages, rules).where("site = 'jumbo' AND page_id = 1").select("site")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(site,jumbo)" in plan and "EqualTo(page_id,1)" in plan
    country = product_prices(pages, rules, ["country"]).groupBy("country").count()
    full = product_prices(pages, rules).groupBy("country").count()
    regexps = [d._jdf.queryExecution().optimizedPlan().toString().count("regexp") for d in (country, full)]
    assert regexps[0] < regexps[1] / 2
    assert sorted(country.collect(), key=str) == sorted(full.collect(), key=str)
