"""Raw captures as files (S1): batch and stream read the same rows."""

import datetime

from pyspark.sql import functions as F

from priceflow.operators.extract import card_fields, explode_cards
from priceflow.sources.snapshots import SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA, read_captures, read_snapshots, stream_captures, write_snapshots

CARD = ('<div class="Showcase__details"><button class="Showcase__name">Leche {n}</button>'
        '<div class="Showcase__salePrice" data-price="S/ 4.50">S/ 4.50</div></div>')
PAGER = '<div class="pagination"><span class="pagination__item page-number active">3</span></div>'


def capture(root, place, html):
    path = root / place
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(html, encoding="utf-8")


def folder(tmp_path):
    root = tmp_path / "captures"
    page = ('<html><head><link href="https://www.plazavea.com.pe/frutas-y-verduras/ba%C3%B1o?a=1&amp;b=2" rel="x">'
            '<link rel="canonical" href="https://www.plazavea.com.pe/l\u00e1cteos/leches"></head>\n<body>\n')
    capture(root, "plaza_vea/20240131T235901/12-0.html", page + CARD.format(n=1) + CARD.format(n=2) + PAGER + "</body></html>")
    capture(root, "plaza_vea/20240201T000000/13-2.htm", "<html></html>")
    capture(root, "plaza_vea/20240201T000000/notes.txt", "not a page")
    capture(root, "odd/page.html", "<p>kept</p>")
    capture(root, "plaza_vea/20241399T000000/14-0.html", "")
    return str(root)


def rows(df):
    return sorted((tuple(r) for r in df.select(*SNAPSHOT_COLUMNS).collect()), key=repr)


def test_a_folder_of_pages_reads_into_the_snapshot_schema(spark, tmp_path):
    df = read_captures(spark, folder(tmp_path))
    assert df.columns == SNAPSHOT_COLUMNS
    got = {r.page_id: r for r in df.collect()}
    first = got[12]
    assert (first.chunk, first.site, first.page_number, first.n_cards) == (0, "plaza_vea", 3, 2)
    assert first.url == "https://www.plazavea.com.pe/l\u00e1cteos/leches"
    assert (first.category, first.sub_category) == ("L\u00e1cteos", "Leches")
    assert first.captured_at == datetime.datetime(2024, 1, 31, 23, 59, 1)
    assert "\n<body>\n" in first.html
    assert (got[13].chunk, got[13].url, got[13].n_cards) == (2, None, 0)
    assert (got[None].site, got[None].html) == (None, "<p>kept</p>")
    assert 14 not in got or got[14].captured_at is None
    assert card_fields(explode_cards(df)).where("name_raw LIKE 'Leche%'").count() == 2


def test_the_stream_reads_the_same_rows(spark, tmp_path):
    root = folder(tmp_path)
    out = str(tmp_path / "out")
    query = (stream_captures(spark, root, max_files_per_trigger=1).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start(out))
    query.awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(read_captures(spark, root))
    # and they can be kept as a snapshot table
    table = str(tmp_path / "table")
    write_snapshots(read_captures(spark, root), table)
    assert rows(read_snapshots(spark, table)) == rows(read_captures(spark, root))


def small_tables(spark, tmp_path):
    """lineitem and part with long orders, a part that comes twice, null keys and null values."""
    lines = [(o, p, 1, n, float(100 * o + n), datetime.datetime(2024, 1, 1 + o % 28))
             for o in range(24) for n, p in enumerate([o % 5, (o + 1) % 5, 2, 3, 4, 0, 1, 9][:1 + o % 8], 1)]
    lines += [(None, 1, 1, 1, 5.0, None), (7, 2, 1, None, None, None), (3, 3, 1, 9, 7.5, None)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                          " l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(str(tmp_path / "lineitem.parquet"))
    parts = [(p, f"it's <{p}> & n ip v", f"Brand#{p}", ["PROMO", "ECONOMY"][p % 2], 7 * p) for p in (0, 1, 2, 3, 4, 4)]
    parts += [(9, None, None, None, None)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"
                          ).write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def test_pages_are_printed_as_their_cards_are_and_no_markup_is_shuffled(spark, tmp_path):
    from pyspark.sql import functions as F
    from priceflow.sources import fixtures as fx
    where = small_tables(spark, tmp_path)
    got = {(r.page_id, r.chunk, r.site): r.html for r in fx.page_snapshot(spark, where).collect()}
    cards = fx.cards(spark, where).groupBy("page_id", "chunk", "site").agg(
        F.array_sort(F.collect_list(F.struct("pos", "card_html"))).alias("cards")).collect()
    assert len(got) == len(cards)
    for r in cards:
        markup = "".join(c.card_html for c in r.cards if c.card_html is not None)
        html = got[r.page_id, r.chunk, r.site]
        assert html is None or markup in html
    assert sum(h is not None for h in got.values()) > 20
    plan = fx.page_snapshot(spark, where)._jdf.queryExecution().executedPlan().toString().splitlines()
    last = next(i for i, line in enumerate(plan) if "Exchange" in line)
    assert not any("card_html" in line for line in plan[last:])


def test_labels_are_made_once_per_page(spark):
    from priceflow.operators.products import product_prices
    from priceflow.sources import fixtures as fx
    from priceflow.sources.snapshots import SNAPSHOT_SCHEMA
    pages = spark.createDataFrame([], SNAPSHOT_SCHEMA)
    plan = product_prices(pages, fx.site_rule(spark))._jdf.queryExecution().analyzed().toString().splitlines()
    explode = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
    assert not any("initcap" in line for line in plan[:explode]) and any("initcap" in line for line in plan[explode:])


def test_elements_cut_by_one_pattern_are_those_of_the_fold(spark):
    """Random tags, nested deep, left open and cut off: the pattern or the fold, always what the fold finds."""
    import random

    from priceflow.functions import markup as mk
    rng = random.Random(7)
    bits = ["<div>", "</div>", '<div class="c x">', '<div id="r">', "<a>", '<a href="/p">', "</a>", "</a >", "<div\n/>", "<b>",
            "</b>", "t", " <", ">", "<divx>", "</div-a>", "<div ", "</div", "</a", "<abbr>", "ñ", '"']
    pages = ["".join(rng.choices(bits, weights=[4, 8, 4, 2, 4, 3, 6] + [1] * 15, k=rng.randint(1, 40))) for _ in range(3000)]
    pages += ["<div>" * n + "t" + "</div>" * n for n in (1, 6, 7, 8, 20)] + [
        '<div id="r">' + "<div><a>x<a>y</a></a>" * 3 + "<div>" * n + "</div>" * n + "</div><a>no</a></div></div><div><a>out</a>"
        for n in (0, 1, 6, 7, 9)]
    cases = [("div", "", False, False), ("div", r'<div\b[^>]*\sclass="c[^"]*"[^>]*>', False, False), ("a", "", False, True),
             ("div", r'<div\b[^>]*\sid="r"[^>]*>', True, False), ("div", r"<div>\s*<a\b[^>]*>", False, False)]
    columns = [(mk.elements("s", *c), mk._folded_elements(F.col("s"), c[0], c[1] or f"<{c[0]}", *c[2:])) for c in cases]
    rest = F.coalesce(F.get(F.split("s", '<div id="r">', 2), F.lit(1)), F.lit(""))
    columns.append((mk.grandchildren("s", '<div id="r">', "div", "a"), mk._folded_grandchildren(rest, "div", "a")))
    df = spark.createDataFrame([(p,) for p in pages] + [(None,)], "s string")
    out = df.select("s", *[x.alias(f"{k}{i}") for i, pair in enumerate(columns) for k, x in zip("gw", pair)]).collect()
    for i in range(len(columns)):
        assert [(r.s, r[f"g{i}"]) for r in out] == [(r.s, r[f"w{i}"]) for r in out]
        assert any(r[f"g{i}"] for r in out)


def test_elements_of_usual_nesting_and_great_length_are_cut_by_the_pattern(spark, monkeypatch):
    from priceflow.functions import markup as mk
    monkeypatch.setattr(mk, "_folded_elements", lambda *_: F.array(F.lit("folded")))
    long = "<p>t</p>" * 200_000
    pages = [("<div>a<div>b</div></div><div>c</div>",), (f"<div>{long}</div>",), ("<p>",)]
    out = spark.createDataFrame(pages, "s string").select(mk.elements("s", "div").alias("e")).collect()
    assert [r.e for r in out] == [["a<div>b</div>", "c"], [long], []]


def test_labels_and_prices_of_rows_do_not_wait_for_the_quantity(spark):
    from priceflow.operators.products import product_prices
    pages = spark.createDataFrame([], SNAPSHOT_SCHEMA)
    sites = spark.createDataFrame([], "site string, country string, comercial_name string, comercial_id string")

    def plan(*columns):
        return product_prices(pages, sites, columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "unidades" in plan("status")
    for c in ("category", "price", "name"):
        assert "unidades|" not in plan(c)


def test_each_field_pattern_runs_once_per_card(spark):
    from priceflow.operators.extract import INKAFARMA_PRICE_BLOCK, NAME_PATTERN, PLAZA_VEA_PRICE_TAG
    data = [("plaza_vea", '<div class="Showcase__salePrice" data-price="">S/</div>'),
            ("plaza_vea", "<div>no price</div>"),
            ("inkafarma", "<fp-product-name><span></span></fp-product-name>"
                          "<fp-product-card-price><div><span>old</span><span>S/ 2 &amp; up</span></div></fp-product-card-price>")]
    out = card_fields(spark.createDataFrame(data, "site string, card string"))
    assert [(r.name_raw, r.price_raw) for r in out.collect()] == [(None, ""), (None, None), (None, "S/ 2 & up")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    for pattern in (INKAFARMA_PRICE_BLOCK, PLAZA_VEA_PRICE_TAG, NAME_PATTERN["plaza_vea"]):
        assert plan.count(pattern) == 1


def test_elements_that_hold_something_are_taken_by_the_pattern_as_they_are(spark, monkeypatch):
    from pyspark.sql import functions as F
    from priceflow.functions import markup as mk
    monkeypatch.setattr(mk, "_folded_elements", lambda *_: F.array(F.lit("folded")))
    monkeypatch.setattr(mk, "_folded_grandchildren", lambda *_: F.array(F.lit("folded")))
    monkeypatch.setattr(mk, "_closed_by", lambda *_: lambda m: F.lit(False))
    pages = [("<div>a<div>b</div></div><div>c</div>",), ('<div id="r"><div><a>x</a></div><div><a>y</a></div></div>',)]
    out = spark.createDataFrame(pages, "s string").select(
        mk.elements("s", "div").alias("e"), mk.elements("s", "div", keep_tag=True).alias("t"),
        mk.grandchildren("s", '<div id="r">', "div", "a").alias("g")).collect()
    assert out[0].e == ["a<div>b</div>", "c"] and out[0].t == ["<div>a<div>b</div>", "<div>c"]
    assert out[1].g == ["x", "y"]


def test_a_page_is_cut_once_for_its_breadcrumbs(spark, tmp_path):
    from priceflow.plans import catalog
    plan = catalog.breadcrumb_category(spark, small_tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1
