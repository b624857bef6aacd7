"""Registered queries: one per operator of the inventory, plus the flagship.

Each query takes (spark, sf_dir), reads the given tables (through the
fixtures, which derive every input from them), and returns a DataFrame.
``oracle_sql()`` holds the DuckDB statement that must give the same rows;
every computed column has the same alias on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions import labels, price, quantity
from priceflow.functions.text import first_match, first_text, strip_text
from priceflow.operators import crawl_log as cl
from priceflow.operators import extract as ex
from priceflow.operators import frontier as fr
from priceflow.operators import policy
from priceflow.operators.extract import FALABELLA_SITES, JUMBO_SITES, breadcrumbs, card_fields, explode_cards
from priceflow.operators.products import attach_retailer, product_prices
from priceflow.plans import duck as d
from priceflow.plans import oracle as o
from priceflow.sources import fixtures as fx
from priceflow.session import shared_path
from priceflow.sources import sink
from priceflow.sources.snapshots import read_snapshots, write_snapshots

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = (fn, sql)
        return fn
    return deco


def W(body: str, products: bool = False, extra: tuple[str, ...] = ()) -> str:
    blocks = [o.base_ctes()] + ([o.product_ctes()] if products else []) + list(extra)
    return o.with_ctes(*blocks, body=body)


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _QUERIES.items() if v[1] is not None}


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------

ROW_COLUMNS = ["site", "page_id", "chunk", "pos", "status", "reason", "name", "price", "unit_price",
               "total_unit_quantity", "unit_type", "category", "sub_category", "comercial_name",
               "comercial_id", "result_date", "result_time", "country"]
PAGE_KEY = ["page_id", "chunk"]
CARD_KEY = ["page_id", "chunk", "pos"]


def product_rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """All price rows (kept and rejected) of the captured pages."""
    return product_prices(fx.page_snapshot(spark, sf_dir), fx.site_rule(spark), columns or None)


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_fields(explode_cards(fx.page_snapshot(spark, sf_dir)))


def resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = fr.link_present(fx.menu_link(spark, sf_dir))
    return links.withColumn("link_url", fr.resolve_link("url", "href"))


def _cols(*names: str) -> str:
    return ", ".join(names)


# ---------------------------------------------------------------------------
# flagship
# ---------------------------------------------------------------------------

@register("product_price", W("SELECT " + _cols(*ROW_COLUMNS) + " FROM product_rows", products=True))
def product_price(spark, sf_dir):
    """Every card of every captured page as a price row (kept and rejected)."""
    return product_rows(spark, sf_dir).select(*ROW_COLUMNS)


# ---------------------------------------------------------------------------
# S: sources and sinks
# ---------------------------------------------------------------------------

@register("scan_snapshots", W(
    "SELECT page_id, chunk, site, url, category, sub_category, page_number, n_cards,"
    " md5(html) AS html_md5, cast(length(html) AS BIGINT) AS html_chars,"
    " strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS captured FROM page_snapshot"))
def scan_snapshots(spark, sf_dir):
    """Captured pages stored as files, read by the batch reader."""
    path = shared_path(spark, f"snapshots-{uuid.uuid4().hex}")
    write_snapshots(fx.page_snapshot(spark, sf_dir), path)
    s = read_snapshots(spark, path)
    return s.select(*PAGE_KEY, "site", "url", "category", "sub_category", "page_number", "n_cards",
                    F.md5("html").alias("html_md5"), F.length("html").cast("bigint").alias("html_chars"),
                    F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss").alias("captured"))


@register("scan_seeds", W("SELECT site, category, sub_category, part, seq FROM seed"))
def scan_seeds(spark, sf_dir):
    return fx.seed(spark, sf_dir)


HREF = r'href="([^"]*)"'


@register("custom_url_source", W(
    "SELECT page_id, cast(u.i - 1 AS INTEGER) AS url_index, " + d.strip("u.x") + " AS url FROM ("
    " SELECT page_id, unnest(list_transform(string_split(array_to_string("
    + d.all_matches("html", HREF, 1) + ", ' ,'), ','), lambda x, i: struct_pack(i := i, x := x))) AS u"
    " FROM pages)"))
def custom_url_source(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    runs = pages.select("page_id", F.array_join(F.regexp_extract_all("html", F.lit(HREF), 1), " ,")
                        .alias("custom_urls"))
    return fr.custom_url_source(runs).select("page_id", "url_index", "url")


@register("append_country_table", W(
    "SELECT name, price, unit_price, total_unit_quantity, unit_type, category, sub_category,"
    " comercial_name, comercial_id, result_date, result_time, country FROM product_rows"
    " WHERE status <> 'rejected' AND country IS NOT NULL", products=True))
def append_country_table(spark, sf_dir):
    """The rows are appended to a table in shared storage and read back."""
    path = shared_path(spark, f"prices-{uuid.uuid4().hex}")
    sink.append_country_table(product_rows(spark, sf_dir), path)
    return sink.kept_rows(spark, path)


@register("project_sink_row", W(
    "SELECT name, price, unit_price, total_unit_quantity, unit_type, category, sub_category,"
    " comercial_name, comercial_id, result_date, result_time FROM product_rows", products=True))
def project_sink_row(spark, sf_dir):
    return sink.project_sink_row(product_rows(spark, sf_dir))


@register("route_by_country", W(
    "SELECT country, count(*) AS n_rows FROM product_rows WHERE country IS NOT NULL GROUP BY country",
    products=True))
def route_by_country(spark, sf_dir):
    routed, _ = sink.route_by_country(product_rows(spark, sf_dir, "country"))
    return routed.groupBy("country").agg(F.count(F.lit(1)).alias("n_rows"))


@register("isolate_bad_rows", W(
    "SELECT site, page_id, chunk, pos, coalesce(reason, 'no_country') AS reason FROM product_rows"
    " WHERE status = 'rejected' OR country IS NULL", products=True))
def isolate_bad_rows(spark, sf_dir):
    _, bad = sink.isolate_bad_rows(product_rows(spark, sf_dir, "site", *CARD_KEY, "status", "reason", "country"))
    return bad.select("site", *CARD_KEY, "reason")


# ---------------------------------------------------------------------------
# P: projections
# ---------------------------------------------------------------------------

@register("stamp_capture", W(
    "SELECT card_id, strftime(captured_at, '%Y-%m-%d') AS result_date,"
    " strftime(captured_at, '%H:%M:%S') AS result_time FROM cards"))
def stamp_capture(spark, sf_dir):
    c = fx.cards(spark, sf_dir)
    date, time = labels.stamp_capture("captured_at")
    return c.select("card_id", date.alias("result_date"), time.alias("result_time"))


@register("attach_retailer", W(
    "SELECT card_id, site, country, comercial_name, comercial_id FROM cards LEFT JOIN site_rule USING (site)"))
def attach_retailer_q(spark, sf_dir):
    c = fx.cards(spark, sf_dir).select("card_id", "site")
    return attach_retailer(c, fx.site_rule(spark)).select(
        "card_id", "site", "country", "comercial_name", "comercial_id")


_u_cat, _u_sub = d.label_from_url("url")


@register("label_from_url", W(
    f"SELECT page_id, chunk, url, {_u_cat} AS category_label, {_u_sub} AS sub_category_label"
    " FROM page_snapshot"))
def label_from_url(spark, sf_dir):
    s = fx.page_snapshot(spark, sf_dir)
    cat, sub = labels.label_from_url("url")
    return s.select(*PAGE_KEY, "url", cat.alias("category_label"), sub.alias("sub_category_label"))


@register("label_after_marker", W(
    f"SELECT page_id, chunk, url, {d.label_after_marker('url')} AS label FROM page_snapshot"))
def label_after_marker(spark, sf_dir):
    s = fx.page_snapshot(spark, sf_dir)
    return s.select(*PAGE_KEY, "url", labels.label_after_marker("url").alias("label"))


_b_cat, _b_sub = d.breadcrumb_category("crumbs", "url")


@register("breadcrumb_category", W(
    f"SELECT page_id, chunk, {_b_cat} AS category, {_b_sub} AS sub_category FROM ("
    f" SELECT page_id, chunk, url, CASE WHEN site IN ('jumbo', 'jumbocl') THEN {fx.crumb_exprs()}"
    " ELSE []::VARCHAR[] END AS crumbs FROM page_snapshot)"))
def breadcrumb_category(spark, sf_dir):
    """P5 on every page; a page without breadcrumbs falls back to its URL."""
    # a column of its own: the rule names the crumbs many times, and each would cut the page again
    s = fx.page_snapshot(spark, sf_dir).withColumn("crumbs", breadcrumbs("html"))
    cat, sub = labels.breadcrumb_category("crumbs", "url")
    return s.select(*PAGE_KEY, cat.alias("category"), sub.alias("sub_category"))


@register("constant_category", W(
    "SELECT site, page_id, chunk, pos, category, sub_category FROM product_rows", products=True))
def constant_category(spark, sf_dir):
    """Labels of every row; Inkafarma's are the constant ones."""
    columns = ["site", *CARD_KEY, "category", "sub_category"]
    return product_rows(spark, sf_dir, *columns).select(*columns)


@register("compose_name", W(
    f"SELECT card_id, {d.compose_name('CASE WHEN has_name THEN name_text END', 'pres')} AS name FROM cards"))
def compose_name(spark, sf_dir):
    c = fx.cards(spark, sf_dir)
    name = F.when(F.col("has_name"), F.col("name_text"))
    return c.select("card_id", labels.compose_name(name, "pres").alias("name"))


_disp = d.title("regexp_replace(category, '[_-]', ' ', 'g')")
_disp_sub = d.title("regexp_replace(sub_category, '[_-]', ' ', 'g')")


@register("display_name", W(
    f"SELECT seq, {_disp} AS category_display, {_disp_sub} AS sub_category_display FROM seed"))
def display_name(spark, sf_dir):
    s = fx.seed(spark, sf_dir)
    return s.select("seq", labels.display_name("category").alias("category_display"),
                    labels.display_name("sub_category").alias("sub_category_display"))


# ---------------------------------------------------------------------------
# F: filters
# ---------------------------------------------------------------------------

@register("category_allow_list", W(
    "SELECT site, page_id, chunk, pos, category FROM product_rows"
    " WHERE category IN (SELECT upper(category) FROM seed WHERE part = '1')", products=True))
def category_allow_list(spark, sf_dir):
    allowed = fx.seed(spark, sf_dir).where(F.col("part") == "1").select(F.upper("category"))
    return fr.category_allow_list(product_rows(spark, sf_dir, "site", *CARD_KEY, "category"), allowed).select(
        "site", *CARD_KEY, "category")


DENIED_IN_QUERY = "PROMO"


@register("category_deny", W(
    f"SELECT site, page_id, chunk, pos, category FROM product_rows"
    f" WHERE category IS DISTINCT FROM '{DENIED_IN_QUERY}'", products=True))
def category_deny(spark, sf_dir):
    return fr.category_deny(product_rows(spark, sf_dir, "site", *CARD_KEY, "category"), DENIED_IN_QUERY).select(
        "site", *CARD_KEY, "category")


def _deny_sql(text: str) -> str:
    return " AND ".join(f"NOT contains({d.strip(text)}, {d.lit(p)})"
                        for p in rules.CRUZVERDE_CL_DENIED_LINK_TEXTS)


@register("link_text_deny", W(
    f"SELECT page_id, pos, href, text FROM menu_link WHERE {_deny_sql('text')}"))
def link_text_deny(spark, sf_dir):
    return fr.link_text_deny(fx.menu_link(spark, sf_dir)).select("page_id", "pos", "href", "text")


REQUEST_EXPRS = (
    "n_nationkey AS run_id,"
    " CASE n_nationkey % 5 WHEN 0 THEN 'super' WHEN 1 THEN 'supermarket' WHEN 2 THEN 'electro'"
    " WHEN 3 THEN '' ELSE 'zzz' END AS category,"
    " CASE n_regionkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '3' END AS part")


@register("seed_selector", W(
    f"SELECT r.run_id, s.part, s.seq FROM (SELECT {REQUEST_EXPRS} FROM nation) r"
    " JOIN seed s ON ("
    "   (r.category IS NULL OR r.category = '')"
    "   OR (contains('supermarket', r.category) AND r.part = '1' AND s.part = '1')"
    "   OR (contains('supermarket', r.category) AND r.part = '2' AND s.part = '2')"
    "   OR (NOT (contains('supermarket', r.category) AND r.part IN ('1', '2'))"
    "       AND contains('electronic', r.category) AND s.part = 'electro'))"))
def seed_selector(spark, sf_dir):
    """runs (from ``nation``) pick their seed lists."""
    runs = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr(*REQUEST_EXPRS.split(","))
    return fr.seed_selector(runs, fx.seed(spark, sf_dir)).select("run_id", "part", "seq")


SPECIAL_IN_QUERY = "MEDIUM"


@register("special_category_pick", W(
    "SELECT page_id, chunk, cast(l.i - 1 AS INTEGER) AS link_pos, l.u AS link_url,"
    f" {d.lit(rules.CRUZVERDE_SPECIAL_SUB)} AS sub_category FROM ("
    " SELECT page_id, chunk, unnest(list_transform(["
    + ", ".join(d.lit(x) for x in rules.CRUZVERDE_SPECIAL_LINKS)
    + "], lambda u, i: struct_pack(i := i, u := u))) AS l"
    f" FROM page_snapshot WHERE category = '{SPECIAL_IN_QUERY}')"))
def special_category_pick(spark, sf_dir):
    s = fx.page_snapshot(spark, sf_dir)
    return fr.special_category_pick(s, SPECIAL_IN_QUERY).select(
        *PAGE_KEY, "link_pos", "link_url", "sub_category")


@register("missing_field_filter", W(
    "SELECT site, page_id, chunk, pos FROM product_rows WHERE name IS NOT NULL AND price IS NOT NULL",
    products=True))
def missing_field_filter(spark, sf_dir):
    return policy.missing_field_filter(product_rows(spark, sf_dir, "site", *CARD_KEY, "name", "price")).select("site", *CARD_KEY)


@register("link_present", W("SELECT page_id, pos, href FROM menu_link WHERE href IS NOT NULL AND href <> ''"))
def link_present(spark, sf_dir):
    return fr.link_present(fx.menu_link(spark, sf_dir)).select("page_id", "pos", "href")


def _resolve_sql(base: str, href: str) -> str:
    """urljoin, step by step over the parts of both addresses."""
    def part(x, k):
        return f"regexp_extract({x}, {d.lit('(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:[?]([^#]*))?(?:#(.*))?$')}, {k})"

    bs, bh, bp, bq = (part(base, k) for k in (1, 2, 3, 4))
    scheme, host, path, query, frag = (part(f"ltrim({href})", k) for k in (1, 2, 3, 4, 5))
    folder = f"string_split(regexp_replace({bp}, '[^/]+$', ''), '/')"
    below = (f"list_concat(list_filter({folder}, lambda x, i: x <> '' OR i = 1),"
             f" list_filter(string_split({path}, '/'), lambda x, i: x <> '' OR i = len(string_split({path}, '/'))))")
    steps = f"(CASE WHEN starts_with({path}, '/') THEN string_split({path}, '/') ELSE {below} END)"
    kept = (f"list_reduce(list_prepend([]::VARCHAR[], list_transform({steps}, lambda x: [x])), lambda a, b:"
            " CASE b[1] WHEN '..' THEN a[:-2] WHEN '.' THEN a ELSE list_concat(a, b) END)")
    joined = f"array_to_string({kept}, '/') || (CASE WHEN {steps}[-1] IN ('.', '..') THEN '/' ELSE '' END)"
    whole = (f"(CASE WHEN {host} <> '' THEN {path} WHEN {path} = '' THEN {bp}"
             f" ELSE '/' || ltrim({joined}, '/') END)")
    asked = f"(CASE WHEN {host} = '' AND {path} = '' AND {query} = '' THEN {bq} ELSE {query} END)"
    return (f"(CASE WHEN {href} = '' THEN {base} WHEN {scheme} <> '' AND lower({scheme}) <> lower({bs}) THEN {href}"
            f" ELSE lower({bs}) || '://' || (CASE WHEN {host} <> '' THEN {host} ELSE {bh} END) || {whole}"
            f" || (CASE WHEN {asked} <> '' THEN '?' || {asked} ELSE '' END)"
            f" || (CASE WHEN {frag} <> '' THEN '#' || {frag} ELSE '' END) END)")


def _host_sql(url: str) -> str:
    return f"lower(regexp_extract({url}, {d.lit(fr.HOST)}, 1))"


RESOLVED = ("resolved AS (SELECT page_id, site, url, pos, href, text, " + _resolve_sql("url", "href")
            + " AS link_url FROM menu_link WHERE href IS NOT NULL AND href <> '')")


@register("offsite_filter", W(
    "SELECT page_id, pos, link_url FROM resolved JOIN site_rule USING (site) WHERE "
    + _host_sql("link_url") + " = lower(domain) OR ends_with(" + _host_sql("link_url")
    + ", '.' || lower(domain))", extra=(RESOLVED,)))
def offsite_filter(spark, sf_dir):
    """F8: links against the allowed domains of their site (the site table)."""
    kept = fr.offsite_filter(resolved_links(spark, sf_dir), fx.site_rule(spark), "link_url")
    return kept.select("page_id", "pos", "link_url")


# ---------------------------------------------------------------------------
# X: cards and fields
# ---------------------------------------------------------------------------

@register("explode_cards", W(
    "SELECT page_id, chunk, pos, md5(card) AS card_md5, cast(length(card) AS BIGINT) AS card_chars"
    " FROM exploded", products=True))
def explode_cards_q(spark, sf_dir):
    e = explode_cards(fx.page_snapshot(spark, sf_dir))
    return e.select(*CARD_KEY, F.md5("card").alias("card_md5"),
                    F.length("card").cast("bigint").alias("card_chars"))


@register("field_first", W("SELECT page_id, chunk, pos, name_raw FROM fields", products=True))
def field_first(spark, sf_dir):
    return fields(spark, sf_dir).select(*CARD_KEY, "name_raw")


@register("field_last", W(
    "SELECT page_id, chunk, pos, CASE WHEN site IN ('jumbo', 'jumbocl') THEN price_raw END AS price_text"
    " FROM exploded", products=True))
def field_last(spark, sf_dir):
    """X3 on every card: the last text of the selling-price elements."""
    e = explode_cards(fx.page_snapshot(spark, sf_dir))
    texts = ex.selling_price_texts("card")
    return e.select(*CARD_KEY, F.try_element_at(texts, F.lit(-1)).alias("price_text"))


@register("field_attribute", W(
    "SELECT page_id, chunk, pos, CASE WHEN site = 'plaza_vea' THEN price_raw END AS data_price"
    " FROM exploded", products=True))
def field_attribute(spark, sf_dir):
    """X4 on every card: the ``data-price`` attribute ('' when empty)."""
    e = explode_cards(fx.page_snapshot(spark, sf_dir))
    return e.select(*CARD_KEY, ex.plaza_vea_price("card").alias("data_price"))


@register("field_optional", W(
    "SELECT page_id, chunk, pos, coalesce(unit_ref_raw, '') AS unit_reference FROM exploded", products=True))
def field_optional(spark, sf_dir):
    """X5 on every card: an absent unit reference reads as ''."""
    e = explode_cards(fx.page_snapshot(spark, sf_dir))
    ref = strip_text(first_text("card", ex.PLAZA_VEA_UNIT_REFERENCE, 1))
    return e.select(*CARD_KEY, F.coalesce(ref, F.lit("")).alias("unit_reference"))


@register("strip_text", W(
    f"SELECT page_id, chunk, pos, {d.strip('name_raw')} AS name FROM fields", products=True))
def strip_text_q(spark, sf_dir):
    return fields(spark, sf_dir).select(*CARD_KEY, strip_text("name_raw").alias("name"))


# ---------------------------------------------------------------------------
# N: price text -> number
# ---------------------------------------------------------------------------

@register("price_dot_thousands", W(
    f"SELECT card_id, {d.price_dot_thousands(chr(39) + '$ ' + chr(39) + ' || money')} AS price FROM cards"))
def price_dot_thousands(spark, sf_dir):
    c = fx.cards(spark, sf_dir)
    return c.select("card_id", price.price_dot_thousands(F.concat(F.lit("$ "), "money")).alias("price"))


@register("price_dot_thousands_nocomma", W(
    f"SELECT card_id, {d.price_dot_thousands_nocomma(chr(39) + '$ ' + chr(39) + ' || money')} AS price"
    " FROM cards"))
def price_dot_thousands_nocomma(spark, sf_dir):
    c = fx.cards(spark, sf_dir)
    return c.select("card_id", price.price_dot_thousands_nocomma(F.concat(F.lit("$ "), "money"))
                    .alias("price"))


@register("price_digits_only", W(f"SELECT card_id, {d.price_digits_only('pv_price')} AS price FROM cards"))
def price_digits_only(spark, sf_dir):
    c = fx.cards(spark, sf_dir)
    return c.select("card_id", price.price_digits_only("pv_price").alias("price"))


@register("price_min_of_list", W(f"SELECT card_id, {d.price_min_of_list('ink_price')} AS price FROM cards"))
def price_min_of_list(spark, sf_dir):
    c = fx.cards(spark, sf_dir)
    return c.select("card_id", price.price_min_of_list("ink_price").alias("price"))


FB_TEXT = "(CASE WHEN pos = 2 THEN '$ ' || half_money || ' - $ ' || money ELSE '$ ' || money END)"


@register("price_range_upper", W(
    f"SELECT card_id, {FB_TEXT} AS price_text, {d.price_range_upper(FB_TEXT)} AS upper_text FROM cards"))
def price_range_upper(spark, sf_dir):
    c = fx.cards(spark, sf_dir).withColumn("price_text", F.expr(FB_TEXT))
    return c.select("card_id", "price_text", price.price_range_upper("price_text").alias("upper_text"))


FB_SLOTS = (f"CASE WHEN has_price AND slot = 0 THEN {FB_TEXT} END AS normal_text,"
            f" CASE WHEN has_price AND slot <= 1 THEN {FB_TEXT} END AS internet_text,"
            f" CASE WHEN has_price THEN {FB_TEXT} END AS event_text")


@register("price_fallback_chain", W(
    "SELECT card_id, coalesce(nullif(normal_text, ''), nullif(internet_text, ''), nullif(event_text, ''))"
    f" AS price_text FROM (SELECT card_id, {FB_SLOTS} FROM cards)"))
def price_fallback_chain(spark, sf_dir):
    c = fx.cards(spark, sf_dir).selectExpr("card_id", *[x.strip() for x in FB_SLOTS.split(",")])
    return c.select("card_id", price.price_fallback_chain("normal_text", "internet_text", "event_text")
                    .alias("price_text"))


TOTAL_COUNT = r'<div class="[^"]*totalProducts--layout[^"]*"><span>([^<]*)</span>'


@register("count_from_text", W(
    f"SELECT page_id, chunk, count_text, {d.count_from_text('count_text')} AS products FROM ("
    f" SELECT page_id, chunk, {d.first('html', TOTAL_COUNT, 1)} AS count_text FROM page_snapshot)"))
def count_from_text(spark, sf_dir):
    """N7 on every page; a page without a product count reads 0."""
    s = fx.page_snapshot(spark, sf_dir)
    s = s.select(*PAGE_KEY, first_match("html", TOTAL_COUNT, 1).alias("count_text"))
    return s.select(*PAGE_KEY, "count_text", price.count_from_text("count_text").alias("products"))


@register("zero_price", W(
    "SELECT card_id, CASE WHEN p <> 0 THEN p END AS price FROM ("
    f" SELECT card_id, {d.price_dot_thousands_nocomma(chr(39) + '$ ' + chr(39) + ' || money')} AS p FROM cards)"))
def zero_price(spark, sf_dir):
    c = fx.cards(spark, sf_dir)
    p = price.price_dot_thousands_nocomma(F.concat(F.lit("$ "), "money"))
    return c.select("card_id", price.zero_price(p).alias("price"))


# ---------------------------------------------------------------------------
# Q, U: quantity, unit, unit price
# ---------------------------------------------------------------------------

_q1, _u1 = d.qty_unit_last("name_text", rules.UNITS_GENERAL)


@register("quantity_unit_last", W(f"SELECT card_id, {_q1} AS qty, {_u1} AS unit FROM cards"))
def quantity_unit_last(spark, sf_dir):
    q, u = quantity.quantity_unit_last("name_text", rules.UNITS_GENERAL)
    return fx.cards(spark, sf_dir).select("card_id", q.alias("qty"), u.alias("unit"))


@register("pack_multiplier", W(
    f"SELECT card_id, {d.pack_multiplier('name_text', rules.PACK_PATTERN_JUMBO)} AS pack_jumbo,"
    f" {d.pack_multiplier('name_text', rules.PACK_PATTERN_CRUZVERDE)} AS pack_cruzverde FROM cards"))
def pack_multiplier(spark, sf_dir):
    return fx.cards(spark, sf_dir).select(
        "card_id", quantity.pack_multiplier("name_text", rules.PACK_PATTERN_JUMBO).alias("pack_jumbo"),
        quantity.pack_multiplier("name_text", rules.PACK_PATTERN_CRUZVERDE).alias("pack_cruzverde"))


@register("quantity_default", W(
    f"SELECT card_id, coalesce({_q1}, 1.0) AS qty,"
    f" CASE WHEN {_q1} IS NOT NULL THEN {_u1} ELSE 'un' END AS unit FROM cards"))
def quantity_default(spark, sf_dir):
    q, u = quantity.quantity_unit_last("name_text", rules.UNITS_GENERAL)
    q, u = quantity.quantity_default(q, u)
    return fx.cards(spark, sf_dir).select("card_id", q.alias("qty"), u.alias("unit"))


_pf, _pq, _pu = d.presentation_first("pres")


@register("presentation_first", W(f"SELECT card_id, {_pf} AS found, {_pq} AS qty, {_pu} AS unit FROM cards"))
def presentation_first(spark, sf_dir):
    f, q, u = quantity.presentation_first("pres")
    return fx.cards(spark, sf_dir).select("card_id", f.alias("found"), q.alias("qty"), u.alias("unit"))


_rq, _ru = d.qty_with_reference("name_text", "unit_ref")


@register("quantity_with_reference", W(f"SELECT card_id, {_rq} AS qty, {_ru} AS unit FROM cards"))
def quantity_with_reference(spark, sf_dir):
    q, u = quantity.quantity_with_reference("name_text", "unit_ref")
    return fx.cards(spark, sf_dir).select("card_id", q.alias("qty"), u.alias("unit"))


@register("unit_synonyms", W(
    f"SELECT card_id, unit, {d.unit_synonyms('unit')} AS unit_normalized FROM"
    f" (SELECT card_id, {_ru} AS unit FROM cards) WHERE unit IS NOT NULL"))
def unit_synonyms(spark, sf_dir):
    _, u = quantity.quantity_with_reference("name_text", "unit_ref")
    c = fx.cards(spark, sf_dir).select("card_id", u.alias("unit")).where(F.col("unit").isNotNull())
    return c.select("card_id", "unit", quantity.unit_synonyms("unit").alias("unit_normalized"))


@register("unit_case", W(
    f"SELECT card_id, {_u1} AS unit_keep, lower({_u1}) AS unit_lower,"
    f" lower({d.strip(_u1)}) AS unit_strip_lower FROM cards"))
def unit_case(spark, sf_dir):
    _, u = quantity.quantity_unit_last("name_text", rules.UNITS_GENERAL)
    return fx.cards(spark, sf_dir).select(
        "card_id", quantity.unit_case(u, "keep").alias("unit_keep"),
        quantity.unit_case(u, "lower").alias("unit_lower"),
        quantity.unit_case(u, "strip_lower").alias("unit_strip_lower"))


_qty_default = f"coalesce({_q1}, 1.0)"


@register("unit_price_ratio", W(
    f"SELECT card_id, {d.ratio('cast(ip AS DOUBLE)', _qty_default)} AS unit_price FROM cards"))
def unit_price_ratio(spark, sf_dir):
    q, _ = quantity.quantity_unit_last("name_text", rules.UNITS_GENERAL)
    q = F.coalesce(q, F.lit(1.0))
    return fx.cards(spark, sf_dir).select(
        "card_id", quantity.unit_price_ratio(F.col("ip").cast("double"), q).alias("unit_price"))


@register("unit_price_published", W(
    f"SELECT card_id, {d.published('upt', d.ratio('cast(ip AS DOUBLE)', _qty_default))} AS unit_price"
    " FROM cards"))
def unit_price_published(spark, sf_dir):
    q, _ = quantity.quantity_unit_last("name_text", rules.UNITS_GENERAL)
    ratio = quantity.unit_price_ratio(F.col("ip").cast("double"), F.coalesce(q, F.lit(1.0)))
    return fx.cards(spark, sf_dir).select(
        "card_id", quantity.unit_price_published("upt", ratio).alias("unit_price"))


@register("unit_price_rounded", W(
    f"SELECT card_id, {d.unit_price_rounded(d.price_min_of_list('ink_price'), _pq, _pf)} AS unit_price"
    " FROM cards"))
def unit_price_rounded(spark, sf_dir):
    f, q, _ = quantity.presentation_first("pres")
    p = price.price_min_of_list("ink_price")
    return fx.cards(spark, sf_dir).select(
        "card_id", quantity.unit_price_rounded(p, q, f).alias("unit_price"))


_kp, _kq, _ku = d.unit_price_by_kind("p", "q", "u")


@register("unit_price_by_kind", W(
    f"SELECT card_id, {_kp} AS unit_price, {_kq} AS qty, {_ku} AS unit FROM ("
    f" SELECT card_id, {d.price_digits_only('pv_price')} AS p, {_rq} AS q, {_ru} AS u FROM cards)"))
def unit_price_by_kind(spark, sf_dir):
    q, u = quantity.quantity_with_reference("name_text", "unit_ref")
    c = fx.cards(spark, sf_dir).select("card_id", price.price_digits_only("pv_price").alias("p"),
                                       q.alias("q"), u.alias("u"))
    up, qq, uu = quantity.unit_price_by_kind("p", "q", "u")
    return c.select("card_id", up.alias("unit_price"), qq.alias("qty"), uu.alias("unit"))


# ---------------------------------------------------------------------------
# C: crawl frontier and crawl log
# ---------------------------------------------------------------------------

PLAZA_VEA_BASE = "https://www.plazavea.com.pe"


@register("expand_seed_urls", W(
    f"SELECT seq, '{PLAZA_VEA_BASE}' || '/' || category || '/' || sub_category AS url FROM seed"))
def expand_seed_urls(spark, sf_dir):
    return fr.expand_seed_urls(fx.seed(spark, sf_dir), PLAZA_VEA_BASE).select("seq", "url")


@register("union_seed_lists", W(
    "SELECT CASE part WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE 2 END AS list_no, seq, category, sub_category"
    " FROM seed WHERE part IN ('1', '2', 'electro')"))
def union_seed_lists(spark, sf_dir):
    return fr.union_seed_lists(fx.seed(spark, sf_dir)).select("list_no", "seq", "category", "sub_category")


@register("number_requests", W(
    "SELECT site, request_index, url || '?scrapy_index=' || cast(request_index AS VARCHAR) || '&ts=0'"
    " AS request_url FROM (SELECT site, row_number() OVER (PARTITION BY site ORDER BY"
    " CASE part WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE 2 END, seq) - 1 AS request_index,"
    f" '{PLAZA_VEA_BASE}' || '/' || category || '/' || sub_category AS url FROM seed)"))
def number_requests(spark, sf_dir):
    seeds = fr.expand_seed_urls(fr.union_seed_lists(fx.seed(spark, sf_dir)), PLAZA_VEA_BASE)
    return fr.number_requests(seeds, ["site"], ["list_no", "seq"], 0).select(
        "site", "request_index", "request_url")


@register("resolve_links", W(
    "SELECT page_id, pos, link_url FROM resolved", extra=(RESOLVED,)))
def resolve_links(spark, sf_dir):
    return resolved_links(spark, sf_dir).select("page_id", "pos", "link_url")


@register("menu_links", W(
    "SELECT page_id, category, sub_category, cast(pos AS INTEGER) AS pos, nullif(href, '') AS href, text"
    " FROM menu_grouped"))
def menu_links(spark, sf_dir):
    """The links of every menu page under their category and sub-category."""
    links = fr.menu_groups(fx.menu_page(spark, sf_dir), fr.FALABELLA_MENU)
    return links.select("page_id", "category", "sub_category", "pos", "href", "text")


# dictionary order, in SQL: the last naming's links at the first naming's place
MENU_TREE = ("named AS (SELECT page_id, category, sub_category, c_at, g_at, pos, " + _resolve_sql("url", "href")
             + " AS url FROM menu_grouped WHERE href <> ''),"
             " open_ AS (SELECT page_id, category, min(c_at) AS category_place, max(c_at) AS c_at FROM named GROUP BY ALL),"
             " kept AS (SELECT * FROM named JOIN open_ USING (page_id, category, c_at)),"
             " subs AS (SELECT page_id, category, sub_category, min(g_at) AS place, max(g_at) AS g_at FROM kept GROUP BY ALL),"
             " tree AS (SELECT * FROM kept JOIN subs USING (page_id, category, sub_category, g_at))")


def menu_tree_rows(spark, sf_dir):
    links = fr.link_present(fr.menu_groups(fx.menu_page(spark, sf_dir), fr.FALABELLA_MENU))
    links = links.select("page_id", "category", "category_pos", "sub_category", "group_pos", "pos",
                         fr.resolve_link("url", "href").alias("url"))
    return fr.menu_tree(links, ["page_id"])


@register("menu_tree", W(
    "SELECT page_id, category, sub_category, cast(pos AS INTEGER) AS pos, url FROM tree", extra=(MENU_TREE,)))
def menu_tree(spark, sf_dir):
    return menu_tree_rows(spark, sf_dir).select("page_id", "category", "sub_category", "pos", "url")


@register("menu_flatten", W(
    "SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY category_place, place, pos) - 1"
    " AS request_index, category, sub_category, url FROM tree", extra=(MENU_TREE,)))
def menu_flatten(spark, sf_dir):
    flat = fr.menu_flatten(menu_tree_rows(spark, sf_dir), ["page_id"])
    return flat.select("page_id", "request_index", "category", "sub_category", "url")


_deny_t = _deny_sql("text")


@register("last_child_label", W(
    "SELECT l.page_id, cast(l.pos AS INTEGER) AS pos,"
    f" CASE WHEN s.n_links > 1 THEN s.last_text ELSE s.first_text END AS label, l.href FROM menu_link l"
    f" JOIN (SELECT page_id, arg_max({d.strip('text')}, pos) AS last_text,"
    f" arg_min({d.strip('text')}, pos) AS first_text, count(*) AS n_links FROM menu_link GROUP BY page_id) s"
    " ON l.page_id = s.page_id"
    f" WHERE ((s.n_links > 1 AND l.pos > 1 AND {_deny_t}) OR s.n_links = 1)"
    " AND l.href IS NOT NULL AND l.href <> ''"))
def last_child_label(spark, sf_dir):
    out = fr.last_child_label(fx.menu_link(spark, sf_dir))
    return out.select("page_id", "pos", "label", "href")


@register("route_by_size", W(
    f"SELECT page_id, chunk, products, CASE WHEN products > {rules.DISCOVER_THRESHOLD} THEN 'discover'"
    " ELSE 'direct' END AS route FROM ("
    f" SELECT page_id, chunk, {d.count_from_text(d.first('html', TOTAL_COUNT, 1))} AS products"
    " FROM page_snapshot)"))
def route_by_size(spark, sf_dir):
    c = count_from_text(spark, sf_dir)
    return c.select(*PAGE_KEY, "products", fr.route_by_size("products").alias("route"))


@register("stop_on_empty_pages", W(f"""
SELECT site, category, last_page, cast(CASE WHEN by_run THEN first_end ELSE lim END AS INTEGER) AS stop_page,
       CASE WHEN by_run THEN 'empty_pages' WHEN last_page > {rules.MAX_PAGES} THEN 'max_pages'
            ELSE 'last_page' END AS stop_reason
FROM (
  SELECT site, category, max(page_number) AS last_page, least(max(page_number), {rules.MAX_PAGES}) AS lim,
         min(CASE WHEN run_len >= {rules.MAX_CONSECUTIVE_EMPTY} THEN page_number END) AS first_end,
         coalesce(min(CASE WHEN run_len >= {rules.MAX_CONSECUTIVE_EMPTY} THEN page_number END)
                  <= least(max(page_number), {rules.MAX_PAGES}), false) AS by_run
  FROM (
    SELECT *, CASE WHEN products_found = 0
                   THEN row_number() OVER (PARTITION BY site, category, products_found = 0, grp
                                           ORDER BY page_number) END AS run_len
    FROM (SELECT *, page_number - row_number() OVER (PARTITION BY site, category, products_found = 0
                                                     ORDER BY page_number) AS grp
          FROM crawl_log))
  GROUP BY site, category)"""))
def stop_on_empty_pages(spark, sf_dir):
    return cl.stop_on_empty_pages(fx.crawl_log(spark, sf_dir))


@register("category_summary", W(
    "SELECT site, category, sub_category,"
    " cast(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS valid_products,"
    " count(*) AS cards, count(DISTINCT (page_id, chunk)) AS pages, max(page_number) AS max_page"
    " FROM product_rows GROUP BY site, category, sub_category", products=True))
def category_summary(spark, sf_dir):
    return cl.category_summary(product_rows(
        spark, sf_dir, "site", "category", "sub_category", "status", *PAGE_KEY, "page_number"))


@register("running_total", W(
    "SELECT site, category, page_number, products_found, cast(sum(products_found) OVER ("
    " PARTITION BY site, category ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    " AS BIGINT) AS running_total FROM crawl_log"))
def running_total(spark, sf_dir):
    return cl.numbered_running_total(fx.crawl_visits(spark, sf_dir)).select(
        "site", "category", "page_number", "products_found", "running_total")


_paged, _last_page = fx.pager_exprs()


@register("next_page", W(
    "SELECT page_id, chunk, current_page, last_page,"
    " CASE WHEN current_page < last_page THEN current_page + 1 END AS next_page FROM ("
    f" SELECT page_id, chunk, CASE WHEN {_paged} THEN page_number END AS current_page,"
    f" CASE WHEN {_paged} THEN cast({_last_page} AS INTEGER) END AS last_page FROM page_snapshot)"))
def next_page(spark, sf_dir):
    """C13 on every page; a page without a pager has no next page."""
    s = fx.page_snapshot(spark, sf_dir)
    cur, last, nxt = cl.next_page("html")
    return s.select(*PAGE_KEY, cur.alias("current_page"), last.alias("last_page"), nxt.alias("next_page"))


@register("page_advance_check", W(
    "SELECT c.site, c.category, c.page_number, p.active_page + 1 AS expected_page, c.active_page,"
    " c.active_page = p.active_page + 1 AS moved_ok FROM crawl_log c JOIN crawl_log p"
    " ON c.site = p.site AND c.category = p.category AND c.page_number = p.page_number + 1"))
def page_advance_check(spark, sf_dir):
    return cl.page_advance_check(fx.crawl_log(spark, sf_dir))


_f_cat, _f_sub = d.label_from_url("url")
_timeout = f"contains(error_type, {d.lit(rules.TIMEOUT_ERROR_MARK)})"
_retry = f"({_timeout} AND retry_count < {rules.MAX_TIMEOUT_RETRIES})"


@register("classify_failures", W(
    f"SELECT request_id, CASE WHEN {_retry} THEN 'retry' WHEN {_timeout} THEN 'gave_up' ELSE 'error' END"
    f" AS outcome, CASE WHEN {_retry} THEN retry_count + 1 END AS next_retry_count,"
    f" CASE WHEN {_retry} THEN {rules.RETRY_TIMEOUT_MS} END AS next_timeout_ms,"
    f" CASE WHEN len(string_split(url, '/')) >= 2 THEN {_f_cat} ELSE 'Unknown' END AS category_label,"
    f" CASE WHEN len(string_split(url, '/')) >= 2 THEN {_f_sub} ELSE 'Unknown' END AS sub_category_label"
    " FROM request_log"))
def classify_failures(spark, sf_dir):
    return cl.classify_failures(fx.request_log(spark, sf_dir)).select(
        "request_id", "outcome", "next_retry_count", "next_timeout_ms", "category_label",
        "sub_category_label")


# ---------------------------------------------------------------------------
# D, R, L: distinct, row policy, limit
# ---------------------------------------------------------------------------

@register("distinct_links", W(
    f"SELECT DISTINCT {_host_sql('url')} AS site, link_url AS url FROM resolved", extra=(RESOLVED,)))
def distinct_links(spark, sf_dir):
    links = resolved_links(spark, sf_dir).select(fr.url_host("url").alias("site"),
                                                 F.col("link_url").alias("url"))
    return fr.distinct_links(links)


_dedup = ", ".join(policy.DEDUP_KEYS)


@register("dedup_rows", W(
    f"SELECT {_dedup}, page_id, chunk, pos, copies FROM ("
    f" SELECT *, row_number() OVER w AS nth, count(*) OVER (PARTITION BY {_dedup}, alone) AS copies FROM ("
    "  SELECT *, CASE WHEN name IS NULL THEN page_id || '/' || chunk || '/' || pos END AS alone"
    "  FROM product_rows WHERE status <> 'rejected')"
    f" WINDOW w AS (PARTITION BY {_dedup}, alone ORDER BY page_id, chunk, pos)) WHERE nth = 1", products=True))
def dedup_rows(spark, sf_dir):
    rows = product_rows(spark, sf_dir, *policy.DEDUP_KEYS, *CARD_KEY, "status")
    rows = rows.where(F.col("status") != "rejected").drop("status")
    return policy.dedup_rows(rows).select(*policy.DEDUP_KEYS, *CARD_KEY, "copies")


@register("row_policy", W(
    "SELECT site, status, reason, count(*) AS cards FROM product_rows GROUP BY site, status, reason",
    products=True))
def row_policy(spark, sf_dir):
    return policy.row_policy_summary(product_rows(spark, sf_dir, "site", "status", "reason"))


LIMIT_N = 500


@register("limit_items", W(
    "SELECT site, page_id, chunk, pos, name, price FROM product_rows WHERE status <> 'rejected'"
    f" ORDER BY site, page_id, chunk, pos LIMIT {LIMIT_N}", products=True))
def limit_items(spark, sf_dir):
    rows = product_rows(spark, sf_dir, "site", *CARD_KEY, "name", "price", "status").where(
        F.col("status") != "rejected")
    return policy.limit_items(rows, LIMIT_N).select("site", *CARD_KEY, "name", "price")


# ---------------------------------------------------------------------------
# T: streaming
# ---------------------------------------------------------------------------

@register("stream_append", _QUERIES["append_country_table"][1])
def stream_append(spark, sf_dir):
    """The snapshots arrive as files; a Structured Streaming query
    (availableNow) appends the kept rows to the country-partitioned sink.
    Must equal the batch sink frame."""
    from priceflow.streaming.stream import stream_append as run
    return sink.kept_rows(spark, run(spark, fx.page_snapshot(spark, sf_dir), fx.site_rule(spark)))
