"""DuckDB SQL for the oracle check.

The driver registers the given tables as views (``lineitem``, ``part``,
``pages``, ``events`` ...).  Every statement here first rebuilds the same
inputs as ``priceflow.sources.fixtures`` (rendered for DuckDB), then does
the query's work in plain SQL.
"""

from __future__ import annotations

from priceflow import rules
from priceflow.plans import duck as d
from priceflow.sources import fixtures as fx

DD = fx.Dialect("duckdb")


def _sel(exprs: list[tuple[str, str]], star: bool = False) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in exprs)
    return ("*, " + cols) if star else cols


def site_rule_values() -> str:
    rows = ", ".join(
        "(" + ", ".join(d.lit(v) for v in (r[0], r[1], r[2], r[3], r[4], rules.ROW_POLICY[r[0]])) + ")"
        for r in rules.SITE_TABLE)
    return (f"SELECT * FROM (VALUES {rows}) AS t(site, country, comercial_name, comercial_id, "
            f"domain, row_policy)")


def base_ctes() -> str:
    """cards, page_snapshot, crawl_log, request_log, menu_link, seed, site_rule."""
    return f"""
cards_num AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(fx.LINE_ORDER)}) AS seq
              FROM lineitem JOIN part ON l_partkey = p_partkey),
cards_base AS (SELECT {_sel(fx.card_base_exprs(DD))} FROM cards_num),
cards_text AS (SELECT {_sel(fx.card_text_exprs(DD), star=True)} FROM cards_base),
cards_inner AS (SELECT *, {fx.card_inner_expr(DD)} AS card_inner FROM cards_text),
cards AS (SELECT *, {fx.card_html_expr(DD)} AS card_html FROM cards_inner),
pages_grouped AS (
  SELECT page_id, chunk, site, arg_min(p_type, pos) AS category, arg_min(p_brand, pos) AS sub_category,
         min(captured_at) AS captured_at, sum(ip) AS total, count(*) AS n_cards,
         string_agg(card_html, '' ORDER BY pos) AS cards
  FROM cards GROUP BY page_id, chunk, site),
page_snapshot AS (SELECT {_sel(fx.page_exprs(DD))} FROM pages_grouped),
crawl_base AS (SELECT {_sel(fx.crawl_log_exprs(DD))} FROM events),
crawl_log AS (
  SELECT *, cast(page_number + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS active_page
  FROM (SELECT *, cast(row_number() OVER (PARTITION BY site, category ORDER BY visited_at, event_id) AS INTEGER)
               AS page_number FROM crawl_base)),
request_log AS (SELECT {_sel(fx.request_log_exprs(DD))} FROM events WHERE event_type = 'error'),
menu_raw AS (
  SELECT page_id, url, cast(m.pos AS INTEGER) AS pos, {d.decode("m.href")} AS href, {d.decode("m.text")} AS text FROM (
    SELECT page_id, url, unnest(list_transform(
        {d.all_matches('html', fx.MENU_LINK_PATTERN, 1)},
        lambda h, i: struct_pack(pos := i, href := h,
                                 text := {d.all_matches('html', fx.MENU_LINK_PATTERN, 2)}[i]))) AS m
    FROM pages)),
menu_link AS (SELECT {_sel(fx.menu_link_exprs(DD))} FROM menu_raw),
menu_marked AS (
  SELECT page_id, url, pos, CASE WHEN {fx.MENU_BLANK} THEN '' ELSE href END AS href, text,
         max(CASE WHEN {fx.MENU_CATEGORY_STARTS} THEN pos END) OVER w AS c_at,
         max(CASE WHEN {fx.MENU_GROUP_STARTS} THEN pos END) OVER w AS g_at
  FROM (SELECT *, pos AS i FROM menu_raw) WINDOW w AS (PARTITION BY page_id ORDER BY pos)),
menu_grouped AS (
  SELECT page_id, url, pos, href, text, 'Cat & ' || cast((page_id + c_at) % 2 AS VARCHAR) AS category,
         'Sub & ' || cast((page_id + g_at) % 3 AS VARCHAR) AS sub_category, c_at, g_at FROM menu_marked),
seed AS (SELECT {_sel(fx.seed_exprs(DD))} FROM part),
site_rule AS ({site_rule_values()})"""


def product_ctes() -> str:
    """page_snapshot -> exploded cards -> fields -> parsed -> product rows."""
    f = fx.card_field_exprs()  # what the page's maker put in, not what a parser finds
    q_gen, u_gen = d.qty_unit_last("name", rules.UNITS_GENERAL)
    q_cv, u_cv = d.qty_unit_last("name", rules.UNITS_CRUZVERDE_CO, lower_input=True)
    q_cl, u_cl = d.qty_unit_last("name", rules.UNITS_CRUZVERDE_CL)
    ink_found, q_ink, u_ink = d.presentation_first("presentation")
    q_pv, u_pv = d.qty_with_reference("name", "unit_ref")
    J, FB = ("jumbo", "jumbocl"), ("falabella", "falabellacol")
    q1 = d.case_site({J: q_gen, FB: q_gen, "cruzverde": q_cv, "cruzverdecl": q_cl,
                      "inkafarma": q_ink, "plaza_vea": q_pv})
    u1 = d.case_site({J: u_gen, FB: u_gen, "cruzverde": u_cv, "cruzverdecl": u_cl,
                      "inkafarma": u_ink, "plaza_vea": u_pv})
    pack = d.case_site({J: d.pack_multiplier("name", rules.PACK_PATTERN_JUMBO),
                        "cruzverde": d.pack_multiplier("name", rules.PACK_PATTERN_CRUZVERDE)})
    price = d.case_site({
        J: d.price_dot_thousands("price_text"),
        "cruzverde": d.price_dot_thousands("price_text", digits_only=True),
        "cruzverdecl": d.price_dot_thousands_nocomma("price_text"),
        "falabella": d.price_dot_thousands_nocomma("price_text"),
        "falabellacol": d.price_dot_thousands_nocomma(d.price_range_upper("price_text")),
        "plaza_vea": d.price_digits_only("price_raw"),
        "inkafarma": d.price_min_of_list("coalesce(price_text, '0')"),
    })
    qty = "coalesce(q1, pack, 1.0)"
    unit = d.case_site({FB: "lower(u1)", "cruzverdecl": f"lower({d.strip('u1')})", "inkafarma": "u1"}, "u1")
    unit = f"(CASE WHEN q1 IS NOT NULL THEN {unit} ELSE {d.lit(rules.DEFAULT_UNIT)} END)"
    ratio = d.ratio("price", qty)
    published = d.published("unit_price_raw", ratio)
    pv_up, pv_q, pv_u = d.unit_price_by_kind("price", "q1", "u1")
    unit_price = d.case_site({
        J: f"(CASE WHEN price IS NOT NULL THEN {published} END)",
        "cruzverde": published, FB: ratio, "cruzverdecl": ratio, "plaza_vea": pv_up,
        "inkafarma": d.unit_price_rounded("price", "q1", "q1 IS NOT NULL"),
    })

    def first_failure(*checks):
        return "(CASE " + " ".join(f"WHEN {c} THEN {d.lit(r)}" for c, r in checks) + " END)"

    no_name, no_price = "name_raw IS NULL", "price_raw IS NULL"
    bad_price, bad_ratio = "price IS NULL", "unit_price IS NULL"
    drop_order = ((no_name, "no_name"), (no_price, "no_price"), (bad_price, "bad_price"),
                  (bad_ratio, "bad_unit_price"))
    reason = d.case_site({
        J: first_failure(*drop_order), "cruzverde": first_failure(*drop_order),
        "cruzverdecl": first_failure((f"NOT ({no_price}) AND {bad_price}", "bad_price"),
                                     (no_name, "no_name"), (no_price, "no_price"),
                                     (bad_ratio, "bad_unit_price")),
        FB: first_failure((no_price, "no_price"), (bad_price, "bad_price"), (no_name, "no_name"),
                          ("price = 0", "zero_price"), (bad_ratio, "bad_unit_price")),
        "plaza_vea": first_failure(*drop_order[:3]),
    })
    jcat, jsub = d.breadcrumb_category("crumbs", "url")
    ucat, usub = d.label_from_url("url")
    category = d.case_site({J: jcat, "plaza_vea": ucat, "inkafarma": d.lit(rules.INKAFARMA_CATEGORY)},
                           "category")
    sub_category = d.case_site({J: jsub, "plaza_vea": usub, "inkafarma": "NULL"}, "sub_category")
    j_no_name = "(site IN ('jumbo', 'jumbocl') AND reason = 'no_name')"
    j_no_price = "(site IN ('jumbo', 'jumbocl') AND reason IN ('no_price', 'bad_price'))"

    def unless(cond, c):
        return f"(CASE WHEN {cond} THEN NULL ELSE {c} END)"

    return f"""
crumbed AS (SELECT *, CASE WHEN site IN ('jumbo', 'jumbocl') THEN {fx.crumb_exprs()} ELSE []::VARCHAR[] END AS crumbs
            FROM page_snapshot),
exploded AS (
  SELECT p.page_id, p.chunk, p.site, p.url, p.category, p.sub_category, p.page_number, p.captured_at, p.n_cards,
         p.crumbs, c.pos, c.card_inner AS card, {", ".join(f"c.{k}" for k in f)}
  FROM (SELECT page_id, chunk, pos, card_inner, {", ".join(f"{v} AS {k}" for k, v in f.items())} FROM cards) c
  JOIN crumbed p ON c.page_id = p.page_id AND c.chunk = p.chunk),
fields AS (SELECT * EXCLUDE (card) FROM exploded),
texts AS (SELECT *, {d.strip('name_raw')} AS name, {d.strip('price_raw')} AS price_text,
                 coalesce({d.strip('presentation_raw')}, '') AS presentation,
                 coalesce({d.strip('unit_ref_raw')}, '') AS unit_ref FROM fields),
numbers AS (SELECT *, {q1} AS q1, {u1} AS u1, {pack} AS pack, {price} AS price FROM texts),
priced AS (SELECT *, {unit_price} AS unit_price,
                  {d.case_site({"plaza_vea": pv_q}, qty)} AS total_unit_quantity,
                  {d.case_site({"plaza_vea": pv_u}, unit)} AS unit_type FROM numbers),
policy AS (SELECT *, {reason} AS reason FROM priced),
parsed AS (SELECT *, CASE WHEN reason IS NULL THEN 'ok' WHEN site IN ('jumbo', 'jumbocl') THEN 'partial'
                          ELSE 'rejected' END AS status FROM policy),
labelled AS (SELECT * EXCLUDE (category, sub_category), {category} AS category,
                    {sub_category} AS sub_category FROM parsed),
product_rows AS (
  SELECT site, page_id, chunk, pos, page_number, status, reason,
         CASE WHEN site = 'inkafarma' THEN {d.compose_name('name', 'presentation')} ELSE name END AS name,
         {unless(f"{j_no_name} OR {j_no_price}", "price")} AS price,
         {unless(j_no_name, "unit_price")} AS unit_price,
         {unless(j_no_name, "total_unit_quantity")} AS total_unit_quantity,
         {unless(j_no_name, "unit_type")} AS unit_type,
         {unless(j_no_name, "category")} AS category,
         {unless(j_no_name, "sub_category")} AS sub_category,
         {unless(j_no_name, "r.comercial_name")} AS comercial_name,
         {unless(j_no_name, "r.comercial_id")} AS comercial_id,
         strftime(captured_at, '%Y-%m-%d') AS result_date, strftime(captured_at, '%H:%M:%S') AS result_time,
         r.country AS country
  FROM labelled l LEFT JOIN site_rule r USING (site))"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",".join(blocks) + "\n" + body
