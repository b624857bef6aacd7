"""Card fields -> price rows, per site.

Each output column is one CASE over the site, built from the rule tables,
so all eight sites go through a single projection: no union of eight scans,
no shuffle.  Row policy (R1) follows the site:

* drop     - a card without name or usable price is rejected
             (Plaza Vea, Falabella, Cruz Verde; the Colombian Cruz Verde
             spider stops the whole process there, we only drop the card)
* partial  - Jumbo keeps the row; the fields after the one that failed are
             NULL, in the spider's order name -> quantity -> labels ->
             retailer -> price -> unit price
* zero     - Inkafarma never rejects: no price reads as 0.0

``status`` is 'ok', 'partial' or 'rejected'; ``reason`` says why.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions import labels, price, quantity
from priceflow.functions.text import slug_to_label, strip_text
from priceflow.operators.extract import FALABELLA_SITES, JUMBO_SITES, by_site

PRODUCT_COLUMNS = ["name", "price", "unit_price", "total_unit_quantity", "unit_type",
                   "category", "sub_category", "comercial_name", "comercial_id",
                   "result_date", "result_time"]


def _first_failure(*checks: tuple[Column, str]) -> Column:
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def parse_cards(fields: DataFrame) -> DataFrame:
    """Parse raw field texts into name, price, quantity, unit and unit price.

    Done in stages (clean texts -> numbers -> unit price -> policy), each a
    projection over the previous one's columns, so every regular expression
    runs once per card and each stage fits whole-stage code generation (a generated
    method of more than 8,000 bytes is never compiled by the JVM).
    """
    site = F.col("site")

    # -- stage 1: cleaned texts ------------------------------------------------
    texts = fields.select(
        "*",
        strip_text("name_raw").alias("name"),
        strip_text("price_raw").alias("price_text"),
        F.coalesce(strip_text(F.col("presentation_raw")), F.lit("")).alias("presentation"),
        F.coalesce(strip_text(F.col("unit_ref_raw")), F.lit("")).alias("unit_ref"))
    name, raw_price = F.col("name"), F.col("price_text")

    # -- stage 2: the quantity as one text (one scan of the name), then its parts
    # (Q1-Q7) and the price
    units = {JUMBO_SITES: rules.UNITS_GENERAL, FALABELLA_SITES: rules.UNITS_GENERAL,
             "cruzverde": rules.UNITS_CRUZVERDE_CO, "cruzverdecl": rules.UNITS_CRUZVERDE_CL}
    hits = {s: quantity.quantity_unit_text(name, u, lower_input=s == "cruzverde") for s, u in units.items()}
    hits["plaza_vea"] = quantity.reference_text(name, F.col("unit_ref"))
    texts = texts.withColumn("hit", by_site(site, hits))
    parts = {s: quantity.split_quantity("hit", quantity.qty_unit_pattern(u)) for s, u in units.items()}
    parts["plaza_vea"] = quantity.split_quantity("hit", quantity.REFERENCE_PATTERN)
    ink_found, q_ink, u_ink = quantity.presentation_first(F.col("presentation"))
    parts["inkafarma"] = (q_ink, u_ink)
    q1 = by_site(site, {s: q for s, (q, _) in parts.items()})
    u1 = by_site(site, {s: u for s, (_, u) in parts.items()})
    pack = by_site(site, {JUMBO_SITES: quantity.pack_multiplier(name, rules.PACK_PATTERN_JUMBO),
                          "cruzverde": quantity.pack_multiplier(name, rules.PACK_PATTERN_CRUZVERDE)})
    parsed_price = by_site(site, {
        JUMBO_SITES: price.price_dot_thousands(raw_price),
        "cruzverde": price.price_dot_thousands(raw_price, digits_only=True),
        "cruzverdecl": price.price_dot_thousands_nocomma(raw_price),
        "falabella": price.price_dot_thousands_nocomma(raw_price),
        "falabellacol": price.price_dot_thousands_nocomma(price.price_range_upper(raw_price)),
        "plaza_vea": price.price_digits_only(F.col("price_raw")),
        "inkafarma": price.price_min_of_list(F.coalesce(raw_price, F.lit("0"))),
    })
    numbers = texts.select("*", q1.alias("q1"), u1.alias("u1"), pack.alias("pack"),
                           parsed_price.alias("price"))
    # Plaza Vea's kind of unit, which its unit price asks for many times
    u1_col = F.col("u1")
    numbers = numbers.withColumns({
        "tray": F.when(site == "plaza_vea", F.lower(u1_col) == "bandeja"),
        "unit_kind": F.when(site == "plaza_vea", quantity.unit_synonyms(u1_col))})

    # -- stage 3: default quantity, unit case, unit price (U1-U4) -------------
    p, q1c, u1c, packc = F.col("price"), F.col("q1"), F.col("u1"), F.col("pack")
    found = q1c.isNotNull()
    qty = F.coalesce(q1c, packc, F.lit(1.0))
    unit = by_site(site, {
        FALABELLA_SITES: quantity.unit_case(u1c, "lower"),
        "cruzverdecl": quantity.unit_case(u1c, "strip_lower"),
    }, u1c)
    unit = F.when(found, unit).otherwise(F.lit(rules.DEFAULT_UNIT))
    ratio = quantity.unit_price_ratio(p, qty)
    published = quantity.unit_price_published(F.col("unit_price_raw"), ratio)
    pv_up, pv_q, pv_u = quantity.unit_price_by_unit(p, q1c, F.col("tray"), F.col("unit_kind"))
    unit_price = by_site(site, {
        (*JUMBO_SITES, "cruzverde"): F.when((site == "cruzverde") | p.isNotNull(), published),
        (*FALABELLA_SITES, "cruzverdecl"): ratio,
        "plaza_vea": pv_up,
        "inkafarma": quantity.unit_price_rounded(p, q1c, found),
    })
    priced = numbers.select(
        "*", unit_price.alias("unit_price"),
        by_site(site, {"plaza_vea": pv_q}, qty).alias("total_unit_quantity"),
        by_site(site, {"plaza_vea": pv_u}, unit).alias("unit_type"))

    # -- stage 4: row policy (R1) ---------------------------------------------
    no_name = F.col("name_raw").isNull()
    no_price = F.col("price_raw").isNull()
    bad_price = F.col("price").isNull()
    bad_ratio = F.col("unit_price").isNull()
    drop_order = ((no_name, "no_name"), (no_price, "no_price"), (bad_price, "bad_price"),
                  (bad_ratio, "bad_unit_price"))
    # Plaza Vea's unit price is missing only where its price is, so the last check never decides there
    reason = by_site(site, {
        (*JUMBO_SITES, "cruzverde", "plaza_vea"): _first_failure(*drop_order),
        "cruzverdecl": _first_failure((~no_price & bad_price, "bad_price"), (no_name, "no_name"),
                                      (no_price, "no_price"), (bad_ratio, "bad_unit_price")),
        FALABELLA_SITES: _first_failure((no_price, "no_price"), (bad_price, "bad_price"),
                                        (no_name, "no_name"), (F.col("price") == 0, "zero_price"),
                                        (bad_ratio, "bad_unit_price")),
    })
    status = (F.when(reason.isNull(), F.lit("ok"))
              .when(site.isin(*JUMBO_SITES), F.lit("partial"))
              .otherwise(F.lit("rejected")))
    return priced.select("*", reason.alias("reason"), status.alias("status"))


def label_pages(pages: DataFrame) -> DataFrame:
    """Category and sub-category by the site's rule (P3, P5, P6, request labels), and
    the stamps (P1).

    They are the page's, so they are worked out once per page, not per card.  A site
    chooses its slugs, which are then made labels in one place: the rules spelled out for
    each site make a generated method that the JVM does not compile.
    """
    site = F.col("site")
    (jumbo_cat, jumbo_sub), (kept_cat, kept_sub) = labels.breadcrumb_slugs("crumbs", "url")
    url_cat, url_sub = labels.url_slugs("url")
    ink_cat, ink_sub = labels.constant_category()
    date, time = labels.stamp_capture("captured_at")
    slugs = pages.withColumns({
        "cat_slug": by_site(site, {JUMBO_SITES: jumbo_cat, "plaza_vea": url_cat}),
        "sub_slug": by_site(site, {JUMBO_SITES: jumbo_sub, "plaza_vea": url_sub}),
        "category": by_site(site, {JUMBO_SITES: kept_cat, "plaza_vea": F.lit(None), "inkafarma": ink_cat},
                            F.col("category")),
        "sub_category": by_site(site, {JUMBO_SITES: kept_sub, "plaza_vea": F.lit(None), "inkafarma": ink_sub},
                                F.col("sub_category")),
        "result_date": date, "result_time": time})
    made = slugs.withColumn("labels", F.transform(F.array("cat_slug", "sub_slug"), slug_to_label))
    return made.withColumns({
        "category": F.coalesce(F.get("labels", F.lit(0)), "category"),
        "sub_category": F.coalesce(F.get("labels", F.lit(1)), "sub_category")}).drop("cat_slug", "sub_slug", "labels")


def attach_retailer(rows: DataFrame, site_rule: DataFrame) -> DataFrame:
    """P2 + S6: retailer name, id and country from the 8-row site table.

    The site table has a fixed size (one row per site), so broadcasting it
    is safe at any data size.  A site missing from it gets no country and
    is routed to the rejects by ``route_by_country``.
    """
    rule = F.broadcast(site_rule.select("site", "country", "comercial_name", "comercial_id"))
    return rows.join(rule, "site", "left")


def to_product_rows(labelled: DataFrame) -> DataFrame:
    """The finished columns; Jumbo's partial rows keep their NULLs."""
    site = F.col("site")
    # what Jumbo's ``no_name`` says; by the field, so that a label needs no parsed price.
    # Without a price (``no_price``, ``bad_price``) the price is NULL as it is.
    jumbo_no_name = site.isin(*JUMBO_SITES) & F.col("name_raw").isNull()

    def unless(cond: Column, c: str) -> Column:
        return F.when(cond, F.lit(None).cast(labelled.schema[c].dataType)).otherwise(F.col(c))

    ink = site == "inkafarma"
    return labelled.select(
        "site", "page_id", "chunk", "pos", "page_number", "status", "reason",
        F.when(ink, labels.join_name(F.coalesce("name", F.lit("")), F.col("presentation")))
         .otherwise(F.col("name")).alias("name"),
        unless(jumbo_no_name, "price").alias("price"),
        unless(jumbo_no_name, "unit_price").alias("unit_price"),
        unless(jumbo_no_name, "total_unit_quantity").alias("total_unit_quantity"),
        unless(jumbo_no_name, "unit_type").alias("unit_type"),
        unless(jumbo_no_name, "category").alias("category"),
        unless(jumbo_no_name, "sub_category").alias("sub_category"),
        unless(jumbo_no_name, "comercial_name").alias("comercial_name"),
        unless(jumbo_no_name, "comercial_id").alias("comercial_id"),
        "result_date", "result_time",
        "country")


PASSED_ON = ("site", "page_id", "chunk", "page_number")   # columns of the snapshot itself


def finished(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Hand the parsed columns on as generator output (``inline`` of a
    one-element array), which Catalyst treats as a barrier: a later filter on
    ``status`` or ``category`` stays above it instead of being pushed down
    with the whole parse inlined into the predicate (which would parse every
    card twice).  The snapshot's own columns stay outside, so a filter on them
    reaches the scan; ``columns`` names what the caller needs, and only that
    is worked out.  Deterministic, no shuffle, no extra pass over the data."""
    names = list(columns or df.columns)
    outside = [c for c in names if c in PASSED_ON]
    parsed = [c for c in names if c not in PASSED_ON]
    if not parsed:
        return df.select(*names)
    return df.select(*outside, F.inline(F.array(F.struct(*[F.col(c) for c in parsed])))).select(*names)


def product_prices(snapshots: DataFrame, site_rule: DataFrame,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Snapshots -> all product rows (kept and rejected), one pass, no shuffle
    apart from the broadcast of the fixed-size site table.

    ``columns``: the row's columns to make (all by default).  Filters on site
    or page are best applied to the result; they reach the snapshot scan.
    """
    from priceflow.operators.extract import card_fields, explode_cards, with_breadcrumbs
    # labels, stamps and retailer are the page's
    pages = label_pages(with_breadcrumbs(attach_retailer(snapshots, site_rule)))
    rows = to_product_rows(parse_cards(card_fields(explode_cards(pages))))
    return finished(rows, columns)
