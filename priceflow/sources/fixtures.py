"""Inputs built from the given tables (TPC-H-like parquet), for tests,
the benchmark and the DuckDB oracle.

The reference crawls live sites; we have no captured pages.  The shapes it
works on are therefore derived here, deterministically, from the given
tables so that every query's work grows with them:

* ``cards``         one product card per ``lineitem`` row (joined to ``part``)
* ``page_snapshot`` captured listing pages: an order's cards, at most six
                    per page (a bounded group), wrapped in the site's markup
* ``crawl_log``     one visited page per ``events`` row
* ``request_log``   one failed request per ``events`` row of type 'error'
* ``menu_link``     the navigation links of ``pages``, with the forms shops use
* ``seed``          one (category, sub-category) seed per ``part`` row

Every column is a SQL expression rendered for one of two dialects, Spark
SQL or DuckDB, so the oracle reads exactly the same inputs.  Values like
``% 23`` below only *assign* properties (a missing name, a zero price) to
rows; no row is ever filtered out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.operators.frontier import menu_links
from priceflow.operators.numbering import sequence_number


class Dialect:
    """The few places where Spark SQL and DuckDB spell things differently."""

    def __init__(self, name: str):
        assert name in ("spark", "duckdb")
        self.name = name

    def s(self, x: str) -> str:
        return f"cast({x} as string)"

    def idiv(self, a: str, b: str) -> str:
        return f"cast(floor(({a}) / ({b})) as bigint)"

    def numbered(self, items: str, item, separator: str = "''") -> str:
        """``item(i)`` for i = 1, 2, ... along a list, joined into one text."""
        if self.name == "spark":
            return f"array_join(transform({items}, (x, k) -> {item('(k + 1)')}), {separator})"
        return f"array_to_string(list_transform({items}, lambda x, k: {item('k')}), {separator})"

    def element(self, items: str, i: str) -> str:
        return f"element_at({items}, cast({i} as int))" if self.name == "spark" else f"{items}[{i}]"

    def comma_thousands(self, x: str) -> str:
        if self.name == "spark":
            return f"format_number({x}, 0)"
        return f"format('{{:,}}', {x})"

    def dotted(self, x: str) -> str:
        return f"replace({self.comma_thousands(x)}, ',', '.')"

    def soles(self, x: str) -> str:
        return f"{self.s(self.idiv(x, '100'))} || '.' || lpad({self.s(f'({x}) % 100')}, 2, '0')"

    def add_seconds(self, ts: str, secs: str) -> str:
        if self.name == "spark":
            return f"{ts} + make_dt_interval(0, 0, 0, {secs})"
        return f"{ts} + to_seconds({secs})"

    def site_of(self, key: str) -> str:
        whens = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(rules.SITES))
        return f"CASE {key} % {len(rules.SITES)} {whens} END"

    def domain_of(self, site: str) -> str:
        whens = " ".join(f"WHEN '{r[0]}' THEN '{r[4]}'" for r in rules.SITE_TABLE)
        return f"CASE {site} {whens} END"


# ---------------------------------------------------------------------------
# cards: lineitem JOIN part
# ---------------------------------------------------------------------------

# Cards per listing page.  An order's lines are numbered (``seq``) and cut
# into pages of this size, so a page is a bounded group even for an order
# with millions of lines.
CARDS_PER_PAGE = 6
# The numbering order: every column a card is built from, so rows that tie
# are identical cards and any tie order gives the same page.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

def card_base_exprs(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("page_id", "l_orderkey"),
        ("chunk", f"cast({d.idiv('seq - 1', str(CARDS_PER_PAGE))} as int)"),
        ("pos", f"cast((seq - 1) % {CARDS_PER_PAGE} + 1 as int)"),
        ("card_id", f"{d.s('l_orderkey')} || '-' || {d.s('seq')}"),
        ("site", d.site_of("l_orderkey")),
        ("p_type", "p_type"),
        ("p_brand", "p_brand"),
        ("p_name", "p_name"),
        ("n", "p_size"),
        ("ip", "cast(floor(l_extendedprice) as bigint)"),
        ("v", "cast((l_orderkey + l_linenumber * 5 + l_partkey) % 12 as int)"),
        ("has_name", "(l_orderkey + l_linenumber) % 23 <> 0"),
        ("has_price", "(l_orderkey * 3 + l_linenumber) % 19 <> 0"),
        ("slot", "cast(l_partkey % 3 as int)"),
        ("zero", "(l_orderkey % 29 = 0 AND l_linenumber = 1)"),
        ("captured_at", d.add_seconds("l_shipdate", "(l_orderkey * 37) % 86400")),
        ("l_extendedprice", "l_extendedprice"),
    ]


def card_text_exprs(d: Dialect) -> list[tuple[str, str]]:
    s, idiv = d.s, d.idiv
    suffix = (
        "CASE v"
        " WHEN 0 THEN ''"
        f" WHEN 1 THEN ' x ' || {s('n')}"
        f" WHEN 2 THEN ' ' || {s('n')} || ' ml'"
        f" WHEN 3 THEN ' ' || {s('n')} || 'GR'"
        f" WHEN 4 THEN ' A&B ' || {s('n')} || ' und'"
        f" WHEN 5 THEN ' ' || {s(idiv('n', '10'))} || ',' || {s('n % 10')} || ' L'"
        f" WHEN 6 THEN ' por ' || {s('n')} || '.000'"
        f" WHEN 7 THEN ' x ' || {s('pos')} || ' un ' || {s('n')} || '.000 ml'"
        " WHEN 8 THEN ' 0 g'"
        f" WHEN 9 THEN ' ' || {s('n')} || ' unidades'"
        f" WHEN 10 THEN ' ' || {s('n')} || ' Kg'"
        f" ELSE ' ' || {s('pos')} || ' bandeja' END")
    cents = f"lpad({s('ip % 100')}, 2, '0')"
    return [
        ("name_text", f"p_name || {suffix}"),
        ("money", f"CASE WHEN zero THEN '0' WHEN pos = 3 THEN {d.dotted('ip')} || ',' || {cents}"
                  f" ELSE {d.dotted('ip')} END"),
        ("half_money", d.dotted(idiv("ip", "2"))),
        ("upt", f"CASE WHEN pos % 2 = 0 THEN '$ ' || {d.dotted(idiv('ip', '10'))} || ' x kg' END"),
        ("unit_ref", f"CASE WHEN pos % 3 = 0 THEN 'Precio por ' || {s('pos')} || ' kg' END"),
        ("pv_price", f"CASE WHEN zero THEN '' WHEN pos = 5 THEN {d.comma_thousands('ip')} || '.00'"
                     f" ELSE {d.soles('ip')} END"),
        ("ink_price", f"CASE WHEN zero THEN {d.soles('ip')}"
                      f" WHEN pos % 3 = 0 THEN 'S/ ' || {d.soles('ip')} || 'S/ ' || {d.soles(idiv('ip * 9', '10'))}"
                      f" ELSE 'S/ ' || {d.soles('ip')} END"),
        ("ink_old", f"'S/ ' || {d.soles(idiv('ip * 11', '10'))}"),
        ("pres", f"CASE pos % 4 WHEN 0 THEN '' WHEN 1 THEN 'Caja ' || {s('n')} || ' unidades'"
                 f" WHEN 2 THEN 'Frasco ' || {s('n')} || ' ml'"
                 f" ELSE 'Blister ' || {s(idiv('n', '10'))} || '.' || {s('n % 10')} || ' g' END"),
    ]


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def cat(*parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


def opt(cond: str, *parts: str) -> str:
    return f"(CASE WHEN {cond} THEN {cat(*parts)} ELSE '' END)"


FB_TEXT = "(CASE WHEN pos = 2 THEN '$ ' || half_money || ' - $ ' || money ELSE '$ ' || money END)"
NAME = "(CASE WHEN pos % 2 = 0 THEN ' ' || name_text || '  ' ELSE name_text END)"
PUM_DIV = '<div class="tiendasjumboqaio-calculate-pum-2-x-main">'


def card_markup(d: Dialect) -> dict[str, tuple[str, str, str]]:
    """What comes before, inside and after one product card, per site.

    The inside is what X1 must return.  Cards hold nested elements of their own
    name, buttons after the price, prices at several depths and entities.
    """
    nm = f"replace({NAME}, '&', '&amp;')"
    cid = d.s("card_id")
    flex = lambda tags: f"(CASE WHEN slot = 1 THEN {q(tags)} ELSE '' END)"
    jumbo = (
        cat(q('<section><a href="/p/'), cid, q('"><article id="'), cid, q('" class="vtex-product-summary-2-x-element">')),
        cat(q("<div>"),
            opt("has_name", q('<h3 class="vtex-product-summary-2-x-productName"><span>'), nm, q("</span></h3>")),
            opt("pos % 2 = 0", q('<article class="badge"><span>Oferta</span></article>')),
            q('<div class="tiendasjumboqaio-selling-price">'),
            opt("has_price", flex('<div class="flex"><div>'), q("<span>$</span><span>"), "money", q("</span>"),
                flex("</div></div>")),
            q("</div>"),
            opt("upt IS NOT NULL", q(PUM_DIV), "upt", q("</div>")),
            q('<div class="buttons"><button type="button">Agregar</button></div></div>')),
        q("</article></a></section>"))
    cruzverde = (
        q('<div class="flex flex-col h-full p-10 bg-white rounded-sm font-open sm:p-10">'),
        cat(opt("has_name", q('<a class="font-open flex items-center text-main text-16 sm:text-18 leading-20 '
                              'font-semibold ellipsis hover:text-accent" href="/p/'), cid, q('.html">'), nm, q("</a>")),
            q('<div class="price">'),
            opt("has_price", q('<span class="font-bold text-prices">$ '), "money", q("</span>")),
            opt("upt IS NOT NULL", q('<span class="text-12">'), "upt", q("</span>")),
            q("</div>")),
        q("</div>"))
    cruzverdecl = (
        q("<ml-new-card-product>"),
        cat(q('<div class="text-left">'),
            opt("has_name", q('<h2 class="name"><span>'), nm, q("</span></h2>")),
            opt("has_price", q("<ml-price-tag-v2><div><p>$ "), "money", q("</p></div></ml-price-tag-v2>")),
            q("</div>")),
        q("</ml-new-card-product>"))

    def price_li(kind, span):
        wrap = f"(CASE v % 3 WHEN 0 THEN '' WHEN 1 THEN {q('<div>')} ELSE {q('<div><div>')} END)"
        unwrap = f"(CASE v % 3 WHEN 0 THEN '' WHEN 1 THEN {q('</div>')} ELSE {q('</div></div>')} END)"
        return cat(q(f'<li data-{kind}-price="'), d.s("ip"), q('">'), wrap, q(span), FB_TEXT, q("</span>"), unwrap,
                   q("</li>"))

    falabella = (
        cat(q('<div class="grid-pod"><a class="pod-link" href="/p/'), cid, q('">')),
        cat(opt("has_name", q('<b id="testId-pod-displaySubTitle-'), cid, q('" class="pod-subTitle">'), nm, q("</b>")),
            opt("pos % 3 = 1", q('<a class="brand" href="/marca">Marca</a>')),
            q('<div id="testId-pod-prices-'), cid, q('"><ol>'),
            opt("has_price AND slot = 0", price_li("normal", "<span>")),
            opt("has_price AND slot <= 1", price_li("internet", '<span id="">')),
            opt("has_price", price_li("event", '<span id="">')),
            q("</ol></div>")),
        q("</a></div>"))
    plaza_vea = (
        q('<div class="Showcase__details">'),
        cat(opt("has_name", q('<button class="Showcase__name">'), nm, q("</button>")),
            opt("has_price", q('<div class="Showcase__salePrice" data-price="'), "pv_price", q('">S/ '),
                "pv_price", q("</div>")),
            opt("unit_ref IS NOT NULL", q('<div class="Showcase__units-reference">'), "unit_ref", q("</div>"))),
        q("</div>"))
    inkafarma = (
        q("<fp-product-large>"),
        cat(q('<fp-product-small-category><fp-link><a href="/producto/'), cid, q('">'),
            opt("has_name", q("<fp-product-name><span>"), nm, q("</span></fp-product-name>")),
            opt("pres <> ''", q("<fp-product-description><span>"), "pres", q("</span></fp-product-description>")),
            opt("has_price", q("<fp-product-card-price><div><span>"), "ink_old", q("</span><span>"),
                "ink_price", q("</span></div></fp-product-card-price>")),
            q("</a></fp-link></fp-product-small-category>")),
        q("</fp-product-large>"))
    return {"jumbo": jumbo, "jumbocl": jumbo, "cruzverde": cruzverde, "cruzverdecl": cruzverdecl,
            "falabella": falabella, "falabellacol": falabella, "plaza_vea": plaza_vea, "inkafarma": inkafarma}


def _by_site(choices: dict[str, str]) -> str:
    return "CASE site " + " ".join(f"WHEN '{site}' THEN {x}" for site, x in choices.items()) + " END"


def card_inner_expr(d: Dialect) -> str:
    """What one product card holds, in the markup of its site."""
    return _by_site({site: inner for site, (_, inner, _) in card_markup(d).items()})


def card_html_expr(d: Dialect) -> str:
    """One product card with its element around ``card_inner``."""
    return _by_site({site: cat(before, "card_inner", after) for site, (before, _, after) in card_markup(d).items()})


def card_field_exprs() -> dict[str, str]:
    """The raw texts that X2-X5 must read back, from the card's own columns."""
    price = {"jumbo": "money", "jumbocl": "money", "cruzverde": "'$ ' || money", "cruzverdecl": "'$ ' || money",
             "falabella": FB_TEXT, "falabellacol": FB_TEXT, "plaza_vea": "pv_price", "inkafarma": "ink_price"}
    pum = f"{q(PUM_DIV)} || upt || '</div>'"
    return {
        "name_raw": f"CASE WHEN has_name THEN {NAME} END",
        "price_raw": f"CASE WHEN has_price THEN {_by_site(price)} END",
        "unit_price_raw": _by_site({"jumbo": pum, "jumbocl": pum, "cruzverde": "upt"}),
        "unit_ref_raw": "CASE WHEN site = 'plaza_vea' THEN unit_ref END",
        "presentation_raw": "CASE WHEN site = 'inkafarma' AND pres <> '' THEN pres END",
    }


# ---------------------------------------------------------------------------
# page snapshots: one per order, cards in line order
# ---------------------------------------------------------------------------

def page_exprs(d: Dialect) -> list[tuple[str, str]]:
    s, idiv = d.s, d.idiv
    cat_slug = "lower(category)"
    sub_slug = "lower(replace(sub_category, '#', '-'))"
    page_number = f"(({idiv('page_id', '8')} + chunk) % 12 + 1)"
    last_page = f"({page_number} + page_id % 4)"

    def span(x, active=False):
        cls = "pagination__item page-number active" if active else "pagination__item page-number"
        return cat(q(f'<span class="{cls}">'), x, q("</span>"))

    blank = "(CASE WHEN page_id % 11 = 0 THEN ' ' ELSE '' END)"
    pagination = (
        f"CASE WHEN page_id % 13 = 0 THEN '' ELSE "
        + cat(opt("page_id % 17 = 0", q('<span data-p="1" class="page-number pagination__item">99</span>')),
              f"(CASE WHEN page_id % 5 = 0 THEN {q('<div data-p="1" class="pagination">')}"
              f" ELSE {q('<div class="pagination">')} END)", q('<div class="pagination__nav">'),
              opt(f"{page_number} > 1", span(s(f"{page_number} - 1"))),
              span(s(page_number), active=True),
              opt(f"{last_page} > {page_number}", span(s(f"{page_number} + 1"))),
              opt(f"{last_page} > {page_number} + 2", span(q("..."))),
              opt(f"{last_page} > {page_number} + 1", span(cat(blank, s(last_page), blank))),
              q("</div></div>"))
        + " END")

    def crumb(x, tag_="{}"):
        before, after = tag_.split("{}")
        return cat(q('<span><a href="/'), x, q(f'">{before}'), x, q(f"{after}</a></span>"))

    footer = q('<div class="footer"><a href="/ayuda">Ayuda</a><button class="Showcase__name">Otro</button>'
               '<div class="Showcase__salePrice" data-price="S/ 9.00">S/ 9.00</div>'
               '<span class="font-bold text-prices">$ 9</span></div>')
    crumbs = cat(
        q('<div data-testid="breadcrumb">'),
        f"(CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN {crumb(cat(cat_slug, q('-'), sub_slug), '<b>{}</b>')}"
        f" ELSE {crumb(cat('category', q(' &amp; Co')))} || {crumb('sub_category')} END)",
        q("</div>"))
    total = cat(q('<div class="vtex-search-result-3-x-totalProducts--layout"><span>'),
                d.dotted(idiv("total", "100")), q(" Productos</span></div>"))
    path = f"(CASE WHEN page_id % 5 = 0 THEN {cat_slug} ELSE {cat(cat_slug, q('/'), sub_slug)} END)"
    url = (
        "CASE"
        " WHEN site = 'inkafarma' THEN "
        + cat(q("https://inkafarma.pe/"), "(CASE WHEN page_id % 5 = 0 THEN '' ELSE 'categoria/' END)", cat_slug)
        + " WHEN site IN ('jumbo', 'jumbocl') THEN " + cat(q("https://"), d.domain_of("site"), q("/"), path)
        + " ELSE " + cat(q("https://"), d.domain_of("site"), q("/"), cat_slug, q("/"), sub_slug) + " END")
    gallery = cat(crumbs, total, q('<div id="gallery-layout-container">'), "cards", q("</div>"))
    body = (
        "CASE site"
        f" WHEN 'jumbo' THEN {gallery} WHEN 'jumbocl' THEN {gallery}"
        " WHEN 'cruzverde' THEN " + cat(q('<div class="grid grid-cols-1 gap-15 lg:grid-cols-3 lg:gap-30 '
                                          'ng-star-inserted">'), "cards", q("</div>"))
        + " WHEN 'plaza_vea' THEN " + cat(q('<div class="Showcase">'), "cards", q("</div>"), pagination)
        + " WHEN 'inkafarma' THEN " + cat(q("<fp-filtered-product-list>"), "cards", q("</fp-filtered-product-list>"))
        + " WHEN 'cruzverdecl' THEN " + cat(q('<div class="grid">'), "cards", q("</div>"))
        + " ELSE " + cat(q('<div><a href="/ofertas">Ofertas</a></div>'
                           '<div class="results" id="testId-searchResults-products-grid">'), "cards", q("</div>"))
        + " END")
    html = cat(q("<html><head><title>"), "category", q("</title></head><body>"), f"({body})", footer,
               q("</body></html>"))
    return [
        ("page_id", "page_id"),
        ("chunk", "chunk"),
        ("site", "site"),
        ("url", url),
        ("category", "category"),
        ("sub_category", "sub_category"),
        ("page_number", f"cast({page_number} as int)"),
        ("captured_at", "captured_at"),
        ("n_cards", "n_cards"),
        ("html", html),
    ]


def crumb_exprs() -> str:
    """The breadcrumb texts of a page, from its own columns (DuckDB list)."""
    slug = "lower(category) || '-' || lower(replace(sub_category, '#', '-'))"
    return (f"CASE page_id % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN [{slug}]"
            " ELSE [category || ' & Co', sub_category] END")


def pager_exprs() -> tuple[str, str]:
    """(has a pager, last page that counts) of a page, from its own columns."""
    last = "(page_number + page_id % 4)"
    return ("site = 'plaza_vea' AND page_id % 13 <> 0",
            f"greatest(page_number, CASE WHEN {last} > page_number THEN page_number + 1 ELSE 0 END,"
            f" CASE WHEN {last} > page_number + 1 AND page_id % 11 <> 0 THEN {last} ELSE 0 END,"
            " CASE WHEN page_id % 17 = 0 THEN 99 ELSE 0 END)")


def _select(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in exprs])


def _keep_and_add(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr("*", *[f"{e} AS {n}" for n, e in exprs])


def card_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card per lineitem row: its place and the values its texts are made of.

    ``part`` is joined by key; it grows with the data, so the join is left
    to the planner (sort-merge at scale, broadcast only if AQE measures it
    small).
    """
    d = Dialect("spark")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # number the narrow lineitem rows first, then add the part columns
    numbered = sequence_number(li, ["l_orderkey"], LINE_ORDER, "seq")
    joined = numbered.join(part, numbered.l_partkey == part.p_partkey, "inner")
    return _select(joined, card_base_exprs(d))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card per lineitem row: texts as a site would print them."""
    d = Dialect("spark")
    texts = _keep_and_add(card_base(spark, sf_dir), card_text_exprs(d))
    inner = texts.selectExpr("*", f"{card_inner_expr(d)} AS card_inner")
    return inner.selectExpr("*", f"{card_html_expr(d)} AS card_html")


# The columns of a card that its texts are made of; the rest is its page's.
CARD_VALUES = ["pos", "p_name", "n", "ip", "v", "has_name", "has_price", "slot", "zero"]


def printed_cards_expr(d: Dialect) -> str:
    """A page's gathered ``values`` -> its cards' (pos, card_html), in the same texts as ``cards``.

    The texts stand where the markup names them, so a card makes only those of its site; the
    site is the page's, so it is asked once per page.
    """
    meaning = {c: f"x.{c}" for c in CARD_VALUES}
    texts = {n: f"({_with(e, meaning)})" for n, e in card_text_exprs(d)}
    texts["card_id"] = f"({d.s('page_id')} || '-' || {d.s(f'cast(chunk as bigint) * {CARDS_PER_PAGE} + x.pos')})"
    return _by_site({site: f"transform(values, x -> struct(x.pos AS pos, {_with(cat(*parts), meaning | texts)} AS card_html))"
                     for site, parts in card_markup(d).items()})


def _with(expr: str, meaning: dict[str, str]) -> str:
    """The expression with these names replaced; string literals stay."""
    return re.sub(rf"'[^']*'|\b({'|'.join(meaning)})\b", lambda m: meaning[m[1]] if m[1] else m[0], expr)


def page_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages: an order's cards in line order, at most
    ``CARDS_PER_PAGE`` per page, so gathering a page's cards into one string
    is bounded whatever the data size or skew.  Only the values that the texts are
    made of are gathered; a card is printed in the task that holds its page,
    so no markup is shuffled or sorted.
    """
    d = Dialect("spark")
    c = card_base(spark, sf_dir)
    pages = c.groupBy("page_id", "chunk", "site").agg(
        F.min_by("p_type", "pos").alias("category"),
        F.min_by("p_brand", "pos").alias("sub_category"),
        F.min("captured_at").alias("captured_at"),
        F.sum("ip").alias("total"),
        F.count(F.lit(1)).alias("n_cards"),
        F.collect_list(F.struct(*CARD_VALUES)).alias("values"))
    printed = pages.withColumn("cards", F.array_join(F.sort_array(F.expr(printed_cards_expr(d)))["card_html"], ""))
    return _select(printed, page_exprs(d))


# ---------------------------------------------------------------------------
# crawl log, request log, menu links, seeds
# ---------------------------------------------------------------------------

def crawl_log_exprs(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("site", d.site_of("user_id")),
        ("category", f"'cat-' || {d.s('user_id')}"),
        ("event_id", "event_id"),
        ("products_found", "CASE WHEN event_type IN ('error', 'signup') THEN 0"
                           " ELSE cast(floor(value) as int) + 1 END"),
        ("has_cards", "event_type <> 'signup'"),
        ("visited_at", "ts"),
    ]


def crawl_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages visited per category, in visit order, not yet numbered.

    category = user, one visited page = one event; a page found no valid
    product for 'error' and 'signup' events (a 'signup' page had no card at
    all).
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value")
    return _select(ev, crawl_log_exprs(Dialect("spark")))


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits numbered 1, 2, ... per category.  ``active_page`` is what the
    pager showed: one ahead on every tenth event, to give the advance check
    something to find.
    """
    log = sequence_number(crawl_visits(spark, sf_dir), ["site", "category"], ["visited_at", "event_id"], "page_number")
    log = log.withColumn("page_number", F.col("page_number").cast("int"))
    return log.withColumn(
        "active_page",
        (F.col("page_number") + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)).cast("int"))


def request_log_exprs(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("request_id", "event_id"),
        ("site", d.site_of("user_id")),
        ("url", "CASE WHEN event_id % 7 = 0 THEN 'about:blank' ELSE"
                f" 'https://www.plazavea.com.pe/cat-' || {d.s('user_id % 10')} || '/sub-item-' || {d.s('user_id')} END"),
        ("error_type", "CASE WHEN event_id % 2 = 0"
                       " THEN '<class ''playwright._impl._errors.TimeoutError''>'"
                       " ELSE '<class ''scrapy.spidermiddlewares.httperror.HttpError''>' END"),
        ("retry_count", "cast(event_id % 4 as int)"),
    ]


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed requests: the 'error' events; even ids timed out."""
    d = Dialect("spark")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type").where(F.col("event_type") == "error")
    return _select(ev, request_log_exprs(d))


#: the given pages' own anchors, as they print them
MENU_LINK_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a>'


def menu_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation anchors of ``pages``: (page_id, url, pos, href, text)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return menu_links(pages)


# Where a menu page built from a page's anchors starts a category and a group, and has no address.
MENU_CATEGORY_STARTS = "(i = 1 OR (page_id + i) % 4 = 0)"
MENU_GROUP_STARTS = "(i = 1 OR (page_id + i) % 4 = 0 OR (page_id + i) % 2 = 0)"
MENU_BLANK = "(page_id + i) % 11 = 0"


def menu_html_expr(d: Dialect, hrefs: str, texts: str) -> str:
    """A menu of categories, groups with a title, and links, from a page's anchors."""
    def item(i):
        at = lambda cond: cond.replace("i ", f"{i} ").replace("+ i)", f"+ {i})")
        title = cat(q('<div class="top FirstLevelCategories-module_categoryTitle__x" id="c"><span>Cat &amp; '),
                    d.s(f"(page_id + {i}) % 2"), q("</span></div>"))
        group = cat(q('<ul id="g" class="b SecondLevelCategories-module_secondLevelCategory__NVToy">'
                      '<li class="z SecondLevelCategories-module_secondLevelCategoryTitle__q"><a href="/t"><b>Sub &amp; '),
                    d.s(f"(page_id + {i}) % 3"), q("</b></a></li>"))
        return cat(
            opt(f"{i} > 1 AND {at(MENU_GROUP_STARTS)}", q("</ul>")), opt(at(MENU_CATEGORY_STARTS), title),
            opt(at(MENU_GROUP_STARTS), group),
            q('<li id="l" class="SecondLevelCategories-module_thirdLevelCategory__0VfiO"> <a class="k" data-i="'),
            d.s(i), q('"'),
            f"(CASE WHEN {at(MENU_BLANK)} THEN '' ELSE {cat(q(' href=\"'), d.element(hrefs, i), q('\"'))} END)",
            q("><i>"), d.element(texts, i), q("</i> </a></li>"))

    return cat(q("<nav>"), d.numbered(hrefs, item), q("</ul></nav>"))


def menu_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One menu page per given page: (page_id, url, html)."""
    d = Dialect("spark")
    anchors = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", *[F.regexp_extract_all("html", F.lit(MENU_LINK_PATTERN), k).alias(name)
                            for k, name in ((1, "hrefs"), (2, "texts"))])
    return _select(anchors, [("page_id", "page_id"), ("url", "url"), ("html", menu_html_expr(d, "hrefs", "texts"))])


def menu_link_exprs(d: Dialect) -> list[tuple[str, str]]:
    """Anchors as shops print them: some without an address, some to other
    hosts, some relative, some with a text that is not a product list."""
    n = d.s("pos")
    site = d.site_of("page_id")
    domain = d.domain_of(f"({site})")
    denied = rules.CRUZVERDE_CL_DENIED_LINK_TEXTS[0]
    return [
        ("page_id", "page_id"), ("url", "url"), ("pos", "pos"), ("site", site),
        ("href", "CASE WHEN (page_id + pos) % 11 = 0 THEN ''"
                 f" WHEN (page_id + 2 * pos) % 7 = 1 THEN 'https://' || {domain} || '/a'"
                 f" WHEN (page_id + 2 * pos) % 7 = 2 THEN 'https://m.' || {domain} || '/b/../c'"
                 f" WHEN (page_id + 2 * pos) % 7 = 3 AND pos % 2 = 0 THEN 'http://x' || {domain} || '/'"
                 " WHEN (page_id + 2 * pos) % 7 = 0 THEN 'https://cdn.example.net' || href"
                 f" WHEN (3 * page_id + pos) % 9 = 1 THEN '?p=' || {n}"
                 f" WHEN (3 * page_id + pos) % 9 = 2 THEN '#s' || {n}"
                 f" WHEN (3 * page_id + pos) % 9 = 3 THEN 'rel/' || {n}"
                 f" WHEN (3 * page_id + pos) % 9 = 4 THEN '//cdn.example.org/' || {n}"
                 f" WHEN (3 * page_id + pos) % 9 = 5 THEN '../up/./' || {n} || '/..'"
                 f" WHEN (3 * page_id + pos) % 9 = 6 THEN 'mailto:a' || {n} || '@example.com'"
                 " ELSE href END"),
        ("text", f"CASE WHEN (page_id + pos) % 13 = 0 THEN {q(denied)} || ' ' || text ELSE text END"),
    ]


def menu_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anchors with the properties above."""
    return _select(menu_raw(spark, sf_dir), menu_link_exprs(Dialect("spark")))


def seed_exprs(d: Dialect) -> list[tuple[str, str]]:
    return [
        ("site", "'plaza_vea'"),
        ("category", "lower(p_type)"),
        ("sub_category", "lower(replace(p_brand, '#', '-'))"),
        ("part", "CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN '1'"
                 " WHEN p_type IN ('MEDIUM', 'LARGE') THEN '2' ELSE 'electro' END"),
        ("seq", "p_partkey"),
    ]


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One seed row per part: category = type, sub-category = brand.

    Kept as rows (not one list per category) so no group is gathered;
    repeats are kept as the reference keeps them.
    """
    d = Dialect("spark")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type", "p_brand")
    return _select(part, seed_exprs(d))


def site_rule(spark: SparkSession) -> DataFrame:
    """The 8-row site dimension (fixed size, safe to broadcast)."""
    return spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4], rules.ROW_POLICY[r[0]]) for r in rules.SITE_TABLE],
        "site string, country string, comercial_name string, comercial_id string, "
        "domain string, row_policy string")
