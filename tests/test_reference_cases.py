"""Hand-made pages and logs on which the rules must agree with the reference."""

from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions import quantity
from priceflow.operators import crawl_log as cl
from priceflow.operators import policy
from priceflow.operators.extract import breadcrumbs, card_fields, explode_cards
from priceflow.operators.products import parse_cards


def parse(spark, site, html):
    pages = spark.createDataFrame([(1, 0, site, "https://h/a/b", html)],
                                  "page_id long, chunk int, site string, url string, html string")
    rows = parse_cards(card_fields(explode_cards(pages)))
    return [(r.name, r.price, r.status) for r in rows.orderBy("pos").collect()]


def test_jumbo_entities_attributes_and_nested_blocks(spark):
    def card(name, price, article='class="x vtex-product-summary-2-x-element y" style="z"'):
        return (f'<article id="1" {article}><h3 class="n"><span><b>{name}</b></span></h3>'
                f'<div id="p" class="a selling-price b">{price}</div></article>')
    html = (card("Jabón A &amp; B 500 g", "<span>$&nbsp;12.900</span>")
            + card("Café", "<div><span>$</span></div><div>12.900</div>")
            + card("Té", '<span>$ 900</span><div class="q calculate-pum-2-x-main">$ 1.200 x kg</div>'))
    assert parse(spark, "jumbo", html) == [("Jabón A & B 500 g", 12900.0, "ok"), ("Café", 12900.0, "ok"),
                                           ("Té", 900.0, "ok")]


def test_falabella_cards_of_the_results_box(spark):
    def card(li):
        return (f'<div class="grid"><a href="/p"><b class="s" id="testId-pod-displaySubTitle-1"><i>Name</i></b>'
                f'<ol><li {li}><div><span class="c" id="">$ 1.990</span></div></li></ol></a></div>')
    html = ('<div><a href="/elsewhere">not a card</a></div><div id="testId-searchResults-products">'
            + card('data-internet-price="1"') + card('class="p" data-internet-price="1"') + "</div>")
    assert parse(spark, "falabella", html) == [("Name", 1990.0, "ok")] * 2


FOOTER = ('<div class="footer"><a href="/h">Help</a><button class="Showcase__name">Other</button>'
          '<div class="Showcase__salePrice" data-price="S/ 9.00">S/ 9.00</div>'
          '<span class="font-bold text-prices">$ 9</span></div>')


def test_a_last_card_without_price_takes_none_from_the_footer(spark):
    card = '<div class="Showcase__details"><div><button class="Showcase__name">Leche 1 l</button></div></div>'
    assert parse(spark, "plaza_vea", f'<div class="list">{card}</div>' + FOOTER) == [("Leche 1 l", None, "rejected")]
    card = ('<div class="flex flex-col h-full p-10 bg-white rounded-sm font-open sm:p-10"><div><a class="font-open flex'
            ' items-center text-main text-16 sm:text-18 leading-20 font-semibold ellipsis hover:text-accent">Crema</a></div></div>')
    assert parse(spark, "cruzverde", f"<div>{card}</div>" + FOOTER) == [("Crema", None, "rejected")]
    # a page cut off in the middle of a card still has that card
    assert parse(spark, "plaza_vea", '<div class="Showcase__details"><button class="Showcase__name">Pan') == [
        ("Pan", None, "rejected")]


def test_jumbo_price_ends_with_its_block(spark):
    def card(rest, inner="<span>$</span><span>12.900</span>"):
        return ('<article class="vtex-product-summary-2-x-element"><h3><span>Arroz 1 kg</span></h3>'
                f'<div class="a selling-price b"><div>{inner}</div></div>{rest}</article>')
    button = "<div><button>Agregar</button></div>"
    pum = '<div class="calculate-pum-2-x-main">$ 1.200 x kg</div>'
    nested = '<article class="badge"><span>Oferta</span></article>'
    want = [("Arroz 1 kg", 12900.0, "ok")]
    for rest in (button, pum + button, nested + button, ""):
        assert parse(spark, "jumbo", card(rest)) == want
    assert parse(spark, "jumbo", card(button) + "<p>after</p>" + card(pum)) == want * 2
    assert parse(spark, "jumbo", card(button, "")) == [("Arroz 1 kg", None, "partial")]
    # the badge is inside the card, not its end
    early = card("").replace("<h3>", nested + "<h3>")
    assert parse(spark, "jumbo", early) == want


def test_falabella_price_at_any_depth(spark):
    def card(price, extra=""):
        return (f'<div class="grid"><a href="/p">{extra}<b id="testId-pod-displaySubTitle-1">Name</b>'
                f'<div id="testId-pod-prices-1"><ol>{price}</ol></div></a></div>')

    def page(*cards):
        return ('<div><a href="/x">x</a></div><div id="y-testId-searchResults-products-z">' + "".join(cards)
                + '</div><div class="footer"><a href="/help">Help</a></div>')
    for price in ('<li data-internet-price="1"><span id="">$ 1.990</span></li>',
                  '<li data-internet-price="1"><div><div><span id="">$ 1.990</span></div></div></li>',
                  '<li class="p" data-normal-price="1"><p><span class="q">$ 1.990</span></p></li>',
                  '<li data-event-price="1"><div><span id="">$ 1.990</span></div></li>'
                  ):
        assert parse(spark, "falabella", page(card(price))) == [("Name", 1990.0, "ok")], price
    price = '<li data-internet-price="1"><span id="">$ 5</span></li><li data-normal-price="2"><span>$ 7</span></li>'
    assert parse(spark, "falabella", page(card(price))) == [("Name", 7.0, "ok")]
    # a span with an id is not an internet price; a price outside the price block is none
    assert parse(spark, "falabella", page(card('<li data-internet-price="1"><span id="k">$ 5</span></li>'))) == [
        ("Name", None, "rejected")]
    outside = '<li data-normal-price="1"><span>$ 3</span></li>'
    assert parse(spark, "falabella", page(card("", outside))) == [("Name", None, "rejected")]
    # an inner link does not end the card, and links elsewhere are no cards
    inner = '<a class="brand" href="/b">Brand</a>'
    price = '<li data-normal-price="2"><span>$ 7</span></li>'
    assert parse(spark, "falabella", page(card(price, inner), card(price))) == [("Name", 7.0, "ok")] * 2
    assert parse(spark, "falabella", page("<div><div>" + '<a href="/deep">deep</a>' + "</div></div>", card(price))) == [
        ("Name", 7.0, "ok")]


def test_breadcrumbs_are_decoded_and_found_however_nested(spark):
    html = ('<div class="c" data-testid="breadcrumb"><span><a href="/f">Frutas &amp; Verduras</a></span>'
            '<span><a href="/g"><b><i>Bananos</i></b></a></span></div><div><a href="/z">Z</a></div>')
    df = spark.createDataFrame([(html,), (html.replace("data-testid", "data-x"),), (None,)], "html string")
    assert [r.c for r in df.select(breadcrumbs("html").alias("c")).collect()] == [
        ["Frutas & Verduras", "Bananos"], [], []]


def test_component_tags_with_attributes_and_inkafarma_price(spark):
    html = ('<fp-product-large _ngcontent-x="" class="a"><fp-product-name _n=""><span>Jarabe</span></fp-product-name>'
            '<fp-product-card-price _n=""><div><div><div><span>S/ 20.00</span><span>S/ 12.50</span></div></div></div>'
            "</fp-product-card-price></fp-product-large>")
    assert parse(spark, "inkafarma", html) == [("Jarabe", 12.5, "ok")]
    html = ('<ml-new-card-product _n="1"><div id="k" class="text-left"><h2><span>Vitamina</span></h2>'
            '<ml-price-tag-v2 _n=""><div><p>$ 3.490</p></div></ml-price-tag-v2></div></ml-new-card-product>')
    assert parse(spark, "cruzverdecl", html) == [("Vitamina", 3490.0, "ok")]


def test_plaza_vea_attribute_order(spark):
    html = ('<div data-x="1" class="Showcase__details"><button type="b" class="Showcase__name">Leche 1 l</button>'
            '<div data-price="S/ 4.50" class="Showcase__salePrice">S/ 4.50</div></div>')
    assert parse(spark, "plaza_vea", html) == [("Leche 1 l", 4.5, "ok")]


def test_quantities_past_a_no_break_space_and_accents(spark):
    names = ["Leche 3\u00a0l", "Café 500\u00a0g", "Champú ácido 2 kg"]
    q, u = quantity.quantity_unit_last("n", rules.UNITS_GENERAL)
    out = spark.createDataFrame([(n,) for n in names], "n string").select(q.alias("q"), u.alias("u")).collect()
    assert [(r.q, r.u) for r in out] == [(3.0, "l"), (500.0, "g"), (2.0, "kg")]


def test_unit_price_rounds_as_python(spark):
    ratios = [i / 8 + j / 1000 for i in range(40) for j in range(0, 60, 5)] + [1.005, 2.675, 0.125, 0.375, 1234567.885]
    out = spark.createDataFrame([(i, x) for i, x in enumerate(ratios)], "i int, x double").select(
        "i", quantity.round2(F.col("x")).alias("r")).collect()
    assert all(r.r == round(ratios[r.i], 2) for r in out)


LOG = "site string, category string, page_number int, products_found int, active_page int"


def test_a_page_read_twice_is_one_empty_page(spark):
    rows = [(1, 5), (2, 0), (2, 0), (3, 0), (4, 7), (5, 8)]
    log = spark.createDataFrame([("s", "c", p, n, p) for p, n in rows], LOG)
    r = cl.stop_on_empty_pages(log).first()
    assert (r.stop_page, r.stop_reason) == (5, "last_page")
    rows = [(1, 0), (2, 0), (2, 4), (3, 0), (4, 0), (5, 0)]   # a good reading makes page 2 good
    log = spark.createDataFrame([("s", "c", p, n, p) for p, n in rows], LOG)
    r = cl.stop_on_empty_pages(log).first()
    assert (r.stop_page, r.stop_reason) == (5, "empty_pages")


def test_a_missing_active_number_is_a_failed_move(spark):
    log = spark.createDataFrame([("s", "c", 1, 1, 1), ("s", "c", 2, 1, None), ("s", "c", 3, 1, 3)], LOG)
    out = sorted((r.page_number, r.expected_page, r.active_page, r.moved_ok) for r in
                 cl.page_advance_check(log).na.fill(-1, ["expected_page", "active_page"]).collect())
    assert out == [(2, 2, -1, False), (3, -1, 3, False)]


def pager(spark, html):
    cur, last, nxt = cl.next_page("h")
    return tuple(spark.createDataFrame([(html,)], "h string").select(cur.alias("c"), last.alias("l"), nxt.alias("n")).first())


def test_pager_class_order_and_white_space(spark):
    html = ('<div class="pagination"><i><span class="pagination__item active page-number"> 2 </span>'
            '<span data-p="3" class="page-number pagination__item">3</span></i></div>')
    assert pager(spark, html) == (2, 3, 3)


def test_pager_with_another_attribute(spark):
    html = '<div id="p" class="pagination" data-x="1"><span class="pagination__item page-number active">4</span></div>'
    assert pager(spark, html) == (4, 4, None)
    assert pager(spark, html.replace('class="pagination" ', 'class="pagination x" ')) == (None, None, None)


def test_page_numbers_count_wherever_they_stand(spark):
    html = ('<span class="page-number pagination__item active">8</span><div class="pagination">'
            '<span class="pagination__item active page-number">2</span>'
            '<span class="page-number pagination__item">9</span></div>')
    assert pager(spark, html) == (8, 9, 9)
    assert pager(spark, html.replace('<div class="pagination">', "<div>")) == (None, None, None)


def test_a_blank_around_another_page_makes_it_no_number(spark):
    html = ('<div class="pagination"><span class="pagination__item page-number active"> 1 </span>'
            '<span class="pagination__item page-number">2</span><span class="pagination__item page-number"> 3 </span></div>')
    assert pager(spark, html) == (1, 2, 2)
    # a word of the class names in another attribute does not count
    assert pager(spark, '<div class="pagination"><span data-a="pagination__item page-number active" class="x">1</span>'
                        "</div>") == (None, None, None)


def test_a_timeout_without_a_count_is_retried(spark):
    df = spark.createDataFrame([(1, "https://h/a/b", rules.TIMEOUT_ERROR_MARK, None)],
                               "request_id long, url string, error_type string, retry_count int")
    r = cl.classify_failures(df).first()
    assert (r.outcome, r.next_retry_count) == ("retry", 1)


def test_dedup_equals_a_plain_pick_on_many_copies(spark):
    keys = [k for k in policy.DEDUP_KEYS if k not in ("name", "price", "total_unit_quantity")]
    df = spark.range(0, 500).selectExpr(
        "CASE WHEN id % 5 < 2 THEN 'hot' WHEN id % 50 = 9 THEN NULL ELSE concat('n', id % 90) END AS name",
        "cast(id % 2 AS double) AS price", "CASE WHEN id % 3 > 0 THEN 1.0D END AS total_unit_quantity",
        "999 - id AS page_id", "0 AS chunk", "cast(id % 6 AS int) AS pos", "id AS extra")
    df = df.withColumns({k: F.lit("x") for k in keys}).repartition(5)
    want = {}
    for r in sorted(df.collect(), key=lambda r: (r.page_id, r.chunk, r.pos)):
        key = ("alone", r.extra) if r.name is None else (r.name, r.price, r.total_unit_quantity)
        first, n = want.get(key, (r.extra, 0))
        want[key] = (first, n + 1)
    got = sorted((r.extra, r.copies) for r in policy.dedup_rows(df).collect())
    assert got == sorted(want.values()) and len(got) > 60


def test_dedup_keeps_nameless_rows_and_different_prices(spark):
    keys = [k for k in policy.DEDUP_KEYS if k not in ("name", "price", "total_unit_quantity")]
    rows = [(None, 1.0, 1.0, 1, 0, 1), (None, 1.0, 1.0, 1, 0, 2), ("a", 1.0, 1.0, 1, 0, 3), ("a", 1.0, 1.0, 2, 0, 1),
            ("a", 2.0, 1.0, 3, 0, 1), ("a", 1.0, 5.0, 4, 0, 1)]
    df = spark.createDataFrame(rows, "name string, price double, total_unit_quantity double, page_id long, chunk int, pos int")
    df = df.withColumns({k: F.lit("x") for k in keys})
    out = sorted((r.page_id, r.pos, r.copies) for r in policy.dedup_rows(df).collect())
    assert out == [(1, 1, 1), (1, 2, 1), (1, 3, 2), (3, 1, 1), (4, 1, 1)]
