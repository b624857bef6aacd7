"""Frontier (S3, C1-C9, D1, F1-F8) and crawl-log rules."""

from urllib.parse import urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from priceflow.operators import crawl_log as cl
from priceflow.operators import frontier as fr


def test_custom_url_source_keeps_order_and_empties(spark):
    df = spark.createDataFrame([(1, " https://a/x , https://b/y,,https://c/z ")], "run long, custom_urls string")
    out = fr.custom_url_source(df).orderBy("url_index").collect()
    assert [(r.url_index, r.url) for r in out] == [(0, "https://a/x"), (1, "https://b/y"), (2, ""), (3, "https://c/z")]


def test_seed_selector_substring_rules(spark):
    seeds = spark.createDataFrame([("1", "a", "s1", 1), ("2", "b", "s2", 2), ("electro", "c", "s3", 3)],
                                  "part string, category string, sub_category string, seq long")
    runs = spark.createDataFrame([(1, "super", "1"), (2, "electro", None), (3, "zzz", "1"), (4, None, None),
                                  (5, "supermarket", "2")], "run_id long, category string, part string")
    got = sorted((r.run_id, r.seq) for r in fr.seed_selector(runs, seeds).collect())
    assert got == [(1, 1), (2, 3), (4, 1), (4, 2), (4, 3), (5, 2)]


def test_expand_union_and_number(spark):
    seeds = spark.createDataFrame([("s", "2", "b", "y", 5), ("s", "1", "a", "x", 9), ("s", "1", "a", "x", 3)],
                                  "site string, part string, category string, sub_category string, seq long")
    urls = fr.expand_seed_urls(fr.union_seed_lists(seeds), "https://h")
    out = fr.number_requests(urls, ["site"], ["list_no", "seq"], 7).orderBy("request_index").collect()
    assert [r.request_url for r in out] == ["https://h/a/x?scrapy_index=0&ts=7", "https://h/a/x?scrapy_index=1&ts=7",
                                            "https://h/b/y?scrapy_index=2&ts=7"]


def test_resolve_link_forms(spark):
    base = "https://a.com/x/y?q=1#f"
    hrefs = ["/p", "//b.com/z", "http://c.com/w", "z", "?r=2", "#g"]
    df = spark.createDataFrame([(base, h) for h in hrefs], "u string, h string")
    out = [r.r for r in df.select(fr.resolve_link("u", "h").alias("r")).collect()]
    assert out == ["https://a.com/p", "https://b.com/z", "http://c.com/w", "https://a.com/x/z",
                   "https://a.com/x/y?r=2", "https://a.com/x/y?q=1#g"]


def resolved(spark, pairs):
    df = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    return [r.r for r in df.select("i", fr.resolve_link("b", "h").alias("r")).orderBy("i").collect()]


def test_resolve_link_equals_urljoin(spark):
    bases = ["https://h.com/x/y/z", "http://H.com", "https://h.com/", "https://h.com/a/b/?q=1#f", "https://h.com/a//b",
             "https://u@h.com:8080/p/../q/r?x=/../y"]
    hrefs = ["../q", "./q", ".", "..", "../..", "../../../../w", "a/./b/../c", "/a/./b/..", "/a//b", "//o.com/x/../y", "//o.com",
             "mailto:a@b.c", "javascript:void(0)", "httpfoo", "http:foo", "HTTPS://K.com/A", "https:/p", "?", "#", "?a=b", "#c",
             "?a#b", " /p", "\n\tq r", "x ", "", "a?b/../c", "a#b/../c", "...", "..a", "a..", "é/ü", "1:2", "a:b/c"]
    pairs = [(b, h) for b in bases for h in hrefs]
    assert resolved(spark, pairs) == [urljoin(b, h) for b, h in pairs]


@settings(max_examples=4, deadline=None)
@given(st.data())
def test_resolve_link_equals_urljoin_on_generated_paths(spark, data):
    part = st.sampled_from(["a", "b.c", "..", ".", "", "é", "x y", "..."])
    path = st.lists(part, max_size=6).map("/".join)
    tail = st.sampled_from(["", "?k=v", "#f", "?k=../v#f", "?", "#"])
    base = st.tuples(st.sampled_from(["http://h.com", "https://h.com:81"]), path, tail).map(
        lambda x: x[0] + ("/" + x[1] if x[1] else "") + x[2])
    href = st.tuples(st.sampled_from(["", "/", "//o.com/", " ", "http:", "https:", "mailto:"]), path, tail).map("".join)
    pairs = data.draw(st.lists(st.tuples(base, href), min_size=100, max_size=200))
    assert resolved(spark, pairs) == [urljoin(b, h) for b, h in pairs]


def test_link_filters_and_offsite(spark):
    links = spark.createDataFrame([(1, "https://www.x.com/a", "Ver"), (2, "", "Conoce más aquí"),
                                   (3, "https://shop.x.com/b", "Asesoría en vivo"), (4, "https://evil.com/c", "c"),
                                   (5, "https://notx.com/", "look-alike"), (6, "mailto:a@x.com", "m"),
                                   (7, "https://x.com:81", "port"), (8, "https://X.COM/", "case"),
                                   (9, "https://x.com.evil.org/", "prefix")],
                                  "pos int, href string, text string").withColumn("site", F.lit("s"))
    sites = spark.createDataFrame([("s", "x.com"), ("s", "shop.x.com"), ("s", "shop.x.com"), ("t", "evil.com")],
                                  "site string, domain string")
    assert [r.pos for r in fr.link_present(links).collect()] == [1, 3, 4, 5, 6, 7, 8, 9]
    assert [r.pos for r in fr.link_text_deny(links).collect()] == [1, 4, 5, 6, 7, 8, 9]
    kept = fr.offsite_filter(fr.link_present(links), sites, "href")
    assert sorted(r.pos for r in kept.collect()) == [1, 3, 7, 8] and kept.columns == links.columns
    assert fr.offsite_filter(links.withColumn("site", F.lit(None).cast("string")), sites, "href").count() == 0


def test_menu_links_with_other_attributes_entities_and_nested_text(spark):
    html = ('<li><a href="/a">A</a></li><li class="x"><a class="k" href="/b?x=1&amp;y=2"><b>B</b> &amp; C</a></li>'
            '<li> <a data-href="/no" id="q">none</a></li><li><a href="/d"><i></i><span>D</span></a></li>')
    rows = fr.menu_links(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).collect()
    assert [(r.pos, r.href, r.text) for r in rows] == [
        (1, "/a", "A"), (2, "/b?x=1&y=2", "B & C"), (3, None, "none"), (4, "/d", "D")]


def falabella_menu(*parts):
    """'=X' a category, '+X' a group with that title, '+' one without, 'X:/u' a link."""
    out, open_ = "", False
    for p in parts:
        if p[0] in "=+" and open_:
            out, open_ = out + "</ul>", False
        if p[0] == "=":
            out += f'<div class="c FirstLevelCategories-module_categoryTitle__z"><span>{p[1:]}</span></div>'
        elif p[0] == "+":
            out, open_ = out + '<ul id="u" class="SecondLevelCategories-module_secondLevelCategory__NVToy">', True
            if p[1:]:
                out += f'<li class="SecondLevelCategories-module_secondLevelCategoryTitle__k"><a href="/t">{p[1:]}</a></li>'
        else:
            text, href = p.split(":")
            out += f'<li class="SecondLevelCategories-module_thirdLevelCategory__0VfiO"><a x="1" href="{href}">{text}</a></li>'
    return out + "</ul>"


def menu(spark, html, markup=fr.FALABELLA_MENU):
    return fr.menu_groups(spark.createDataFrame([(1, "https://h/x/", html)], "page_id long, url string, html string"), markup)


def test_menu_links_carry_their_category_and_group(spark):
    html = falabella_menu("+lost", "a:/0", "=Cat &amp; Co", "+One", "b:/1", "c:/2", "+", "d:/3", "+Two", "e:/4", "=Next", "+One", "f:/5")
    got = [(r.category, r.category_pos, r.sub_category, r.group_pos, r.pos, r.href, r.text) for r in menu(spark, html).collect()]
    assert got == [("Cat & Co", 1, "One", 2, 1, "/1", "b"), ("Cat & Co", 1, "One", 2, 2, "/2", "c"),
                   ("Cat & Co", 1, "Two", 4, 3, "/4", "e"), ("Next", 2, "One", 5, 4, "/5", "f")]


def test_cruz_verde_menu_groups_are_named_after_their_last_link(spark):
    def group(*links):
        return '<li class="ng-star-inserted">' + "".join(
            f'<at-link _n=""><a class="q" href="{h}"><span>{t}</span></a></at-link>' for t, h in links) + "</li>"
    title = '<div class="flex-1 hover:bg-main hover:text-white option text-gray-darkest ng-star-inserted"><h4>Belleza</h4></div>'
    html = title + group(("Rostro", "/r"), ("Cremas", "/r/c"), ("Conoce m&aacute;s", "/r/x")) + group(("Solo", "/s"))
    links = menu(spark, html, fr.CRUZVERDE_CL_MENU)
    assert {r.sub_category for r in links.collect()} == {None}
    named = fr.last_child_label(links, ["page_id", "category", "group_pos"])
    assert sorted((r.label, r.href) for r in named.collect())[-1] == ("Solo", "/s")


def reference_requests(rows):
    """The loops over nested dictionaries that the tree stands for."""
    tree, seen = {}, None
    for category, category_pos, sub, group, url in rows:
        if category_pos != seen:
            seen, tree[category] = category_pos, {}
        links = tree[category].get(sub)
        tree[category][sub] = (group, [*(links[1] if links and links[0] == group else []), url])
    return [(c, s, u) for c, subs in tree.items() for s, (_, urls) in subs.items() for u in urls]


def test_menu_tree_keeps_a_dictionary_order(spark):
    html = falabella_menu("=Z", "+b", "1:/1", "2:/2", "+a", "3:/3", "=A", "+x", "4:/4", "+b", "5:/5", "+x", "6:/6", "=Z",
                          "+c", "7:/7", "+a", "8:/8", "+c", "9:/9", "10:/10")
    links = menu(spark, html)
    rows = [(r.category, r.category_pos, r.sub_category, r.group_pos, r.href) for r in links.collect()]
    tree = fr.menu_tree(links.withColumn("url", fr.resolve_link("url", "href")), ["page_id"])
    flat = fr.menu_flatten(tree, ["page_id"]).orderBy("request_index").collect()
    want = reference_requests(rows)
    assert [(r.category, r.sub_category, r.href) for r in flat] == want
    assert want == [("Z", "c", "/9"), ("Z", "c", "/10"), ("Z", "a", "/8"), ("A", "x", "/6"), ("A", "b", "/5")]
    assert [r.request_index for r in flat] == list(range(5)) and flat[0].url == "https://h/9"


def test_menu_tree_last_group_wins(spark):
    rows = [("Cat", "Sub", 1, 1, "u1"), ("Cat", "Sub", 1, 2, "u2"), ("Cat", "Sub", 5, 1, "u9"),
            ("Cat", "Other", 2, 1, "o1")]
    groups = spark.createDataFrame(rows, "category string, sub_category string, group_pos long, pos int, url string")
    tree = sorted((r.sub_category, r.url) for r in fr.menu_tree(groups).collect())
    assert tree == [("Other", "o1"), ("Sub", "u9")]
    # 'Sub' was named first, so its links come first, though they are those of the later naming
    flat = fr.menu_flatten(fr.menu_tree(groups)).orderBy("request_index").collect()
    assert [r.url for r in flat] == ["u9", "o1"]


def test_last_child_label(spark):
    rows = [(1, 1, "/t", "Title"), (1, 2, "/a", "Alpha"), (1, 3, "/x", "Conoce más"),
            (2, 1, "/solo", "Solo")]
    links = spark.createDataFrame(rows, "page_id long, pos int, href string, text string")
    out = sorted((r.page_id, r.href, r.label) for r in fr.last_child_label(links).collect())
    # several links: named after the last one (even the denied one); the
    # first link is the title and gives no URL
    assert out == [(1, "/a", "Conoce más"), (2, "/solo", "Solo")]


def test_route_by_size(spark):
    df = spark.createDataFrame([(1400,), (1401,)], "n long")
    assert [r.r for r in df.select(fr.route_by_size("n").alias("r")).collect()] == ["direct", "discover"]


def _log(spark, found_by_cat):
    rows = [("s", cat, i + 1, f, i + 1) for cat, found in found_by_cat.items() for i, f in enumerate(found)]
    return spark.createDataFrame(rows, "site string, category string, page_number int, products_found int, "
                                       "active_page int")


def test_stop_on_empty_pages(spark):
    log = _log(spark, {"A": [5, 0, 0, 3, 0, 0, 0, 4], "B": [0, 0, 1, 0, 0], "C": [1] * 250})
    out = {r.category: (r.stop_page, r.stop_reason) for r in cl.stop_on_empty_pages(log).collect()}
    assert out == {"A": (7, "empty_pages"), "B": (5, "last_page"), "C": (200, "max_pages")}


def test_running_total_and_advance(spark):
    log = _log(spark, {"A": [2, 0, 3], "B": [1]})
    tot = {(r.category, r.page_number): r.running_total for r in cl.running_total(log).collect()}
    assert tot == {("A", 1): 2, ("A", 2): 2, ("A", 3): 5, ("B", 1): 1}
    moved = cl.page_advance_check(log.withColumn(
        "active_page", F.when(F.col("page_number") == 3, 9).otherwise(F.col("active_page"))))
    assert sorted((r.page_number, r.moved_ok) for r in moved.collect()) == [(2, True), (3, False)]


def test_page_numbers_and_totals_in_one_pass(spark):
    visits = spark.range(0, 600).selectExpr(
        "'s' AS site", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('c', id % 7) END AS category",
        "id % 50 AS visited_at", "id AS event_id", "id % 5 AS products_found")
    got = {r.event_id: (r.page_number, r.running_total) for r in cl.numbered_running_total(visits).collect()}
    seen = {}
    for r in sorted(visits.collect(), key=lambda r: (r.category, r.visited_at, r.event_id)):
        n, total = seen.get(r.category, (0, 0))
        seen[r.category] = (n + 1, total + r.products_found)
        assert got[r.event_id] == seen[r.category]
    assert len(got) == 600


def test_next_page(spark):
    def pager(active, pages):
        spans = "".join(f'<span class="pagination__item page-number{" active" if p == active else ""}">{p}</span>'
                        for p in pages)
        return f'<div class="pagination"><div class="pagination__nav">{spans}</div></div>'
    html = [pager("2", ["1", "2", "3", "...", "9"]), pager("9", ["8", "9"]), "<div>no pager</div>",
            pager("x", ["x", "2"])]
    df = spark.createDataFrame([(h,) for h in html], "html string")
    cur, last, nxt = cl.next_page("html")
    out = [(r.c, r.l, r.n) for r in df.select(cur.alias("c"), last.alias("l"), nxt.alias("n")).collect()]
    assert out == [(2, 9, 3), (9, 9, None), (None, None, None), (None, None, None)]


def test_classify_failures(spark):
    t = "<class 'playwright._impl._errors.TimeoutError'>"
    rows = [(1, "https://h/cat-a/sub-b", t, 0), (2, "https://h/cat-a/sub-b", t, 1), (3, "https://h/c/d", t, 2),
            (4, "about:blank", "HttpError", 0)]
    df = spark.createDataFrame(rows, "request_id long, url string, error_type string, retry_count int")
    out = {r.request_id: (r.outcome, r.next_retry_count, r.next_timeout_ms, r.category_label)
           for r in cl.classify_failures(df).collect()}
    assert out == {1: ("retry", 1, 45000, "Cat A"), 2: ("retry", 2, 45000, "Cat A"),
                   3: ("gave_up", None, None, "C"), 4: ("error", None, None, "Unknown")}


def test_seed_selector_counts_and_one_scan_union(spark):
    seeds = spark.range(0, 300).selectExpr(
        "CASE id % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE 'electro' END AS part",
        "'c' AS category", "'s' AS sub_category", "id AS seq")
    runs = spark.createDataFrame([(1, "super", "1"), (2, None, None), (3, "electro", "x")],
                                 "run_id long, category string, part string")
    assert fr.seed_selector(runs, seeds).count() == 100 + 300 + 100
    lists = fr.union_seed_lists(seeds, ("2", "1", "2")).groupBy("list_no").count().orderBy("list_no").collect()
    assert [(r.list_no, r["count"]) for r in lists] == [(0, 100), (1, 100), (2, 100)]
