"""The crawl frontier as table operators.

The reference builds its request lists in Python loops and dicts.  Here the
seeds, menu links and requests are rows, and every step is a DataFrame
transform: explode, filter, join, aggregate.  No list is ever gathered into
one row; where the reference keeps "the last one" of something, a partial
aggregate finds the winner and a join keeps its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions.text import col, strip_text
from priceflow.operators.extract import decode_entities, tag
from priceflow.operators.numbering import sequence_number

ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


# -- sources of URLs ----------------------------------------------------------------

def custom_url_source(df: DataFrame, text_col: str = "custom_urls") -> DataFrame:
    """S3: a comma list of URLs -> one row per URL, trimmed, in order.

    Empty items are kept, as a plain split keeps them.  Adds ``url_index``
    (0-based) and ``url``.
    """
    parts = F.split(col(text_col), ",")
    return (df.select("*", F.posexplode(parts).alias("url_index", "_raw"))
            .withColumn("url", strip_text("_raw")).drop("_raw"))


def expand_seed_urls(seeds: DataFrame, base: str | Column, template: str = "/{category}/{sub}"
                     ) -> DataFrame:
    """One request URL per (category, sub-category) seed row, kept in
    seed order, repeats kept."""
    base_c = F.lit(base) if isinstance(base, str) else base
    pieces = []
    for i, part in enumerate(template.replace("{category}", "\0c\0").replace("{sub}", "\0s\0").split("\0")):
        if part == "c":
            pieces.append(F.col("category"))
        elif part == "s":
            pieces.append(F.col("sub_category"))
        elif part:
            pieces.append(F.lit(part))
    return seeds.withColumn("url", F.concat(base_c, *pieces))


def union_seed_lists(seeds: DataFrame, parts: Sequence[str] = ("1", "2", "electro")) -> DataFrame:
    """Concatenate the seed lists in the given order (repeats kept).

    ``list_no`` is the list's place in the concatenation, so
    (list_no, seq) orders the result as the reference's ``a + b + c``.
    """
    places = F.array_compact(F.array(*[F.when(F.col("part") == p, F.lit(i)) for i, p in enumerate(parts)]))
    return seeds.select("*", F.explode(places).alias("list_no"))


def seed_selector(requests: DataFrame, seeds: DataFrame, scope: str = "supermarket",
                  electro: str = "electronic") -> DataFrame:
    """pick seed lists by the run's (category, part) arguments.

    ``category`` is tested as a substring of the scope word ('super' picks
    the supermarket lists), then ``part``; no category picks every list; no
    match picks none.  One row per (run, seed).

    The join key ``part`` has three values, so a list is a hot key: the join
    is left to the planner, which broadcasts the picks (runs x lists) when it
    has measured them small and otherwise splits the hot partitions (AQE skew
    join, see ``session.PIPELINE_CONF``).
    """
    cat, part = F.col("category"), F.col("part")
    none = cat.isNull() | (cat == "")
    in_scope = F.lit(scope).contains(cat)
    chosen = (F.when(none, F.array(F.lit("1"), F.lit("2"), F.lit("electro")))
              .when(in_scope & (part == "1"), F.array(F.lit("1")))
              .when(in_scope & (part == "2"), F.array(F.lit("2")))
              .when(F.lit(electro).contains(cat), F.array(F.lit("electro")))
              .otherwise(F.array().cast("array<string>")))
    picks = requests.select("run_id", F.explode(chosen).alias("part"))
    seeds = seeds.withColumnRenamed("category", "seed_category")
    return seeds.join(picks, "part", "inner")


def number_requests(requests: DataFrame, keys: Sequence[str], order: Sequence[str],
                    ts: Column | str | int = 0) -> DataFrame:
    """Running index from 0 within ``keys``; URL gets ``?scrapy_index=i&ts=t``.

    ``ts`` is a column or a value given by the caller, not the clock, so a
    rerun gives the same URLs.  Skew-safe numbering (see ``numbering``).
    """
    numbered = sequence_number(requests, keys, order, "request_index")
    ts_c = F.col(ts) if isinstance(ts, str) else F.lit(ts)
    return (numbered.withColumn("request_index", F.col("request_index") - 1)
            .withColumn("request_url", F.concat(F.col("url"), F.lit("?scrapy_index="),
                                                F.col("request_index").cast("string"),
                                                F.lit("&ts="), ts_c.cast("string"))))


# -- links -----------------------------------------------------------------------------

ANCHOR = r"<a\b([^>]*)>(.*?)</a>"
MENU_LINK_PATTERN = "(?s)" + tag("li") + r"\s*" + ANCHOR


class MenuMarkup(NamedTuple):
    """Patterns of a menu: category title, start of a group, its title ('' if none), its links."""

    category: str
    group: str
    title: str
    link: str


_LEVEL_2 = "SecondLevelCategories-module_"
FALABELLA_MENU = MenuMarkup(
    tag("div", "class", '[^"]*FirstLevelCategories-module_categoryTitle__[^"]*') + ".*?</div>",
    tag("ul", "class", f'[^"]*{_LEVEL_2}secondLevelCategory__NVToy[^"]*'),
    tag("li", "class", f'[^"]*{_LEVEL_2}secondLevelCategoryTitle__[^"]*') + r"\s*" + ANCHOR,
    tag("li", "class", f"{_LEVEL_2}thirdLevelCategory__0VfiO") + r"\s*" + ANCHOR)
CRUZVERDE_CL_MENU = MenuMarkup(
    tag("div", "class", '[^"]*flex-1 hover:bg-main hover:text-white option text-gray-darkest ng-star-inserted[^"]*')
    + r"\s*" + tag("h4") + ".*?</h4>",
    tag("li", "class", "ng-star-inserted"), "", tag("at-link") + r"\s*" + ANCHOR)


def _visible_text(markup: Column) -> Column:
    return strip_text(decode_entities(F.regexp_replace(markup, "<[^>]*>", "")))


def _href(markup: Column) -> Column:
    found = F.regexp_extract_all(markup, F.lit(r'<a\b[^>]*\shref="([^"]*)"'), F.lit(1))
    return decode_entities(F.get(found, F.lit(0)))


def menu_links(pages: DataFrame, pattern: str = MENU_LINK_PATTERN) -> DataFrame:
    """C5, plain: list anchors of a page -> (page_id, url, pos, href, text) rows.

    The tags may have any attributes; texts and addresses are decoded; an
    anchor without an address has a NULL href.
    """
    anchors = F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
    return (pages.select("page_id", "url", F.posexplode(anchors).alias("pos0", "anchor"))
            .select("page_id", "url", (F.col("pos0") + 1).cast("int").alias("pos"),
                    _href(F.col("anchor")).alias("href"), _visible_text(F.col("anchor")).alias("text")))


def menu_groups(pages: DataFrame, markup: MenuMarkup) -> DataFrame:
    """A menu's links with the category and sub-category that they stand under.

    The menu's titles, group starts and links are taken as one array in document
    order, and one fold carries the last category and sub-category along it.  Adds
    (category, category_pos, sub_category, group_pos, pos, href, text): the positions are
    the running numbers of the category title, the group and the link.  A group's first
    title names it; a link before any category, or in a group without its title, is
    none of the menu's.  Menus without group titles give a NULL sub-category.
    """
    kinds = [p for p in markup if p]
    tokens = F.regexp_extract_all("html", F.lit("(?s)" + "|".join(f"(?:{p})" for p in kinds)), F.lit(0))

    def described(token: Column) -> Column:
        # only the opening tag tells the kind: what follows may hold anything
        kind = F.when(token.rlike("(?s)^" + markup.category), "category").when(token.rlike("^" + markup.group), "group")
        if markup.title:
            kind = kind.when(token.rlike("(?s)^" + markup.title), "title")
        return F.struct(kind.otherwise("link").alias("kind"), _visible_text(token).alias("text"),
                        _href(token).alias("href"))

    def state(s: Column, **changed: Column) -> Column:
        return F.struct(*[changed.get(f, s[f]).alias(f) for f in (
            "category", "category_pos", "sub_category", "group_pos", "links")])

    def step(s: Column, t: Column) -> Column:
        named = s["sub_category"].isNotNull() if markup.title else F.lit(True)
        link = F.struct(s["category"].alias("category"), s["category_pos"].alias("category_pos"),
                        s["sub_category"].alias("sub_category"), s["group_pos"].alias("group_pos"),
                        t["href"].alias("href"), t["text"].alias("text"))
        none = F.lit(None).cast("string")
        return (F.when(t["kind"] == "category", state(s, category=t["text"], category_pos=s["category_pos"] + 1,
                                                      sub_category=none))
                .when(t["kind"] == "group", state(s, group_pos=s["group_pos"] + 1, sub_category=none))
                .when(t["kind"] == "title", state(s, sub_category=F.coalesce(s["sub_category"], t["text"])))
                .when(s["category"].isNotNull() & named, state(s, links=F.concat(s["links"], F.array(link))))
                .otherwise(s))

    row = ("category:string,category_pos:int,sub_category:string,group_pos:int")
    zero = F.struct(F.lit(None).alias("category"), F.lit(0).alias("category_pos"), F.lit(None).alias("sub_category"),
                    F.lit(0).alias("group_pos"), F.array().alias("links")).cast(
                        f"struct<{row},links:array<struct<{row},href:string,text:string>>>")
    links = F.aggregate(F.transform(tokens, described), zero, step, lambda s: s["links"])
    found = pages.select("page_id", "url", F.posexplode(links).alias("pos0", "link"))
    return found.select("page_id", "url", (F.col("pos0") + 1).cast("int").alias("pos"), "link.*")


def url_origin(url: Column | str) -> Column:
    return F.regexp_extract(col(url), ORIGIN, 1)


def url_host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(url), HOST, 1))


# scheme, //host, path, ?query, #fragment
URL_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _url_parts(url: Column) -> list[Column]:
    return [F.regexp_extract(url, URL_PARTS, k) for k in range(1, 6)]


def _collapse(segments: Column) -> Column:
    """Path segments with '.' dropped and '..' taking back the one before."""
    return F.aggregate(segments, F.array().cast("array<string>"), lambda kept, s: F.when(
        s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept).otherwise(F.concat(kept, F.array(s))))


def resolve_link(base: Column | str, href: Column | str) -> Column:
    """C4: an address joined to its page's URL, as ``urljoin`` joins them.

    A fold over the path's segments keeps them as a stack: '.' is dropped, '..' takes
    back the one before.  An address with a scheme other than the page's (``mailto:``)
    stays as it is; leading blanks and line ends are dropped.  Pages are http or https.
    """
    b, h = col(base), col(href)
    clean = F.regexp_replace(F.regexp_replace(h, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    b_scheme, b_host, b_path, b_query, _ = _url_parts(b)
    scheme, host, path, query, fragment = _url_parts(clean)
    base_scheme = F.lower(b_scheme)
    own_scheme = F.when(scheme == "", base_scheme).otherwise(F.lower(scheme))
    before = F.split(b_path, "/")
    before = F.when(F.element_at(before, -1) != "", F.slice(before, 1, F.size(before) - 1)).otherwise(before)
    after = F.split(path, "/")
    below = F.concat(before, after)
    below = F.filter(below, lambda s, i: (s != "") | (i == 0) | (i == F.size(before) + F.size(after) - 1))
    segments = F.when(path.startswith("/"), after).otherwise(below)
    ends = F.element_at(segments, -1)
    kept = _collapse(segments)
    kept = F.when(ends.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(kept, "/")
    whole = F.when(host != "", path).when(path == "", b_path).otherwise(F.when(joined == "", "/").otherwise(joined))
    asked = F.when((host == "") & (path == "") & (query == ""), b_query).otherwise(query)
    place = F.when(host != "", host).otherwise(b_host)
    slash = F.when((place != "") & (whole != "") & ~whole.startswith("/"), "/").otherwise("")
    full = F.concat(own_scheme, F.lit("://"), place, slash, whole,
                    F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""),
                    F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))
    return F.when(h == "", b).when(own_scheme != base_scheme, h).otherwise(full)


def link_present(links: DataFrame, href: str = "href") -> DataFrame:
    """keep anchors that have an href."""
    return links.where(F.col(href).isNotNull() & (F.col(href) != ""))


def link_text_deny(links: DataFrame, text: str = "text",
                   phrases: Sequence[str] = tuple(rules.CRUZVERDE_CL_DENIED_LINK_TEXTS)) -> DataFrame:
    """drop links whose text contains any of the phrases."""
    t = strip_text(text)
    cond = F.lit(False)
    for p in phrases:
        cond = cond | F.contains(t, F.lit(p))
    return links.where(~cond)


def host_suffixes(url: Column | str) -> Column:
    """'a.b.c' -> ['a.b.c', 'b.c', 'c']: a URL's host and the domains it is under."""
    labels = F.split(url_host(url), r"\.")
    return F.transform(labels, lambda x, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def offsite_filter(links: DataFrame, sites: DataFrame, url: str = "url", site: str = "site",
                   domain: str = "domain") -> DataFrame:
    """F8: keep URLs whose host is an allowed domain of their site, or under one.

    A host becomes its label suffixes and meets the site's domains by equality, so any
    number of sites and domains is one equi-join and 'xshop.com' is not under 'shop.com'.
    A link without a host or a site is dropped.
    """
    allowed = sites.select(F.col(site).alias("_site"), F.lower(domain).alias("_domain")).distinct()
    # a domain under another of its site allows nothing more, and would repeat links
    wider = F.slice(F.split("_domain", r"\."), 2, F.size(F.split("_domain", r"\.")))
    under = allowed.select("_site", "_domain", F.explode(
        F.transform(wider, lambda x, i: F.array_join(F.slice(wider, i + 1, F.size(wider)), "."))).alias("_wider"))
    under = under.join(allowed.select("_site", F.col("_domain").alias("_wider")), ["_site", "_wider"], "left_semi")
    allowed = allowed.join(under, ["_site", "_domain"], "left_anti")
    found = links.withColumn("_suffix", F.explode(host_suffixes(url)))
    return found.join(allowed, (F.col(site) == F.col("_site")) & (F.col("_suffix") == F.col("_domain")),
                      "left_semi").drop("_suffix")


def distinct_links(links: DataFrame, keys: Sequence[str] = ("site", "url")) -> DataFrame:
    """Each (site, URL) once."""
    return links.dropDuplicates(list(keys))


# -- menus ---------------------------------------------------------------------------

def menu_tree(groups: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Category -> sub-category -> links, with a dictionary's order.

    ``groups`` holds (run, category, sub_category, group_pos, pos, url) rows, and
    category_pos where categories can be named again.  A sub-category named again
    replaces the links of the earlier one but keeps its place; a category named again
    starts empty and keeps its place.  So one aggregate per level takes the place of
    the first naming (``category_place``, ``place``) and the links of the last.

    With ``run``, a run's links come from one menu page, which bounds the group: both
    levels are windows over one shuffle by run, and the menu is parsed once.  Without,
    a category may be hot: partial aggregates find the winners and joins keep them.
    """
    run = list(run)
    if run:
        groups = groups.repartition(*run)
        if "category_pos" not in groups.columns:  # no category is named again
            first = F.min("group_pos").over(Window.partitionBy(*run, "category"))
            groups = groups.withColumn("category_pos", first)
        for level, pos, place in ((["category"], "category_pos", "category_place"),
                                  (["category", "sub_category"], "group_pos", "place")):
            of = Window.partitionBy(*run, *level)
            groups = groups.withColumns({place: F.min(pos).over(of), "_last": F.max(pos).over(of)}).where(
                F.col(pos) == F.col("_last")).drop("_last")
        return groups
    if "category_pos" in groups.columns:
        last = groups.groupBy(*run, "category").agg(
            F.min("category_pos").alias("category_place"), F.max("category_pos").alias("category_pos"))
        groups = groups.join(last, [*run, "category", "category_pos"])
    else:
        first = groups.groupBy(*run, "category").agg(F.min("group_pos").alias("category_place"))
        groups = groups.join(first, [*run, "category"])
    last = groups.groupBy(*run, "category", "sub_category").agg(
        F.min("group_pos").alias("place"), F.max("group_pos").alias("group_pos"))
    return groups.join(last, [*run, "category", "sub_category", "group_pos"])


def menu_flatten(tree: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """One request per URL of the tree, numbered from 0 in dictionary order.

    With ``run``, the numbers start anew for each run; its links come from one menu,
    so the window is bounded by that page.  Without, the whole tree is numbered in
    slices (see ``numbering``).
    """
    order = ["category_place", "place", "pos"]
    if not run:
        return sequence_number(tree, [], order, "request_index").withColumn(
            "request_index", F.col("request_index") - 1)
    return tree.withColumn("request_index", (
        F.row_number().over(Window.partitionBy(*run).orderBy(*order)) - 1).cast("bigint"))


def last_child_label(links: DataFrame, group: Sequence[str] = ("page_id",),
                     deny: Sequence[str] = tuple(rules.CRUZVERDE_CL_DENIED_LINK_TEXTS)) -> DataFrame:
    """A link group is named after its last link (even one dropped by
    F3) when it has several, else after its only link.  With several links
    the first one is the group's title and gives no URL; the others give
    URLs unless their text is denied or they have no href.

    Returns the group's links with ``label``.
    """
    group = list(group)
    stats = links.groupBy(*group).agg(
        F.max_by(strip_text("text"), F.col("pos")).alias("last_text"),
        F.min_by(strip_text("text"), F.col("pos")).alias("first_text"),
        F.count(F.lit(1)).alias("n_links"))
    labelled = links.join(stats, group, "inner").withColumn(
        "label", F.when(F.col("n_links") > 1, F.col("last_text")).otherwise(F.col("first_text")))
    several = labelled.where((F.col("n_links") > 1) & (F.col("pos") > 1))
    single = labelled.where(F.col("n_links") == 1)
    kept = link_present(link_text_deny(several, "text", deny)).unionByName(link_present(single))
    return kept.drop("last_text", "first_text")


def route_by_size(count: Column | str, threshold: int = rules.DISCOVER_THRESHOLD) -> Column:
    """More than the threshold -> 'discover' sub-categories, else 'direct'."""
    return F.when(col(count) > threshold, F.lit("discover")).otherwise(F.lit("direct"))


# -- category filters ----------------------------------------------------------------

def category_allow_list(df: DataFrame, allowed: Sequence[str] | DataFrame,
                        column: str = "category") -> DataFrame:
    """keep the named categories (a list, or a one-column DataFrame that
    is semi-joined, so a long list need not fit in the plan)."""
    if isinstance(allowed, DataFrame):
        other = allowed.toDF(column).distinct()
        return df.join(other, column, "left_semi")
    return df.where(F.col(column).isin(*allowed))


def category_deny(df: DataFrame, denied: str = rules.CRUZVERDE_CL_DENIED_CATEGORY,
                  column: str = "category") -> DataFrame:
    """drop one category (a row without a category is kept, as
    Python's ``!=`` keeps it)."""
    return df.where(~F.col(column).eqNullSafe(denied))


def special_category_pick(df: DataFrame, special: str = rules.CRUZVERDE_SPECIAL_CATEGORY,
                          links: Sequence[str] = tuple(rules.CRUZVERDE_SPECIAL_LINKS),
                          sub: str = rules.CRUZVERDE_SPECIAL_SUB,
                          column: str = "category") -> DataFrame:
    """only the special category is followed, through a fixed link list
    and a fixed sub-category."""
    picked = df.where(F.col(column) == special)
    return picked.select("*", F.posexplode(F.array(*[F.lit(x) for x in links])).alias("link_pos", "link_url")
                         ).withColumn("sub_category", F.lit(sub))
