"""The crawl's own bookkeeping as queries.

The reference keeps counters in loop variables while it pages through a
category.  Here the visited pages are a table, ``crawl_log(site, category,
page_number, products_found, active_page, ...)`` with page numbers 1, 2, ...
per category, and each rule is a join or an aggregate over it.

Neighbouring pages are matched by emitting each page under the page
numbers it relates to and grouping by (site, category, page_number), instead
of ``lag`` over a window: the grouping key includes the page number, so a
category holding a third of the log is spread over all tasks instead of
landing in one, and the log is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions.labels import label_from_url
from priceflow.functions.text import col, strip_text
from priceflow.operators.extract import tag
from priceflow.operators.numbering import running_sum, running_values

KEYS = ("site", "category")


def stop_on_empty_pages(log: DataFrame, keys: Sequence[str] = KEYS, page: str = "page_number",
                        found: str = "products_found", run: int = rules.MAX_CONSECUTIVE_EMPTY,
                        max_pages: int = rules.MAX_PAGES) -> DataFrame:
    """Where each category's crawl stops.

    A page with no valid product is empty; ``run`` empty pages in a row end
    the category (a good page resets the count); at most ``max_pages`` pages
    are read; otherwise the last page ends it.  One row per category:
    (keys, last_page, stop_page, stop_reason).

    One pass over the log: page p is a member of the runs that would end at
    p, p+1, ..., p+run-1, so it is exploded into those candidate ends, with
    one bit per member; a candidate whose ``run`` members are all empty is a
    run end.  A page read again sets the same bit, and one good reading of it
    makes it good.  The first aggregate is keyed by page (no skew), the
    second, per category, is a partial aggregate.
    """
    keys = list(keys)
    p = F.col(page)
    empty = F.coalesce(F.col(found) == 0, F.lit(False))
    entries = F.array(*[
        F.struct((p + k).alias("_end"), F.lit(int(k == 0)).alias("_page"),
                 F.when(empty, F.lit(1 << k)).otherwise(0).alias("_empty"),
                 F.when(empty, F.lit(0)).otherwise(1 << k).alias("_good")) for k in range(run)])
    exploded = log.select(*keys, F.inline(entries))
    ends = (exploded.groupBy(*keys, "_end")
            .agg(F.max("_page").alias("_is_page"), F.bit_or("_empty").alias("_e"), F.bit_or("_good").alias("_g"))
            .withColumn("_members", F.bit_count(F.col("_e").bitwiseAND(F.bitwise_not(F.col("_g"))))))
    per_cat = ends.groupBy(*keys).agg(
        F.max(F.when(F.col("_is_page") == 1, F.col("_end"))).alias("last_page"),
        F.min(F.when((F.col("_members") >= run) & (F.col("_is_page") == 1), F.col("_end")))
         .alias("first_run_end"))
    limit = F.least(F.col("last_page"), F.lit(max_pages))
    by_run = F.col("first_run_end").isNotNull() & (F.col("first_run_end") <= limit)
    return per_cat.select(
        *keys, F.col("last_page").cast("int").alias("last_page"),
        F.when(by_run, F.col("first_run_end")).otherwise(limit).cast("int").alias("stop_page"),
        F.when(by_run, F.lit("empty_pages"))
         .when(F.col("last_page") > max_pages, F.lit("max_pages"))
         .otherwise(F.lit("last_page")).alias("stop_reason"))


def category_summary(rows: DataFrame, keys: Sequence[str] = ("site", "category", "sub_category"),
                     page_keys: Sequence[str] = ("page_id", "chunk")) -> DataFrame:
    """C11: valid products, pages and the highest page number per category."""
    return rows.groupBy(*keys).agg(
        F.sum(F.when(F.col("status") == "ok", 1).otherwise(0)).cast("bigint").alias("valid_products"),
        F.count(F.lit(1)).alias("cards"),
        F.count_distinct(*[F.col(k) for k in page_keys]).alias("pages"),
        F.max("page_number").alias("max_page"))


def running_total(log: DataFrame, keys: Sequence[str] = KEYS, page: str = "page_number",
                  found: str = "products_found") -> DataFrame:
    """Products so far after each page (skew-safe running sum)."""
    return running_sum(log, keys, [page], F.col(found).cast("bigint"), "running_total")


def numbered_running_total(visits: DataFrame, keys: Sequence[str] = KEYS,
                           order: Sequence[str] = ("visited_at", "event_id"),
                           found: str = "products_found") -> DataFrame:
    """C12 on visits that have no page numbers yet: both running values in one sliced pass."""
    out = running_values(visits, keys, order, {
        "page_number": F.lit(1).cast("bigint"), "running_total": F.col(found).cast("bigint")})
    return out.withColumn("page_number", F.col("page_number").cast("int"))


PAGINATION = tag("div", "class", "pagination")
PAGE_SPAN = r"<span\b([^>]*)>([^<]+)"


def next_page(html: Column | str) -> tuple[Column, Column, Column]:
    """(current, last, next) page from a page's pagination markup.

    current = the first active number; last = the highest all-digit page
    text, else current; next = current + 1 while current < last.  No
    pagination, no active page or a non-number active text -> NULLs.  When
    there is a pager, page numbers count wherever they stand on the page.
    Classes may come in any order and the tags have other attributes.  White
    space around the active number does not count; around another page's it
    makes the text no number.
    """
    h = col(html)
    paged = F.when(h.rlike(PAGINATION), h)
    spans = F.arrays_zip(F.regexp_extract_all(paged, F.lit(PAGE_SPAN), F.lit(1)).alias("tag"),
                         F.regexp_extract_all(paged, F.lit(PAGE_SPAN), F.lit(2)).alias("text"))
    classed = F.transform(spans, lambda x: F.struct(
        F.regexp_extract(x["tag"], r'\sclass="([^"]*)"', 1).alias("class"), x["text"].alias("text")))

    def has(span: Column, *words: str) -> Column:
        cond = F.lit(True)
        for w in words:
            cond = cond & F.contains(span["class"], F.lit(w))
        return cond

    pages = F.filter(classed, lambda x: has(x, "pagination__item", "page-number"))
    active = strip_text(F.get(F.filter(pages, lambda x: has(x, "active")), F.lit(0))["text"])
    current = F.when(active.rlike(r"^\d+\z"), active.try_cast("int"))
    digits = F.filter(F.transform(pages, lambda x: x["text"]), lambda t: t.rlike(r"^\d+\z"))
    last = F.coalesce(F.array_max(F.transform(digits, lambda t: t.try_cast("int"))), current)
    last = F.when(current.isNotNull(), last)
    nxt = F.when(current < last, current + 1)
    return current, last, nxt


def page_advance_check(log: DataFrame, keys: Sequence[str] = KEYS, page: str = "page_number",
                       active: str = "active_page") -> DataFrame:
    """C14: a move to the next page is good only if the pager then shows
    the expected number (the previous active page + 1).  A page that shows
    no active number is a failed move.

    One pass: every page is emitted as itself at p and as the previous page
    at p+1; grouping by (keys, page) pairs them without a self-join.
    """
    keys = list(keys)
    page_type = log.schema[page].dataType
    both = log.select(*keys, F.inline(F.array(
        F.struct(F.col(page).alias("_p"), F.lit(1).alias("_is"), F.lit(0).alias("_was"),
                 F.col(active).cast("int").alias("_cur"), F.lit(None).cast("int").alias("_prev")),
        F.struct((F.col(page) + 1).cast(page_type).alias("_p"), F.lit(0).alias("_is"), F.lit(1).alias("_was"),
                 F.lit(None).cast("int").alias("_cur"), F.col(active).cast("int").alias("_prev")))))
    paired = (both.groupBy(*keys, "_p")
              .agg(F.max("_is").alias("_is"), F.max("_was").alias("_was"),
                   F.max("_cur").alias("_cur"), F.max("_prev").alias("_prev"))
              .where((F.col("_is") == 1) & (F.col("_was") == 1)))
    return paired.select(
        *keys, F.col("_p").cast(page_type).alias(page),
        (F.col("_prev") + 1).alias("expected_page"), F.col("_cur").alias("active_page"),
        F.coalesce(F.col("_cur") == F.col("_prev") + 1, F.lit(False)).alias("moved_ok"))


def classify_failures(requests: DataFrame, error: str = "error_type", retries: str = "retry_count",
                      url: str = "url") -> DataFrame:
    """A timed-out request is retried (count + 1, longer time limit)
    while it has fewer than two retries, then given up; other failures are
    errors.  Labels come from the URL, 'Unknown' when it has no path."""
    is_timeout = F.contains(F.col(error), F.lit(rules.TIMEOUT_ERROR_MARK))
    count = F.coalesce(F.col(retries), F.lit(0))   # a first failure carries no count
    retry = is_timeout & (count < rules.MAX_TIMEOUT_RETRIES)
    cat, sub = label_from_url(url, fallback=rules.FAILURE_LABEL_FALLBACK)
    return requests.select(
        "*",
        F.when(retry, F.lit("retry")).when(is_timeout, F.lit("gave_up"))
         .otherwise(F.lit("error")).alias("outcome"),
        F.when(retry, count + 1).alias("next_retry_count"),
        F.when(retry, F.lit(rules.RETRY_TIMEOUT_MS)).alias("next_timeout_ms"),
        cat.alias("category_label"), sub.alias("sub_category_label"))
