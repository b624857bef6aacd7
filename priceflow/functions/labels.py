"""Labels and stamps (P1-P8).  Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions.text import col, slug_to_label, strip_text, title_case


def stamp_capture(captured_at: Column | str) -> tuple[Column, Column]:
    """result_date 'yyyy-MM-dd' and result_time 'HH:mm:ss'.

    Taken from the snapshot's capture time, not the clock, so a rerun
    writes the same rows.
    """
    ts = col(captured_at)
    return F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")


def label_from_url(url: Column | str, fallback: str | None = None) -> tuple[Column, Column]:
    """The last two path parts, '-' -> ' ', title case.

    With ``fallback`` set, a URL with no '/' gives that label twice.
    """
    parts = F.split(col(url), "/")
    cat, sub = (slug_to_label(slug) for slug in url_slugs(url))
    if fallback is not None:
        enough = F.size(parts) >= 2
        cat = F.when(enough, cat).otherwise(F.lit(fallback))
        sub = F.when(enough, sub).otherwise(F.lit(fallback))
    return cat, sub


def url_slugs(url: Column | str) -> tuple[Column, Column]:
    """The last two path parts, as the address spells them."""
    parts = F.split(col(url), "/")
    return F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))


def label_after_marker(url: Column | str, marker: str = rules.URL_LABEL_MARKER,
                       fallback: str = rules.URL_LABEL_FALLBACK) -> Column:
    """The text after '/categoria/' as a label, else 'General'."""
    u = col(url)
    return F.when(F.contains(u, F.lit(marker)),
                  slug_to_label(F.element_at(F.split(u, marker), -1))
                  ).otherwise(F.lit(fallback))


def url_path_parts(url: Column | str) -> Column:
    """Path of a URL split on '/', scheme and host removed."""
    path = F.regexp_replace(col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?", "")
    return F.split(path, "/")


def breadcrumb_category(crumbs: Column | str, url: Column | str) -> tuple[Column, Column]:
    """P5: category and sub-category from breadcrumbs, else from the URL.

    One crumb -> that crumb twice, title-cased; fewer than two crumbs and at
    least two path parts -> the path parts, title-cased; no crumb and one
    part -> that part twice; two or more crumbs -> the first two unchanged.
    """
    slugs, kept = breadcrumb_slugs(crumbs, url)
    cat, sub = (F.coalesce(slug_to_label(slug), text) for slug, text in zip(slugs, kept, strict=True))
    return cat, sub


def breadcrumb_slugs(crumbs: Column | str, url: Column | str
                     ) -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    """P5 before title case: (the texts to be title-cased, the crumbs to be left unchanged);
    of each two, one is NULL."""
    cr, parts = col(crumbs), url_path_parts(url)
    n_cr, n_parts = F.size(cr), F.size(parts)
    c0, c1 = F.try_element_at(cr, F.lit(1)), F.try_element_at(cr, F.lit(2))
    p0, p1 = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    one_crumb = n_cr == 1
    from_path = (n_cr < 2) & (n_parts >= 2)
    single_part = (n_parts == 1) & (n_cr < 1)
    slugs = (F.when(one_crumb, c0).when(from_path | single_part, p0),
             F.when(one_crumb, c0).when(from_path, p1).when(single_part, p0))
    unchanged = ~F.coalesce(one_crumb | from_path | single_part, F.lit(False))
    return slugs, (F.when(unchanged, c0), F.when(unchanged, c1))


def constant_category() -> tuple[Column, Column]:
    """Inkafarma's fixed category, no sub-category."""
    return F.lit(rules.INKAFARMA_CATEGORY), F.lit(None).cast("string")


def compose_name(name: Column | str, presentation: Column | str) -> Column:
    """P7: 'name - presentation' when both exist, else name, else 'Sin nombre'."""
    return join_name(F.coalesce(strip_text(name), F.lit("")), F.coalesce(strip_text(presentation), F.lit("")))


def join_name(n: Column, p: Column) -> Column:
    """``compose_name`` of texts that are stripped and not NULL."""
    return (F.when((n != "") & (p != ""), F.concat(n, F.lit(" - "), p))
            .when(n != "", n).otherwise(F.lit(rules.NO_NAME)))


def display_name(slug: Column | str) -> Column:
    """P8: 'carnes_aves-y-pescados' -> 'Carnes Aves Y Pescados'."""
    return title_case(F.regexp_replace(col(slug), "[_-]", " "))
