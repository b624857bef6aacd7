"""Price text -> number (N1-N8).  Column -> Column, built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from priceflow.functions.text import blank_to_null, col, strip_text, to_double


def _drop_currency_and_dots(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("$"), F.lit("")), F.lit("."), F.lit(""))


def price_dot_thousands(c: Column | str, digits_only: bool = False) -> Column:
    """N1: '$ 12.900,50' -> 12900.5 ('.' groups thousands, ',' is decimal).

    ``digits_only`` also deletes whatever is left that is not a digit or a
    dot (the Colombian Cruz Verde form).
    """
    text = strip_text(F.replace(_drop_currency_and_dots(col(c)), F.lit(","), F.lit(".")))
    if digits_only:
        text = F.regexp_replace(text, r"[^\d.]", "")
    return to_double(text)


def price_dot_thousands_nocomma(c: Column | str) -> Column:
    """Drop '$' and '.', nothing else; a decimal comma gives NULL."""
    return to_double(strip_text(_drop_currency_and_dots(col(c))))


def price_digits_only(c: Column | str) -> Column:
    """Keep digits and dots only ('1,299.00' -> 1299.0); empty -> NULL."""
    return to_double(F.regexp_replace(col(c), r"[^\d.]", ""))


def price_min_of_list(c: Column | str, marker: str = "S/") -> Column:
    """N4: 'S/ 5.20S/ 2.20' -> 2.2, the lowest of the listed prices.

    Parts that are empty or not a number are skipped; no marker or no
    number at all gives 0.0.
    """
    c = col(c)
    parts = F.split(c, marker)
    cleaned = F.transform(parts, lambda p: F.regexp_replace(strip_text(p), r"[^\d.]", ""))
    values = F.filter(F.transform(cleaned, lambda p: to_double(p)), lambda v: v.isNotNull())
    lowest = F.array_min(values)
    return F.when(F.contains(c, F.lit(marker)), F.coalesce(lowest, F.lit(0.0))).otherwise(F.lit(0.0))


def price_range_upper(c: Column | str) -> Column:
    """N5: '$ 9.990 - $ 12.990' -> '$ 12.990' (text after the last '-')."""
    return strip_text(F.element_at(F.split(col(c), "-"), -1))


def price_fallback_chain(*texts: Column | str) -> Column:
    """The first price element that exists wins, even if unparsable."""
    return F.coalesce(*[blank_to_null(t) for t in texts])


def count_from_text(c: Column | str) -> Column:
    """N7: '1.432 productos' -> 1432; no digits -> 0."""
    return F.coalesce(F.regexp_replace(col(c), r"[^\d]", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def zero_price(c: Column | str) -> Column:
    """A price of 0 is treated as missing."""
    c = col(c)
    return F.when(c != 0, c)
