"""Quantity, unit and unit price (Q1-Q7, U1-U4).  Column -> Column."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions.text import col, last_match, strip_text, to_double


def qty_unit_pattern(units: str) -> str:
    return "(?iuU)" + rules.QTY_UNIT_PATTERN.format(units=units)


def split_quantity(hit: Column | str, pattern: str) -> tuple[Column, Column]:
    """The number and the unit of one 'number unit' text (NULL stays NULL)."""
    number = F.regexp_extract(col(hit), pattern, 1)
    return to_double(F.replace(number, F.lit(","), F.lit("."))), F.regexp_extract(col(hit), pattern, 2)


def quantity_unit_text(name: Column | str, units: str = rules.UNITS_GENERAL,
                       lower_input: bool = False) -> Column:
    """Q1, first half: the last 'number unit' of a name as one text, so that a
    name is scanned once for both parts."""
    text = F.lower(col(name)) if lower_input else col(name)
    return last_match(text, qty_unit_pattern(units), 0)


def quantity_unit_last(name: Column | str, units: str = rules.UNITS_GENERAL,
                       lower_input: bool = False) -> tuple[Column, Column]:
    """Q1: last 'number unit' in a name -> (quantity, unit as written).

    The decimal comma becomes a dot; a dot is kept, so '1.000 ml' is 1.0.
    """
    return split_quantity(quantity_unit_text(name, units, lower_input), qty_unit_pattern(units))


def pack_multiplier(name: Column | str, pattern: str = rules.PACK_PATTERN_JUMBO) -> Column:
    """Q2: pack size after 'x' / 'por' in the lower-cased name.

    Here '.' groups thousands ('por 1.000' -> 1000.0) and ',' is decimal.
    """
    raw = last_match(F.lower(col(name)), "(?iuU)" + pattern, 1)
    return to_double(F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def quantity_default(qty: Column, unit: Column, default_unit: str = rules.DEFAULT_UNIT
                     ) -> tuple[Column, Column]:
    """Q3: nothing found -> 1.0 and the site's default unit."""
    found = qty.isNotNull()
    return (F.when(found, qty).otherwise(F.lit(1.0)),
            F.when(found, unit).otherwise(F.lit(default_unit)))


def presentation_first(text: Column | str) -> tuple[Column, Column, Column]:
    """Q4: first 'number unit' in a presentation text -> (found, qty, unit).

    No word boundary: 'unidades' reads as 'un', 'gr' as 'g'.
    """
    pattern = "(?iuU)" + rules.QTY_PATTERN_INKAFARMA.format(units=rules.UNITS_INKAFARMA)
    text = F.coalesce(col(text), F.lit(""))
    number = F.regexp_extract(text, pattern, 1)     # never empty on a match
    found = number != ""
    qty = to_double(number)
    unit = F.when(found, F.lower(F.regexp_extract(text, pattern, 2)))
    return found, qty, unit


REFERENCE_PATTERN = "(?iuU)" + rules.QTY_PATTERN_PLAZA_VEA.format(units=rules.UNITS_PLAZA_VEA)


def reference_text(name: Column | str, reference: Column | str) -> Column:
    """Q5, first half: the last 'number unit' over lower('name unit-reference')."""
    text = F.lower(F.concat_ws(" ", col(name), F.coalesce(col(reference), F.lit(""))))
    return last_match(text, REFERENCE_PATTERN, 0)


def quantity_with_reference(name: Column | str, reference: Column | str
                            ) -> tuple[Column, Column]:
    """Q5: last 'number unit' over lower('name unit-reference').

    Only dot decimals are numbers here, so '1,5 l' reads as 5 l.
    """
    return split_quantity(reference_text(name, reference), REFERENCE_PATTERN)


def unit_synonyms(unit: Column | str) -> Column:
    """Q6: 'gr' -> 'g', 'litros' -> 'l', 'caja' -> 'pack', ...; others as is."""
    synonyms = F.create_map(*[F.lit(x) for x in chain.from_iterable(rules.UNIT_SYNONYMS.items())])
    u = F.lower(col(unit))
    return F.coalesce(F.try_element_at(synonyms, u), u)


def unit_case(unit: Column | str, mode: str) -> Column:
    """Q7: 'keep', 'lower', or 'strip_lower' the unit as the site does."""
    u = col(unit)
    if mode == "lower":
        return F.lower(u)
    if mode == "strip_lower":
        return F.lower(strip_text(u))
    return u


def unit_price_ratio(price: Column | str, qty: Column | str) -> Column:
    """Price / quantity; NULL where the division fails (quantity 0)."""
    return F.try_divide(col(price), col(qty))


def unit_price_published(text: Column | str, fallback: Column) -> Column:
    """A number with a separator in the site's unit-price text wins.

    '$ 2.450 x kg' -> 2.45 (the dot is read as decimal), '$ 450' has no
    separator so the ratio is used, and so is a missing text.
    """
    t = strip_text(col(text))
    published = to_double(F.replace(F.regexp_extract(t, rules.PUBLISHED_UNIT_PRICE_PATTERN, 1),
                                    F.lit(","), F.lit(".")))
    return F.coalesce(published, fallback)


def round2(x: Column) -> Column:
    """Round to cents as Python's ``round(x, 2)``: on the exact binary value,
    which ``format_number`` uses (``rint(x * 100)`` rounds the product again)."""
    return F.replace(F.format_number(x, 2), F.lit(","), F.lit("")).try_cast("double")


def unit_price_rounded(price: Column | str, qty: Column | str, found: Column) -> Column:
    """Quantity > 0 -> round(price / quantity, 2); else the price."""
    p, q = col(price), col(qty)
    return F.when(found & (q > 0), round2(p / q)).otherwise(p)


def unit_price_by_kind(price: Column | str, qty: Column | str, raw_unit: Column | str
                       ) -> tuple[Column, Column, Column]:
    """U4: Plaza Vea's unit price by kind of unit -> (unit_price, qty, unit).

    Weights, volumes and packs divide; a tray keeps the price and reads as
    grams; units divide only above 1.  No match, or a division by zero,
    gives (price, 1.0, 'unidad').
    """
    raw = F.lower(col(raw_unit))
    return unit_price_by_unit(price, qty, raw == "bandeja", unit_synonyms(raw))


def unit_price_by_unit(price: Column | str, qty: Column | str, is_tray: Column, norm: Column
                       ) -> tuple[Column, Column, Column]:
    """``unit_price_by_kind`` from the unit's synonym and whether it is a tray.

    Both are asked many times here: columns that hold them are looked up once a card.
    """
    p, q = col(price), col(qty)
    fallback = (p, F.lit(1.0), F.lit(rules.DEFAULT_UNIT_PLAZA_VEA))
    matched = q.isNotNull()
    tray = matched & is_tray
    divides = matched & ~tray & (norm != "unidad")
    unit_rule = matched & (norm == "unidad")
    zero = divides & (q == 0)

    def pick(tray_v, div_v, unit_v, fb_v):
        return (F.when(tray, tray_v).when(zero, fb_v).when(divides, div_v)
                .when(unit_rule, unit_v).otherwise(fb_v))

    unit_price = pick(p, p / q, F.when(q > 1, p / q).otherwise(p), fallback[0])
    quantity = pick(q, q, F.when(q > 1, q).otherwise(F.lit(1.0)), fallback[1])
    unit = pick(F.lit("g"), norm, F.lit(rules.DEFAULT_UNIT_PLAZA_VEA), fallback[2])
    return unit_price, quantity, unit
