"""DuckDB spellings of the column functions, for the oracle SQL.

Each builder returns a SQL expression string that computes what the Spark
function of the same name computes.  DuckDB's RE2 reads ``\\d \\s \\b`` as
ASCII; the fixture texts are ASCII where it matters, so both agree.
"""

from __future__ import annotations

from priceflow import rules

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def to_double(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, {lit(NUMBER)}) THEN try_cast({x} AS DOUBLE) END)"


def blank_null(x: str) -> str:
    return f"(CASE WHEN {x} <> '' THEN {x} END)"


def first(x: str, pattern: str, group: int = 1) -> str:
    p = lit(pattern)
    return f"(CASE WHEN regexp_matches({x}, {p}) THEN regexp_extract({x}, {p}, {group}) END)"


def all_matches(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({x}, {lit(pattern)}, {group})"


def last(x: str, pattern: str, group: int = 1) -> str:
    return f"{all_matches(x, pattern, group)}[-1]"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ''), lambda ch, i: "
            f"CASE WHEN i = 1 OR NOT regexp_matches(substr({x}, i - 1, 1), '\\p{{L}}') "
            f"THEN upper(ch) ELSE lower(ch) END), '')")


def decode(x: str) -> str:
    """Entities as characters (the few that the given pages hold)."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&amp;", "&")):
        x = f"replace({x}, {lit(entity)}, {lit(char)})"
    return x


def slug_label(x: str) -> str:
    return title(f"replace({x}, '-', ' ')")


def case_site(choices: dict, default: str = "NULL", site: str = "site") -> str:
    parts = []
    for names, value in choices.items():
        names = names if isinstance(names, tuple) else (names,)
        cond = f"{site} IN ({', '.join(lit(n) for n in names)})"
        parts.append(f"WHEN {cond} THEN {value}")
    return f"(CASE {' '.join(parts)} ELSE {default} END)"


# -- prices (N1-N8) -----------------------------------------------------------

def _drop_currency_and_dots(x: str) -> str:
    return f"replace(replace({strip(x)}, '$', ''), '.', '')"


def price_dot_thousands(x: str, digits_only: bool = False) -> str:
    t = strip(f"replace({_drop_currency_and_dots(x)}, ',', '.')")
    if digits_only:
        t = rf"regexp_replace({t}, '[^\d.]', '', 'g')"
    return to_double(t)


def price_dot_thousands_nocomma(x: str) -> str:
    return to_double(strip(_drop_currency_and_dots(x)))


def price_digits_only(x: str) -> str:
    return to_double(rf"regexp_replace({x}, '[^\d.]', '', 'g')")


def price_min_of_list(x: str, marker: str = "S/") -> str:
    cleaned = (f"list_transform(string_split({x}, {lit(marker)}), "
               rf"lambda p: regexp_replace({strip('p')}, '[^\d.]', '', 'g'))")
    values = f"list_filter(list_transform({cleaned}, lambda c: {to_double('c')}), lambda v: v IS NOT NULL)"
    return (f"(CASE WHEN contains({x}, {lit(marker)}) THEN coalesce(list_min({values}), 0.0) "
            f"ELSE 0.0 END)")


def price_range_upper(x: str) -> str:
    return strip(f"string_split({x}, '-')[-1]")


def count_from_text(x: str) -> str:
    return rf"coalesce(try_cast(regexp_replace({x}, '[^\d]', '', 'g') AS BIGINT), 0)"


# -- quantities (Q1-Q7, U1-U4) ---------------------------------------------------

def qty_unit_last(name: str, units: str, lower_input: bool = False) -> tuple[str, str]:
    text = f"lower({name})" if lower_input else name
    pattern = "(?i)" + rules.QTY_UNIT_PATTERN.format(units=units)
    return (to_double(f"replace({last(text, pattern, 1)}, ',', '.')"), last(text, pattern, 2))


def pack_multiplier(name: str, pattern: str) -> str:
    raw = last(f"lower({name})", "(?i)" + pattern, 1)
    return to_double(f"replace(replace({raw}, '.', ''), ',', '.')")


def presentation_first(x: str) -> tuple[str, str, str]:
    pattern = "(?i)" + rules.QTY_PATTERN_INKAFARMA.format(units=rules.UNITS_INKAFARMA)
    t = f"coalesce({x}, '')"
    return (f"regexp_matches({t}, {lit(pattern)})", to_double(first(t, pattern, 1)),
            f"lower({first(t, pattern, 2)})")


def qty_with_reference(name: str, ref: str) -> tuple[str, str]:
    text = f"lower(concat_ws(' ', {name}, coalesce({ref}, '')))"
    pattern = "(?i)" + rules.QTY_PATTERN_PLAZA_VEA.format(units=rules.UNITS_PLAZA_VEA)
    return (to_double(f"replace({last(text, pattern, 1)}, ',', '.')"), last(text, pattern, 2))


def unit_synonyms(u: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in rules.UNIT_SYNONYMS.items())
    return f"(CASE lower({u}) {whens} ELSE lower({u}) END)"


def ratio(p: str, q: str) -> str:
    return f"(CASE WHEN {q} <> 0 THEN {p} / {q} END)"


def published(text: str, fallback: str) -> str:
    t = strip(text)
    pub = to_double(f"replace({first(t, rules.PUBLISHED_UNIT_PRICE_PATTERN, 1)}, ',', '.')")
    return f"coalesce({pub}, {fallback})"


def round2(x: str) -> str:
    return f"cast(format('{{:.2f}}', {x}) AS DOUBLE)"


def unit_price_rounded(p: str, q: str, found: str) -> str:
    return f"(CASE WHEN {found} AND {q} > 0 THEN {round2(f'{p} / {q}')} ELSE {p} END)"


def unit_price_by_kind(p: str, q: str, raw: str) -> tuple[str, str, str]:
    rawl = f"lower({raw})"
    norm = unit_synonyms(raw)
    matched = f"({q} IS NOT NULL)"
    tray = f"({matched} AND {rawl} = 'bandeja')"
    divides = f"({matched} AND NOT {tray} AND {norm} <> 'unidad')"
    unit_rule = f"({matched} AND {norm} = 'unidad')"
    zero = f"({divides} AND {q} = 0)"

    def pick(tray_v, div_v, unit_v, fb_v):
        return (f"(CASE WHEN {tray} THEN {tray_v} WHEN {zero} THEN {fb_v} WHEN {divides} THEN {div_v} "
                f"WHEN {unit_rule} THEN {unit_v} ELSE {fb_v} END)")

    return (pick(p, f"{p} / {q}", f"(CASE WHEN {q} > 1 THEN {p} / {q} ELSE {p} END)", p),
            pick(q, q, f"(CASE WHEN {q} > 1 THEN {q} ELSE 1.0 END)", "1.0"),
            pick("'g'", norm, "'unidad'", "'unidad'"))


# -- labels (P1-P8) -------------------------------------------------------------

def label_from_url(url: str) -> tuple[str, str]:
    parts = f"string_split({url}, '/')"
    return slug_label(f"{parts}[-2]"), slug_label(f"{parts}[-1]")


def url_path_parts(url: str) -> str:
    return f"string_split(regexp_replace({url}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?', ''), '/')"


def breadcrumb_category(crumbs: str, url: str) -> tuple[str, str]:
    parts = url_path_parts(url)
    n_cr, n_p = f"len({crumbs})", f"len({parts})"
    c0 = slug_label(f"{crumbs}[1]")
    p0, p1 = slug_label(f"{parts}[1]"), slug_label(f"{parts}[2]")
    one, from_path = f"{n_cr} = 1", f"({n_cr} < 2 AND {n_p} >= 2)"
    single = f"({n_p} = 1 AND {n_cr} < 1)"
    cat = f"(CASE WHEN {one} THEN {c0} WHEN {from_path} THEN {p0} WHEN {single} THEN {p0} ELSE {crumbs}[1] END)"
    sub = f"(CASE WHEN {one} THEN {c0} WHEN {from_path} THEN {p1} WHEN {single} THEN {p0} ELSE {crumbs}[2] END)"
    return cat, sub


def label_after_marker(url: str) -> str:
    m = lit(rules.URL_LABEL_MARKER)
    return (f"(CASE WHEN contains({url}, {m}) THEN {slug_label(f'string_split({url}, {m})[-1]')} "
            f"ELSE {lit(rules.URL_LABEL_FALLBACK)} END)")


def compose_name(name: str, pres: str) -> str:
    n, p = f"coalesce({strip(name)}, '')", f"coalesce({strip(pres)}, '')"
    return (f"(CASE WHEN {n} <> '' AND {p} <> '' THEN {n} || ' - ' || {p} "
            f"WHEN {n} <> '' THEN {n} ELSE {lit(rules.NO_NAME)} END)")
