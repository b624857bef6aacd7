"""Cards and fields out of captured HTML.

Spark's ``xpath`` functions need well-formed XML and fail on an unclosed
``<br>``, so cards, price blocks and breadcrumbs are cut out of the known
markup of each site as elements that end where their nesting depth closes
(see ``functions.markup``): what follows the last card is no part of it, and
nested elements of the card's own name do not end it.

Tags are matched by name and the one attribute that identifies them, in any
order and among any others; texts are the first ones inside an element,
however nested, and their entities are decoded.

Everything is a built-in expression chosen per row by site (one CASE), so a
page is read once, in the task that scanned it, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceflow.functions.markup import element_texts, elements, first_element, first_in, grandchildren, let
from priceflow.functions.text import all_matches, blank_to_null

JUMBO_SITES = ("jumbo", "jumbocl")
FALABELLA_SITES = ("falabella", "falabellacol")

def tag(name: str, attribute: str = "", value: str = "") -> str:
    """Pattern of an opening tag, whatever its other attributes and their order."""
    return rf'<{name}\b[^>]*\s{attribute}="{value}"[^>]*>' if attribute else rf"<{name}\b[^>]*>"


# First text inside an element: past any tags that open right after it.
FIRST_TEXT = r"(?:\s*<[^/][^>]*>)*([^<]*)"

# Each site's product cards: the element and how its opening tag looks (and what follows it).
JUMBO_CARD = ("article", tag("article", "class", "[^\"]*vtex-product-summary-2-x-element[^\"]*"))
CARD_MARKUP = {
    JUMBO_SITES: JUMBO_CARD,
    "cruzverde": ("div", tag("div", "class", "flex flex-col h-full p-10 bg-white rounded-sm font-open sm:p-10")),
    "cruzverdecl": ("ml-new-card-product", tag("ml-new-card-product") + r"\s*"
                    + tag("div", "class", "[^\"]*text-left[^\"]*")),
    "plaza_vea": ("div", tag("div", "class", "Showcase__details")),
    "inkafarma": ("fp-product-large", tag("fp-product-large")),
}
# Falabella's cards are the links right inside the boxes right inside the results.
FALABELLA_RESULTS = tag("div", "id", "[^\"]*testId-searchResults-products[^\"]*")

# Field patterns inside one card; group 1 is the value.
NAME_PATTERN = {
    "jumbo": tag("h3") + FIRST_TEXT,
    "cruzverde": tag("a", "class", "font-open flex items-center text-main[^\"]*") + FIRST_TEXT,
    "cruzverdecl": tag("h2") + FIRST_TEXT,
    "falabella": tag("b", "id", "testId-pod-displaySubTitle-[^\"]*") + FIRST_TEXT,
    "plaza_vea": tag("button", "class", "Showcase__name") + FIRST_TEXT,
    "inkafarma": tag("fp-product-name") + FIRST_TEXT,
}
SELLING_PRICE = tag("div", "class", "[^\"]*selling-price[^\"]*")
# A unit price inside the selling price's block is not the selling price.
UNIT_PRICE_START = r"(?s)<div\b[^>]*calculate-pum-2-x-main.*$"
UNIT_PRICE_DIV = "(?s)(" + tag("div", "class", "[^\"]*calculate-pum-2-x-main[^\"]*") + ".*?</div>)"
PRICE_PATTERN = {
    "cruzverde": tag("span", "class", "font-bold text-prices") + FIRST_TEXT,
    "cruzverdecl": "(?s)" + tag("ml-price-tag-v2") + ".*?" + tag("div") + r"\s*" + tag("p") + FIRST_TEXT,
}
PLAZA_VEA_PRICE_TAG = r"(<div\b[^>]*Showcase__salePrice[^>]*>)"
PLAZA_VEA_PRICE = r'\bdata-price="([^"]*)"'
# Inkafarma: the first span that is the last child of its parent, inside the price block.
INKAFARMA_PRICE_BLOCK = "(?s)" + tag("fp-product-card-price") + "(.*?)</fp-product-card-price>"
INKAFARMA_PRICE = r"<span\b[^>]*>([^<]*)</span>\s*</"
# Falabella: the first span text (with an empty id in the last two) in such an item of the price block.
FALABELLA_PRICES = tag("div", "id", "[^\"]*testId-pod-prices-[^\"]*")
SPAN_TEXT = r"<span\b[^>]*>([^<]+)"
BLANK_ID_SPAN_TEXT = r'<span\b[^>]*\sid=""[^>]*>([^<]+)'
FALABELLA_PRICE_ITEMS = (
    (r"<li\b[^>]*\sdata-normal-price\b[^>]*>", SPAN_TEXT),
    (r"<li\b[^>]*\sdata-internet-price\b[^>]*>", BLANK_ID_SPAN_TEXT),
    (r"<li\b[^>]*\sdata-event-price\b[^>]*>", BLANK_ID_SPAN_TEXT),
)
CRUZVERDE_UNIT_PRICE = tag("span", "class", "text-12") + FIRST_TEXT
PLAZA_VEA_UNIT_REFERENCE = tag("div", "class", "Showcase__units-reference") + FIRST_TEXT
INKAFARMA_PRESENTATION = tag("fp-product-description") + FIRST_TEXT
BREADCRUMB_DIV = tag("div", "data-testid", "breadcrumb")

# The entities that a serialised page holds, '&' last.
ENTITIES = (("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
            ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&#38;", "&"), ("&amp;", "&"))


def decode_entities(text: Column) -> Column:
    """Entities of one field's text as characters; untouched without an '&'."""
    out = text
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(F.contains(text, F.lit("&")), out).otherwise(text)


def by_site(site: Column, choices: dict[str, Column], default: Column | None = None) -> Column:
    """CASE site WHEN ... : only the taken branch is evaluated."""
    expr = None
    for names, value in choices.items():
        cond = site.isin(*names) if isinstance(names, tuple) else (site == names)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default) if default is not None else expr


def selling_price_texts(card: Column | str) -> Column:
    """X3 on Jumbo: the text nodes of the selling-price blocks, in order."""
    blocks = elements(card, "div", SELLING_PRICE)
    return element_texts(F.transform(blocks, lambda b: F.regexp_replace(b, UNIT_PRICE_START, "")))


def falabella_price(card: Column | str) -> Column:
    """X2 on Falabella: the first of normal, internet and event price, at any depth of its item.

    Only the price block counts; a card without one is searched as a whole.
    """
    card = F.col(card) if isinstance(card, str) else card
    items = elements(F.coalesce(first_element(card, "div", FALABELLA_PRICES), card), "li", keep_tag=True)
    return let(items, lambda found: F.coalesce(*[
        first_in(F.filter(found, lambda li: li.rlike("^" + item)), text) for item, text in FALABELLA_PRICE_ITEMS]))


def plaza_vea_price(card: Column | str) -> Column:
    """The ``data-price`` attribute of the sale price; '' if it is empty."""
    opening = F.regexp_extract(F.col(card) if isinstance(card, str) else card, PLAZA_VEA_PRICE_TAG, 1)
    return F.get(all_matches(opening, PLAZA_VEA_PRICE, 1), F.lit(0))


def card_array(html: Column | str, site: Column | str) -> Column:
    """X1 (array form): the cards of a page, in document order."""
    html = F.col(html) if isinstance(html, str) else html
    site = F.col(site) if isinstance(site, str) else site
    choices = {names: elements(html, name, opener) for names, (name, opener) in CARD_MARKUP.items()}
    choices[FALABELLA_SITES] = grandchildren(html, FALABELLA_RESULTS, "div", "a")
    return by_site(site, choices, F.array().cast("array<string>"))


def breadcrumbs(html: Column | str) -> Column:
    """Texts of the breadcrumb links of a page (Jumbo), however nested, decoded."""
    links = elements(F.coalesce(first_element(html, "div", BREADCRUMB_DIV), F.lit("")), "a")
    return F.transform(element_texts(links), decode_entities)


def with_breadcrumbs(snapshots: DataFrame) -> DataFrame:
    """Pages with ``crumbs``, the breadcrumbs that the site's labels come from."""
    return snapshots.withColumn("crumbs", F.when(F.col("site").isin(*JUMBO_SITES), breadcrumbs("html")))


def explode_cards(snapshots: DataFrame) -> DataFrame:
    """One row per product card: page columns + ``pos`` (1-based) + ``card``.

    Page-level values that the parsers need (breadcrumbs) are taken once per
    page, before the explode; the HTML itself is dropped.
    """
    pages = snapshots if "crumbs" in snapshots.columns else with_breadcrumbs(snapshots)
    cols = [c for c in pages.columns if c != "html"]
    exploded = pages.select(*cols, F.posexplode(card_array("html", "site")).alias("pos0", "card"))
    return exploded.withColumn("pos", (F.col("pos0") + 1).cast("int")).drop("pos0")


def card_fields(cards: DataFrame) -> DataFrame:
    """Raw field texts of each card, by the site's markup.

    A missing element gives NULL; an element whose text is empty gives NULL
    too (an empty text node does not exist for a selector).  Plaza Vea's
    price is an attribute: present but empty stays ''.  Empty texts become NULL
    outside the CASE, so that each pattern runs once per card.
    """
    site, card = F.col("site"), F.col("card")

    def first(pattern: str) -> Column:
        return F.regexp_extract(card, pattern, 1)

    name_raw = by_site(site, {
        JUMBO_SITES: first(NAME_PATTERN["jumbo"]),
        "cruzverde": first(NAME_PATTERN["cruzverde"]),
        "cruzverdecl": first(NAME_PATTERN["cruzverdecl"]),
        FALABELLA_SITES: first(NAME_PATTERN["falabella"]),
        "plaza_vea": first(NAME_PATTERN["plaza_vea"]),
        "inkafarma": first(NAME_PATTERN["inkafarma"]),
    })
    price_raw = by_site(site, {
        JUMBO_SITES: F.try_element_at(selling_price_texts(card), F.lit(-1)),
        "cruzverde": first(PRICE_PATTERN["cruzverde"]),
        "cruzverdecl": first(PRICE_PATTERN["cruzverdecl"]),
        FALABELLA_SITES: falabella_price(card),
        "plaza_vea": plaza_vea_price(card),
        "inkafarma": F.regexp_extract(first(INKAFARMA_PRICE_BLOCK), INKAFARMA_PRICE, 1),
    })
    unit_price_raw = by_site(site, {
        JUMBO_SITES: first(UNIT_PRICE_DIV),
        "cruzverde": first(CRUZVERDE_UNIT_PRICE),
    })
    unit_ref_raw = by_site(site, {"plaza_vea": first(PLAZA_VEA_UNIT_REFERENCE)})
    presentation_raw = by_site(site, {"inkafarma": first(INKAFARMA_PRESENTATION)})
    fields = {"name_raw": name_raw, "price_raw": price_raw, "unit_price_raw": unit_price_raw,
              "unit_ref_raw": unit_ref_raw, "presentation_raw": presentation_raw}
    raw = cards.select(*[c for c in cards.columns if c != "card"], *[v.alias(k) for k, v in fields.items()])
    texts = {k: blank_to_null(k) for k in fields}
    texts["price_raw"] = F.when((site == "plaza_vea") | (F.col("price_raw") != ""), F.col("price_raw"))
    return raw.withColumns(texts).withColumns({k: decode_entities(F.col(k)) for k in fields})
