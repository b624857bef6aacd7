"""Per-site rules as plain data.

Everything under "fixed values" must equal the retail sites' own constants
(retailer names, tax ids, domains, unit lists, regular expressions) for the
output rows to be right.  The expression builders in ``priceflow.functions``
and ``priceflow.operators`` read these tables; no site has its own copy of
the logic.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# fixed values: sites, countries, retailer names and ids, allowed domains
# ---------------------------------------------------------------------------
# (site, country, comercial_name, comercial_id, domain)
# The Chilean Jumbo site has no published name or id: placeholders.
SITE_TABLE = [
    ("jumbo", "colombia", "Jumbo", "900.155.107", "www.jumbocolombia.com"),
    ("jumbocl", "chile", "Jumbo CL", "unknown", "www.jumbocl.cl"),
    ("cruzverde", "colombia", "Cruz Verde", "800.149.695", "www.cruzverde.com.co"),
    ("cruzverdecl", "chile", "Cruz Verde CL", "89.807.200", "www.cruzverde.cl"),
    ("falabella", "chile", "Falabella", "76.212.492", "www.falabella.com"),
    ("falabellacol", "colombia", "Falabella", "76.212.492", "www.falabella.com.co"),
    ("plaza_vea", "peru", "plaza_vea", "20100070970", "www.plazavea.com.pe"),
    ("inkafarma", "peru", "InkaFarma", "20608430301", "inkafarma.pe"),
]

SITES = tuple(row[0] for row in SITE_TABLE)
COUNTRIES = ("colombia", "chile", "peru")

# ---------------------------------------------------------------------------
# fixed values: unit alternations of the quantity patterns, per site family
# ---------------------------------------------------------------------------
UNITS_GENERAL = "g|gr|ml|l|lt|kg|onz|lb|unidades|unideades|un|cm|m|u|grs|und|unds"
UNITS_CRUZVERDE_CL = (
    "g|gr|ml|l|lt|kg|onz|mg|comprimido|lb|unidades|unideades|un|cm|m|u|grs|und|unds")
UNITS_CRUZVERDE_CO = (
    "g|gr|ml|l|kg|unidades|unidad|un|cm|m|u|grs|und|unds|tabletas|tableta|mg|dosis|"
    "cápsulas|capsulas|sobres|ampolletas|cotonetes")
UNITS_PLAZA_VEA = (
    "kg|g|gr|grs|l|litro|litros|ml|mililitro|mililitros|pack|paquete|caja|bandeja|"
    "unidad|unidades|un|u|und|unds")
UNITS_INKAFARMA = "ml|mg|g|kg|l|un|unidades?|caps?|comp|tab"

# ---------------------------------------------------------------------------
# fixed values: regular expressions (Java syntax; (?i) = case-insensitive)
# ---------------------------------------------------------------------------
# number + unit anywhere in a product name; the last match wins (Q1)
QTY_UNIT_PATTERN = r"(\d+[\.,]?\d*)\s?((?:{units})\b)"
# pack size after "x" / "por"; Jumbo wants exactly one white space before (Q2)
PACK_PATTERN_JUMBO = r"(?:\s{1}(?:x|por))\s*(\d+[\.,]?\d*)\b"
PACK_PATTERN_CRUZVERDE = r"(?:x|por)\s*(\d+[\.,]?\d*)\b"
# Plaza Vea: dot decimals only, last match over "name unit-reference" (Q5)
QTY_PATTERN_PLAZA_VEA = r"(\d+(?:\.\d+)?)\s*({units})\b"
# Inkafarma: first match over the presentation text, no word boundary (Q4)
QTY_PATTERN_INKAFARMA = r"(\d+(?:\.\d+)?)\s*({units})"
# a published unit price counts only with a separator: "$ 450" does not
PUBLISHED_UNIT_PRICE_PATTERN = r"(\d+[\.,]\d*)"

# ---------------------------------------------------------------------------
# fixed values: Plaza Vea unit synonyms (Q6); anything else stays as written
# ---------------------------------------------------------------------------
UNIT_SYNONYMS = {
    "g": "g", "gr": "g", "grs": "g",
    "l": "l", "litro": "l", "litros": "l",
    "ml": "ml", "mililitro": "ml", "mililitros": "ml",
    "pack": "pack", "paquete": "pack", "caja": "pack",
    "bandeja": "g",
    "unidades": "unidad", "un": "unidad", "u": "unidad", "und": "unidad", "unds": "unidad",
}

# ---------------------------------------------------------------------------
# fixed values: labels, lists and limits
# ---------------------------------------------------------------------------
DEFAULT_UNIT = "un"                 # every site but Plaza Vea
DEFAULT_UNIT_PLAZA_VEA = "unidad"
INKAFARMA_CATEGORY = "Farmacia"
NO_NAME = "Sin nombre"
URL_LABEL_MARKER = "/categoria/"
URL_LABEL_FALLBACK = "General"
FAILURE_LABEL_FALLBACK = "Unknown"

CRUZVERDE_CATEGORIES = ["Medicamentos", "Dermocosméticos", "Bebé y Maternidad",
                        "Cuidado Personal", "Salud Sexual", "Belleza", "Bienestar y Nutrición"]
CRUZVERDE_SPECIAL_CATEGORY = "Medicamentos"
CRUZVERDE_SPECIAL_SUB = "Formulados"
CRUZVERDE_SPECIAL_LINKS = ["https://www.cruzverde.com.co/medicamentos/formulados/"]
FALABELLA_CL_CATEGORIES = ["Tecnología", "Electrohogar y Climatización", "Celulares y Planes"]
FALABELLA_CO_CATEGORIES = ["Tecnología", "Electrohogar", "Celulares y accesorios"]
CRUZVERDE_CL_DENIED_CATEGORY = "Veterinaria"
CRUZVERDE_CL_DENIED_LINK_TEXTS = ["Conoce más", "Asesoría en vivo"]

DISCOVER_THRESHOLD = 1400           # products above which a category is split
MAX_PAGES = 200                     # pages per category
MAX_CONSECUTIVE_EMPTY = 3           # empty pages in a row that end a category
MAX_TIMEOUT_RETRIES = 2             # retries of a timed-out request
RETRY_TIMEOUT_MS = 45000            # navigation timeout of a retried request
TIMEOUT_ERROR_MARK = "TimeoutError"

# ---------------------------------------------------------------------------
# per-site behaviour (derived from the tables above, not fixed values)
# ---------------------------------------------------------------------------
# How a site's rows fail: 'drop' a bad card, keep a 'partial' row with NULLs,
# or give it price 'zero'.  The Colombian Cruz Verde spider stops the whole
# process on a missing price; here that card is dropped like the others.
ROW_POLICY = {
    "jumbo": "partial", "jumbocl": "partial",
    "cruzverde": "drop", "cruzverdecl": "drop",
    "falabella": "drop", "falabellacol": "drop",
    "plaza_vea": "drop", "inkafarma": "zero",
}

SITE_BY_NAME = {row[0]: row for row in SITE_TABLE}


def country_of(site: str) -> str:
    return SITE_BY_NAME[site][1]


def domain_of(site: str) -> str:
    return SITE_BY_NAME[site][4]
