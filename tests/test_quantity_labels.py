"""Quantity, unit, unit price (Q1-Q7, U1-U4) and labels."""

import datetime

import pytest
from pyspark.sql import functions as F

from priceflow import rules
from priceflow.functions import labels, quantity

# name, Jumbo (Q1 else Q2 else default), Plaza Vea (Q5 raw), Inkafarma (Q4)
NAMES = [
    ("Arroz 500 GR", (500.0, "GR"), (500.0, "gr"), (500.0, "g")),
    ("Leche x 6 un 1.000 ml", (1.0, "ml"), (1.0, "ml"), (6.0, "un")),
    ("Aceite 1,5 L", (1.5, "L"), (5.0, "l"), (5.0, "l")),
    ("Pan x 12", (12.0, "un"), (None, None), (None, None)),
    ("Servilleta por 1.000", (1000.0, "un"), (None, None), (None, None)),
    ("Jabon", (1.0, "un"), (None, None), (None, None)),
    ("Queso 0 g", (0.0, "g"), (0.0, "g"), (0.0, "g")),
    ("Caja 12 unidades", (12.0, "unidades"), (12.0, "unidades"), (12.0, "un")),
    ("Pollo 2 bandeja", (1.0, "un"), (2.0, "bandeja"), (None, None)),
    ("Gaseosa 3 litros", (1.0, "un"), (3.0, "litros"), (3.0, "l")),
]


@pytest.mark.parametrize("name, jumbo, plaza, inka", NAMES)
def test_quantity_rules(rows_of, name, jumbo, plaza, inka):
    q1, u1 = quantity.quantity_unit_last("n", rules.UNITS_GENERAL)
    pack = quantity.pack_multiplier("n", rules.PACK_PATTERN_JUMBO)
    jq = F.coalesce(q1, pack, F.lit(1.0))
    ju = F.when(q1.isNotNull(), u1).otherwise(F.lit("un"))
    pq, pu = quantity.quantity_with_reference("n", F.lit(""))
    _, iq, iu = quantity.presentation_first("n")
    out = rows_of([(name,)], "n string", jq=jq, ju=ju, pq=pq, pu=pu, iq=iq, iu=iu)[0]
    assert (out["jq"], out["ju"]) == jumbo
    assert (out["pq"], out["pu"]) == plaza
    assert (out["iq"], out["iu"]) == inka


def test_pack_patterns_differ_on_space(rows_of):
    out = rows_of([("Panx 12",)], "n string",
                  j=quantity.pack_multiplier("n", rules.PACK_PATTERN_JUMBO),
                  c=quantity.pack_multiplier("n", rules.PACK_PATTERN_CRUZVERDE))[0]
    assert out == {"j": None, "c": 12.0}


def test_unit_synonyms_and_case(rows_of):
    data = [("gr",), ("Litros",), ("caja",), ("bandeja",), ("und",), ("kg",)]
    out = rows_of(data, "u string", n=quantity.unit_synonyms("u"),
                  s=quantity.unit_case(F.concat(F.lit(" "), F.col("u")), "strip_lower"))
    assert [r["n"] for r in out] == ["g", "l", "pack", "g", "unidad", "kg"]
    assert out[1]["s"] == "litros"


def test_unit_price_published(rows_of):
    data = [("$ 450", 9.0), ("$ 3.450,50", 9.0), ("12,5 x g", 9.0), (None, 9.0)]
    out = rows_of(data, "t string, r double", p=quantity.unit_price_published("t", F.col("r")))
    assert [r["p"] for r in out] == [9.0, 3.45, 12.5, 9.0]


def test_unit_price_ratio_and_rounded(rows_of):
    out = rows_of([(10.0, 3.0, True), (10.0, 0.0, True), (10.0, 4.0, False)], "p double, q double, f boolean",
                  r=quantity.unit_price_ratio("p", "q"), u=quantity.unit_price_rounded("p", "q", F.col("f")))
    assert [(r["r"], r["u"]) for r in out] == [(10.0 / 3.0, 3.33), (None, 10.0), (2.5, 10.0)]


@pytest.mark.parametrize("p, q, u, expected", [
    (100.0, 500.0, "gr", (0.2, 500.0, "g")),
    (100.0, 2.0, "bandeja", (100.0, 2.0, "g")),
    (100.0, 4.0, "unidades", (25.0, 4.0, "unidad")),
    (100.0, 1.0, "un", (100.0, 1.0, "unidad")),
    (100.0, 0.0, "g", (100.0, 1.0, "unidad")),
    (100.0, 2.0, "caja", (50.0, 2.0, "pack")),
    (100.0, None, None, (100.0, 1.0, "unidad")),
])
def test_unit_price_by_kind(rows_of, p, q, u, expected):
    up, qq, uu = quantity.unit_price_by_kind("p", "q", "u")
    out = rows_of([(p, q, u)], "p double, q double, u string", a=up, b=qq, c=uu)[0]
    assert (out["a"], out["b"], out["c"]) == expected


@pytest.mark.parametrize("crumbs, url, expected", [
    (["frutas-y-verduras"], "https://www.jumbocolombia.com/x/y", ("Frutas Y Verduras", "Frutas Y Verduras")),
    ([], "https://www.jumbocolombia.com/supermercado/despensa", ("Supermercado", "Despensa")),
    (["A-b", "C"], "https://www.jumbocolombia.com/x/y", ("A-b", "C")),
    ([], "https://www.jumbocolombia.com/celulares", ("Celulares", "Celulares")),
])
def test_breadcrumb_category(rows_of, crumbs, url, expected):
    cat, sub = labels.breadcrumb_category("c", "u")
    out = rows_of([(crumbs, url)], "c array<string>, u string", a=cat, b=sub)[0]
    assert (out["a"], out["b"]) == expected


def test_url_labels(rows_of):
    cat, sub = labels.label_from_url("u", fallback="Unknown")
    data = [("https://www.plazavea.com.pe/frutas-y-verduras/frutas",), ("https://inkafarma.pe/categoria/mama-y-bebe",),
            ("about:blank",)]
    out = rows_of(data, "u string", c=cat, s=sub, m=labels.label_after_marker("u"))
    assert [(r["c"], r["s"], r["m"]) for r in out] == [
        ("Frutas Y Verduras", "Frutas", "General"),
        ("Categoria", "Mama Y Bebe", "Mama Y Bebe"),
        ("Unknown", "Unknown", "General")]


def test_compose_and_display_name(rows_of):
    data = [("Paracetamol", "Caja 10 un"), ("X", ""), ("", ""), (None, "p")]
    out = rows_of(data, "n string, p string", c=labels.compose_name("n", "p"),
                  d=labels.display_name(F.lit("carnes_aves-y-pescados")))
    assert [r["c"] for r in out] == ["Paracetamol - Caja 10 un", "X", "Sin nombre", "Sin nombre"]
    assert out[0]["d"] == "Carnes Aves Y Pescados"


def test_stamp_capture(rows_of):
    date, time = labels.stamp_capture("t")
    out = rows_of([(datetime.datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp_ntz", d=date, h=time)[0]
    assert out == {"d": "2024-01-02", "h": "03:04:05"}
