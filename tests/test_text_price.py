"""Text and price rules (X6, N1-N8) on hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from priceflow.functions import price, text


@pytest.mark.parametrize("raw, expected", [
    ("3d tv", "3D Tv"), ("l'oreal", "L'Oreal"), ("10kg", "10Kg"),
    ("frutas y verduras", "Frutas Y Verduras"), ("ÁRBOL grande", "Árbol Grande"), ("", ""),
])
def test_title_case_matches_python(rows_of, raw, expected):
    assert expected == raw.title()
    assert rows_of([(raw,)], "s string", t=text.title_case("s"))[0]["t"] == expected


def test_strip_text_is_unicode_aware(rows_of):
    out = rows_of([("  a b \n",), (" x ",), (None,)], "s string", t=text.strip_text("s"))
    assert [r["t"] for r in out] == ["a b", "x", None]


def test_to_double_reads_like_python_float(rows_of):
    data = [("12.5",), ("5d",), ("5.",), ("",), (" 7 ",), ("1e3",), ("abc",)]
    out = rows_of(data, "s string", d=text.to_double("s"))
    assert [r["d"] for r in out] == [12.5, None, 5.0, None, 7.0, 1000.0, None]


def test_last_and_first_match(rows_of):
    out = rows_of([("a1 b22 c333",), ("none",)], "s string",
                  last=text.last_match("s", r"(\d+)", 1), first=text.first_match("s", r"(\d+)", 1))
    assert out == [{"last": "333", "first": "1"}, {"last": None, "first": None}]


@pytest.mark.parametrize("raw, n1, n2", [
    ("$ 12.900", 12900.0, 12900.0),
    ("$ 12.900,50", 12900.5, None),      # N2 has no decimal comma: reject
    ("$ 0", 0.0, 0.0),
    ("precio", None, None),
])
def test_dot_thousands(rows_of, raw, n1, n2):
    out = rows_of([(raw,)], "s string", n1=price.price_dot_thousands("s"),
                  n2=price.price_dot_thousands_nocomma("s"))[0]
    assert (out["n1"], out["n2"]) == (n1, n2)


def test_dot_thousands_digits_only(rows_of):
    out = rows_of([("$ 12.900 c/u",)], "s string", p=price.price_dot_thousands("s", digits_only=True))
    assert out[0]["p"] == 12900.0


@pytest.mark.parametrize("raw, expected", [("1,299.00", 1299.0), ("S/ 8.50", 8.5), ("", None),
                                           ("1.2.3", None)])
def test_digits_only(rows_of, raw, expected):
    assert rows_of([(raw,)], "s string", p=price.price_digits_only("s"))[0]["p"] == expected


@pytest.mark.parametrize("raw, expected", [
    ("S/ 5.20S/ 2.20", 2.2), ("5.20", 0.0), ("S/ 1.2.3S/ 4", 4.0), ("S/ ", 0.0), ("0", 0.0),
])
def test_min_of_list(rows_of, raw, expected):
    assert rows_of([(raw,)], "s string", p=price.price_min_of_list("s"))[0]["p"] == expected


def test_range_upper_then_nocomma(rows_of):
    out = rows_of([("$ 9.990 - $ 12.990",)], "s string",
                  up=price.price_range_upper("s"),
                  p=price.price_dot_thousands_nocomma(price.price_range_upper("s")))[0]
    assert out == {"up": "$ 12.990", "p": 12990.0}


def test_fallback_chain_first_existing_wins(rows_of):
    out = rows_of([(None, "", "$ 5"), ("bad", "$ 1", "$ 2"), (None, None, None)],
                  "a string, b string, c string", p=price.price_fallback_chain("a", "b", "c"))
    assert [r["p"] for r in out] == ["$ 5", "bad", None]


def test_count_from_text_and_zero_price(rows_of):
    out = rows_of([("1.432 productos", 0.0), ("sin datos", 3.5)], "s string, p double",
                  n=price.count_from_text("s"), z=price.zero_price("p"))
    assert out == [{"n": 1432, "z": None}, {"n": 0, "z": 3.5}]


def test_strip_text_takes_every_white_space_of_unicode_and_no_regular_expression(spark, rows_of):
    places = [*range(9, 14), 0x20, 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000]
    white, other = "".join(map(chr, places)), "\x1fa\u200b"
    data = [(white + "a b" + white,), (white,), ("",), (other,)] + [(c + "x" + c + "y" + c,) for c in white]
    out = rows_of(data, "s string", t=text.strip_text("s"), r=F.regexp_replace("s", r"(?U)^\s+|\s+$", ""))
    assert [r["t"] for r in out] == [r["r"] for r in out]
    assert [r["t"] for r in out[:4]] == ["a b", "", "", other]
    plan = spark.range(1).select(text.strip_text(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "regexp" not in plan


def test_a_number_is_read_from_its_text_once(spark, rows_of):
    texts = ["5", " 5.5\n", "\t-1e3 ", "5d", "5\x85", "5\xa0", "", "1,5", ".5", "5.", "\n", None]
    out = rows_of([(t,) for t in texts], "s string", n=text.to_double("s"))
    assert [r["n"] for r in out] == [5.0, 5.5, -1000.0, None, None, None, None, None, 0.5, 5.0, None, None]
    asked = text.to_double(F.lower("s")).alias("n")
    plan = spark.createDataFrame([("1",)], "s string").select(asked)._jdf.queryExecution().analyzed().toString()
    assert plan.split("\n")[0].count("lower(") == 1
