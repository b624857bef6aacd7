"""Property tests: Spark's rules against Python's ``re`` on random names.

The Spark side runs Java regular expressions; the expectations here use
Python's ``re`` with the same patterns, the engine the rules were written
for, so the two regex engines are compared on generated names.
"""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from priceflow import rules
from priceflow.functions import price, quantity

WORDS = ["leche", "Arroz", "x", "por", "un", "Pack", "ml", "GR", "kg", "L", "litros", "und",
         "unidades", "bandeja", "caja", "de", "1,5", "1.000", "0", "12", "500", "3x", "x6", "  "]
NAMES = st.lists(st.sampled_from(WORDS), min_size=1, max_size=7).map(" ".join)


def py_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def expected_jumbo(name):
    found = re.findall(rules.QTY_UNIT_PATTERN.format(units=rules.UNITS_GENERAL), name, re.IGNORECASE)
    if found:
        return py_float(found[-1][0].replace(",", ".")), found[-1][1]
    packs = re.findall(rules.PACK_PATTERN_JUMBO, name.lower(), re.IGNORECASE)
    if packs:
        return py_float(packs[-1].replace(".", "").replace(",", ".")), "un"
    return 1.0, "un"


def expected_plaza(name, ref):
    text = f"{name} {ref}".lower()
    found = re.findall(rules.QTY_PATTERN_PLAZA_VEA.format(units=rules.UNITS_PLAZA_VEA), text, re.IGNORECASE)
    return (py_float(found[-1][0]), found[-1][1]) if found else (None, None)


@settings(max_examples=60, deadline=None)
@given(st.lists(NAMES, min_size=1, max_size=40))
def test_quantity_rules_match_python_re(spark, names):
    from pyspark.sql import functions as F
    q1, u1 = quantity.quantity_unit_last("n", rules.UNITS_GENERAL)
    pack = quantity.pack_multiplier("n", rules.PACK_PATTERN_JUMBO)
    pq, pu = quantity.quantity_with_reference("n", F.lit(""))
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", F.coalesce(q1, pack, F.lit(1.0)).alias("q"),
                    F.when(q1.isNotNull(), u1).otherwise(F.lit("un")).alias("u"),
                    pq.alias("pq"), pu.alias("pu")).collect()
    for r in got:
        assert (r.q, r.u) == expected_jumbo(r.n), r.n
        assert (r.pq, r.pu) == expected_plaza(r.n, ""), r.n


PRICES = st.builds(lambda a, b, c, sep, cur: f"{cur}{a}{sep}{b:03d}{c}",
                   st.integers(0, 999), st.integers(0, 999),
                   st.sampled_from(["", ",5", ",50", ".00", " - $ 9.990"]),
                   st.sampled_from([".", ",", ""]), st.sampled_from(["$ ", "$", "S/ ", ""]))


@settings(max_examples=60, deadline=None)
@given(st.lists(PRICES, min_size=1, max_size=40))
def test_price_rules_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", price.price_dot_thousands("t").alias("n1"),
                    price.price_dot_thousands_nocomma("t").alias("n2"),
                    price.price_digits_only("t").alias("n3")).collect()
    for r in got:
        t = r.t
        assert r.n1 == py_float(t.strip().replace("$", "").replace(".", "").replace(",", ".").strip()), t
        assert r.n2 == py_float(t.replace("$", "").replace(".", "").strip()), t
        assert r.n3 == py_float(re.sub(r"[^\d.]", "", t)), t
