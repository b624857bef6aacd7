"""The element pattern starts where Java can skip to it (FINDINGS_r04, F2)."""

from priceflow.functions.markup import _element, elements


def test_element_pattern_begins_with_plain_text():
    assert _element(r"<article(?=[\s/>])", "article", "article").startswith("<article")


def test_first_element_closed_empty_and_left_open(spark):
    pages = ["<p><div id='a'>x<div>y</div></div><div id='a'>z</div>", "<div id='a'></div><div id='a'>z</div>",
             "<div id='a'>x", "<p>none</p>", "", None]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    got = df.select(elements("html", "div", "<div id='a'>", first=True).alias("e")).collect()
    assert [r.e for r in got] == [["x<div>y</div>"], [""], ["x"], [], [], None]
