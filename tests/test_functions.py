
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import labels, scalars


def col1(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col(df.columns[0]))).collect()]


def test_parse_amount(spark):
    got = col1(spark, ["Rs 1,45,980cr", "₹1.97 lakh cr", "$776.0bn", "+21.2%", "-3.5 crore", "n/a", None], scalars.parse_amount)
    as_tuples = [(None if r is None else (r.value, r.unit)) for r in got]
    assert as_tuples[0] == (145980.0, "INR_cr")
    assert as_tuples[1][1] == "INR_cr" and abs(as_tuples[1][0] - 197000.0) < 1e-6
    assert as_tuples[2] == (776000.0, "USD_mn")
    assert as_tuples[3] == (21.2, "pct")
    assert as_tuples[4] == (-3.5, "INR_cr")
    assert as_tuples[5][0] is None and as_tuples[6][0] is None


def test_parse_date_formats_and_unknown_month(spark):
    got = col1(spark, ["05 JUN 2022", "2023-03-31", "5 June 2022", "31/12/2024", "12 XYZ 2020", ""], scalars.parse_date)
    assert got == [dt.date(2022, 6, 5), dt.date(2023, 3, 31), dt.date(2022, 6, 5), dt.date(2024, 12, 31), None, None]


def test_fiscal_year_and_quarter(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 31),), (dt.date(2025, 4, 1),), (dt.date(2026, 1, 15),)], "d date")
    got = [(r[0], r[1]) for r in df.select(scalars.fiscal_label("d"), scalars.fiscal_quarter("d")).collect()]
    assert got == [("FY2024-25", 4), ("FY2025-26", 1), ("FY2025-26", 4)]


def test_humanize_and_stem(spark):
    assert col1(spark, ["fdi_usd_mn", "iem-part_b", "top10_sector"], labels.humanize) == ["FDI USD Mn", "IEM Part B", "Top10 Sector"]
    got = col1(spark, ["state_fdi_vs_iem_2026-07-21", "repo_manifest"], labels.title_from_stem)
    assert got == ["State FDI Vs IEM", "Repo Manifest"]


def test_slug_and_units(spark):
    assert col1(spark, ["Q3 FY2025-26: Report!"], labels.slug) == ["q3-fy2025-26-report"]
    df = spark.createDataFrame([(100.0, "ha"), (1.0, "sq_km"), (10000.0, "sq_m"), (5.0, "furlong")], "v double, u string")
    got = [r[0] for r in df.select(scalars.to_unit("v", "u", "acre")).collect()]
    assert [round(x, 3) if x is not None else None for x in got] == [247.105, 247.105, 2.471, None]


def test_band_classify_status(spark):
    df = spark.createDataFrame([(85.0, "Approved"), (40.0, "Under Process"), (10.0, "withdrawn"), (None, None)], "c double, s string")
    bands = [r[0] for r in df.select(scalars.band("c", [(80, "high"), (40, "mid")], "low")).collect()]
    assert bands == ["high", "mid", "low", None]
    cls = [r[0] for r in df.select(scalars.status_class("s", [("approv|grant", "done"), ("process|pending", "open")], "other")).collect()]
    assert cls == ["done", "open", "other", "other"]


def test_clean_html_paths(spark):
    got = col1(spark, ["  a &amp; b&nbsp;&lt;c&gt;  ", "&eacute;t&#233;"], scalars.clean_html)
    assert got[0] == "a & b <c>"
    assert got[1] == "été"


def test_unescape_agrees_with_the_standard_library(spark):
    import html

    texts = ["&amp;lt; &lt; &amp;amp;", "India&#8217;s &ndash; &#x1F600; &#128; &#0; &#xD800; &#1114112;", "no entity", "", "&unknown; & &;", "&hellip;&nbsp;x&euro;&Eacute;", "&#39;&apos;&quot;&gt;"]
    got = col1(spark, texts, scalars.unescape)
    assert got == [html.unescape(t) for t in texts]


def test_labels_with_unicode_and_inner_blanks(spark):
    assert col1(spark, ["jammu\u00a0&\u00a0KASHMIR", "\u00a0 andaman  and nicobar. "], labels.canon_label) == ["Jammu and Kashmir", "Andaman and Nicobar"]
    assert col1(spark, ["foo bar_baz", "a__b"], labels.humanize) == ["Foo bar Baz", "A  B"]


def test_parse_amount_spellings(spark):
    cases = {"Rs. 5 Lakh Crore": (500000.0, "INR_cr"), "$4 trillion": (4e6, "USD_mn"), "₹500 lakh": (5.0, "INR_cr"), "−$333.2bn": (-333200.0, "USD_mn"), "$-5bn": (-5000.0, "USD_mn"),
             "USD 2 MILLION": (2.0, "USD_mn"), "7 quintal": (None, None), "5 crore people": (None, None), "-3%": (-3.0, "pct"), "12": (12.0, None), "₹ 3 bn": (300.0, "INR_cr"), "": (None, None)}
    got = col1(spark, list(cases), scalars.parse_amount)
    for text, r in zip(cases, got):
        want = cases[text]
        assert r.unit == want[1] and (r.value is None) == (want[0] is None) and (want[0] is None or abs(r.value - want[0]) < 1e-9 * abs(want[0])), (text, r)


def test_safe_ratio_keeps_tiny_shares(spark):
    df = spark.createDataFrame([(0.00004, 10.0), (1.0, 0.0), (None, 2.0), (3.0, None)], "n double, d double")
    got = [r[0] for r in df.select(scalars.safe_ratio("n", "d")).collect()]
    assert got[0] == pytest.approx(0.000004) and got[1:] == [None, None, None]


def test_json_shapes(spark):
    vals = ['{"a":1}', '[{"a":1},{"b":2}]', '["a", 1, null]', '[1, {"a":1}]', "[]", "null", "5", "{bad", None]
    assert col1(spark, vals, scalars.json_shape) == [
        "object", "object_list", "scalar_list", "list", "list", "null", "scalar", "null", "null",
    ]


def test_two_signs_are_no_amount(spark):
    got = col1(spark, ["-\u22125", "-Rs +5", "+-5", "-5", "Rs -5", "\u2212 Rs 5cr", "1\x012"], scalars.parse_amount)
    assert [g.value for g in got] == [None, None, None, -5.0, -5.0, -5.0, None]
