import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspark.functions import numbers as num
from loomspark.functions import texts


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or ("",)], ", ".join(f"{k} string" for k in values) or "x string")
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw,value",
    [
        ("236,681", 236681.0),
        ("236 681", 236681.0),
        ("(1,234)", -1234.0),
        ("−500", -500.0),
        ("- 7", -7.0),
        ("1234,5", 1234.5),
        ("1.234,56", 1234.56),
        ("12.5", 12.5),
        ("SEK 1,234 m", 1234.0),
        ("1,234.56", 1234.56),
        ("abc", None),
        ("", None),
        ("1.2.3", None),
    ],
)
def test_parse_number(spark, raw, value):
    assert one(spark, num.parse_number(F.col("x")), x=raw) == value


@pytest.mark.parametrize("raw,value", [("1 234,5", 1234.5), ("12,5 MSEK", 12.5), ("–7", -7.0), ("x", None)])
def test_parse_number_html(spark, raw, value):
    assert one(spark, num.parse_number_html(F.col("x")), x=raw) == value


@pytest.mark.parametrize("raw,value", [("2,5 miljarder", 2500.0), ("12 mkr", 12.0), ("1 234", 1.234), ("okänt", None)])
def test_parse_statutory(spark, raw, value):
    assert one(spark, num.parse_statutory(F.col("x")), x=raw) == value


@pytest.mark.parametrize("raw,value", [("12.500 tonnes", 12500.0), ("12,500", 12500.0), ("1.5 million tonnes", 1_500_000.0), ("3 kt", 3000.0), ("none", None)])
def test_parse_co2(spark, raw, value):
    assert one(spark, num.parse_co2(F.col("x")), x=raw) == value


@pytest.mark.parametrize(
    "text,unit",
    [
        ("Amounts in SEK m", "msek"),
        ("all in MEUR", "eur_m"),
        ("belopp i tkr", "ksek"),
        ("USD million", "usd_m"),
        ("in thousands of U.S. dollars", "usd_k"),
        ("GBP million, later MSEK", "gbp_m"),
        ("debt of MEUR 50 ... Amounts in SEK m", "msek"),
        ("no unit, only rusdm", None),
    ],
)
def test_unit_context(spark, text, unit):
    assert one(spark, num.unit_context(F.col("x")), x=text) == unit


@pytest.mark.parametrize("value,fused", [("20252024", True), ("202420230", True), ("20241", False), ("123456", False)])
def test_fused_years(spark, value, fused):
    assert one(spark, num.fused_years(F.col("x").cast("double")), x=value) is fused


@pytest.mark.parametrize("raw,key", [("VOLV B", "VOLV-B.ST"), ("volv-b", "VOLV-B.ST"), ("ABB", "ABB.ST"), ("SEB-A.ST", "SEB-A.ST"), ("TOOLONGNAME", "TOOLONGNAME")])
def test_ticker_key(spark, raw, key):
    assert one(spark, texts.ticker_key(F.col("x")), x=raw) == key


@pytest.mark.parametrize("url,host", [("https://www.Example.COM/x", "example.com"), ("nonsense", "none"), (None, "none")])
def test_host_key(spark, url, host):
    df = spark.createDataFrame([(url,)], "x string")
    assert df.select(texts.host_key(F.col("x"), "none")).first()[0] == host


def test_names(spark):
    assert one(spark, texts.distinctive_tokens(F.col("x")), x="Skanska Group (publ) Sweden AB, Skanska") == ["skanska"]
    assert one(spark, texts.slug(F.col("x")), x="Åre & Öst AB") == "are-ost-ab"
    assert one(spark, texts.ambiguity(F.col("x"), F.col("t")), x="Sinch AB", t="X.ST") == "high"
    assert one(spark, texts.model_hint(F.col("x")), x="Svea Fastigheter") == "real_estate"


def test_quote_and_pages(spark):
    assert one(spark, texts.quote_verified(F.col("x"), F.col("q")), x="The  net\nsales were 12", q="NET SALES WERE") is True
    assert one(spark, texts.quote_verified(F.col("x"), F.col("q")), x="short", q="short") is False
    assert one(spark, texts.normalise_space(F.col("x")), x="a  b\n\n\n\n\nc") == "a b\n\n\nc"


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=40))
def test_parse_of_rendered_numbers(spark, values):
    """Whatever the separators, a rendered number is read back."""
    styles = ["{:,}".format, str, lambda v: "{:,}".format(v).replace(",", " "), lambda v: f"({abs(v):,})" if v < 0 else f"SEK {v:,} m", lambda v: f"−{abs(v)}" if v < 0 else f"{v},0"]
    rows = [(i, style(v), float(v)) for i, v in enumerate(values) for style in styles]
    wrong = spark.createDataFrame(rows, "i int, x string, v double").where(~num.parse_number(F.col("x")).eqNullSafe(F.col("v")))
    assert wrong.collect() == []
