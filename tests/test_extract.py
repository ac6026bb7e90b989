"""Mini-reports with invented companies."""

import pytest

from loomspark.operators import extract as ex


def docs(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id long, text string")


def ladder(spark, text, kind="industrial"):
    r = ex.ebit_ladder(docs(spark, text), kind, year="2024").first()
    return r["revenue"], r["ebit"], r["strategy"]


HEAD = "Consolidated income statement\nSEK m  2024  2023\n"


@pytest.mark.parametrize(
    "body,want",
    [
        ("Net sales  88 000  85 000\nResultat före finansnetto  9 200  8 100", (88000.0, 9200.0, "direct")),
        ("Revenue  9 999  9 998\nNet sales  120 680  1\nOperating profit  500  400", (120680.0, 500.0, "direct")),
        ("Net sales  50 000  48 000\nEBITDA  8 000  7 000\nAdjusted EBIT  6 200  6 000", (50000.0, 6200.0, "adjusted")),
        ("Net sales  100 000  98 000\nOperating margin 12.5%", (100000.0, 12500.0, "margin")),
        ("Net sales  100 000  98 000\nEBITA  7 200  7 000\n" + "Other line\n" * 10 + "Amortisation  -700  -600", (100000.0, 6500.0, "ebita")),
        ("Net sales  100 000  98 000\nEBITA  22 616  20 000", (100000.0, 22616.0, "ebita")),
        ("Net sales  100 000  98 000", (100000.0, None, None)),
    ],
)
def test_ladder(spark, body, want):
    assert ladder(spark, HEAD + body) == want


def test_bank_labels(spark):
    text = "SEK m  2024  2023\nTotal operating income  70 234  68 000\nOperating profit  32 100  31 000"
    assert ladder(spark, text, "bank") == (70234.0, 32100.0, "direct")
    assert ladder(spark, "SEK m  2024  2023\nTotal operating income  70 234  68 000\nResult before tax  9 900  9 000", "bank") == (70234.0, 9900.0, "direct")


def test_header_year_decides_the_column(spark):
    text = "Income statement, MSEK\n2023  2024\nNet sales  1 000  2 000"
    assert ex.labelled_figure(docs(spark, text), ["net sales"], "2024").first()["msek"] == 2000.0
    assert ex.labelled_figure(docs(spark, text), ["net sales"], "2023").first()["msek"] == 1000.0


def test_notes_years_percent_and_spread_are_left_out(spark):
    figure = lambda line: ex.labelled_figure(docs(spark, "MSEK\n" + line), ["net sales"]).first()["msek"]
    assert figure("Net sales  4  12 345  11 000") == 12345.0
    assert figure("Net sales  12%  5 000") == 5000.0
    assert figure("Net sales  5 000 000  1") is None
    assert figure("Other net sales  77\nNet sales  88") == 88.0


def test_employees_ceo_year_and_emissions(spark):
    text = "Annual report 2024\nPresident and CEO\nAnna Svensson\nAverage number of employees  12 345  11 000\nScope 1 emissions\n12.500 tonnes"
    assert ex.employees(docs(spark, text)).first()["employees"] == 12345.0
    assert ex.chief_executive(docs(spark, text)).first()["ceo"] == "Anna Svensson"
    assert ex.fiscal_year(docs(spark, text)).first()["fiscal_year"] == 2024
    assert ex.co2(docs(spark, text)).first()["tonnes"] == 12500.0
    assert ex.chief_executive(docs(spark, "CEO: Bo Ek, since 2020")).first()["ceo"] == "Bo Ek"


def test_empty_documents(spark):
    for f in (ex.employees, ex.chief_executive, ex.fiscal_year, ex.co2, ex.ebit_ladder):
        assert f(docs(spark, "")).count() == 1 and f(docs(spark, None)).count() == 1
