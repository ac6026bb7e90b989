"""Whole reports with invented companies."""

import pytest
from pyspark.sql import functions as F

from loomspark.operators import narrative, report

STATEMENT = "Consolidated income statement\nSEK m  2024  2023\nNet sales  88 000  85 000\nCost of goods  -70 000  -69 000\nOperating profit  9 200  8 100\nFinancial net  -100  -90\n"


def reports(spark, texts, company="Norrvik Industri AB"):
    """All texts in one job."""
    docs = spark.createDataFrame([(k, text, company) for k, text in enumerate(texts)], "doc_id long, text string, company string")
    return sorted(report.extract_reports(docs, 2024).collect(), key=lambda r: r["doc_id"])


PARENT = STATEMENT.replace("Consolidated income statement", "Parent company income statement").replace("88 000", "77 000")
LAYERS = "Annual report 2024\nAmounts in MSEK\nKey figures\nNet sales  1 111  1 000\nOperating profit  222  200\n" + "Filler line\n" * 40 + "Segment information\nNet sales  3 333  3 000\nOperating profit  333  300\n" + "Filler line\n" * 45 + STATEMENT
SEGMENT_ONLY = "Amounts in MSEK\nSegment information\nNet sales  3 333  3 000\n"
SECOND = "MSEK\nKey figures\nOperating profit  999 000  1\n" + "Filler line\n" * 40 + "Consolidated income statement\n2024  2023\nNet sales  5 000  4 000\nOperating profit  9 999  800\nx\ny\nNotes to the financial statements\nConsolidated income statement\n2024  2023\nOperating profit  700  800\n" + "z\n" * 9
BANK = "SEK m  2024  2023\nNet interest income  1  1\nCredit losses  1  1\nTotal operating income  70 234  68 000\nOperating profit  32 100  31 000"
HOLDING = "MSEK\nSubstansvärde, net asset value, investmentbolag\nNet sales  100  90\nOperating profit  50  40"


def test_figures_by_section_and_strategy(spark):
    cases = [
        (LAYERS, ("industrial", 88000.0, 9200.0)),
        (LAYERS.replace(STATEMENT, ""), ("industrial", 1111.0, 222.0)),
        (SEGMENT_ONLY + "Filler line\n" * 45 + "Net sales  4 444  4 000\n", ("industrial", 4444.0, None)),
        (SEGMENT_ONLY, ("industrial", None, None)),
        ("MSEK\n" + PARENT + STATEMENT, ("industrial", 88000.0, 9200.0)),
        ("MSEK\n" + PARENT, ("industrial", 77000.0, 9200.0)),
        ("Sales, SEK billion: 79\nOperating margin 15%", ("industrial", 79000.0, None)),
        ("SEK m  2024  2023\nNet sales  100 000  98 000\nOperating margin 12.5%", ("industrial", 100000.0, 12500.0)),
        (SECOND, ("industrial", 5000.0, 700.0)),
        (BANK, ("bank", 70234.0, 32100.0)),
        (HOLDING, ("investment_company", 100.0, None)),
        ("", ("industrial", None, None)),
        (None, ("industrial", None, None)),
    ]
    got = reports(spark, [t for t, _ in cases])
    assert [(r["company_type"], r["revenue"], r["ebit"]) for r in got] == [w for _, w in cases]
    assert got[0]["fiscal_year"] == 2024 and got[7]["notes"][0] == "EBIT by margin" and "EBIT not found" in got[-1]["notes"] and "EBIT not found" not in got[10]["notes"]


def test_chief_executives(spark):
    bad = "".join(f"CEO {x}\nline\nline\n" for x in ("North America", "South America", "Latin America"))
    cases = [
        ("President and CEO Anna Svensson", "Anna Svensson"),
        ("Erik von Berg\nPresident and CEO", "Erik von Berg"),
        ("Former CEO Bo Ek\nSome line\nSome other line\nCEO: Eva Lind", "Eva Lind"),
        ("Election of CEO Bo Ek\nline\nline\nline\nChief Executive Officer\nMaria Holm", "Maria Holm"),
        ("President and CEO Norrvik Industri\nline\nline\nCEO Anna Svensson", "Anna Svensson"),
        ("President and CEO\nNorth America\nline\nCEO Group Management\nCEO Maria Holm", "Maria Holm"),
        ("CEO of Other Company Bo Ek", None),
        ("Chairman Bo Ek", None),
        ("filler\n" * 900 + "CEO Anna Svensson", None),
        ("filler\n" * 900 + "Group management\nCEO Anna Svensson", "Anna Svensson"),
        # Three tries and no more.
        (bad + "CEO Anna Svensson", None),
        (bad.split("CEO Latin")[0] + "CEO Anna Svensson", "Anna Svensson"),
    ]
    assert [r["ceo"] for r in reports(spark, [t for t, _ in cases])] == [w for _, w in cases]


@pytest.mark.parametrize(
    "text,want",
    [
        ("Sales, SEK billion: 79.4", 79400.0),
        ("The group had revenues of BSEK 12,5 and more", 125000.0),
        ("Our target is revenues of BSEK 100. " + "Filler words. " * 9 + "Today revenues of SEK 42 billion.", 42000.0),
        ("revenues of BSEK 0.5", None),
        ("Net sales amounted to SEK 20,427m.", 20427.0),
        ("net sales amounted to SEK 999m", None),
        (None, None),
    ],
)
def test_narrative_revenue(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(narrative.narrative_revenue(F.col("t"))).first()[0] == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("about 12,200 employees; a workforce of 14,500 in all", 14500.0),
        ("Koncernen hade 12 345 anställda", 12345.0),
        ("The number of employees increased from 900 to 11,000", 11000.0),
        ("12 employees worldwide", None),
    ],
)
def test_narrative_employees(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(narrative.narrative_employees(F.col("t"))).first()[0] == want
