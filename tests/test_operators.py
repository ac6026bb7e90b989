import pytest
from pyspark.sql import functions as F

from loomspark.operators import adjudicate, merge, quality, rank, risk, validate

ROW = "company_id long, company string, ticker string, company_type string, revenue double, ebit double, employees double, ceo string, fiscal_year int, has_data boolean, timed_out boolean, data_source string, fallback_step string, confidence int, failed_stage string, report_url string, notes string"


def row(**change):
    base = {"company_id": 1, "company": "Acme", "ticker": "A.ST", "company_type": "industrial", "revenue": 50000.0, "ebit": 5000.0, "employees": 9000.0, "ceo": "Anna Ek", "fiscal_year": 2024, "has_data": True, "timed_out": False, "data_source": "pdf", "fallback_step": "primary", "confidence": 100, "failed_stage": None, "report_url": None, "notes": ""}
    return tuple((base | change).values())


def rows(spark, *changes):
    return spark.createDataFrame([row(**c) for c in changes], ROW)


@pytest.mark.parametrize(
    "change,field,value,score",
    [
        ({}, "revenue", 50000.0, 100),
        ({"revenue": 12_000_000.0}, "revenue", None, 85),
        ({"ebit": 5_000_000.0}, "ebit", None, 85),
        ({"ebit": 60_000.0}, "ebit", None, 85),
        ({"company_type": "real_estate", "revenue": 8000.0, "ebit": 8500.0}, "ebit", 8500.0, 95),
        ({"company_type": "bank", "revenue": 60000.0, "ebit": 70000.0}, "ebit", 70000.0, 95),
        ({"company_type": "bank", "revenue": 60000.0, "ebit": 90000.0}, "ebit", None, 88),
        ({"company_type": "bank", "revenue": 5000.0, "ebit": 6000.0}, "ebit", 6000.0, 89),
        ({"revenue": 500.0, "ebit": 60.0, "employees": 20000.0}, "revenue", 500000.0, 92),
        ({"revenue": 500.0, "ebit": 400.0}, "revenue", None, 85),
        ({"company_type": "pharma", "revenue": 500.0, "ebit": 40.0}, "revenue", 500.0, 100),
        ({"employees": 30.0, "notes": "Moderbolag only"}, "employees", 30.0, 92),
        ({"employees": 30.0}, "employees", None, 85),
        ({"ceo": "Cher"}, "ceo", "Cher", 95),
        ({"notes": "x | ENTITY WARNING: y | Fiscal year mismatch"}, "ceo", "Anna Ek", 65),
        ({"revenue": None, "ebit": None, "employees": None, "ceo": None}, "revenue", None, 35),
    ],
)
def test_validator(spark, change, field, value, score):
    got = validate.validate(rows(spark, change)).first()
    assert (got[field], got["confidence_score"]) == (value, score)


def test_scores_stay_between_0_and_100(spark):
    got = validate.validate(rows(spark, {"revenue": -5.0, "ebit": 9e9, "employees": 1.0, "ceo": None, "notes": "ENTITY WARNING | CONTENT WARNING | fiscal year mismatch"})).first()
    assert got["confidence_score"] == 0


@pytest.mark.parametrize("change,fixed", [({"revenue": 50000.0, "ebit": 50_000_000.0}, 50000.0), ({"revenue": 10000.0, "ebit": 12582.0}, 1258.0), ({"company_type": "bank", "revenue": 9000.0, "ebit": 90000.0}, None), ({"ebit": 10.0}, None)])
def test_ebit_rescale(spark, change, fixed):
    assert validate.ebit_rescale(rows(spark, change)).first()["ebit_fixed"] == fixed


def test_status_needs_no_ebit_for_investment_companies(spark):
    got = quality.with_status(rows(spark, {"company_type": "investment_company", "ebit": None}, {"ebit": None}, {"has_data": False}, {"timed_out": True})).select("status").collect()
    assert [r[0] for r in got] == ["complete", "partial", "failed", "timeout"]


@pytest.mark.parametrize("change,tier", [({}, "low"), ({"has_data": False, "revenue": None, "fallback_step": "search", "notes": "Rejected pdf candidate | download failed", "confidence": 40}, "high"), ({"ebit": None, "notes": "Revenue unit guard: x | EBIT unit guard: y | fiscal year mismatch"}, "medium")])
def test_risk_tiers(spark, change, tier):
    assert risk.risk_map(rows(spark, change)).first()["risk_tier"] == tier


def test_null_reasons(spark):
    got = quality.null_ledger(rows(spark, {"ebit": None, "employees": None, "notes": "EBIT (9) exceeds revenue (3) | fiscal-year column misread"})).first()
    assert (got["ebit_reason"], got["employees_reason"], got["revenue_reason"]) == ("validator_ebit_gt_revenue", "extractor_year_column_misread", None)


def test_upsert_is_idempotent(spark):
    old = rows(spark, {}, {"company": "Bolt"}).withColumn("ord", F.monotonically_increasing_id())
    new = rows(spark, {"company": "ACME", "revenue": 7.0}, {"company": "Cora"}).withColumn("ord", F.monotonically_increasing_id())
    once = merge.upsert(old, new)
    assert {(r["company"], r["change"]) for r in once.collect()} == {("ACME", "replaced"), ("Bolt", "kept"), ("Cora", "added")}
    twice = merge.upsert(once.drop("change"), new)
    assert {tuple(r) for r in twice.drop("change").collect()} == {tuple(r) for r in once.drop("change").collect()}


CAND = "company_id long, url string, text string, score int, ord long"


def test_ranking_puts_annual_reports_first(spark):
    c = spark.createDataFrame([(1, "https://x/governance.pdf", "Corporate governance report", 40, 0), (1, "https://x/policy", "Policy", 45, 1), (1, "https://x/ar.pdf", "Annual report", 20, 2), (2, "https://x/a", "x", 5, 3), (2, "https://x/b.pdf", "x", 5, 4)], CAND)
    got = rank.rank_class_first(c).orderBy("company_id", "rank").collect()
    assert [r["ord"] for r in got] == [2, 1, 0, 4, 3]


@pytest.mark.parametrize("url,is_stale", [("https://x/2020.pdf", True), ("https://x/2025.pdf", False), ("https://x/ar-09-10.pdf", True), ("https://x/ar-1213.pdf", True), ("https://x/ar-2425.pdf", False), ("https://x/annual_report_2020.pdf", False), ("https://x/09-10/2025", False)])
def test_stale(spark, url, is_stale):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(rank.stale(F.col("url"), F.lit(""), 2026)).first()[0] is is_stale


@pytest.mark.parametrize("year,points", [(2026, 50), (2025, 50), (2024, 20), (2023, 0), (2022, -30), (None, 0)])
def test_year_points(spark, year, points):
    df = spark.createDataFrame([(year,)], "y int")
    assert df.select(rank.year_points(F.col("y"), 2026)).first()[0] == points


def test_adjudication_cases(spark):
    base = ("ebit", 100.0, 100.5, True, True, True, 60, 5)
    cases = [base, ("ebit", 100.0, 100.5, True, False, True, 60, 5), ("ebit", 100.0, 100.5, True, False, False, 60, 5), ("ebit", 100.0, 150.0, True, True, True, 60, 5), ("ebit", 100.0, 150.0, True, True, True, 10, 30), ("ebit", 100.0, 150.0, True, True, True, 10, 5), ("ebit", 100.0, 150.0, False, True, True, 10, 5), ("ebit", None, 150.0, True, True, True, 10, 5), ("ebit", None, None, True, True, True, 10, 5), ("employees", 100.0, 101.0, True, True, True, 10, 5)]
    df = spark.createDataFrame(cases, "field string, det double, llm double, quoted boolean, det_ok boolean, llm_ok boolean, quote_len int, snippet_len int")
    got = [(r["case_no"], r["outcome"]) for r in adjudicate.adjudicate(df).collect()]
    assert got == [(1, "accept_det"), (2, "accept_llm"), (3, "review"), (4, "accept_llm"), (5, "accept_det"), (6, "review"), (8, "accept_det"), (9, "accept_llm"), (11, "failed"), (6, "review")]


def test_circuit_breaker(spark):
    f = spark.createDataFrame([(1, "h", i, s) for i, s in enumerate([403, 403, 200, 500, 200, 500, 200])], "company_id long, host string, ord long, status int")
    got = {r["ord"]: (r["failures_before"], r["streak_before"], r["skipped"]) for r in merge.running_failures(f, limit=4, streak=2).collect()}
    assert got == {0: (0, 0, False), 1: (1, 1, False), 2: (2, 2, True), 3: (2, 0, False), 4: (3, 0, False), 5: (3, 0, False), 6: (4, 0, True)}


def test_tournament_prefers_the_earliest_complete_row(spark):
    c = rows(spark, {"company_id": 1, "ceo": None}, {"company_id": 2}, {"company_id": 3, "ebit": 1.0}, {"company_id": 4}, {"company_id": 5}, {"company_id": 6}).withColumn("grp", F.lit(1)).withColumn("ord", F.col("company_id"))
    assert validate.tournament(c, "grp").first()["company_id"] == 2
