"""Validation by company type, with a confidence score; unit repairs; merit of candidates.

Columns in and out: ``company_type, revenue, ebit, employees, ceo, notes``. Values that can't be trusted become null; penalties come off 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions.rounding import matches, present, round_half_up

# Limits in millions of the reporting currency.
MEGASCALE = {"industrial": 3_000_000, "bank": 80_000_000, "investment_company": 2_000_000, "real_estate": 50_000}
RELAXED_FLOOR = r"segment-level|parent[\s-]company|moderbolag|non[\s-]consolidated|huvudkontor\s+only"


def _first(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that holds."""
    case = None
    for condition, name in rules:
        case = F.when(condition, name) if case is None else case.when(condition, name)
    return case.otherwise("ok")


def _penalty(rule: str, points: dict[str, int]) -> Column:
    return sum((F.when(F.col(rule) == name, p).otherwise(0) for name, p in points.items()), F.lit(0))


REVENUE_POINTS = {"missing": 20, "non_positive": 15, "too_high": 15, "bank_low": 6, "rescaled": 8, "below_floor": 15}
EBIT_POINTS = {"missing": 15, "too_large": 15}
RATIO_POINTS = {"operating_metric": 4, "bank_low_proxy": 5, "bank_near": 5, "bank_mismatch": 12, "estate_near": 5, "estate_far": 15, "above_revenue": 15}
EMPLOYEE_POINTS = {"missing": 15, "floor_relaxed": 8, "industrial_low": 15, "too_low": 15, "too_high": 15}
CEO_POINTS = {"missing": 15, "one_word": 5}


def validate(rows: DataFrame) -> DataFrame:
    """The rows with cleaned figures, ``confidence_score``, and the rule that each field met. Unknown types take no type's rules; a null type is industrial."""
    kind = F.coalesce("company_type", F.lit("industrial"))
    bank, industrial, estate, invest = (kind == t for t in ("bank", "industrial", "real_estate", "investment_company"))
    revenue, ebit, employees = F.col("revenue"), F.col("ebit"), F.col("employees")
    margin = F.when((revenue > 0) & (ebit > 0), ebit / revenue)
    misread = revenue.between(100, 999.999999) & (employees >= 5000) & (revenue / employees < 0.03) & margin.between(0.08, 0.45)
    floor = industrial & (revenue < 1000)
    rows = rows.withColumn(
        "revenue_rule",
        _first(
            (revenue.isNull(), "missing"),
            ((revenue <= 0) & ~invest, "non_positive"),
            (revenue > F.when(bank, 50_000_000).otherwise(5_000_000), "too_high"),
            (bank & (revenue > 0) & (revenue < 10_000), "bank_low"),
            (floor & F.coalesce(misread, F.lit(False)), "rescaled"),
            (floor, "below_floor"),
        ),
    )
    rows = rows.withColumn("ebit_rule", _first((ebit.isNull(), "missing"), (F.abs(ebit) > F.when(bank, 3_000_000).otherwise(2_000_000), "too_large")))
    rows = rows.withColumn("revenue", F.when(F.col("revenue_rule") == "rescaled", revenue * 1000).when(~F.col("revenue_rule").isin("missing", "non_positive", "too_high", "below_floor"), revenue))
    rows = rows.withColumn("ebit", F.when(F.col("ebit_rule") == "ok", ebit))

    above = F.coalesce(ebit > revenue, F.lit(False))
    ratio = ebit / F.greatest(revenue, F.lit(1.0))
    metric = estate & F.col("notes").contains("EBIT estimated from förvaltningsresultat") & F.col("notes").contains("primary operating metric")
    rows = rows.withColumn(
        "ratio_rule",
        _first(
            (~above, "ok"),
            (metric, "operating_metric"),
            (bank & (revenue < 10_000), "bank_low_proxy"),
            (bank & (ratio <= 1.3) & (ebit - revenue <= 15_000), "bank_near"),
            (bank, "bank_mismatch"),
            (estate & (ratio <= 3), "estate_near"),
            (estate, "estate_far"),
            (above, "above_revenue"),
        ),
    )
    rows = rows.withColumn("ebit", F.when(~F.col("ratio_rule").isin("bank_mismatch", "estate_far", "above_revenue"), ebit))

    relaxed = matches("notes", RELAXED_FLOOR)
    rows = rows.withColumn(
        "employee_rule",
        _first(
            (employees.isNull(), "missing"),
            (industrial & (employees < 100) & relaxed & (employees >= 20), "floor_relaxed"),
            (industrial & (employees < 100), "industrial_low"),
            (employees < 50, "too_low"),
            (employees > 700_000, "too_high"),
        ),
    )
    rows = rows.withColumn("employees", F.when(F.col("employee_rule").isin("ok", "floor_relaxed"), employees))
    rows = rows.withColumn("ceo_rule", _first((F.col("ceo").isNull(), "missing"), (F.size(F.split(F.trim("ceo"), r"\s+")) < 2, "one_word")))

    few = F.coalesce(bank & (employees < revenue / 50), F.lit(False))
    points = (
        _penalty("revenue_rule", REVENUE_POINTS)
        + _penalty("ebit_rule", EBIT_POINTS)
        + _penalty("ratio_rule", RATIO_POINTS)
        + _penalty("employee_rule", EMPLOYEE_POINTS)
        + _penalty("ceo_rule", CEO_POINTS)
        + F.when(few, 5).otherwise(0)
        + F.when(invest & (revenue.isNotNull() | ebit.isNotNull()), 8).otherwise(0)
        + F.when(matches("notes", r"(^|\| )ENTITY WARNING"), 25).otherwise(0)
        + F.when(matches("notes", r"(^|\| )CONTENT WARNING"), 15).otherwise(0)
        + F.when(matches("notes", r"fiscal year mismatch"), 10).otherwise(0)
    )
    return rows.withColumn("confidence_score", F.greatest(F.lit(0), F.least(F.lit(100), 100 - points)).cast("int"))


def confidence_cap(source: str = "data_source", score: str = "confidence_score") -> Column:
    """Rows from the statutory site are trusted up to 30."""
    return F.when(F.col(source) == "allabolag", F.least(F.col(score), F.lit(30))).otherwise(F.col(score))


def megascale_guard(rows: DataFrame) -> DataFrame:
    """Revenue absurdly large for its type is divided by 1000 once: thousands were read as millions."""
    limit = F.element_at(F.create_map(*(F.lit(x) for pair in MEGASCALE.items() for x in pair)), F.col("company_type"))
    over = F.coalesce(F.col("revenue") > limit, F.lit(False))
    return rows.withColumns({"revenue": F.when(over, round_half_up(F.col("revenue") / 1000)).otherwise(F.col("revenue")), "adjusted": over})


def ebit_rescale(rows: DataFrame) -> DataFrame:
    """``ebit_fixed, divisor``: EBIT above revenue, divided by the first of 1000, 100, 10 that fits (10 first for industrial ratios under 2.2); null where nothing is to be done."""
    kind, ebit, revenue = F.col("company_type"), F.col("ebit"), F.col("revenue")
    ratio, delta = ebit / revenue, ebit - revenue
    skip = (
        F.when(kind == "investment_company", True)
        .when((revenue <= 0) | (ebit <= revenue), True)
        .when(kind == "bank", (revenue < 10_000) | ((ratio <= 1.3) & (delta <= 15_000)))
        .when(kind == "real_estate", ratio < 1.5)
        .otherwise((ratio < 1.15) | (delta < 1000))
    )

    def fits(divisor: int) -> Column:
        size = F.abs(round_half_up(ebit / divisor))
        return (size <= F.abs(revenue) * 1.02 + 1) & ~((revenue >= 5000) & (size > 0) & (size < 50))

    def search(divisors: tuple[int, ...]) -> Column:
        return F.coalesce(*(F.when(fits(d), d) for d in divisors))

    divisor = F.when(~F.coalesce(skip, F.lit(True)), F.when((kind == "industrial") & (ratio < 2.2), search((10, 100, 1000))).otherwise(search((1000, 100, 10))))
    return rows.withColumn("divisor", divisor).withColumn("ebit_fixed", F.when(F.col("divisor").isNotNull(), round_half_up(ebit / F.col("divisor"))))


def orphan_ebit() -> Column:
    """No revenue, and an EBIT that is tiny for the headcount, outside investment companies."""
    size, staff = F.abs("ebit"), F.col("employees")
    tiny = ((staff >= 2000) & (size < 500)) | ((staff >= 250) & (size < 30))
    return F.coalesce((F.col("company_type") != "investment_company") & F.col("revenue").isNull() & tiny, F.lit(False))


def merit() -> Column:
    """Points of a candidate's figures: 10 each for revenue and EBIT, 4 each for employees and CEO, and coherence of EBIT with revenue by type."""
    revenue, ebit, kind = F.col("revenue"), F.col("ebit"), F.col("company_type")
    bank_fits = (ebit / F.greatest(revenue, F.lit(1.0)) <= 1.35) & (ebit - revenue <= 20_000)
    coherence = (
        F.when(revenue.isNull() | ebit.isNull(), 0)
        .when(kind == "bank", F.when(bank_fits, 14).otherwise(4))
        .when(kind == "real_estate", 10)
        .otherwise(F.when(ebit <= revenue, 14).when(ebit * 100 <= revenue * 108, 6).otherwise(-8))
    )
    points = {"revenue": 10, "ebit": 10, "employees": 4, "ceo": 4}
    return sum((F.when(F.isnotnull(c), p).otherwise(0) for c, p in points.items()), coherence)


def tournament(candidates: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """The winner for each key among its first ``limit`` candidates by ``ord``: the earliest with all four fields, else the highest merit, ties to the earlier."""
    first = Window.partitionBy(key).orderBy("ord")
    four = present("revenue", "ebit", "employees", "ceo") == 4
    ranked = candidates.withColumn("n", F.row_number().over(first)).where(F.col("n") <= limit)
    best = F.struct(four.cast("int").alias("four"), F.when(four, -F.col("n")).otherwise(merit()).alias("points"), (-F.col("n")).alias("early"))
    kept = [c for c in candidates.columns if c != key]
    return ranked.groupBy(key).agg(F.max_by(F.struct(*kept), best).alias("w")).select(key, "w.*")


def fiscal_year_check(expected: Column, found: Column) -> Column:
    """match, off_by_one (tolerated), mismatch, or null where either is unknown."""
    gap = F.abs(expected - found)
    return F.when(gap == 0, "match").when(gap == 1, "off_by_one").when(gap > 1, "mismatch")


def plausible_year(year: Column, as_of_year: int) -> Column:
    return F.when(year.between(as_of_year - 3, as_of_year + 1), year)


def cacheable() -> Column:
    return F.col("status").isin("complete", "partial")
