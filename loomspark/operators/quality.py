"""Roll-ups over result rows: status, failure classes, null rates and reasons, grades, bands.

Result rows have ``company, ticker, company_type, revenue, ebit, employees, ceo, fiscal_year, has_data, timed_out, data_source, fallback_step, confidence, failed_stage,
report_url, notes``; ``notes`` joins the trace with `` | ``. Roll-ups aggregate partially before their shuffle and return a few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions.rounding import matches, present

HEADLINE = ("revenue", "ebit", "employees", "ceo")

# Class, reason and bucket names, and the patterns they stand for.
FAILURE_CLASSES = ("complete", "partial_pdf", "allabolag_partial", "no_ir", "no_pdf", "download_failed", "extraction_failed", "validation_failed", "failed_other", "timeout")
STAGE_CLASSES = {"irDiscovery": "no_ir", "reportDiscovery": "no_pdf", "download": "download_failed", "extraction": "extraction_failed", "validation": "validation_failed"}
DISCARD_PATTERNS = {
    "ebit_gt_revenue": r"ebit .*exceeds revenue|discarding ebit",
    "revenue_implausible": r"revenue implausibly high|revenue .*implausible",
    "ebit_implausible": r"ebit implausibly large",
    "employee_low": r"employee count too low|suspect_low",
    "employee_high": r"employee count implausibly high",
    "employee_year_misread": r"fiscal-year column misread",
}
NON_ANNUAL = r"\b(corporate governance|governance report|policy|presentation|factbook|agm|general meeting|remuneration report)\b"
ANNUAL = r"\b(annual report|annual and sustainability report|integrated report)\b|årsredovisning"
#: Field to its reasons in order; every pattern of a reason must be found in the notes.
NULL_REASONS: dict[str, tuple[tuple[str, tuple[str, ...]], ...]] = {
    "ebit": (
        ("timeout", (r"Pipeline timed out",)),
        ("not_found", (r"EBIT not extracted|EBIT not found",)),
        ("validator_bank_semantic_mismatch", (r"discarding ebit for assignment safety|semantic mismatch",)),
        ("validator_ebit_gt_revenue", (r"exceeds revenue",)),
        ("validator_ebit_implausible", (r"EBIT implausibly large",)),
        ("extractor_fused_year_artifact", (r"fused-year artifact.*ebit",)),
    ),
    "employees": (
        ("timeout", (r"Pipeline timed out",)),
        ("not_found", (r"Employee count not extracted|Employees not found",)),
        ("extractor_year_column_misread", (r"fiscal-year column misread",)),
        ("validator_employee_implausible_high", (r"implausibly high", r"employee")),
        ("validator_industrial_floor", (r"too low .*industrial large-cap",)),
        ("validator_employee_too_low", (r"Employee count too low",)),
        ("policy_investment_company_headcount", (r"portfolio/holdings headcount",)),
        ("extractor_suspect_low_vs_revenue", (r"SUSPECT_LOW:.*employees",)),
    ),
    "revenue": (
        ("not_found", (r"Revenue not extracted|Revenue not found",)),
        ("policy_investment_company", (r"Investment company — standard revenue not applicable",)),
        ("validator_revenue_discard", (r"implausibly high|below 1,000|non-positive", r"revenue")),
    ),
    "ceo": (("not_found", (r"CEO not found|CEO not extracted",)), ("extractor_non_person_ceo", (r"non-person ESEF",))),
}
TIMEOUT_PATTERNS = {
    "no_pdf": r"no (income statement signals|extracted data)|quality gate rejected",
    "discovery_budget": r"Stage budget exhausted for .*discover",
    # The second alternative stands alone, as published: any mention of the statutory site counts.
    "fallback_budget": r"Stage budget exhausted for .*ir-html|allabolag",
}


def status() -> Column:
    """complete, partial, failed or timeout: investment companies need no EBIT to be complete."""
    filled = present("revenue", "ebit", "employees", "ceo") - F.when(F.col("company_type") == "investment_company", F.isnotnull("ebit").cast("int")).otherwise(0)
    needed = F.when(F.col("company_type") == "investment_company", 3).otherwise(4)
    return F.when(F.col("timed_out"), "timeout").when(~F.col("has_data") | (filled == 0), "failed").when(filled == needed, "complete").otherwise("partial")


def with_status(results: DataFrame) -> DataFrame:
    return results.withColumn("status", status())


def failure_class(stages: bool = True) -> Column:
    """The first that fits: timeout, complete, a failed stage, the source, partial, other. Without stage columns those are passed over."""
    case = F.when(F.col("status") == "timeout", "timeout").when(F.col("status") == "complete", "complete")
    for stage, name in STAGE_CLASSES.items() if stages else ():
        case = case.when(F.col("failed_stage") == stage, name)
    return case.when(F.col("data_source") == "allabolag", "allabolag_partial").when((F.col("data_source") == "ir-html") | (F.col("status") == "partial"), "partial_pdf").otherwise("failed_other")


def failure_tally(results: DataFrame) -> DataFrame:
    """Count of each of the ten classes, zeros included."""
    classes = results.sparkSession.createDataFrame([(c,) for c in FAILURE_CLASSES], "failure_class string")
    counted = with_status(results).groupBy(failure_class().alias("failure_class")).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(classes).join(counted, "failure_class", "left").select("failure_class", F.coalesce("n", F.lit(0)).alias("n"))


def count_by(results: DataFrame, column: str) -> DataFrame:
    return with_status(results).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def fields_filled() -> Column:
    """0 to 5, with the fiscal year."""
    return present(*HEADLINE, "fiscal_year")


def run_summary(results: DataFrame) -> DataFrame:
    """One row: counts by status and class, mean fields, and the health grade."""
    rows = with_status(results).withColumn("failure_class", failure_class())
    n = F.count(F.lit(1))
    flags = {s: F.count_if(F.col("status") == s).alias(s) for s in ("complete", "partial", "failed", "timeout")}
    flags |= {f"class_{c}": F.count_if(F.col("failure_class") == c).alias(f"class_{c}") for c in FAILURE_CLASSES if c not in ("complete", "timeout")}
    summed = rows.agg(n.alias("companies"), *flags.values(), F.sum(fields_filled()).alias("fields_filled"))
    return summed.withColumn("grade", health_grade(F.col("complete") / F.col("companies"), F.col("partial") / F.col("companies"), F.col("timeout") / F.col("companies")))


def health_grade(complete: Column, partial: Column, timeout: Column) -> Column:
    score = complete + partial * 0.5
    return F.when((score >= 0.85) & (timeout < 0.05), "A").when((score >= 0.75) & (timeout < 0.10), "B").when((score >= 0.60) & (timeout < 0.20), "C").when(score >= 0.40, "D").otherwise("F")


def null_rates(results: DataFrame) -> DataFrame:
    """``field, nulls, null_rate``: percent of rows, one decimal; a row without data counts as null."""
    counts = results.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.isnull(f)).alias(f) for f in HEADLINE))
    long = counts.unpivot("n", list(HEADLINE), "field", "nulls")
    return long.select("field", "nulls", (F.floor(F.col("nulls") * 1000 / F.greatest("n", F.lit(1)) + 0.5) / 10).alias("null_rate"))


def wrong_report() -> Column:
    """The url and notes speak of another kind of document and not of an annual report."""
    hay = F.concat_ws(" ", F.coalesce("report_url", F.lit("")), "notes")
    return matches(hay, NON_ANNUAL) & ~matches(hay, ANNUAL)


def discard_buckets(results: DataFrame) -> DataFrame:
    counts = results.agg(*(F.count_if(matches("notes", p)).alias(name) for name, p in DISCARD_PATTERNS.items()), F.count_if(wrong_report()).alias("wrong_report_class"))
    return counts.unpivot([], [*DISCARD_PATTERNS, "wrong_report_class"], "bucket", "n")


def wrong_report_rows(results: DataFrame) -> DataFrame:
    return with_status(results).where(wrong_report()).select("company", "ticker", "status", "report_url")


def null_reason(field: str) -> Column:
    """Why a headline field is null, by the first rule that fits; null where it is filled."""
    if field in ("ebit", "employees"):
        case = F.when(F.col("status") == "timeout", "timeout").when((F.col("status") == "failed") & ~F.col("has_data"), "no_extracted_data")
        last = F.when(F.col("has_data"), "unknown_null_after_validation").otherwise("no_extracted_data")
    else:
        case = F.when(F.col("status") == "timeout", "timeout").when(~F.col("has_data"), "no_extracted_data")
        last = F.lit("unknown_null_after_validation")
    for reason, patterns in NULL_REASONS[field]:
        case = case.when(reduce(Column.__and__, [matches("notes", p) for p in patterns]), reason)
    return F.when(F.isnull(field), case.otherwise(last))


def null_ledger(results: DataFrame) -> DataFrame:
    rows = with_status(results)
    return rows.select("company", "ticker", "status", *(null_reason(f).alias(f"{f}_reason") for f in ("ebit", "employees", "revenue", "ceo")))


def ledger_tallies(results: DataFrame) -> DataFrame:
    ledger = null_ledger(results)
    fields = [c for c in ledger.columns if c.endswith("_reason")]
    long = ledger.unpivot([], fields, "field", "reason").where("reason IS NOT NULL")
    return long.groupBy(F.regexp_replace("field", "_reason$", "").alias("field"), "reason").agg(F.count(F.lit(1)).alias("n"))


def timeout_profile(results: DataFrame) -> DataFrame:
    rows = with_status(results)
    counts = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "timeout").alias("timeout"), F.count_if(F.col("status") == "failed").alias("failed"), *(F.count_if(matches("notes", p)).alias(n) for n, p in TIMEOUT_PATTERNS.items()))
    return counts


def confidence_band(confidence: str = "confidence") -> Column:
    return F.when(F.isnull(confidence), "none").when(F.col(confidence) >= 80, "high").when(F.col(confidence) >= 50, "medium").otherwise("low")


def confidence_bands(results: DataFrame) -> DataFrame:
    return results.groupBy(confidence_band().alias("band")).agg(F.count(F.lit(1)).alias("n"), F.min("confidence").alias("low"), F.max("confidence").alias("high"))


def worst_partials(results: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` partial rows with the fewest fields; a report, so it is limited."""
    rows = with_status(results).where("status = 'partial'").withColumn("fields", fields_filled())
    return rows.orderBy("fields", "company").limit(n).select("company", "fields", "confidence")


def rejection_telemetry(results: DataFrame) -> DataFrame:
    """``reason, n``: the counts in the notes' rejection summaries, summed."""
    inside = F.explode(F.expr(r"regexp_extract_all(notes, '(?i)rejection summary \\(([^)]+)\\)', 1)")).alias("items")
    items = results.select(inside).select(F.explode(F.split("items", ",")).alias("item"))
    pair = items.select(F.regexp_extract("item", r"^\s*([A-Za-z-]+)\s*=\s*(\d+)\s*$", 1).alias("reason"), F.regexp_extract("item", r"^\s*([A-Za-z-]+)\s*=\s*(\d+)\s*$", 2).alias("n"))
    return pair.where("reason <> ''").groupBy("reason").agg(F.sum(F.col("n").cast("long")).alias("n"))


def rate_checks(results: DataFrame, min_complete: float = 0.3, max_failed: float = 0.5, max_timeout: float = 0.6) -> DataFrame:
    """``rule, passed``: floors and ceilings of the status rates."""
    rates = with_status(results).agg(*(F.avg((F.col("status") == s).cast("double")).alias(s) for s in ("complete", "failed", "timeout")))
    return rates.select(
        F.inline(
            F.array(
                F.struct(F.lit("min_complete").alias("rule"), (F.col("complete") >= min_complete).alias("passed")),
                F.struct(F.lit("max_failed").alias("rule"), (F.col("failed") <= max_failed).alias("passed")),
                F.struct(F.lit("max_timeout").alias("rule"), (F.col("timeout") <= max_timeout).alias("passed")),
            )
        )
    )


def completeness(results: DataFrame) -> DataFrame:
    """Rows by number of filled fields, the fiscal year counted."""
    return results.groupBy(fields_filled().alias("fields")).agg(F.count(F.lit(1)).alias("n"))


def missing_field_queue(results: DataFrame, attempted: DataFrame | None = None) -> DataFrame:
    """Rows with gaps, those with most fields first, as a rank; companies already attempted are left out."""
    rows = with_status(results).where(present(*HEADLINE) < 4)
    if attempted is not None:
        rows = rows.join(attempted.select("company").distinct(), "company", "left_anti")
    missing = F.array_join(F.array_compact(F.array(*(F.when(F.isnull(f), f) for f in HEADLINE))), "|")
    return rows.select("company", present(*HEADLINE).alias("present"), missing.alias("missing"))


def loop_metrics(rounds: DataFrame) -> DataFrame:
    """Per round its completeness and whether it and the one before passed in full: the stop rule. ``rounds`` is a small state table (round, complete, total)."""
    by_round = Window.orderBy("round")
    full = (F.col("complete") == F.col("total")).cast("int")
    return rounds.select("round", (F.col("complete") / F.col("total")).alias("rate"), (full + F.coalesce(F.lag(full).over(by_round), F.lit(0)) == 2).alias("stop"))


def review_queue(results: DataFrame) -> DataFrame:
    """Rows with a null headline field: missing names, a suggested override and the last note."""
    rows = with_status(results).where(present(*HEADLINE) < 4)
    missing = F.array_join(F.array_compact(F.array(*(F.when(F.isnull(f), f) for f in HEADLINE))), "|")
    override = F.to_json(F.struct(*(F.lit(None).cast("double").alias(f) for f in ("revenue", "ebit", "employees"))), {"ignoreNullFields": "false"})
    return rows.select("company", "ticker", "status", "report_url", "revenue", "ebit", "employees", "ceo", missing.alias("missing_fields"), override.alias("suggested_override"), F.element_at(F.split("notes", r" \| "), -1).alias("latest_note"))


def partial_report(results: DataFrame, last: int = 10) -> DataFrame:
    """Partial rows with their last ten notes."""
    notes = F.split("notes", r" \| ")
    return with_status(results).where("status = 'partial'").select("company", "ticker", "data_source", "confidence", F.array_join(F.slice(notes, F.greatest(F.size(notes) - last + 1, F.lit(1)), last), " || ").alias("last_notes"))
