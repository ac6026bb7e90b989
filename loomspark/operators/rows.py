"""Public rows, rows of failed companies, rejection notes, timeouts and the gate before a release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.rounding import matches

_DATA = "struct<revenue_msek: double, ebit_msek: double, employees: double, ceo: string, fiscal_year: int>"
_SUSTAINABILITY = "struct<reportUrl: string, reportDownloaded: string, scope1_co2_tonnes: double, scope2_co2_tonnes: double, methodology: string, confidence: string, note: string>"
STAGES = ("irDiscovery", "reportDiscovery", "download", "extraction", "validation")
#: Columns of a public row in order; whatever else a row has stays inside.
PUBLIC = (
    "company ticker website irPage annualReportUrl annualReportDownloaded fiscalYear extractedData sustainability dataSource confidence status fallbackStepReached detectedCompanyType cached cachedAt extractionNotes"
).split()


def public_json(rows: DataFrame) -> Column:
    """The row as the outside sees it: nulls written out, the adjudication only where there is one, stages never."""
    have = {c.lower() for c in rows.columns}
    fields = [F.col(c) if c.lower() in have else F.lit(None).cast("string").alias(c) for c in PUBLIC]
    plain = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    if "dualtrackadjudication" not in have:
        return plain
    return F.when(F.col("dualTrackAdjudication").isNull(), plain).otherwise(F.to_json(F.struct(*fields, F.col("dualTrackAdjudication")), {"ignoreNullFields": "false"}))


def _ended(companies: DataFrame, status: str, confidence: Column, note: Column, sustainability: str, stage: str, error: Column) -> DataFrame:
    none = lambda kind: F.lit(None).cast(kind)
    skipped = F.struct(F.lit(stage).alias("status"), none("string").alias("value"), error.alias("error"))
    empty = F.from_json(F.lit("{}"), _SUSTAINABILITY)
    return companies.select(
        F.col("name").alias("company"),
        "ticker",
        "website",
        none("string").alias("irPage"),
        none("string").alias("annualReportUrl"),
        none("string").alias("annualReportDownloaded"),
        none("int").alias("fiscalYear"),
        none(_DATA).alias("extractedData"),
        empty.withField("note", F.lit(sustainability)).alias("sustainability"),
        none("string").alias("dataSource"),
        confidence.cast("int").alias("confidence"),
        F.lit(status).alias("status"),
        F.lit("none").alias("fallbackStepReached"),
        none("string").alias("detectedCompanyType"),
        F.lit(False).alias("cached"),
        F.array(note).alias("extractionNotes"),
        F.struct(*(skipped.alias(s) for s in STAGES)).alias("stages"),
    )


def failed_rows(companies: DataFrame, error: Column) -> DataFrame:
    """The row of each company whose run ended with an error. ``companies`` has name, ticker, website."""
    return _ended(companies, "failed", F.lit(None), error, "Pipeline failed", "failed", error)


def timeout_rows(companies: DataFrame, limit_ms: Column) -> DataFrame:
    """The row of each company whose run was stopped after ``limit_ms``."""
    note = F.concat(F.lit("Pipeline timed out after "), limit_ms.cast("string"), F.lit("ms"))
    return _ended(companies, "timeout", F.lit(0), note, "Pipeline timed out", "skipped", F.lit("Skipped because a prior stage did not succeed"))


def with_timeouts(rows: DataFrame, wall_ms: str, limit_ms: int) -> DataFrame:
    """``company, json``: runs over the limit as timeout rows, the others as they are. ``rows`` has name, ticker, website, json and the time."""
    late = timeout_rows(rows.where(F.col(wall_ms) > limit_ms), F.lit(limit_ms))
    return rows.where(F.col(wall_ms) <= limit_ms).select(F.col("name").alias("company"), "json").unionAll(late.select("company", public_json(late).alias("json")))


def over_budget(stages: DataFrame, budgets: dict[str, int]) -> DataFrame:
    """Stage runs over their time budget, with the note that tells of it. ``stages`` has company_id, stage, duration_ms."""
    budget = F.element_at(F.create_map(*(F.lit(x) for pair in budgets.items() for x in pair)), F.col("stage"))
    rows = stages.withColumn("budget_ms", budget).where(F.col("duration_ms") > F.col("budget_ms"))
    return rows.select("company_id", "stage", "duration_ms", "budget_ms", F.concat(F.lit("Stage budget exhausted for "), "stage").alias("note"))


def rejection_notes(rejections: DataFrame, key: str = "company_id", step: str = "step", reason: str = "reason") -> DataFrame:
    """Per company and step one note with its reasons, sorted, and how often each came up."""
    counts = rejections.groupBy(key, step, reason).agg(F.count(F.lit(1)).alias("n"))
    pairs = counts.groupBy(key, step).agg(F.array_sort(F.collect_list(F.struct(F.col(reason).alias("reason"), "n"))).alias("pairs"))
    text = F.array_join(F.transform("pairs", lambda p: F.concat(p["reason"], F.lit("="), p["n"].cast("string"))), ", ")
    return pairs.select(key, step, F.concat(F.col(step), F.lit(": rejection summary ("), text, F.lit(")")).alias("note"))


def narrow_repairs(ebit: Column, revenue: Column, employees: Column, ceo: Column, notes: Column) -> tuple[Column, Column]:
    """Whether the operating profit alone is asked for again, and whether the people are."""
    discarded = matches(notes, "discarding ebit|semantic mismatch|assignment safety|exceeds revenue")
    return ebit.isNull() & revenue.isNotNull() & discarded, employees.isNull() | ceo.isNull()


def forbidden_or_missing(message: Column) -> Column:
    """An error that tells of a forbidden or missing page."""
    return matches(message, r"\b403\b|\b404\b|status code 40[34]")


def not_run(skip_reason: Column, error: Column) -> Column:
    """The adjudication of a company whose second track did not run, or failed with ``error``."""
    failed = F.struct(F.lit(None).cast("string").alias("finalValue"), F.lit("failed").alias("status"), F.lit("none").alias("acceptedTrack"), F.lit("LLM challenger not run").alias("reason"))
    fields = F.struct(*(failed.alias(f) for f in ("revenue_msek", "ebit_msek", "employees", "ceo", "fiscalYear")))
    return F.struct(error.isNotNull().alias("ranLlm"), F.when(error.isNull(), skip_reason).alias("skipReason"), error.alias("llmError"), fields.alias("fields"))


def promotion_gate(checks: DataFrame) -> DataFrame:
    """``passed, failed_check, skipped``: checks run in order and the first failure ends the gate. ``checks`` has ord, name, available, ok; one that isn't available is skipped."""
    first = F.min(F.when(F.col("available") & ~F.col("ok"), F.struct("ord", "name")))
    return checks.agg(first.alias("first"), F.count_if(~F.col("available")).alias("skipped")).select(F.col("first").isNull().alias("passed"), F.col("first.name").alias("failed_check"), "skipped")
