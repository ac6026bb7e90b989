"""Risk points of result rows and of preflight checks, and the gate to the second track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.texts import host_key
from loomspark.functions.rounding import matches
from loomspark.operators.quality import with_status

# Patterns over the notes.
REJECTED = r"quality gate rejected|rejected .* candidate|rejection summary|revenue-too-high|entity-check"
LAYOUT = r"unit guard|fused year pattern|likely .* misread|suspiciously low"
ENTITY = r"entity check failed|ambiguity=high|host collision|no matching company"
TRANSPORT = r"403|429|download failed|playwright fallback|cloud"
WRONG_DOCUMENT = r"governance report|corporate governance report|quarterly report|no income statement|no consolidated income statement|no balance sheet"
CORRUPTION = r"fused year pattern detected|implausibly large|stage budget exhausted"
ANTI_BOT = r"access denied|forbidden|captcha|cloudflare|bot"
ANNUAL_WORDS = ("annual report", "årsredovisning", "financial reports", "investors", "reports")


def tier(score: Column) -> Column:
    return F.when(score <= 34, "low").when(score <= 64, "medium").otherwise("high")


def band(signals: Column) -> Column:
    return F.when(signals >= 5, "high").when(signals >= 3, "medium").otherwise("low")


def _roll_up(rows: DataFrame, rules: list[tuple[Column, Column | int, str | None]]) -> DataFrame:
    """``rules``: condition, points, archetype. Adds risk_score, n_signals, archetypes (sorted, distinct), tier and band."""
    flags = [F.coalesce(c, F.lit(False)) for c, _, _ in rules]
    rows = rows.withColumns({f"_r{i}": f for i, f in enumerate(flags)})
    score = sum((F.when(F.col(f"_r{i}"), p).otherwise(0) for i, (_, p, _) in enumerate(rules)), F.lit(0))
    kinds = F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.col(f"_r{i}"), a) for i, (_, _, a) in enumerate(rules) if a)))))
    signals = sum((F.col(f"_r{i}").cast("int") for i in range(len(rules))), F.lit(0))
    rows = rows.withColumn("risk_score", F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("int")).withColumn("n_signals", signals).withColumn("archetypes", kinds)
    return rows.drop(*(f"_r{i}" for i in range(len(rules)))).withColumn("risk_tier", tier(F.col("risk_score"))).withColumn("confidence_band", band(F.col("n_signals")))


def risk_map(results: DataFrame) -> DataFrame:
    rows = with_status(results)
    notes = F.split("notes", r" \| ")
    both = matches("notes", "revenue unit guard") & matches("notes", "ebit unit guard")
    rules = [
        (F.col("status").isin("failed", "partial", "timeout"), F.when(F.col("status") == "failed", 20).when(F.col("status") == "partial", 10).otherwise(25), None),
        (F.col("fallback_step").isin("playwright", "search", "allabolag"), 15, "js_heavy_ir"),
        (F.exists(notes, lambda n: n.rlike("(?iu)" + REJECTED)), 15, "ambiguous_pdf_corpus"),
        (F.exists(notes, lambda n: n.rlike("(?iu)" + LAYOUT)), 10, "layout_fragile_pdf"),
        (both, 10, "layout_fragile_pdf"),
        (matches("notes", "fiscal year mismatch"), 10, "entity_ambiguity"),
        (F.col("confidence") < 85, 10, None),
        (F.col("company_type").isin("investment_company", "real_estate"), F.when(F.col("company_type") == "real_estate", 5).otherwise(10), "industry_semantic_risk"),
        (matches("notes", ENTITY), 10, "entity_ambiguity"),
        (matches("notes", TRANSPORT), 8, "cloud_transport_risk"),
    ]
    out = _roll_up(rows, rules)
    has = lambda kind: F.array_contains("archetypes", kind)
    action = (
        F.when(F.col("risk_tier") == "low", "routine")
        .when(F.col("risk_tier") == "medium", "periodic_check")
        .when(has("js_heavy_ir") | has("cloud_transport_risk"), "cloud_preflight")
        .when(has("layout_fragile_pdf"), "layout_fixture")
        .otherwise("full_validation")
    )
    return out.select("company", "ticker", "status", "confidence", "risk_score", "risk_tier", "n_signals", "confidence_band", F.array_join("archetypes", ",").alias("archetypes"), action.alias("action"))


def page_signals(pages: DataFrame, html: str = "html") -> DataFrame:
    """Counts over a page's first 400,000 characters: annual wording, links to PDF files, scripts, anchors, challenge words."""
    hay = F.lower(F.substring(F.coalesce(F.col(html), F.lit("")), 1, 400_000))
    count = lambda p: F.size(F.regexp_extract_all(hay, F.lit(p), F.lit(0)))
    words = sum((hay.contains(w).cast("int") for w in ANNUAL_WORDS), F.lit(0))
    return pages.withColumns({"annual_words": words, "pdf_links": count(r'\.pdf(\?|")'), "scripts": count(r"<script[\s>]"), "anchors": count(r"<a[\s>]"), "challenged": hay.rlike(ANTI_BOT)})


def host_drift(final_url: Column, domains: Column) -> Column:
    """The page that answered is on none of the candidate domains; without domains or a host there is no telling, so false."""
    host = host_key(final_url)
    names = F.filter(F.transform(domains, lambda d: F.when(d.startswith("http"), host_key(d)).otherwise(F.regexp_replace(F.lower(d), r"^www\.", ""))), lambda n: n.isNotNull() & (n != ""))
    return F.coalesce((F.size(domains) > 0) & host.isNotNull() & ~F.exists(names, lambda n: host.contains(n)), F.lit(False))


def preflight_risk(checks: DataFrame) -> DataFrame:
    """``checks``: page signals with ``status_code, response_ms, host_drift``."""
    rules = [
        (F.col("status_code").isNull() | (F.col("status_code") >= 400), 25, "cloud_transport_risk"),
        (F.col("response_ms") > 5000, 8, "cloud_transport_risk"),
        (F.col("annual_words") == 0, 15, "ambiguous_pdf_corpus"),
        (F.col("pdf_links") == 0, 10, "ambiguous_pdf_corpus"),
        (F.col("host_drift"), 15, "entity_ambiguity"),
        ((F.col("scripts") >= 8) & (F.col("anchors") <= 12), 15, "js_heavy_ir"),
        (F.col("challenged"), 10, "cloud_transport_risk"),
    ]
    return _roll_up(checks, rules)


def second_track(results: DataFrame, hard: DataFrame | None = None, force: bool = False) -> DataFrame:
    """The decision for each row, first rule first: whether the second track runs, and why."""
    rows = with_status(results).withColumn("hard", F.lit(False))
    if hard is not None:
        names = hard.select(F.lower("company").alias("_name")).distinct().withColumn("_hit", F.lit(True))
        rows = rows.join(names, F.lower("company") == F.col("_name"), "left").withColumn("hard", F.coalesce("_hit", F.lit(False))).drop("_name", "_hit")
    gap = (F.col("ebit").isNull() & F.col("revenue").isNotNull()) | F.col("employees").isNull() | F.col("ceo").isNull() | (F.col("revenue").isNull() & F.col("ebit").isNotNull())
    reason = (
        F.when(F.col("status") == "timeout", "timeout")
        .when(F.lit(force), "forced")
        .when(F.col("company_type") == "investment_company", "investment")
        .when(F.col("hard"), "hard_list")
        .when(~F.col("has_data"), "no_data")
        .when(~F.col("status").isin("partial", "failed"), "status")
        .when(F.col("confidence").isNull() | (F.col("confidence") < 80), "confidence")
        .when(matches("notes", WRONG_DOCUMENT), "wrong_document")
        .when(matches("notes", CORRUPTION), "corruption")
        .when(gap, "gap")
        .otherwise("no_gap")
    )
    return rows.select("company_id", "company", "status", reason.alias("reason"), reason.isin("forced", "hard_list", "gap").alias("run"))
