"""Queries over result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import adjudicate as adj
from loomspark.operators import quality as q
from loomspark.operators import risk as rk
from loomspark.operators import validate as v
from loomspark.plans import surrogate
from loomspark.plans.registry import query

R = surrogate.text(surrogate.RESULTS)
FILLED = "(CASE WHEN revenue IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN ebit IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN employees IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN ceo IS NOT NULL THEN 1 ELSE 0 END)"
STATUS = f"""CASE WHEN timed_out THEN 'timeout' WHEN NOT has_data THEN 'failed'
  WHEN company_type = 'investment_company' THEN CASE WHEN revenue IS NULL AND employees IS NULL AND ceo IS NULL THEN 'failed' WHEN revenue IS NOT NULL AND employees IS NOT NULL AND ceo IS NOT NULL THEN 'complete' ELSE 'partial' END
  WHEN {FILLED} = 0 THEN 'failed' WHEN {FILLED} = 4 THEN 'complete' ELSE 'partial' END"""
S = f"SELECT *, {STATUS} AS status FROM ({R}) r0"
CLASS = """CASE WHEN status = 'timeout' THEN 'timeout' WHEN status = 'complete' THEN 'complete' WHEN failed_stage = 'irDiscovery' THEN 'no_ir' WHEN failed_stage = 'reportDiscovery' THEN 'no_pdf'
  WHEN failed_stage = 'download' THEN 'download_failed' WHEN failed_stage = 'extraction' THEN 'extraction_failed' WHEN failed_stage = 'validation' THEN 'validation_failed' WHEN data_source = 'allabolag' THEN 'allabolag_partial'
  WHEN data_source = 'ir-html' OR status = 'partial' THEN 'partial_pdf' ELSE 'failed_other' END"""


def rows(spark: SparkSession, d: str) -> DataFrame:
    return surrogate.frame(spark, d, surrogate.RESULTS)


def like(pattern: str) -> str:
    """Case-insensitive search in the notes."""
    return "regexp_matches(notes, '(?i)" + pattern.replace("'", "''") + "')"


@query(f"""WITH s AS ({S}), c AS (SELECT *, {CLASS} AS failure_class FROM s)
SELECT *, CASE WHEN score >= 0.85 AND t < 0.05 THEN 'A' WHEN score >= 0.75 AND t < 0.10 THEN 'B' WHEN score >= 0.60 AND t < 0.20 THEN 'C' WHEN score >= 0.40 THEN 'D' ELSE 'F' END AS grade FROM (
SELECT count(*) AS companies, {", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("complete", "partial", "failed", "timeout"))},
{", ".join(f"count(*) FILTER (failure_class = '{c}') AS class_{c}" for c in q.FAILURE_CLASSES if c not in ("complete", "timeout"))},
CAST(sum({FILLED} + CASE WHEN fiscal_year IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS fields_filled, complete / companies + partial / companies * 0.5 AS score, timeout / companies AS t FROM c) x""".replace("SELECT *, CASE WHEN score", "SELECT * EXCLUDE (score, t), CASE WHEN score", 1))
def run_summary(spark, d):
    return q.run_summary(rows(spark, d))


@query(f"SELECT company_id, {STATUS} AS status FROM ({R}) r")
def status(spark, d):
    return q.with_status(rows(spark, d)).select("company_id", "status")


@query(f"SELECT k.failure_class, coalesce(n, 0) AS n FROM (SELECT unnest([{', '.join(repr(c) for c in q.FAILURE_CLASSES)}]) AS failure_class) k LEFT JOIN (SELECT {CLASS} AS failure_class, count(*) AS n FROM ({S}) s GROUP BY 1) c USING (failure_class)")
def failure_class_tally(spark, d):
    return q.failure_tally(rows(spark, d))


@query(f"SELECT company_id, CASE WHEN status IN ('timeout', 'complete') THEN status WHEN data_source = 'allabolag' THEN 'allabolag_partial' WHEN data_source = 'ir-html' OR status = 'partial' THEN 'partial_pdf' ELSE 'failed_other' END AS failure_class FROM ({S}) s")
def failure_class_short(spark, d):
    return q.with_status(rows(spark, d)).select("company_id", q.failure_class(stages=False).alias("failure_class"))


for _column in ("status", "fallback_step", "data_source", "company_type"):
    query(f"SELECT {_column} AS value, count(*) AS n FROM ({S}) s GROUP BY 1", f"count_by_{_column}")(lambda spark, d, c=_column: q.count_by(rows(spark, d), c))


@query(f"SELECT fields, count(*) AS n FROM (SELECT {FILLED} + CASE WHEN fiscal_year IS NOT NULL THEN 1 ELSE 0 END AS fields FROM ({R}) r) x GROUP BY 1")
def completeness(spark, d):
    return q.completeness(rows(spark, d))


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({f} IS NULL) AS nulls, floor(count(*) FILTER ({f} IS NULL) * 1000 / greatest(count(*), 1) + 0.5) / 10 AS null_rate FROM ({R}) r" for f in q.HEADLINE))
def null_rates(spark, d):
    return q.null_rates(rows(spark, d))


_HAY = "concat(coalesce(report_url, ''), ' ', notes)"
_WRONG = f"(regexp_matches({_HAY}, '(?i){q.NON_ANNUAL}') AND NOT regexp_matches({_HAY}, '(?i){q.ANNUAL}'))"


@query(" UNION ALL ".join([*(f"SELECT '{n}' AS bucket, count(*) FILTER ({like(p)}) AS n FROM ({R}) r" for n, p in q.DISCARD_PATTERNS.items()), f"SELECT 'wrong_report_class' AS bucket, count(*) FILTER ({_WRONG}) AS n FROM ({R}) r"]))
def discard_buckets(spark, d):
    return q.discard_buckets(rows(spark, d))


@query(f"SELECT company, ticker, status, report_url FROM ({S}) s WHERE {_WRONG}")
def wrong_report_rows(spark, d):
    return q.wrong_report_rows(rows(spark, d))


def _reason(field: str) -> str:
    head = "WHEN status = 'timeout' THEN 'timeout' "
    head += "WHEN status = 'failed' AND NOT has_data THEN 'no_extracted_data' " if field in ("ebit", "employees") else "WHEN NOT has_data THEN 'no_extracted_data' "
    middle = " ".join(f"WHEN {' AND '.join(like(p) for p in ps)} THEN '{r}'" for r, ps in q.NULL_REASONS[field])
    last = "CASE WHEN has_data THEN 'unknown_null_after_validation' ELSE 'no_extracted_data' END" if field in ("ebit", "employees") else "'unknown_null_after_validation'"
    return f"CASE WHEN {field} IS NOT NULL THEN NULL {head}{middle} ELSE {last} END"


_LEDGER = f"SELECT company, ticker, status, {', '.join(f'{_reason(f)} AS {f}_reason' for f in ('ebit', 'employees', 'revenue', 'ceo'))} FROM ({S}) s"


@query(_LEDGER)
def null_ledger(spark, d):
    return q.null_ledger(rows(spark, d))


@query("SELECT field, reason, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {f}_reason AS reason FROM ({_LEDGER}) l" for f in ("ebit", "employees", "revenue", "ceo")) + ") x WHERE reason IS NOT NULL GROUP BY 1, 2")
def ledger_tallies(spark, d):
    return q.ledger_tallies(rows(spark, d))


@query(f"SELECT count(*) AS total, count(*) FILTER (status = 'timeout') AS timeout, count(*) FILTER (status = 'failed') AS failed, {', '.join(f'count(*) FILTER ({like(p)}) AS {n}' for n, p in q.TIMEOUT_PATTERNS.items())} FROM ({S}) s")
def timeout_profile(spark, d):
    return q.timeout_profile(rows(spark, d))


@query(f"SELECT CASE WHEN confidence IS NULL THEN 'none' WHEN confidence >= 80 THEN 'high' WHEN confidence >= 50 THEN 'medium' ELSE 'low' END AS band, count(*) AS n, min(confidence) AS low, max(confidence) AS high FROM ({R}) r GROUP BY 1")
def confidence_bands(spark, d):
    return q.confidence_bands(rows(spark, d))


@query(f"SELECT company, CAST({FILLED} + CASE WHEN fiscal_year IS NOT NULL THEN 1 ELSE 0 END AS INT) AS fields, confidence FROM ({S}) s WHERE status = 'partial' ORDER BY fields, company LIMIT 10")
def worst_partials(spark, d):
    return q.worst_partials(rows(spark, d))


@query(f"SELECT reason, CAST(sum(CAST(n AS BIGINT)) AS BIGINT) AS n FROM (SELECT regexp_extract(item, '([A-Za-z-]+)=([0-9]+)', 1) AS reason, regexp_extract(item, '([A-Za-z-]+)=([0-9]+)', 2) AS n FROM (SELECT unnest(string_split(regexp_extract(notes, 'rejection summary \\(([^)]+)\\)', 1), ',')) AS item FROM ({R}) r) y) x WHERE reason <> '' GROUP BY 1")
def rejection_telemetry(spark, d):
    return q.rejection_telemetry(rows(spark, d))


@query(f"""SELECT unnest(['min_complete', 'max_failed', 'max_timeout']) AS rule, unnest([c >= 0.3, f <= 0.5, t <= 0.6]) AS passed FROM (SELECT avg(CAST(status = 'complete' AS DOUBLE)) AS c, avg(CAST(status = 'failed' AS DOUBLE)) AS f, avg(CAST(status = 'timeout' AS DOUBLE)) AS t FROM ({S}) s) x""".replace("CAST(status = 'complete' AS DOUBLE)", "CASE WHEN status = 'complete' THEN 1.0 ELSE 0.0 END").replace("CAST(status = 'failed' AS DOUBLE)", "CASE WHEN status = 'failed' THEN 1.0 ELSE 0.0 END").replace("CAST(status = 'timeout' AS DOUBLE)", "CASE WHEN status = 'timeout' THEN 1.0 ELSE 0.0 END"))
def rate_checks(spark, d):
    return q.rate_checks(rows(spark, d))


_MISSING = "concat_ws('|', " + ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in q.HEADLINE) + ")"


@query(f"SELECT company, CAST({FILLED} AS INT) AS present, {_MISSING} AS missing FROM ({S}) s WHERE {FILLED} < 4 AND company NOT IN (SELECT company FROM ({R}) r WHERE company_id % 5 = 0)")
def missing_field_queue(spark, d):
    r = rows(spark, d)
    return q.missing_field_queue(r, r.where("company_id % 5 = 0"))


_ROUNDS = f"SELECT company_type AS round, count(*) FILTER (status = 'complete') AS complete, count(*) FILTER (status IN ('complete', 'partial')) AS total FROM ({S}) s GROUP BY 1"


@query(f"SELECT round, complete / total AS rate, CASE WHEN complete = total AND coalesce(lag(complete = total) OVER (ORDER BY round), false) THEN true ELSE false END AS stop FROM ({_ROUNDS}) x")
def loop_metrics(spark, d):
    s = q.with_status(rows(spark, d))
    rounds = s.groupBy(F.col("company_type").alias("round")).agg(F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status").isin("complete", "partial")).alias("total"))
    return q.loop_metrics(rounds)


@query(f"""SELECT company, ticker, status, report_url, revenue, ebit, employees, ceo, {_MISSING} AS missing_fields, '{{"revenue":null,"ebit":null,"employees":null}}' AS suggested_override, list_extract(string_split(notes, ' | '), -1) AS latest_note FROM ({S}) s WHERE {FILLED} < 4""")
def review_queue(spark, d):
    return q.review_queue(rows(spark, d))


@query(f"SELECT company, ticker, data_source, confidence, array_to_string(list_slice(string_split(notes, ' | '), greatest(len(string_split(notes, ' | ')) - 9, 1), len(string_split(notes, ' | '))), ' || ') AS last_notes FROM ({S}) s WHERE status = 'partial'")
def partial_report(spark, d):
    return q.partial_report(rows(spark, d))


# --- validation -------------------------------------------------------------------------------------------------------------------

_V1 = f"""SELECT *, CASE WHEN revenue IS NULL THEN 'missing' WHEN revenue <= 0 AND company_type <> 'investment_company' THEN 'non_positive' WHEN revenue > (CASE WHEN company_type = 'bank' THEN 50000000 ELSE 5000000 END) THEN 'too_high'
  WHEN company_type = 'bank' AND revenue > 0 AND revenue < 10000 THEN 'bank_low'
  WHEN company_type = 'industrial' AND revenue < 1000 AND revenue >= 100 AND employees >= 5000 AND revenue / employees < 0.03 AND ebit > 0 AND ebit / revenue >= 0.08 AND ebit / revenue <= 0.45 THEN 'rescaled'
  WHEN company_type = 'industrial' AND revenue < 1000 THEN 'below_floor' ELSE 'ok' END AS revenue_rule,
  CASE WHEN ebit IS NULL THEN 'missing' WHEN abs(ebit) > (CASE WHEN company_type = 'bank' THEN 3000000 ELSE 2000000 END) THEN 'too_large' ELSE 'ok' END AS ebit_rule FROM ({R}) r"""
_V2 = f"""SELECT * EXCLUDE (revenue, ebit), CASE WHEN revenue_rule = 'rescaled' THEN revenue * 1000 WHEN revenue_rule IN ('ok', 'bank_low') THEN revenue END AS revenue, CASE WHEN ebit_rule = 'ok' THEN ebit END AS ebit FROM ({_V1}) v1"""
_V3 = f"""SELECT *, CASE WHEN revenue IS NULL OR ebit IS NULL OR ebit <= revenue THEN 'ok' WHEN company_type = 'real_estate' AND contains(notes, 'EBIT estimated from förvaltningsresultat') AND contains(notes, 'primary operating metric') THEN 'operating_metric'
  WHEN company_type = 'bank' THEN CASE WHEN revenue < 10000 THEN 'bank_low_proxy' WHEN ebit / greatest(revenue, 1) <= 1.3 AND ebit - revenue <= 15000 THEN 'bank_near' ELSE 'bank_mismatch' END
  WHEN company_type = 'real_estate' THEN CASE WHEN ebit / greatest(revenue, 1) <= 3 THEN 'estate_near' ELSE 'estate_far' END ELSE 'above_revenue' END AS ratio_rule,
  CASE WHEN employees IS NULL THEN 'missing' WHEN company_type = 'industrial' AND employees < 100 THEN CASE WHEN employees >= 20 AND {like(v.RELAXED_FLOOR.replace('[s-]', '[ -]'))} THEN 'floor_relaxed' ELSE 'industrial_low' END
  WHEN employees < 50 THEN 'too_low' WHEN employees > 700000 THEN 'too_high' ELSE 'ok' END AS employee_rule,
  CASE WHEN ceo IS NULL THEN 'missing' WHEN len(string_split(trim(ceo), ' ')) < 2 THEN 'one_word' ELSE 'ok' END AS ceo_rule FROM ({_V2}) v2"""
_V4 = f"""SELECT * EXCLUDE (ebit, employees), CASE WHEN ratio_rule IN ('bank_mismatch', 'estate_far', 'above_revenue') THEN NULL ELSE ebit END AS ebit, CASE WHEN employee_rule IN ('ok', 'floor_relaxed') THEN employees END AS employees FROM ({_V3}) v3"""
_SCORE = """CAST(greatest(0, least(100, 100
  - CASE revenue_rule WHEN 'missing' THEN 20 WHEN 'non_positive' THEN 15 WHEN 'too_high' THEN 15 WHEN 'bank_low' THEN 6 WHEN 'rescaled' THEN 8 WHEN 'below_floor' THEN 15 ELSE 0 END
  - CASE ebit_rule WHEN 'missing' THEN 15 WHEN 'too_large' THEN 15 ELSE 0 END
  - CASE ratio_rule WHEN 'operating_metric' THEN 4 WHEN 'bank_low_proxy' THEN 5 WHEN 'bank_near' THEN 5 WHEN 'bank_mismatch' THEN 12 WHEN 'estate_near' THEN 5 WHEN 'estate_far' THEN 15 WHEN 'above_revenue' THEN 15 ELSE 0 END
  - CASE employee_rule WHEN 'missing' THEN 15 WHEN 'floor_relaxed' THEN 8 WHEN 'industrial_low' THEN 15 WHEN 'too_low' THEN 15 WHEN 'too_high' THEN 15 ELSE 0 END
  - CASE ceo_rule WHEN 'missing' THEN 15 WHEN 'one_word' THEN 5 ELSE 0 END
  - CASE WHEN company_type = 'bank' AND revenue IS NOT NULL AND employees IS NOT NULL AND employees < revenue / 50 THEN 5 ELSE 0 END
  - CASE WHEN company_type = 'investment_company' AND (revenue IS NOT NULL OR ebit IS NOT NULL) THEN 8 ELSE 0 END
  - CASE WHEN contains(notes, 'ENTITY WARNING') THEN 25 ELSE 0 END - CASE WHEN contains(notes, 'CONTENT WARNING') THEN 15 ELSE 0 END - CASE WHEN contains(lower(notes), 'fiscal year mismatch') THEN 10 ELSE 0 END)) AS INT)"""


@query(f"SELECT company_id, revenue, ebit, employees, ceo, revenue_rule, ebit_rule, ratio_rule, employee_rule, ceo_rule, {_SCORE} AS confidence_score FROM ({_V4}) v4")
def validate_rows(spark, d):
    out = v.validate(rows(spark, d))
    return out.select("company_id", "revenue", "ebit", "employees", "ceo", "revenue_rule", "ebit_rule", "ratio_rule", "employee_rule", "ceo_rule", "confidence_score")


@query(f"SELECT company_id, CAST(CASE WHEN data_source = 'allabolag' THEN least({_SCORE}, 30) ELSE {_SCORE} END AS INT) AS confidence FROM ({_V4}) v4")
def confidence_cap(spark, d):
    return v.validate(rows(spark, d)).select("company_id", v.confidence_cap().cast("int").alias("confidence"))


_LIMIT = "CASE company_type WHEN 'industrial' THEN 3000000 WHEN 'bank' THEN 80000000 WHEN 'investment_company' THEN 2000000 WHEN 'real_estate' THEN 50000 END"


@query(f"SELECT company_id, CASE WHEN revenue > {_LIMIT} THEN floor(revenue / 1000 + 0.5) ELSE revenue END AS revenue, coalesce(revenue > {_LIMIT}, false) AS adjusted FROM ({R}) r")
def megascale_guard(spark, d):
    return v.megascale_guard(rows(spark, d)).select("company_id", "revenue", "adjusted")


def _fit(n: int) -> str:
    return f"(abs(floor(ebit / {n} + 0.5)) <= abs(revenue) * 1.02 + 1 AND NOT (revenue >= 5000 AND abs(floor(ebit / {n} + 0.5)) > 0 AND abs(floor(ebit / {n} + 0.5)) < 50))"


_DIV = f"""CASE WHEN company_type = 'investment_company' OR revenue IS NULL OR ebit IS NULL OR revenue <= 0 OR ebit <= revenue THEN NULL
  WHEN company_type = 'bank' AND (revenue < 10000 OR (ebit / revenue <= 1.3 AND ebit - revenue <= 15000)) THEN NULL WHEN company_type = 'real_estate' AND ebit / revenue < 1.5 THEN NULL
  WHEN company_type NOT IN ('bank', 'real_estate') AND (ebit / revenue < 1.15 OR ebit - revenue < 1000) THEN NULL
  WHEN company_type = 'industrial' AND ebit / revenue < 2.2 THEN CASE WHEN {_fit(10)} THEN 10 WHEN {_fit(100)} THEN 100 WHEN {_fit(1000)} THEN 1000 END
  ELSE CASE WHEN {_fit(1000)} THEN 1000 WHEN {_fit(100)} THEN 100 WHEN {_fit(10)} THEN 10 END END"""


@query(f"SELECT company_id, CAST(divisor AS INT) AS divisor, CASE WHEN divisor IS NOT NULL THEN floor(ebit / divisor + 0.5) END AS ebit_fixed FROM (SELECT *, {_DIV} AS divisor FROM ({R}) r) x")
def ebit_rescale(spark, d):
    return v.ebit_rescale(rows(spark, d)).select("company_id", "divisor", "ebit_fixed")


@query(f"SELECT company_id, coalesce(company_type <> 'investment_company' AND revenue IS NULL AND ((employees >= 2000 AND abs(ebit) < 500) OR (employees >= 250 AND abs(ebit) < 30)), false) AS discard FROM (SELECT * EXCLUDE (ebit), floor(ebit / 1000) AS ebit FROM ({R.replace('1900000 + r % 2000000', '1000 * (r % 700)')}) r) x")
def orphan_discard(spark, d):
    small = surrogate.frame(spark, d, surrogate.RESULTS.replace("1900000 + r % 2000000", "1000 * (r % 700)")).withColumn("ebit", F.floor(F.col("ebit") / 1000))
    return small.select("company_id", v.orphan_ebit().alias("discard"))


_MERIT = """(CASE WHEN revenue IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN ebit IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN employees IS NOT NULL THEN 4 ELSE 0 END + CASE WHEN ceo IS NOT NULL THEN 4 ELSE 0 END
  + CASE WHEN revenue IS NULL OR ebit IS NULL THEN 0 WHEN company_type = 'bank' THEN CASE WHEN ebit / greatest(revenue, 1) <= 1.35 AND ebit - revenue <= 20000 THEN 14 ELSE 4 END WHEN company_type = 'real_estate' THEN 10
    WHEN ebit <= revenue THEN 14 WHEN ebit * 100 <= revenue * 108 THEN 6 ELSE -8 END)"""
_CAND = f"SELECT *, floor(company_id / 8) AS grp, company_id % 8 AS ord FROM ({R}) r"


@query(f"SELECT company_id, CAST({_MERIT} AS INT) AS merit FROM ({R}) r")
def candidate_merit(spark, d):
    return rows(spark, d).select("company_id", v.merit().alias("merit"))


@query(f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY ord) AS n FROM ({_CAND}) c), p AS (SELECT *, CASE WHEN {FILLED} = 4 THEN 1 ELSE 0 END AS four FROM n WHERE n <= 5),
w AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY four DESC, CASE WHEN four = 1 THEN -n ELSE {_MERIT} END DESC, n) AS place FROM p) SELECT CAST(grp AS BIGINT) AS grp, company_id FROM w WHERE place = 1""")
def candidate_tournament(spark, d):
    cands = rows(spark, d).withColumn("grp", F.floor(F.col("company_id") / 8)).withColumn("ord", F.col("company_id") % 8)
    return v.tournament(cands, "grp").select("grp", "company_id")


@query(f"SELECT company_id, CASE abs(fiscal_year - (2020 + company_id % 7)) WHEN 0 THEN 'match' WHEN 1 THEN 'off_by_one' ELSE CASE WHEN fiscal_year IS NOT NULL THEN 'mismatch' END END AS verdict, CASE WHEN fiscal_year BETWEEN 2022 AND 2026 THEN fiscal_year END AS kept FROM ({R}) r")
def fiscal_year_check(spark, d):
    return rows(spark, d).select("company_id", v.fiscal_year_check((F.lit(2020) + F.col("company_id") % 7), F.col("fiscal_year")).alias("verdict"), v.plausible_year(F.col("fiscal_year"), 2025).alias("kept"))


@query(f"SELECT company_id, status IN ('complete', 'partial') AS cacheable FROM ({S}) s")
def cache_eligible(spark, d):
    return q.with_status(rows(spark, d)).select("company_id", v.cacheable().alias("cacheable"))


# --- risk, second track, adjudication ---------------------------------------------------------------------------------------------

_FLAGS = f"""SELECT *, CASE status WHEN 'failed' THEN 20 WHEN 'partial' THEN 10 WHEN 'timeout' THEN 25 ELSE 0 END AS p1, CASE WHEN fallback_step IN ('playwright', 'search', 'allabolag') THEN 15 ELSE 0 END AS p2,
  CASE WHEN {like(rk.REJECTED.replace('rejected .* candidate', 'rejected [^|]* candidate'))} THEN 15 ELSE 0 END AS p3, CASE WHEN {like(rk.LAYOUT.replace('likely .* misread', 'likely [^|]* misread'))} THEN 10 ELSE 0 END AS p4,
  CASE WHEN contains(lower(notes), 'revenue unit guard') AND contains(lower(notes), 'ebit unit guard') THEN 10 ELSE 0 END AS p5, CASE WHEN contains(lower(notes), 'fiscal year mismatch') THEN 10 ELSE 0 END AS p6, CASE WHEN confidence < 85 THEN 10 ELSE 0 END AS p7,
  CASE company_type WHEN 'investment_company' THEN 10 WHEN 'real_estate' THEN 5 ELSE 0 END AS p8, CASE WHEN {like(rk.ENTITY)} THEN 10 ELSE 0 END AS p9, CASE WHEN {like(rk.TRANSPORT)} THEN 8 ELSE 0 END AS p10 FROM ({S}) s"""
_RISK = f"""SELECT company, ticker, status, confidence, CAST(least(100, p1 + p2 + p3 + p4 + p5 + p6 + p7 + p8 + p9 + p10) AS INT) AS risk_score,
  CAST({' + '.join(f'CASE WHEN p{i} > 0 THEN 1 ELSE 0 END' for i in range(1, 11))} AS INT) AS n_signals,
  concat_ws(',', CASE WHEN p3 > 0 THEN 'ambiguous_pdf_corpus' END, CASE WHEN p10 > 0 THEN 'cloud_transport_risk' END, CASE WHEN p6 > 0 OR p9 > 0 THEN 'entity_ambiguity' END, CASE WHEN p8 > 0 THEN 'industry_semantic_risk' END, CASE WHEN p2 > 0 THEN 'js_heavy_ir' END, CASE WHEN p4 > 0 OR p5 > 0 THEN 'layout_fragile_pdf' END) AS archetypes FROM ({_FLAGS}) f"""


@query(f"""SELECT *, CASE risk_tier WHEN 'low' THEN 'routine' WHEN 'medium' THEN 'periodic_check' ELSE CASE WHEN contains(archetypes, 'js_heavy_ir') OR contains(archetypes, 'cloud_transport_risk') THEN 'cloud_preflight' WHEN contains(archetypes, 'layout_fragile_pdf') THEN 'layout_fixture' ELSE 'full_validation' END END AS action
FROM (SELECT *, CASE WHEN risk_score <= 34 THEN 'low' WHEN risk_score <= 64 THEN 'medium' ELSE 'high' END AS risk_tier, CASE WHEN n_signals >= 5 THEN 'high' WHEN n_signals >= 3 THEN 'medium' ELSE 'low' END AS confidence_band FROM ({_RISK}) k) t""")
def risk_map(spark, d):
    return rk.risk_map(rows(spark, d))


_GAP = "((ebit IS NULL AND revenue IS NOT NULL) OR employees IS NULL OR ceo IS NULL OR (revenue IS NULL AND ebit IS NOT NULL))"


@query(f"""SELECT *, reason IN ('forced', 'hard_list', 'gap') AS run FROM (SELECT company_id, company, status, CASE WHEN status = 'timeout' THEN 'timeout' WHEN company_type = 'investment_company' THEN 'investment' WHEN company_id % 40 = 2 THEN 'hard_list' WHEN NOT has_data THEN 'no_data' WHEN status NOT IN ('partial', 'failed') THEN 'status'
  WHEN confidence IS NULL OR confidence < 80 THEN 'confidence' WHEN {like(rk.WRONG_DOCUMENT)} THEN 'wrong_document' WHEN {like(rk.CORRUPTION)} THEN 'corruption' WHEN {_GAP} THEN 'gap' ELSE 'no_gap' END AS reason FROM ({S}) s) x""")
def second_track_gate(spark, d):
    r = rows(spark, d)
    return rk.second_track(r, r.where("company_id % 40 = 2"))


_TRACKS = f"""SELECT company_id, CASE company_id % 3 WHEN 0 THEN 'revenue' WHEN 1 THEN 'ebit' ELSE 'employees' END AS field,
  CASE WHEN company_id % 7 = 0 THEN NULL ELSE employees END AS det, CASE WHEN company_id % 5 = 0 THEN NULL ELSE employees + CASE company_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN floor(employees / 100) ELSE employees END END AS llm,
  company_id % 6 <> 0 AS quoted, company_id % 11 <> 0 AS det_ok, company_id % 13 <> 0 AS llm_ok, CAST(company_id % 90 AS INT) AS quote_len, CAST(company_id % 35 AS INT) AS snippet_len FROM ({surrogate.RESULTS}) r"""
_TR = surrogate.text(_TRACKS)


@query(f"""WITH t AS (SELECT *, CASE WHEN quoted THEN llm END AS l FROM ({_TR}) x), e AS (SELECT *, det IS NOT NULL AND l IS NOT NULL AND abs(det - l) * 1000 <= CASE field WHEN 'ebit' THEN 10 WHEN 'revenue' THEN 5 ELSE 0 END * greatest(abs(det), abs(l)) AS same FROM t),
c AS (SELECT *, CASE WHEN same THEN CASE WHEN det_ok THEN 1 WHEN llm_ok THEN 2 ELSE 3 END WHEN det IS NOT NULL AND l IS NOT NULL THEN CASE WHEN llm_ok AND quote_len >= 48 AND NOT (det_ok AND snippet_len >= 20) THEN 4 WHEN det_ok AND snippet_len >= 20 AND NOT (llm_ok AND quote_len >= 48) THEN 5 ELSE 6 END
  WHEN det IS NOT NULL AND det_ok THEN 8 WHEN det IS NULL AND l IS NOT NULL AND llm_ok THEN 9 ELSE 11 END AS case_no FROM e),
o AS (SELECT *, CASE WHEN case_no IN (1, 5, 8) THEN 'accept_det' WHEN case_no IN (2, 4, 9) THEN 'accept_llm' WHEN case_no = 11 AND det IS NULL AND l IS NULL THEN 'failed' ELSE 'review' END AS outcome FROM c)
SELECT company_id, field, CAST(case_no AS INT) AS case_no, outcome, CASE outcome WHEN 'accept_det' THEN det WHEN 'accept_llm' THEN l END AS value FROM o""")
def adjudicate(spark, d):
    return adj.adjudicate(surrogate.frame(spark, d, _TRACKS)).select("company_id", "field", "case_no", "outcome", "value")
