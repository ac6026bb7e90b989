"""Public rows, rows of failed runs, rejection notes, budgets, gates, and answers of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.operators import answers as an
from loomspark.operators import rows as ro
from loomspark.plans import surrogate
from loomspark.plans.registry import query
from loomspark.plans.result_queries import R, rows


@query(f"SELECT company_id, company, CASE WHEN confidence IS NULL THEN 'null' ELSE 'set' END AS confidence, CAST(17 + CASE WHEN company_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS n_keys, false AS has_stages, company_id % 3 = 0 AS adjudicated, CASE WHEN company_id % 3 = 0 THEN 'ran' END AS verdict FROM ({R}) r")
def public_rows(spark, d):
    """The outside's JSON, read back key by key."""
    r = rows(spark, d).withColumns({"stages": F.struct(F.lit("failed").alias("download")), "dualTrackAdjudication": F.when(F.col("company_id") % 3 == 0, F.struct(F.lit("ran").alias("state")))})
    j = r.select("company_id", ro.public_json(r).alias("j"))
    keys = F.json_object_keys("j")
    at = F.try_variant_get(F.parse_json("j"), "$.confidence", "int")
    return j.select(
        "company_id",
        F.get_json_object("j", "$.company").alias("company"),
        F.when(at.isNull(), "null").otherwise("set").alias("confidence"),
        F.size(keys).alias("n_keys"),
        F.array_contains(keys, "stages").alias("has_stages"),
        F.array_contains(keys, "dualTrackAdjudication").alias("adjudicated"),
        F.get_json_object("j", "$.dualTrackAdjudication.state").alias("verdict"),
    )


_FETCHED = surrogate.text(surrogate.FETCHES)


def _ended(df):
    return df.select("company", "ticker", "confidence", "status", F.col("fallbackStepReached").alias("step"), F.get("extractionNotes", F.lit(0)).alias("note"), F.col("sustainability.note").alias("sustainability"), F.col("stages.download.status").alias("stage"), F.col("stages.validation.error").alias("error"))


@query(f"""SELECT company, ticker, CASE WHEN company_id % 2 = 0 THEN 0 END AS confidence, CASE WHEN company_id % 2 = 0 THEN 'timeout' ELSE 'failed' END AS status, 'none' AS step, CASE WHEN company_id % 2 = 0 THEN concat('Pipeline timed out after ', 200000 + company_id, 'ms') ELSE concat('boom ', company_id) END AS note,
CASE WHEN company_id % 2 = 0 THEN 'Pipeline timed out' ELSE 'Pipeline failed' END AS sustainability, CASE WHEN company_id % 2 = 0 THEN 'skipped' ELSE 'failed' END AS stage, CASE WHEN company_id % 2 = 0 THEN 'Skipped because a prior stage did not succeed' ELSE concat('boom ', company_id) END AS error FROM ({R}) r""")
def ended_rows(spark, d):
    r = rows(spark, d).select("company_id", F.col("company").alias("name"), "ticker", F.lit(None).cast("string").alias("website"))
    late = ro.timeout_rows(r.where("company_id % 2 = 0"), F.lit(200_000) + F.col("company_id"))
    return _ended(late.unionByName(ro.failed_rows(r.where("company_id % 2 <> 0"), F.concat(F.lit("boom "), F.col("company_id").cast("string")))))


@query(f"SELECT company, CASE WHEN company_id * 37 % 400 > 210 THEN 'timeout' ELSE 'kept' END AS status FROM ({R}) r")
def child_timeouts(spark, d):
    """Runs over the limit become timeout rows."""
    r = rows(spark, d).select(F.col("company").alias("name"), "ticker", F.lit(None).cast("string").alias("website"), F.lit('{"status":"kept"}').alias("json"), (F.col("company_id") * 37 % 400).alias("ms"))
    return ro.with_timeouts(r, "ms", 210).select("company", F.get_json_object("json", "$.status").alias("status"))


@query(f"SELECT company_id, event_type AS stage, duration_ms, CASE event_type WHEN 'view' THEN 3000 WHEN 'click' THEN 5000 END AS budget_ms, concat('Stage budget exhausted for ', event_type) AS note FROM ({_FETCHED}) f WHERE duration_ms > CASE event_type WHEN 'view' THEN 3000 WHEN 'click' THEN 5000 END")
def stage_budgets(spark, d):
    runs = surrogate.frame(spark, d, surrogate.FETCHES).select("company_id", F.col("event_type").alias("stage"), "duration_ms")
    return ro.over_budget(runs, {"view": 3000, "click": 5000})


_REASONS = "CASE l_partkey % 4 WHEN 0 THEN 'quality-gate' WHEN 1 THEN 'entity-check' WHEN 2 THEN 'download' ELSE 'bank-employees' END"


@query(f"SELECT company_id, step, concat(step, ': rejection summary (', string_agg(concat(reason, '=', n), ', ' ORDER BY reason), ')') AS note FROM (SELECT l_orderkey AS company_id, CASE l_linenumber % 2 WHEN 0 THEN 'Primary' ELSE 'Search' END AS step, {_REASONS} AS reason, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) x GROUP BY 1, 2")
def rejection_notes(spark, d):
    l = spark.read.parquet(f"{d}/lineitem.parquet")  # noqa: E741
    step = F.when(F.col("l_linenumber") % 2 == 0, "Primary").otherwise("Search")
    return ro.rejection_notes(l.select(F.col("l_orderkey").alias("company_id"), step.alias("step"), F.expr(_REASONS).alias("reason")))


@query(f"SELECT company_id, ebit IS NULL AND revenue IS NOT NULL AND regexp_matches(lower(notes), 'discarding ebit|semantic mismatch|assignment safety|exceeds revenue') AS ebit_repair, employees IS NULL OR ceo IS NULL AS people_repair, regexp_matches(notes, '\\b403\\b|\\b404\\b|status code 40[34]') AS forbidden FROM ({R}) r")
def narrow_repairs(spark, d):
    ebit, people = ro.narrow_repairs(F.col("ebit"), F.col("revenue"), F.col("employees"), F.col("ceo"), F.col("notes"))
    return rows(spark, d).select("company_id", ebit.alias("ebit_repair"), people.alias("people_repair"), ro.forbidden_or_missing(F.col("notes")).alias("forbidden"))


@query(f"SELECT company_id, company_id % 4 = 0 AS ran, CASE WHEN company_id % 4 <> 0 THEN 'gated' END AS skip, CASE WHEN company_id % 4 = 0 THEN 'no answer' END AS error, 'failed' AS status, 'LLM challenger not run' AS reason FROM ({R}) r")
def track_not_run(spark, d):
    error = F.when(F.col("company_id") % 4 == 0, "no answer")
    a = rows(spark, d).select("company_id", ro.not_run(F.lit("gated"), error).alias("a"))
    return a.select("company_id", F.col("a.ranLlm").alias("ran"), F.col("a.skipReason").alias("skip"), F.col("a.llmError").alias("error"), F.col("a.fields.ceo.status").alias("status"), F.col("a.fields.ebit_msek.reason").alias("reason"))


_CHECKS = "SELECT event_type AS name, CAST(rank() OVER (ORDER BY event_type) AS INT) AS ord, count(*) % 3 <> 0 AS available, max(event_id) % 2 = 0 AS ok FROM events GROUP BY event_type"


@query(f"SELECT count(*) FILTER (available AND NOT ok) = 0 AS passed, min_by(name, ord) FILTER (available AND NOT ok) AS failed_check, count(*) FILTER (NOT available) AS skipped FROM ({_CHECKS}) c")
def promotion_gate(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    checks = e.groupBy(F.col("event_type").alias("name")).agg((F.count(F.lit(1)) % 3 != 0).alias("available"), (F.max("event_id") % 2 == 0).alias("ok"))
    return ro.promotion_gate(checks.withColumn("ord", F.col("name")))


_ANSWERS = """SELECT c_custkey AS doc_id, CASE c_custkey % 7 WHEN 0 THEN 'no json' WHEN 1 THEN 'null' ELSE translate(concat('<"revenue_msek": <"value": ', CASE c_custkey % 5 WHEN 0 THEN '"12"' WHEN 1 THEN 'null' WHEN 2 THEN 'true' ELSE concat(CAST(c_custkey AS STRING), '.5') END, ', "page": ', CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '3.7' WHEN 2 THEN '"4"' ELSE '12' END,
 ', "source_quote": ', CASE c_custkey % 3 WHEN 0 THEN '7' ELSE '"net sales"' END, ', "normalization": ["a", 1, "b"]>, "ceo": ', CASE c_custkey % 3 WHEN 0 THEN '"text"' WHEN 1 THEN '<"value": "Ann Lee", "unit_stated": "x">' ELSE '<"value": <"a": 1>, "normalization": "none">' END, '>'), '<>', concat(chr(123), chr(125))) END AS answer FROM {customer}"""


@query(f"""WITH a AS (SELECT doc_id FROM ({surrogate.text(_ANSWERS).replace('AS STRING', 'AS VARCHAR')}) x WHERE answer NOT IN ('no json', 'null'))
SELECT doc_id, 'revenue_msek' AS field, CAST(CASE WHEN doc_id % 5 IN (3, 4) THEN doc_id + 0.5 END AS DOUBLE) AS value_num, CASE WHEN doc_id % 5 = 0 THEN '12' END AS value_str, CASE doc_id % 4 WHEN 1 THEN 3 WHEN 3 THEN 12 END AS page, CASE WHEN doc_id % 3 <> 0 THEN 'net sales' END AS source_quote, NULL AS unit_stated, 'a,b' AS normalization FROM a
UNION ALL SELECT doc_id, 'ceo', NULL, CASE WHEN doc_id % 3 = 1 THEN 'Ann Lee' END, NULL, NULL, CASE WHEN doc_id % 3 = 1 THEN 'x' END, '' FROM a UNION ALL SELECT doc_id, f, NULL, NULL, NULL, NULL, NULL, '' FROM a, (SELECT unnest(['ebit_msek', 'employees', 'fiscal_year']) AS f) y""")
def model_answers(spark, d):
    """Tolerant reading: wrong types become null, what is no JSON gives nothing."""
    parsed = an.parse_answers(surrogate.frame(spark, d, _ANSWERS))
    return parsed.select("doc_id", "field", "value_num", "value_str", "page", "source_quote", "unit_stated", F.array_join("normalization", ",").alias("normalization"))


@query("SELECT doc_id, contains(p, concat('Company: D', doc_id)) AS named, length(p) - 0 > 0 AS asked, CAST(least(length(coalesce(text, '')), 72000) AS INT) AS n_text FROM (SELECT doc_id, text, concat('Company: D', doc_id) AS p FROM documents) x")
def model_prompts(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    p = an.prompt(F.concat(F.lit("D"), F.col("doc_id").cast("string")), an.FIELDS, F.col("text"))
    head = F.instr(p, "\nDocument:\n") + 10
    return docs.select("doc_id", p.startswith(F.concat(F.lit("Company: D"), F.col("doc_id").cast("string"))).alias("named"), (p.contains("fiscal_year") & p.contains("word for word")).alias("asked"), (F.length(p) - head).cast("int").alias("n_text"))
