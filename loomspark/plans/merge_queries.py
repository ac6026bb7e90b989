"""Upserts, diffs, set operations, lookups and circuit breakers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import texts
from loomspark.operators import merge as m
from loomspark.operators import quality as q
from loomspark.plans import surrogate
from loomspark.plans.registry import query
from loomspark.plans.result_queries import STATUS, R

OLD, NEW = surrogate.text(surrogate.STORED), surrogate.text(surrogate.FRESH)
C = surrogate.text(surrogate.CANDIDATES)
FIELDS = ("revenue", "ebit", "employees", "ceo")


def stored(spark: SparkSession, d: str) -> DataFrame:
    return surrogate.frame(spark, d, surrogate.STORED)


def fresh(spark: SparkSession, d: str) -> DataFrame:
    return surrogate.frame(spark, d, surrogate.FRESH)


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return surrogate.frame(spark, d, surrogate.CANDIDATES)


_COLS = ("company", "ticker", "revenue", "ebit", "employees", "ceo", "confidence", "ord")


def _upsert(key: str, where: str = "") -> str:
    picked = ", ".join(f"CASE WHEN n.ord IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in _COLS)
    return f"""WITH o AS (SELECT *, {key} AS k FROM ({OLD}) o0 {where}), n AS (SELECT *, {key} AS k FROM ({NEW}) n0 {where})
SELECT {picked}, CASE WHEN n.ord IS NULL THEN 'kept' WHEN o.ord IS NULL THEN 'added' ELSE 'replaced' END AS change FROM o FULL OUTER JOIN n ON o.k = n.k"""


@query(_upsert("lower(company)"))
def upsert_results(spark, d):
    return m.upsert(stored(spark, d), fresh(spark, d))


@query(_upsert("ticker", "WHERE ticker IS NOT NULL"))
def upsert_by_ticker(spark, d):
    return m.upsert(stored(spark, d), fresh(spark, d), key="ticker", fold=False, drop_null_keys=True)


@query(f"SELECT o.company, {', '.join(f'coalesce(o.{f}, n.{f}) AS {f}' for f in FIELDS)} FROM ({OLD}) o LEFT JOIN ({NEW}) n ON o.ord = n.ord")
def null_fill_merge(spark, d):
    return m.prefer_base(stored(spark, d), fresh(spark, d), "ord").select("company", *FIELDS)


@query(f"SELECT o.company, {', '.join(f'CASE WHEN n.ord IS NOT NULL AND n.ord % {i} = 1 THEN n.{f} ELSE o.{f} END AS {f}' for i, f in enumerate(FIELDS, 2))} FROM ({OLD}) o LEFT JOIN ({NEW}) n ON o.ord = n.ord")
def manual_overrides(spark, d):
    overrides = fresh(spark, d).select("ord", *FIELDS, *((F.col("ord") % i == 1).alias(f"has_{f}") for i, f in enumerate(FIELDS, 2)))
    return m.apply_overrides(stored(spark, d), overrides, "ord").select("company", *FIELDS)


_BASE = f"SELECT *, {STATUS} AS status FROM ({R}) r"
_NEXT = f"SELECT * EXCLUDE (employees, ceo), CASE WHEN company_id % 5 = 1 THEN NULL ELSE employees END AS employees, CASE WHEN company_id % 7 = 2 THEN NULL ELSE ceo END AS ceo, CASE WHEN company_id % 11 = 3 THEN 'partial' ELSE status END AS status2 FROM ({_BASE}) b WHERE company_id % 9 <> 4"


@query(f"""WITH j AS (SELECT lower(coalesce(b.ticker, b.company)) AS key, n.status2, n.employees IS NULL AND b.employees IS NOT NULL AS e, n.ceo IS NULL AND b.ceo IS NOT NULL AS c FROM ({_BASE}) b JOIN ({_NEXT}) n ON b.company_id = n.company_id WHERE b.status = 'complete')
SELECT key, 'status' AS regression FROM j WHERE status2 <> 'complete' UNION ALL SELECT key, 'employees' FROM j WHERE status2 = 'complete' AND e UNION ALL SELECT key, 'ceo' FROM j WHERE status2 = 'complete' AND c""")
def canary_diff(spark, d):
    base = q.with_status(surrogate.frame(spark, d, surrogate.RESULTS))
    i = F.col("company_id")
    changed = {"employees": F.when(i % 5 != 1, F.col("employees")), "ceo": F.when(i % 7 != 2, F.col("ceo")), "status": F.when(i % 11 == 3, "partial").otherwise(F.col("status"))}
    return m.canary_diff(base, base.where("company_id % 9 <> 4").withColumns(changed))


@query(f"SELECT host_no, min(ord) AS ord FROM ({C}) c GROUP BY 1")
def dedupe_first(spark, d):
    return m.dedupe_first(candidates(spark, d), ["host_no"], ["ord"]).select("host_no", "ord")


@query(f"SELECT company_id, url, score, ord FROM (SELECT *, row_number() OVER (PARTITION BY company_id, url ORDER BY score DESC, ord) AS n FROM ({C}) c) x WHERE n = 1")
def dedupe_max_score(spark, d):
    return m.dedupe_max(candidates(spark, d), ["company_id", "url"], "score", "ord").select("company_id", "url", "score", "ord")


@query(f"SELECT url, ord, part FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY part, ord) AS n FROM (SELECT url, ord, CASE WHEN score >= 25 THEN 0 ELSE 1 END AS part FROM ({C}) c) y) x WHERE n = 1")
def union_first(spark, d):
    c = candidates(spark, d).withColumn("part", F.when(F.col("score") >= 25, 0).otherwise(1)).select("url", "ord", "part")
    return m.union_first([c.where("part = 0"), c.where("part = 1")], ["url"], "ord")


@query(f"SELECT DISTINCT url FROM ({C}) c WHERE score < 10 AND url NOT IN (SELECT url FROM ({C}) k WHERE score >= 50 AND company_id < 40)")
def anti_known(spark, d):
    c = candidates(spark, d)
    return m.except_known(c.where("score < 10"), c.where("score >= 50 AND company_id < 40"), "url").select("url").distinct()


@query(f"SELECT company_id, host, ord FROM (SELECT company_id, host, ord, row_number() OVER (PARTITION BY company_id, host ORDER BY trust, ord) AS n FROM (SELECT company_id, ord, score % 4 AS trust, regexp_replace(lower(regexp_extract(url, '://([^/]*)', 1)), '^www\\.', '') AS host FROM ({C}) c) y) x WHERE n = 1")
def domain_order(spark, d):
    c = candidates(spark, d).withColumn("host", texts.host_key(F.col("url"))).withColumn("trust", F.col("score") % 4)
    return m.dedupe_first(c, ["company_id", "host"], ["trust", "ord"]).select("company_id", "host", "ord")


_REG = f"SELECT CASE company_id % 3 WHEN 0 THEN CAST(company_id AS STRING) WHEN 1 THEN concat('t', CAST(company_id AS STRING), '.st') ELSE concat('T', CAST(company_id AS STRING), '.ST') END AS key, company_id AS entry FROM ({surrogate.RESULTS}) r WHERE company_id % 4 <> 0"


@query(f"""WITH reg AS ({surrogate.text(_REG)}), t AS (SELECT company_id AS id, concat('T', CAST(company_id AS VARCHAR), '.ST') AS raw FROM ({R}) r),
v AS (SELECT id, 0 AS rank, raw AS k FROM t UNION ALL SELECT id, 1, lower(raw) FROM t UNION ALL SELECT id, 2, regexp_replace(raw, '[^0-9]', '', 'g') FROM t)
SELECT t.id, raw, h.k AS variant, h.entry FROM t LEFT JOIN (SELECT id, k, entry FROM (SELECT v.id, v.k, reg.entry, row_number() OVER (PARTITION BY v.id ORDER BY rank) AS n FROM v JOIN reg ON v.k = reg.key) x WHERE n = 1) h ON t.id = h.id""")
def registry_lookup(spark, d):
    reg = surrogate.frame(spark, d, _REG)
    t = surrogate.frame(spark, d, surrogate.RESULTS).select(F.col("company_id").alias("id"), F.concat(F.lit("T"), F.col("company_id").cast("string"), F.lit(".ST")).alias("raw"))
    return m.lookup_with_fallback(t, reg, [F.col("raw"), F.lower("raw"), F.regexp_replace("raw", "[^0-9]", "")])


_F = surrogate.text(surrogate.FETCHES)


@query(f"""WITH f AS (SELECT *, row_number() OVER w AS n, sum(CASE WHEN status >= 400 THEN 1 ELSE 0 END) OVER b AS before FROM ({_F}) x WINDOW w AS (PARTITION BY company_id, host ORDER BY ord), b AS (PARTITION BY company_id, host ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, n - 1 - coalesce(max(CASE WHEN status NOT IN (403, 404) THEN n END) OVER (PARTITION BY company_id, host ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS streak FROM f)
SELECT company_id, host, ord, CAST(status AS INT) AS status, CAST(coalesce(before, 0) AS BIGINT) AS failures_before, CAST(streak AS INT) AS streak_before, coalesce(before, 0) >= 3 OR streak >= 2 AS skipped FROM s""")
def circuit_breaker(spark, d):
    return m.running_failures(surrogate.frame(spark, d, surrogate.FETCHES))


@query(f"SELECT host, event_type, count(*) AS n, count(*) FILTER (duration_ms > 5000) AS over_budget FROM ({_F}) f GROUP BY 1, 2")
def stage_budget(spark, d):
    return surrogate.frame(spark, d, surrogate.FETCHES).groupBy("host", "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("duration_ms") > 5000).alias("over_budget"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1")
def json_props(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k"))


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) x GROUP BY 1")
def variant_walk(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select(F.try_parse_json("props").alias("v"))
    walked = e.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("key")))
    return walked.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    """Spark-native extension: the same plan runs on a stream with a watermark."""
    from loomspark.streaming import logs

    e = spark.read.parquet(f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return logs.windowed_counts(e)
