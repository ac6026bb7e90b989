"""Scores and order of candidates and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import texts
from loomspark.operators import rank as r
from loomspark.operators import risk
from loomspark.plans import rank_sql as q
from loomspark.plans import surrogate
from loomspark.plans.merge_queries import C, candidates
from loomspark.plans.rank_sql import sql_match, sql_sum
from loomspark.plans.registry import query

YEAR = 2025


def sql_year(text: str) -> str:
    return f"list_max(list_transform(regexp_extract_all({text}, '\\b((?:19|20)[0-9]{{2}})\\b', 1), lambda y: CAST(y AS INT)))"


def sql_year_points(text: str) -> str:
    y = sql_year(text)
    return f"(CASE WHEN {y} IS NULL THEN 0 WHEN {y} IN ({YEAR - 1}, {YEAR}) THEN 50 WHEN {y} = {YEAR - 2} THEN 20 WHEN {YEAR - 1} - {y} > 2 THEN -30 ELSE 0 END)"


_BOTH = "lower(concat(text, ' ', url))"
_LONE = "CASE WHEN " + sql_match("text", "sustainability|hållbarhet") + " AND NOT " + sql_match("text", "annual|årsredovisning") + " THEN -5 ELSE 0 END"
_SCORE = f"({sql_sum('text', q.LINK_TEXT)} + {sql_sum(_BOTH, q.LINK_BOTH)} + {_LONE} + {sql_year_points('text')} + {sql_sum('lower(url)', q.ADDRESS)} + {sql_year_points('url')})"
_CLASS = f"CASE WHEN {sql_match('concat(text, chr(32), url)', q.ANNUAL_CLASS)} THEN 'annual_like' WHEN {sql_match('concat(text, chr(32), url)', q.OTHER_CLASS)} THEN 'non_annual_like' ELSE 'unknown' END"
_STALE = f"coalesce({sql_year('concat(url, chr(32), text)').replace('list_max', 'list_min')} < {YEAR - 2}, false)"


@query(f"SELECT company_id, ord, CAST({_SCORE} AS INT) AS points FROM ({C}) c")
def rule_points(spark, d):
    return candidates(spark, d).select("company_id", "ord", r.link_score(F.col("text"), F.col("url"), YEAR).alias("points"))


_T = surrogate.text(surrogate.TITLES)


@query(f"SELECT p_partkey, CAST({_SCORE} + CASE WHEN {sql_match('heading', 'annual[[:space:]]*report|årsredovisning')} THEN 3 ELSE 0 END AS INT) AS points, {_CLASS} AS class FROM ({_T}) t")
def title_points(spark, d):
    """Titles of every rule of the table, in text and address, below headings."""
    t = surrogate.frame(spark, d, surrogate.TITLES)
    return t.select("p_partkey", r.link_score(F.col("text"), F.col("url"), YEAR, F.col("heading")).alias("points"), r.report_class(F.col("text"), F.col("url")).alias("class"))


_SHORT = r"""SELECT *, list_transform(list_concat(regexp_extract_all(hay, '\b[0-9]{2}[-_]([0-9]{2})\b', 1), list_transform(list_filter(regexp_extract_all(hay, '\b([0-9]{4})\b', 1), lambda x: NOT starts_with(x, '20') AND CAST(x[3:4] AS INT) = (CAST(x[1:2] AS INT) + 1) % 100), lambda x: x[3:4])),
  lambda e: CASE WHEN 2000 + CAST(e AS INT) > 2026 THEN 1900 + CAST(e AS INT) ELSE 2000 + CAST(e AS INT) END) AS ends, list_transform(regexp_extract_all(hay, '\b((?:19|20)[0-9]{2})\b', 1), lambda y: CAST(y AS INT)) AS years FROM"""


@query(f"SELECT p_partkey, CASE WHEN len(years) > 0 THEN list_min(years) < 2023 ELSE coalesce(list_min(ends) < 2023, false) END AS stale FROM ({_SHORT} (SELECT p_partkey, concat(url, ' ', text) AS hay FROM ({surrogate.text(surrogate.RANGES)}) t) h) x")
def stale_ranges(spark, d):
    """Four-digit years, and ranges of two-digit ones where there are none."""
    t = surrogate.frame(spark, d, surrogate.RANGES)
    return t.select("p_partkey", r.stale(F.col("url"), F.col("text"), YEAR).alias("stale"))


@query(f"SELECT company_id, ord FROM ({C}) c WHERE NOT {_STALE}")
def stale_filter(spark, d):
    return candidates(spark, d).where(~r.stale(F.col("url"), F.col("text"), YEAR)).select("company_id", "ord")


@query(f"""WITH k AS (SELECT *, {_CLASS} AS class FROM ({C}) c), a AS (SELECT *, max(CASE WHEN class = 'annual_like' THEN 1 ELSE 0 END) OVER (PARTITION BY company_id) AS any_annual FROM k),
p AS (SELECT *, class = 'annual_like' OR any_annual = 0 AS pool FROM a)
SELECT company_id, ord, class, CAST(row_number() OVER (PARTITION BY company_id ORDER BY CASE WHEN pool THEN 0 ELSE 1 END, score DESC, CASE WHEN pool AND regexp_matches(lower(url), '\\.pdf(\\?|$)') THEN 0 ELSE CASE WHEN pool THEN 1 ELSE 0 END END, ord) AS INT) AS rank FROM p""")
def rank_class_first(spark, d):
    return r.rank_class_first(candidates(spark, d)).select("company_id", "ord", "class", "rank")


@query(f"""WITH n AS (SELECT company_id, score, row_number() OVER (PARTITION BY company_id ORDER BY score DESC) AS n FROM ({C}) c), t AS (SELECT company_id, max(CASE WHEN n = 1 THEN score END) AS top, max(CASE WHEN n = 2 THEN score END) AS second FROM n GROUP BY 1)
SELECT company_id, top, second, CASE WHEN top < 8 THEN 'low' WHEN second IS NOT NULL AND top - second <= 3 THEN 'medium' ELSE 'high' END AS level FROM t""")
def top_gap_confidence(spark, d):
    return r.top_confidence(candidates(spark, d))


_HOST = "regexp_replace(lower(regexp_extract(url, '://([^/]*)', 1)), '^www\\.', '')"


@query(f"""SELECT company_id, ord, CAST(CASE WHEN company_id % 3 = 0 THEN CASE WHEN contains(host, 'ir3.example') THEN 8 ELSE -22 END WHEN contains(host, 'ir3.example') THEN 4 ELSE 0 END + CASE WHEN company_id % 4 = 0 THEN 5 ELSE 0 END AS INT) AS adjustment FROM (SELECT *, {_HOST} AS host FROM ({C}) c) x""")
def entity_adjust(spark, d):
    c = candidates(spark, d).withColumn("url", F.when(F.col("company_id") % 4 == 0, F.concat("url", F.lit("?org=55601234"))).otherwise(F.col("url")))
    level = F.when(F.col("company_id") % 3 == 0, "high").otherwise("low")
    adjustment = r.entity_adjustment(texts.host_key(F.col("url")), F.array(F.lit("ir3.example"), F.lit("abc")), level, F.col("url"), F.lit("5560-1234"))
    return c.select("company_id", "ord", adjustment.alias("adjustment"))


@query(f"SELECT company_id, ord FROM (SELECT *, {_HOST} AS host FROM ({C}) c) x WHERE NOT (company_id % 2 = 0 AND contains(host, 'ir4.')) AND NOT (company_id % 5 = 0 AND contains(host, 'ir7.'))")
def host_collisions(spark, d):
    rules = spark.createDataFrame([("^even", "ir4."), ("five$", "ir7.")], "name_pattern string, host_part string")
    name = F.concat(F.when(F.col("company_id") % 2 == 0, "even").otherwise("odd"), F.when(F.col("company_id") % 5 == 0, " five").otherwise(" other"))
    c = candidates(spark, d).withColumn("company", name)
    return r.reject_collisions(c, rules, texts.host_key(F.col("url"))).select("company_id", "ord")


@query(f"SELECT company_id, ord, CAST(rank AS INT) AS rank FROM (SELECT company_id, ord, row_number() OVER (PARTITION BY company_id ORDER BY score DESC, ord) AS rank FROM ({C}) c) x WHERE rank <= 5")
def top_candidates(spark, d):
    return r.top_n(candidates(spark, d), 5).select("company_id", "ord", "rank")


@query(f"SELECT company_id, max({sql_year('concat(text, chr(32), url)')}) AS year FROM ({C}) c GROUP BY 1")
def discovery_year(spark, d):
    return candidates(spark, d).groupBy("company_id").agg(F.max(r.latest_year(F.concat_ws(" ", "text", "url"))).alias("year"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/pages.parquet")


_LINKS = """SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS text FROM pages"""


@query(f"SELECT page_id, href, trim(regexp_replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM ({_LINKS}) l")
def link_scan(spark, d):
    return r.links(pages(spark, d)).select("page_id", "href", "text")


@query(f"SELECT page_id, href, CAST({_SCORE.replace('url', 'href')} AS INT) AS points FROM ({_LINKS}) l")
def link_score(spark, d):
    return r.links(pages(spark, d)).select("page_id", "href", r.link_score(F.col("text"), F.col("href"), YEAR).alias("points"))


_SIGNALS = """SELECT page_id, url, CAST(len(regexp_extract_all(hay, '\\.pdf(\\?|")')) AS INT) AS pdf_links, CAST(len(regexp_extract_all(hay, '<script[\\s>]')) AS INT) AS scripts, CAST(len(regexp_extract_all(hay, '<a[\\s>]')) AS INT) AS anchors,
  CAST(CASE WHEN contains(hay, 'annual report') THEN 1 ELSE 0 END + CASE WHEN contains(hay, 'årsredovisning') THEN 1 ELSE 0 END + CASE WHEN contains(hay, 'financial reports') THEN 1 ELSE 0 END + CASE WHEN contains(hay, 'investors') THEN 1 ELSE 0 END + CASE WHEN contains(hay, 'reports') THEN 1 ELSE 0 END AS INT) AS annual_words,
  regexp_matches(hay, 'access denied|forbidden|captcha|cloudflare|bot') AS challenged FROM (SELECT page_id, url, lower(substring(coalesce(html, ''), 1, 400000)) AS hay FROM pages) p"""


@query(f"SELECT page_id, pdf_links, scripts, anchors, annual_words, challenged FROM ({_SIGNALS}) s")
def page_signals(spark, d):
    return risk.page_signals(pages(spark, d)).select("page_id", "pdf_links", "scripts", "anchors", "annual_words", "challenged")


@query(f"""WITH c AS (SELECT *, CASE page_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 404 ELSE 200 END AS code, page_id % 9000 AS ms, page_id % 4 = 0 AS drift FROM ({_SIGNALS}) s),
f AS (SELECT *, CASE WHEN code IS NULL OR code >= 400 THEN 25 ELSE 0 END AS a, CASE WHEN ms > 5000 THEN 8 ELSE 0 END AS b, CASE WHEN annual_words = 0 THEN 15 ELSE 0 END AS e, CASE WHEN pdf_links = 0 THEN 10 ELSE 0 END AS g, CASE WHEN drift THEN 15 ELSE 0 END AS h, CASE WHEN scripts >= 8 AND anchors <= 12 THEN 15 ELSE 0 END AS i, CASE WHEN challenged THEN 10 ELSE 0 END AS j FROM c)
SELECT page_id, CAST(least(100, a + b + e + g + h + i + j) AS INT) AS risk_score, CASE WHEN a + b + e + g + h + i + j <= 34 THEN 'low' WHEN a + b + e + g + h + i + j <= 64 THEN 'medium' ELSE 'high' END AS risk_tier,
concat_ws(',', CASE WHEN e > 0 OR g > 0 THEN 'ambiguous_pdf_corpus' END, CASE WHEN a > 0 OR b > 0 OR j > 0 THEN 'cloud_transport_risk' END, CASE WHEN h > 0 THEN 'entity_ambiguity' END, CASE WHEN i > 0 THEN 'js_heavy_ir' END) AS archetypes FROM f""")
def preflight_risk(spark, d):
    i = F.col("page_id")
    checks = risk.page_signals(pages(spark, d)).withColumns({"status_code": F.when(i % 6 == 1, 404).when(i % 6 != 0, 200), "response_ms": i % 9000, "host_drift": i % 4 == 0})
    return risk.preflight_risk(checks).select("page_id", "risk_score", "risk_tier", F.array_join("archetypes", ",").alias("archetypes"))


@query("SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages")
def title_scan(spark, d):
    return pages(spark, d).select("page_id", F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"))


@query("SELECT regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') AS host, count(*) AS n, count(DISTINCT url) AS urls FROM pages GROUP BY 1")
def hosts(spark, d):
    return pages(spark, d).groupBy(texts.host_key(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"))
