"""Files as sources: each supplier or customer has small files of its own, rendered as texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.plans import surrogate
from loomspark.plans.registry import query
from loomspark.sources import readers

# Angle brackets stand for braces, which the parameters of an SQL text take.
_B = "translate({}, '<>', concat(chr(123), chr(125)))"
_REGISTRY = "SELECT s_suppkey, " + _B.format(
    """concat('<"T', CAST(s_suppkey AS STRING), '.ST": "Plain ', CAST(s_suppkey AS STRING), '", "U', CAST(s_suppkey AS STRING), '": <"name": ', CASE s_suppkey % 4 WHEN 0 THEN '7' ELSE concat('"Object ', CAST(s_suppkey AS STRING), '"') END, ', "irPage": "https://ir', CAST(s_suppkey AS STRING), '", "candidateDomains": ["a.example", 5, "b.example"],
 "annualReportPdfUrls": ["https://x/a.pdf", "ftp://no"], "manual": <"revenue_msek": ', CASE s_suppkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN '12.5' ELSE '"text"' END, ', "ceo": ', CASE s_suppkey % 2 WHEN 0 THEN '"Ann Lee"' ELSE '5' END, '>>, "V": [1]>')"""
) + " AS value FROM {supplier} WHERE s_suppkey % 9 <> 8 UNION ALL SELECT s_suppkey, 'broken' FROM {supplier} WHERE s_suppkey % 9 = 8"
_S = "(SELECT * FROM supplier WHERE s_suppkey % 9 <> 8)"


@query(f"""SELECT concat('T', s_suppkey, '.ST') AS ticker, concat('Plain ', s_suppkey) AS name, NULL AS ir_page, 0 AS n_domains, 0 AS n_pdfs, NULL AS manual_revenue, false AS has_revenue, NULL AS manual_ceo, false AS has_ceo FROM {_S} s
UNION ALL SELECT concat('U', s_suppkey), CASE WHEN s_suppkey % 4 <> 0 THEN concat('Object ', s_suppkey) END, concat('https://ir', s_suppkey), 2, 1, CASE WHEN s_suppkey % 3 = 1 THEN CAST(12.5 AS DOUBLE) END, s_suppkey % 3 < 2, CASE WHEN s_suppkey % 2 = 0 THEN 'Ann Lee' END, s_suppkey % 2 = 0 FROM {_S} s
UNION ALL SELECT 'V', NULL, NULL, 0, 0, NULL, false, NULL, false FROM {_S} s""")
def registry_scan(spark, d):
    r = readers.parse_registry(surrogate.frame(spark, d, _REGISTRY))
    return r.select("ticker", "name", "ir_page", F.size("candidate_domains").alias("n_domains"), F.size("annual_report_pdf_urls").alias("n_pdfs"), F.col("manual_revenue_msek").alias("manual_revenue"), F.coalesce("has_revenue_msek", F.lit(False)).alias("has_revenue"), "manual_ceo", F.coalesce("has_ceo", F.lit(False)).alias("has_ceo"))


@query(f"SELECT concat('T', s_suppkey, '.ST') AS ticker, concat('Plain ', s_suppkey) AS company, NULL AS ir_page, '' AS domains FROM {_S} s UNION ALL SELECT concat('U', s_suppkey), concat('Object ', s_suppkey), concat('https://ir', s_suppkey), 'a.example,b.example' FROM {_S} s WHERE s_suppkey % 4 <> 0")
def preflight_registry(spark, d):
    r = readers.preflight_registry(readers.parse_registry(surrogate.frame(spark, d, _REGISTRY)))
    return r.select("ticker", "company", "ir_page", F.array_join("candidate_domains", ",").alias("domains"))


@query("SELECT concat('Name ', s_suppkey, x) AS name FROM supplier, (SELECT unnest(['a', 'b']) AS x) y")
def list_scan(spark, d):
    files = surrogate.frame(spark, d, "SELECT concat('[\" Name ', CAST(s_suppkey AS STRING), 'a\", \"\", \"Name ', CAST(s_suppkey AS STRING), 'b \"]') AS value FROM {supplier}")
    return readers.parse_list(files)


_RULES = "SELECT " + _B.format("""concat('[<"if_legal_name_matches": ', CASE s_suppkey % 3 WHEN 0 THEN '5' ELSE concat('"^firm', CAST(s_suppkey AS STRING), '"') END, ', "reject_host_substrings": ["Host', CAST(s_suppkey AS STRING), '.", 4, "other."]>, "text", <"comment": "none">]')""") + " AS value FROM {supplier}"


@query("SELECT concat('^firm', s_suppkey) AS name_pattern, h AS host_part FROM (SELECT s_suppkey, unnest([concat('host', s_suppkey, '.'), 'other.']) AS h FROM supplier WHERE s_suppkey % 3 <> 0) x")
def collision_rules(spark, d):
    return readers.parse_collision_rules(surrogate.frame(spark, d, _RULES))


_HARD = "SELECT " + _B.format("""concat('<"company_names": [" Firm', CAST(s_suppkey % 5 AS STRING), '", 3], "tickers": ', CASE s_suppkey % 2 WHEN 0 THEN '"none"' ELSE concat('["t', CAST(s_suppkey AS STRING), '"]') END, '>')""") + " AS value FROM {supplier}"


@query("SELECT DISTINCT 'name' AS kind, concat('firm', s_suppkey % 5) AS value FROM supplier UNION ALL SELECT 'ticker', concat('T', s_suppkey) FROM supplier WHERE s_suppkey % 2 <> 0")
def hard_list(spark, d):
    return readers.parse_hard_list(surrogate.frame(spark, d, _HARD))


_RESULTS = "SELECT " + _B.format(
    """concat(CASE s_suppkey % 3 WHEN 0 THEN '<"generatedAt": "x", "results": ' WHEN 1 THEN '' ELSE '<oops' END, '[<"company": "C', CAST(s_suppkey AS STRING), '", "status": "partial", "fiscalYear": 2024, "extractedData": <"revenue_msek": ', CAST(s_suppkey AS STRING), '.5, "employees": 7>, "extractionNotes": ["a", "b"]>]', CASE s_suppkey % 3 WHEN 0 THEN '>' ELSE '' END)"""
) + " AS value FROM {supplier}"


@query("SELECT concat('C', s_suppkey) AS company, s_suppkey + CAST(0.5 AS DOUBLE) AS revenue, CAST(7 AS DOUBLE) AS employees, 2024 AS fiscal_year, true AS has_data, false AS timed_out, 'a | b' AS notes FROM supplier WHERE s_suppkey % 3 <> 2")
def result_files(spark, d):
    rows = readers.flat_results(readers.parse_results(surrogate.frame(spark, d, _RESULTS)))
    return rows.select("company", "revenue", "employees", "fiscal_year", "has_data", "timed_out", "notes")


_PREFLIGHT = "SELECT " + _B.format("""concat('<', CASE s_suppkey % 3 WHEN 0 THEN '"companyCount": 9, ' WHEN 1 THEN '"generatedAt": "g", ' ELSE '' END, CASE s_suppkey % 4 WHEN 0 THEN '"results": 5>' WHEN 1 THEN '"x": 1' ELSE '"results": [<"ticker": "T", "riskScore": 40>, <"ticker": "U">]>' END, CASE s_suppkey % 4 WHEN 1 THEN '' ELSE '' END)""") + " AS value FROM {supplier}"


@query("SELECT CASE WHEN s_suppkey % 3 = 1 THEN 'g' END AS generated_at, CASE WHEN s_suppkey % 3 = 0 THEN 9 WHEN s_suppkey % 4 = 0 THEN 0 ELSE 2 END AS company_count, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 2 END AS n_rows, CASE WHEN s_suppkey % 4 > 1 THEN 40 END AS first_score FROM supplier WHERE s_suppkey % 4 <> 1")
def preflight_file(spark, d):
    p = readers.parse_preflight(surrogate.frame(spark, d, _PREFLIGHT))
    return p.select("generated_at", "company_count", F.size("results").alias("n_rows"), F.get("results", F.lit(0))["riskScore"].alias("first_score"))


@query("SELECT DISTINCT concat('https://s', s_suppkey, '.example/', p) AS loc FROM supplier, (SELECT unnest(['investors/annual-report', 'Finance/x', 'reports']) AS p) x")
def sitemap_scan(spark, d):
    xml = "SELECT concat('<urlset><url><loc> https://s', CAST(s_suppkey AS STRING), '.example/investors/annual-report</loc></url><url><LOC>https://s', CAST(s_suppkey AS STRING), '.example/Finance/x</LOC></url><url><loc>https://s', CAST(s_suppkey AS STRING), '.example/reports\n</loc></url><loc>https://s', CAST(s_suppkey AS STRING), '.example/career</loc></urlset>') AS body FROM {supplier}"
    return readers.sitemap_urls(surrogate.frame(spark, d, xml))


@query("SELECT concat('https://cms.example/', s_suppkey, p) AS url FROM supplier, (SELECT unnest(['/a.pdf', '/b/c.pdf']) AS p) x")
def cms_scan(spark, d):
    body = "SELECT " + _B.format("""concat('<"items": [<"file": "https:', chr(92), '/', chr(92), '/cms.example', chr(92), '/', CAST(s_suppkey AS STRING), chr(92), '/a.pdf">, <"deep": <"url": "https://cms.example/', CAST(s_suppkey AS STRING), '/b/c.pdf?x", "page": "https://cms.example/p.html">>]>')""") + " AS body FROM {supplier}"
    return readers.json_urls(surrogate.frame(spark, d, body))


_LOG = "SELECT concat('https://u', CAST(event_id % 50 AS STRING)) AS url, CASE WHEN event_id % 3 = 0 THEN concat('https://final', CAST(event_id AS STRING)) END AS final_url, CASE WHEN event_id % 7 = 0 THEN 404 ELSE 200 END AS status, concat('body ', CAST(event_id AS STRING)) AS body, CASE WHEN event_id % 2 = 0 THEN 'http' ELSE 'browser' END AS transport, event_id AS ord FROM {events}"


@query("SELECT url, coalesce(final_url, url) AS final_url, body FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord DESC) AS n FROM (SELECT concat('https://u', event_id % 50) AS url, CASE WHEN event_id % 3 = 0 THEN concat('https://final', event_id) END AS final_url, concat('body ', event_id) AS body, event_id AS ord FROM events WHERE event_id % 7 <> 0 AND event_id % 2 = 1) e) x WHERE n = 1")
def browser_pages(spark, d):
    return readers.page_texts(surrogate.frame(spark, d, _LOG), "browser")


@query("SELECT DISTINCT url FROM (SELECT concat('https://u', event_id % 50) AS url FROM events WHERE event_id % 7 <> 0) x UNION ALL SELECT 'https://u51' WHERE false")
def reachable_pages(spark, d):
    asked = spark.range(60).select(F.concat(F.lit("https://u"), F.col("id").cast("string")).alias("url"))
    return readers.reachable(asked, surrogate.frame(spark, d, _LOG))
