"""Page scans, report and investor-page discovery, hubs and search results over rendered pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import urls
from loomspark.operators import discovery as di
from loomspark.plans import rank_sql as q
from loomspark.plans import surrogate
from loomspark.plans.merge_queries import C, candidates
from loomspark.plans.rank_queries import _SCORE, _SHORT, YEAR, pages, sql_year, sql_year_points
from loomspark.plans.rank_sql import sql_match, sql_sum
from loomspark.plans.registry import query

#: What a rendered page is made of: two links below a heading, an address in a script, and an escaped one.
_PIECES = f"""SELECT p_partkey AS page_id, text, heading, concat('https://www.site', CAST(p_partkey % 5 AS STRING), '.example') AS origin, substring(url, 25) AS tail,
  CASE p_size % 3 WHEN 0 THEN concat('https://cdn.sanity.io/files/', CAST(p_partkey AS STRING), '.pdf') WHEN 1 THEN concat('https://docs.site', CAST(p_partkey % 5 AS STRING), '.example/annual-report-2024.pdf') ELSE concat('https://other.example/x', CAST(p_partkey AS STRING), '.pdf') END AS inside,
  concat('storage.example/', CASE p_size % 4 WHEN 0 THEN 'interim-q2-2025' WHEN 1 THEN 'arsredovisning-2025' WHEN 2 THEN 'report-2019' ELSE 'file' END, '.pdf') AS away
FROM ({surrogate.TITLES}) t"""
RENDERED = f"""SELECT page_id, concat(origin, '/ir/index.html') AS url, origin, text, heading, tail, inside, away, concat('<html><body><div><h2>', coalesce(heading, 'Other'), '</h2><p>lines</p><ul><li><a href="/docs/', tail, '">', text, '</a></li><li><a href="more/list.html">See  all <b>Reports</b></a></li></ul></div><script>var a="', inside,
  '"; var b="https:', chr(92), '/', chr(92), '/', replace(away, '/', concat(chr(92), '/')), '";</script></body></html>') AS html FROM ({_PIECES}) p"""
_R = surrogate.text(RENDERED).replace("AS STRING", "AS VARCHAR")


def rendered(spark: SparkSession, d: str) -> DataFrame:
    # The part table alone is read; its rows are short, the pages are what weighs.
    return surrogate.frame(spark, d, RENDERED, dealt=True)


_FOUND = f"""SELECT page_id, 0 AS ord, 'anchor' AS kind, concat(origin, '/docs/', rtrim(tail, '/')) AS url, text, heading, html, concat(origin, '/docs/', rtrim(tail, '/'), ' ', text) AS hay FROM ({_R}) r
UNION ALL SELECT page_id, 1, 'anchor', concat(origin, '/ir/more/list.html'), 'See all Reports', heading, html, '' FROM ({_R}) r
UNION ALL SELECT page_id, 2, 'embedded', inside, 'Embedded PDF URL', NULL, html, concat(inside, ' ', inside) FROM ({_R}) r
UNION ALL SELECT page_id, 3, 'escaped', concat('https://', away), 'Embedded escaped PDF URL', NULL, html, concat('https://', away, ' https://', away) FROM ({_R}) r"""


@query(f"SELECT page_id, CAST(ord AS INT) AS ord, kind, url, text, CASE WHEN kind = 'anchor' THEN coalesce(heading, 'Other') END AS heading FROM ({_FOUND}) f")
def page_scan(spark, d):
    return di.scan_pages(rendered(spark, d)).select("page_id", "ord", "kind", "url", "text", "heading")


_ALONE = f"({sql_sum('lower(url)', q.ADDRESS)} + 2 * {sql_year_points('url')})"
_NEAR = sql_match("concat(html, ' ', url)", r"annual\s*(and\s*sustainability\s*)?report|årsredovisning|integrated\s*(annual\s*)?report|financial\s*statements|koncernredovisning|arsredovisning|års-?\s*och\s*hållbarhets")
_POINTS = f"CASE WHEN kind = 'anchor' THEN {_SCORE} + CASE WHEN {sql_match('heading', 'annual[[:space:]]*report|årsredovisning')} THEN 3 ELSE 0 END WHEN contains(url, 'sanity.io') THEN CASE WHEN {_NEAR} THEN greatest(3, {_ALONE}) + 10 ELSE 1 END WHEN kind = 'embedded' THEN greatest(3, {_ALONE}) ELSE greatest(4, {_ALONE}) END"
_STALE = "CASE WHEN len(years) > 0 THEN list_min(years) < 2023 ELSE coalesce(list_min(ends) < 2023, false) END"
_CANDIDATES = f"SELECT page_id, ord, url, text, CAST({_POINTS} AS INT) AS score FROM ({_SHORT} ({_FOUND}) h) x WHERE NOT {_STALE}"


@query(f"SELECT page_id, CAST(ord AS INT) AS ord, url, score FROM ({_CANDIDATES}) c")
def page_candidates(spark, d):
    """The heading above a link, addresses in scripts, and those on content networks count here."""
    return di.report_candidates(di.scan_pages(rendered(spark, d)), YEAR).select("page_id", "ord", "url", "score")


@query(f"""SELECT page_id, concat(origin, '/ir/more/list.html') AS url, 5 AS points, CAST(1 + CASE WHEN first_points > 5 OR first_points = 5 THEN 1 ELSE 0 END AS INT) AS rank FROM (SELECT *, CASE WHEN regexp_matches(tail, '\\.pdf(\\?|$)') THEN 0 ELSE {sql_sum('text', r'''
5 \\breports?\\b
5 \\bpublications?\\b
5 \\bdocuments?\\b
5 \\barchive\\b
5 \\bfinancial\\s*information\\b
5 \\brapporter\\b
5 \\bpublikationer\\b
5 \\bannual\\s*report
5 \\bårsredovisning
3 annual
-10 calendar|event|press|news|contact|career|cookie|privacy
'''.replace(chr(92) * 2, chr(92)))} + CASE WHEN contains(tail, 'investor') THEN 2 ELSE 0 END END AS first_points FROM ({_R}) r) x""")
def followed_pages(spark, d):
    return di.sub_pages(di.scan_pages(rendered(spark, d))).where(F.col("url").endswith("list.html")).select("page_id", "url", "points", "rank")


_CLASS = f"CASE WHEN {sql_match('concat(text, chr(32), url)', q.ANNUAL_CLASS)} THEN 0 ELSE 1 END"
_PDF = "regexp_matches(lower(url), '\\.pdf(\\?|$)')"


def _discovery_sql(source: str, key: str) -> str:
    return f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY {key}, url ORDER BY score DESC, ord) AS n FROM ({source}) c), k AS (SELECT *, {_CLASS} AS other FROM b WHERE n = 1 AND ({_PDF} OR score >= 25)),
a AS (SELECT *, min(other) OVER (PARTITION BY {key}) AS best FROM k), r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY CASE WHEN other = best THEN 0 ELSE 1 END, score DESC, CASE WHEN other = best AND {_PDF} THEN 0 ELSE 1 END, ord) AS rank FROM a),
g AS (SELECT {key}, count(*) AS considered, max(CASE WHEN rank = 1 THEN url END) AS url, max(CASE WHEN rank = 1 THEN text END) AS text, max(CASE WHEN rank = 1 THEN score END) AS s1, max(CASE WHEN rank = 2 THEN score END) AS s2, string_agg(url, ' ' ORDER BY rank) FILTER (rank <= 10) AS candidates FROM r GROUP BY 1)
SELECT {key}, url, CAST(coalesce({sql_year('text')}, {sql_year('url')}) AS INT) AS fiscal_year, CASE WHEN s1 < 8 THEN 'low' WHEN s2 IS NOT NULL AND s1 - s2 <= 3 THEN 'medium' ELSE 'high' END AS confidence, considered, candidates FROM g"""


@query(_discovery_sql(C, "company_id"))
def report_discovery(spark, d):
    return di.report_discovery(candidates(spark, d), "company_id").withColumn("candidates", F.array_join("candidates", " "))


@query(_discovery_sql(_CANDIDATES, "page_id"))
def page_reports(spark, d):
    """From pages to reports: scan, points, choice."""
    return di.report_discovery(di.report_candidates(di.scan_pages(rendered(spark, d)), YEAR)).withColumn("candidates", F.array_join("candidates", " "))


@query("SELECT page_id, regexp_matches(lower(html), 'href[[:space:]]*=[[:space:]]*[\"''][^\"'']*\\.pdf') OR contains(lower(html), 'annual report') OR contains(lower(html), 'årsredovisning') OR contains(html, '2025') OR contains(html, '2024') AS valid FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN concat(html, ' FY 2024') WHEN 1 THEN replace(html, 'href=\"/', 'href=\"/a.pdf') WHEN 2 THEN concat('Annual REPORT ', html) ELSE html END AS html FROM pages) p")
def investor_page_valid(spark, d):
    i = F.col("page_id") % 4
    html = F.when(i == 0, F.concat("html", F.lit(" FY 2024"))).when(i == 1, F.replace("html", F.lit('href="/'), F.lit('href="/a.pdf'))).when(i == 2, F.concat(F.lit("Annual REPORT "), "html")).otherwise(F.col("html"))
    return pages(spark, d).select("page_id", di.investor_page_valid(html, YEAR).alias("valid"))


@query(f"SELECT p_partkey, {sql_match(chr(39) + chr(39) + ' || url || chr(32) || text', 'investor.?relations|investerare')} OR regexp_matches(lower(url), '/investors?\\b') OR ({sql_match('concat(url, chr(32), text)', 'annual.report')} AND NOT contains(lower(url), '.pdf')) AS wording FROM ({surrogate.text(surrogate.TITLES)}) t")
def investor_page_wording(spark, d):
    t = surrogate.frame(spark, d, surrogate.TITLES)
    return t.select("p_partkey", di.investor_page_wording(F.col("url"), F.col("text")).alias("wording"))


#: Rendered addresses in many forms: the raw text and what the database expects of it.
_FORMS = """SELECT p_partkey, concat(CASE p_partkey % 8 WHEN 0 THEN '/Docs/a' WHEN 1 THEN 'b.html' WHEN 2 THEN '../c' WHEN 3 THEN '//CDN.Example.net/d' WHEN 4 THEN 'mailto:x@example.com' WHEN 5 THEN '"/%22/investors//%22"' WHEN 6 THEN ' https://Www.Other.example/E/?q=1#f ' ELSE '?page=2' END, CASE WHEN p_partkey % 8 IN (0, 1, 2, 3) THEN CAST(p_size AS STRING) ELSE '' END) AS href,
'https://www.site.example/ir/en/index.html' AS base, p_size FROM {part}"""


@query(f"SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN concat('https://www.site.example/Docs/a', p_size) WHEN 1 THEN concat('https://www.site.example/ir/en/b.html', p_size) WHEN 2 THEN concat('https://www.site.example/ir/c', p_size) WHEN 3 THEN concat('https://cdn.example.net/d', p_size) WHEN 5 THEN 'https://www.site.example/investors' WHEN 6 THEN 'https://www.other.example/E?q=1#f' WHEN 7 THEN 'https://www.site.example/ir/en/index.html?page=2' END AS url, p_partkey % 8 IN (0, 1, 2, 5, 7) AS same, CASE p_partkey % 8 WHEN 0 THEN concat('/docs/a', p_size) WHEN 1 THEN concat('/ir/en/b.html', p_size) WHEN 2 THEN concat('/ir/c', p_size) WHEN 3 THEN concat('/d', p_size) WHEN 4 THEN '' WHEN 5 THEN '/investors' WHEN 6 THEN '/e' ELSE '/ir/en/index.html' END AS path FROM part")
def resolve_urls(spark, d):
    t = surrogate.frame(spark, d, _FORMS).withColumn("url", urls.resolve(F.col("base"), F.col("href")))
    return t.select("p_partkey", "url", urls.same_site(F.col("base"), F.col("url")).alias("same"), urls.path(F.col("url")).alias("path"))


@query("SELECT page_id, concat(regexp_extract(url, '^(https?://[^/]+)', 1), '/', replace(url_encode(href[2:]), '%2C', ',')) AS url FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS href FROM pages) h WHERE starts_with(href, '/') AND NOT contains(href[2:], '/')")
def resolve_links(spark, d):
    found = pages(spark, d).select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))).alias("href"))
    return found.where(F.col("href").startswith("/") & ~F.col("href").substr(2, 10_000).contains("/")).select("page_id", urls.resolve(F.col("url"), F.col("href")).alias("url"))


@query("SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN concat('https://site', s_suppkey, '.example') WHEN 1 THEN concat('http://site', s_suppkey, '.example/About') WHEN 2 THEN NULL WHEN 3 THEN concat('https://site', s_suppkey, '.example/a') WHEN 4 THEN NULL ELSE concat('https://site', s_suppkey, '.example/?x=1') END AS url FROM supplier")
def absolute_urls(spark, d):
    n = F.col("s_suppkey").cast("string")
    i = F.col("s_suppkey") % 6
    site = F.concat(F.lit("Site"), n, F.lit(".Example"))
    raw = F.when(i == 0, F.concat(F.lit(" "), site, F.lit("/ "))).when(i == 1, F.concat(F.lit("http://"), site, F.lit("/About"))).when(i == 2, F.lit("  ")).when(i == 3, F.concat(site, F.lit("/a/"))).when(i == 4, F.lit("two words")).otherwise(F.concat(F.lit("https://"), site, F.lit("?x=1")))
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", urls.absolute(raw).alias("url"))


@query("SELECT s_suppkey AS company_id, concat('https://site', s_suppkey, '.example', p) AS url FROM supplier, (SELECT unnest(['/investor-relations/reports-and-publications', '/investor-relations/reports-and-presentations', '/investor-relations/financial-reports', '/investors/reports', '/investors/financial-reports', '/our-offering/reports-and-publications', '/en/investor-relations/reports-and-publications', '/en/investors/reports']) AS p) x WHERE (s_suppkey + length(p)) % 3 = 0")
def hub_probe(spark, d):
    supplier = spark.read.parquet(f"{d}/supplier.parquet")
    companies = supplier.select(F.col("s_suppkey").alias("company_id"), F.concat(F.when(F.col("s_suppkey") % 2 == 0, "https://").otherwise(""), F.lit("site"), F.col("s_suppkey").cast("string"), F.lit(".example/start?x")).alias("website"))
    # The log holds answers and errors of all paths.
    log = supplier.select("s_suppkey", F.explode(F.array(*map(F.lit, di.HUB_PATHS))).alias("p"))
    log = log.select(F.concat(F.lit("https://site"), F.col("s_suppkey").cast("string"), F.lit(".example"), "p").alias("url"), F.when((F.col("s_suppkey") + F.length("p")) % 3 == 0, 200).otherwise(404).alias("status"))
    return di.hub_addresses(companies, log)


@query("""WITH r AS (SELECT l_orderkey AS query, CASE l_suppkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS engine, concat('https://hit', l_partkey % 4) AS url, l_linenumber AS ord FROM lineitem), f AS (SELECT *, CASE engine WHEN 'b' THEN 1 WHEN 'a' THEN 2 END AS e FROM r WHERE engine <> 'c'),
k AS (SELECT *, min(e) OVER (PARTITION BY query) AS first FROM f) SELECT query, engine, url, min(ord) AS ord FROM k WHERE e = first GROUP BY 1, 2, 3""")
def search_results(spark, d):
    l = spark.read.parquet(f"{d}/lineitem.parquet")  # noqa: E741
    engine = F.when(F.col("l_suppkey") % 3 == 0, "a").when(F.col("l_suppkey") % 3 == 1, "b").otherwise("c")
    results = l.select(F.col("l_orderkey").alias("query"), engine.alias("engine"), F.col("l_linenumber").alias("ord"), F.concat(F.lit("https://hit"), (F.col("l_partkey") % 4).cast("string")).alias("url"), F.lit("t").alias("title"), F.lit("s").alias("snippet"))
    return di.search_results(results, ("b", "a")).select("query", "engine", "url", "ord")


@query("SELECT s_suppkey, s_suppkey % 3 = 0 OR s_suppkey % 3 = 1 AS skipped FROM supplier")
def rendered_skip(spark, d):
    i = F.col("s_suppkey") % 3
    url = F.when(i == 0, "https://www.Slow.example/x").when(i == 1, "https://other.example").otherwise("https://sub.slow.example")
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", di.rendered_skip(url, True, ("slow.example", "other.example")).alias("skipped"))


_IR = """SELECT c_custkey AS company_id, concat('https://c', c_custkey, '.example') AS home FROM customer"""


@query(f"""WITH c AS ({_IR}) SELECT company_id, CASE WHEN company_id % 4 = 0 THEN concat(home, '/ir/start') WHEN company_id % 4 = 1 THEN concat(home, '/investors') WHEN company_id % 4 = 2 THEN concat(home, '/map') END AS url,
CASE company_id % 4 WHEN 0 THEN 'homepage' WHEN 1 THEN 'paths' ELSE 'sitemap' END AS tier, CAST(CASE company_id % 4 WHEN 0 THEN 20 WHEN 1 THEN 19 ELSE 0 END AS INT) AS score FROM c WHERE company_id % 4 <> 3""")
def investor_page(spark, d):
    """Homepage links by points, usual paths, sitemap; the first that holds. Another site's page and one that doesn't hold are passed over."""
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("company_id"), F.concat(F.lit("https://c"), F.col("c_custkey").cast("string"), F.lit(".example")).alias("home"))
    link = lambda path, text, n: c.select("company_id", "home", (F.concat("home", F.lit(path)) if path.startswith("/") else F.lit(path)).alias("url"), F.lit(text).alias("text"), F.lit(n).alias("ord"))
    links = link("/contact", "Contact", 0).unionAll(link("https://elsewhere.example/investor-relations", "Investor relations", 1)).unionAll(link("/investors/none", "Investors", 2)).unionAll(link("/ir/start", "Investor relations", 3))
    at = lambda path, n: c.select("company_id", F.concat("home", F.lit(path)).alias("url"), F.lit(n).alias("ord"))
    i = F.col("company_id") % 4
    page = lambda path, body, when: c.where(when).select(F.concat("home", F.lit(path)).alias("url"), F.lit(body).alias("body"), F.lit(200).alias("status"))
    fetches = page("/investors/none", "nothing", F.lit(True)).unionAll(page("/ir/start", "Annual report", i == 0)).unionAll(page("/investors", "<a href='x.pdf'>", i <= 1)).unionAll(page("/map", "in 2025", i <= 2))
    fetches = fetches.unionAll(spark.createDataFrame([("https://elsewhere.example/investor-relations", "annual report", 200)], "url string, body string, status int"))
    return di.investor_tiers(links, "home", at("/investors", 0), at("/map", 0), fetches, YEAR)


_HITS = """SELECT l_orderkey AS company_id, l_linenumber % 2 AS query_no, l_linenumber AS ord, CASE (l_orderkey + l_linenumber % 2 * 3 + l_linenumber) % 5 WHEN 0 THEN concat('https://www.firm', CAST(l_orderkey AS STRING), '.example/investor') WHEN 1 THEN concat('https://ir.firm', CAST(l_orderkey AS STRING), '.example/start')
  WHEN 2 THEN 'https://www.allabolag.se/x' WHEN 3 THEN 'https://unrelated.example/firm' ELSE concat('https://firm', CAST(l_orderkey AS STRING), '.example/report.pdf') END AS url, CASE l_linenumber % 3 WHEN 0 THEN 'Official site' ELSE 'Page' END AS title
  FROM (SELECT l_orderkey, l_linenumber FROM {lineitem} GROUP BY l_orderkey, l_linenumber) x"""
_HITS_SQL = surrogate.text(_HITS).replace("AS STRING", "AS VARCHAR")


@query(f"""WITH k AS (SELECT *, (company_id + query_no * 3 + ord) % 5 AS kind FROM ({_HITS_SQL}) h WHERE (company_id + query_no * 3 + ord) % 5 < 2 AND NOT (company_id % 4 = 0 AND (company_id + query_no * 3 + ord) % 5 = 1)),
f AS (SELECT *, row_number() OVER (PARTITION BY company_id, kind ORDER BY query_no, ord) AS n FROM k), s AS (SELECT *, least(12, length(concat('firm', company_id))) + CASE WHEN kind = 0 THEN 8 WHEN regexp_matches('ir.firm', 'ir\\b') THEN 8 ELSE 0 END + CASE WHEN ord % 3 = 0 THEN 4 ELSE 0 END AS score FROM f WHERE n = 1)
SELECT company_id, CASE WHEN kind = 0 THEN concat('https://final', company_id) ELSE concat('https://ir.firm', company_id, '.example') END AS url, concat(CASE WHEN kind = 1 THEN 'ir.' ELSE '' END, 'firm', company_id, '.example') AS host, CAST(score AS INT) AS score, CAST(row_number() OVER (PARTITION BY company_id ORDER BY score DESC, query_no, ord) AS INT) AS rank FROM s""")
def corporate_domains(spark, d):
    """Portals, other companies and files are passed over; an origin that the log doesn't know is none."""
    hits = surrogate.frame(spark, d, _HITS).withColumns({"snippet": F.lit(""), "slugs": F.array(F.concat(F.lit("firm"), F.col("company_id").cast("string")), F.lit("zzz"))})
    c = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    n = F.col("k").cast("string")
    main = c.select(F.concat(F.lit("https://www.firm"), n, F.lit(".example/")).alias("url"), F.concat(F.lit("https://final"), n, F.lit("/")).alias("final_url"), F.lit(200).alias("status"))
    side = c.select(F.concat(F.lit("https://ir.firm"), n, F.lit(".example/")).alias("url"), F.lit(None).cast("string").alias("final_url"), F.when(F.col("k") % 4 == 0, 404).otherwise(200).alias("status"))
    return di.corporate_domains(hits, main.unionAll(side))
