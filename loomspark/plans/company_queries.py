"""Company lists, enrichment, generated addresses, tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.functions import numbers as num
from loomspark.functions import texts
from loomspark.operators import company as c
from loomspark.operators import rank, risk
from loomspark.plans.merge_queries import C, candidates
from loomspark.plans.rank_queries import sql_year
from loomspark.plans.registry import query
from loomspark.plans.result_queries import R, rows

_HOST = "regexp_replace(lower(regexp_extract(url, '://([^/]*)', 1)), '^www\\.', '')"


@query(f"""WITH u AS (SELECT company AS name, ticker, company_id AS ord, 0 AS part FROM ({R}) r WHERE company_id % 3 = 0 UNION ALL SELECT upper(company), ticker, company_id, 1 FROM ({R}) r WHERE company_id % 2 = 0),
j AS (SELECT u.*, coalesce(g.legal, u.name, u.ticker) AS legal FROM u LEFT JOIN (SELECT ticker, concat('Legal ', company) AS legal FROM ({R}) r WHERE company_id % 4 = 0 AND ticker IS NOT NULL) g ON u.ticker = g.ticker)
SELECT name, ticker, ord, legal FROM (SELECT *, row_number() OVER (PARTITION BY lower(legal) ORDER BY part, ord) AS n FROM j) x WHERE n = 1""")
def company_list(spark, d):
    r = rows(spark, d)
    first = r.where("company_id % 3 = 0").select(F.col("company").alias("name"), "ticker", F.col("company_id").alias("ord"))
    second = r.where("company_id % 2 = 0").select(F.upper("company").alias("name"), "ticker", F.col("company_id").alias("ord"))
    registry = r.where("company_id % 4 = 0 AND ticker IS NOT NULL").select("ticker", F.concat(F.lit("Legal "), "company").alias("name"))
    return c.company_list([first, second], registry).select("name", "ticker", "ord", "legal")


_REGISTRY = f"SELECT concat('T', CAST(company_id AS VARCHAR), '-B.ST') AS ticker, CASE WHEN company_id % 2 = 0 THEN NULL ELSE report_url END AS url, company AS name, company_id FROM ({R}) r"


@query(f"SELECT g.ticker, coalesce(g.url, s.url) AS url FROM ({_REGISTRY}) g LEFT JOIN (SELECT company_id, concat('https://seed/', CAST(company_id AS VARCHAR)) AS url FROM ({R}) r WHERE company_id % 3 = 0) s ON g.company_id = s.company_id")
def seed_enrichment(spark, d):
    r = rows(spark, d)
    registry = r.select(F.concat(F.lit("T"), F.col("company_id").cast("string"), F.lit("-B.ST")).alias("ticker"), F.when(F.col("company_id") % 2 != 0, F.col("report_url")).alias("url"))
    seeds = r.where("company_id % 3 = 0").select(F.concat(F.lit("t"), F.col("company_id").cast("string"), F.lit(" a")).alias("symbol"), F.concat(F.lit("https://seed/"), F.col("company_id").cast("string")).alias("url"))
    return c.enrich(registry, seeds, "url").select("ticker", "url")


@query(f"SELECT url, string_agg(DISTINCT ticker, ',' ORDER BY ticker) AS tickers, max(name) AS name FROM (SELECT CASE WHEN company_id % 9 <> 0 THEN concat('https://ir/', CAST(company_id % 100 AS VARCHAR)) END AS url, concat('T', CAST(company_id AS VARCHAR)) AS ticker, company AS name FROM ({R}) r) x WHERE url IS NOT NULL GROUP BY 1")
def link_health(spark, d):
    i = F.col("company_id")
    registry = rows(spark, d).select(F.when(i % 9 != 0, F.concat(F.lit("https://ir/"), (i % 100).cast("string"))).alias("url"), F.concat(F.lit("T"), i.cast("string")).alias("ticker"), F.col("company").alias("name"))
    return c.link_health(registry)


@query(f"""SELECT company_id, CAST(year AS INT) AS year, concat('https://x', CAST(company_id AS VARCHAR), '.example', replace(replace(template, '{{year}}', CAST(year AS VARCHAR)), '{{slug}}', trim(regexp_replace(lower(company), '[^a-z0-9]+', '-', 'g'), '-'))) AS url
FROM ({R}) r, (SELECT unnest([2023, 2024]) AS year) y, (SELECT unnest(['/{{slug}}-annual-report-{{year}}.pdf', '/{{slug}}-annual-and-sustainability-report-{{year}}.pdf', '/investors/annual-report-{{year}}.pdf', '/investors/{{slug}}-annual-report-{{year}}.pdf', '/globalassets/{{slug}}-annual-report-{{year}}.pdf',
'/annual-report-{{year}}.pdf', '/annual-report-{{year}}-en.pdf', '/globalassets/annual-report-{{year}}.pdf', '/assets/annual-report-{{year}}.pdf', '/content/dam/{{slug}}/annual-report-{{year}}.pdf', '/wp-content/uploads/{{year}}/{{slug}}-annual-report-{{year}}.pdf']) AS template) t""")
def report_addresses(spark, d):
    named = rows(spark, d).select("company_id", F.concat(F.lit("https://x"), F.col("company_id").cast("string"), F.lit(".example")).alias("origin"), texts.slug(F.col("company")).alias("slug"))
    return c.report_addresses(named, [2023, 2024])


@query(f"SELECT company_id, ord FROM (SELECT *, {_HOST} AS host FROM ({C}) k) x WHERE host = 'ir1.example.com' OR host LIKE '%.ir1.example.com' OR host = 'ir2.example.com' OR host LIKE '%.ir2.example.com'")
def allowed_hosts(spark, d):
    k = candidates(spark, d).withColumn("host", texts.host_key(F.col("url")))
    return c.allowed_hosts(k, ["ir1.example.com", "ir2.example.com"]).select("company_id", "ord")


@query(f"SELECT company_id, ord, company_id % 3 = 0 OR contains({_HOST}, 'ir5') OR contains({_HOST}, concat('ir', CAST(company_id % 9 AS VARCHAR))) AS trusted FROM ({C}) k")
def brand_trust(spark, d):
    slugs = F.when(F.col("company_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("ir5"), F.concat(F.lit("ir"), (F.col("company_id") % 9).cast("string"))))
    return candidates(spark, d).select("company_id", "ord", c.brand_trust(texts.host_key(F.col("url")), slugs).alias("trusted"))


@query(f"SELECT company_id, CAST(CASE WHEN company_id % 4 = 0 THEN 0 WHEN company_id % 3 = 0 THEN 1 ELSE 2 END AS INT) AS tier, CASE WHEN company_id % 4 = 0 THEN revenue WHEN company_id % 3 = 0 THEN employees ELSE ebit END AS value FROM ({R}) r WHERE company_id % 4 = 0 OR company_id % 3 = 0 OR company_id % 5 = 0")
def tier_ladder(spark, d):
    r = rows(spark, d)
    tier = lambda n, v: r.where(f"company_id % {n} = 0").select("company_id", F.col(v).alias("value"))
    return c.tier_ladder(r, [tier(4, "revenue"), tier(3, "employees"), tier(5, "ebit")])


@query(f"SELECT company_id, value FROM (SELECT company_id, score AS value, row_number() OVER (PARTITION BY company_id ORDER BY abs(score * 25 - company_id % 1200), ord) AS n FROM ({C}) k) x WHERE n = 1")
def employee_repick(spark, d):
    k = candidates(spark, d).select("company_id", F.col("score").alias("value"), (F.col("company_id") % 1200).alias("revenue"), "ord")
    return c.repick_employees(k)


@query(f"SELECT company_id, CASE WHEN company_type IN ('bank', 'real_estate') THEN 'mapped' WHEN company_type = 'investment_company' THEN 'n_a' ELSE 'exact' END AS revenue, 'exact' AS employees FROM ({R}) r")
def schema_mapping(spark, d):
    return rows(spark, d).select("company_id", c.schema_mapping(F.col("company_type"), "revenue").alias("revenue"), c.schema_mapping(F.col("company_type"), "employees").alias("employees"))


@query(f"SELECT company_id, ord FROM (SELECT company_id, ord, row_number() OVER (PARTITION BY company_id ORDER BY coalesce({sql_year('url')}, 0) DESC, score DESC, ord) AS n FROM ({C}) k) x WHERE n = 1")
def best_sustainability(spark, d):
    return c.best_recent(candidates(spark, d), "company_id", rank.latest_year(F.col("url"))).select("company_id", "ord")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) x WHERE n <= 5")
def job_table(spark, d):
    return c.job_table(spark.read.parquet(f"{d}/events.parquet"), 5).select("user_id", "event_id")


@query(f"SELECT concat(rpad(company, 20, ' '), rpad(coalesce(CAST(fiscal_year AS VARCHAR), '-'), 6, ' '), rpad(coalesce(CAST(confidence AS VARCHAR), '-'), 4, ' ')) AS line FROM ({R}) r")
def console_lines(spark, d):
    return rows(spark, d).select(c.fixed_width(("company", 20), ("fiscal_year", 6), ("confidence", 4)).alias("line"))


@query("SELECT page_id, nullif(regexp_replace(regexp_replace(regexp_extract(concat('see ', url, ' or ', url), 'https?://[^ \"<>)]+'), '#.*$', ''), '/+$', ''), '') AS link FROM pages")
def link_text(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet")
    return pages.select("page_id", c.plain_link(F.concat(F.lit("see "), "url", F.lit(" or "), "url")).alias("link"))




@query("SELECT s_suppkey, s_suppkey % 4 = 1 OR s_suppkey % 4 = 3 AND s_suppkey % 5 <> 0 AS drift FROM supplier")
def host_drift(spark, d):
    """Hosts beside candidate domains: equal, another, no domains, and a domain as an address that fits every fifth."""
    i = F.col("s_suppkey") % 4
    n = F.col("s_suppkey").cast("string")
    url = F.when(i == 3, F.concat(F.lit("https://www.group"), (F.col("s_suppkey") % 5).cast("string"), F.lit(".example/ir"))).otherwise(F.concat(F.lit("https://www.site"), n, F.lit(".example/x")))
    domains = F.when(i == 0, F.array(F.lit("other.example"), F.concat(F.lit("www.Site"), n, F.lit(".example")))).when(i == 1, F.array(F.lit("other.example"))).when(i == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("https://www.group0.example/about")))
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", risk.host_drift(url, domains).alias("drift"))


@query("SELECT concat('volv', chr(97 + CAST(s_suppkey % 26 AS INT)), ' b') AS raw, concat('VOLV', upper(chr(97 + CAST(s_suppkey % 26 AS INT))), '-B.ST') AS ticker, CASE WHEN s_suppkey % 2 = 0 THEN concat('Firm ', s_suppkey) ELSE concat('volv', chr(97 + CAST(s_suppkey % 26 AS INT)), ' b') END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'https://ir' END AS ir_page FROM supplier WHERE s_suppkey < 26")
def ticker_profiles(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").where("s_suppkey < 26")
    letter = F.expr("chr(97 + s_suppkey % 26)")
    asked = s.select(F.concat(F.lit("volv"), letter, F.lit(" b")).alias("ticker"))
    registry = s.where("s_suppkey % 2 = 0").select(F.concat(F.lit("VOLV"), F.upper(letter), F.lit("-B.ST")).alias("ticker"), F.concat(F.lit("Firm "), F.col("s_suppkey").cast("string")).alias("name"), F.lit("https://ir").alias("ir_page"))
    return c.profiles(asked, registry)


@query("SELECT p_partkey, CAST(CASE p_partkey % 6 WHEN 0 THEN (1000 + p_partkey) / 1000.0 WHEN 1 THEN 2000 + p_partkey WHEN 2 THEN NULL WHEN 3 THEN -(5000 + p_partkey) / 1000.0 WHEN 4 THEN (10000 + p_partkey) / 1000.0 ELSE NULL END AS DOUBLE) AS msek FROM part")
def substantial_numbers(spark, d):
    n = F.col("p_partkey")
    t = lambda base: (n + base).cast("string")
    i = n % 6
    line = F.when(i == 0, F.concat(F.lit("Omsättning "), t(1000), F.lit(" tkr"))).when(i == 1, F.concat(F.lit("Revenue 12 "), F.lit("x "), t(2000), F.lit(" mkr"))).when(i == 2, "Year 123").when(i == 3, F.concat(F.lit("Result –"), t(5000))).when(i == 4, "Sales").otherwise("Note 2024")
    below = F.when(i == 4, t(10000)).when(i == 5, "12").otherwise("7 x")
    part = spark.read.parquet(f"{d}/part.parquet")
    return part.select("p_partkey", F.when(i == 5, num.substantial_number(line, below, 3000)).otherwise(num.substantial_number(line, below, 100)).alias("msek"))
