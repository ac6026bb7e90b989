"""Stand-in input tables, derived from the star schema.

The engine's own inputs (stored results, notes, candidates, fetch logs) have no counterpart among the test tables, so they are rendered from them by SQL that Spark and
the checking database both run. Only inputs are shared; every operator is written twice, as DataFrame code and as SQL. Numbers are integers, so that no comparison hangs on
rounding. The scales differ by key so that every branch of the decision tables is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Money is summed in cents, as integers.
_BASE = """
SELECT c.c_custkey AS k, c.c_name AS company, count(o.o_orderkey) AS n_orders,
       CAST(floor(coalesce(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)), 0) / 100) AS BIGINT) AS r
FROM {customer} c LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_name
"""

_AMOUNTS = f"""
SELECT b.*,
  CASE WHEN k % 50 = 17 THEN 'industrial' WHEN k % 29 = 4 THEN 'pharma' WHEN k % 4 = 0 THEN 'industrial' WHEN k % 4 = 1 THEN 'bank'
       WHEN k % 4 = 2 THEN 'real_estate' ELSE 'investment_company' END AS company_type,
  CASE WHEN k % 50 = 17 THEN 100 + r % 900 WHEN k % 11 = 0 THEN NULL WHEN k % 11 = 1 THEN -r WHEN k % 11 = 2 THEN 4900000 + r * 100
       WHEN k % 11 = 3 THEN r % 1000 WHEN k % 11 = 4 THEN r % 10000 WHEN k % 11 = 5 THEN 100 + r % 900 ELSE 1000 + r % 4000000 END AS revenue,
  CASE WHEN k % 50 = 17 THEN 40000 + n_orders WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN n_orders WHEN k % 9 = 2 THEN 20 + n_orders WHEN k % 9 = 3 THEN 60 + n_orders
       WHEN k % 9 = 4 THEN 800000 + n_orders WHEN k % 9 = 5 THEN 5000 + r % 50000 ELSE 100 + r % 90000 END AS employees
FROM ({_BASE}) b
"""

RESULTS = f"""
SELECT k AS company_id, company, CASE WHEN k % 7 = 0 THEN NULL ELSE concat('T', CAST(k AS STRING), '.ST') END AS ticker, company_type,
  CASE WHEN k % 17 = 3 THEN NULL ELSE CAST(revenue AS DOUBLE) END AS revenue,
  CASE WHEN k % 17 = 3 THEN NULL ELSE CAST(CASE WHEN k % 50 = 17 THEN floor(revenue * 2 / 10) WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN revenue * 2 WHEN k % 13 = 2 THEN floor(revenue * 12 / 10)
       WHEN k % 13 = 3 THEN 1900000 + r % 2000000 WHEN k % 13 = 4 THEN -floor(revenue / 4) WHEN k % 13 = 5 THEN floor(revenue * 3 / 10) WHEN k % 13 = 6 THEN revenue * 10
       WHEN k % 13 = 7 THEN revenue * 1000 ELSE floor(revenue / 8) END AS DOUBLE) END AS ebit,
  CASE WHEN k % 17 = 3 THEN NULL ELSE CAST(employees AS DOUBLE) END AS employees,
  CASE WHEN k % 17 = 3 OR k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN 'Cher' ELSE concat('Anna Customer', CAST(k AS STRING)) END AS ceo,
  CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(2020 + k % 6 AS INT) END AS fiscal_year,
  k % 17 <> 3 AS has_data, k % 23 = 5 AS timed_out,
  CASE k % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'ir-html' WHEN 2 THEN 'allabolag' WHEN 3 THEN 'search+pdf' ELSE 'playwright+pdf' END AS data_source,
  CASE k % 6 WHEN 0 THEN 'primary' WHEN 1 THEN 'playwright' WHEN 2 THEN 'search' WHEN 3 THEN 'allabolag' WHEN 4 THEN 'ir-html' ELSE 'override' END AS fallback_step,
  CASE WHEN k % 12 = 0 THEN NULL ELSE CAST(40 + k % 61 AS INT) END AS confidence,
  CASE k % 19 WHEN 1 THEN 'irDiscovery' WHEN 2 THEN 'reportDiscovery' WHEN 3 THEN 'download' WHEN 4 THEN 'extraction' WHEN 5 THEN 'validation' ELSE NULL END AS failed_stage,
  CASE WHEN k % 8 = 0 THEN NULL WHEN k % 8 = 1 THEN concat('https://ir.example.com/corporate-governance report/', CAST(k AS STRING)) WHEN k % 8 = 2 THEN concat('https://ir.example.com/annual report policy/', CAST(k AS STRING))
       ELSE concat('https://ir.example.com/', CAST(k AS STRING), '.pdf') END AS report_url,
  concat_ws(' | ',
    CASE WHEN k % 3 = 0 THEN concat('Result: rejection summary (quality-gate=', CAST(k % 5 AS STRING), ', entity-check=', CAST(k % 7 AS STRING), ')') END,
    CASE WHEN k % 5 = 1 THEN 'EBIT not found' END,
    CASE WHEN k % 5 = 2 THEN 'EBIT exceeds revenue' END,
    CASE WHEN k % 10 = 3 THEN 'discarding EBIT for assignment safety' END,
    CASE WHEN k % 14 = 4 THEN 'EBIT implausibly large' END,
    CASE WHEN k % 9 = 2 THEN 'Employee count not extracted' END,
    CASE WHEN k % 9 = 5 THEN 'Employees: fiscal-year column misread' END,
    CASE WHEN k % 9 = 7 THEN 'Employee count too low (12) for industrial large-cap' END,
    CASE WHEN k % 9 = 8 THEN 'SUSPECT_LOW: 40 employees' END,
    CASE WHEN k % 11 = 6 THEN 'Revenue not found' END,
    CASE WHEN k % 11 = 8 THEN 'Revenue implausibly high' END,
    CASE WHEN k % 13 = 2 THEN 'CEO not found' END,
    CASE WHEN k % 13 = 5 THEN 'CEO: non-person ESEF boilerplate' END,
    CASE WHEN k % 16 = 3 THEN 'Revenue unit guard: scaled' END,
    CASE WHEN k % 32 = 3 THEN 'EBIT unit guard: scaled' END,
    CASE WHEN k % 21 = 4 THEN 'Fiscal year mismatch: 2022 vs 2024' END,
    CASE WHEN k % 25 = 6 THEN 'ENTITY_PROFILE: ambiguity=high' END,
    CASE WHEN k % 27 = 8 THEN 'download failed: 403' END,
    CASE WHEN k % 31 = 9 THEN 'ENTITY WARNING: other company' END,
    CASE WHEN k % 33 = 9 THEN 'CONTENT WARNING: quarterly' END,
    CASE WHEN k % 35 = 9 THEN 'Figures are segment-level' END,
    CASE WHEN k % 37 = 9 THEN 'Stage budget exhausted for report discovery' END,
    CASE WHEN k % 39 = 9 THEN 'Stage budget exhausted for ir-html' END,
    CASE WHEN k % 41 = 9 THEN 'allabolag lookup used' END,
    CASE WHEN k % 43 = 9 THEN 'quality gate rejected: no income statement signals' END,
    CASE WHEN k % 4 = 2 AND k % 3 = 1 THEN 'EBIT estimated from förvaltningsresultat, the primary operating metric' END,
    CASE WHEN k % 23 = 5 THEN 'Pipeline timed out after 210 s' END) AS notes
FROM ({_AMOUNTS}) a
"""

#: Stored and fresh rows for merging: fresh rows have other figures, some are new, some keys differ in case.
STORED = f"SELECT company, ticker, revenue, ebit, employees, ceo, confidence, company_id AS ord FROM ({RESULTS}) x WHERE company_id % 5 <> 0"
FRESH = f"""SELECT CASE WHEN company_id % 2 = 0 THEN upper(company) ELSE company END AS company, ticker, CASE WHEN company_id % 6 = 4 THEN NULL ELSE revenue + 1 END AS revenue, CASE WHEN company_id % 9 = 4 THEN NULL ELSE ebit END AS ebit,
employees, CASE WHEN company_id % 12 = 10 THEN NULL ELSE ceo END AS ceo, confidence, company_id AS ord FROM ({RESULTS}) x WHERE company_id % 5 = 0 OR company_id % 3 = 1"""

#: Ranked report candidates per company, from line items: url, text, score, arrival order.
CANDIDATES = """
SELECT o.o_custkey AS company_id, (o.o_orderkey * 10 + l.l_linenumber) * 100000000 + l.l_partkey * 1000 + l.l_suppkey % 1000 AS ord,
  concat('https://', CASE WHEN l.l_suppkey % 4 = 0 THEN 'www.' ELSE '' END, 'ir', CAST(l.l_suppkey % 9 AS STRING), '.example.com/', CASE l.l_partkey % 6 WHEN 0 THEN 'annual-report-' WHEN 1 THEN 'press/q1-' WHEN 2 THEN 'governance-policy-' WHEN 3 THEN 'arsredovisning-'
    WHEN 4 THEN 'acquisition-' ELSE 'doc-' END, CAST(2018 + l.l_partkey % 9 AS STRING), CASE WHEN l.l_linenumber % 3 = 0 THEN '' ELSE '.pdf' END) AS url,
  CASE l.l_partkey % 6 WHEN 0 THEN 'Annual report' WHEN 1 THEN 'Press release Q1 interim' WHEN 2 THEN 'Corporate governance report' WHEN 3 THEN 'Annual and sustainability report' WHEN 4 THEN 'Acquisition presentation' ELSE 'Document' END AS text,
  CAST(l.l_quantity AS INT) AS score, CAST(l.l_suppkey % 9 AS INT) AS host_no
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
"""

#: Link titles and addresses in which every rule of the point tables occurs, alone and with others.
TITLES = """
SELECT p_partkey, p_size, CASE p_partkey % 70 WHEN 0 THEN 'Annual report' WHEN 1 THEN 'Årsredovisning' WHEN 2 THEN 'Års- och hållbarhetsredovisning' WHEN 3 THEN 'Annual results' WHEN 4 THEN 'Q3 report'
    WHEN 5 THEN 'Interim statement' WHEN 6 THEN 'Quarterly figures' WHEN 7 THEN 'Delårsrapport' WHEN 8 THEN 'Governance' WHEN 9 THEN 'Remuneration' WHEN 10 THEN 'Presentation'
    WHEN 11 THEN 'Acquisition of Alpha' WHEN 12 THEN 'M&A strategy presentation' WHEN 13 THEN 'Capital markets day' WHEN 14 THEN 'Press release' WHEN 15 THEN 'News'
    WHEN 16 THEN 'General meeting' WHEN 17 THEN 'Annual general meeting' WHEN 18 THEN 'Extraordinary general meeting' WHEN 19 THEN 'AGM 2024' WHEN 20 THEN 'Proxy form'
    WHEN 21 THEN 'Voting results' WHEN 22 THEN 'Postal voting form' WHEN 23 THEN 'Post-vote form' WHEN 24 THEN 'Kallelse' WHEN 25 THEN 'Extra stämma' WHEN 26 THEN 'Bolagsstämma'
    WHEN 27 THEN 'Bolagsstamma' WHEN 28 THEN 'Röstmaterial' WHEN 29 THEN 'Valberedningen' WHEN 30 THEN 'Notice of the annual meeting' WHEN 31 THEN 'Instructions for shareholders'
    WHEN 32 THEN 'Summary 2023' WHEN 33 THEN 'Sammandrag' WHEN 34 THEN 'Year in brief' WHEN 35 THEN 'Highlights' WHEN 36 THEN 'Beta Holding' WHEN 37 THEN 'Sustainability report'
    WHEN 38 THEN 'Hållbarhetsrapport 2021' WHEN 39 THEN 'Hållbarhetsredovisning' WHEN 40 THEN 'ESEF package' WHEN 41 THEN 'Copy of the official document' WHEN 42 THEN 'Pillar 3'
    WHEN 43 THEN 'Risk disclosures' WHEN 44 THEN 'Risk report' WHEN 45 THEN 'Nomination committee''s work' WHEN 46 THEN 'Board proposal' WHEN 47 THEN 'LTI programme'
    WHEN 48 THEN 'Remuneration report' WHEN 49 THEN 'Bolagsstyrningsrapport' WHEN 50 THEN 'Corporate governance report' WHEN 51 THEN 'Code policy' WHEN 52 THEN 'Fact book'
    WHEN 53 THEN 'Governance statement' WHEN 54 THEN 'Annual and sustainability report 2025' WHEN 55 THEN 'Integrated annual report 2024' WHEN 56 THEN 'Annual financial report 2022'
    WHEN 57 THEN 'Investors' WHEN 58 THEN 'Investor relations' WHEN 59 THEN 'Investerare' WHEN 60 THEN 'Financial reports' WHEN 61 THEN 'Calendar' WHEN 62 THEN 'Contact'
    WHEN 63 THEN 'Career' WHEN 64 THEN 'Cookie notice' WHEN 65 THEN 'Privacy' WHEN 66 THEN 'Legal' WHEN 67 THEN 'Notice of meeting' WHEN 68 THEN 'Annual report 2019 and 2023'
    WHEN 69 THEN 'Mergers and acquisitions overview presentation' END AS text,
concat('https://ir', CAST(p_partkey % 5 AS STRING), '.example.com/', CASE p_size % 26 WHEN 0 THEN 'annual-report-2024.pdf' WHEN 1 THEN 'arsredovisning-2025.pdf' WHEN 2 THEN 'annual-and-sustainability-report.pdf' WHEN 3 THEN 'doc.pdf?v=1'
    WHEN 4 THEN 'press/pr-1.html' WHEN 5 THEN 'news/interim-q1.pdf' WHEN 6 THEN 'presentations/acquisition-deck.pdf' WHEN 7 THEN 'agm/voting.pdf' WHEN 8 THEN 'postal-vote.pdf'
    WHEN 9 THEN 'instruktioner.pdf' WHEN 10 THEN 'nomination.pdf' WHEN 11 THEN 'lti-plan.pdf' WHEN 12 THEN 'board-proposals.pdf' WHEN 13 THEN 'corpgov.pdf'
    WHEN 14 THEN 'governance-report-2020.pdf' WHEN 15 THEN 'policy.pdf' WHEN 16 THEN 'factbook_2022.pdf' WHEN 17 THEN 'remuneration-report.pdf' WHEN 18 THEN 'investors/en/reports/'
    WHEN 19 THEN 'ir/index.html' WHEN 20 THEN 'mergers-and-acquisitions.pdf' WHEN 21 THEN 'm&a-deck.pdf' WHEN 22 THEN 'proxy_agm_2024.pdf' WHEN 23 THEN 'kallelse-2023.pdf'
    WHEN 24 THEN 'bolagsstamma/x.pdf' WHEN 25 THEN 'acqisition-present.pdf' END) AS url,
CASE p_partkey % 4 WHEN 0 THEN 'Annual reports' WHEN 1 THEN 'Årsredovisningar' WHEN 2 THEN 'Press' END AS heading FROM {part}
"""

#: Titles with years and ranges of years.
RANGES = """
SELECT p_partkey, CASE p_partkey % 14 WHEN 0 THEN 'Report 09-10' WHEN 1 THEN 'Report 1213' WHEN 2 THEN 'Report 23-24' WHEN 3 THEN 'Report 2324' WHEN 4 THEN 'Report 2425' WHEN 5 THEN 'Report 22_23'
    WHEN 6 THEN 'Report 20-21' WHEN 7 THEN 'Report 9900' WHEN 8 THEN 'Nothing' WHEN 9 THEN 'Report 2019' WHEN 10 THEN 'Report 2025' WHEN 11 THEN 'Report 97-98 and 24-25'
    WHEN 12 THEN 'Report 1919' WHEN 13 THEN 'Report 2526 draft' END AS text, concat('https://ir.example.com/', CASE p_size % 3 WHEN 0 THEN 'a.pdf' WHEN 1 THEN 'a-0708.pdf' ELSE 'report-2022/x.pdf' END) AS url FROM {part}
"""

#: Fetches in order per user and event type; errors are failed downloads.
FETCHES = """
SELECT event_id AS ord, user_id AS company_id, concat('host', CAST(event_id % 3 AS STRING)) AS host, event_type, CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 403 ELSE 500 END ELSE 200 END AS status,
  CAST(floor(value * 100) AS BIGINT) AS duration_ms FROM {events}
"""


def spread(spark: SparkSession, table: DataFrame) -> DataFrame:
    """The rows dealt out to all cores, four parts each. A table of short rows may be one group of one file, which one task reads alone, however much is made of a row afterwards; only
    the columns that are needed are dealt out."""
    return table.repartition(4 * spark.sparkContext.defaultParallelism)


def frame(spark: SparkSession, sf_dir: str, sql: str, dealt: bool = False) -> DataFrame:
    """The rendered input over the Parquet tables, whose rows are dealt out first where much work is done on each."""
    names = [t for t in ("customer", "orders", "lineitem", "events", "part", "supplier", "nation", "pages", "documents", "benchmark") if "{" + t + "}" in sql]
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(sql, **{t: spread(spark, read(t)) if dealt else read(t) for t in names})


def text(sql: str) -> str:
    """The same input for the checking database."""
    for t in ("customer", "orders", "lineitem", "events", "part", "supplier", "nation", "pages", "documents", "benchmark"):
        sql = sql.replace("{" + t + "}", t)
    return sql
