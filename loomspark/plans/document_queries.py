"""Is a document an annual report, and the company's own? Texts are the documents' with rendered wording around them."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loomspark.functions import texts
from loomspark.operators import documents as dc
from loomspark.operators import narrative, report
from loomspark.plans import surrogate
from loomspark.plans.registry import query

_HEADS = "CASE doc_id % 9 WHEN 0 THEN 'Corporate governance report' WHEN 1 THEN 'Interim report Q2 2024' WHEN 2 THEN 'Q4 2024 and full-year figures' WHEN 3 THEN 'Januari – mars' WHEN 5 THEN 'Bolagsstyrningsrapport' WHEN 6 THEN 'The fourth quarter' WHEN 7 THEN 'Remuneration report, annual results' ELSE '' END"
_TAILS = "CASE doc_id % 7 WHEN 0 THEN 'Consolidated income statement, consolidated balance sheet, directors report' WHEN 1 THEN 'Resultaträkning' WHEN 2 THEN 'revenue' WHEN 4 THEN 'Net interest income. Balansräkning. Förvaltningsberättelse. Årsredovisning' WHEN 5 THEN 'Annual report. Income statement. Balance sheet' ELSE '' END"
WORDED = f"SELECT doc_id, CASE WHEN doc_id % 11 <> 3 THEN concat({_HEADS}, ' ', coalesce(text, ''), ' ', {_TAILS}) END AS text FROM {{documents}}"
_W = surrogate.text(WORDED)

_I = "regexp_matches(t, 'resultaträkning|income\\s+statement|statement\\s+of\\s+(income|profit|loss|comprehensive\\s+income)|statements?\\s+of\\s+operations|rapport\\s+(?:över|over)\\s+totalresultat|\\bprofit\\s+before\\s+tax\\b|\\bresult\\s+before\\s+tax\\b|\\bnet\\s+interest\\s+income\\b|\\boperating\\s+income\\b')"
_MARKS = " + ".join(
    f"CAST(regexp_matches(t, '{p}') AS INT)"
    for p in (
        "consolidated\\s+(income\\s+statement|statement\\s+of\\s+(income|profit|loss))",
        "resultaträkning",
        "consolidated\\s+(balance\\s+sheet|statement\\s+of\\s+financial\\s+position)",
        "balansräkning",
        "income\\s+statement",
        "balance\\s+sheet",
        "annual\\s+report",
        "årsredovisning",
        "directors['']?\\s+report",
        "förvaltningsberättelse",
    )
)
_CHECK = f"""SELECT doc_id, n_chars, i AS income_statement, b AS balance_sheet, CAST(n AS INT) AS markers, q AND NOT (n >= 4 AND i AND b) AND NOT (c AND i) AS quarterly, g AND n < 3 AS governance, any_figures FROM (SELECT doc_id, length(t) AS n_chars, {_I} AS i,
  regexp_matches(t, 'balansräkning|balance\\s+sheet|statement\\s+of\\s+financial\\s+position') AS b, {_MARKS} AS n, regexp_matches(t[:5000], '\\bq[1-4]\\s+[0-9]{{4}}\\b|\\binterim\\s+report\\b|\\bdelårsrapport\\b|\\bquarterly\\s+report\\b|\\bfirst\\s+quarter\\b|\\bsecond\\s+quarter\\b|\\bthird\\s+quarter\\b|\\bfourth\\s+quarter\\b|\\bjanuary\\s*[-–]\\s*(?:march|june|september)\\b|\\bjanuari\\s*[-–]\\s*(?:mars|juni|september)\\b') AS q,
  regexp_matches(t[:5000], '\\bcorporate\\s+governance\\s+report\\b|\\bbolagsstyrningsrapport\\b|\\bremuneration\\s+report\\b|\\bersättningsrapport\\b') AS g, regexp_matches(t[:5000], '\\bfull[- ]year\\b|\\bannual\\s+results\\b|\\bfull\\s+year\\s+results\\b|\\bfiscal\\s+year\\s+ended\\b') AS c,
  regexp_matches(t, 'intäkter|revenue|nettoomsättning|resultat') AS any_figures FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM ({_W}) w) x) y"""


@query(f"SELECT doc_id, income_statement, balance_sheet, markers, quarterly, governance, NOT quarterly AND NOT governance AND (income_statement OR markers >= 2) AS annual FROM ({_CHECK}) c")
def content_check(spark, d):
    return surrogate.frame(spark, d, WORDED).select("doc_id", dc.content_check(F.col("text")).alias("c")).select("doc_id", "c.*")


@query(f"""SELECT doc_id, CASE WHEN n_chars < least THEN concat('text too short (', n_chars, ' chars)') WHEN NOT income_statement AND NOT any_figures THEN 'no income statement signals' WHEN governance THEN 'governance report' WHEN quarterly THEN 'quarterly report' END AS reason
FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 3200 ELSE 5000 END AS least FROM ({_CHECK}) c) x""")
def annual_gate(spark, d):
    """With the banks' lower limit for every third document."""
    least = F.when(F.col("doc_id") % 3 == 0, dc.LEAST_CHARS_BANK).otherwise(dc.LEAST_CHARS)
    return surrogate.frame(spark, d, WORDED).select("doc_id", dc.quality_reason(F.col("text"), dc.content_check(F.col("text")), least).alias("reason"))


#: Three companies: a plain name, an ampersand brand, a short name.
_COMPANIES = [
    (0, "Norrvik Industri AB (publ)", "Norrvik", "Norrvik Industri", ["norrvik", "industri"], ["Norrvik"], "NORV-B.ST", "556012-1234", ["Norrvik Works"], "low"),
    (1, "H & M Vester & Moritz AB", "H&M", "H&M", ["vester", "moritz"], ["H&M"], "hm-b.st", None, [], "high"),
    (2, "Tal AB", "Tal", "Tal", [], [], "TAL", "5560991", ["TalCo"], "high"),
]
#: Their terms as worked out by hand.
_TERMS = """SELECT * FROM (VALUES (0, 1, 'Norrvik Industri AB (publ)', 'legal:full'), (0, 2, 'Norrvik Industri', 'legal:stripped-suffix'), (0, 3, 'Norrvik', 'display:name'), (0, 4, 'industri', 'entity:brand-token'), (0, 5, 'NORV B', 'ticker:variant'), (0, 6, 'NORV-B', 'ticker:variant'), (0, 7, 'NORV', 'ticker:variant'),
(0, 8, '556012-1234', 'org:formatted'), (0, 9, '5560121234', 'org:digits'), (0, 10, 'Norrvik Works', 'alias:known'), (1, 1, 'H & M Vester & Moritz AB', 'legal:full'), (1, 2, 'H & M Vester & Moritz', 'legal:stripped-suffix'), (1, 3, 'H&M Vester & Moritz', 'legal:collapsed-spacing'), (1, 4, 'H&M Vester & Moritz AB', 'legal:collapsed-full'),
(1, 5, 'H&M', 'legal:ampersand-fragment'), (1, 6, 'moritz', 'entity:brand-token'), (1, 7, 'vester', 'entity:distinctive-token'), (1, 8, 'HM B', 'ticker:variant'), (1, 9, 'HM-B', 'ticker:variant'), (1, 10, 'HM', 'ticker:variant'), (2, 1, 'Tal AB', 'legal:full'), (2, 2, 'Tal', 'legal:stripped-suffix'), (2, 3, '5560991', 'org:formatted'), (2, 4, 'TalCo', 'alias:known')) t(k, ord, needle, provenance)"""


def _companies(spark: SparkSession):
    rows = spark.createDataFrame(_COMPANIES, "k int, legal string, display string, anchor string, tokens array<string>, short array<string>, ticker string, org string, aliases array<string>, ambiguity string")
    return rows.withColumn("terms", dc.entity_terms(*map(F.col, ("legal", "display", "anchor", "tokens", "short", "ticker", "org", "aliases"))))


@query(f"SELECT k, CAST(ord AS INT) AS ord, needle, provenance FROM ({_TERMS}) t")
def entity_terms(spark, d):
    found = _companies(spark).select("k", F.posexplode("terms").alias("ord", "t"))
    return found.select("k", (F.col("ord") + 1).alias("ord"), "t.needle", "t.provenance")


MENTIONS = """SELECT doc_id, CAST(floor(doc_id / 10) % 3 AS INT) AS k, CASE doc_id % 10 WHEN 0 THEN concat(repeat('lorem ', 50), 'of NORRVIK and vester') WHEN 1 THEN concat(repeat('x ', 3500), 'Norrvik Industri AB (publ); H & M Vester & Moritz AB; Tal AB') WHEN 2 THEN 'only TAL here' WHEN 3 THEN 'the h&m brand'
  WHEN 4 THEN concat(repeat('y ', 6500), 'Norrvik Works TalCo') WHEN 5 THEN concat(repeat('y ', 5000), 'Norrvik Works TalCo h&m') WHEN 6 THEN 'HM B and Moritzes' WHEN 7 THEN 'hm b alone, tal alone' WHEN 8 THEN text ELSE 'org 556012-1234 and 5560991' END AS text FROM {documents}"""


@query(f"""WITH t AS ({_TERMS}), m AS (SELECT doc_id, k, lower(coalesce(text, '')[:6000]) AS near, lower(coalesce(text, '')[:12000]) AS far FROM ({surrogate.text(MENTIONS)}) x),
n AS (SELECT m.doc_id, t.*, contains(near, lower(needle)) AND (m.k = 0 OR length(needle) >= 5 OR contains(needle, '&') OR (m.k = 1 AND (contains(near, 'vester') OR contains(near, 'moritz')))) AS is_near, regexp_matches(provenance, '^(legal|org|alias):') AND contains(far, lower(needle)) AS is_far FROM m JOIN t ON m.k = t.k),
b AS (SELECT doc_id, min(CASE WHEN is_near THEN ord END) AS a, min(CASE WHEN is_far THEN ord END) AS f FROM n GROUP BY 1)
SELECT b.doc_id, t.ord IS NOT NULL AS passed, concat(t.provenance, ':' || t.needle) AS term, CASE WHEN a IS NULL AND f IS NOT NULL THEN 'first-12000-chars-strong' ELSE 'first-6000-chars' END AS region FROM b JOIN m ON b.doc_id = m.doc_id LEFT JOIN t ON t.k = m.k AND t.ord = coalesce(a, f)""".replace("concat(t.provenance, ':' || t.needle)", "t.provenance || ':' || t.needle"))
def entity_in_document(spark, d):
    named = surrogate.frame(spark, d, MENTIONS).join(F.broadcast(_companies(spark).select("k", "terms", "ambiguity", "tokens")), "k")
    return named.select("doc_id", dc.entity_check(F.col("text"), F.col("terms"), F.col("ambiguity"), F.col("tokens")).alias("c")).select("doc_id", "c.*")


_VOTES = "CASE doc_id % 6 WHEN 0 THEN 'Substansvärde, Net Asset Value, investmentbolag' WHEN 1 THEN 'Net interest income and credit losses' WHEN 2 THEN 'Rental income of investment properties' WHEN 3 THEN 'Portfolio companies; net asset value; deposits from the public' WHEN 4 THEN 'räntenetto' ELSE 'förvaltningsresultat hyresintäkter kreditförluster räntenetto' END"


def _votes(*words: str) -> str:
    return " + ".join(f"CAST(contains(t, '{w}') AS INT)" for w in words)


@query(f"""SELECT doc_id, CASE WHEN {_votes('substansvärde', 'net asset value', 'investmentbolag', 'portfolio companies', 'investment company')} >= 3 THEN 'investment_company' WHEN {_votes('net interest income', 'räntenetto', 'credit losses', 'kreditförluster', 'deposits from')} >= 2 THEN 'bank'
WHEN {_votes('förvaltningsresultat', 'rental income', 'hyresintäkter', 'investment properties', 'fastighetsbestånd')} >= 2 THEN 'real_estate' ELSE 'industrial' END AS kind FROM (SELECT doc_id, lower(concat({_VOTES}, ' ', coalesce(text, ''))[:30000]) AS t FROM documents) x""")
def company_type(spark, d):
    """The shipped signals. The first 30,000 characters are the rule's own."""
    worded = surrogate.frame(spark, d, f"SELECT doc_id, concat({_VOTES}, ' ', coalesce(text, '')) AS text FROM {{documents}}")
    return worded.select("doc_id", texts.vote_type(F.col("text")).alias("kind"))


@query("""SELECT p_partkey, CASE WHEN n = 0 OR p_partkey % 4 IN (0, 1) AND n <= 1 THEN 'high' WHEN n = 1 THEN 'medium' ELSE 'low' END AS level, CASE WHEN p_size % 5 = 0 THEN 'bank' WHEN p_size % 5 = 1 THEN 'real_estate' WHEN p_size % 5 = 2 THEN 'investment_company' ELSE 'industrial' END AS hint, array_to_string(w, ',') AS tokens
FROM (SELECT *, len(w) AS n FROM (SELECT p_partkey, p_size, list_filter(list_distinct_keep, lambda x: length(x) >= 5 AND x NOT IN ('group', 'holding', 'holdings', 'company', 'international', 'limited', 'sweden', 'nordic', 'publ')) AS w
FROM (SELECT p_partkey, p_size, [x for i, x in a if list_position(a, x) = i] AS list_distinct_keep FROM (SELECT p_partkey, p_size, list_concat(string_split(lower(p_name), ' '), CASE p_size % 5 WHEN 0 THEN ['bank'] WHEN 1 THEN ['fastighets', 'group'] WHEN 2 THEN ['invest', 'nordic'] ELSE [] END) AS a FROM part) b) c) e) f""".replace("[x for i, x in a if list_position(a, x) = i]", "list_filter(a, lambda x, i: list_position(a, x) = i)"))
def name_profile(spark, d):
    """Distinctive words, how easily a name is mistaken, and the hint that a name gives of its business."""
    part = spark.read.parquet(f"{d}/part.parquet")
    i = F.col("p_size") % 5
    name = F.concat("p_name", F.when(i == 0, " (ABC Company) Bank").when(i == 1, " Fastighets, Group").when(i == 2, " Invest / Nordic").otherwise(""))
    j = F.col("p_partkey") % 4
    ticker = F.when(j == 0, "ABC.ST").when(j == 1, "AB-B.ST").when(j == 2, "ABCDE.ST")
    return part.select("p_partkey", texts.ambiguity(name, ticker).alias("level"), texts.model_hint(name).alias("hint"), F.array_join(texts.distinctive_tokens(name), ",").alias("tokens"))


# --- whole reports ------------------------------------------------------------------------------------------------------------------

#: A report per company in one of four layouts, with decoys on its page of key figures and in its segments.
REPORTS = """SELECT c_custkey AS doc_id, concat('Firm', CAST(c_custkey AS STRING), ' AB') AS company, 10000 + c_custkey * 7 % 80000 AS revenue, concat_ws('\n', 'Annual report 2024', 'Amounts in MSEK',
  CASE WHEN c_custkey % 5 = 1 THEN 'Chairman Otto Grahn' ELSE 'A year of change' END, CASE WHEN c_custkey % 5 = 0 THEN 'Former CEO Bertil Falk' END, 'about us', 'our work',
  CASE c_custkey % 5 WHEN 0 THEN 'President and CEO Anna Svensson' WHEN 1 THEN 'President and CEO' WHEN 2 THEN 'CEO North America' WHEN 3 THEN 'Maria Holm' ELSE 'nobody' END, CASE c_custkey % 5 WHEN 1 THEN 'Erik von Berg' WHEN 3 THEN 'Chief Executive Officer' ELSE 'and so on' END, 'more words', CASE WHEN c_custkey % 5 = 2 THEN 'CEO Eva Lind' END,
  CASE WHEN c_custkey % 3 = 0 THEN 'Key figures' END, CASE WHEN c_custkey % 3 = 0 THEN 'Net sales  1 111  1 000' END, CASE WHEN c_custkey % 3 = 0 THEN 'Operating profit  222  200' END, repeat('Filler line\n', 45), 'Segment information', 'Net sales  3 333  3 000', 'Operating profit  333  300', repeat('Filler line\n', 45),
  CASE WHEN c_custkey % 4 <> 3 THEN CASE WHEN c_custkey % 4 = 1 THEN 'Moderbolagets resultaträkning' ELSE 'Consolidated income statement' END END, CASE WHEN c_custkey % 4 <> 3 THEN 'SEK m  2024  2023' END,
  CASE WHEN c_custkey % 4 <> 3 THEN concat('Net sales  ', CAST(10000 + c_custkey * 7 % 80000 AS STRING), '  9000') END,
  CASE c_custkey % 4 WHEN 0 THEN concat('Operating profit  ', CAST(900 + c_custkey % 1000 AS STRING), '  800') WHEN 1 THEN 'Operating margin 10%' WHEN 2 THEN concat('EBITA  ', CAST(900 + c_custkey % 1000 AS STRING), '  800') END, CASE WHEN c_custkey % 4 = 2 THEN 'Amortisation  -100  -90' END, CASE WHEN c_custkey % 4 <> 3 THEN 'Tax  -10  -9' END, CASE WHEN c_custkey % 4 <> 3 THEN 'Net result  500  400' END,
  CASE WHEN c_custkey % 6 < 2 THEN 'Average number of employees  2 345  2 000' WHEN c_custkey % 6 < 4 THEN 'A workforce of 12,345 and a headcount of 900' END) AS text FROM {customer}"""
_REPORTS = surrogate.text(REPORTS).replace("AS STRING", "AS VARCHAR").replace("'\n'", "chr(10)").replace("'Filler line\n'", "concat('Filler line', chr(10))")


@query("""SELECT c_custkey AS doc_id, 'industrial' AS company_type, 'msek' AS unit, CASE WHEN c_custkey % 4 <> 3 THEN r WHEN c_custkey % 3 = 0 THEN CAST(1111 AS DOUBLE) END AS revenue,
CASE WHEN c_custkey % 4 = 0 THEN p WHEN c_custkey % 3 = 0 THEN CAST(222 AS DOUBLE) WHEN c_custkey % 4 = 1 THEN floor(r / 10 + 0.5) WHEN c_custkey % 4 = 2 THEN p - 100 END AS ebit, CAST(CASE WHEN c_custkey % 6 < 2 THEN 2345 WHEN c_custkey % 6 < 4 THEN 12345 END AS DOUBLE) AS employees,
CASE c_custkey % 5 WHEN 0 THEN 'Anna Svensson' WHEN 1 THEN 'Erik von Berg' WHEN 2 THEN 'Eva Lind' WHEN 3 THEN 'Maria Holm' END AS ceo, 2024 AS fiscal_year FROM (SELECT c_custkey, CAST(10000 + c_custkey * 7 % 80000 AS DOUBLE) AS r, CAST(900 + c_custkey % 1000 AS DOUBLE) AS p FROM customer) c""")
def report_fields(spark, d):
    """The assembled extraction over rendered reports; the database knows what they were made from."""
    # The table they are rendered from may be one file of short rows; the reports are what weighs.
    return report.extract_reports(surrogate.frame(spark, d, REPORTS, dealt=True), 2024).drop("notes")


@query("SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 4 IN (0, 1, 2) THEN 1 ELSE 0 END AS n_sections, c_custkey % 4 = 1 AS parent, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS n_highlights, true AS in_segment FROM customer")
def report_sections(spark, d):
    lines = surrogate.frame(spark, d, REPORTS, dealt=True).select("doc_id", report.report_lines(F.col("text")).alias("lines"))
    places = lines.withColumn("places", report.structure(F.col("lines")))
    row = F.get(F.filter("lines", lambda x: x["line"].startswith("Net sales  3 333")), F.lit(0))["no"]
    first = F.get("places.sections", F.lit(0))
    return places.select("doc_id", F.size("places.sections").alias("n_sections"), F.coalesce(first["parent"], F.lit(False)).alias("parent"), F.size("places.highlights").alias("n_highlights"), report.in_segment(F.col("places"), row).alias("in_segment"))


NARRATIVES = """SELECT doc_id, concat(CASE doc_id % 6 WHEN 0 THEN concat('Sales, SEK billion: ', CAST(1 + doc_id % 90 AS STRING)) WHEN 1 THEN concat('The group had revenues of BSEK ', CAST(2 + doc_id % 70 AS STRING), '.5') WHEN 2 THEN 'Our target is revenues of BSEK 90' WHEN 3 THEN concat('Net sales amounted to SEK ', CAST(10 + doc_id % 80 AS STRING), ',427m') WHEN 4 THEN 'revenues of BSEK 0.2' ELSE '' END, '. ',
  CASE doc_id % 5 WHEN 0 THEN 'a workforce of 14,500 and about 12,200 employees' WHEN 1 THEN concat('Koncernen hade ', CAST(10 + doc_id % 80 AS STRING), ' 345 anställda') WHEN 2 THEN 'employs 45 people' WHEN 3 THEN 'The number of employees increased from 900 to 11,000' ELSE '' END) AS text FROM {documents}"""


@query("""SELECT doc_id, CAST(CASE doc_id % 6 WHEN 0 THEN 1000 * (1 + doc_id % 90) WHEN 1 THEN 1000 * (2 + doc_id % 70) + 500 WHEN 3 THEN 1000 * (10 + doc_id % 80) + 427 END AS DOUBLE) AS revenue, CAST(CASE doc_id % 5 WHEN 0 THEN 14500 WHEN 1 THEN 1000 * (10 + doc_id % 80) + 345 WHEN 3 THEN 11000 END AS DOUBLE) AS employees FROM documents""")
def narrative_figures(spark, d):
    t = surrogate.frame(spark, d, NARRATIVES)
    return t.select("doc_id", narrative.narrative_revenue(F.col("text")).alias("revenue"), narrative.narrative_employees(F.col("text")).alias("employees"))


_WORDS = "CASE c_custkey % 8 WHEN 0 THEN 'Anna Svensson' WHEN 1 THEN 'Group Management' WHEN 2 THEN 'North America' WHEN 3 THEN 'Firm Nord' WHEN 4 THEN 'The Board' WHEN 5 THEN 'Investor Relations' WHEN 6 THEN 'Eva Holding' ELSE 'Carl af Ek' END"


@query(f"SELECT c_custkey, c_custkey % 8 NOT IN (1, 4, 6) AS person, c_custkey % 8 IN (2, 3, 5) AS rejected, c_custkey % 3 = 0 AS parent FROM (SELECT c_custkey, {_WORDS} AS name FROM customer) c")
def name_checks(spark, d):
    name = F.expr(_WORDS)
    heading = F.when(F.col("c_custkey") % 3 == 0, "Parent company income statement").when(F.col("c_custkey") % 3 == 1, "Koncernens och moderbolagets resultaträkning").otherwise("Income statement")
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select("c_custkey", (~report.no_name(name)).alias("person"), report.rejected_name(name, F.lit("Firm Nord AB")).alias("rejected"), report.parent_only(heading).alias("parent"))
