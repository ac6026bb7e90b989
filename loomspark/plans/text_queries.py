"""Lines, labels, units and document checks; the rendered reports that are parsed back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions import numbers as num
from loomspark.functions import texts
from loomspark.operators import extract
from loomspark.operators import lines as ln
from loomspark.plans import surrogate
from loomspark.plans.registry import query

LABELS = ["of the", "with", "de la", "und", "que"]
HEADING = r"^[A-ZÀ-Ý][^.,]{0,30}\.$"
_LINES = "SELECT doc_id, line_no, line FROM (SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) d) x WHERE trim(line) <> ''"


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def lines(spark: SparkSession, d: str) -> DataFrame:
    return ln.explode_lines(documents(spark, d))


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, CAST(length(line) AS INT) AS n FROM ({_LINES}) l")
def line_explode(spark, d):
    return lines(spark, d).select("doc_id", "line_no", F.length("line").alias("n"))


_TRIES = " UNION ALL ".join(
    f"SELECT doc_id, {p} AS p, {k} AS k, line_no FROM l WHERE length(line) <= {longest} AND instr(lower(line), '{label}') BETWEEN 1 AND {offset + 1}" for p, (longest, offset) in enumerate(((150, 60), (500, 200))) for k, label in enumerate(LABELS)
)


@query(f"WITH l AS ({_LINES}), t AS ({_TRIES}), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p, k, line_no) AS n FROM t) SELECT doc_id, [{', '.join(repr(x) for x in LABELS)}][k + 1] AS label, CAST(line_no AS INT) AS line_no, CAST(p AS INT) AS pass_no FROM n WHERE n = 1")
def label_first_match(spark, d):
    return ln.label_first_match(documents(spark, d), LABELS)


_KIND = f"CASE WHEN regexp_matches(line, '{HEADING}') THEN 'heading' WHEN length(line) > 400 THEN 'statement' END"


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, last_value({_KIND} IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 40 PRECEDING AND CURRENT ROW) AS above FROM ({_LINES}) l")
def asof_heading(spark, d):
    kind = lambda line: F.when(line.rlike(HEADING), "heading").when(F.length(line) > 400, "statement")
    return ln.nearest_above(documents(spark, d), kind, 40).select("doc_id", "line_no", "above")


_H = "CASE WHEN len(regexp_extract_all(line, '([a-z]*tion)', 1)) >= 2 THEN array_to_string(regexp_extract_all(line, '([a-z]*tion)', 1), ',') END"


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, coalesce(lag(h, 1) OVER w, lag(h, 2) OVER w, lag(h, 3) OVER w) AS header FROM (SELECT doc_id, line_no, {_H} AS h FROM ({_LINES}) l) x WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)")
def header_lookup(spark, d):
    return ln.header_years(documents(spark, d), pattern="([a-z]*tion)").select("doc_id", "line_no", "header")


_E = f"""SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY doc_id) AS total, {_KIND} = 'heading' AND {_KIND} IS NOT NULL AS start, {_KIND} IS NOT NULL AS edge FROM ({_LINES}) l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)"""


@query(f"SELECT doc_id, CAST(n AS INT) AS first_row, CAST(least(coalesce(nxt - 1, total), n + 79) AS INT) AS last_row FROM (SELECT *, min(CASE WHEN edge THEN n END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM ({_E}) e) x WHERE start")
def section_windows(spark, d):
    return ln.sections(documents(spark, d), lambda line: line.rlike(HEADING), lambda line: ~line.rlike(HEADING) & (F.length(line) > 400))


@query(f"WITH l AS ({_LINES}), a AS (SELECT * FROM l WHERE length(line) < 60), b AS (SELECT * FROM l WHERE length(line) > 300) SELECT a.doc_id, CAST(a.line_no AS INT) AS l_line, CAST(min(b.line_no) AS INT) AS r_line FROM a JOIN b ON a.doc_id = b.doc_id AND abs(a.line_no - b.line_no) <= 15 GROUP BY 1, 2")
def range_pair(spark, d):
    return ln.pair_within(documents(spark, d), lambda line: F.length(line) < 60, lambda line: F.length(line) > 300, 15)


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, md5(array_to_string(array_agg(line) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), '|')) AS context FROM ({_LINES}) l")
def context_window(spark, d):
    return ln.context(documents(spark, d), 2, 2).select("doc_id", "line_no", F.md5(F.col("context").cast("binary")).alias("context"))


@query(f"""WITH r AS (SELECT *, sum(CASE WHEN start THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS run FROM ({_E}) e), m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY n) - 1 AS k FROM r WHERE run > 0)
SELECT doc_id, CAST(run AS INT) AS run, CAST(sum(length(line)) AS BIGINT) AS total, count(*) AS n FROM m WHERE k BETWEEN 1 AND 22 GROUP BY 1, 2 HAVING count(*) >= 2""")
def segment_sums(spark, d):
    sums = ln.segment_sums(documents(spark, d), lambda line: line.rlike(HEADING), lambda line: F.length(line).cast("double"))
    return sums.withColumn("total", F.col("total").cast("long"))


@query("SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '\\n{4,}', chr(10) || chr(10) || chr(10), 'g')) AS digest FROM documents")
def whitespace_normalise(spark, d):
    return documents(spark, d).select("doc_id", F.md5(texts.normalise_space(F.col("text")).cast("binary")).alias("digest"))


_SIGNALS = {"investment_company": ("tion", "ment", "eaux", "elle"), "bank": ("schaft", "lich", "keit"), "real_estate": ("ción", "miento", "ando")}


def _votes(name: str) -> str:
    return " + ".join(f"CASE WHEN contains(t, '{w}') THEN 1 ELSE 0 END" for w in _SIGNALS[name])


@query(f"SELECT doc_id, CASE WHEN {_votes('investment_company')} >= 3 THEN 'investment_company' WHEN {_votes('bank')} >= 2 THEN 'bank' WHEN {_votes('real_estate')} >= 2 THEN 'real_estate' ELSE 'industrial' END AS kind FROM (SELECT doc_id, lower(substring(text, 1, 30000)) AS t FROM documents) x")
def type_vote(spark, d):
    return documents(spark, d).select("doc_id", texts.vote_type(F.col("text"), _SIGNALS).alias("kind"))


@query("SELECT doc_id, CASE WHEN length(coalesce(text, '')) < 800 THEN 'too_short' WHEN NOT regexp_matches(lower(text), 'tion|lich') THEN 'no_statement' WHEN regexp_matches(lower(substring(text, 1, 5000)), 'ando|keit') THEN 'wrong_type' ELSE 'pass' END AS verdict FROM documents")
def quality_gate(spark, d):
    return documents(spark, d).select("doc_id", texts.document_gate(F.col("text"), 800, "tion|lich", "ando|keit").alias("verdict"))


@query("SELECT doc_id, CAST(CASE WHEN length(text) > 0 THEN least(9, floor(((doc_id % length(text)) + 1 - 1) * 9 / length(text)) + 1) END AS INT) AS page FROM documents")
def page_estimate(spark, d):
    n = F.length("text")
    return documents(spark, d).select("doc_id", texts.page_estimate(F.col("doc_id") % F.when(n > 0, n) + 1, n, F.lit(9)).alias("page"))


_FOLD = "lower(trim(regexp_replace({}, '\\s+', ' ', 'g')))"


@query(f"SELECT doc_id, length({_FOLD.format('quote')}) >= 12 AND contains({_FOLD.format('text')}, {_FOLD.format('quote')}) AS verified FROM (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN concat('x', substring(text, 20, 40)) ELSE replace(substring(text, 20, CAST(5 + doc_id % 40 AS INT)), ' ', chr(10) || ' ') END AS quote FROM documents) x")
def quote_verify(spark, d):
    quote = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x"), F.substring("text", 20, 40))).otherwise(F.regexp_replace(F.expr("substring(text, 20, CAST(5 + doc_id % 40 AS INT))"), " ", "\n "))
    return documents(spark, d).select("doc_id", texts.quote_verified(F.col("text"), quote).alias("verified"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, len(list_filter(string_split(lower(p_name), ' '), lambda w: length(w) >= 5)) AS tokens FROM part")
def name_tokens(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    kept = F.filter(F.split(F.lower("p_name"), " "), lambda w: F.length(w) >= 5)
    return part.select("p_partkey", texts.slug(F.col("p_name")).alias("slug"), F.size(kept).cast("long").alias("tokens"))


# --- rendered reports ---------------------------------------------------------------------------------------------------------------

_TRUTH = f"SELECT company_id, r_value AS value, CASE company_id % 5 WHEN 0 THEN 'msek' WHEN 1 THEN 'ksek' WHEN 2 THEN 'eur_m' WHEN 3 THEN 'usd_m' ELSE 'gbp_m' END AS unit FROM (SELECT company_id, CAST(abs(coalesce(revenue, 7)) AS BIGINT) % 900000 + 2100 AS r_value FROM ({surrogate.RESULTS}) x) y"
_FACTOR = "CASE unit WHEN 'msek' THEN 1.0 WHEN 'ksek' THEN 0.001 WHEN 'eur_m' THEN 11.25 WHEN 'usd_m' THEN 10.8 ELSE 13.5 END"


def reports(spark: SparkSession, d: str) -> DataFrame:
    """A small report per company: unit statement, year header, decoys, and the figure with one of four separators."""
    truth = surrogate.frame(spark, d, _TRUTH)
    grouped = F.format_number("value", 0)
    figure = F.when(F.col("company_id") % 4 == 0, grouped).when(F.col("company_id") % 4 == 1, F.regexp_replace(grouped, ",", " ")).when(F.col("company_id") % 4 == 2, F.col("value").cast("string")).otherwise(F.concat(F.lit("("), grouped, F.lit(")")))
    words = F.element_at(F.create_map(*(F.lit(x) for x in ("msek", "Amounts in SEK m", "ksek", "Amounts in SEK thousands", "eur_m", "All figures in MEUR", "usd_m", "Figures in USD million", "gbp_m", "Amounts in GBP million"))), F.col("unit"))
    text = F.concat_ws("\n", F.lit("Annual report"), words, F.lit("Notes  2024  2023"), F.lit("Income statement"), F.lit("Note  2024  2023"), F.concat(F.lit("Other net sales items  9  12 345  1")), F.concat(F.lit("Revenue  5  "), F.lit("77  66")), F.concat(F.lit("Net sales  "), figure, F.lit("  1,234")), F.lit("Operating profit  55  44"))
    return truth.withColumn("text", text)


@query(f"SELECT company_id, unit, round(CAST(CASE WHEN company_id % 4 = 3 THEN -value ELSE value END AS DOUBLE) * CAST({_FACTOR} AS DOUBLE), 3) AS revenue FROM ({surrogate.text(_TRUTH)}) t")
def render_parse_roundtrip(spark, d):
    """The database computes the expected figure from the orders; it doesn't share the parsing."""
    found = extract.labelled_figure(reports(spark, d).select(F.col("company_id").alias("doc_id"), "text"), ["net sales", "revenue"], year="2024")
    return found.select(F.col("doc_id").alias("company_id"), "unit", F.round("msek", 3).alias("revenue"))


@query(f"""SELECT company_id, CAST(CASE company_id % 6 WHEN 2 THEN -value WHEN 3 THEN -value WHEN 4 THEN value + 0.5 WHEN 5 THEN NULL ELSE value END AS DOUBLE) AS value, company_id % 7 = 0 OR regexp_matches(CAST(value AS VARCHAR), '(20[0-9][0-9]){{2}}') AS fused
FROM (SELECT company_id, CASE WHEN company_id % 7 = 0 THEN 20232024 ELSE value END AS value FROM ({surrogate.text(_TRUTH)}) t) x""")
def parse_numbers(spark, d):
    """Thousands by commas and spaces, brackets, minus signs, a decimal comma, and what is no number."""
    truth = surrogate.frame(spark, d, _TRUTH).withColumn("value", F.when(F.col("company_id") % 7 == 0, F.lit(20232024)).otherwise(F.col("value")))
    grouped, plain, i = F.format_number("value", 0), F.col("value").cast("string"), F.col("company_id") % 6
    cell = (
        F.when(i == 0, F.concat(F.lit("SEK "), grouped, F.lit(" m")))
        .when(i == 1, F.regexp_replace(grouped, ",", " "))
        .when(i == 2, F.concat(F.lit("("), grouped, F.lit(")")))
        .when(i == 3, F.concat(F.lit("−"), plain))
        .when(i == 4, F.concat(plain, F.lit(",5")))
        .otherwise("n/a")
    )
    return truth.select("company_id", num.parse_number(cell).alias("value"), num.fused_years(F.col("value")).alias("fused"))


@query(f"SELECT company_id, unit FROM ({surrogate.text(_TRUTH)}) t")
def unit_detection(spark, d):
    return reports(spark, d).select("company_id", num.unit_context(F.col("text")).alias("unit"))
