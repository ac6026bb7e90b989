"""Sources: result files, the registry, lists, fetch logs, reports and sitemaps. Nothing is fetched over the network; snapshots are read as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = (
    "company string, ticker string, website string, irPage string, annualReportUrl string, fiscalYear int, extractedData struct<revenue_msek: double, ebit_msek: double, employees: double, ceo: string, fiscal_year: int>, "
    "dataSource string, confidence int, status string, fallbackStepReached string, detectedCompanyType string, cached boolean, extractionNotes array<string>"
)
FETCH_SCHEMA = "url string, final_url string, host string, status int, content_type string, body string, response_ms bigint, redirected boolean, transport string, ord bigint, error string"


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """``value``: each file as one text. A missing path gives no rows."""
    try:
        return spark.read.text(path, wholetext=True)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], "value string")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result rows of an envelope ``{generatedAt, companyCount, results}`` or a bare array; malformed files give none."""
    return parse_results(whole_files(spark, path))


def parse_results(files: DataFrame) -> DataFrame:
    """The same of texts in ``value``."""
    envelope = F.from_json("value", f"struct<generatedAt: string, results: array<struct<{_fields(RESULT_SCHEMA)}>>>")
    bare = F.from_json("value", f"array<struct<{_fields(RESULT_SCHEMA)}>>")
    rows = files.select(F.when(F.ltrim("value").startswith("["), bare).otherwise(envelope["results"]).alias("rows"))
    return rows.select(F.inline("rows"))


def _fields(schema: str) -> str:
    """DDL columns as fields of a struct type."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            name, kind = schema[start:i].strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            start = i + 1
    return ", ".join(out)


def flat_results(rows: DataFrame) -> DataFrame:
    """Result rows with the columns that the operators read."""
    e = "extractedData"
    return rows.select(
        "company",
        "ticker",
        F.col("detectedCompanyType").alias("company_type"),
        F.col(f"{e}.revenue_msek").alias("revenue"),
        F.col(f"{e}.ebit_msek").alias("ebit"),
        F.col(f"{e}.employees").alias("employees"),
        F.col(f"{e}.ceo").alias("ceo"),
        F.col("fiscalYear").alias("fiscal_year"),
        F.col(e).isNotNull().alias("has_data"),
        (F.col("status") == "timeout").alias("timed_out"),
        F.col("dataSource").alias("data_source"),
        F.col("fallbackStepReached").alias("fallback_step"),
        "confidence",
        F.lit(None).cast("string").alias("failed_stage"),
        F.col("annualReportUrl").alias("report_url"),
        F.concat_ws(" | ", "extractionNotes").alias("notes"),
    )


def _text(v: Column, path: str) -> Column:
    return F.when(F.schema_of_variant(F.variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))


def _number(v: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.variant_get(v, path, "variant"))
    return F.when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(v, path, "double"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """``ticker`` and its entry's fields. An entry is a name or an object; values of a wrong type are dropped; a manual null is told from an absent value by ``has_*``."""
    return parse_registry(whole_files(spark, path))


def parse_registry(files: DataFrame) -> DataFrame:
    """The same of texts in ``value``."""
    json = files.select(F.try_parse_json("value").alias("v")).where("v IS NOT NULL")
    entries = files.sparkSession.sql("SELECT e.key AS ticker, e.value AS v FROM {json}, LATERAL variant_explode(v) AS e WHERE e.key IS NOT NULL", json=json)
    v = F.col("v")
    plain = F.schema_of_variant(v) == "STRING"
    manual = {f: F.schema_of_variant(F.variant_get(v, f"$.manual.{f}", "variant")) for f in ("revenue_msek", "ebit_msek", "employees", "ceo")}
    urls = F.filter(F.try_variant_get(v, "$.annualReportPdfUrls", "array<string>"), lambda u: u.rlike("^https?://"))
    return entries.select(
        "ticker",
        F.when(plain, F.try_variant_get(v, "$", "string")).otherwise(_text(v, "$.name")).alias("name"),
        _text(v, "$.website").alias("website"),
        _text(v, "$.irPage").alias("ir_page"),
        _text(v, "$.orgNumber").alias("org_number"),
        _text(v, "$.companyType").alias("company_type"),
        F.coalesce(_texts(v, "$.candidateDomains"), F.array().cast("array<string>")).alias("candidate_domains"),
        F.coalesce(urls, F.array().cast("array<string>")).alias("annual_report_pdf_urls"),
        *(
            (_text(v, f"$.manual.{f}") if f == "ceo" else _number(v, f"$.manual.{f}")).alias(f"manual_{f}")
            for f in manual
        ),
        *((kind.isNotNull() & kind.rlike("^VOID$|^STRING$" if f == "ceo" else "^VOID$|^BIGINT$|^DOUBLE$|^DECIMAL")).alias(f"has_{f}") for f, kind in manual.items()),
    )


def preflight_registry(registry: DataFrame) -> DataFrame:
    """``ticker, company, ir_page, candidate_domains`` of the entries that have a name, in Swedish order."""
    rows = registry.where("name IS NOT NULL").select("ticker", F.col("name").alias("company"), "ir_page", "candidate_domains")
    return rows.orderBy(F.collate("company", "sv"), F.collate("ticker", "sv"))


def _texts(v: Column, path: str) -> Column:
    """The strings of an array; other items are dropped."""
    items = F.try_variant_get(v, path, "array<variant>")
    return F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))


def read_collision_rules(spark: SparkSession, path: str) -> DataFrame:
    return parse_collision_rules(whole_files(spark, path))


def parse_collision_rules(files: DataFrame) -> DataFrame:
    """``name_pattern, host_part``: a row for each pattern and rejected host part, as the collision filter takes them. Rules without a pattern or without host parts are dropped, a file that is no list gives none."""
    rules = files.select(F.explode(F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")).alias("v"))
    v = F.col("v")
    rows = rules.select(_text(v, "$.if_legal_name_matches").alias("name_pattern"), F.explode(_texts(v, "$.reject_host_substrings")).alias("host_part"))
    return rows.where("name_pattern IS NOT NULL").select("name_pattern", F.lower("host_part").alias("host_part"))


def read_hard_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_hard_list(whole_files(spark, path))


def parse_hard_list(files: DataFrame) -> DataFrame:
    """``kind, value``: the names (lower case) and tickers (upper case) that are always looked at twice; nothing of a malformed file."""
    v = F.try_parse_json("value")
    names = F.transform(_texts(v, "$.company_names"), lambda x: F.struct(F.lit("name").alias("kind"), F.lower(F.trim(x)).alias("value")))
    tickers = F.transform(_texts(v, "$.tickers"), lambda x: F.struct(F.lit("ticker").alias("kind"), F.upper(F.trim(x)).alias("value")))
    none = F.array().cast("array<struct<kind: string, value: string>>")
    return files.select(F.explode(F.concat(F.coalesce(names, none), F.coalesce(tickers, none))).alias("x")).select("x.*").distinct()


PREFLIGHT_ROW = "ticker string, company string, irPage string, riskScore int, riskTier string, archetypes array<string>, signals array<string>"


def read_preflight(spark: SparkSession, path: str) -> DataFrame:
    return parse_preflight(whole_files(spark, path))


def parse_preflight(files: DataFrame) -> DataFrame:
    """``generated_at, company_count, results`` of a preflight file: the count is the stated one or that of its rows; missing keys have defaults, a malformed file gives no row."""
    v = F.try_parse_json("value")
    parsed = F.from_json("value", f"struct<generatedAt: string, results: array<struct<{_fields(PREFLIGHT_ROW)}>>>")
    rows = F.coalesce(parsed["results"], F.array().cast(f"array<struct<{_fields(PREFLIGHT_ROW)}>>"))
    return files.where(v.isNotNull()).select(parsed["generatedAt"].alias("generated_at"), F.coalesce(_number(v, "$.companyCount").cast("int"), F.size(rows)).alias("company_count"), rows.alias("results"))


def read_binaries(spark: SparkSession, path: str) -> DataFrame:
    """Stored answers as bytes: ``url, length, content``. A file's name is its address in percent encoding; an empty file is a failed fetch and gives no row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where("length > 0").select(F.url_decode(F.url_decode(name)).alias("url"), "length", "content")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_list(whole_files(spark, path))


def parse_list(files: DataFrame) -> DataFrame:
    """``name``: a JSON array of strings, trimmed, without empties. Anything else raises."""
    parsed = files.select(F.from_json("value", "array<string>").alias("names"), F.ltrim("value").startswith("[").alias("ok"))
    checked = parsed.select(F.when(F.coalesce(F.col("ok") & F.col("names").isNotNull(), F.lit(False)), F.col("names")).otherwise(F.raise_error(F.lit("a JSON array of strings is expected")).cast("array<string>")).alias("names"))
    return checked.select(F.explode("names").alias("name")).select(F.trim("name").alias("name")).where("name <> ''")


def read_fetch_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FETCH_SCHEMA).parquet(path)


def page_texts(fetches: DataFrame, transport: str | None = None) -> DataFrame:
    """``url, final_url, body`` of the log's last good answer for each address, of any transport or one (``http``, ``browser``)."""
    rows = fetches.where("status < 400 AND body IS NOT NULL")
    rows = rows.where(F.col("transport") == transport) if transport else rows
    return rows.groupBy("url").agg(F.max_by(F.struct("final_url", "body"), "ord").alias("b")).select("url", F.coalesce("b.final_url", "url").alias("final_url"), "b.body")


def reachable(urls: DataFrame, fetches: DataFrame) -> DataFrame:
    """The urls that the log has answered, by a semi-join."""
    return urls.join(fetches.where("status < 400").select("url").distinct(), "url", "left_semi")


def read_reports(spark: SparkSession, path: str, least: int = 1000) -> DataFrame:
    """Downloaded files that are whole PDF documents: ``path, length, content, name8`` with eight digits of the path's SHA-256."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    good = files.where((F.col("length") >= least) & (F.substring(F.decode(F.substring("content", 1, 5), "ISO-8859-1"), 1, 5) == "%PDF-"))
    return good.select("path", "length", "content", F.substring(F.sha2(F.col("path").cast("binary"), 256), 1, 8).alias("name8"))


def sitemap_urls(pages: DataFrame, xml: str = "body", pattern: str = "(?i)report|investor|annual|financ") -> DataFrame:
    """``loc``: addresses of sitemaps whose path matches. Text that isn't well-formed gives none."""
    locs = F.regexp_extract_all(F.col(xml), F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    return pages.select(F.explode(locs).alias("loc")).where(F.col("loc").rlike(pattern)).distinct()


def json_urls(documents: DataFrame, json: str = "body") -> DataFrame:
    """``url``: PDF addresses anywhere in JSON text, escaped slashes included."""
    found = F.regexp_extract_all(F.regexp_replace(F.col(json), r"\\/", "/"), F.lit(r'(https?://[^\s"\'<>]+?\.pdf)'), F.lit(1))
    return documents.select(F.explode(found).alias("url")).distinct()
