"""Company lists, registry enrichment, generated addresses, tiers of sources and other composite steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions.texts import ticker_key
from loomspark.operators.merge import dedupe_first

# Path templates of report addresses.
REPORT_TEMPLATES = (
    "/{slug}-annual-report-{year}.pdf",
    "/{slug}-annual-and-sustainability-report-{year}.pdf",
    "/investors/annual-report-{year}.pdf",
    "/investors/{slug}-annual-report-{year}.pdf",
    "/globalassets/{slug}-annual-report-{year}.pdf",
    "/annual-report-{year}.pdf",
    "/annual-report-{year}-en.pdf",
    "/globalassets/annual-report-{year}.pdf",
    "/assets/annual-report-{year}.pdf",
    "/content/dam/{slug}/annual-report-{year}.pdf",
    "/wp-content/uploads/{year}/{slug}-annual-report-{year}.pdf",
)
#: Explanations of how a type's figures map to the headline fields.
MAPPINGS = {("bank", "revenue"): "mapped", ("bank", "ebit"): "mapped", ("real_estate", "revenue"): "mapped", ("real_estate", "ebit"): "mapped", ("investment_company", "revenue"): "n_a", ("investment_company", "ebit"): "n_a"}


def company_list(parts: list[DataFrame], registry: DataFrame) -> DataFrame:
    """Names from several lists in order of the lists, joined with the registry by ticker, one row per legal name (case ignored), the first kept."""
    tagged = reduce(DataFrame.unionByName, [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    named = tagged.join(registry.withColumnRenamed("name", "_legal"), "ticker", "left").withColumn("legal", F.coalesce("_legal", "name", "ticker")).drop("_legal")
    return dedupe_first(named, [F.lower("legal")], ["_part", "ord"]).drop("_part")


def symbol_stem(ticker: Column) -> Column:
    """The symbol without its exchange and one-letter class."""
    return F.regexp_replace(F.regexp_replace(F.upper(ticker), r"\.[A-Z]+$", ""), r"[-\s][A-Z]$", "")


def enrich(registry: DataFrame, seeds: DataFrame, value: str) -> DataFrame:
    """Registry rows whose ``value`` is missing get the seed's of the same stem; no key is added."""
    by_stem = seeds.select(symbol_stem(F.col("symbol")).alias("_stem"), F.col(value).alias("_value")).groupBy("_stem").agg(F.min("_value").alias("_value"))
    joined = registry.withColumn("_stem", symbol_stem(F.col("ticker"))).join(by_stem, "_stem", "left")
    return joined.select(*(F.coalesce(c, "_value").alias(c) if c == value else F.col(c) for c in registry.columns))


def unmatched_seeds(registry: DataFrame, seeds: DataFrame) -> DataFrame:
    stems = registry.select(symbol_stem(F.col("ticker")).alias("_stem")).distinct()
    return seeds.withColumn("_stem", symbol_stem(F.col("symbol"))).join(stems, "_stem", "left_anti").drop("_stem")


def link_health(registry: DataFrame) -> DataFrame:
    """Per address its tickers, sorted, and the longest name, the last in order of equal length."""
    longest = F.struct(F.length("name"), F.col("name"))
    return registry.where("url IS NOT NULL").groupBy("url").agg(F.array_join(F.array_sort(F.collect_set("ticker")), ",").alias("tickers"), F.max_by("name", longest).alias("name"))


def report_addresses(companies: DataFrame, years: list[int], templates: tuple[str, ...] = REPORT_TEMPLATES) -> DataFrame:
    """Every template for every company and year. Templates and years are constants, so this is an explode and not a join."""
    made = [F.struct(F.lit(y).alias("year"), F.lit(t).alias("template")) for y in years for t in templates]
    rows = companies.select("company_id", "origin", "slug", F.explode(F.array(*made)).alias("m"))
    path = F.replace(F.replace(F.col("m.template"), F.lit("{year}"), F.col("m.year").cast("string")), F.lit("{slug}"), F.col("slug"))
    return rows.select("company_id", F.col("m.year").alias("year"), F.concat("origin", path).alias("url"))


def allowed_hosts(rows: DataFrame, allowed: list[str], host: str = "host") -> DataFrame:
    """Rows whose host is an allowed one or below it."""
    fits = reduce(Column.__or__, [(F.col(host) == h) | F.col(host).endswith("." + h) for h in allowed])
    return rows.where(F.coalesce(fits, F.lit(False)))


def brand_trust(host: Column, slugs: Column) -> Column:
    """The host holds any slug; without slugs every host is trusted."""
    return (F.size(slugs) == 0) | F.exists(slugs, lambda s: host.contains(s))


def tier_ladder(companies: DataFrame, tiers: list[DataFrame], key: str = "company_id") -> DataFrame:
    """Each company's row of the first tier that has one: one pre-aggregated minimum over the tiers' union, so no tier's plan holds another's. Tiers have the same columns and a row a company."""
    rows = reduce(DataFrame.unionByName, [t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)])
    columns = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*columns), "tier").alias("first")).select(key, "first.*")
    return first.join(companies.select(key), key, "left_semi")


def repick_employees(matches: DataFrame, key: str = "company_id") -> DataFrame:
    """The match nearest to revenue / 25, ties to the earlier."""
    gap = F.struct(F.abs(F.col("value") * 25 - F.col("revenue")).alias("gap"), F.col("ord").alias("ord"))
    return matches.groupBy(key).agg(F.min_by("value", gap).alias("value"))


def schema_mapping(company_type: Column, field: str) -> Column:
    """exact, mapped or n_a: how a type's own line stands for a headline field."""
    case = F.when(F.lit(False), "")
    for (kind, name), how in MAPPINGS.items():
        if name == field:
            case = case.when(company_type == kind, how)
    return case.otherwise("exact")


def best_recent(candidates: DataFrame, key: str, year: Column) -> DataFrame:
    """One candidate per key: the latest year, then the highest score, then the earliest."""
    kept = [c for c in candidates.columns if c != key]
    return candidates.groupBy(key).agg(F.max_by(F.struct(*kept), F.struct(F.coalesce(year, F.lit(0)), F.col("score"), -F.col("ord"))).alias("w")).select(key, "w.*")


def job_table(jobs: DataFrame, keep: int = 50) -> DataFrame:
    """The newest ``keep`` jobs of each user by start: eviction by age. A limited table by design."""
    return jobs.withColumn("_n", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))).where(F.col("_n") <= keep).drop("_n")


def collated(rows: DataFrame, *columns: str, locale: str = "sv") -> DataFrame:
    """Rows in the order of a language: å, ä and ö after z in Swedish."""
    return rows.orderBy(*(F.collate(F.col(c), locale) for c in columns))


def profiles(tickers: DataFrame, registry: DataFrame) -> DataFrame:
    """A profile for each ticker of the list, in the order of the tickers: the registry's fields by the usual fallback of keys, the ticker itself where it has no name."""
    asked = tickers.select(F.col("ticker").alias("asked")).distinct()
    keys = F.array(F.struct(F.lit(0).alias("rank"), F.col("asked").alias("key")), F.struct(F.lit(1).alias("rank"), F.upper(F.trim("asked")).alias("key")), F.struct(F.lit(2).alias("rank"), ticker_key(F.col("asked")).alias("key")))
    tries = asked.select("asked", F.explode(keys).alias("k")).select("asked", "k.*")
    fields = [c for c in registry.columns if c != "ticker"]
    hit = tries.join(registry.withColumnRenamed("ticker", "key"), "key").groupBy("asked").agg(F.min_by(F.struct(*fields), "rank").alias("r"))
    rows = asked.join(hit, "asked", "left").select(F.col("asked").alias("raw"), ticker_key(F.col("asked")).alias("ticker"), F.coalesce("r.name", "asked").alias("name"), *(F.col(f"r.{c}").alias(c) for c in fields if c != "name"))
    return rows.orderBy("raw")


def fixed_width(*parts: tuple[str, int]) -> Column:
    """A report line: columns padded or cut to their widths."""
    return F.concat(*(F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("-")), w, " ") for c, w in parts))


def plain_link(text: Column) -> Column:
    """The first address in a text without fragment and closing slash."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.regexp_extract(text, r"https?://[^\s\"'<>)]+", 0), "#.*$", ""), "/+$", ""), F.lit(""))
