"""Scores and order of report candidates: rule points, years, classes, entity adjustment.

Rules are data: (pattern, points) tables become one summed column, so there is no join with the rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions.rounding import folded, let, matches

Rules = tuple[tuple[str, int], ...]

# Patterns and their points.
TEXT_POSITIVE: Rules = (
    (r"annual\s+(and\s+sustainability\s+)?report", 10),
    (r"årsredovisning", 10),
    (r"års-?\s*och\s+hållbarhetsredovisning", 8),
    (r"\bannual\b", 3),
)
TEXT_NEGATIVE: Rules = (
    (r"\bq[1-4]\b", -10),
    (r"\binterim\b", -10),
    (r"\bquarterly\b", -10),
    (r"delårsrapport", -10),
    (r"\bgovernance\b", -8),
    (r"\bremuneration\b", -8),
    (r"\bpresentation\b", -8),
    (r"\bacq[u]?isition\b|acquisition[-_\s]present|\bpresentations/[^?\s]*acqui|\b(m&a|mergers?\s+and\s+acquisitions?)\b[^\n]{0,80}\bpresentation\b", -32),
    (r"capital\s*markets?\s*day", -8),
    (r"\bpress\s*release\b", -10),
    (r"\bnews\b", -8),
    (r"\bgeneral\s*meeting\b", -12),
    (r"\bannual\s+general\s+meeting\b", -18),
    (r"\bextraordinary\s+general\b", -18),
    (r"\bagm\b", -14),
    (r"\bproxy\b", -14),
    (r"\bvoting\b", -22),
    (r"\bpostal[\s-]*voting\b", -22),
    (r"\bpost[\s-]*vote\b", -18),
    (r"\bkallelse\b", -22),
    (r"\bstämma\b", -16),
    (r"\bbolagsstämma\b", -22),
    (r"\bbolagsstamma\b", -20),
    (r"\bröstmaterial\b", -20),
    (r"\bvalberedning", -12),
    (r"\bnotice\s+of\s+(the\s+)?(annual|general|egm)\b", -18),
    (r"\binstructions\s+for\s+(voting|shareholders)\b", -16),
    (r"\bsummary\b", -3),
    (r"\bsammandrag\b", -3),
    (r"\byear\s+in\s+brief\b", -22),
    (r"\bhighlights?\b", -10),
    (r"\bholdings?\b", -8),
    (r"\bsustainability\s+report\b", -14),
    (r"\bhållbarhetsrapport\b", -14),
    (r"\bhållbarhetsredovisning\b", -14),
    (r"\besef\b", -3),
    (r"\bcopy[\s-]+of[\s-]+the[\s-]+official\b", -5),
    (r"\bpillar[\s-]*3\b", -24),
    (r"\brisk\s+disclosures?\b", -20),
    (r"\brisk\s+report\b", -16),
    (r"\bnomination\s+committee'?s?\b", -24),
    (r"\bboard\s+proposal\b", -24),
    (r"\blti\b", -16),
    (r"\bremuneration\s+report\b", -18),
    (r"bolagsstyrningsrapport", -26),
    (r"corporate\s+governance\s+report", -26),
    (r"\bpolicy\b", -20),
    (r"\bfact\s*book\b", -20),
    (r"\bgovernance\s+statement\b", -24),
)
URL_RULES: Rules = (
    (r"\.pdf(\?|$)", 5),
    (r"annual|arsredovisning|årsredovisning", 4),
    (r"annual-and-sustainability|annual.report|arsredovisning|års-och-hållbarhets", 3),
    (r"\bacq[u]?isition\b|acquisition[-_\s]present|\bpresentations/[^?\s]*acqui|\b(m&a|mergers?\s+and\s+acquisitions?)[-_\s]", -38),
    (r"press|/pr-|/news/|pressrelease|_pr_", -10),
    (r"interim|quarterly|q[1-4]\b", -8),
    (r"voting|postal[\s-]*vote|kallelse|proxy|bolagsst(a|ä)mma|röstmaterial|/agm\b|_agm_|instruktioner", -22),
    (r"nomination|board-proposal|board-proposals|lti-|remuneration-report", -22),
    (r"corpgov|bolagsstyrn|corp[-_]gov|governance[-_]report", -28),
    (r"policy|factbook|presentation|remuneration[-_]report", -18),
)
CLASS_ANNUAL = r"\b(annual\s+(and\s+sustainability\s+)?report|integrated\s+annual\s+report|annual\s+financial\s+report)\b|årsredovisning"
CLASS_OTHER = (
    r"\b(corporate\s+governance|governance\s+report|governance\s+statement|policy|presentation|factbook|year\s+in\s+brief|remuneration\s+report|annual\s+general\s+meeting|agm|"
    r"notice\s+of\s+meeting|sustainability\s+report|hållbarhetsrapport|hållbarhetsredovisning|acq[u]?isition)\b"
)


def rule_points(text: Column, rules: Rules) -> Column:
    """The sum of the points of the patterns that the text matches. The folded text is named alike in each rule, so it is computed once."""
    low = folded(F.coalesce(text, F.lit("")))
    return sum((F.when(matches(text, p, low), n).otherwise(0) for p, n in rules), F.lit(0))


def latest_year(text: Column) -> Column:
    """The largest free-standing year 19xx or 20xx."""
    return F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1)), lambda y: y.cast("int")))


def year_points(year: Column, as_of_year: int) -> Column:
    """+50 for this year and the last, +20 for the one before, nothing for exactly two years before the last, -30 for older."""
    last = as_of_year - 1
    return let(year, lambda y: F.when(y.isNull(), 0).when(y.isin(last, as_of_year), 50).when(y == last - 1, 20).when(last - y > 2, -30).otherwise(0))


def stale(url: Column, text: Column, as_of_year: int) -> Column:
    """Any year before ``as_of_year - 2``; without years any two-digit range (09-10, 1213) that ends before it."""
    hay = F.concat_ws(" ", url, text)
    cutoff = as_of_year - 2
    years = F.transform(F.regexp_extract_all(hay, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    century = as_of_year // 100 * 100

    def full(two: Column) -> Column:
        y = two.cast("int") + century
        return F.when(y > as_of_year + 1, y - 100).otherwise(y)

    dashed = F.transform(F.regexp_extract_all(hay, F.lit(r"\b\d{2}[-_](\d{2})\b"), F.lit(1)), full)
    fused = F.filter(F.regexp_extract_all(hay, F.lit(r"\b(\d{4})\b"), F.lit(1)), lambda t: ~t.rlike(r"^20") & (F.substring(t, 3, 2).cast("int") == (F.substring(t, 1, 2).cast("int") + 1) % 100))
    ends = F.concat(dashed, F.transform(fused, lambda t: full(F.substring(t, 3, 2))))
    return let(years, lambda found: F.when(F.size(found) > 0, F.exists(found, lambda y: y < cutoff)).otherwise(F.exists(ends, lambda y: y < cutoff)))


def report_class(text: Column, url: Column) -> Column:
    hay = F.concat_ws(" ", text, url)
    return F.when(matches(hay, CLASS_ANNUAL), "annual_like").when(matches(hay, CLASS_OTHER), "non_annual_like").otherwise("unknown")


def url_score(url: Column, as_of_year: int) -> Column:
    """Points of an address alone, its year included."""
    return rule_points(F.lower(url), URL_RULES) + year_points(latest_year(url), as_of_year)


def heading_points(heading: Column) -> Column:
    """+3 for a link below a heading that mentions the annual report."""
    return F.when(matches(heading, r"annual\s*report|årsredovisning"), 3).otherwise(0)


def link_score(text: Column, url: Column, as_of_year: int, heading: Column | None = None) -> Column:
    """Points of a link: its text, the negatives of text and url together, both years, the url's own rules, and the headings above it if they are known."""
    both = F.lower(F.concat_ws(" ", text, url))
    lone = F.when(matches(text, "sustainability|hållbarhet") & ~matches(text, "annual|årsredovisning"), -5).otherwise(0)
    return rule_points(text, TEXT_POSITIVE) + rule_points(both, TEXT_NEGATIVE) + lone + year_points(latest_year(text), as_of_year) + url_score(url, as_of_year) + (heading_points(heading) if heading is not None else F.lit(0))


def rank_class_first(candidates: DataFrame, key: str = "company_id") -> DataFrame:
    """Adds ``class`` and ``rank``: annual-like candidates first, by score, PDF before others and arrival; the rest by score and arrival. Without any
    annual-like candidate the whole list counts as the first pool."""
    annual = F.col("class") == "annual_like"
    pool = Window.partitionBy(key)
    rows = candidates.withColumn("class", report_class(F.col("text"), F.col("url"))).withColumn("_any", F.max(annual.cast("int")).over(pool) == 1)
    first = annual | ~F.col("_any")
    pdf = F.when(first, F.lower("url").rlike(r"\.pdf(\?|$)").cast("int")).otherwise(0)
    order = Window.partitionBy(key).orderBy(first.desc(), F.desc("score"), pdf.desc(), "ord")
    return rows.withColumn("rank", F.row_number().over(order)).drop("_any")


def top_confidence(candidates: DataFrame, key: str = "company_id") -> DataFrame:
    """Per key the two best scores and the level of confidence: low under 8, medium at a gap of 3 or less, else high. Ranks up to two are taken before the shuffle, so a key costs two rows a task."""
    best = candidates.select(key, "score", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"))).alias("n")).where("n <= 2")
    rows = best.groupBy(key).agg(F.max(F.when(F.col("n") == 1, F.col("score"))).alias("top"), F.max(F.when(F.col("n") == 2, F.col("score"))).alias("second"))
    level = F.when(F.col("top") < 8, "low").when(F.col("second").isNotNull() & (F.col("top") - F.col("second") <= 3), "medium").otherwise("high")
    return rows.select(key, "top", "second", level.alias("level"))


def entity_adjustment(host: Column, tokens: Column, ambiguity: Column, url: Column, org_digits: Column) -> Column:
    """-22 or +8 by whether the host holds a token of five letters at high ambiguity, +4 for one of six otherwise, +5 for the organisation number in the url."""
    holds = lambda least: F.exists(tokens, lambda t: (F.length(t) >= least) & host.contains(t))
    some = F.size(tokens) > 0
    by_host = F.when((ambiguity == "high") & some, F.when(holds(5), 8).otherwise(-22)).when(some & holds(6), 4).otherwise(0)
    digits = F.regexp_replace(org_digits, r"\D", "")
    by_number = F.when((F.length(digits) >= 8) & F.lower(url).contains(digits), 5).otherwise(0)
    return F.when(host.isNull(), 0).otherwise(by_host + by_number)


#: Rules of a configuration file; more are an error and not a plan of any size.
MOST_RULES = 2_000


def reject_collisions(candidates: DataFrame, rules: DataFrame, host: Column) -> DataFrame:
    """Candidates without those on a host that a rule of their company name rejects. The rules (name_pattern, host_part) are folded into the plan as one condition, by host part, so there is no join: a
    name is looked at only where a part of the host fits."""
    read = rules.select("name_pattern", "host_part").distinct().limit(MOST_RULES + 1).collect()
    if len(read) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} collision rules")
    if not read:
        return candidates
    patterns: dict[str, list[str]] = {}
    for r in read:
        patterns.setdefault(r["host_part"], []).append(f"(?:{r['name_pattern']})")
    name = F.lower("company")
    hit = reduce(Column.__or__, [F.coalesce(host.contains(part) & name.rlike("|".join(sorted(p))), F.lit(False)) for part, p in sorted(patterns.items())])
    return candidates.where(~hit)


def top_n(candidates: DataFrame, n: int, key: str = "company_id") -> DataFrame:
    """The n best of each key: a report, so it is limited."""
    return candidates.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "ord"))).where(F.col("rank") <= n)


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id, pos, href, text``: the anchors of each page in order, markup in their text dropped."""
    pattern = r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    source = F.coalesce(F.col(html), F.lit(""))
    pair = F.arrays_zip(F.regexp_extract_all(source, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(source, F.lit(pattern), F.lit(2)).alias("text"))
    rows = pages.select("page_id", "url", F.posexplode(pair).alias("pos", "a"))
    return rows.select("page_id", "url", "pos", F.col("a.href").alias("href"), F.trim(F.regexp_replace(F.regexp_replace("a.text", "<[^>]*>", " "), r"\s+", " ")).alias("text"))
