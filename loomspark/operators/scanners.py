"""Points of links by the scanner that found them. Each scanner has tables of its own; the years are counted alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.rounding import let, matches
from loomspark.operators.rank import Rules, rule_points

NOT_PDF = -999
PDF = r"\.pdf(\?|$)"
FIRST_YEAR = r"\b(20[12][0-9])\b"

# Patterns and their points.
_VOTING = r"voting|postal[\s-]*voting|postal[\s-]*vote|kallelse|bolagsst(a|ä)mma|stämma|röstmaterial|notice\s+of\s+(the\s+)?(annual|general)"
BROWSER_TEXT: Rules = (
    (r"annual\s+(and\s+sustainability\s+)?report", 10),
    (r"årsredovisning", 10),
    (r"q[1-4]", -10),
    (r"interim|quarterly|delårsrapport", -10),
    (r"governance|remuneration|presentation", -8),
    (r"press\s*release|news", -8),
    (r"summary|sammandrag", -3),
)
BROWSER_URL: Rules = ((r"annual|arsredovisning|årsredovisning", 4), (r"annual-and-sustainability|annual.report|arsredovisning|årsredovisning", 3), (r"press|/pr-|/news/|pressrelease", -8))
BROWSER_BOTH: Rules = ((_VOTING, -22), (r"\bagm\b", -14), (r"\bproxy\b", -14))
WIRE_URL: Rules = (
    (r"annual\s*(and\s*sustainability)?\s*report|arsredovisning|årsredovisning|annual-report", 8),
    (r"press|/pr-|/news/|pressrelease|_pr_", -10),
    (r"interim|quarterly|q[1-4]", -10),
    (r"governance|remuneration|presentation", -6),
    (r"voting|kallelse|proxy|bolagsst(a|ä)mma|stämma|röstmaterial|\bagm\b|postal", -22),
)
CMS_BOTH: Rules = (
    (r"annual\s+(and\s+sustainability\s+)?report|årsredovisning|arsredovisning", 10),
    (r"q[1-4]\b|quarterly|interim|delårsrapport", -12),
    (r"governance|bolagsstyrning|remuneration|nomination|board\s+proposal", -16),
)
AGGREGATOR_BOTH: Rules = (
    (r"annual\s+(and\s+sustainability\s+)?report|årsredovisning|arsredovisning", 10),
    (r"q[1-4]\b|quarterly|interim|delårsrapport", -12),
    (r"governance|bolagsstyrning|remuneration|nomination", -14),
)
SEARCH_TEXT: Rules = (
    (r"annual\s*(and\s*sustainability\s*)?\s*report", 10),
    (r"årsredovisning", 10),
    (r"interim|quarterly|q[1-4]", -10),
    (r"governance|remuneration", -8),
    (_VOTING, -22),
    (r"\bagm\b|\bproxy\b", -14),
    (r"summary|sammandrag", -3),
)
SEARCH_URL: Rules = ((r"annual.report|arsredovisning|årsredovisning", 6), (r"press|pressrelease|/news/", -10), (r"voting|kallelse|proxy|bolagsst(a|ä)mma|stämma|röstmaterial|\bagm\b|postal", -22))
IR_TEXT: Rules = (
    (r"investor\s*relations", 10),
    (r"^investors$", 8),
    (r"investerare", 8),
    (r"investor", 6),
    (r"financial\s*reports", 5),
    (r"årsredovisning", 5),
    (r"annual\s*report", 4),
    (r"\breports\b", 3),
    (r"calendar", -5),
    (r"contact", -5),
    (r"governance", -5),
    (r"press", -5),
    (r"news", -5),
    (r"career", -5),
    (r"cookie", -10),
    (r"privacy", -10),
    (r"legal", -10),
)
IR_URL: Rules = ((r"/investor", 5), (r"/ir/", 4), (r"/reports", 3), (r"/en/", 2))


def first_year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, FIRST_YEAR, 1), F.lit("")).cast("int")


def recency(year: Column, as_of_year: int) -> Column:
    """+5 for this year and the last, +2 for the one before, then 5 less for each year beyond two."""
    last = as_of_year - 1
    return let(year, lambda y: F.when(y.isin(last, as_of_year), 5).when(y == last - 1, 2).when(y < last - 2, (y - last + 2) * 5).otherwise(0))


def _lone_sustainability(text: Column, annual: str = "annual|årsredovisning") -> Column:
    return F.when(matches(text, "sustainability|hållbarhet") & ~matches(text, annual), -5).otherwise(0)


def _pdf_only(url: Column, points: Column) -> Column:
    return F.when(matches(url, PDF), points).otherwise(NOT_PDF)


def browser_points(text: Column, url: Column, as_of_year: int) -> Column:
    """Links of a rendered page."""
    both = F.concat_ws(" ", text, url)
    year = F.coalesce(first_year(text), first_year(url))
    return _pdf_only(url, 5 + rule_points(text, BROWSER_TEXT) + rule_points(url, BROWSER_URL) + rule_points(both, BROWSER_BOTH) + _lone_sustainability(text) + recency(year, as_of_year))


def wire_points(url: Column, as_of_year: int) -> Column:
    """Addresses seen while a page loads."""
    return _pdf_only(url, 4 + rule_points(url, WIRE_URL) + recency(first_year(url), as_of_year))


def cms_points(context: Column, url: Column, year: Column, as_of_year: int) -> Column:
    """Addresses in JSON, with their key path as context."""
    both = F.concat_ws(" ", context, url)
    by_year = F.when(year.isin(as_of_year, as_of_year - 1), 4).when(year < as_of_year - 3, -8).otherwise(0)
    return 4 + rule_points(both, CMS_BOTH) + _lone_sustainability(both, "annual|årsredovisning|arsredovisning") + by_year


def aggregator_points(text: Column, url: Column) -> Column:
    return 3 + rule_points(F.concat_ws(" ", text, url), AGGREGATOR_BOTH)


def ir_points(text: Column, url: Column) -> Column:
    """Links to investor pages."""
    return rule_points(text, IR_TEXT) + rule_points(url, IR_URL)


def search_points(title: Column, url: Column, host: Column, names: Column, as_of_year: int) -> Column:
    """Search results: 4 more if the host holds a name, 14 less if neither host nor text nor address holds one."""
    year = F.coalesce(first_year(url), first_year(title))
    hay = F.lower(F.concat_ws(" ", url, title))
    in_host = F.coalesce(F.exists(names, lambda n: host.contains(n)), F.lit(False))
    anywhere = F.exists(F.filter(names, lambda n: F.length(n) >= 4), lambda n: hay.contains(n))
    trust = F.when(in_host, 4).when(~anywhere, -14).otherwise(0)
    return _pdf_only(url, 5 + rule_points(title, SEARCH_TEXT) + rule_points(url, SEARCH_URL) + recency(year, as_of_year) + trust)
