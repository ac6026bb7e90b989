"""Key figures from investor and statutory web pages: structured data, then table rows, definition lists and running text; the first strategy that answers wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import numbers as num
from loomspark.functions.rounding import let

# Labels by field.
WEB_LABELS = {
    "revenue": ("net sales", "revenue", "nettoomsättning", "omsättning"),
    "ebit": ("operating profit", "operating result", "ebit", "rörelseresultat"),
    "employees": ("number of employees", "employees", "antal anställda"),
    "ceo": ("president and ceo", "ceo", "verkställande direktör", "vd"),
}
#: Revenue of a listed company in millions.
REVENUE_RANGE = (500, 5_000_000)


def strip_tags(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<[^>]*>", " "), r"[\s ]+", " "))


def table_rows(html: Column) -> Column:
    """``array<array<string>>``: the cells of each table row, and the pairs of definition lists, as text."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), strip_tags))
    terms = F.regexp_extract_all(html, F.lit(r"(?is)<dt[^>]*>(.*?)</dt>\s*<dd"), F.lit(1))
    values = F.regexp_extract_all(html, F.lit(r"(?is)<dt[^>]*>.*?</dt>\s*<dd[^>]*>(.*?)</dd>"), F.lit(1))
    pairs = F.transform(F.arrays_zip(terms.alias("t"), values.alias("v")), lambda p: F.array(strip_tags(p["t"]), strip_tags(p["v"])))
    return F.concat(cells, pairs)


def _labelled(cell: Column, field: str) -> Column:
    return F.lower(cell).rlike(r"^\W*(" + "|".join(WEB_LABELS[field]) + r")\b")


def from_rows(rows: Column, field: str) -> Column:
    """The first cell with a digit after a labelled first cell."""
    hits = F.filter(rows, lambda r: (F.size(r) >= 2) & _labelled(F.get(r, F.lit(0)), field))
    tails = F.transform(hits, lambda r: F.get(F.filter(F.slice(r, 2, F.size(r)), lambda c: c.rlike(r"\d")), F.lit(0)))
    return F.get(F.filter(tails, lambda v: v.isNotNull()), F.lit(0))


def from_json_ld(html: Column, key: str) -> Column:
    """A value of a key in the page's structured data."""
    return F.nullif(F.regexp_extract(html, r'(?is)"' + key + r'"\s*:\s*(?:\{[^}]*"value"\s*:\s*)?"?([^",}\]]+)', 1), F.lit(""))


def from_text(text: Column, field: str) -> Column:
    """The first number within 40 characters after a label in running text."""
    return F.nullif(F.regexp_extract(F.lower(text), r"\b(?:" + "|".join(WEB_LABELS[field]) + r")\b[^\d]{0,40}(\d[\d ,.]*\d|\d)", 1), F.lit(""))


def key_figures(pages: DataFrame, id_col: str = "company_id", html_col: str = "html") -> DataFrame:
    """One row per company over its pages: ``revenue, ebit, employees, confidence``; of several pages the first in order with an answer counts.

    Revenue outside the range of a listed company is dropped; the confidence is 30 and 10 for each figure, 70 at most.
    """
    source = F.coalesce(F.col(html_col), F.lit(""))
    parsed = pages.select(F.col(id_col), "ord", source.alias("_h")).withColumn("_rows", table_rows(F.col("_h"))).withColumn("_text", strip_tags(F.col("_h")))

    def figure(field: str, key: str) -> Column:
        tries = [from_json_ld(F.col("_h"), key), from_rows(F.col("_rows"), field), from_text(F.col("_text"), field)]
        return F.coalesce(*(num.parse_number(t) for t in tries))

    revenue = let(figure("revenue", "revenue"), lambda v: num.plausible(v, *REVENUE_RANGE))
    per_page = parsed.select(id_col, "ord", revenue.alias("revenue"), figure("ebit", "operatingIncome").alias("ebit"), figure("employees", "numberOfEmployees").alias("employees"))
    fields = ("revenue", "ebit", "employees")
    found = per_page.groupBy(id_col).agg(*(F.min_by(f, F.when(F.isnotnull(f), F.col("ord"))).alias(f) for f in fields))
    filled = sum((F.isnotnull(f).cast("int") for f in fields), F.lit(0))
    return found.withColumn("confidence", F.least(F.lit(70), 30 + 10 * filled))
