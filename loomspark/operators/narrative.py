"""Figures that a report states in sentences: revenue in billions or millions, headcounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.rounding import folded, let, may_match, round_half_up

# Wording around a figure that makes it another one, and the wording of figures in order; the figure is the group.
BAD_CONTEXT = r"since\s+\d{4}|by\s+20\d{2}|over\s+the\s+(past|last)|cumulative|divested|spun\s+off|acquired|combined|target|ambition|goal|increase\b.*\bto\b"
_N = r"(\d[\d.,]*)"
REVENUE_BILLIONS = (
    rf"\bsales\s*,\s*SEK\s+billion[^\d]{{0,50}}{_N}",
    rf"\bnet\s+sales\s*,\s*SEK\s+billion[^\d]{{0,50}}{_N}",
    rf"\bsales\s+SEK\s+billion[^\d]{{0,50}}{_N}",
    rf"(?:group|total|the group)\s+had\s+revenues?\s+of\s+BSEK\s*{_N}",
    rf"revenues?\s+(?:amounted|totaled|totalled)\s+to\s+BSEK\s*{_N}",
    rf"revenues?\s+of\s+BSEK\s*{_N}",
    rf"revenues?\s+of\s+SEK\s*{_N}\s*billion",
    rf"\bsales\s+(?:amounted|were|was|totalled|totaled)\s+to\s+SEK\s*{_N}\s*billion",
    rf"\bnet\s+sales\s+(?:amounted|were|was)\s+SEK\s*{_N}\s*billion",
)
REVENUE_MILLIONS = (r"\bnet\s+sales\s+amounted\s+to\s+SEK\s*(\d{1,3}(?:,\d{3})+)\s*m\b", r"\brevenue\s+amounted\s+to\s+SEK\s*(\d{1,3}(?:,\d{3})+)\s*m\b")
_C = r"(\d{2,3}(?:,\d{3})*|\d{2,6})"
_S = r"(\d{1,3}(?:[  ]\d{3})+|\d{2,3}(?:,\d{3})*|\d{2,6})"
_U = r"(?:\d{2,3}(?:,\d{3})*|\d{2,6})"
EMPLOYEES = (
    rf"\bthe\s+number\s+of\s+employees\s+increased\s+from\s+{_U}\s+to\s+{_C}\b",
    rf"\bantalet\s+anst[aä]llda\s+[oö]kade\s+fr[aå]n\s+{_U}\s+till\s+{_C}\b",
    rf"\bthe\s+group\s+had\s+{_C}(?:\s*\([\d,\s]{{2,12}}\))?\s+employees\b",
    rf"\baverage\s+number\s+of\s+employees(?:\s+was|\s+were|\s*[:=])?\s*{_C}\b",
    rf"\bnumber\s+of\s+employees(?:\s+at\s+year[- ]end)?(?:\s+was|\s+were|\s*[:=])?\s*{_C}\b",
    rf"\b(?:approximately|approx\.?|about|around|circa)\s+{_C}\s+(?:employees|FTEs?|full[- ]time\s+equivalents?)\b",
    rf"\b{_C}\s+(?:full[- ]time\s+equivalents?|FTEs?)\b",
    rf"\bheadcount(?:\s+was|\s+of|\s*[:=])?\s*{_C}\b",
    rf"\b{_C}\s+employees\s+(?:worldwide|globally|across)\b",
    rf"\b{_C}\s+employees\s+\(\d{{4}}:",
    rf"\bworkforce\s+of\s+{_C}\b",
    rf"\b{_S}\s+medarbetare\b",
    rf"\b{_S}\s+anst[äa]llda\b",
    rf"\b(?:hade|har)\s+{_S}\s+(?:anst[äa]llda|medarbetare)\b",
    rf"\b(?:employs|employed)\s+{_S}\s+(?:people|persons?|employees?|staff)\b",
)


def _with_folds(text: Column, body) -> Column:
    """``body`` of a text with its folded form, null as empty."""
    t = F.coalesce(text, F.lit(""))
    return let(F.struct(t.alias("text"), folded(t).alias("folds")), body)


def _revenue(text: Column, folds: Column, pattern: str, low: float, high: float, factor: float) -> Column:
    """The first figure of a wording that lies in the range and whose surroundings, 80 characters before it and 40 after, don't tell of another."""
    around = rf"(?is)(?<=(.{{80}}|\A.{{0,79}}))({pattern})(?=(.{{0,40}}))"
    groups = [F.regexp_extract_all(text, F.lit(around), F.lit(g)) for g in (1, 2, 3, 4)]
    hits = F.arrays_zip(*(g.alias(n) for g, n in zip(groups, ("before", "own", "figure", "after"), strict=True)))
    calm = F.filter(hits, lambda h: ~F.concat(h["before"], h["own"], h["after"]).rlike("(?i)" + BAD_CONTEXT))
    values = F.transform(calm, lambda h: F.regexp_extract(F.replace(h["figure"], F.lit(","), F.lit("")), r"^\d+(?:\.\d+)?", 0).cast("double"))
    # Looking back is dear, so the wording is looked for alone first, and its literals before it.
    return F.when(may_match(folds, pattern) & text.rlike("(?is)" + pattern), round_half_up(F.get(F.filter(values, lambda v: v.between(low, high)), F.lit(0)) * factor))


def narrative_revenue(text: Column) -> Column:
    """Revenue in millions as the first wording that has a plausible one states it: billions of sales, of revenue, then millions."""

    def first(t: Column) -> Column:
        billions = [_revenue(t["text"], t["folds"], p, 1, 2_000, 1_000) for p in REVENUE_BILLIONS]
        millions = [_revenue(t["text"], t["folds"], p, 1_000, 5_000_000, 1) for p in REVENUE_MILLIONS]
        return F.coalesce(*billions, *millions)

    return _with_folds(text, first)


def narrative_employees(text: Column) -> Column:
    """The largest headcount between 50 and 700,000 that any wording states."""
    none = F.array().cast("array<string>")
    stated = lambda t, p: F.when(may_match(t["folds"], p), F.regexp_extract_all(t["text"], F.lit("(?i)" + p), F.lit(1))).otherwise(none)
    found = _with_folds(text, lambda t: F.flatten(F.array(*(stated(t, p) for p in EMPLOYEES))))
    values = F.transform(found, lambda v: F.regexp_replace(v, r"[,\s ]", "").cast("double"))
    return F.array_max(F.filter(values, lambda v: v.between(50, 700_000)))
