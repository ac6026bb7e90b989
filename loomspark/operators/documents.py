"""Checks of a document's text: is it an annual report, and is it the company's?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.rounding import matches

# Patterns of statements, annual reports, quarterly reports and governance reports.
INCOME_STATEMENT = (
    r"resultaträkning|income\s+statement|statement\s+of\s+(income|profit|loss|comprehensive\s+income)|statements?\s+of\s+operations|rapport\s+(över|over)\s+totalresultat|"
    r"\bprofit\s+before\s+tax\b|\bresult\s+before\s+tax\b|\bnet\s+interest\s+income\b|\boperating\s+income\b"
)
BALANCE_SHEET = r"balansräkning|balance\s+sheet|statement\s+of\s+financial\s+position"
ANNUAL_MARKERS = (
    r"consolidated\s+(income\s+statement|statement\s+of\s+(income|profit|loss))",
    r"resultaträkning",
    r"consolidated\s+(balance\s+sheet|statement\s+of\s+financial\s+position)",
    r"balansräkning",
    r"income\s+statement",
    r"balance\s+sheet",
    r"annual\s+report",
    r"årsredovisning",
    r"directors['']?\s+report",
    r"förvaltningsberättelse",
)
QUARTERLY = (
    r"\bq[1-4]\s+\d{4}\b|\binterim\s+report\b|\bdelårsrapport\b|\bquarterly\s+report\b|\b(first|second|third|fourth)\s+quarter\b|\bjanuary\s*[-–]\s*(march|june|september)\b|\bjanuari\s*[-–]\s*(mars|juni|september)\b"
)
GOVERNANCE = r"\bcorporate\s+governance\s+report\b|\bbolagsstyrningsrapport\b|\bremuneration\s+report\b|\bersättningsrapport\b"
COMBINED = r"\bfull[- ]year\b|\bannual\s+results\b|\bfull\s+year\s+results\b|\bfiscal\s+year\s+ended\b"
ANY_FIGURES = "intäkter|revenue|nettoomsättning|resultat"
#: Characters that the first look at a document takes, and those of the entity check and its second pass. They are part of the rules.
HEAD, NEAR, FAR = 5_000, 6_000, 12_000
LEAST_CHARS, LEAST_CHARS_BANK = 5_000, 3_200


def content_check(text: Column) -> Column:
    """A struct of what a document is: ``income_statement, balance_sheet, markers, quarterly, governance, annual``.

    Quarterly wording in the head makes it a quarterly report, unless four annual markers and both statements, or full-year wording in the head and an income statement, say otherwise. Governance
    wording in the head makes it a governance report where fewer than three annual markers stand in the text.
    """
    head = F.substring(text, 1, HEAD)
    income, balance = matches(text, INCOME_STATEMENT), matches(text, BALANCE_SHEET)
    markers = sum((matches(text, p).cast("int") for p in ANNUAL_MARKERS), F.lit(0))
    raw = F.struct(income.alias("i"), balance.alias("b"), markers.alias("n"), matches(head, QUARTERLY).alias("q"), matches(head, GOVERNANCE).alias("g"), matches(head, COMBINED).alias("c"))

    def judge(x: Column) -> Column:
        quarterly = x["q"] & ~((x["n"] >= 4) & x["i"] & x["b"]) & ~(x["c"] & x["i"])
        governance = x["g"] & (x["n"] < 3)
        return F.struct(
            x["i"].alias("income_statement"),
            x["b"].alias("balance_sheet"),
            x["n"].alias("markers"),
            quarterly.alias("quarterly"),
            governance.alias("governance"),
            (~quarterly & ~governance & (x["i"] | (x["n"] >= 2))).alias("annual"),
        )

    return F.get(F.transform(F.array(raw), judge), F.lit(0))


def quality_reason(text: Column, check: Column, least: Column | int = LEAST_CHARS) -> Column:
    """Why a document is passed over, or null: too short, no figures, a governance or a quarterly report. ``check`` is its content check."""
    size = F.length(F.coalesce(text, F.lit("")))
    return (
        F.when(size < least, F.concat(F.lit("text too short ("), size.cast("string"), F.lit(" chars)")))
        .when(~check["income_statement"] & ~matches(text, ANY_FIGURES), "no income statement signals")
        .when(check["governance"], "governance report")
        .when(check["quarterly"], "quarterly report")
    )


_AMPERSAND = r"(?<![\wåäöÅÄÖ])[\wåäöÅÄÖ]{1,20}&[\wåäöÅÄÖ]{1,20}(?![\wåäöÅÄÖ])"


def without_form(name: Column) -> Column:
    """A legal name without its legal form at the end."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"(?i)\s*\(publ\)\s*$", ""), r"(?i)\s+AB\s*$", ""))


def tight_ampersand(name: Column) -> Column:
    """``H & M`` as ``H&M``: single characters around an ampersand, as often as there are any."""
    once = lambda c: F.regexp_replace(c, r"\b(\w)\s+&\s+(\w)\b", "$1&$2")
    return F.trim(once(once(once(name))))


def ticker_forms(ticker: Column) -> Column:
    """The ways a ticker is written: with its share class and without."""
    t = F.regexp_replace(F.regexp_replace(F.upper(F.trim(ticker)), r"\s+", ""), r"\.ST$", "")
    base, share = F.regexp_extract(t, r"^(.+)-([A-Z])$", 1), F.regexp_extract(t, r"^(.+)-([A-Z])$", 2)
    split = F.array(F.concat(base, F.lit(" "), share), F.concat(base, F.lit("-"), share), F.when(F.length(base) >= 2, base))
    none = F.array().cast("array<string>")
    return F.when(ticker.isNull() | (t == ""), none).when(base != "", F.array_compact(split)).otherwise(F.array(t))


def entity_terms(legal: Column, display: Column, anchor: Column, tokens: Column, short_names: Column, ticker: Column, org_number: Column, aliases: Column) -> Column:
    """``array<struct<needle, provenance>>``: what a company's report may call it, in order of trust; of terms that differ in case the first counts."""
    stripped = without_form(legal)
    forms = F.array(*(F.struct(F.trim(c).alias("needle"), F.lit(p).alias("provenance")) for c, p in ((legal, "legal:full"), (stripped, "legal:stripped-suffix"), (tight_ampersand(stripped), "legal:collapsed-spacing"), (tight_ampersand(legal), "legal:collapsed-full"))))
    many = lambda values, p: F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.struct(F.trim(v).alias("needle"), F.lit(p).alias("provenance")))
    one = lambda value, p: many(F.array_compact(F.array(value)), p)
    marks = F.flatten(F.array(*(F.regexp_extract_all(c, F.lit(_AMPERSAND), F.lit(0)) for c in (legal, stripped, tight_ampersand(stripped), tight_ampersand(legal)))))
    long = F.filter(tokens, lambda t: F.length(t) >= 3)
    brand = F.when(F.size(tokens) > 0, F.element_at(tokens, -1))
    digits = F.regexp_replace(org_number, r"\D", "")
    terms = F.concat(
        forms,
        many(marks, "legal:ampersand-fragment"),
        one(display, "display:name"),
        one(anchor, "search:anchor"),
        one(F.when(F.length(brand) >= 3, brand), "entity:brand-token"),
        many(long, "entity:distinctive-token"),
        many(short_names, "derived:short-name"),
        many(ticker_forms(ticker), "ticker:variant"),
        one(F.regexp_replace(org_number, r"\s", ""), "org:formatted"),
        one(F.when(F.length(digits) >= 8, digits), "org:digits"),
        many(aliases, "alias:known"),
    )
    kept = F.filter(terms, lambda t: F.length(t["needle"]) >= 2)
    folded = F.transform(kept, lambda t: F.lower(t["needle"]))
    return F.filter(kept, lambda t, i: F.array_position(folded, F.lower(t["needle"])) == i + 1)


def entity_check(text: Column, terms: Column, ambiguity: Column, tokens: Column) -> Column:
    """A struct ``passed, term, region`` of the first term that stands in the text's first characters.

    In the first 6,000 any term counts; one of under five letters without an ampersand needs a distinctive word of five letters beside it if the name is easily mistaken. After that the names, numbers and aliases
    count in the first 12,000.
    """
    text = F.coalesce(text, F.lit(""))
    regions = F.struct(F.lower(F.substring(text, 1, NEAR)).alias("near"), F.lower(F.substring(text, 1, FAR)).alias("far"))

    def judge(r: Column) -> Column:
        backed = F.coalesce(F.exists(tokens, lambda t: (F.length(t) >= 5) & r["near"].contains(F.lower(t))), F.lit(False))
        fits = lambda n: (F.length(n) >= 5) | (ambiguity != "high") | n.contains("&") | backed
        near = F.get(F.filter(terms, lambda t: r["near"].contains(F.lower(t["needle"])) & fits(F.lower(t["needle"]))), F.lit(0))
        far = F.get(F.filter(terms, lambda t: t["provenance"].rlike("^(legal|org|alias):") & r["far"].contains(F.lower(t["needle"]))), F.lit(0))
        found = F.coalesce(near, far)
        return F.struct(
            found.isNotNull().alias("passed"),
            F.concat(found["provenance"], F.lit(":"), found["needle"]).alias("term"),
            F.when(near.isNull() & far.isNotNull(), "first-12000-chars-strong").otherwise("first-6000-chars").alias("region"),
        )

    return F.get(F.transform(F.array(regions), judge), F.lit(0))
