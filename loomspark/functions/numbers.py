"""Numbers from report text: table cells, units, plausibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.functions.rounding import let, may_match

# Factors to millions of SEK.
FACTORS = {"msek": 1.0, "bsek": 1000.0, "ksek": 0.001, "sek": 0.000001, "eur_m": 11.25, "usd_m": 10.8, "usd_k": 0.0108, "gbp_m": 13.5, "nok_m": 1.0, "dkk_m": 1.55}
HTML_FACTORS = {**FACTORS, "eur_m": 11.5}

# The wording that names a unit, by family. Boundaries are ASCII ones, in every dialect.
UNIT_MARKERS: tuple[tuple[str, str], ...] = (
    ("ksek", r"amounts?\s+in\s+sek\s+thousands?\b|\btkr\b|\bksek\b|\bsek\s+thousands?\b"),
    ("bsek", r"\bbsek\b|\bbillion\s+sek\b|\bmiljard(er)?\s+sek\b|\bsek\s*billion\b"),
    ("msek", r"amounts?\s+in\s+sek\s*m\b|belopp\s+i\s+msek\b|amounts?\s+in\s+msek\b|\bmsek\b|sek\s+millions?\b|\bmkr\b"),
    ("eur_m", r"amounts?\s+in\s+(million\s+)?euros?\b|\bin\s+eur\s*m\b|\bmeur\b|\beur\s*million\b|\bmillion\s+euros?\b|\bbelopp\s+i\s+meur\b|\bi\s+miljoner\s+euro\b"),
    ("usd_k", r"\(in\s+thousands\s+of\s+u\.?s\.?\s*dollars|\bthousands?\s+of\s+(u\.?s\.?\s*)?dollars?\b|\b000s?\s+of\s+u\.?s\.?\s*dollars?\b"),
    ("usd_m", r"\bin\s+millions?\s+of\s+(u\.?s\.?\s*|united\s+states\s+)?dollars?\b|\busd\s*(million|millions|m)\b|\bmusd\b|\bus\$\s*(million|millions|m)\b|\$\s*m\b|\$\s*million"),
    ("gbp_m", r"\bgbp\s*(million|millions|m)\b|£\s*m\b|£\s*million\b|\bmillion\s+pounds?\b|\bin\s+millions?\s+of\s+pounds?\b"),
    ("nok_m", r"\bmnok\b|\bnok\s*(million|millions|m)\b|\bmillion\s+nok\b|\bnorske\s+kroner\s+i\s+millioner\b"),
    ("dkk_m", r"\bmdkk\b|\bdkk\s*(million|millions|m)\b|\bmillion\s+dkk\b|\bdanske\s+kroner\s+i\s+millioner\b"),
)
EARLY_EURO, LATE_SEK = 45_000, 250_000
EXPLICIT_SEK = r"amounts?\s+in\s+(sek\s*)?m\b|amounts?\s+in\s+msek|belopp\s+i\s+msek|sek\s+millions?\b"


def ascii_words(pattern: str) -> str:
    """A pattern whose ``\\b`` means an ASCII word boundary also beside other letters."""
    return pattern.replace(r"\b", r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))")


def parse_number(raw: Column) -> Column:
    """A table cell as a double, null if it is none.

    Leading text is cut; ``(x)`` and a leading minus of any kind negate; groups of three after commas or spaces are thousands; else a comma before one or
    two digits is decimal. Text after the number is cut unless it holds digits or marks.
    """


    def unsigned(text: Column) -> Column:
        grouped = F.regexp_extract(text, r"^\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?", 0)
        rest = F.regexp_replace(F.regexp_replace(text, r"[^0-9.,]+$", ""), r"(?<=\d) (?=\d{3}(?!\d))", "")
        plain = let(rest, lambda x: F.when(x.rlike(r",[^,.]{0,2}$"), F.regexp_replace(F.regexp_replace(x, r"\.", ""), ",", ".")).otherwise(F.regexp_replace(x, ",", "")))
        digits = let(grouped, lambda g: F.when(g != "", F.regexp_replace(g, ",", "")).otherwise(plain))
        return let(digits, lambda d: F.when(d.rlike(r"^\d+(\.\d+)?$"), d.cast("double")))

    def signed(text: Column) -> Column:
        bracket = text.startswith("(") & text.contains(")")
        inner = F.when(bracket, F.regexp_replace(F.regexp_replace(text, r"^\(", ""), r"^([^)]*)\)", "$1")).otherwise(text)
        return let(F.struct(bracket.alias("b"), inner.alias("t")), lambda s: let(unsigned(F.regexp_replace(s["t"], r"^[-–−]\s*", "")), lambda v: F.when(s["b"] | s["t"].rlike(r"^[-–−]"), -v).otherwise(v)))

    return let(F.regexp_replace(F.trim(raw), r"^[^0-9(–−-]+", ""), signed)


def parse_number_html(raw: Column) -> Column:
    """The laxer rule for web tables: spaces are dropped, a comma is decimal, trailing text is ignored."""
    text = F.regexp_replace(F.regexp_replace(F.trim(raw), r"[\s ]", ""), ",", ".")
    return F.regexp_extract(F.regexp_replace(text, "[–−]", "-"), r"^-?\d+(\.\d+)?", 0).try_cast("double") if hasattr(text, "try_cast") else F.expr("NULL")


def parse_statutory(raw: Column) -> Column:
    """A figure with its unit word, in millions: miljarder, miljoner or mkr, else thousands."""
    low = F.lower(raw)
    number = F.regexp_replace(F.regexp_replace(F.regexp_extract(low, r"-?[\d\s ]+(,\d+)?", 0), r"[\s ]", ""), ",", ".")
    factor = F.when(low.rlike("miljard|mdkr"), 1000.0).when(low.rlike("miljon|mkr|msek"), 1.0).otherwise(0.001)
    return F.when(number.rlike(r"^-?\d+(\.\d+)?$"), number.cast("double") * factor)


def substantial_number(line: Column, below: Column, least: float) -> Column:
    """The first figure of four digits or more on a line, or else on the one below it, of an amount of ``least`` at least in its own unit; in millions."""
    pattern = r"([-–−]?\d[\d\s,.]{2,}\d(?:\s*(?:tkr|mkr|mdr|kr))?)"
    found = F.concat(*(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(pattern), F.lit(1)) for c in (line, below)))
    long = F.filter(found, lambda x: F.length(F.regexp_replace(x, r"\D", "")) >= 4)

    def value(raw: Column) -> Column:
        number = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"[a-zåäö]", ""), r"[\s.]", ""), r"[–−]", "-"), ",", ".")
        factor = F.when(raw.contains("mdr"), 1000.0).when(raw.contains("mkr"), 1.0).when(raw.rlike(r"(?<!t)(?<!m)kr$"), 0.000001).otherwise(0.001)
        return F.struct(F.abs(number.try_cast("double")).alias("size"), (number.try_cast("double") * factor).alias("msek"))

    return F.get(F.filter(F.transform(long, value), lambda v: v["size"] >= least), F.lit(0))["msek"]


def parse_co2(raw: Column) -> Column:
    """Tonnes: ``12.500`` and ``12,500`` are thousands; kt and million multiply."""
    low = F.lower(raw)
    token = F.regexp_extract(low, r"\d[\d\s.,]*", 0)
    clean = F.regexp_replace(token, r"\s", "")
    grouped = clean.rlike(r"^\d{1,3}([.,]\d{3})+$")
    number = F.when(grouped, F.regexp_replace(clean, "[.,]", "")).otherwise(F.regexp_replace(F.regexp_replace(clean, "[.,]$", ""), ",", "."))
    factor = F.when(low.rlike(r"million|\bmt\b"), 1_000_000.0).when(low.rlike(r"kiloton|\bkt\b|thousand|tusen"), 1000.0).otherwise(1.0)
    return F.when(number.rlike(r"^\d+(\.\d+)?$"), number.cast("double") * factor)


def unit_context(text: Column) -> Column:
    """The unit of the earliest marker, families in their order at a tie. A euro marker early in the text yields to an explicit SEK statement further on."""

    def earliest(low: Column) -> Column:
        at = lambda p: F.nullif(F.when(may_match(low, p), F.regexp_instr(low, F.lit(ascii_words(p)))).otherwise(0), F.lit(0))
        marks = F.array(*(F.struct(at(p).alias("at"), F.lit(i).alias("order"), F.lit(unit).alias("unit")) for i, (unit, p) in enumerate(UNIT_MARKERS)))
        best = F.array_min(F.filter(marks, lambda m: m["at"].isNotNull()))
        # Only after a euro marker is the statement looked for.
        later = lambda b: let(at(EXPLICIT_SEK), lambda sek: (sek > b["at"]) & (sek <= LATE_SEK))
        return let(best, lambda b: F.when((b["unit"] == "eur_m") & (b["at"] <= EARLY_EURO), F.when(F.coalesce(later(b), F.lit(False)), "msek").otherwise(b["unit"])).otherwise(b["unit"]))

    return let(F.lower(text), earliest)


def to_msek(value: Column, unit: Column, factors: dict[str, float] = FACTORS) -> Column:
    """Millions of SEK; an unknown unit leaves the value as it is."""
    factor = F.element_at(F.create_map(*(F.lit(x) for pair in factors.items() for x in pair)), unit)
    return value * F.coalesce(factor, F.lit(1.0))


def fused_years(value: Column) -> Column:
    """Two years side by side in the digits."""
    return F.format_string("%.0f", F.abs(value.cast("double"))).rlike(r"(20\d{2}){2,}")


def is_year(cell: Column) -> Column:
    return F.trim(cell).rlike(r"^(19|20)\d{2}$")


def plausible(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(low, high), value)
