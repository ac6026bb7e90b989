"""Names, hosts, tickers and document checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists.
NAME_STOPWORDS = ("group", "holding", "holdings", "company", "international", "limited", "sweden", "nordic", "publ")
TYPE_SIGNALS = {
    "investment_company": ("substansvärde", "net asset value", "investmentbolag", "portfolio companies", "investment company"),
    "bank": ("net interest income", "räntenetto", "credit losses", "kreditförluster", "deposits from"),
    "real_estate": ("förvaltningsresultat", "rental income", "hyresintäkter", "investment properties", "fastighetsbestånd"),
}
TYPE_NEEDS = {"investment_company": 3, "bank": 2, "real_estate": 2}


def normalise_space(text: Column) -> Column:
    """Runs of spaces and tabs in a line become one space; four or more line breaks become three."""
    return F.regexp_replace(F.regexp_replace(text, "[ \t]+", " "), "\n{4,}", "\n\n\n")


def slug(name: Column) -> Column:
    """Lower-case letters and digits, joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.translate(F.lower(name), "åäöéü", "aaoeu"), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def host_key(url: Column, missing: str | None = None) -> Column:
    """Lower-case host without www; ``missing`` where there is none."""
    host = F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")
    return F.coalesce(F.nullif(host, F.lit("")), F.lit(missing))


def ticker_key(raw: Column) -> Column:
    """``VOLV B`` and ``volv-b`` become VOLV-B.ST; a bare symbol of two to six letters gets .ST."""
    up = F.regexp_replace(F.upper(F.trim(raw)), r"[\s_]+", "-")
    return F.when(up.rlike(r"\.[A-Z]+$"), up).when(up.rlike(r"^[A-Z0-9]{1,8}-[A-Z]$") | up.rlike(r"^[A-Z]{2,6}$"), F.concat(up, F.lit(".ST"))).otherwise(up)


def distinctive_tokens(legal: Column) -> Column:
    """Lower-case words of five letters or more, brackets and stop-words left out, in order."""
    words = F.split(F.regexp_replace(F.lower(legal), r"\([^)]*\)", " "), r"[\s,/&-]+")
    letters = F.transform(words, lambda w: F.regexp_replace(w, "[^a-zåäöéü]", ""))
    return F.array_distinct(F.filter(letters, lambda w: (F.length(w) >= 5) & ~w.isin(*NAME_STOPWORDS)))


def ambiguity(legal: Column, ticker: Column) -> Column:
    """How easily a name is mistaken: by the ticker's stem and the number of distinctive words."""
    stem = F.length(F.regexp_replace(F.coalesce(ticker, F.lit("")), r"(-[A-Z])?\.ST$", ""))
    tokens = F.size(distinctive_tokens(legal))
    return F.when(tokens == 0, "high").when((stem.between(1, 3)) & (tokens <= 1), "high").when(tokens == 1, "medium").otherwise("low")


def model_hint(legal: Column) -> Column:
    low = F.lower(legal)
    return F.when(low.rlike("bank"), "bank").when(low.rlike("fastighet|real estate|properties"), "real_estate").when(low.rlike("invest|kapital|capital"), "investment_company").otherwise("industrial")


def vote_type(text: Column, signals: dict[str, tuple[str, ...]] = TYPE_SIGNALS, needs: dict[str, int] = TYPE_NEEDS, prefix: int = 30_000, hint: Column | None = None) -> Column:
    """The first type with enough distinct signals in the text's first characters; a hint wins."""
    low = F.lower(F.substring(text, 1, prefix))
    case = F.when(hint.isNotNull(), hint) if hint is not None else F.when(F.lit(False), "")
    for name, words in signals.items():
        case = case.when(sum((low.contains(w).cast("int") for w in words), F.lit(0)) >= needs[name], name)
    return case.otherwise("industrial")


def page_estimate(position: Column, length: Column, pages: Column) -> Column:
    """The page of a character position if text is spread evenly; positions and pages count from 1."""
    return F.when((length > 0) & (pages > 0), F.least(pages, F.floor((position - 1) * pages / length) + 1).cast("int"))


def quote_verified(text: Column, quote: Column) -> Column:
    """The quote, of 12 characters or more, lies in the text when white space is collapsed and case ignored."""
    fold = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return (F.length(fold(quote)) >= 12) & fold(text).contains(fold(quote))


def document_gate(text: Column, min_chars: int, statement: str, wrong: str) -> Column:
    """Why a document is no annual report, or pass: too short, no statement wording, or other wording in the first 5,000 characters."""
    head = F.lower(F.substring(text, 1, 5000))
    return F.when(F.length(F.coalesce(text, F.lit(""))) < min_chars, "too_short").when(~F.lower(text).rlike(statement), "no_statement").when(head.rlike(wrong), "wrong_type").otherwise("pass")
