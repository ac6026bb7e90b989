"""Figures from report text: label scan, cells, column choice, the ladder for operating profit, headcount, chief executive, fiscal year.

A document's lines are an array column; each step is a higher-order function over it, so a report is read in one row without a shuffle. Labels, patterns and limits are data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import numbers as num
from loomspark.functions.rounding import let, may_match, round_half_up

# Labels in order of rank, by type and field.
LABELS: dict[str, dict[str, list[str]]] = {
    "industrial": {
        "revenue": ["net sales", "nettoomsättning", "revenue", "net revenue", "total revenue", "omsättning", "sales"],
        "ebit": ["operating profit", "operating income", "rörelseresultat", "operating result", "resultat före finansnetto", "ebit"],
        "adjusted": ["adjusted operating profit", "adjusted ebit", "justerat rörelseresultat"],
        "ebita": ["ebita"],
        "amortisation": ["amortisation", "amortization", "avskrivningar på immateriella"],
        "margin": ["operating margin", "rörelsemarginal", "ebit margin"],
    },
    "bank": {"revenue": ["total operating income", "summa rörelseintäkter", "total income"], "ebit": ["operating profit", "rörelseresultat", "result before tax", "profit before tax"]},
    "real_estate": {"revenue": ["rental income", "hyresintäkter", "net sales"], "ebit": ["förvaltningsresultat", "profit from property management", "operating profit"]},
}
EMPLOYEES = ["average number of employees", "medelantal anställda", "number of employees", "antal anställda", "employees"]
CEO_LABELS = ["president and ceo", "vd och koncernchef", "chief executive officer", "verkställande direktör", "ceo"]
YEAR_LABELS = r"(?i)(?:financial year|fiscal year|räkenskapsåret|annual report|årsredovisning)\D{0,20}(20[2-3]\d)"
_NUMBER = r"\(?[-–−]?\d{1,3}(?:[, ]\d{3})+(?:[.,]\d+)?\)?|\(?[-–−]?\d+(?:[.,]\d+)?\)?"
_NAME = r"([A-ZÅÄÖ][a-zåäöéü]+(?:[ -][A-ZÅÄÖ][a-zåäöéü]+){1,3})"
EXCLUDED = ("other ", "övriga ", "adjusted ", "parent ", "moderbolag")


def cells(tail: Column) -> Column:
    """The number-like cells after a label: columns split at two spaces or tabs where there are any, else at the numbers themselves."""
    columns = lambda t: F.filter(F.transform(F.split(t, r"\s{2,}|\t"), lambda c: F.trim(c)), lambda c: c.rlike(r"\d"))
    return let(F.trim(tail), lambda t: F.when(t.rlike(r"\s{2,}|\t"), columns(t)).otherwise(F.regexp_extract_all(t, F.lit(f"({_NUMBER})"), F.lit(1))))


def usable(cell: Column) -> Column:
    """Not a year, a percentage, a note reference or mostly letters."""
    letters, digits = F.length(F.regexp_replace(cell, r"[^A-Za-zÅÄÖåäö]", "")), F.length(F.regexp_replace(cell, r"\D", ""))
    return ~num.is_year(cell) & ~cell.contains("%") & ~cell.rlike(r"(?i)^\s*not(e|er)?\b") & (letters <= digits)


def pick_cell(candidates: Column, header: Column, year: str | None) -> Column:
    """The value of the wanted year's column where a header of as many columns stands above, else of the first; a spread over 500 times gives none.

    A lone small integer before larger values is a note reference and is left out."""

    def chosen(x: Column) -> Column:
        values, years = x["v"], x["h"]
        size = lambda k: F.abs(F.get(values, F.lit(k)))
        note = (F.size(values) > 1) & (size(0) < 100) & (size(1) >= 1000) & (F.size(values) > F.size(years))
        return let(F.struct(F.when(note, F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))).otherwise(values).alias("v"), years.alias("h")), by_column)

    def by_column(x: Column) -> Column:
        values, years = x["v"], x["h"]
        at = F.coalesce(F.array_position(years, year).cast("int"), F.lit(0)) if year else F.lit(0)
        sizes = F.transform(values, lambda v: F.abs(v))
        spread = F.coalesce(F.array_max(sizes) > 500 * F.greatest(F.array_min(sizes), F.lit(1.0)), F.lit(False))
        return F.when((F.size(years) >= 2) & (at > 0) & (F.size(values) >= at), F.get(values, at - 1)).when(~spread, F.get(values, F.lit(0)))

    values = F.filter(F.transform(F.filter(candidates, usable), num.parse_number), lambda v: v.isNotNull())
    return let(F.struct(values.alias("v"), header.alias("h")), chosen)


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("no"), line.alias("line")))


def header_above(lines: Column, no: Column, reach: int = 3) -> Column:
    """The years of the nearest of the ``reach`` lines above that has at least two; else none."""
    def years(k: int) -> Column:
        return F.regexp_extract_all(F.coalesce(F.get(lines, no - k)["line"], F.lit("")), F.lit(r"\b(20\d{2})\b"), F.lit(1))

    near = F.array(*(years(k) for k in range(1, reach + 1)))
    return F.coalesce(F.get(F.filter(near, lambda y: F.size(y) >= 2), F.lit(0)), F.array().cast("array<string>"))


def ranked_labels(labels: list[str]) -> Column:
    """Labels with their ranks as an array of constants. Short one-word labels have a pattern: they need neighbours that are no letters."""
    lone = lambda label: len(label) <= 5 and " " not in label
    return F.array(*(F.struct(F.lit(x).alias("label"), F.lit(r).alias("rank"), F.lit(f"(?<![a-zåäö]){x}(?![a-zåäö])" if lone(x) else "").alias("pattern")) for r, x in enumerate(labels)))


def labels_of(kind: Column, lists: dict[str, list[str]], other: list[str]) -> tuple[Column, str]:
    """The labels of each row's kind, and the pattern of any label."""
    case = F.when(F.lit(False), ranked_labels(other))
    for k, labels in lists.items():
        case = case.when(kind == k, ranked_labels(labels))
    return case.otherwise(ranked_labels(other)), "|".join(dict.fromkeys(x for labels in (*lists.values(), other) for x in labels))


def labelled_lines(lines: Column, labels: list[str]) -> Column:
    """The lines that hold one of the labels or more; a report has few."""
    return F.filter(lines, lambda x: let(F.lower(x["line"]), lambda low: may_match(low, "|".join(labels))))


def label_hits(lines: Column, labels: list[str] | tuple[Column, str], passes: tuple[tuple[int, int], ...] = ((150, 60), (500, 200)), excluded: tuple[str, ...] = EXCLUDED) -> Column:
    """All (pass, rank, line, position after the label), sorted: the first usable one wins. Of the passes that a labelled line fits the first one counts, since a later one can't win over it."""
    before = "(" + "|".join(x.strip() for x in excluded) + r")\s*$"
    # Labels and passes are arrays of constants, so the plan doesn't grow with them.
    ranked, words = labels if isinstance(labels, tuple) else (ranked_labels(labels), "|".join(labels))
    limits = F.array(*(F.struct(F.lit(p).alias("pass_no"), F.lit(longest).alias("longest"), F.lit(offset).alias("offset")) for p, (longest, offset) in enumerate(passes)))

    def of(x: Column) -> Column:
        def hits(label: Column) -> Column:
            at = F.when(label["pattern"] == "", F.instr(x["low"], label["label"])).otherwise(F.regexp_instr(x["low"], label["pattern"]))

            def within(at: Column) -> Column:
                free = (at > 0) & ~F.substring(x["low"], F.lit(1), at - 1).rlike(before)
                fits = F.slice(F.filter(limits, lambda p: free & (x["n"] <= p["longest"]) & (at <= p["offset"] + 1)), 1, 1)
                return F.transform(fits, lambda p: F.struct(p["pass_no"].alias("pass_no"), label["rank"].alias("rank"), x["no"].alias("no"), (at + F.length(label["label"])).alias("after"), label["label"].alias("label")))

            return let(at, within)

        return F.flatten(F.transform(ranked, hits))

    # Lines without any label are left out before the labels are told apart.
    some = F.filter(F.transform(lines, lambda x: F.struct(F.lower(x["line"]).alias("low"), F.length(x["line"]).alias("n"), x["no"].alias("no"))), lambda x: may_match(x["low"], words))
    return F.array_sort(F.flatten(F.transform(some, of)))


def first_figure(lines: Column, labels: list[str], year: str | None = None) -> Column:
    """``struct<value, label, no>`` of the first labelled line, in the order pass, label, line, with a value that can be picked."""
    def value(hit: Column) -> Column:
        line = F.get(lines, hit["no"])["line"]
        tail = F.substring(line, hit["after"], F.length(line))
        below = F.coalesce(F.get(lines, hit["no"] + 1)["line"], F.lit(""))
        cut = F.when(tail.rlike(r"\d"), tail).otherwise(F.when(below.rlike(r"^[\s\d(–−-]"), below).otherwise(F.lit("")))
        return F.struct(pick_cell(cells(cut), header_above(lines, hit["no"]), year).alias("value"), hit["label"].alias("label"), hit["no"].alias("no"))

    return F.get(F.filter(F.transform(label_hits(lines, labels), value), lambda f: f["value"].isNotNull()), F.lit(0))


def with_lines(docs: DataFrame) -> DataFrame:
    """``lines`` and ``unit`` beside the text."""
    return docs.withColumn("lines", _lines(F.col("text"))).withColumn("unit", num.unit_context(F.col("text")))


def labelled_figure(docs: DataFrame, labels: list[str], year: str | None = None) -> DataFrame:
    """``doc_id, unit, label, line_no, msek``."""
    found = with_lines(docs).withColumn("f", first_figure(F.col("lines"), labels, year))
    return found.select("doc_id", "unit", F.col("f.label").alias("label"), F.col("f.no").alias("line_no"), num.to_msek(F.col("f.value"), F.col("unit")).alias("msek"))


def margin_percent(lines: Column) -> Column:
    """The first margin between -80 and 80 percent on a line with a margin label."""
    words = "|".join(LABELS["industrial"]["margin"])
    found = F.transform(F.filter(lines, lambda x: F.lower(x["line"]).rlike(words)), lambda x: F.regexp_replace(F.regexp_extract(x["line"], r"(-?\d+(?:[.,]\d+)?)\s*%", 1), ",", ".").try_cast("double"))
    return F.get(F.filter(found, lambda m: m.between(-80, 80)), F.lit(0))


def ebit_ladder(docs: DataFrame, kind: str = "industrial", year: str | None = None) -> DataFrame:
    """``doc_id, revenue, ebit, strategy``: direct, adjusted, EBITA less amortisation within 15 lines (or EBITA itself), then margin times revenue. Banks and landlords use their own labels first."""
    labels = LABELS.get(kind, LABELS["industrial"])
    base = LABELS["industrial"]
    rows = with_lines(docs)
    lines = F.col("lines")
    rows = rows.withColumns(
        {
            "revenue_f": first_figure(lines, labels["revenue"], year),
            "direct_f": first_figure(lines, labels["ebit"], year),
            "adjusted_f": first_figure_plain(lines, base["adjusted"], year),
            "ebita_f": first_figure_plain(lines, base["ebita"], year),
            "amort_f": first_figure_plain(lines, base["amortisation"], year),
            "margin": margin_percent(lines),
        }
    )
    near = F.abs(F.col("amort_f.no") - F.col("ebita_f.no")) <= 15
    amort = F.abs("amort_f.value")
    ebita = F.when(near & (amort > 0) & (amort < 2 * F.abs("ebita_f.value")), F.col("ebita_f.value") - amort).otherwise(F.col("ebita_f.value"))
    derived = round_half_up(F.col("revenue_f.value") * F.col("margin") / 100)
    ladder = [("direct", F.col("direct_f.value")), ("adjusted", F.col("adjusted_f.value")), ("ebita", ebita), ("margin", derived)]
    strategy = F.coalesce(*(F.when(v.isNotNull(), name) for name, v in ladder))
    value = F.coalesce(*(v for _, v in ladder))
    return rows.select("doc_id", num.to_msek(F.col("revenue_f.value"), F.col("unit")).alias("revenue"), num.to_msek(value, F.col("unit")).alias("ebit"), strategy.alias("strategy"))


def first_figure_plain(lines: Column, labels: list[str], year: str | None = None) -> Column:
    """As ``first_figure``, without excluded prefixes: for labels that are themselves qualified."""
    def value(hit: Column) -> Column:
        line = F.get(lines, hit["no"])["line"]
        tail = F.substring(line, hit["after"], F.length(line))
        return F.struct(pick_cell(cells(tail), header_above(lines, hit["no"]), year).alias("value"), hit["label"].alias("label"), hit["no"].alias("no"))

    hits = label_hits(lines, labels, excluded=("never before",))
    return F.get(F.filter(F.transform(hits, value), lambda f: f["value"].isNotNull()), F.lit(0))


def employees(docs: DataFrame, year: str | None = None) -> DataFrame:
    """``doc_id, employees``: the first labelled headcount between 1 and 1,000,000 that isn't a year."""
    rows = with_lines(docs).withColumn("f", first_figure(F.col("lines"), EMPLOYEES, year))
    value = F.col("f.value")
    return rows.select("doc_id", F.when(value.between(1, 1_000_000) & ~value.between(2000, 2035), value).alias("employees"))


def chief_executive(docs: DataFrame, window: int = 800) -> DataFrame:
    """``doc_id, ceo``: a person's name beside a label among the first 800 lines, as the rule has it: after it, before it, or on the line above or below; label order first."""
    rows = with_lines(docs)
    lines = F.slice("lines", 1, window)

    def name(hit: Column) -> Column:
        at = lambda k: F.coalesce(F.get(F.col("lines"), hit["no"] + k)["line"], F.lit(""))
        after, before = F.substring(at(0), hit["after"], F.lit(200)), F.substring(at(0), F.lit(1), hit["after"] - F.length(hit["label"]) - 1)
        return F.coalesce(*(F.nullif(F.regexp_extract(part, pattern, 1), F.lit("")) for part, pattern in ((after, "^[\\s,:–-]*" + _NAME), (before, _NAME + r"[\s,:–-]*$"), (at(-1), "^\\s*" + _NAME + "\\s*$"), (at(1), "^\\s*" + _NAME + "\\s*$"))))

    names = F.filter(F.transform(label_hits(lines, CEO_LABELS, ((300, 200),)), name), lambda n: n.isNotNull())
    return rows.select("doc_id", F.get(names, F.lit(0)).alias("ceo"))


def fiscal_year(docs: DataFrame, prefixes: tuple[int, ...] = (3_000, 15_000, 120_000)) -> DataFrame:
    """``doc_id, fiscal_year``: the year beside a year label, looked for in ever longer prefixes."""
    tries = [F.regexp_extract(F.substring("text", 1, n), YEAR_LABELS, 1) for n in prefixes]
    return docs.select("doc_id", F.coalesce(*(F.nullif(t, F.lit("")).cast("int") for t in tries)).alias("fiscal_year"))


def co2(docs: DataFrame, labels: tuple[str, ...] = ("scope 1",)) -> DataFrame:
    """``doc_id, tonnes``: the figure after the label or on the two lines below, between 10 and 100 million."""
    rows = with_lines(docs)
    pattern = "|".join(labels)

    def figure(line: Column) -> Column:
        own = F.regexp_replace(F.lower(line["line"]), f"^.*?({pattern})", "")
        below = [F.coalesce(F.get(F.col("lines"), line["no"] + k)["line"], F.lit("")) for k in (1, 2)]
        return F.coalesce(*(F.when(v.between(10, 100_000_000), v) for v in (num.parse_co2(own), *(num.parse_co2(b) for b in below))))

    hits = F.filter(F.transform(F.filter("lines", lambda x: F.lower(x["line"]).rlike(pattern)), figure), lambda v: v.isNotNull())
    return rows.select("doc_id", F.get(hits, F.lit(0)).alias("tonnes"))
