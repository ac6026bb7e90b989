"""The whole report in one row: sections, figures by section priority, the chief executive with second tries, and the assembled extraction.

A report's lines are an array; every step is a higher-order function over it, so nothing is shuffled, and a report is the most that a task must hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import numbers as num
from loomspark.functions import texts
from loomspark.functions.rounding import folded, let, matches, may_match, round_half_up
from loomspark.operators import extract as ex
from loomspark.operators.narrative import narrative_employees, narrative_revenue

# Headings of statements, of what ends them, of segments, of key figures and of the management.
STATEMENT = (
    r"consolidated\s+(statement\s+of\s+)?(income|profit|loss)|consolidated\s+statements?\s+of\s+(\(?(loss|profit|income)\)?\s+)?earnings|consolidated\s+income\s+statement|(income|profit\s+(and|&)\s+loss)\s+statement|koncernens\s+resultaträkning|resultaträkning|"
    r"statement\s+of\s+(profit|income|loss)|(consolidated\s+)?statement\s+of\s+comprehensive\s+income|statement\s+of\s+(total\s+)?comprehensive\s+(income|loss)|consolidated\s+statements?\s+of\s+operations|statements?\s+of\s+operations\s+and\s+(comprehensive\s+)?(income|loss)|"
    r"rapport\s+(över|over)\s+totalresultat|rapport\s+(över|over)\s+(det\s+samlade\s+resultatet|helhetsresultatet)"
)
BOUNDARY = (
    r"consolidated\s+(statement\s+of\s+)?(financial\s+position|balance\s+sheet|cash\s+flow|changes\s+in\s+equity)|other\s+comprehensive\s+(income|loss)|balance\s+sheet|koncernens\s+balansräkning|balansräkning|kassaflödesanalys|"
    r"statement\s+of\s+(cash\s+flows?|financial\s+position|changes\s+in\s+equity)|notes\s+to\s+the\s+(consolidated\s+)?financial\s+statements"
)
SEGMENT = r"segment\s+(information|reporting|overview|results?)|(operating|business|reportable)\s+segments?|segmentöversikt|segmentinformation|business\s+areas?\s+(overview|results?|performance)"
HIGHLIGHTS = r"\bat\s+a\s+glance\b|\bhighlights\b|\bi\s+korthet\b|\bnyckeltal\b|\bkey\s+figures?\b|\bfinancial\s+summary\b|\bfinansöversikt\b"
MANAGEMENT = r"\b(group\s+)?management\b|\bkoncernledning\b|\bstyrelse\b|\bboard\s+of\s+directors\b|\bleadership\b"
_BOTH_COMPANIES = r"koncernens\s+och\s+moderbolaget|(the\s+)?group\s+and\s+(the\s+)?parent|consolidated\s+and\s+(parent|separate)"
GHOST = r"rörelseresultat\s+före\s+finansiella"
# Wording around a label that speaks of a meeting, an election or another person, and words that are no names.
MEETING = r"\bagm\b|annual\s+general\s+meeting|extraordinary\s+general|bolagsstämma|bolagsstamma|\bkallelse\b|postal\s+vot(e|ing)|\bröstmaterial\b|notice\s+of\s+(the\s+)?(annual|general)\s+meeting|valberedningens\s+förslag"
NOMINATION = r"\bproposal\b|\bnomination\s+committee\b|\belection\s+of\b|\bvalberedning\b|\bförslag\s+till\s+styrelsen\b"
OTHER_ROLE = r"\bchairman\b|\bordförande\b|\bchief\s+financial\s+officer\b|(^|[^a-z])cfo([^a-z]|$)|\bauditor\b|\brevisor\b"
FORMER = r"\bformer\b|\btidigare\b|\bex[\s-]|\bfd\b|\bwhich\b"
OTHER_COMPANY = r"\bceo\s+(of|at|för)\s+|\bvd\s+(of|at|för|på)\s+"
OTHER_LINE = r"company\s+of\s+which\b.*\bceo\b|shareholder.*\bceo\b"
NO_NAMES = (
    "top management|group management|management team|board of directors|executive team|executive committee|senior leadership|group functions|corporate governance|annual report|sustainability report|financial statements|income statement|table of contents|chairman|the board|supervisory board|"
    "ordförande|chief financial officer|cfo|auditor|revisor|board member|styrelseledamot|single electronic format|electronic format|esef report|managing partner|internal audit"
)
CORPORATE = r"\b(group|board|committee|team|communications|holding|capital|partners|investment|management|report|statement|corporate|governance|foundation|business|area|president|director|officer|vice|senior|division|segment|unit|meeting|annual|general)\b"
COMMON = r"\b(things|about|with|from|that|this|what|where|which|their|these|those|have|been|will|would|could|should|does)\b"
SMALL_WORDS = r"(^|\s)(we|do|an|if|or|so|at|by|in|on|to|up|is|it|no)(\s|$)"
BOILERPLATE = (
    "single electronic format|electronic format|esef|changing world|administrative heads|norwegian property|exchange act|chief human resources|building sweden|financial manager|comments on the|internal control|investor relations|corporate governance|audit committee|"
    "risk management|north america|south america|latin america|europe middle east|asia pacific|middle east|parent com|holding company|group plc|group ab|moderbolag"
)
_NAME = r"([A-ZÅÄÖÉÜ][a-zåäöéü]+(?:[\s-]+(?:von\s+|af\s+|de\s+)?[A-ZÅÄÖÉÜ][a-zåäöéü]+){1,3})"
#: Revenue in billions is a sentence's or a picture's, not a table's.
IN_WORDS = r"sek\s+billion|\bbsek\s*\d"
#: Lines of the letter at a report's front, and how often a rejected name is looked for again.
LETTER, TRIES = 800, 3


def report_lines(text: Column) -> Column:
    """``array<struct<no, line>>`` of the trimmed lines that aren't empty."""
    kept = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(F.regexp_replace(x, r"[\r\t]", "  "))), lambda x: x != "")
    return F.transform(kept, lambda line, i: F.struct(i.alias("no"), line.alias("line")))


def parent_only(line: Column) -> Column:
    """A statement's heading that names the parent company and not the group."""
    return ~matches(line, _BOTH_COMPANIES) & ~matches(line, r"koncern(ens)?|consolidated|konsoliderad") & matches(line, r"moderbolag|parent\s+compan")


def _numbers(lines: Column, condition) -> Column:
    return F.transform(F.filter(lines, condition), lambda x: x["no"])


_HEADING = rf"^.{{0,14}}?({STATEMENT})(.{{0,9}}|\s*\d{{1,3}}\s*)$"


def _short_lines(lines: Column, n: int, *patterns: str) -> Column:
    """``array<struct<no, line, low>>``: the lines of at most ``n`` characters that hold a literal of one of the patterns, with their folded text; only these are held against the patterns."""
    short = F.transform(F.filter(lines, lambda x: F.length(x["line"]) <= n), lambda x: F.struct(x["no"].alias("no"), x["line"].alias("line"), folded(x["line"]).alias("low")))
    return F.filter(short, lambda x: may_match(x["low"], *patterns))


def _sections(marked: Column, size: Column) -> Column:
    def build(x: Column) -> Column:
        edges, size = x["edges"], x["size"]

        def section(h: Column) -> Column:
            following = F.array_min(F.transform(F.filter(edges, lambda e: e["no"] > h["no"]), lambda e: e["no"]))
            return F.struct(h["no"].alias("first"), F.least(F.coalesce(following, size), h["no"] + 80, size).alias("stop"), parent_only(h["line"]).alias("parent"))

        found = F.transform(F.filter(edges, lambda e: e["heading"]), section)
        long = F.filter(found, lambda s: (s["stop"] - s["first"] >= 5) | ((s["stop"] >= size) & (s["stop"] - s["first"] >= 2)))
        return let(long, lambda s: let(F.filter(s, lambda y: ~y["parent"]), lambda own: F.when(F.size(own) > 0, own).otherwise(s)))

    return let(F.struct(F.filter(marked, lambda e: e["heading"] | e["boundary"]).alias("edges"), size.alias("size")), build)


def structure(lines: Column) -> Column:
    """A struct of the places that finding needs: ``sections, highlights, marks``; a mark is a segment's or a statement's heading.

    Sections are ``array<struct<first, stop, parent>>`` in order: from a heading to the next heading or boundary, 80 lines at most; five lines at least, or two at the report's end. Those of
    the parent company alone count only if there are no others.
    """

    def mark(x: Column) -> Column:
        fits = lambda p: matches(x["line"], p, x["low"])
        statement = fits(STATEMENT)
        return F.struct(
            x["no"].alias("no"),
            x["line"].alias("line"),
            statement.alias("statement"),
            (statement & x["line"].rlike("(?iu)" + _HEADING)).alias("heading"),
            fits(BOUNDARY).alias("boundary"),
            fits(SEGMENT).alias("segment"),
            ((F.length(x["line"]) <= 80) & fits(HIGHLIGHTS)).alias("highlight"),
        )

    def places(marked: Column) -> Column:
        marks = F.transform(F.filter(marked, lambda m: m["segment"] | m["statement"]), lambda m: F.struct(m["no"].alias("no"), m["segment"].alias("segment")))
        return F.struct(_sections(marked, F.size(lines)).alias("sections"), _numbers(marked, lambda m: m["highlight"]).alias("highlights"), marks.alias("marks"))

    # Each line is held against the patterns once. The struct is bound, since the optimizer would copy a plain one's fields into every place that reads them, loops over hits included.
    return let(F.transform(_short_lines(lines, 120, STATEMENT, BOUNDARY, SEGMENT, HIGHLIGHTS), mark), places)


def in_segment(places: Column, no: Column) -> Column:
    """The nearest mark of the 40 lines above, the line itself included, is a segment's."""
    near = F.filter(places["marks"], lambda m: (m["no"] <= no) & (m["no"] >= no - 40))
    return F.coalesce(F.try_element_at(near, F.lit(-1))["segment"], F.lit(False))


def find_figure(lines: Column, places: Column, labels: list[str] | tuple[Column, str], year: str | None = None, excluded: tuple[str, ...] = ex.EXCLUDED, skipped: str | None = None, labelled: Column | None = None) -> Column:
    """``struct<context, section, pass_no, rank, no, value, label>`` of a labelled figure: in statements in their order, then on pages of key figures (30 lines), then elsewhere but in segments. Lines that match ``skipped`` are no table's.
    ``labelled`` are the lines that hold a label, if they are known."""

    def value(hit: Column) -> Column:
        line = F.get(lines, hit["no"])["line"]
        tail = F.substring(line, hit["after"], F.length(line))
        below = F.coalesce(F.get(lines, hit["no"] + 1)["line"], F.lit(""))
        cut = F.when(tail.rlike(r"\d"), tail).otherwise(F.when(below.rlike(r"^[\s\d(–−-]"), below).otherwise(F.lit("")))
        v = ex.pick_cell(ex.cells(cut), ex.header_above(lines, hit["no"]), year)
        return F.struct(hit["pass_no"].alias("pass_no"), hit["rank"].alias("rank"), hit["no"].alias("no"), v.alias("value"), hit["label"].alias("label"), (matches(line, GHOST) & ~line.rlike(r"\d")).alias("ghost"))

    def place(f: Column) -> Column:
        no = f["no"]
        inside = F.transform(places["sections"], lambda s: (s["first"] <= no) & (no < s["stop"]))
        shown = F.transform(places["highlights"], lambda h: (h <= no) & (no < h + 30))
        section, highlight = F.array_position(inside, True), F.array_position(shown, True)
        segment = in_segment(places, no)
        key = lambda c, k: F.struct(F.lit(c).alias("context"), k.cast("int").alias("section"), f["pass_no"].alias("pass_no"), f["rank"].alias("rank"), no.alias("no"), f["value"].alias("value"), f["label"].alias("label"))
        return F.when((section > 0) & ~(f["ghost"] & segment), key(0, section)).when(highlight > 0, key(1, highlight)).when(~segment, key(2, F.lit(0)))

    found = lines if labelled is None else labelled
    rows = F.filter(found, lambda x: ~matches(x["line"], skipped)) if skipped else found
    hits = F.filter(F.transform(ex.label_hits(rows, labels, excluded=excluded), value), lambda f: f["value"].isNotNull())
    return F.array_min(F.array_compact(F.transform(hits, place)))


def second_pass_ebit(lines: Column, places: Column, kind: Column, labels: list[str] | tuple[Column, str], revenue: Column, unit: Column, year: str | None = None, labelled: Column | None = None) -> Column:
    """Operating profit of the longest statement that has an acceptable one: no fused years, no segment, and not beyond revenue: 1.05 times; for banks 1.35 times and 20,000 more, for landlords
    three times. Investment companies have none."""

    def of(labels: list[str] | tuple[Column, str], rank: int, excluded: tuple[str, ...]) -> Column:
        def value(hit: Column) -> Column:
            line = F.get(lines, hit["no"])["line"]
            v = num.to_msek(ex.pick_cell(ex.cells(F.substring(line, hit["after"], F.length(line))), ex.header_above(lines, hit["no"]), year), unit)
            s = F.get(F.filter(places["sections"], lambda s: (s["first"] <= hit["no"]) & (hit["no"] < s["stop"])), F.lit(0))
            return F.struct((s["first"] - s["stop"]).alias("span"), s["first"].alias("first"), F.lit(rank).alias("list"), hit["pass_no"].alias("pass_no"), hit["rank"].alias("rank"), hit["no"].alias("no"), v.alias("value"))

        return F.filter(F.transform(ex.label_hits(lines if labelled is None else labelled, labels, excluded=excluded), value), lambda f: f["span"].isNotNull() & f["value"].isNotNull())

    known = F.coalesce(revenue > 0, F.lit(False))

    def fits(v: Column) -> Column:
        return F.when(kind == "bank", (v <= 1.35 * revenue) & (v - revenue <= 20_000)).when(kind == "real_estate", v <= 3 * revenue).otherwise(v <= 1.05 * revenue)

    def choose(both: Column) -> Column:
        # Of each statement the first line counts; a refused one sends the search to the next statement.
        firsts = F.filter(both, lambda f, i: (i == 0) | (F.get(both, i - 1)["first"] != f["first"]))
        good = F.filter(firsts, lambda f: ~num.fused_years(f["value"]) & ~in_segment(places, f["no"]) & (~known | F.coalesce(fits(f["value"]), F.lit(True))))
        return F.get(good, F.lit(0))["value"]

    both = F.array_sort(F.concat(of(labels, 0, ex.EXCLUDED), of(ex.LABELS["industrial"]["adjusted"], 1, ("never before",))))
    return F.when(kind != "investment_company", let(both, choose))


def no_name(name: Column) -> Column:
    """A heading, a title or a sentence, not a person."""
    low = F.lower(name)
    return low.rlike(f"^({NO_NAMES})") | matches(name, CORPORATE) | matches(name, r"^the\s+\w+$") | matches(name, COMMON) | matches(name, SMALL_WORDS)


def rejected_name(name: Column, company: Column) -> Column:
    """Boilerplate, or an echo of the company's name: two words of three letters or more that it holds all."""
    words = F.filter(F.split(F.lower(name), "[^a-zåäö]+"), lambda w: F.length(w) >= 3)
    echo = (F.size(words) >= 2) & F.forall(words, lambda w: F.lower(company).contains(w))
    return matches(name, BOILERPLATE) | F.coalesce(echo, F.lit(False))


def chief_names(lines: Column, labels: list[str] = ex.CEO_LABELS) -> Column:
    """``array<struct<window, section, rank, no, pattern, name, line>>``, best first: names beside a label in the first 800 lines, then in parts about the management.

    Of a labelled line the order is the line above, after the label, before it, the line below. Lines about meetings, elections, other roles, former holders and other companies give none.
    """
    managed = _numbers(lines, lambda x: (F.length(x["line"]) <= 80) & matches(x["line"], MANAGEMENT))
    text = lambda no: F.coalesce(F.get(lines, no)["line"], F.lit(""))
    previous = lambda no: F.when(no > 0, text(no - 1)).otherwise("")

    def names(hit: Column) -> Column:
        no, line, at, n = hit["no"], hit["line"], hit["at"], hit["n"]
        above, below = previous(no), text(no + 1)
        block = F.concat_ws(" ", F.when(no > 1, text(no - 2)).otherwise(""), above, line, below)
        before, after = F.substring(line, F.lit(1), at - 1), F.substring(line, at + n, F.length(line))
        other = matches(line, OTHER_ROLE) & ~matches(line, r"\bceo\b|\bvd\b")
        gone = matches(before, FORMER) | matches(F.substring(line, at, F.length(line)), OTHER_COMPANY) | matches(line, OTHER_LINE)
        bad = matches(block, MEETING) | matches(block, NOMINATION) | other | gone
        tries = (
            (above, "^" + _NAME + "$", no - 1),
            (F.regexp_replace(after, r"^[:\s–—,.-]+", ""), _NAME, no),
            (F.regexp_replace(before, r"[,:\s–—.-]+$", ""), _NAME, no),
            (below, _NAME, no + 1),
        )
        def candidate(k: int, part: Column, pattern: str, row: Column) -> Column:
            kept = lambda name: F.when(name.isNotNull() & ~no_name(name), F.struct(hit["window"].alias("window"), hit["section"].alias("section"), hit["rank"].alias("rank"), no.alias("no"), F.lit(k).alias("pattern"), name.alias("name"), row.alias("line")))
            return let(F.nullif(F.regexp_extract(part, pattern, 1), F.lit("")), kept)

        found = F.array(*(candidate(k, *t) for k, t in enumerate(tries)))
        return F.when(bad, F.filter(F.array_compact(found), lambda _: F.lit(False))).otherwise(F.array_compact(found))

    ranked = F.array(*(F.struct(F.lit(x).alias("label"), F.lit(r).alias("rank")) for r, x in enumerate(labels)))

    def labelled(label: Column, titled: Column, managed: Column) -> Column:
        here = F.filter(titled, lambda x: x["low"].contains(label["label"]))

        def windows(x: Column) -> Column:
            parts = F.transform(managed, lambda m: (x["no"] >= m - 2) & (x["no"] < m + 40))
            section = F.array_position(parts, True).cast("int")
            hit = lambda w, s: F.struct(F.lit(w).alias("window"), s.alias("section"), label["rank"].alias("rank"), x["no"].alias("no"), x["line"].alias("line"), F.instr(x["low"], label["label"]).alias("at"), F.length(label["label"]).alias("n"))
            return F.array_compact(F.array(F.when(x["no"] < LETTER, hit(0, F.lit(0))), F.when(section > 0, hit(1, section))))

        return F.flatten(F.transform(here, windows))

    # Both are bound: inside the loops over labels and hits they would be found anew for each.
    lower = F.transform(ex.labelled_lines(lines, labels), lambda x: F.struct(x["no"].alias("no"), x["line"].alias("line"), F.lower(x["line"]).alias("low")))
    places = F.struct(lower.alias("titled"), managed.alias("managed"))
    hits = F.array_sort(let(places, lambda p: F.flatten(F.transform(ranked, lambda label: labelled(label, p["titled"], p["managed"])))))
    return F.flatten(F.transform(hits, names))


def chief_executive(lines: Column, company: Column) -> Column:
    """The first of three candidates on different lines that isn't rejected."""

    def choose(found: Column) -> Column:
        rows = F.transform(found, lambda f: f["line"])
        apart = F.filter(found, lambda f, i: F.array_position(rows, f["line"]) == i + 1)
        good = F.filter(F.slice(apart, 1, TRIES), lambda f: ~rejected_name(f["name"], company))
        return F.get(good, F.lit(0))["name"]

    return let(chief_names(lines), choose)


def extract_reports(docs: DataFrame, year: int, id_col: str = "doc_id", text_col: str = "text", company: str = "company", hint: str | None = None) -> DataFrame:
    """``doc_id, company_type, unit, revenue, ebit, employees, ceo, fiscal_year, notes`` of each report, in millions.

    The type is voted for, or hinted. Revenue is a labelled figure or a sentence's; operating profit the direct one, the adjusted one, EBITA less amortisation, margin times revenue, or a second pass over the
    statements, in that order and never beyond 1.05 times an industrial company's revenue; investment companies have none. Headcounts are labelled or the largest that a sentence states. Notes tell of what is missing.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(company).alias("company"), texts.vote_type(F.col(text_col), hint=F.col(hint) if hint else None).alias("company_type"))
    base = base.withColumns({"lines": report_lines(F.col("text")), "unit": num.unit_context(F.col("text"))})
    # Lines without a label of any figure are passed over once, not once a figure.
    words = [x for fields in ex.LABELS.values() for labels in fields.values() for x in labels] + ex.EMPLOYEES
    base = base.withColumns({"places": structure(F.col("lines")), "labelled": ex.labelled_lines(F.col("lines"), words)})
    wanted, lines, places, unit, kind, some = str(year), F.col("lines"), F.col("places"), F.col("unit"), F.col("company_type"), F.col("labelled")
    industrial, own = ex.LABELS["industrial"], {k: v for k, v in ex.LABELS.items() if k != "industrial"}
    of_kind = lambda field: ex.labels_of(kind, {k: v[field] for k, v in own.items()}, industrial[field])
    plain = lambda field: find_figure(lines, places, industrial[field], wanted, ("never before",), labelled=some)
    rows = base.withColumns(
        {
            "revenue_f": find_figure(lines, places, of_kind("revenue"), wanted, skipped=IN_WORDS, labelled=some),
            "direct_f": find_figure(lines, places, of_kind("ebit"), wanted, labelled=some),
            "adjusted_f": plain("adjusted"),
            "ebita_f": plain("ebita"),
            "amort_f": plain("amortisation"),
            "margin": ex.margin_percent(some),
            "employees_f": find_figure(lines, places, ex.EMPLOYEES, wanted, labelled=some),
            "ceo": chief_executive(lines, F.col("company")),
        }
    )
    # A type's own labels everywhere before the common ones anywhere.
    rows = rows.withColumn("revenue_f", F.coalesce("revenue_f", F.when(kind.isin(*own), find_figure(lines, places, industrial["revenue"], wanted, skipped=IN_WORDS, labelled=some))))
    table = num.to_msek(F.col("revenue_f.value"), unit)
    headcount = F.col("employees_f.value")
    people = F.when(headcount.between(1, 1_000_000) & ~headcount.between(2000, 2035), headcount)
    rows = rows.withColumns({"revenue": F.coalesce(table, narrative_revenue(F.col("text"))), "employees": F.coalesce(people, narrative_employees(F.col("text")))})
    revenue = F.col("revenue")
    rows = rows.withColumn("second", second_pass_ebit(lines, places, kind, of_kind("ebit"), revenue, unit, wanted, some))
    near = F.abs(F.col("amort_f.no") - F.col("ebita_f.no")) <= 15
    amort = F.abs("amort_f.value")
    ebita = F.when(near & (amort > 0) & (amort < 2 * F.abs("ebita_f.value")), F.col("ebita_f.value") - amort).otherwise(F.col("ebita_f.value"))
    fits = lambda v: F.when((kind != "industrial") | revenue.isNull() | (revenue <= 0) | (v <= 1.05 * revenue), v)
    ladder = {
        "direct": fits(num.to_msek(F.col("direct_f.value"), unit)),
        "adjusted": fits(num.to_msek(F.col("adjusted_f.value"), unit)),
        "ebita": fits(num.to_msek(ebita, unit)),
        # A margin needs a revenue of a table.
        "margin": round_half_up(table * F.col("margin") / 100),
        "second_pass": F.col("second"),
    }
    has_profit = kind != "investment_company"
    rows = rows.withColumns({"ebit": F.when(has_profit, F.coalesce(*ladder.values())), "strategy": F.when(has_profit, F.coalesce(*(F.when(v.isNotNull(), name) for name, v in ladder.items())))})
    head = [F.nullif(F.regexp_extract(F.substring("text", 1, n), ex.YEAR_LABELS, 1), F.lit("")).cast("int") for n in (3_000, 15_000, 120_000)]
    notes = F.array_compact(
        F.array(
            F.when(F.col("revenue").isNull(), "Revenue not found"),
            F.when(F.col("ebit").isNull() & (F.col("company_type") != "investment_company"), "EBIT not found"),
            F.when(F.col("strategy").isin("adjusted", "ebita", "margin", "second_pass"), F.concat(F.lit("EBIT by "), "strategy")),
            F.when(F.col("employees").isNull(), "Employee count not extracted"),
            F.when(F.col("ceo").isNull(), F.concat(F.lit("CEO not found for "), F.coalesce("company", F.lit("")))),
        )
    )
    return rows.select("doc_id", "company_type", "unit", "revenue", "ebit", "employees", "ceo", F.coalesce(*head).alias("fiscal_year"), notes.alias("notes"))
