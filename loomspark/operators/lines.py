"""Line-structured text: labels, headings, sections and windows around lines.

A document's non-blank lines are one array, ``array<struct<no, line>>``, and every operator is a higher-order function over it: nothing is shuffled or sorted to bring lines together that
came in one row. Only results are exploded. Conditions on lines are functions of a column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.rounding import let

Condition = Callable[[Column], Column]


def line_array(text: Column) -> Column:
    """The non-blank lines; ``no`` counts all lines from 0."""
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("no"), line.alias("line")))
    return F.filter(numbered, lambda x: F.trim(x["line"]) != "")


def with_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), line_array(F.col(text_col)).alias("lines"))


def explode_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per non-blank line: ``doc_id, line_no, line``."""
    return with_lines(docs, id_col, text_col).select("doc_id", F.explode("lines").alias("x")).select("doc_id", F.col("x.no").alias("line_no"), "x.line")


def _rows(docs: DataFrame, values: Column, name: str) -> DataFrame:
    """Lines with a value each, one row a line."""
    pairs = F.arrays_zip(F.col("lines").alias("x"), values.alias("v"))
    return docs.select("doc_id", F.explode(pairs).alias("p")).select("doc_id", F.col("p.x.no").alias("line_no"), F.col("p.x.line").alias("line"), F.col("p.v").alias(name))


def label_first_match(docs: DataFrame, labels: list[str], passes: tuple[tuple[int, int], ...] = ((150, 60), (500, 200))) -> DataFrame:
    """``doc_id, label, line_no, pass_no``: the first labelled line of each document, where the order is pass, then label rank, then line.

    A pass is (longest line, furthest offset). Label order beats line order: a lower-ranked label further up doesn't win. Labels and passes are constants of the plan, so there is no join.
    """
    low = lambda x: F.lower(x["line"])
    some = F.filter("lines", lambda x: low(x).rlike("|".join(labels)))

    def best(x: Column) -> Column:
        def tries(text: Column) -> Column:
            at = lambda label: F.instr(text, label)
            hit = lambda p, r: F.struct(F.lit(p).alias("pass_no"), F.lit(r).alias("rank"), x["no"].alias("line_no"))
            return F.array_min(F.array_compact(F.array(*(F.when((F.length(text) <= longest) & at(label).between(1, offset + 1), hit(p, r)) for p, (longest, offset) in enumerate(passes) for r, label in enumerate(labels)))))

        return let(low(x), tries)

    found = with_lines(docs).select("doc_id", F.array_min(F.array_compact(F.transform(some, best))).alias("m")).where("m IS NOT NULL")
    return found.select("doc_id", F.get(F.array(*map(F.lit, labels)), F.col("m.rank")).alias("label"), "m.line_no", "m.pass_no")


def nearest_above(docs: DataFrame, kind: Condition, reach: int) -> DataFrame:
    """``doc_id, line_no, line, above``: the nearest non-null kind among the line itself and the ``reach`` lines before it."""
    rows = with_lines(docs).withColumn("kinds", F.transform("lines", lambda x: kind(x["line"])))

    def near(_: Column, i: Column) -> Column:
        window = F.slice("kinds", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + 1)
        return F.try_element_at(F.filter(window, lambda k: k.isNotNull()), F.lit(-1))

    return _rows(rows, F.transform("lines", near), "above")


def header_years(docs: DataFrame, reach: int = 3, pattern: str = r"(20[0-9]{2})") -> DataFrame:
    """``doc_id, line_no, line, header``: the nearest of the ``reach`` lines above with at least two years, as its years joined by commas."""

    def years(x: Column) -> Column:
        return let(F.regexp_extract_all(x["line"], F.lit(pattern), F.lit(1)), lambda y: F.when(F.size(y) >= 2, F.array_join(y, ",")))

    rows = with_lines(docs).withColumn("headers", F.transform("lines", years))
    above = F.transform("lines", lambda _, i: F.coalesce(*(F.when(i >= k, F.get("headers", i - k)) for k in range(1, reach + 1))))
    return _rows(rows, above, "header")


def sections(docs: DataFrame, start: Condition, stop: Condition, longest: int = 80) -> DataFrame:
    """``doc_id, first_row, last_row``: from each start row to the row before the next start or stop, at most ``longest`` rows; rows count from 1."""
    kinds = F.transform("lines", lambda x, i: F.struct((i + 1).alias("n"), start(x["line"]).alias("start"), stop(x["line"]).alias("stop")))
    rows = with_lines(docs).select("doc_id", F.size("lines").alias("total"), F.filter(kinds, lambda k: k["start"] | k["stop"]).alias("edges"))

    def section(e: Column, i: Column) -> Column:
        return F.struct(e["start"].alias("start"), e["n"].alias("first_row"), F.least(F.coalesce(F.get("edges", i + 1)["n"] - 1, F.col("total")), e["n"] + longest - 1).alias("last_row"))

    found = F.filter(F.transform("edges", section), lambda s: s["start"])
    return rows.select("doc_id", F.explode(found).alias("s")).select("doc_id", "s.first_row", "s.last_row")


def pair_within(docs: DataFrame, left: Condition, right: Condition, reach: int) -> DataFrame:
    """``doc_id, l_line, r_line``: each left line with the first right line from the top of the window of ``reach`` line numbers around it; left lines without one are left out."""
    # Blank lines count, so a window of 2 * reach + 1 entries of the array holds it whole.
    rows = with_lines(docs).withColumn("marks", F.transform("lines", lambda x: F.when(right(x["line"]), x["no"])))

    def pair(x: Column, i: Column) -> Column:
        window = F.slice("marks", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1))
        near = F.filter(window, lambda r: r.isNotNull() & (F.abs(r - x["no"]) <= reach))
        return F.when(left(x["line"]), F.struct(x["no"].alias("l_line"), F.get(near, F.lit(0)).alias("r_line")))

    pairs = F.filter(F.transform("lines", pair), lambda p: p.isNotNull() & p["r_line"].isNotNull())
    return rows.select("doc_id", F.explode(pairs).alias("p")).select("doc_id", "p.l_line", "p.r_line")


def context(docs: DataFrame, before: int, after: int) -> DataFrame:
    """``doc_id, line_no, line, context``: the lines of the frame, joined by a bar."""
    rows = with_lines(docs)
    frame = lambda _, i: F.array_join(F.transform(F.slice("lines", F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)) + 1 + after), lambda x: x["line"]), "|")
    return _rows(rows, F.transform("lines", frame), "context")


def segment_sums(docs: DataFrame, heading: Condition, value: Condition, longest: int = 22, least: int = 2) -> DataFrame:
    """``doc_id, run, total, n``: the sum of the values on the lines after each heading, up to the next heading or ``longest`` lines; at least ``least`` values are needed. Runs count from 1."""
    rows = with_lines(docs).withColumn("heads", F.transform(F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), heading(x["line"]).alias("h"))), lambda k: k["h"]), lambda k: k["i"]))

    def run(head: Column, k: Column) -> Column:
        end = F.least(F.coalesce(F.get("heads", k + 1), F.size("lines")), head + 1 + longest)
        values = F.filter(F.transform(F.slice("lines", head + 2, end - head - 1), lambda x: value(x["line"])), lambda v: v.isNotNull())
        return let(values, lambda v: F.struct((k + 1).alias("run"), F.aggregate(v, F.lit(0).cast("double"), lambda a, x: a + x).alias("total"), F.size(v).cast("long").alias("n")))

    runs = F.filter(F.transform("heads", run), lambda r: r["n"] >= least)
    return rows.select("doc_id", F.explode(runs).alias("r")).select("doc_id", "r.run", "r.total", "r.n")
