"""Line dedup over overlapping windows of three lines. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import Scratch, fresh


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, text_hash, starts``: for each document with any, the first lines of the windows that also begin earlier, by identifier and then by line.

    A window is ``width`` consecutive lines, told apart by two independent 64-bit hashes; a window of blank lines only is none. Rows that
    share identifier and text count as one document.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), _lines(text).alias("lines"))
    rows = rows.where(F.size("lines") >= width)
    hashed = rows.select(
        "doc_id",
        "text_hash",
        F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("second"), x).alias("b"), (F.trim(x) == "").alias("blank"))).alias("h"),
    )
    at = lambda name, i: [F.element_at("h", i + 1 + k)[name] for k in range(width)]

    def window(i: Column) -> Column:
        blank = at("blank", i)
        return F.struct(
            i.alias("line"),
            F.xxhash64(*at("a", i)).alias("a"),
            F.xxhash64(F.lit("second"), *at("b", i)).alias("b"),
            F.array_contains(F.array(*blank), F.lit(False)).alias("counts"),
        )

    starts = F.sequence(F.lit(0), F.size("h") - width)
    windows = hashed.select("doc_id", "text_hash", F.explode(F.transform(starts, window)).alias("w")).where("w.counts").select("doc_id", "text_hash", "w.line", "w.a", "w.b")
    place = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("d"), F.col("text_hash").alias("t"), F.col("line").alias("l"))
    first = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("a", "b", "first")
    later = windows.join(first, ["a", "b"]).where(place > F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("starts"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """The input rows with their columns, ``text_col`` without repeated passages, and ``lines_removed``, ``lines_kept`` after them.

    Every line that lies in a window of ``width`` lines which also begins earlier (smaller identifier, nulls first; or earlier in the same document)
    is removed: removed windows that overlap are merged. The first occurrence stays whole. Texts of fewer lines have no window and stay, and
    so does an empty text; a null text stays null. Copies of one text with other identifiers lose all lines and become empty texts; rows that
    share identifier and text are treated alike. An empty table gives an empty result. Input columns of the two new names are replaced.

    Line hashes are shuffled, not lines; the first place of a window is a pre-aggregated minimum, and adaptive execution splits the join on a window that very
    many documents share. The only whole texts moved are those joined with their own removed lines.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    key, hashed, starts = fresh(docs, "key", "hashed", "starts")
    marks = scratch.save(repeated_windows(docs, id_col, text_col, width), "marks").select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed), F.col("starts").alias(starts))
    text = F.col(text_col).cast("string")
    same = docs[id_col].cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == F.col(hashed))
    # A sort-merge join at every size: texts are shuffled once, and nothing is broadcast that grows with the input.
    joined = docs.join(marks.hint("merge"), same, "left")
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + width - 1)))))

    def between(s: Column, j: Column) -> Column:
        """The kept lines after the j-th removed one, up to the next."""
        start = F.when(j == 0, 0).otherwise(F.get(s["gone"], j - 1) + 1)
        end = F.when(j == F.size(s["gone"]), F.size(s["lines"])).otherwise(F.get(s["gone"], j))
        return F.slice(s["lines"], start + 1, end - start)

    def kept(s: Column) -> Column:
        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["gone"])), lambda j: between(s, j))), "\n")

    # Bound to a lambda variable, the lines and the removed positions are computed once for each document.
    bound = F.array(F.struct(_lines(text).alias("lines"), covered.alias("gone")))
    touched = F.col(starts).isNotNull()
    new = {"lines_removed": F.when(touched, F.size(covered)).otherwise(F.lit(0)), "n_lines": F.when(text.isNull(), F.lit(0)).otherwise(F.size(_lines(text)))}
    own = [F.when(touched, F.get(F.transform(bound, kept), F.lit(0))).otherwise(text).alias(text_col) if c == text_col else docs[c] for c in docs.columns if c not in ("lines_removed", "lines_kept")]
    return joined.select(*own, new["lines_removed"].alias("lines_removed"), (new["n_lines"] - new["lines_removed"]).alias("lines_kept"))
