"""Adjudication of two tracks' values, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative tolerance in tenths of a percent.
TOLERANCE = {"employees": 0, "ebit": 10, "revenue": 5}


def equal_within(field: Column, a: Column, b: Column) -> Column:
    """Employees must be equal, EBIT within 1 %, revenue within 0.5 % of the larger. Multiplied out, so integers compare exactly."""
    allowed = F.when(field == "ebit", TOLERANCE["ebit"]).when(field == "revenue", TOLERANCE["revenue"]).otherwise(TOLERANCE["employees"])
    return F.abs(a - b) * 1000 <= allowed * F.greatest(F.abs(a), F.abs(b))


def adjudicate(rows: DataFrame) -> DataFrame:
    """``rows``: field, det, llm, quoted (the quote was verified), det_ok and llm_ok (the value survives validation), quote_len, snippet_len.

    Adds ``outcome`` (accept_det, accept_llm, review, failed), ``case_no`` and ``value``. An unverified quote removes the second value before the cases.
    """
    llm = F.when(F.col("quoted"), F.col("llm"))
    rows = rows.withColumn("l", llm)
    d, l = F.col("det"), F.col("l")  # noqa: E741
    both = d.isNotNull() & l.isNotNull()
    same = both & equal_within(F.col("field"), d, l)
    det_ok, llm_ok = F.col("det_ok"), F.col("llm_ok")
    strong_llm, strong_det = llm_ok & (F.col("quote_len") >= 48), det_ok & (F.col("snippet_len") >= 20)
    case = (
        F.when(same & det_ok, 1)
        .when(same & llm_ok, 2)
        .when(same, 3)
        .when(both & strong_llm & ~strong_det, 4)
        .when(both & strong_det & ~strong_llm, 5)
        .when(both, 6)
        .when(d.isNotNull() & det_ok, 8)
        .when(d.isNull() & l.isNotNull() & llm_ok, 9)
        .otherwise(11)
    )
    rows = rows.withColumn("case_no", case)
    outcome = (
        F.when(F.col("case_no").isin(1, 5, 8), "accept_det")
        .when(F.col("case_no").isin(2, 4, 9), "accept_llm")
        .when((F.col("case_no") == 11) & d.isNull() & l.isNull(), "failed")
        .otherwise("review")
    )
    rows = rows.withColumn("outcome", outcome)
    return rows.withColumn("value", F.when(F.col("outcome") == "accept_det", d).when(F.col("outcome") == "accept_llm", l)).drop("l")
