"""Upserts, diffs, set operations by key and lookups with fallback keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIELDS = ("revenue", "ebit", "employees", "ceo")


def upsert(stored: DataFrame, fresh: DataFrame, key: str = "company", fold: bool = True, drop_null_keys: bool = False) -> DataFrame:
    """Stored rows, replaced where a fresh row has the key, then the fresh rows with new keys. Of equal keys on one side the last (stored: first) counts.

    One full outer join on the key: both sides are shuffled once, and no side is broadcast for its own sake. With ``drop_null_keys`` rows without key go; otherwise they stay apart.
    """
    k = F.lower(key) if fold else F.col(key)

    def one(df: DataFrame, last: bool) -> DataFrame:
        rows = df.withColumn("_k", k)
        if drop_null_keys:
            rows = rows.where("_k IS NOT NULL")
        pick = F.max_by if last else F.min_by
        return rows.groupBy("_k").agg(pick(F.struct(*df.columns), "ord").alias("row"))

    old, new = one(stored, False).withColumnRenamed("row", "old"), one(fresh, True).withColumnRenamed("row", "new")
    merged = old.join(new, "_k", "full_outer")
    return merged.select(F.coalesce("new", "old").alias("row"), F.when(F.isnotnull("old") & F.isnotnull("new"), "replaced").when(F.isnotnull("old"), "kept").otherwise("added").alias("change")).select("row.*", "change")


def prefer_base(base: DataFrame, other: DataFrame, key: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Null fields of ``base`` filled from ``other``."""
    extra = other.select(key, *(F.col(f).alias(f"_{f}") for f in fields))
    joined = base.join(extra, key, "left")
    return joined.select(*(F.coalesce(c, f"_{c}").alias(c) if c in fields else F.col(c) for c in base.columns))


def apply_overrides(base: DataFrame, overrides: DataFrame, key: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Manual values win, an explicit null too: ``overrides`` has a value and ``has_<field>`` for each field."""
    extra = overrides.select(key, *(F.col(f).alias(f"_{f}") for f in fields), *(F.col(f"has_{f}").alias(f"_has_{f}") for f in fields))
    joined = base.join(extra, key, "left")
    return joined.select(*(F.when(F.col(f"_has_{c}"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in base.columns))


def canary_diff(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Regressions of complete baseline rows: the status fell, or else a field became null. Keys are ``lower(ticker or company)``; missing candidates are ignored."""
    key = F.lower(F.coalesce("ticker", "company")).alias("key")
    b = base.where("status = 'complete'").select(key, *(F.col(f).alias(f"b_{f}") for f in FIELDS))
    c = candidate.select(key, F.col("status").alias("c_status"), *(F.col(f).alias(f"c_{f}") for f in FIELDS))
    fell = F.when(F.col("c_status") != "complete", F.array(F.lit("status")))
    nulled = F.array_compact(F.array(*(F.when(F.isnotnull(f"b_{f}") & F.isnull(f"c_{f}"), f) for f in FIELDS)))
    return b.join(c, "key").select("key", F.explode(F.coalesce(fell, nulled)).alias("regression"))


def dedupe_first(rows: DataFrame, key: list[str | Column], order: list[str]) -> DataFrame:
    """The first row of each key; a pre-aggregated minimum, so a hot key costs one row per task."""
    named = [(F.col(c) if isinstance(c, str) else c).alias(f"_k{i}") for i, c in enumerate(key)]
    picked = rows.select(*named, F.struct(*rows.columns).alias("row"), F.struct(*order).alias("o")).groupBy(*(f"_k{i}" for i in range(len(key)))).agg(F.min_by("row", "o").alias("row"))
    return picked.select("row.*")


def dedupe_max(rows: DataFrame, key: list[str], score: str, order: str) -> DataFrame:
    """The row of each key with the highest score, ties to the first."""
    kept = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*kept), F.struct(F.col(score), -F.col(order))).alias("row")).select(*key, "row.*")


_WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Types whose values a hash aggregate can replace in place.
_FIXED = (*_WHOLE, "boolean", "float", "double", "date", "timestamp")


def union_first(parts: list[DataFrame], key: list[str], order: str) -> DataFrame:
    """Union in which a key's first part wins, then the first row.

    Where the columns besides the key have values of fixed size and the order is a whole number, part and order become one number and the first row is kept by hash: a task holds a row a key. Otherwise the rows are sorted by key.
    """
    rows = reduce(DataFrame.unionByName, [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    types = dict(rows.dtypes)
    kept = [c for c in rows.columns if c not in key and c != "_part"]
    if types[order] not in _WHOLE or any(types[c] not in _FIXED for c in kept):
        return dedupe_first(rows, key, ["_part", order]).drop("_part")
    # A part's numbers lie above all of the part before it; null orders come first in theirs.
    number = F.coalesce(F.col(order).cast("decimal(20,0)"), F.lit(str(-(2**63) - 1)).cast("decimal(20,0)"))
    place = (F.col("_part").cast("decimal(10,0)") * F.lit(str(2**65)).cast("decimal(20,0)") + number).cast("decimal(38,0)")
    first = rows.withColumn("_place", place).groupBy(*key).agg(*(F.min_by(c, "_place").alias(c) for c in kept))
    return first.select(*parts[0].columns)


def except_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.join(known.select(key).distinct(), key, "left_anti")


def lookup_with_fallback(rows: DataFrame, registry: DataFrame, variants: list[Column], key: str = "key") -> DataFrame:
    """Each row with the entry of its first key variant that the registry has. ``rows`` has a unique ``id``."""
    tries = rows.select("id", F.posexplode(F.array(*variants)).alias("rank", "variant"))
    hits = tries.join(registry.withColumnRenamed(key, "variant"), "variant")
    kept = [c for c in registry.columns if c != key]
    found = hits.groupBy("id").agg(F.min_by(F.struct("variant", *kept), "rank").alias("hit"))
    return rows.join(found, "id", "left").select(*rows.columns, "hit.*")


def running_failures(fetches: DataFrame, limit: int = 3, streak: int = 2) -> DataFrame:
    """Circuit breaker per company and host in order: a fetch is ``skipped`` once ``limit`` failures have come before, or the last ``streak`` were all refused (403, 404).

    The streak restarts at any other outcome. One window per host, so a company's fetches spread over its hosts.
    """
    before = Window.partitionBy("company_id", "host").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    refused = F.col("status").isin(403, 404)
    up_to = Window.partitionBy("company_id", "host").orderBy("ord")
    marked = fetches.withColumn("failed", (F.col("status") >= 400).cast("int")).withColumn("refused", refused)
    marked = marked.withColumn("failures_before", F.coalesce(F.sum("failed").over(before), F.lit(0)))
    runs = marked.withColumn("_n", F.row_number().over(up_to)).withColumn("_ok_n", F.max(F.when(~F.col("refused"), F.col("_n"))).over(before))
    runs = runs.withColumn("streak_before", (F.col("_n") - 1 - F.coalesce("_ok_n", F.lit(0))).cast("int"))
    skipped = (F.col("failures_before") >= limit) | (F.col("streak_before") >= streak)
    return runs.withColumn("skipped", skipped).select("company_id", "host", "ord", "status", "failures_before", "streak_before", "skipped")
