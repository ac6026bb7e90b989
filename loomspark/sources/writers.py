"""Sinks: the results envelope, review CSV, partial TSV, run summary."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_results(rows: DataFrame, path: str) -> None:
    """The rows as JSON lines, nulls kept. Tables of any size; the committer makes the write atomic."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_envelope(rows: DataFrame, path: str, generated_at: str) -> None:
    """One JSON envelope ``{generatedAt, companyCount, results}`` for export. It is one value, so it is meant for a company table, not for a corpus."""
    public = [c for c in rows.columns if c != "stages"]
    body = rows.select(F.struct(*public).alias("r")).agg(F.collect_list("r").alias("results"))
    whole = body.select(F.struct(F.lit(generated_at).alias("generatedAt"), F.size("results").alias("companyCount"), "results").alias("v"))
    whole.select(F.to_json("v", {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written beside its place and renamed onto it: readers see the old text or the new one."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), conf).rename(beside, where, options)


def write_preflight(rows: DataFrame, path: str, generated_at: str) -> None:
    """The preflight file ``{generatedAt, companyCount, results}``, highest risk first. One value, for a company table."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("riskScore")).alias("k"), F.struct(*rows.columns).alias("r"))))
    body = rows.agg(F.transform(order, lambda x: x["r"]).alias("results"))
    whole = body.select(F.struct(F.lit(generated_at).alias("generatedAt"), F.size("results").alias("companyCount"), "results").alias("v"))
    replace_text(rows.sparkSession, path, whole.select(F.to_json("v", {"ignoreNullFields": "false"})).first()[0])


def write_null_ledger(rows: DataFrame, tallies: DataFrame, path: str, generated_at: str) -> None:
    """The ledger of null reasons ``{generated_at, source_row_count, per_row, tallies}``: ``tallies`` has field, reason, n. One value, for a company table."""
    per_row = rows.agg(F.to_json(F.collect_list(F.struct(*rows.columns)), {"ignoreNullFields": "false"})).first()[0]
    by_field = tallies.groupBy("field").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("m"))
    counts = by_field.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("field", "m"))))).first()[0]
    items = json.loads(per_row or "[]")
    replace_text(rows.sparkSession, path, json.dumps({"generated_at": generated_at, "source_row_count": len(items), "per_row": items, "tallies": json.loads(counts or "{}")}, ensure_ascii=False))


def seed_results(spark: SparkSession, source: str, target: str) -> None:
    """Copies a results file that is valid JSON; another one is an error and leaves the target alone."""
    texts = [r[0] for r in spark.read.text(source, wholetext=True).collect()]
    if len(texts) != 1 or spark.createDataFrame([(texts[0],)], "v string").select(F.try_parse_json("v").isNull()).first()[0]:
        raise ValueError(f"{source} is no JSON file")
    replace_text(spark, target, texts[0])


def write_registry(registry: DataFrame, path: str) -> None:
    """The enriched registry as one JSON object by ticker, in order. ``registry`` has ticker and its fields."""
    fields = [c for c in registry.columns if c != "ticker"]
    entries = registry.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ticker", F.struct(*fields).alias("e"))))).alias("m"))
    replace_text(registry.sparkSession, path, entries.select(F.to_json("m")).first()[0])


def write_review_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"').csv(path)


def write_partial_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").option("sep", "\t").csv(path)


def write_year_partitioned(documents: DataFrame, path: str, year: str = "fiscal_year") -> None:
    """Texts by year, so that a year's scan prunes the rest; rows are clustered first, so that a task doesn't write every year."""
    documents.repartition(year, F.pmod(F.xxhash64("doc_id"), F.lit(16))).write.mode("overwrite").partitionBy(year).parquet(path)
