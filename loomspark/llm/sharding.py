"""Sharding by global byte-size prefix sums: contiguous shards of near-equal bytes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.common import Scratch, shuffle_partitions


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; the law is ``bytes``.

    Rows are ordered by identifier (nulls first), then checksum and size. ``size`` is the text's UTF-8 bytes plus 1 (a null text has none; its checksum is that of no
    bytes, 0). A row belongs to the shard in which its first byte falls when all bytes are cut at equal targets, so a shard
    exceeds the target by less than the largest row. ``slot`` counts a shard's rows from 0 without gaps. Equal texts need not share a shard.
    Repeated rows are separate rows with slots of their own. An empty table gives an empty result; an identifier that a third of all rows share is
    spread by the further sort keys. Other columns are not read.

    Range partitions are written once, since a second sampling could place the bounds elsewhere. The window over totals has a row per
    partition, not per document.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shard")
    n = partitions or shuffle_partitions(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "tie"]
    ranged = scratch.save(rows.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id()), "ranged")

    totals = ranged.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    starts = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(everything).alias("total"),
    )
    within = Window.partitionBy("part").orderBy(*keys)
    placed = (
        ranged.withColumn("bytes_within", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("row_within", F.row_number().over(within) - 1)
        .join(starts, "part")
    )
    first_byte = F.col("bytes_before") + F.col("bytes_within")
    # Quotient and remainder of the total, so that the product can't overflow a long.
    target = F.expr(f"total div {n_shards}"), F.expr(f"total % {n_shards}")
    cut = lambda k: target[0] * k + F.floor(target[1] * k / n_shards)
    shard = sum((F.when(first_byte >= cut(k), 1).otherwise(0) for k in range(1, n_shards)), F.lit(0)).cast("int")
    numbered = placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("rows_before") + F.col("row_within")).cast("long").alias("row"))
    saved = scratch.save(numbered, "numbered")
    scratch.drop("ranged")
    heads = saved.groupBy("shard").agg(F.min("row").alias("head"))  # n_shards rows
    return saved.join(F.broadcast(heads), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("head")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
