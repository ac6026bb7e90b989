"""Connected components of an edge table by alternating large-star and small-star steps, never on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``: the smallest node it is connected with. Nodes are non-null longs.

    Each step joins a table of minima by node, so a hub's edges are split by adaptive execution instead of meeting in one task, and ends in a written
    table. Stops when a round changes nothing.
    """
    now = scratch.save(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges0")
    state, step = _state(now), 0
    while state[0]:
        step += 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.save(large, f"large{step}")
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lower.select("u", F.col("m").alias("v")))
        then = scratch.save(small.where("u <> v").distinct(), f"edges{step}")
        scratch.drop(f"large{step}")
        scratch.drop(f"edges{step - 1}")
        now, before = then, state
        state = _state(now)
        if state == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
