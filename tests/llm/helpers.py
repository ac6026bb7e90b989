"""Small document tables for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = "ab the of x long lorem ipsum é dolor sit amet Straße".split()
#: Columns that operators use inside themselves, to see that an input may have them too.
CLASHING = ("fp", "rep", "doc", "tag", "line", "lines", "digest", "entry", "class", "shard", "slot", "size", "part", "text_hash", "h", "w", "members", "host", "rule", "score", "ids", "lines_removed", "__starts", "__gone", "key", "hashed", "starts", "gone", "n", "kept", "component_id", "sets")


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) for _ in range(n))


def hard_rows(seed: int = 3, n: int = 120) -> list[tuple]:
    """Copies, near copies, shared passages, repeats, empty, null, blank and one very long text; identifiers out of order."""
    r = random.Random(seed)
    base = [prose(r, 70) for _ in range(4)]
    kinds = [
        lambda i: base[i % 4],
        lambda i: base[i % 4].replace(" ", "\n", 30),
        lambda i: base[i % 4] + " " + prose(r, 1),
        lambda i: prose(r, r.randrange(90)),
        lambda i: "\n".join([prose(r, 3), *base[0].split()[:5], prose(r, 2)]),
        lambda i: "\n".join(base[1].split()[:6]) * 2,
        lambda i: "a" * r.randrange(400),
        lambda i: None,
        lambda i: "",
        lambda i: " \n\n\n \n",
    ]
    rows = [(i * 7 % 1000, r.choice(kinds)(i), "en", f"s{i % 3}", 1) for i in range(n)]
    return [*rows, (5000, prose(r, 40_000), "en", "s", 1)]


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *(f"'own' AS `{c}`" for c in CLASHING)) if clashing else df


def by_id(df: DataFrame) -> dict:
    return {r[0]: tuple(r)[1:] for r in df.collect()}
