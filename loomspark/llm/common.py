"""Scratch tables in the shared checkpoint folder, and sizes for partitions."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CREATED: list[tuple[SparkSession, str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session without one gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="loomspark-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _clean() -> None:
    for spark, path in _CREATED:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended; the folder is scratch
            pass


atexit.register(_clean)


class Scratch:
    """Tables of one call. ``save`` writes and rereads, so that lineage ends there and a lost executor costs one read.

    A table that no later step reads is dropped with ``drop``; the rest go when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        _CREATED.append((spark, self.root))

    def save(self, df: DataFrame, table: str, compression: str = "zstd") -> DataFrame:
        path = f"{self.root}/{table}"
        df.write.option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, table: str) -> None:
        _delete(self.spark, f"{self.root}/{table}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until they are no columns of ``df``, so that an input may have any columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
