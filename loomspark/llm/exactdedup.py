"""Exact deduplication through a log-structured merge index.

Memtables take rows in scan order and flush sorted digest runs, each with a filter; runs are merged where their digest
ranges meet, and every digest hit is verified on bytes, so equal digests of different texts stay apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.llm.common import Scratch, shuffle_partitions

_ENTRY = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("head", T.LongType()),
        T.StructField("members", T.ArrayType(T.LongType())),
        T.StructField("sha256", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
_LINK = T.StructType([T.StructField(c, T.LongType()) for c in ("entry", "class", "keep_id", "n")])


class BloomFilter:
    """Filter of one run: ``bits_per_key`` bits for each key, four probes taken from the digest itself."""

    PROBES = 4

    def __init__(self, digests: list[bytes], bits_per_key: int = 10) -> None:
        self.size = max(64, len(digests) * bits_per_key)
        self.bits = np.zeros((self.size + 7) // 8, dtype=np.uint8)
        for d in digests:
            for at in self._at(d):
                self.bits[at >> 3] |= 1 << (at & 7)

    def _at(self, digest: bytes) -> list[int]:
        a = int.from_bytes(digest[:8], "little")
        b = int.from_bytes(digest[-8:], "little") | 1
        return [(a + i * b) % self.size for i in range(self.PROBES)]

    def __contains__(self, digest: bytes) -> bool:
        return all(self.bits[at >> 3] >> (at & 7) & 1 for at in self._at(digest))


class Memtable:
    """Entries of the rows since the last flush: digest to classes of equal bytes.

    An entry is [members, text, sha256]. A digest hit counts only if the bytes are equal. The table is full at ``max_rows`` rows or ``max_bytes`` of
    distinct text, whichever comes first, so it bounds memory whatever the number of copies.
    """

    def __init__(self, max_rows: int, max_bytes: int) -> None:
        self.max_rows, self.max_bytes = max_rows, max_bytes
        self.entries: dict[bytes, list[list]] = {}
        self.rows = self.bytes = 0

    def add(self, digest: bytes, sha: str, text: str, doc_id: int | None) -> None:
        classes = self.entries.setdefault(digest, [])
        for entry in classes:
            if entry[1] == text:
                entry[0].append(doc_id)
                break
        else:
            classes.append([[doc_id], text, sha])
            self.bytes += len(text)
        self.rows += 1

    def full(self) -> bool:
        return self.rows >= self.max_rows or self.bytes >= self.max_bytes

    def flush(self) -> list[tuple]:
        """The sorted run."""
        run = [(d, *entry) for d in sorted(self.entries) for entry in self.entries[d]]
        self.entries, self.rows, self.bytes = {}, 0, 0
        return run


class LocalRuns:
    """The runs that one task has flushed. A digest that an earlier run of the task may hold is marked by its filter;
    such runs are compacted before they leave the task, which saves shuffling one text many times."""

    def __init__(self, fanout: int) -> None:
        self.fanout = fanout
        self.runs: list[list[tuple]] = []
        self.filters: list[BloomFilter] = []

    def add(self, run: list[tuple]) -> Iterator[list[tuple]]:
        self.runs.append(run)
        self.filters.append(BloomFilter([e[0] for e in run]))
        if len(self.runs) >= self.fanout:
            yield from self.compact()

    def compact(self) -> Iterator[list[tuple]]:
        """Merge the runs: entries that a filter of another run may hold are looked up there and, when the bytes agree, joined."""
        merged: dict[bytes, list[list]] = {}
        for i, run in enumerate(self.runs):
            alone = []
            for digest, members, text, sha in run:
                if digest in merged or any(digest in f for j, f in enumerate(self.filters) if j != i):
                    classes = merged.setdefault(digest, [])
                    for entry in classes:
                        if entry[1] == text:
                            entry[0].extend(members)
                            break
                    else:
                        classes.append([members, text, sha])
                else:
                    alone.append((digest, members, text, sha))
            if alone:
                yield alone
        if merged:
            yield [(d, *entry) for d in sorted(merged) for entry in merged[d]]
        self.runs, self.filters = [], []


def _level_zero(digest_bytes: int, largest: bool, max_rows: int, max_bytes: int, fanout: int):
    best = max if largest else min

    def batch(run: list[tuple]) -> pa.RecordBatch:
        known = [[m for m in e[1] if m is not None] for e in run]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([e[0] for e in run], pa.binary()),
                pa.array([best(m) if m else None for m in known], pa.int64()),
                pa.array([e[1] for e in run], pa.list_(pa.int64())),
                pa.array([e[3] for e in run], pa.string()),
                pa.array([e[2] for e in run], pa.string()),
            ],
            names=_ENTRY.names,
        )

    def pieces(run: list[tuple]) -> Iterator[pa.RecordBatch]:
        at = held = 0
        for i, e in enumerate(run):
            held += len(e[2])
            if held >= 1 << 23 or i - at >= 4096:
                yield batch(run[at : i + 1])
                at, held = i + 1, 0
        if at < len(run):
            yield batch(run[at:])

    def flush(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, runs = Memtable(max_rows, max_bytes), LocalRuns(fanout)
        for b in batches:
            ids = b.column(0).to_pylist()
            texts = b.column(1)
            for i, doc_id in enumerate(ids):
                text = texts[i].as_py() or ""
                sha = hashlib.sha256(text.encode())
                table.add(sha.digest()[:digest_bytes], sha.hexdigest(), text, doc_id)
                if table.full():
                    for run in runs.add(table.flush()):
                        yield from pieces(run)
        for run in runs.add(table.flush()):
            yield from pieces(run)
        for run in runs.compact():
            yield from pieces(run)

    return flush


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one digest come together, best head first. Each is compared on bytes with the classes seen so far; the first of a
    class has the identifier that stays. Holds the texts of one digest's classes, of which there is one but for collisions."""
    digest, classes = None, []
    for b in batches:
        out: list[list] = [[], [], [], []]
        texts = b.column(4)
        for i, (d, entry, head, n) in enumerate(zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)):
            if d != digest:
                digest, classes = d, []
            text = texts[i].as_py()
            for first, keep, other in classes:
                if other == text:
                    break
            else:
                first, keep = entry, head
                classes.append((entry, head, text))
            for column, value in zip(out, (entry, first, keep, n), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=_LINK.names)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    digest_bytes: int = 32,
    memtable_rows: int = 50_000,
    memtable_bytes: int = 16 << 20,
    fanout: int = 4,
    meeting: int = 64,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the smallest (``keep="min"``) or
    largest (``keep="max"``) identifier stays. Rows that repeat an identifier in one group are all kept or all dropped with it;
    a row without identifier stays only where its whole group has none (keep_id is null then). An empty table gives an
    empty result. Other columns are not read, so their names can't clash.

    Runs hold each distinct text of a task once, so a text with a third of all rows reaches the merge as one row per task.
    Only digests that meet in several runs are shuffled with their text.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is min or max")
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "exact")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    flushed = source.mapInArrow(_level_zero(digest_bytes, keep == "max", memtable_rows, memtable_bytes, fanout), _ENTRY)
    runs = scratch.save(flushed.withColumn("entry", F.monotonically_increasing_id()), "runs")
    # Runs that share a digest meet in one task, up to ``meeting`` of them; more are dealt out by salt first, and then one of each salt and class meet.
    met = runs.groupBy("digest").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1")
    salt = F.pmod(F.xxhash64("entry"), F.greatest(F.lit(1), F.ceil(F.col("runs") / meeting)))
    hits = runs.select("digest", "entry", "head", F.size("members").cast("long").alias("n"), "text").join(met.hint("merge"), "digest")
    hits = hits.select(F.concat("digest", F.unhex(F.lpad(F.hex(salt), 16, F.lit("0")))).alias("key"), "entry", "head", "n", "text", "digest", "runs")
    order = F.col("head").desc_nulls_last() if keep == "max" else F.col("head").asc_nulls_last()

    def verify(rows: DataFrame, key: str, table: str) -> DataFrame:
        rows = rows.select(F.col(key).alias("key"), "entry", "head", "n", "text")
        return scratch.save(rows.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", order).mapInArrow(_verify, _LINK), table)

    links = verify(hits, "key", "links")
    many = hits.where(F.col("runs") > meeting)
    if met.where(F.col("runs") > meeting).take(1):
        heads = links.where("entry = class").select("entry")
        salts = verify(many.join(heads.hint("merge"), "entry", "left_semi"), "digest", "salts").select(F.col("entry").alias("class"), F.col("class").alias("whole"), F.col("keep_id").alias("best"))
        links = links.join(salts.hint("merge"), "class", "left")
        links = links.select("entry", F.coalesce("whole", "class").alias("class"), F.when(F.col("whole").isNull(), F.col("keep_id")).otherwise(F.col("best")).alias("keep_id"), "n")
    sizes = links.groupBy("class").agg(F.sum("n").alias("group_size"))
    merged = links.select("entry", "class", "keep_id").join(sizes.hint("merge"), "class")
    entries = runs.select("entry", "head", "members", "sha256").join(merged.hint("merge"), "entry", "left")
    alone = F.col("class").isNull()
    rows = entries.select(
        F.explode("members").alias("doc_id"),
        F.when(alone, F.col("head")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(alone, F.size("members").cast("long")).otherwise(F.col("group_size")).alias("group_size"),
        F.col("sha256").alias("text_sha256"),
    )
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
