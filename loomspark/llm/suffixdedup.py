"""Suffix-array dedup of repeated byte strings by bucket-pointer refinement.

A string of ``length`` bytes that repeats holds, at the same offset, a q-gram whose hash is least among its q-grams. Neighbouring windows with
the same least q-gram form a run, and the q-gram's hash is the run's initial bucket; buckets with one run hold nothing that repeats. Runs of equal
bytes collapse to the earliest. What is left of a bucket is refined like a suffix array: windows start in buckets of equal 8-grams, and each is split by
the bucket of the window that starts where its known part ends, so that the known length doubles until it covers ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.llm.common import Scratch, shuffle_partitions

#: What a run is to the next step.
ALONE, COVERED, HOT, MARK, COMPARE = range(5)
#: Windows per block of a long text: a place in a block has 20 bits.
BLOCK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]

_RUN = np.dtype([("key", "<u8"), ("digest", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("start", "<u4"), ("n", "u1"), ("kind", "u1")])
_FIELDS = ("key", "digest", "doc", "tag", "start", "n", "kind")
_RUNS = T.StructType([T.StructField("bucket", T.IntegerType()), *(T.StructField(c, T.BinaryType()) for c in _FIELDS)])
_MARKS = T.StructType(
    [T.StructField("doc", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("start", T.BinaryType()), T.StructField("n", T.BinaryType()), T.StructField("key", T.BinaryType())]
)
_SLICE = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("key", T.LongType()),
        T.StructField("doc", T.LongType()),
        T.StructField("tag", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("bytes", T.BinaryType()),
    ]
)
_OUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)
_KEPT = T.StructType([*_OUT.fields, T.StructField("kept", T.BinaryType())])


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q-gram, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _M[0]
    size = 1
    while size < q:
        step = min(size, q - size)
        h = (h[:-step] * _M[1] + (h[step:] ^ (h[step:] >> np.uint64(29)))) * _M[2 if step == size else 3]
        size += step
    return h ^ (h >> np.uint64(32))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least value in each window of ``width``, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        x = np.minimum(x[:-step], x[step:])
        size += step
    return x


def window_runs(text: bytes, length: int, q: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, first windows, numbers of windows) of a text's runs; of equal least q-grams the leftmost counts."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - length + 1, BLOCK):
        block = data[at : at + BLOCK + length - 1]
        grams = gram_hashes(block, q)
        packed = grams >> np.uint64(20) << np.uint64(20) | np.arange(len(grams), dtype=np.uint64)
        least = _least(packed, length - q + 1)
        start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        yield grams[(least[start] & _PLACE).astype(np.int64)], start + at, np.diff(start, append=len(least))


def _first_of(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def collapse(runs: np.ndarray, most: int) -> np.ndarray:
    """Sorted runs with their kinds: of equal runs all but the earliest are COVERED; a key with more than ``most`` different runs or with a MARK is HOT, one
    with a single run ALONE, any other to COMPARE."""
    runs = runs[np.lexsort((runs["start"], runs["tag"], runs["doc"], runs["digest"], runs["kind"] == MARK, runs["key"]))]
    runs = runs[_first_of(runs["key"], runs["digest"], runs["kind"] == MARK, runs["doc"], runs["start"], runs["tag"])]  # repeated rows
    marked = runs["kind"] == MARK
    first = _first_of(runs["key"], runs["digest"], marked) & ~marked
    head = np.maximum.accumulate(np.where(first | marked, np.arange(len(runs)), 0))
    earliest = first | (runs["doc"] == runs["doc"][head]) & (runs["tag"] == runs["tag"][head]) & (runs["start"] == runs["start"][head])
    group = np.cumsum(_first_of(runs["key"])) - 1
    different = np.bincount(group, first)
    hot = (different > most) | (np.bincount(group, marked) > 0)
    kind = np.where(hot[group], HOT, np.where(different[group] > 1, COMPARE, ALONE))
    runs["kind"] = np.where(marked, MARK, np.where(earliest, kind, COVERED))
    return runs


def _scan(length: int, q: int, buckets: int, hot_runs: int, flush_bytes: int):
    names = _RUNS.names

    def rows(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        runs = collapse(np.concatenate(parts), hot_runs)
        marks = runs[(runs["kind"] == HOT) & _first_of(runs["key"])].copy()
        marks["kind"] = MARK
        runs["kind"][runs["kind"] == COMPARE] = ALONE  # to be settled where all runs of the key meet
        by_key = runs["kind"] == ALONE
        where = np.where(by_key, runs["key"] % np.uint64(buckets), (runs["doc"] ^ runs["tag"]).astype(np.uint64) * _M[0] >> np.uint64(33) & np.uint64(0x7FFFFFFF))
        runs = np.concatenate([runs, marks])
        where = np.concatenate([where, marks["key"] % np.uint64(buckets)]) % np.uint64(buckets)
        order = np.lexsort((runs["start"], runs["doc"], where))
        runs, where = runs[order], where[order]
        at = np.flatnonzero(_first_of(where))
        columns = [pa.array(where[at].astype(np.int32))]
        parts = np.split(runs, at[1:])
        columns += [pa.array([p[c].tobytes() for p in parts], pa.binary()) for c in _FIELDS]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            texts = b.column(2)
            for i, (doc, tag) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                text = texts[i].as_py().encode()
                for keys, start, n in window_runs(text, length, q):
                    part = np.empty(len(keys), _RUN)
                    part["key"], part["doc"], part["tag"], part["start"], part["n"], part["kind"] = keys, doc, tag, start, n, ALONE
                    part["digest"] = [digest(text[s:e]) for s, e in zip(start.tolist(), (start + n + (length - 1)).tolist(), strict=True)]
                    parts.append(part)
                    held += len(keys)
                if held * _RUN.itemsize >= flush_bytes:
                    yield from rows(parts)
                    parts, held = [], 0
        if parts:
            yield from rows(parts)

    return scan


def _by_document(runs: np.ndarray) -> pd.DataFrame:
    """A row for each document and kind, with the runs' starts, numbers and keys as bytes."""
    runs = runs[np.lexsort((runs["start"], runs["kind"], runs["tag"], runs["doc"]))]
    at = np.flatnonzero(_first_of(runs["doc"], runs["tag"], runs["kind"])) if len(runs) else np.array([], int)
    head, parts = runs[at], np.split(runs, at[1:]) if len(runs) else []
    return pd.DataFrame(
        {
            "doc": head["doc"].astype(np.int64),
            "tag": head["tag"].astype(np.int64),
            "kind": head["kind"].astype(np.int32),
            **{c: pd.Series([p[c].tobytes() for p in parts], dtype=object) for c in ("start", "n", "key")},
        }
    )


def _meet(most: int):
    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        size = sum(map(len, rows["n"]))
        runs = np.empty(size, _RUN)
        for c in _FIELDS:
            runs[c] = np.frombuffer(b"".join(rows[c]), _RUN[c])
        settled = (runs["kind"] == COVERED) | (runs["kind"] == HOT)
        met = collapse(runs[~settled], most)
        met = met[(met["kind"] != MARK) & (met["kind"] != ALONE)]
        return _by_document(np.concatenate([runs[settled], met]))

    return meet


def _windows(text: bytes, start: np.ndarray, n: np.ndarray, length: int) -> Iterator[tuple[int, bytes]]:
    for s, k in zip(start.tolist(), n.tolist(), strict=True):
        for p in range(s, s + k):
            yield p, hashlib.blake2b(text[p : p + length], digest_size=16).digest()


def _cut(length: int, buckets: int):
    """From documents with their runs to compare: a row for each such run with its bytes, and for each window of a hot run with its digest. A
    hot window that the batch has earlier is covered."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, refs = b.column(2), b.column(4)
            out: list[tuple] = []
            seen: dict[bytes, tuple] = {}
            for i, (doc, tag) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                found = refs[i].as_py()
                text = texts[i].as_py().encode() if found else b""
                for ref in found or ():
                    start, n = np.frombuffer(ref["start"], "<u4").astype(np.int64), np.frombuffer(ref["n"], np.uint8)
                    if ref["kind"] == COMPARE:
                        keys = np.frombuffer(ref["key"], "<i8")
                        out += [(int(k % buckets), COMPARE, k, doc, tag, s, m, text[s : s + m + length - 1]) for k, s, m in zip(keys.tolist(), start.tolist(), n.tolist(), strict=True)]
                        continue
                    for p, digest in _windows(text, start, n, length):
                        before = seen.get(digest)
                        late = (doc, tag, p)
                        if before is None or late < before:
                            seen[digest], late = late, before
                        if late is not None and late != seen[digest]:
                            out.append(((late[0] ^ late[1]) % buckets, COVERED, 0, *late, 1, None))
                if len(out) >= 1 << 16:
                    yield _slices(out)
                    out = []
            for digest, (doc, tag, p) in seen.items():
                key = int.from_bytes(digest[:8], "little", signed=True)
                out.append((key % buckets, HOT, key, doc, tag, p, 1, digest))
            yield _slices(out)

    return cut


def _slices(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)], names=_SLICE.names)


def refine(bucket: np.ndarray, active: np.ndarray, after: int) -> tuple[np.ndarray, np.ndarray]:
    """Split the buckets of the active positions by the bucket pointers of the positions ``after`` bytes later. A position alone in its bucket
    keeps a number of its own and is sorted no more."""
    pair = bucket[active].astype(np.uint64) << np.uint64(32) | bucket[active + after].astype(np.uint64)
    order = np.argsort(pair)
    pair = pair[order]
    new = _first_of(pair)
    number = np.cumsum(new) - 1
    size = np.bincount(number)
    out = bucket.copy()
    # Numbers of buckets that are still shared start over; those of single positions lie above them all.
    top = np.uint32(len(bucket))
    single = size[number] == 1
    out[active[order]] = np.where(single, top + active[order], number).astype(np.uint32)
    return out, np.sort(active[order][~single])


def repeated_windows(slices: list[bytes], keys: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The bucket of each slice's windows, slice by slice: equal for equal windows of ``length`` bytes under one key; -1 for windows alone in theirs."""
    data = np.frombuffer(b"".join(slices) + bytes(8), np.uint8)
    sizes = np.array([len(s) for s in slices])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(slices)), sizes)
    room = np.repeat(ends, sizes) - np.arange(len(owner))  # bytes from here to the slice's end
    words = np.zeros(len(owner), np.uint64)
    for k in range(8):
        words = words << np.uint64(8) | data[k : k + len(owner)].astype(np.uint64)
    # The first buckets: equal 8-grams below one key.
    gram = np.unique(words, return_inverse=True)[1].astype(np.uint32)
    key = np.unique(keys, return_inverse=True)[1].astype(np.uint32)[owner]
    bucket = np.arange(len(owner), dtype=np.uint32) + np.uint32(len(owner))
    active = np.flatnonzero(room >= 8)
    pair = key[active].astype(np.uint64) << np.uint64(32) | gram[active].astype(np.uint64)
    _, number, size = np.unique(pair, return_inverse=True, return_counts=True)
    shared = size[number] > 1
    bucket[active[shared]] = number[shared]
    active, known = active[shared], 8
    while known < length:
        step = min(known, length - known)
        active = active[room[active] >= known + step]
        bucket, active = refine(bucket, active, step)
        known += step
    start = np.repeat(ends - sizes, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    alive = np.zeros(len(owner), bool)
    alive[active] = True
    return np.where(alive[start], bucket[start].astype(np.int64), -1)


def _late(bucket: np.ndarray, doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The rows whose bucket has an earlier one."""
    order = np.lexsort((place, tag, doc, bucket))
    first = _first_of(bucket[order])
    head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    same = (doc[order] == doc[order][head]) & (tag[order] == tag[order][head]) & (place[order] == place[order][head])  # repeated rows: neither is earlier
    return order[(bucket[order] >= 0) & ~first & ~same]


def _compare(length: int, piece_bytes: int):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        done = rows[rows["kind"] == COVERED]
        out.append(_ranges(done["doc"].to_numpy(np.int64), done["tag"].to_numpy(np.int64), done["start"].to_numpy(np.int64)))
        hot = rows[rows["kind"] == HOT]
        if len(hot):
            doc, tag, start = (hot[c].to_numpy(np.int64) for c in ("doc", "tag", "start"))
            late = _late(np.unique(hot["bytes"].to_numpy(dtype=object).astype("V16"), return_inverse=True)[1], doc, tag, start)
            out.append(_ranges(doc[late], tag[late], start[late]))
        rest = rows[rows["kind"] == COMPARE].sort_values("key", kind="stable")
        if len(rest):
            keys = rest["key"].to_numpy(np.int64)
            sizes = np.cumsum(rest["bytes"].map(len).to_numpy())
            first = np.flatnonzero(_first_of(keys))
            # Keys are independent, so they are refined in pieces of bounded size.
            piece = sizes[first] // piece_bytes
            cuts = first[np.flatnonzero(_first_of(piece))]
            for a, b in zip(cuts, [*cuts[1:], len(rest)], strict=True):
                part = rest.iloc[a:b]
                counts = part["n"].to_numpy(np.int64)
                bucket = repeated_windows(part["bytes"].tolist(), keys[a:b], counts, length)
                doc, tag, start = (np.repeat(part[c].to_numpy(np.int64), counts) for c in ("doc", "tag", "start"))
                start = start + np.arange(len(start)) - np.repeat(np.cumsum(counts) - counts, counts)
                late = _late(bucket, doc, tag, start)
                out.append(_ranges(doc[late], tag[late], start[late]))
        return _by_document(np.concatenate(out))

    return compare


def _ranges(doc: np.ndarray, tag: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Windows as covered runs: neighbours are joined, up to 255."""
    order = np.lexsort((start, tag, doc))
    doc, tag, start = doc[order], tag[order], start[order]
    if not len(doc):
        return np.empty(0, _RUN)
    new = _first_of(doc, tag, start - np.arange(len(start)))
    index = np.arange(len(start))
    new |= (index - np.maximum.accumulate(np.where(new, index, 0))) % 255 == 0
    at = np.flatnonzero(new)
    runs = np.zeros(len(at), _RUN)
    runs["doc"], runs["tag"], runs["start"], runs["n"], runs["kind"] = doc[at], tag[at], start[at], np.diff(at, append=len(start)), COVERED
    return runs


def _remove(length: int, full: bool):
    schema = _KEPT if full else _OUT

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, marks = b.column(1), b.column(2)
            out: list[list] = [[] for _ in schema.names[1:]]
            for i in range(b.num_rows):
                text = (texts[i].as_py() or "").encode()
                found = marks[i].as_py()
                removed = spans = 0
                kept = text
                if found:
                    start = np.concatenate([np.frombuffer(m["start"], "<u4") for m in found]).astype(np.int64)
                    end = start + np.concatenate([np.frombuffer(m["n"], np.uint8) for m in found]) + length - 1
                    gone = np.cumsum(np.bincount(start, minlength=len(text) + 1) - np.bincount(end, minlength=len(text) + 1))[:-1] > 0
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                for column, value in zip(out, (len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept), strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()), *(pa.array(c, pa.binary()) for c in out[4:])], names=schema.names)

    return remove


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 100,
    q: int = 24,
    full: bool = True,
    bucket_bytes: int = 8 << 20,
    hot_runs: tuple[int, int] = (512, 4096),
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if ``full``, the bytes ``kept``.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers it also starts earlier (smaller identifier, nulls first, or earlier in the same
    text; overlaps count); strings are judged on the input. Different texts under one
    identifier, or without one, are documents of their own, in the order of their 64-bit hashes. Null and empty texts have no bytes, texts shorter than ``length`` lose none. Rows that
    share identifier and text are one document and fare alike. An empty table gives an empty result; other columns are not read.

    Runs, not texts, meet by key: one of about (length - q) / 2 bytes each. A task sends one of its equal runs. A key with more different runs than
    ``hot_runs`` (in one task's buffer, in all) is not compared in one place: its windows are dealt out by their own digests.
    """
    if not 8 <= q < length <= q + 255:
        raise ValueError("8 <= q < length <= q + 255")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # A text under an identifier is told apart by 64 bits of its hash, one of the many without identifier by 126.
    own, whole, none = F.col(id_col).cast("long"), F.xxhash64(text), F.col(id_col).cast("long").isNull()
    ranked = F.lit(-(2**63)) + F.shiftrightunsigned(whole.bitwiseXOR(F.lit(-(2**63))), 2)
    source = docs.select(F.when(none, ranked).otherwise(own).alias("doc"), F.when(none, F.xxhash64(F.lit("second"), text)).otherwise(whole).alias("tag"), text.alias("text"), own.alias("own"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = max(8, int(size * 2 / (length - q) * _RUN.itemsize) // bucket_bytes)
    runs = source.select("doc", "tag", "text").mapInArrow(_scan(length, q, buckets, hot_runs[0], 16 << 20), _RUNS)
    marks = scratch.save(runs.groupBy("bucket").applyInPandas(_meet(hot_runs[1]), _MARKS), "marks")

    def gather(found: DataFrame) -> DataFrame:
        return found.groupBy("doc", "tag").agg(F.collect_list(F.struct("kind", "start", "n", "key")).alias("marks"))

    # Both joins read the same exchange of the texts.
    open_runs = source.join(gather(marks.where(F.col("kind") != COVERED)), ["doc", "tag"], "left")
    slices = open_runs.mapInArrow(_cut(length, buckets), _SLICE)
    settled = slices.groupBy("bucket").applyInPandas(_compare(length, 4 << 20), _MARKS)
    covered = gather(marks.where(F.col("kind") == COVERED).unionByName(settled))
    joined = source.join(covered, ["doc", "tag"], "left")
    return joined.select(F.col("own").alias("doc_id"), "text", "marks").mapInArrow(_remove(length, full), _KEPT if full else _OUT)
