"""Benchmark decontamination by MinHash containment search over test items partitioned by size.

Containment of an item in a document is the share of the item's distinct shingles that the document holds. The items of a size class share a
signature length: the class's largest item may miss floor((1 - threshold) * n) shingles and still reach the threshold, so of any item the
floor((1 - threshold) * n) + 1 shingles with the smallest min-hashes can't all be missing. A document that holds none of an item's
signature is therefore no candidate, and no candidate is lost, however long the document is. A document's min-hashes are looked up in the signatures alone; only candidates' shingles
are compared.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HIT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("containment", T.DoubleType()), T.StructField("shared", T.LongType()), T.StructField("n_shingles", T.LongType())])
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores: marks and line breaks don't hide a passage."""
    return _WORD.findall((text or "").lower())


_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _windows(values: np.ndarray, k: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(values, k)


def min_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` words, from the words' hashes."""
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h = (out + words[i : len(words) - k + 1 + i]) * _M[0]
        h = (h ^ (h >> np.uint64(30))) * _M[1]
        h = (h ^ (h >> np.uint64(27))) * _M[2]
        out = h ^ (h >> np.uint64(31))
    return out


class SizeClass:
    """Items of like size and one shingle length, and the least min-hashes of each as its signature, sorted over all items."""

    def __init__(self, k: int, members: list[tuple[int, np.ndarray]], threshold: float) -> None:
        self.k = k
        sizes = [len(hashes) for _, hashes in members]
        #: Shingles that a document must have for any of them.
        self.least = math.ceil(threshold * min(sizes) - 1e-9)
        length = int((1 - threshold) * max(sizes) + 1e-9) + 1
        signatures = [hashes[:length] for _, hashes in members]
        values = np.concatenate(signatures)
        items = np.repeat(np.array([m for m, _ in members], np.int32), [len(x) for x in signatures])
        order = np.argsort(values)
        self.values, self.items = values[order], items[order]

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """The items of which a document with these min-hashes has any of the signature. Of the document only hashes up to the signatures' largest can matter."""
        sketch = np.unique(hashes[hashes <= self.values[-1]])
        lo, hi = np.searchsorted(self.values, sketch), np.searchsorted(self.values, sketch, "right")
        hit = hi > lo
        return np.unique(np.concatenate([self.items[a:b] for a, b in zip(lo[hit], hi[hit], strict=True)])) if hit.any() else self.items[:0]


class ContainmentIndex:
    """Min-hash signatures of a bounded block of items by size class, and the items' words for the check of candidates.

    Words of the items are numbered; a word outside the vocabulary can't lie in a shingle of an item, so a document is searched in its runs of known
    words only. The check compares tuples of word numbers, so equality is exact and not one of hashes.
    """

    def __init__(self, items: list[tuple[int, str]], shingle: int, threshold: float) -> None:
        self.threshold = threshold
        self.vocab: dict[str, int] = {}
        self.items: list[tuple[int, int, np.ndarray]] = []
        numbered = []
        for item_id, text in items:
            if w := words(text):
                numbered.append((item_id, np.array([self.vocab.setdefault(x, len(self.vocab)) for x in w], np.int32)))
        self.hashes = np.array([xxhash.xxh64_intdigest(w, 7) for w in self.vocab], np.uint64)
        classes: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for item_id, ids in numbered:
            k = min(shingle, len(ids))
            hashes = np.unique(min_hashes(self.hashes[ids], k))
            classes.setdefault((k, len(hashes).bit_length()), []).append((len(self.items), hashes))
            self.items.append((item_id, k, ids))
        self.classes = [SizeClass(k, members, threshold) for (k, _), members in sorted(classes.items())]

    def candidates(self, ids: np.ndarray) -> list[int]:
        """The items that share a signature with a document of these word numbers, -1 for unknown words."""
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        hashes, found = {}, []
        for c in self.classes:
            if len(ids) < c.k:
                continue
            if c.k not in hashes:
                whole = known[c.k :] - known[: -c.k] == c.k
                hashes[c.k] = min_hashes(self.hashes[ids], c.k)[whole] if whole.any() else self.hashes[:0]
            if len(hashes[c.k]) >= max(1, c.least):
                found += c.candidates(hashes[c.k]).tolist()
        return found

    def search(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item, containment, shared shingles, item's shingles) at or over the threshold."""
        if not self.items:
            return []
        get = self.vocab.get
        ids = np.array([get(w, -1) for w in words(text)], np.int32)
        out, held = [], {}
        for m in self.candidates(ids):
            item_id, k, own = self.items[m]
            if k not in held:
                held[k] = set(map(tuple, _windows(ids, k).tolist()))
            shingles = set(map(tuple, _windows(own, k).tolist()))
            shared = len(shingles & held[k])
            if shared >= self.threshold * len(shingles) - 1e-9:
                out.append((item_id, shared / len(shingles), shared, len(shingles)))
        return out


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = index.value.search
        for b in batches:
            texts = b.column(1)
            hits = [(doc_id, *hit) for i, doc_id in enumerate(b.column(0).to_pylist()) for hit in sorted(search(texts[i].as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if k == 2 else pa.int64()) for k, c in enumerate(zip(*hits, strict=True) if hits else [[]] * 5)], names=_HIT.names)

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    block: list[tuple[int, str]] = []
    held = 0
    for row in items.toLocalIterator():
        size = len(row["text"] or "")
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["item_id"], row["text"]))
        held += size
    yield block


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8, block_bytes: int = 16 << 20
) -> DataFrame:
    """``doc_id, item_id, containment, shared, n_shingles``: every document and item with at least ``threshold`` of the item's distinct word shingles in the document.

    Words are lower-cased runs of letters, digits and underscores. An item of fewer than ``shingle`` words is one shingle, its whole sequence; an item or document
    without words matches nothing. Repeated documents and repeated items each match; null identifiers are kept. Empty tables give an empty result. Other
    columns are not read.

    Items are broadcast in blocks of at most ``block_bytes`` of text (or one item), each block searched in all documents; so the broadcast is bounded for
    any benchmark, and no document's text is shuffled.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    queries = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    found = [source.mapInArrow(_search(spark.sparkContext.broadcast(ContainmentIndex(block, shingle, threshold))), _HIT) for block in _blocks(queries, block_bytes)]
    return reduce(DataFrame.unionAll, found)


def _without(index, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = index.value.search
        for b in batches:
            texts = b.column(at)
            yield b.filter(pa.array([not search(texts[i].as_py()) for i in range(b.num_rows)], pa.bool_()))

    return run


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns.

    A row goes if it contains at least ``threshold`` of any item's shingles (see ``contained_items``). Rows are judged on their text alone, so repeated rows and
    null identifiers fare alike; null and empty texts stay. No shuffle: each block of items filters what the one before has left.
    """
    spark = docs.sparkSession
    queries = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    at = docs.columns.index(text_col)
    for block in _blocks(queries, block_bytes):
        docs = docs.mapInArrow(_without(spark.sparkContext.broadcast(ContainmentIndex(block, shingle, threshold)), at), docs.schema)
    return docs
