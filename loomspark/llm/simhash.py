"""SimHash near-duplicates by a self-join of a binary trie over the fingerprints.

Pairs of trie nodes are traversed together; the bits in which they differ are added up, and a pair is left as soon as they exceed the
budget. The trie is joined in several views, each of which puts another segment of the bits first and allows no difference in it; the nodes below that segment are what is dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.llm.common import Scratch, shuffle_partitions
from loomspark.llm.components import components

_PRINT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
_EDGE = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
BITS = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the A-Z-lower-cased words' shingles, repeats included. Fewer words give one shingle, none give 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return digest(joined, seed)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, n, 1 << 15):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[k : min(n, k + (1 << 15))], ends[k + shingle - 1 :], strict=False)], np.dtype("<u8"))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            found = np.array([fingerprint(texts[i].as_py(), shingle) for i in range(b.num_rows)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int64())], names=_PRINT.names)

    return run


def trie_join(a: np.ndarray, b: np.ndarray | None, budget: int, depth: int = 0, nodes: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with at most ``budget`` bits between a[i] and b[j] below the first ``depth`` bits; a and b are sorted, unsigned and equal in those
    bits. b None: the pairs within a, each once; ``nodes`` are then the first and last-plus-one places of the nodes to join with themselves, each sorted.

    A node is a range of a sorted array; a level of pairs is expanded at once. A pair of small nodes is compared directly.
    """
    own = b is None
    b = a if own else b
    lo, hi = nodes if nodes is not None else (np.array([0]), np.array([len(a)]))
    todo = [(lo[k : k + (1 << 20)], hi[k : k + (1 << 20)]) for k in range(0, len(lo), 1 << 20)]
    todo = [(x, y, *((x, y) if own else (np.array([0]), np.array([len(b)]))), np.zeros(len(x), np.int64), depth) for x, y in todo]
    zeros: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def below(bit: int) -> tuple[np.ndarray, np.ndarray]:
        if bit not in zeros:
            count = lambda x: np.concatenate([[0], np.cumsum(x >> np.uint64(BITS - 1 - bit) & np.uint64(1) == 0)])
            of_a = count(a)
            zeros[bit] = of_a, of_a if own else count(b)
        return zeros[bit]

    while todo:
        alo, ahi, blo, bhi, gone, bit = todo.pop()
        small = (ahi - alo) * (bhi - blo) <= 64
        if bit == BITS:
            small[:] = True
        if small.any():
            yield from _compare(a, b, alo[small], ahi[small], blo[small], bhi[small], budget, own, depth)
            keep = ~small
            alo, ahi, blo, bhi, gone = (x[keep] for x in (alo, ahi, blo, bhi, gone))
        if not len(alo):
            continue
        za, zb = below(bit)
        amid, bmid = alo + za[ahi] - za[alo], blo + zb[bhi] - zb[blo]
        parts = [(alo, amid, blo, bmid, gone), (amid, ahi, bmid, bhi, gone), (alo, amid, bmid, bhi, gone + 1), (amid, ahi, blo, bmid, gone + 1)]
        if own:  # a node against itself has one mixed pair, not two
            other = alo != blo
            parts[3] = tuple(x[other] for x in parts[3])
        alo, ahi, blo, bhi, gone = (np.concatenate(x) for x in zip(*parts, strict=True))
        live = (gone <= budget) & (ahi > alo) & (bhi > blo)
        alo, ahi, blo, bhi, gone = (x[live] for x in (alo, ahi, blo, bhi, gone))
        for k in range(0, len(alo), 1 << 20):
            todo.append(tuple(x[k : k + (1 << 20)] for x in (alo, ahi, blo, bhi, gone)) + (bit + 1,))


def _compare(a, b, alo, ahi, blo, bhi, budget, own, depth) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    rest = np.uint64((1 << (BITS - depth)) - 1)
    sizes = (ahi - alo) * (bhi - blo)
    for part in np.array_split(np.arange(len(sizes)), max(1, int(sizes.sum()) >> 21)):
        size = sizes[part]
        at = np.repeat(part, size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = bhi[at] - blo[at]
        i, j = alo[at] + k // width, blo[at] + k % width
        near = np.bitwise_count((a[i] ^ b[j]) & rest) <= budget
        if own:
            near &= i < j
        if near.any():
            yield i[near], j[near]


def forest(ids: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A star for each group the pairs connect: (member, smallest member)."""
    parent = np.arange(len(ids))

    def roots() -> np.ndarray:
        nonlocal parent
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        return parent

    for i, j in pairs:
        while True:
            r = roots()
            x, y = r[i], r[j]
            apart = x != y
            if not apart.any():
                break
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
    r = roots()
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, r, ids)
    star = least[r]
    member = np.bincount(r, minlength=len(ids))[r] > 1
    far = member & (star != ids)
    return ids[far], star[far]


#: Bits below a node's prefix of which every value may occur in a task.
TAIL = 16
#: Rows of a bucket, on the average.
BUCKET = 250_000


class View:
    """An order of the fingerprint's bits and a depth: the trie over the bits in that order, in whose first ``depth`` levels a pair may not differ."""

    def __init__(self, order: tuple[int, ...], depth: int) -> None:
        self.order, self.depth = order, depth

    def split(self, parts: int) -> list[View]:
        """A pair that differs in fewer than ``parts`` of the bits below the prefix agrees on one of as many segments of them; each leads a view of its own."""
        rest = self.order[self.depth :]
        cuts = [round(k * len(rest) / parts) for k in range(parts + 1)]
        pieces = [rest[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return [View((*self.order[: self.depth], *p, *(x for o in pieces if o is not p for x in o)), self.depth + len(p)) for p in pieces]

    def prints(self, fp: Column) -> Column:
        """The fingerprint with its bits in this order; runs of neighbours are shifted at once."""
        out, at = F.lit(0).cast("long"), 0
        while at < BITS:
            n = 1
            while at + n < BITS and self.order[at + n] == self.order[at] + n:
                n += 1
            piece = F.shiftrightunsigned(fp, BITS - self.order[at] - n) if self.order[at] + n < BITS else fp
            piece = piece.bitwiseAND(F.lit((1 << n) - 1).cast("long")) if n < BITS else piece
            out = out.bitwiseOR(F.shiftleft(piece, BITS - at - n) if at + n < BITS else piece)
            at += n
        return out

    def row(self, number: int) -> Column:
        turned = self.prints(F.col("fp"))
        return F.struct(F.lit(number).alias("view"), turned.alias("turned"), F.shiftrightunsigned(turned, BITS - self.depth).alias("node"))


def _join_task(budget: int, depths: list[int]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fp, rep, view = rows["turned"].to_numpy(np.int64).view(np.uint64), rows["rep"].to_numpy(np.int64), rows["view"].to_numpy()
        order = np.lexsort((fp, view))
        fp, rep, view = fp[order], rep[order], view[order]

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for v in np.unique(view):
                at, end = np.searchsorted(view, v), np.searchsorted(view, v, "right")
                part = fp[at:end]
                node = part >> np.uint64(BITS - depths[v])
                lo = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
                hi = np.append(lo[1:], len(part))
                shared = hi - lo > 1
                for i, j in trie_join(part, None, budget, depths[v], (lo[shared], hi[shared])):
                    yield i + at, j + at

        u, v = forest(rep, pairs())
        return pd.DataFrame({"u": u, "v": v})

    return run


def links(prints: DataFrame, budget: int, node_size: int, n: int, scratch: Scratch) -> DataFrame:
    """``u, v``: edges between representatives that connect just what the links within ``budget`` bits connect. ``prints`` is ``fp, rep`` with ``n`` distinct fp.

    A pair within ``budget`` bits agrees on one of ``budget + 1`` segments of the bits. Each segment leads one view of the trie, in which node pairs may differ only below
    that segment; so a fingerprint is dealt to ``budget + 1`` nodes, however many there are. A node of more than ``node_size`` fingerprints is dealt on in the same
    way by the bits below, until it is small or has few bits left. Within a task only a forest is emitted, never all pairs of a group.
    """
    spark = prints.sparkSession
    views = View(tuple(range(BITS)), 0).split(budget + 1)
    rows = prints.select("fp", "rep", F.explode(F.array(*(v.row(k) for k, v in enumerate(views)))).alias("r")).select("fp", "rep", "r.*")
    found, count, level = [], n * len(views), 0
    while True:
        cold, hot = rows, None
        large = [k for k, v in enumerate(views) if BITS - v.depth > TAIL]
        if n > node_size and large:
            hot = scratch.save(rows.where(F.col("view").isin(large)).groupBy("view", "node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_size), f"hot{level}")
            total = hot.agg(F.sum("n")).first()[0]
            if total:
                cold = rows.join(hot.hint("merge"), ["view", "node"], "left_anti")
        buckets = max(2 * shuffle_partitions(spark), count // BUCKET)
        dealt = cold.select("turned", "rep", "view", F.pmod(F.xxhash64("view", "node"), F.lit(buckets)).cast("int").alias("bucket"))
        found.append(scratch.save(dealt.groupBy("bucket").applyInPandas(_join_task(budget, [v.depth for v in views]), _EDGE), f"links{level}"))
        if hot is None or not total:
            return reduce(DataFrame.unionAll, found)
        rows = scratch.save(rows.join(hot.hint("merge"), ["view", "node"], "left_semi").select("fp", "rep", "view"), f"rows{level}")
        below = {k: views[k].split(budget + 1) for k in large}
        at = {k: i * (budget + 1) for i, k in enumerate(large)}
        deal = [rows.where(F.col("view") == k).select("fp", "rep", F.explode(F.array(*(v.row(at[k] + i) for i, v in enumerate(below[k])))).alias("r")) for k in large]
        rows, views = reduce(DataFrame.unionAll, deal).select("fp", "rep", "r.*"), [v for k in large for v in below[k]]
        count, level = total * (budget + 1), level + 1


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 2, node_size: int = 1 << 16) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Fingerprints link at ``budget`` or fewer differing bits; ``component_id`` is the smallest identifier reachable over links, itself
    included. A null or blank text has fingerprint zero, linked like any other. Rows without identifier get a fingerprint but link nothing, and
    their component is null; repeated rows give repeated rows. An empty table gives an empty result; other columns are not read.

    Equal fingerprints are one trie leaf, so a text with a third of all rows is one entry. A node of more than ``node_size`` fingerprints is dealt on by
    further bits; nothing is left out for a larger node.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = scratch.save(source.mapInArrow(_prints(shingle), _PRINT), "prints")
    leaves = scratch.save(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "leaves")
    edges = links(leaves, budget, node_size, leaves.count(), scratch)
    groups = components(edges, scratch)
    labels = leaves.join(groups, leaves["rep"] == groups["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = prints.join(labels, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
