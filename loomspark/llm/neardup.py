"""Near duplicates by exact similarity of word shingles, with candidates from the binary trie join over wide SimHash fingerprints.

A pair at a similarity of 0.8 differs in about 19 of 128 bits, so no trie that allows so few differences from its root on finds it. It is joined in many views
instead: in each, some bits drawn from the fingerprint lead, in which a pair may not differ, and below them the differing bits are added up against the whole budget.
So many views are taken that a pair at the threshold is missed by all of them at the rate ``miss`` at most. Candidates are verified on their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.llm.common import Scratch, fresh, shuffle_partitions
from loomspark.llm.components import components
from loomspark.llm.simhash import BUCKET, forest, trie_join

WIDE = 128
#: Shingles of a component from which on it is cut into parts, up to 16 of them, and those that a part may have at most.
SPLIT, ROOM = 1 << 15, 1 << 23
SALTS = 64
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_PRINT = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "raw", "a", "b", "p", "q")])
_DEALT = T.StructType([T.StructField("bucket", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("view", "node", "p", "q"))])
_PAIR = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
#: Shingles as bytes: a column of arrays takes Arrow and pandas ten times as long.
_SET = T.StructType([T.StructField("node", T.LongType()), T.StructField("size", T.LongType()), T.StructField("shingles", T.BinaryType())])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M[1]
    h = (h ^ (h >> np.uint64(27))) * _M[2]
    return h ^ (h >> np.uint64(31))


class Shingles:
    """Hashes of a text's distinct shingles. Words are those of the SimHash operator: A-Z lower-cased, cut at ASCII white space."""

    ROOM = 1 << 18

    def __init__(self, shingle: int) -> None:
        self.shingle = shingle
        self.known: dict[bytes, int] = {}

    def words(self, text: str | None) -> list[bytes]:
        return (text or "").encode().lower().split()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Sorted and distinct; a text of fewer words has one shingle, its whole sequence, and one without words none."""
        known = self.known
        if len(known) > self.ROOM:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, 1)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.shingle, len(h))
        if not k:
            return h
        n = len(h) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = _mix((out + h[i : i + n]) * _M[0])
        return np.unique(out)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """128 bits as two words: a bit is 1 if it is set in over half the hashes."""
    both = np.stack([hashes, _mix(hashes + _M[0])], axis=1).astype("<u8")
    counts = np.zeros(WIDE, np.int64)
    for k in range(0, len(both), 1 << 15):
        counts += np.unpackbits(both[k : k + (1 << 15)].view(np.uint8).reshape(-1, 16), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes)).view("<u8")


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingles(shingle)
        for batch in batches:
            texts = batch.column(2)
            out = np.empty((batch.num_rows, 4), "<i8")
            for i in range(batch.num_rows):
                words = of.words(texts[i].as_py())
                out[i, :2] = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), "<i8")
                out[i, 2:] = fingerprint(of.hashes(words)).view("<i8") if words else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(out[:, k]) for k in range(4))], names=_PRINT.names)

    return run


def views(n: int, similarity: float, miss: float, seed: int = 5) -> list[np.ndarray]:
    """The leading bits of each view: so many that about 16 of ``n`` texts share them, where comparing texts costs about as much as dealing them out."""
    lead = max(14, math.ceil(math.log2(max(2, n))) - 4)
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    # The bits in which a pair differs scatter, and so do its chances; averaged over the binomial number of them.
    odds = [(math.comb(WIDE, d) * differ**d * (1 - differ) ** (WIDE - d), math.comb(WIDE - d, lead) / math.comb(WIDE, lead)) for d in range(WIDE - lead)]
    count = 1
    while sum(p * (1 - hit) ** count for p, hit in odds) > miss:
        count += max(1, count // 8)
    r = np.random.default_rng(seed)
    return [np.sort(r.choice(WIDE, lead, replace=False)) for _ in range(count)]


def _deal(leading: list[np.ndarray], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.uint64(1) << np.arange(len(leading[0]), dtype=np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                words = np.stack([part.column(k).to_numpy(zero_copy_only=False) for k in (1, 2)], axis=1).astype("<i8")
                bits = np.unpackbits(words.view(np.uint8), axis=1)
                for v, lead in enumerate(leading):
                    view = bits[:, lead].astype(np.uint64) @ power | np.uint64(v << 48)
                    bucket = (_mix(view * _M[0]) % np.uint64(buckets)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(view.view(np.int64)), *part.columns], names=_DEALT.names)

    return run


def _candidates(budget: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        view, p = rows["view"].to_numpy(np.int64), rows["p"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort((p, view))
        view, p, q, node = view[order], p[order], rows["q"].to_numpy(np.int64).view(np.uint64)[order], rows["node"].to_numpy(np.int64)[order]
        lo = np.flatnonzero(np.concatenate([[True], view[1:] != view[:-1]]))
        hi = np.append(lo[1:], len(view))
        shared = hi - lo > 1

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i, j in trie_join(p, None, budget, 0, (lo[shared], hi[shared])):
                near = np.bitwise_count(p[i] ^ p[j]).astype(np.int64) + np.bitwise_count(q[i] ^ q[j]) <= budget
                yield i[near], j[near]

        u, v = forest(node, pairs())
        return pd.DataFrame({"u": u, "v": v})

    return run


def exact_links(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A forest of the links of sets at ``similarity`` or more: from each set that a search has reached, all that are linked to it and not reached yet. What is reached leaves the
    inverted index, so that a family of like sets is read a few times and not once for each of its members."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    left, out = np.arange(n), []
    reached = np.zeros(n, bool)
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(ids, np.cumsum(sizes)[:-1])

    def index(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(members, sizes[members])
        held = np.concatenate([parts[m] for m in members])
        order = np.argsort(held, kind="stable")
        return np.searchsorted(held[order], np.arange(len(values) + 1)), owner[order]

    bounds, owners = index(left)
    for start in range(n):
        if reached[start]:
            continue
        reached[start] = True
        todo = [start]
        while todo:
            k = todo.pop()
            lo, count = bounds[parts[k]], bounds[parts[k] + 1] - bounds[parts[k]]
            at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
            common = np.bincount(owners[at], minlength=n)
            linked = np.flatnonzero(~reached & (common > 0) & (common >= similarity * (sizes + sizes[k] - common) - 1e-9))
            reached[linked] = True
            out += [(k, int(x)) for x in linked]
            todo += linked.tolist()
            open_ = int(n - reached.sum())
            if not open_:
                return out
            if open_ < len(left) // 2 and len(left) > 32:
                left = np.flatnonzero(~reached)
                bounds, owners = index(left)
    return out


def _exact(similarity: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows[["component", "one", "other"]].to_numpy(np.int64)
        order = np.lexsort((key[:, 2], key[:, 1], key[:, 0]))
        key, node, shingles = key[order], rows["node"].to_numpy(np.int64)[order], rows["shingles"].to_numpy()[order]
        cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if len(key) else []
        found = []
        for a, b in zip(cuts, [*cuts[1:], len(key)], strict=True):
            if b - a > 1:
                found += [(node[a + i], node[a + j]) for i, j in exact_links([np.frombuffer(x, np.uint64) for x in shingles[a:b]], similarity)]
        return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["u", "v"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Shingles(shingle)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1)
                sets = [of.hashes(of.words(texts[i].as_py())) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=_SET.names)

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, miss: float = 0.02) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with their columns.

    Two texts are linked if the Jaccard similarity of their sets of ``shingle``-word shingles is ``similarity`` or more; texts of equal words always are, texts without words among them. A group is what links
    connect. Of each group the row with the smallest identifier stays; one without identifier only if the whole group has none, then that of the least hash. Rows that
    share identifier and text are one document: they stay or go together. Null texts count as empty. An empty table gives an empty result; columns may have any names.

    No link is reported that isn't one; a pair just at ``similarity`` is missed with the chance ``miss``, one above it with less. Equal texts are one node, so a text with a third
    of all rows is one entry. A task emits a forest of its candidates, never all pairs. All pairs of the candidates' components are then judged on their shingles, for which a large component is cut into
    parts that meet in twos; what leaves is again a forest. Up to about 900,000 texts, a component is dealt out 16 times at most; beyond, in proportion to its size.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("raw"), text.alias("text"))
    prints = scratch.save(source.mapInArrow(_prints(shingle), _PRINT), "prints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "raw")
    grouped = prints.groupBy("a", "b").agg(F.min(place).alias("least"), F.min("p").alias("p"), F.min("q").alias("q"))
    leaves = scratch.save(grouped.withColumn("node", F.monotonically_increasing_id()), "leaves")
    n = leaves.count()
    leading = views(n, similarity, miss)
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    budget = math.ceil(WIDE * differ + 3.5 * math.sqrt(WIDE * differ * (1 - differ)))
    empty = F.lit(None).cast("array<long>")
    buckets = max(2 * shuffle_partitions(spark), n * len(leading) // BUCKET)
    dealt = leaves.where("p <> 0 OR q <> 0").select("node", "p", "q").mapInArrow(_deal(leading, buckets), _DEALT)
    pairs = scratch.save(dealt.groupBy("bucket").applyInPandas(_candidates(budget), _PAIR).distinct(), "pairs")
    loose = scratch.save(components(pairs, Scratch(spark, "neardup-loose")), "loose")
    wanted = leaves.join(loose.hint("merge"), "node").select("node", F.col("least.doc_id").alias("id"), F.col("least.raw").alias("hash"))
    same = source["doc_id"].eqNullSafe(F.col("id")) & (source["raw"] == F.col("hash"))
    texts = source.join(wanted.hint("merge"), same).groupBy("node").agg(F.min("text").alias("text"))
    sets = scratch.save(texts.mapInArrow(_sets(shingle), _SET).join(loose.hint("merge"), "node"), "sets")
    # Only the few large components need their number of parts. The optimizer broadcasts them if their size allows; else they are met in as many places as there are salts, so that none gathers in one task.
    large = sets.groupBy("component").agg(F.sum("size").alias("total")).where(F.col("total") > SPLIT)
    large = large.select("component", "total", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    parts = F.greatest(F.least(F.ceil(F.col("total") / SPLIT), F.lit(16)), F.ceil(F.col("total") / ROOM)).cast("int")
    salted = sets.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(large, ["component", "salt"], "left")
    placed = salted.withColumn("parts", F.coalesce(parts, F.lit(1))).withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
    both = placed.select("component", "node", "shingles", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("next"))
    both = both.select("component", "node", "shingles", F.least("own", "next").alias("one"), F.greatest("own", "next").alias("other"))
    tasks = both.withColumn("bucket", F.pmod(F.xxhash64("component", "one", "other"), F.lit(4 * shuffle_partitions(spark))).cast("int"))
    links = scratch.save(tasks.groupBy("bucket").applyInPandas(_exact(similarity), _PAIR), "links")
    groups = scratch.save(components(links, Scratch(spark, "neardup-groups")), "groups")
    labels = leaves.join(groups.hint("merge"), "node", "left").select("a", "b", "least", F.coalesce("component", "node").alias("component"))
    labels = scratch.save(labels, "labels")
    winners = labels.groupBy("component").agg(F.min("least").alias("stays"))
    decided = labels.join(winners.hint("merge"), "component").select("a", "b", "stays")
    gone = prints.join(decided.hint("merge"), ["a", "b"]).where(~(F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("raw") == F.col("stays.raw"))))
    key, hashed = fresh(docs, "gone_id", "gone_hash")
    gone = gone.select(F.col("doc_id").alias(key), F.col("raw").alias(hashed)).distinct()
    dropped = docs[id_col].cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == F.col(hashed))
    return docs.join(gone.hint("merge"), dropped, "left_anti")
