import hashlib
import zlib
from collections import Counter

import pytest

from loomspark.llm.exactdedup import BloomFilter, Memtable, exact_dedup
from loomspark.llm.sharding import shard_by_bytes
from tests.llm.helpers import documents, hard_rows


def brute(rows, best):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,best", [("min", min), ("max", max)])
@pytest.mark.parametrize("options", [{}, {"digest_bytes": 1}, {"memtable_rows": 3, "fanout": 2}, {"memtable_bytes": 50, "digest_bytes": 1, "fanout": 3}, {"memtable_rows": 2, "fanout": 2, "digest_bytes": 1, "meeting": 2}, {"memtable_rows": 1, "fanout": 1, "meeting": 1}])
def test_exact_dedup_equals_brute_force(spark, keep, best, options):
    rows = hard_rows()
    got = exact_dedup(documents(spark, rows).repartition(5), keep=keep, **options).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, best)


def test_exact_dedup_repeated_rows_and_null_ids(spark):
    rows = [(1, "a", None, None, None), (1, "a", None, None, None), (None, "a", None, None, None), (None, "b", None, None, None), (None, "b", None, None, None), (2, None, None, None, None), (3, "", None, None, None)]
    got = exact_dedup(documents(spark, rows).repartition(4), memtable_rows=1).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, min)


def test_exact_dedup_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []


def test_filter_has_no_false_negatives():
    keys = [hashlib.sha256(bytes([i])).digest() for i in range(200)]
    found = BloomFilter(keys)
    assert all(k in found for k in keys)
    assert sum(hashlib.sha256(b"x" + bytes([i])).digest() in found for i in range(200)) < 40


def test_memtable_keeps_colliding_texts_apart():
    table = Memtable(10, 1000)
    for i, text in enumerate("aba"):
        table.add(b"d", "", text, i)
    assert [(e[1], e[2]) for e in table.flush()] == [([0, 2], "a"), ([1], "b")]


def test_shards_are_contiguous_balanced_and_gapless(spark):
    rows = [r for r in hard_rows() if r[0] != 5000]
    rows = list({r[0]: r for r in rows}.values())
    got = sorted(map(tuple, shard_by_bytes(documents(spark, rows).repartition(6), n_shards=5).collect()))
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert [g[0] for g in got] == sorted(texts)
    assert all(g[1] == len(texts[g[0]]) + 1 and g[2] == zlib.crc32(texts[g[0]]) and g[3] == "bytes" and g[6] is None for g in got)
    assert [g[4] for g in got] == sorted(g[4] for g in got)
    sizes, total, largest = Counter(), sum(g[1] for g in got), max(g[1] for g in got)
    start = 0
    for g in got:
        assert g[4] == next(k for k in range(4, -1, -1) if start >= total * k // 5)
        sizes[g[4]] += g[1]
        start += g[1]
    assert all(abs(s - total / 5) <= largest for s in sizes.values())
    for k in range(5):
        assert sorted(g[5] for g in got if g[4] == k) == list(range(sum(g[4] == k for g in got)))


def test_shards_of_repeated_and_null_ids(spark):
    rows = [(1, "aa", None, None, None)] * 40 + [(None, "b", None, None, None)] * 5 + [(2, None, None, None, None)]
    got = shard_by_bytes(documents(spark, rows), n_shards=4).collect()
    assert len(got) == 46
    for k in range(4):
        assert sorted(g["slot"] for g in got if g["shard"] == k) == list(range(sum(g["shard"] == k for g in got)))
    assert shard_by_bytes(documents(spark, [])).collect() == []
