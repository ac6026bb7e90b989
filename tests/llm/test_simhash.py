import random
import re

import numpy as np
import pytest
import xxhash

from loomspark.llm import simhash
from loomspark.llm.common import Scratch
from loomspark.llm.components import components
from tests.llm.helpers import documents, hard_rows


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget):
    ids = list(prints)
    near = [[(prints[a] ^ prints[b]).bit_count() <= budget for b in ids] for a in ids]
    label = {i: i for i in ids}
    while True:
        new = {a: min(label[b] for k, b in enumerate(ids) if near[j][k]) for j, a in enumerate(ids)}
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("text", [None, "", "  ", "One", "one two", "a b c", "A b\tC d\x0be", "ÄÖ äö x y z " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_join_finds_all_pairs(budget):
    r = random.Random(budget)
    seeds = [r.getrandbits(64) for _ in range(40)]
    values = np.array(sorted({s ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))) for s in seeds for _ in range(12)}), np.uint64)
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= budget}
    got = [(int(i), int(j)) for a, b in simhash.trie_join(values, None, budget) for i, j in zip(a, b, strict=True)]
    assert sorted(got) == sorted(want)
    left, right = values[::2], values[1::2]
    want = {(i, j) for i in range(len(left)) for j in range(len(right)) if int(left[i] ^ right[j]).bit_count() <= budget}
    got = [(int(i), int(j)) for a, b in simhash.trie_join(left, right, budget) for i, j in zip(a, b, strict=True)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("node_size", [1 << 16, 4])
def test_groups_equal_brute_force(spark, node_size):
    rows = hard_rows(n=90)
    prints = {r[0]: brute_print(r[1]) for r in rows}
    label = brute_components(prints, 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_groups(documents(spark, rows).repartition(5), node_size=node_size).collect()}
    assert got == {i: (f"{prints[i]:016x}", label[i]) for i in prints}


def test_null_ids_repeats_and_empty_table(spark):
    rows = [(None, "a b c", None, None, None), (4, "a b c", None, None, None), (4, "a b c", None, None, None), (2, "a b c", None, None, None)]
    got = [(r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == [(2, 2), (4, 2), (4, 2), (None, None)]
    assert simhash.simhash_groups(documents(spark, [])).collect() == []


def test_components_of_long_chains(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)] + [(300 + r.randrange(20), 300) for _ in range(40)]
    r.shuffle(edges)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in (100, 150, 200)) and all(v == 300 for k, v in got.items() if k >= 300)
