import random
import re

import numpy as np
import pytest

from loomspark.llm import neardup
from loomspark.llm.neardup import near_duplicates
from tests.llm.helpers import documents, hard_rows


def brute_groups(texts, similarity=0.8, shingle=5):
    """The group of each text, as the first index reachable over pairs whose shingle sets are similar."""
    words = [tuple(re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())) for t in texts]
    sets = [{w[k : k + shingle] for k in range(max(1, len(w) - shingle + 1))} if w else set() for w in words]
    label = list(range(len(texts)))
    near = [(i, j) for j in range(len(texts)) for i in range(j) if words[i] == words[j] or len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) > 0]
    while True:
        before = list(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            return label


def kept_by_brute_force(rows):
    rows = sorted({r[:2] for r in rows}, key=lambda r: r[0])
    label = brute_groups([t for _, t in rows])
    return {rows[k][0] for k in set(label)}


def variants(r, n, words=120, edits=2):
    base = [r.choice("abcdefghijklmnop") + str(r.randrange(400)) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(len(w))] = str(r.randrange(10**6))
        out.append(" ".join(w))
    return out


def test_hard_rows_equal_brute_force(spark):
    rows = list({r[0]: r for r in hard_rows(n=150)}.values())
    got = near_duplicates(documents(spark, rows).repartition(5))
    assert {r["doc_id"] for r in got.collect()} == kept_by_brute_force(rows)
    assert got.columns == documents(spark, rows).columns


def test_groups_of_variants_and_pairs_about_the_threshold(spark):
    r = random.Random(4)
    texts = [t for _ in range(25) for t in variants(r, r.choice([1, 2, 6, 40]), r.choice([12, 40, 120]), r.choice([1, 2, 4]))]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(r.sample(texts, len(texts)))]
    want, got = kept_by_brute_force(rows), {x["doc_id"] for x in near_duplicates(documents(spark, rows)).collect()}
    # No row goes without a link; of the groups next to none are missed.
    assert want <= got and len(got - want) <= 0.02 * len(rows)


def test_every_link_of_a_chain_is_verified(spark):
    """Neighbours are at 0.8 or more, others are not: one group, though its ends share little."""
    words = [f"w{k}" for k in range(160)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 80]), "en", "s", 1) for k in range(20)]
    assert {x["doc_id"] for x in near_duplicates(documents(spark, rows)).collect()} == {0}
    far = [(k, " ".join(words[10 * k : 10 * k + 70]), "en", "s", 1) for k in range(10)]
    assert near_duplicates(documents(spark, far)).count() == 10


def test_a_short_document_inside_a_long_one_stays(spark):
    rows = [(1, "one two three four five six seven", "", "", 1), (2, "one two three four five six seven eight nine ten eleven twelve", "", "", 1), (3, "a b", "", "", 1), (4, "A  b", "", "", 1), (5, "a", "", "", 1)]
    assert {x["doc_id"] for x in near_duplicates(documents(spark, rows)).collect()} == {1, 2, 3, 5}


def test_nulls_repeats_and_empty_tables(spark):
    text = " ".join(f"w{k}" for k in range(50))
    other = "nothing of this is like the rest of all that"
    rows = [(None, text), (None, None), (4, text), (4, text), (2, text + " end"), (3, ""), (6, " \n"), (7, other), (2, other + " x y z"), (None, "without identifier alone")]
    got = sorted([(x["doc_id"], x["text"]) for x in near_duplicates(documents(spark, [(*r, None, None, None) for r in rows])).collect()], key=str)
    # A text stands for itself: identifier 2 has two, of which only one is near to others.
    assert got == sorted([(2, text + " end"), (3, ""), (7, other), (2, other + " x y z"), (None, "without identifier alone")], key=str)
    same = near_duplicates(documents(spark, [(4, text, None, None, None)] * 3))
    assert [x["doc_id"] for x in same.collect()] == [4, 4, 4]
    assert near_duplicates(documents(spark, [])).collect() == []


def test_many_equal_rows_and_a_cluster_of_hundreds(spark):
    r = random.Random(9)
    cluster = variants(r, 400, 100, 2)
    rows = [(k, cluster[0], "", "", 1) for k in range(1, 600)] + [(1000 + k, t, "", "", 1) for k, t in enumerate(cluster)] + [(5000 + k, variants(r, 1)[0], "", "", 1) for k in range(50)]
    got = {x["doc_id"] for x in near_duplicates(documents(spark, rows)).collect()}
    assert got == {1, *range(5000, 5050)}


@pytest.mark.parametrize("seed", range(4))
def test_exact_links_connect_what_similar_sets_connect(seed):
    r = np.random.default_rng(seed)
    sets = []
    for _ in range(12):
        base = r.integers(0, 1 << 40, r.integers(1, 60)).astype(np.uint64)
        for _ in range(r.integers(1, 30)):
            keep = base[r.random(len(base)) > r.choice([0, 0.05, 0.2])]
            sets.append(np.unique(np.concatenate([keep, r.integers(0, 1 << 40, 1 + r.integers(0, 4)).astype(np.uint64)])))
    order = r.permutation(len(sets))
    sets = [sets[k] for k in order]
    near = lambda i, j: len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))

    def groups(pairs):
        label = list(range(len(sets)))
        for _ in sets:
            before = list(label)
            for i, j in pairs:
                label[i] = label[j] = min(label[i], label[j])
            if label == before:
                return label

    found = neardup.exact_links(sets, 0.8)
    assert all(near(i, j) for i, j in found) and len(found) < len(sets)
    assert groups(found) == groups([(i, j) for j in range(len(sets)) for i in range(j) if near(i, j)])


def test_a_large_component_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SPLIT", 300)
    r = random.Random(10)
    texts = [t for _ in range(4) for t in variants(r, 40, 60, 3)]
    rows = [(k, t, "", "", 1) for k, t in enumerate(texts)]
    assert {x["doc_id"] for x in near_duplicates(documents(spark, rows)).collect()} == kept_by_brute_force(rows)


def test_views_miss_few_pairs_at_the_threshold():
    r = np.random.default_rng(1)
    for n in (1000, 1 << 24):
        views = neardup.views(n, 0.8, 0.02)
        differ = np.arccos(1.6 / 1.8) / np.pi
        missed = np.mean([not any(not flips[v].any() for v in views) for flips in r.random((2000, 128)) < differ])
        assert missed < 0.04
