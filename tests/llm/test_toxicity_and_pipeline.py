import random
import zlib

import numpy as np
import pytest

from loomspark.llm import toxicity as tox
from tests.llm.helpers import documents, hard_rows, prose

BAD = ["scum", "moron", "dummkopfen", "dummkopfung"]


def labelled(n=400, seed=1):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(r, r.randrange(5, 60)).split()
        y = int(r.random() < 0.3)
        if y:
            for _ in range(3):
                words.insert(r.randrange(len(words) + 1), r.choice(BAD))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, y))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = labelled()
    docs = documents(spark, rows)
    return docs, rows, labels, tox.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy_and_columns(spark, fitted):
    docs, _, labels, model = fitted
    truth = {i: y for i, _, y in labels}
    got = tox.toxicity_scores(docs, model).collect()
    assert len(got) == len(truth)
    assert all(g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 5 == 0) and 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.5) for g in got)
    held = [g for g in got if g["held_out"]]
    assert np.mean([g["predicted"] == truth[g["doc_id"]] for g in held]) > 0.95


def test_scores_depend_on_the_text_alone(spark, fitted):
    _, _, _, model = fitted
    rows = [(1, "you moron scum", "en", "a", 1), (None, "you moron scum", None, None, None), (2, None, "de", "b", 2), (3, "", "fr", "c", 3), (4, " .!? ", "es", "d", 4)]
    got = tox.toxicity_scores(documents(spark, rows), model).collect()
    scores = {g["doc_id"]: g["score"] for g in got}
    assert scores[1] == scores[None] and scores[2] == scores[3] == scores[4] < 0.5
    assert next(g for g in got if g["doc_id"] is None)["held_out"] is None
    assert tox.toxicity_scores(documents(spark, []), model).collect() == []


def test_long_texts_are_scored_whole(fitted, monkeypatch):
    model = fitted[3]
    long = "lorem " * 70_000 + "moron scum moron"
    vocabulary = tox.Vocabulary(model.buckets)
    assert tox.score(model, vocabulary, [long])[0] > tox.score(model, vocabulary, ["lorem " * 70_000])[0]
    texts = [r[1] for r in fitted[1][:50]]
    whole, _ = tox.raw_logits(model, vocabulary, texts)
    monkeypatch.setattr(tox, "SEGMENT", 7)
    parts, _ = tox.raw_logits(model, vocabulary, texts)
    assert np.allclose(whole, parts, atol=1e-4)


def test_labels_of_held_out_rows_are_not_read(spark, fitted):
    docs, _, labels, model = fitted
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    again = tox.fit(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert np.array_equal(again.embedding, model.embedding) and np.array_equal(again.thresholds, model.thresholds)


def test_a_text_over_the_sample_size_is_left_out(spark):
    rows, labels = labelled(60)
    first = min((i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5), key=lambda i: zlib.crc32(str(i).encode()))
    rows = [(i, "x" * 50_000 if i == first else t, *rest) for i, t, *rest in rows]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    read = lambda size: tox.training_rows(documents(spark, rows), table, "doc_id", "text", "toxic", 100, size)
    used = sum(1 for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5)
    texts, found, _ = read(40_000)
    assert len(texts) == used - 1 and set(found) == {0, 1}
    assert len(read(200_000)[0]) == used
    with pytest.raises(ValueError, match="class"):
        read(4)


def test_texts_that_share_an_identifier_give_one_training_row(spark):
    rows, labels = labelled(60)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    read = lambda r, k: tox.training_rows(documents(spark, r).repartition(k), table, "doc_id", "text", "toxic", 100, 1 << 20)
    twice = [*rows, *rows, *((i, t + " other", *rest) for i, t, *rest in rows)]
    once, again, third = read(rows, 3), read(twice, 3), read(twice, 5)
    assert len(again[0]) == len(once[0]) == len(once[1]) and again == third and once[1] == again[1]


def test_without_labels_nothing_is_toxic(spark):
    docs = documents(spark, [(1, "moron", "en", "s", 1)])
    model = tox.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert tox.without_toxic(docs, model).count() == 1


def test_gradients(monkeypatch):
    model = tox.TextCnn(buckets=50, size=4, filters=3)
    model.embedding = model.embedding.astype(np.float64)
    model.kernels = [k.astype(np.float64) for k in model.kernels]
    model.dense = model.dense.astype(np.float64)
    vocabulary = tox.Vocabulary(50)
    rows, starts, stops, _ = tox._layout([vocabulary.tokens(t) for t in ("a b c d e", "f g", "h")], 3)
    features, y, w = vocabulary.features[rows], np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        z = model.logits(model.respond(features, starts, stops)[0])
        return float((w * (np.logaddexp(0, z) - y * z)).sum() / w.sum())

    grads, _, _ = model.gradients(features, starts, stops, y, w)
    for kernel, g in zip(model.kernels, grads, strict=False):
        for at in [(0, 0, 0), (0, 2, 1), (kernel.shape[0] - 1, 3, 2)]:
            kernel[at] += 1e-5
            up = loss()
            kernel[at] -= 2e-5
            down = loss()
            kernel[at] += 1e-5
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    import re

    import corpus_pipeline
    from tests.llm.test_neardup import kept_by_brute_force
    from tests.llm.test_text_operators import brute_lines

    rows, labels = labelled(300)
    extra = [(1000 + r[0], r[1], "en", "s", 1) for r in {r[0]: r for r in hard_rows(n=100)}.values()]
    item = " ".join(f"item{k}" for k in range(30))
    rows = rows + extra + [(9000, "before " + item + " after", "en", "s", 1), (9001, "before " + " ".join(item.split()[:12]), "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "decontamination", "bpe"]

    clean = stages["toxicity"](spark, docs, str(tmp_path))
    clean.write.parquet(f"{tmp_path}/1")
    clean = spark.read.parquet(f"{tmp_path}/1")
    truth = {i: y for i, _, y in labels}
    kept = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns and np.mean([(i in kept) == (y == 0) for i, y in truth.items()]) > 0.97

    cut = stages["line_dedup"](spark, clean, str(tmp_path))
    want = brute_lines([(r["doc_id"], r["text"]) for r in clean.collect()])
    assert cut.columns == columns and {r["doc_id"]: r["text"] for r in cut.collect()} == {i: t for i, (t, _) in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect() if want[r["doc_id"]][1])

    one = stages["simhash"](spark, cut, str(tmp_path))
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == kept_by_brute_force([(r["doc_id"], r["text"]) for r in cut.collect()])

    left = stages["decontamination"](spark, one, str(tmp_path))
    assert left.columns == columns and {r["doc_id"] for r in one.collect()} - {r["doc_id"] for r in left.collect()} == {9000}

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in left.collect()}
    assert all(len(r["ids"]) == r["n_tokens"] for r in out) and not any(re.search("moron", r["ids_sha256"]) for r in out)
