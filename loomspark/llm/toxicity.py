"""Toxicity: a convolutional text classifier with hashed word embeddings, several filter widths and max pooling, trained in numpy.

Scores depend on the text alone. The model is fitted on a bounded sample of labelled rows; each language's threshold is calibrated on a part of the
sample that training does not see, where a text's language is told by its function words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
_WORD = re.compile(r"\w+")

# Function words that only one of the languages has.
FUNCTION_WORDS = {
    "en": "the and of to is that for with are was this it be by not from have",
    "fr": "le les des et une est pour dans qui pas sur du au avec ce il elle",
    "de": "der die das und ist nicht ein eine zu mit den von für auch auf dem sich",
    "es": "el los las y por con para del una como más su al lo pero sus",
}
LANGUAGES = tuple(FUNCTION_WORDS)
_LANGUAGE_OF = {w: k for k, text in enumerate(FUNCTION_WORDS.values()) for w in text.split()}


class Vocabulary:
    """Hashed features of words: the word, its first four and five letters and its last four. Bounded: it is emptied when full."""

    FEATURES = 4
    ROOM = 1 << 18

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {"": 0}
        self.features = np.zeros((1024, self.FEATURES), np.int32)
        self.language = np.full(1024, len(LANGUAGES), np.int8)

    def _add(self, words: set[str]) -> None:
        at = len(self.rows)
        end = at + len(words)
        while end > len(self.features):
            self.features = np.concatenate([self.features, np.zeros_like(self.features)])
            self.language = np.concatenate([self.language, np.full_like(self.language, len(LANGUAGES))])
        crc = zlib.crc32
        hashes = [crc(x.encode()) for w in words for x in (w, "<" + w[:4], "<<" + w[:5], w[-4:] + ">")]
        # Bucket 0 is padding.
        self.features[at:end] = (1 + np.array(hashes, np.int64) % (self.buckets - 1)).reshape(-1, self.FEATURES)
        self.language[at:end] = [_LANGUAGE_OF.get(w, len(LANGUAGES)) for w in words]
        self.rows.update(zip(words, range(at, end), strict=True))

    def tokens(self, text: str) -> np.ndarray:
        words = _WORD.findall(text.lower())
        new = set(words).difference(self.rows)
        if new:
            self._add(new)
        return np.fromiter(map(self.rows.__getitem__, words), np.int32, len(words))


@dataclass
class TextCnn:
    """Embeddings, filters of each width, and a dense layer over the max-pooled responses."""

    buckets: int = 1 << 15
    size: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    seed: int = 7
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES) + 1))

    def __post_init__(self) -> None:
        r = np.random.default_rng(self.seed)
        self.embedding = r.normal(0, 0.1, (self.buckets, self.size)).astype(np.float32)
        self.embedding[0] = 0
        self.kernels = [r.normal(0, 1 / np.sqrt(w * self.size), (w, self.size, self.filters)).astype(np.float32) for w in self.widths]
        self.bias = [np.zeros(self.filters, np.float32) for _ in self.widths]
        self.dense = r.normal(0, 0.3, len(self.widths) * self.filters).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def respond(self, features: np.ndarray, starts: np.ndarray, stops: np.ndarray, places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest response of each filter over the windows that start in each segment, and where it is. ``features`` are rows of words with padding between
        segments, so that no window spans two."""
        x = self.embedding[features].sum(axis=1)
        pooled, where = [], []
        bounds = np.stack([starts, stops], axis=1).reshape(-1)
        bounds = bounds[:-1] if bounds[-1] >= len(x) else bounds
        for w, kernel, bias in zip(self.widths, self.kernels, self.bias, strict=True):
            y = x @ kernel[0]
            for k in range(1, w):
                y[:-k] += x[k:] @ kernel[k]
            pooled.append(np.maximum.reduceat(y, bounds, axis=0)[::2] + bias)
            if places:
                where.append(np.stack([a + y[a:b].argmax(axis=0) for a, b in zip(starts, stops, strict=True)]))
        return np.maximum(np.concatenate(pooled, axis=1), 0), where

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.dense + self.offset[0]

    def parameters(self) -> list[np.ndarray]:
        return [*self.kernels, *self.bias, self.dense, self.offset]

    def gradients(self, features: np.ndarray, starts: np.ndarray, stops: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Of the weighted log loss: for the parameters, then embedding rows and their gradients. Only the windows that won the pooling have any."""
        pooled, where = self.respond(features, starts, stops, places=True)
        p = 1 / (1 + np.exp(-np.clip(self.logits(pooled), -30, 30)))
        d = ((p - target) * weight / weight.sum()).astype(np.float32)
        back = np.where(pooled > 0, d[:, None] * self.dense, 0)
        kernels, bias, rows, changes = [], [], [], []
        for i, (w, kernel) in enumerate(zip(self.widths, self.kernels, strict=True)):
            own = back[:, i * self.filters : (i + 1) * self.filters]
            g = np.zeros_like(kernel)
            for k in range(w):
                at = np.minimum(where[i] + k, len(features) - 1)
                f = features[at]
                g[k] = np.einsum("df,dfs->sf", own, self.embedding[f].sum(axis=2))
                rows.append(f.reshape(-1, Vocabulary.FEATURES))
                changes.append((own[:, :, None] * kernel[k].T[None]).reshape(-1, self.size))
            kernels.append(g)
            bias.append(own.sum(axis=0))
        return [*kernels, *bias, pooled.T @ d, np.array([d.sum()], np.float32)], np.concatenate(rows), np.concatenate(changes)


#: Distance from the threshold of a text without words: it says nothing, so it is not toxic.
NO_WORDS = -3.0
#: Words of a segment at most; longer texts are several segments that overlap by the widest filter.
SEGMENT = 1 << 15


def _layout(tokens: list[np.ndarray], reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word rows, segment starts, stops of its windows' starts, segment's text). Every segment is followed by padding; windows that reach into it count at
    a text's end only, so a text's responses don't depend on how it is cut."""
    pad = np.zeros(reach, np.int32)
    parts, owner, whole = [], [], []
    for i, t in enumerate(tokens):
        for at in range(0, max(1, len(t)), SEGMENT):
            parts += [t[at : at + SEGMENT + reach - 1], pad]
            owner.append(i)
            whole.append(at + SEGMENT >= len(t))
    sizes = np.array([len(a) + reach for a in parts[::2]])
    starts = np.cumsum(sizes) - sizes
    return np.concatenate(parts), starts, starts + np.where(whole, sizes, SEGMENT), np.array(owner)


def raw_logits(model: TextCnn, vocabulary: Vocabulary, texts: list[str], chunk: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(logit, language) of each text, whole. Works in chunks of words."""
    out, languages = np.zeros(len(texts)), np.zeros(len(texts), int)
    at = 0
    while at < len(texts):
        tokens, first, held = [], at, 0
        while at < len(texts) and (not tokens or held < chunk):
            tokens.append(vocabulary.tokens(texts[at]))
            held += len(tokens[-1])
            at += 1
        for i, t in enumerate(tokens):
            votes = np.bincount(vocabulary.language[t], minlength=len(LANGUAGES) + 1)[:-1]
            languages[first + i] = votes.argmax() if votes.any() else len(LANGUAGES)
        rows, starts, stops, owner = _layout(tokens, max(model.widths))
        pooled = np.zeros((len(tokens), len(model.dense)), np.float32)
        step = len(starts) if len(rows) <= 1 << 18 else max(1, (1 << 18) // SEGMENT)
        for k in range(0, len(starts), step):
            part = slice(k, k + step)
            begin, end = starts[k], starts[k + step] if k + step < len(starts) else len(rows)
            found, _ = model.respond(vocabulary.features[rows[begin:end]], starts[part] - begin, stops[part] - begin)
            np.maximum.at(pooled, owner[part], found)
        out[first:at] = model.logits(pooled)
        if len(vocabulary.rows) > vocabulary.ROOM:
            vocabulary.clear()
    return out, languages


def _best_threshold(logit: np.ndarray, target: np.ndarray, weight: np.ndarray) -> float:
    """Where the weighted errors are fewest: the middle of the best gap."""
    order = np.argsort(logit)
    x, y, w = logit[order], target[order], weight[order]
    errors = np.concatenate([[0], np.cumsum(w * y)]) + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 2], (x[1:] + x[:-1]) / 2, [x[-1] + 2]])
    valid = np.concatenate([[True], x[1:] > x[:-1], [True]])
    least = errors[valid].min()
    best = np.flatnonzero(valid & (errors <= least + 1e-9))
    gap = np.concatenate([[0], np.diff(x), [0]])
    return float(edges[best[gap[best].argmax()]])


def prior(tokens: list[np.ndarray], target: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """How much more often texts of class 1 have a bucket than those of class 0, as a log-odds in standard deviations; 0 where that may be chance."""
    counts = np.zeros((2, vocabulary.buckets))
    for t, y in zip(tokens, target, strict=True):
        counts[int(y), np.unique(vocabulary.features[np.unique(t)])] += 1
    size = np.array([(target == 0).sum(), (target == 1).sum()])[:, None]
    a, b = counts[1] + 0.5, counts[0] + 0.5
    odds = np.log(a / (size[1] - counts[1] + 0.5)) - np.log(b / (size[0] - counts[0] + 0.5))
    deviation = np.sqrt(1 / a + 1 / b + 1 / (size[1] - counts[1] + 0.5) + 1 / (size[0] - counts[0] + 0.5))
    sure = np.clip(odds / deviation, 0, 6)
    sure[(sure < 2) | (counts[1] < 3)] = 0
    sure[0] = 0
    return sure


def train(texts: list[str], labels: list[int], rate: tuple[float, float] = (1.0, 1.0), epochs: int = 6, batch: int = 32, step: float = 0.01, model: TextCnn | None = None) -> TextCnn:
    """Fit a model and its thresholds. ``rate`` is how many rows one sampled row of each class stands for. Every fifth text calibrates."""
    model = model or TextCnn()
    vocabulary = Vocabulary(model.buckets)
    target = np.array(labels, np.float32)
    r = np.random.default_rng(model.seed)
    index = r.permutation(len(texts))
    fit, check = (index[np.arange(len(index)) % 5 != 0], index[::5]) if len(index) >= 50 else (index, index)
    tokens = [vocabulary.tokens(t) for t in texts]
    # The first dimension starts with what counting tells, and the first filter of each width reads it; the rest starts from chance.
    model.embedding[:, 0] = 0.5 * prior([tokens[i] for i in fit], target[fit], vocabulary)
    for i, kernel in enumerate(model.kernels):
        kernel[:, :, 0] = 0
        kernel[:, 0, 0] = 1
        kernel[:, 0, 1:] *= 0.1
        model.dense[i * model.filters] = 0.5
    balance = np.where(target == 1, 1 / max(1, target.sum()), 1 / max(1, (1 - target).sum()))
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    history = np.full(model.buckets, 1e-8, np.float32)
    count = 0
    for epoch in range(epochs if len(fit) > 500 else 5 * epochs):
        order = r.permutation(fit)
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            rows, starts, stops, owner = _layout([tokens[i] for i in chosen], max(model.widths))
            grads, at, change = model.gradients(vocabulary.features[rows], starts, stops, target[chosen][owner], balance[chosen][owner])
            count += 1
            for p, g, m, v in zip(model.parameters(), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= step * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-8)
            # The embedding is updated where it was used, with a step of its own for each bucket.
            used, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(used), model.size), np.float32)
            np.add.at(total, inverse.reshape(-1), np.repeat(change, Vocabulary.FEATURES, axis=0))
            history[used] += (total**2).mean(axis=1)
            model.embedding[used] -= 5 * step * total / np.sqrt(history[used])[:, None]
            model.embedding[0] = 0
    logit, language = raw_logits(model, vocabulary, [texts[i] for i in check])
    weight = np.where(target[check] == 1, rate[1], rate[0])
    overall = _best_threshold(logit, target[check], weight)
    model.thresholds = np.full(len(LANGUAGES) + 1, overall)
    for k in range(len(LANGUAGES)):
        own = language == k
        if 5 <= target[check][own].sum() <= own.sum() - 5:
            model.thresholds[k] = _best_threshold(logit[own], target[check][own], weight[own])
    return model


def score(model: TextCnn, vocabulary: Vocabulary, texts: list[str]) -> np.ndarray:
    """0 to 1; 0.5 is the threshold of the text's language."""
    logit, language = raw_logits(model, vocabulary, texts)
    logit = np.where([bool(_WORD.search(t)) for t in texts], logit - model.thresholds[language], NO_WORDS)
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int, sample_bytes: int) -> tuple[list[str], list[int], tuple[float, float]]:
    """At most ``per_class`` labelled texts of each class, those with the least hash of their identifier, and at most ``sample_bytes`` of characters. Rows whose crc32(identifier as text) mod 5 is
    0 are never used. A text that does not fit is left out, and others take its room; if none of a class fits, that is an error. Sizes are read first, so only the chosen texts reach the driver."""
    key = F.col(id_col).cast("long")
    rows = labels.select(key.alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1) AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 0").groupBy("doc_id").agg(F.max("y").alias("y"))
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id"), F.col("doc_id")
    some = rows.where("y = 0").orderBy(*order).limit(per_class).unionAll(rows.where("y = 1").orderBy(*order).limit(per_class))
    source = docs.select(key.alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # First the sizes alone: at most 2 * per_class rows of three numbers. Of texts that share an identifier the one of least hash counts.
    sizes = source.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.first("y").alias("y"), F.min(F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("size"))).alias("text")).select("doc_id", "y", "text.*")
    sample = sorted(sizes.collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    chosen, held = set(), 0
    # Each class up to half of the room, then whatever else fits.
    for y, room in ((0, sample_bytes // 2), (1, sample_bytes // 2), (None, sample_bytes)):
        own = 0 if y is not None else held
        for i, r in enumerate(sample):
            if i not in chosen and y in (None, r["y"]) and own + r["size"] <= room:
                chosen.add(i)
                own += r["size"]
        held = held + own if y is not None else own
    found = [sample[i]["y"] for i in sorted(chosen)]
    if without := {r["y"] for r in sample} - set(found):
        raise ValueError(f"no text of class {sorted(without)} fits in sample_bytes={sample_bytes}")
    taken = docs.sparkSession.createDataFrame([(n, sample[i]["doc_id"], sample[i]["hash"]) for n, i in enumerate(sorted(chosen))], "n long, doc_id long, hash long")
    rows = source.withColumn("hash", F.xxhash64("text")).join(F.broadcast(taken), ["doc_id", "hash"]).groupBy("n").agg(F.min("text").alias("text"))
    texts = [r["text"] for r in sorted(rows.collect())]
    got = {y: max(1, found.count(y)) for y in (0, 1)}
    return texts, found, (totals.get(0, 0) / got[0], totals.get(1, 0) / got[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 2500, sample_bytes: int = 48 << 20) -> TextCnn:
    """A model fitted on a sample of at most ``2 * per_class`` rows; without labels of both classes one that scores every text under 0.5."""
    texts, found, rate = training_rows(docs, labels, id_col, text_col, label_col, per_class, sample_bytes)
    if len(set(found)) < 2:
        model = TextCnn()
        model.dense[:] = 0
        model.thresholds[:] = 5
        return model
    return train(texts, found, rate)


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cnn, vocabulary = model.value, Vocabulary(model.value.buckets)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = part.column(1)
                s = score(cnn, vocabulary, [texts[i].as_py() or "" for i in range(part.num_rows)])
                held_out = [None if i is None else zlib.crc32(str(i).encode()) % 5 == 0 for i in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(held_out, pa.bool_()), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=_OUT.names)

    return run


def _clean(model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cnn, vocabulary = model.value, Vocabulary(model.value.buckets)
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                texts = part.column(at)
                yield part.filter(pa.array(score(cnn, vocabulary, [texts[i].as_py() or "" for i in range(part.num_rows)]) < 0.5))

    return run


def toxicity_scores(docs: DataFrame, model: TextCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    ``held_out``: crc32(identifier as text) mod 5 is 0 (null without identifier). ``predicted`` is 1 if the score is 0.5 or more. A null text is an empty one; it is scored as a text without
    words. Repeated rows get equal scores, an empty table gives an empty result, other columns are not read. No shuffle; the model (about 2 MB, whatever the data) is broadcast,
    and long texts are scored whole in overlapping segments.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model)), _OUT)


def without_toxic(docs: DataFrame, model: TextCnn, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with their columns."""
    return docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)), docs.schema)
