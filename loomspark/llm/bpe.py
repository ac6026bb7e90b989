"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring base symbols that no vocabulary token holds side by side can never be merged over, so a word may be cut
there; the fragments are encoded independently and their identifiers concatenated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: No merge.
NONE = 1 << 62

_OUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)
_FULL = T.StructType([*_OUT.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])


def _byte_symbols() -> list[str]:
    """The printable symbol of each byte, as byte-level vocabularies write it: bytes that print stand for themselves, the others are
    numbered from U+0100 on."""
    prints = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256))
    return [chr(b) if b in prints else chr(256 + next(others)) for b in range(256)]


class ForcedBoundaryBpe:
    """Encoder and decoder for a word-level BPE file with an end-of-word suffix (a tokenizers JSON file).

    Texts go the way the file says: special tokens are found first, the rest is NFC-normalised, its white space made single spaces,
    lower-cased character by character, cut into words by the file's pattern, and each word's bytes are merged. Identifiers are those
    of the tokenizers library without added special tokens. Decoding joins the tokens' strings with one space, as the
    library does for a file without decoder.
    """

    #: Bytes of the memo of words, about; it is emptied when full, and a word that takes a thousandth of it is not kept.
    MEMO = 96 << 20
    #: Symbols from which on a fragment is merged with a heap.
    LONG = 48

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, normal = spec["model"], spec["normalizer"]["normalizers"]
        if [n["type"] for n in normal] != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or model["type"] != "BPE":
            raise ValueError(f"{path}: only NFC, white-space, lower-case BPE files without decoder are known")
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.strings = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        symbols = _byte_symbols()
        self.inner = [self.vocab[c] for c in symbols]
        self.last = [self.vocab[c + self.suffix] for c in symbols]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # Rank above, the merged token in the lower 24 bits.
        self.merges = {(self.vocab[a], self.vocab[b]): rank << 24 | self.vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.inside = self._pairs_inside()
        self.memo: dict[str, tuple[bytes, int, str]] = {}
        self.held = 0

    def _base(self, token: str) -> list[int]:
        """The base symbols of a token, the last with its suffix."""
        ends = bool(self.suffix) and token.endswith(self.suffix)
        chars = list(token[: -len(self.suffix)] if ends else token)
        if ends and chars:
            chars[-1] += self.suffix
        return [self.vocab.get(c, -1) for c in chars]

    def _pairs_inside(self) -> set[tuple[int, int]]:
        """Every pair of base symbols side by side in some token; any other pair marks a certain cut."""
        found: set[tuple[int, int]] = set()
        for token in self.vocab:
            base = self._base(token)
            found.update(zip(base, base[1:], strict=False))
        return found

    def fragments(self, base: list[int]) -> list[list[int]]:
        """The word cut at its forced boundaries."""
        inside, start, out = self.inside, 0, []
        for end, pair in enumerate(zip(base, base[1:], strict=False), 1):
            if pair not in inside:
                out.append(base[start:end])
                start = end
        out.append(base[start:])
        return out

    def _merge(self, ids: list[int]) -> list[int]:
        """Merge the pair of least rank, the leftmost first, until none is left. Only the neighbours of a merge get new ranks."""
        if len(ids) > self.LONG:
            return self._merge_long(ids)
        get = self.merges.get
        found = [get(p, NONE) for p in zip(ids, ids[1:], strict=False)]
        while found and (least := min(found)) != NONE:
            i = found.index(least)
            new = ids[i] = least & 0xFFFFFF
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = get((ids[i - 1], new), NONE)
            if i < len(found):
                found[i] = get((new, ids[i + 1]), NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list: n log n, where a list takes the square. A pair that a merge has broken is passed over when it comes up."""
        get, end = self.merges.get, len(ids)
        after, before = [*range(1, end + 1)], [*range(-1, end - 1)]
        heap = [(value, i) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if (value := get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            value, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j == end or get((ids[i], ids[j])) != value:
                continue
            ids[i], ids[j] = value & 0xFFFFFF, -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (found := get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (found, i))
            h = before[i]
            if h >= 0 and (found := get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (found, h))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> tuple[bytes, int, str]:
        """Identifiers as little-endian bytes, their number, and the decoded tokens."""
        data = word.encode()
        base = [self.inner[b] for b in data]
        base[-1] = self.last[data[-1]]
        ids = [i for part in self.fragments(base) for i in self._merge(part)]
        found = struct.pack(f"<{len(ids)}I", *ids), len(ids), " ".join([self.strings[i] for i in ids])
        size = 4 * len(word) + len(found[0]) + len(found[2]) + 300
        if size <= self.MEMO // 1000:
            if self.held + size > self.MEMO:
                self.memo.clear()
                self.held = 0
            self.held += size
            self.memo[word] = found
        return found

    def _normal(self, text: str) -> str:
        # White space only separates words, so it need not be made single. Lower case goes by characters: a final sigma is not special.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _plain(self, text: str) -> list[tuple[bytes, int, str]]:
        get, word = self.memo.get, self.word
        return [get(w) or word(w) for w in self.words.findall(self._normal(text))]

    def pieces(self, text: str) -> list[tuple[bytes, int, str]]:
        """(identifiers, their number, decoded tokens) of each word and special token in order."""
        if not self.special or "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._plain(text[at : m.start()])
            i = self.added[m[0]]
            out.append((struct.pack("<I", i), 1, m[0]))
            at = m.end()
        return out + self._plain(text[at:])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(p[0] for p in self.pieces(text)), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids)


def _encode(path: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ForcedBoundaryBpe(path)
        schema = _FULL if full else _OUT
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = part.column(1)
                counts, ids_sha, text_sha, ids, decoded = [], [], [], [], []
                for i in range(part.num_rows):
                    pieces = bpe.pieces(texts[i].as_py() or "")
                    packed = b"".join([p[0] for p in pieces])
                    counts.append(len(packed) // 4)
                    ids_sha.append(hashlib.sha256(packed).hexdigest())
                    text = " ".join([p[2] for p in pieces])
                    text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                    if full:
                        ids.append(np.frombuffer(packed, "<i4"))
                        decoded.append(text)
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                if full:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return run


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if ``full``, ``ids`` and ``decoded``.

    A null text is an empty one: no identifiers and an empty decoded text. Rows are independent: repeated rows give repeated rows, a null
    identifier stays null, an empty table gives an empty result, other columns are not read. No shuffle; memory is one text and a
    bounded memo of words in each worker. ``path`` must be readable on every executor.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(_encode(path, full), _FULL if full else _OUT)
