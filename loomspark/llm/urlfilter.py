"""URL filter: a broadcast trie over reversed host labels and path segments, in which the longest rule wins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (verdict, host, path)
Rule = tuple[str, str, str]

_OUT = T.StructType([T.StructField(c, T.LongType() if c == "page_id" else T.StringType()) for c in ("page_id", "host", "path", "rule", "verdict")])
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased; then the path up to ``?`` or ``#``.
    Both are empty for a null and for a text without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for stop in "#?":
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class UrlTrie:
    """Nodes are dicts: first by host labels from the right, then, below the key None, by path segments; the last segment of a rule may
    be the beginning of one. A deeper host beats a shallower one, then a longer path a shorter one."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block") or not host or not path.startswith("/"):
                raise ValueError(f"not a rule: {verdict} {host}{path}")
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, last = path[1:].split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            # None keeps the rules that end within this node's next segment; at equal rules block wins.
            ends = node.setdefault(None, {})
            if ends.get(last, ("", "allow"))[1] != "block":
                ends[last] = (host + path, verdict)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        if not host or not path.startswith("/"):
            return None
        node, hosts = self.root, []
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                hosts.append(node[None])
        segments = path[1:].split("/")
        for node in reversed(hosts):
            found = None
            for segment in segments:
                ends = node.get(None)
                if ends:
                    fits = [e for e in ends if segment.startswith(e)]
                    if fits:
                        found = ends[max(fits, key=len)]
                node = node.get(segment)
                if node is None:
                    break
            if found:
                return found
        return None


def _judge(trie, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for b in batches:
            parts = [split_url(u) for u in b.column(1).to_pylist()]
            found = [match(*p) or (None, default) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string()) for c in ([p[0] for p in parts], [p[1] for p in parts], [f[0] for f in found], [f[1] for f in found]))], names=_OUT.names
            )

    return run


def url_filter(pages: DataFrame, rules: Iterable[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", block_bytes: int = 32 << 20) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the url's path starts with the rule's; the longest rule (host first, then path) gives the
    verdict, at a tie block does. Where none fits, ``rule`` is null and the verdict is ``default``: a filter that lists nothing about a url lets
    it pass. A null or malformed url has empty host and path, so no rule fits. Repeated rows and null identifiers pass
    through, an empty table gives an empty result, other columns are not read.

    The broadcast is bounded: rules are cut into blocks of ``block_bytes`` of text, one trie each; with several blocks the urls pass through
    one trie after another and the longest match is kept.
    """
    spark = pages.sparkSession
    blocks: list[list[Rule]] = [[]]
    held = 0
    for rule in sorted(set(rules)):
        held += len(rule[1]) + len(rule[2])
        if held > block_bytes and blocks[-1]:
            blocks.append([])
            held = len(rule[1]) + len(rule[2])
        blocks[-1].append(rule)
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    if len(blocks) == 1:
        return source.mapInArrow(_judge(spark.sparkContext.broadcast(UrlTrie(blocks[0])), default), _OUT)

    def through(df: DataFrame, block: list[Rule]) -> DataFrame:
        # The identifier column carries the whole row so far, so that rows need not be joined again.
        return df.mapInArrow(_judge_more(spark.sparkContext.broadcast(UrlTrie(block)), default), T.StructType([*_OUT.fields, T.StructField("url", T.StringType())]))

    first = source.select("page_id", F.lit("").alias("host"), F.lit("").alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"), "url")
    return reduce(through, blocks, first).drop("url")


def _judge_more(trie, default: str):
    def rank(found: tuple | None) -> tuple[int, int, bool]:
        if not found or found[0] is None:
            return (-1, -1, False)
        host, slash, path = found[0].partition("/")
        return (len(host), len(slash + path), found[1] == "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for b in batches:
            urls = b.column(5).to_pylist()
            parts = [split_url(u) for u in urls]
            before = zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)
            found = [max((old, match(*p) or (None, default)), key=rank) for old, p in zip(before, parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.string()) for c in ([p[0] for p in parts], [p[1] for p in parts], [f[0] for f in found], [f[1] for f in found], urls))],
                names=[*_OUT.names, "url"],
            )

    return run
