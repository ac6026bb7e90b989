"""The queries of this subpackage and their SQL. Each applies its operator to the whole of its table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspark.llm.bpe import bpe_encode
from loomspark.llm.decontam import contained_items
from loomspark.llm.exactdedup import exact_dedup
from loomspark.llm.htmltext import html_text
from loomspark.llm.linededup import line_dedup
from loomspark.llm.sharding import shard_by_bytes
from loomspark.llm.simhash import simhash_groups
from loomspark.llm.suffixdedup import suffix_dedup
from loomspark.llm.toxicity import fit, toxicity_scores
from loomspark.llm.urlfilter import Rule, url_filter

#: Where the public tokenizer files are; every executor must have them.
TOKENIZERS = os.environ.get("LOOMSPARK_TOKENIZERS", "/opt/tokenizers")
WORD_BPE = f"{TOKENIZERS}/word_bpe_49k.json"

#: (verdict, host, path)
URL_RULES: tuple[Rule, ...] = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"), WORD_BPE, full=False)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).selectExpr("doc_id", "lines_removed", "lines_kept", "sha2(text, 256) AS kept_sha256")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), full=False)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_bpe, op2_url_filter, op3_html_text, op4_simhash, op5_sharding, op6_line_dedup, op7_decontamination, op8_suffix_dedup, op9_toxicity, op10_exact_dedup)
    return {f.__name__: f for f in found}


_HOST = r"""translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
_PATH = r"""regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"""


def _under(host: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}'))"


def _rule_case(column: int) -> str:
    """The longest rule first, so the first branch that fits is the verdict."""
    order = sorted(URL_RULES, key=lambda r: (len(r[1]), len(r[2])), reverse=True)
    return "CASE " + " ".join(f"WHEN {_under(h)} AND starts_with(path, '{p}') THEN '{(h + p, v)[column]}'" for v, h, p in order) + f" ELSE {('NULL', repr('allow'))[column]} END"


_OP2 = f"SELECT page_id, host, path, {_rule_case(0)} AS rule, {_rule_case(1)} AS verdict FROM (SELECT page_id, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path FROM pages) p"

_OP6 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(generate_series(0, len(x) - 1)) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM t) s),
w AS (SELECT doc_id, i, line, lead(line, 1) OVER d AS l2, lead(line, 2) OVER d AS l3 FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, i) AS n FROM w WHERE l3 IS NOT NULL AND (trim(line) <> '' OR trim(l2) <> '' OR trim(l3) <> '')),
g AS (SELECT DISTINCT doc_id, i + k AS i FROM f, (SELECT unnest([0, 1, 2]) AS k) o WHERE n > 1),
k AS (SELECT l.doc_id, count(*) FILTER (g.i IS NOT NULL) AS removed, count(*) FILTER (g.i IS NULL) AS kept, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY 1)
SELECT doc_id, CAST(removed AS INT) AS lines_removed, CAST(kept AS INT) AS lines_kept, sha256(coalesce(text, '')) AS kept_sha256 FROM k
"""

_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"
_OP7 = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM i) x),
n AS (SELECT item_id, count(*) AS n FROM s GROUP BY 1),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS k FROM d) x)
SELECT doc_id, item_id, shared / n AS containment, shared, n AS n_shingles FROM (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN s USING (s) GROUP BY 1, 2) m JOIN n USING (item_id) WHERE shared >= 0.8 * n
"""

_OP10 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def oracle_sql() -> dict[str, str]:
    """The others have no SQL: there is no 64-bit xxHash, CRC-32, byte BPE, parser or classifier in it; tests/llm holds them against brute force."""
    return {"op2_url_filter": _OP2, "op6_line_dedup": _OP6, "op7_decontamination": _OP7, "op10_exact_dedup": _OP10}
