"""Points of the candidates by each scanner's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.functions import texts
from loomspark.operators import rank
from loomspark.operators import scanners as s
from loomspark.plans.merge_queries import C, candidates
from loomspark.plans import rank_sql as q
from loomspark.plans import surrogate
from loomspark.plans.rank_queries import YEAR, sql_year
from loomspark.plans.rank_sql import sql_match, sql_sum
from loomspark.plans.registry import query

_BOTH = "concat(text, ' ', url)"


def _first(text: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, '\\b(20[12][0-9])\\b', 1), '') AS INT)"


def _recency(y: str) -> str:
    return f"(CASE WHEN {y} IN ({YEAR - 1}, {YEAR}) THEN 5 WHEN {y} = {YEAR - 2} THEN 2 WHEN {y} < {YEAR - 3} THEN ({y} - {YEAR - 3}) * 5 ELSE 0 END)"


def _lone(text: str, annual: str) -> str:
    return f"(CASE WHEN {sql_match(text, 'sustainability|hållbarhet')} AND NOT {sql_match(text, annual)} THEN -5 ELSE 0 END)"


def _pdf(points: str) -> str:
    return f"CASE WHEN {sql_match('url', '\\.pdf(\\?|$)')} THEN {points} ELSE -999 END"


_PARTS = {
    "browser": _pdf(f"5 + {sql_sum('text', q.BROWSER_TEXT)} + {sql_sum('url', q.BROWSER_ADDRESS)} + {sql_sum(_BOTH, q.BROWSER_BOTH)} + {_lone('text', 'annual|årsredovisning')} + {_recency(f'coalesce({_first("text")}, {_first("url")})')}"),
    "wire": _pdf(f"4 + {sql_sum('url', q.WIRE)} + {_recency(_first('url'))}"),
    "cms": f"4 + {sql_sum(_BOTH, q.CMS)} + {_lone(_BOTH, 'annual|årsredovisning|arsredovisning')} + CASE WHEN {sql_year('url')} IN ({YEAR}, {YEAR - 1}) THEN 4 WHEN {sql_year('url')} < {YEAR - 3} THEN -8 ELSE 0 END",
    "aggregator": f"3 + {sql_sum(_BOTH, q.AGGREGATOR)}",
    "ir": f"{sql_sum('text', q.IR_TEXT)} + {sql_sum('url', q.IR_ADDRESS)}",
    "search": _pdf(f"5 + {sql_sum('text', q.SEARCH_TEXT)} + {sql_sum('url', q.SEARCH_ADDRESS)} + {_recency(f'coalesce({_first("url")}, {_first("text")})')} + CASE WHEN contains(regexp_extract(url, '://([^/]*)', 1), 'ir2') THEN 4 WHEN contains(lower({_BOTH}), 'governance') THEN 0 ELSE -14 END"),
}


@query(f"SELECT company_id, ord, {', '.join(f'CAST({sql} AS INT) AS {name}' for name, sql in _PARTS.items())} FROM ({C}) c")
def scanner_points(spark, d):
    return _points(candidates(spark, d), "company_id", "ord")


def _points(rows, *keys):
    text, url = F.col("text"), F.col("url")
    names = F.array(F.lit("ir2"), F.lit("governance"))
    return rows.select(
        *keys,
        s.browser_points(text, url, YEAR).alias("browser"),
        s.wire_points(url, YEAR).alias("wire"),
        s.cms_points(text, url, rank.latest_year(url), YEAR).alias("cms"),
        s.aggregator_points(text, url).alias("aggregator"),
        s.ir_points(text, url).alias("ir"),
        s.search_points(text, url, texts.host_key(url), names, YEAR).alias("search"),
    )


@query(f"SELECT p_partkey, {', '.join(f'CAST({sql} AS INT) AS {name}' for name, sql in _PARTS.items())} FROM ({surrogate.text(surrogate.TITLES)}) c")
def scanner_titles(spark, d):
    """The same over titles of every rule."""
    t = surrogate.frame(spark, d, surrogate.TITLES)
    return _points(t, "p_partkey")
