"""All queries of the engine by name, and the SQL each is checked against."""

from __future__ import annotations

from loomspark.plans import company_queries, discovery_queries, document_queries, merge_queries, rank_queries, result_queries, row_queries, scanner_queries, source_queries, text_queries  # noqa: F401  they register themselves
from loomspark.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
