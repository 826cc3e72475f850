"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables; the SQL text computes the same columns with the same names
and types from the same parquet tables (views inlined as CTEs).
"""

from cardrisk.queries.registry import REGISTRY, oracle_sql, queries

# import the sections so they register themselves
from cardrisk.queries import (  # noqa: F401  (registration side effects)
    q_windows,
    q_filters,
    q_aggregates,
    q_topk,
    q_joins,
    q_sources,
    q_metrics,
    q_model,
    q_resample,
    q_search,
    q_sketches,
    q_upkeep,
    q_streaming,
    q_more,
)

__all__ = ["REGISTRY", "oracle_sql", "queries"]
