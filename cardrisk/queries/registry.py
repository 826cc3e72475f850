from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.fixtures import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ("tx",)):
    """Register a query; ``sql`` is the oracle body, prefixed with the view CTEs."""

    def deco(fn: QueryFn) -> QueryFn:
        # re-registration (a module reload) replaces the entry
        REGISTRY[name] = (fn, with_views(sql, *views) if sql else None)
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}


def out(df: DataFrame) -> DataFrame:
    """Return timestamps as timestamp_ntz, the type the parquet source has."""
    cols = {}
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            cols[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(cols) if cols else df


__all__ = ["REGISTRY", "register", "queries", "oracle_sql", "out"]
