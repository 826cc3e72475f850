"""Sinks (2.A): feature tables, previews, daily partitions, predictions, history.

Output folders are given by the caller; on a cluster they must be on shared
storage (``scratch_path`` builds one under ``spark.checkpoint.dir``).
Writes are whole-folder overwrites or appends, so a retried job writes the
same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cardrisk.functions.scalar import clip_round
from cardrisk.schema import PREDICTED_FRAUD, TRANSACTION_ID, TX_DATETIME, TX_FRAUD, TX_TIME_DAYS, TX_TIME_SECONDS
from cardrisk.sources.readers import TS_WRITE_FORMAT


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True).option("timestampFormat", TS_WRITE_FORMAT)
        w.csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """All feature rows (parquet by default, CSV with header on request)."""
    return write_table(df, path, fmt)


def write_features_checked(df: DataFrame, path: str, fmt: str = "parquet") -> dict:
    """Write all feature rows and return the data check of what was written: rows, frauds, first and last time and the nulls of
    every column (``null_<column>``).

    The check is observed in the pass that writes; the rows are not read for it again.
    """
    seen = Observation("feature check")
    ts = F.col(TX_DATETIME).cast("timestamp_ntz")
    checks = [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(TX_FRAUD), F.lit(0)).cast("bigint").alias("n_fraud"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time")]
    checks += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in df.columns]
    write_table(df.observe(seen, *checks), path, fmt)
    return seen.get


def preview(df: DataFrame, n: int = 50, ts: str = TX_DATETIME) -> DataFrame:
    """The first ``n`` rows in time order (a top-n, not a full sort)."""
    return df.orderBy(F.col(ts).asc_nulls_last(), F.col(TRANSACTION_ID)).limit(n)


def write_preview(df: DataFrame, path: str, n: int = 50, fmt: str = "csv") -> str:
    return write_table(preview(df, n).coalesce(1), path, fmt)


def write_daily_partitions(
    df: DataFrame, path: str, start: dt.date | str = "2024-01-01", fmt: str = "parquet", partitions: int | None = None
) -> str:
    """One folder per day ``TX_DATE = start + TX_TIME_DAYS``, rows sorted by time within.

    Rows are range-partitioned on (day, time) before the write: a normal day
    is written by one or a few tasks, and a hot day is split over several
    tasks (several files in its folder) instead of landing in one task.
    ``partitions`` defaults to the session's shuffle partitions.
    """
    start_d = dt.date.fromisoformat(start) if isinstance(start, str) else start
    d = df.withColumn("TX_DATE", F.date_add(F.lit(start_d), F.col(TX_TIME_DAYS)))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.repartitionByRange(n, "TX_DATE", TX_TIME_SECONDS).sortWithinPartitions("TX_DATE", TX_TIME_SECONDS)
    d.write.mode("overwrite").partitionBy("TX_DATE").format(fmt).save(path)
    return path


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> str:
    return write_table(df.select(TRANSACTION_ID, PREDICTED_FRAUD), path, fmt)


def append_history(df: DataFrame, path: str, metrics: Sequence[str], base: dict | None = None,
                   spread: float = 0.005, digits: int = 4) -> str:
    """Append metric rows, each metric rounded (and clipped around ``base`` when given)."""
    cols = {}
    for c in metrics:
        cols[c] = clip_round(c, base[c], spread, digits) if base and c in base else F.round(F.col(c), digits)
    return write_table(df.withColumns(cols), path, "csv", mode="append")

