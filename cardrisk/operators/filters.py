"""Row filters and searches (2.B).

Filters on raw columns reach the parquet scan as pushed predicates; date
predicates are written as timestamp ranges (not ``to_date(ts) = d``) so they
push down too.  Defaults that depend on the data ("the latest day", "the
three latest days") are scalar subqueries or tiny ordered lists, computed by
Spark, never collected into the driver.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.functions.scalar import id_matches, status_light
from cardrisk.schema import (
    CUSTOMER_ID,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_DATETIME,
    TX_FRAUD,
    TX_TIME_DAYS,
)


def filter_min_day(df: DataFrame, min_day: int | None) -> DataFrame:
    """Keep ``TX_TIME_DAYS >= min_day`` when the column exists."""
    if min_day is None or TX_TIME_DAYS not in df.columns:
        return df
    return df.filter(F.col(TX_TIME_DAYS) >= min_day)


def _day_start(d) -> Column:
    if isinstance(d, Column):
        return d.cast("timestamp")
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp")


def day_range(ts: str, first, last) -> Column:
    """``first <= date(ts) <= last`` as a pushable timestamp range."""
    c = F.col(ts)
    start = _day_start(first)
    end = _day_start(last) + F.expr("INTERVAL 1 DAY")
    return (c >= start) & (c < end)


def filter_date_range(df: DataFrame, begin, end, ts: str = TX_DATETIME) -> DataFrame:
    """Rows whose calendar day lies in ``[begin, end]`` (both inclusive)."""
    return df.filter(day_range(ts, begin, end))


def fraud_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(TX_FRAUD) == 1)


def drop_null_timestamps(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    return df.filter(F.col(ts).isNotNull())


def latest_day(df: DataFrame, ts: str = TX_DATETIME) -> Column:
    """Scalar subquery: the latest calendar day in ``df``."""
    return df.select(F.max(F.to_date(ts))).scalar()


def day_slice(df: DataFrame, day=None, ts: str = TX_DATETIME) -> DataFrame:
    """Rows of one calendar day; default the latest day in the data."""
    d = latest_day(df, ts) if day is None else day
    return df.filter(day_range(ts, d, d))


def latest_days(df: DataFrame, n: int = 3, ts: str = TX_DATETIME) -> DataFrame:
    """The ``n`` latest distinct days (at most ``n`` rows)."""
    return df.select(F.to_date(ts).alias("_day")).distinct().orderBy(F.col("_day").desc()).limit(n)


def search_transactions(
    df: DataFrame,
    amount_min: float | None = None,
    amount_max: float | None = None,
    days: Sequence | None = None,
    n_latest_days: int = 3,
    status: str = "all",
    customer_pattern: str | None = None,
    terminal_pattern: str | None = None,
    ts: str = TX_DATETIME,
) -> DataFrame:
    """Conjunctive search; each optional part is skipped when empty.

    ``days=None`` means the ``n_latest_days`` latest days of the data (a
    semi-join against that bounded list).  ``status`` is 'all', 'fraud' or
    'legit'.
    """
    d = df.filter(F.col(ts).isNotNull())
    if amount_min is not None:
        d = d.filter(F.col(TX_AMOUNT) >= amount_min)
    if amount_max is not None:
        d = d.filter(F.col(TX_AMOUNT) <= amount_max)
    if days is None:
        picked = latest_days(df, n_latest_days, ts)
        d = d.join(F.broadcast(picked), F.to_date(F.col(ts)) == picked["_day"], "left_semi")
    elif len(days):
        # an OR of day ranges on the raw timestamp reaches the parquet scan
        ranges = [day_range(ts, x, x) for x in dict.fromkeys(days)]
        d = d.filter(functools.reduce(lambda a, b: a | b, ranges))
    if status == "fraud":
        d = d.filter(F.col(TX_FRAUD) == 1)
    elif status == "legit":
        d = d.filter(F.col(TX_FRAUD) == 0)
    elif status != "all":
        raise ValueError("status must be 'all', 'fraud' or 'legit'")
    if customer_pattern:
        d = d.filter(id_matches(CUSTOMER_ID, customer_pattern))
    if terminal_pattern:
        d = d.filter(id_matches(TERMINAL_ID, terminal_pattern))
    return d


def search_view(df: DataFrame) -> DataFrame:
    """Display projection of a search result with the traffic light."""
    return df.select(TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, status_light(TX_FRAUD).alias("STATUS"))


def filter_min_amount(df: DataFrame, amount: float) -> DataFrame:
    return df.filter(F.col(TX_AMOUNT) >= amount)


def tx_lookup(df: DataFrame, transaction_id: int) -> DataFrame:
    """Point lookup; pushed to the parquet scan as an equality predicate."""
    return df.filter(F.col(TRANSACTION_ID) == transaction_id)


# Flag column marking cases forwarded to second-level support, if present.
FORWARDED = "WEITERGELEITET_AN_SUPPORT"


def second_level_queue(df: DataFrame, n: int = 10, ts: str = TX_DATETIME) -> DataFrame:
    """Forwarded cases if the flag column exists, else the newest frauds; newest ``n``."""
    if FORWARDED in df.columns:
        d = df.filter(F.col(FORWARDED).cast("int") == 1)  # 0/1 or a boolean
    else:
        d = df.filter(F.col(TX_FRAUD) == 1)
    return d.orderBy(F.col(ts).desc_nulls_last(), F.col(TRANSACTION_ID)).limit(n)
