"""Group aggregates broadcast back to rows (``transform('mean')`` / ``map``).

An unordered ``avg().over(partitionBy(key))`` would put a hot key's rows into
one task.  Instead the aggregate is a ``groupBy`` (partial aggregation before
the shuffle, so a hot key costs one row per map task) and the per-key result
is joined back; AQE chooses between a broadcast (measured size) and a
skew-split sort-merge join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.operators.rolling import money
from cardrisk.schema import (
    TERMINAL_FRAUD_RATIO,
    TERMINAL_ID,
    TX_AMOUNT,
    TX_AMOUNT_TO_TERMINAL_AVG,
    TX_FRAUD,
)


def join_group_aggregates(
    df: DataFrame,
    key: str,
    aggs: Mapping[str, Column],
) -> DataFrame:
    """Left-join ``df.groupBy(key).agg(aggs)`` onto every row of ``df``."""
    stats = df.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    return df.join(stats, key, "left")


def terminal_means(
    df: DataFrame,
    key: str = TERMINAL_ID,
    amount_scale: int | None = 2,
    method: str = "join",
) -> DataFrame:
    """Amount over the key's mean amount, and the key's fraud ratio (all rows).

    ``method='join'``: ``groupBy`` (partial aggregation) joined back, safe for
    hot keys.  ``method='window'``: an unordered window over the key, for rows
    already partitioned by the key with no hot key among them (the feature
    plan after its probe): no extra scan, shuffle or join.
    """
    aggs = {
        "_amt_sum": F.sum(money(TX_AMOUNT, amount_scale)),
        "_amt_n": F.count(TX_AMOUNT),
        "_fr_sum": F.sum(TX_FRAUD),
        "_fr_n": F.count(TX_FRAUD),
    }
    if method == "window":
        w = Window.partitionBy(key)
        d = df.withColumns({n: F.when(F.col(key).isNotNull(), c.over(w)) for n, c in aggs.items()})
    else:
        d = join_group_aggregates(df, key, aggs)
    mean_amt = F.try_divide(F.col("_amt_sum").cast("double"), F.col("_amt_n"))
    return d.withColumns(
        {
            TX_AMOUNT_TO_TERMINAL_AVG: F.try_divide(F.col(TX_AMOUNT), mean_amt),
            TERMINAL_FRAUD_RATIO: F.try_divide(F.col("_fr_sum").cast("double"), F.col("_fr_n")),
        }
    ).drop("_amt_sum", "_amt_n", "_fr_sum", "_fr_n")


MEAN_AMOUNT = "MEAN_AMOUNT"


def fit_terminal_stats(train: DataFrame, key: str = TERMINAL_ID, amount_scale: int | None = 2) -> DataFrame:
    """``key, MEAN_AMOUNT, TERMINAL_FRAUD_RATIO`` of the given (train) rows."""
    return train.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.try_divide(F.sum(money(TX_AMOUNT, amount_scale)).cast("double"), F.count(TX_AMOUNT)).alias(MEAN_AMOUNT),
        F.try_divide(F.sum(TX_FRAUD).cast("double"), F.count(TX_FRAUD)).alias(TERMINAL_FRAUD_RATIO),
    )


def fitted_stats_lookup(df: DataFrame, fitted: DataFrame, key: str = TERMINAL_ID, default: float = 0.0) -> DataFrame:
    """Fitted terminal statistics as features; a terminal not fitted has ratio ``default`` and no mean."""
    d = df.drop(TERMINAL_FRAUD_RATIO, TX_AMOUNT_TO_TERMINAL_AVG).join(fitted.select(key, MEAN_AMOUNT, TERMINAL_FRAUD_RATIO), key, "left")
    return d.withColumns({
        TERMINAL_FRAUD_RATIO: F.coalesce(F.col(TERMINAL_FRAUD_RATIO), F.lit(default)),
        TX_AMOUNT_TO_TERMINAL_AVG: F.try_divide(F.col(TX_AMOUNT), F.col(MEAN_AMOUNT)),
    }).drop(MEAN_AMOUNT)
