"""Sorts, limits and top-k lists (2.E E10/E11, 2.F).

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition
keeps its own top k and only those rows meet in the final merge.  Top k per
group uses ``row_number() <= k``, which Spark plans with a map-side group
limit before the shuffle.  Every order has a unique tie-break column, so the
result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.functions.calendar import clock_hhmm
from cardrisk.operators.filters import day_slice
from cardrisk.operators.rolling import money
from cardrisk.operators.sampling import hash_order
from cardrisk.schema import (
    CUSTOMER_ID,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_DATETIME,
    TX_FRAUD,
)

# Case status shown for the newest five fraud cases, by rank.
CASE_STATUS = (
    "🟥 Offen",
    "🟥 Offen",
    "🟧 In Bearbeitung (0452)",
    "🟧 In Bearbeitung (0572)",
    "✅ Abgeschlossen (0578)",
)


def latest_fraud_cases(
    df: DataFrame, day=None, n: int = 5, statuses: Sequence[str] = CASE_STATUS, ts: str = TX_DATETIME
) -> DataFrame:
    """Newest ``n`` frauds of a day (default the latest day) with clock time and case status by rank."""
    d = day_slice(df, day, ts).filter(F.col(TX_FRAUD) == 1)
    top = d.orderBy(F.col(ts).desc_nulls_last(), F.col(TRANSACTION_ID)).limit(n)
    w = Window.orderBy(F.col(ts).desc_nulls_last(), F.col(TRANSACTION_ID))  # over at most n rows
    status = F.array(*[F.lit(s) for s in statuses])
    return top.select(
        TRANSACTION_ID,
        clock_hhmm(ts).alias("TIME_HHMM"),
        TX_AMOUNT,
        CUSTOMER_ID,
        TERMINAL_ID,
        F.try_element_at(status, F.row_number().over(w)).alias("STATUS"),
    )


def top_transactions(df: DataFrame, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(TX_AMOUNT).desc_nulls_last(), F.col(TRANSACTION_ID)).limit(n).select(
        TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TX_AMOUNT, TX_FRAUD
    )


def top_fraud_terminals(df: DataFrame, day=None, n: int = 5, ts: str = TX_DATETIME) -> DataFrame:
    d = day_slice(df, day, ts).filter(F.col(TX_FRAUD) == 1)
    return (
        d.groupBy(TERMINAL_ID)
        .agg(F.count(F.lit(1)).alias("n_fraud"))
        .orderBy(F.col("n_fraud").desc(), F.col(TERMINAL_ID))
        .limit(n)
    )


def top_customers(df: DataFrame, n: int = 10, amount_scale: int | None = 2) -> DataFrame:
    """Customers by turnover (exact decimal sum; more digits than the scale are an error)."""
    return (
        df.groupBy(CUSTOMER_ID)
        .agg(F.sum(money(TX_AMOUNT, amount_scale)).cast("double").alias("turnover"))
        .orderBy(F.col("turnover").desc_nulls_last(), F.col(CUSTOMER_ID))
        .limit(n)
    )


def top_risk_terminals(df: DataFrame, col: str = "TERMINAL_ID_RISK_30DAY_WINDOW", n: int = 10, digits: int = 9) -> DataFrame:
    """Terminals by their mean risk (rounded so the order is engine-independent)."""
    return (
        df.groupBy(TERMINAL_ID)
        .agg(F.round(F.avg(col), digits).alias("mean_risk"))
        .orderBy(F.col("mean_risk").desc_nulls_last(), F.col(TERMINAL_ID))
        .limit(n)
    )


def customer_last_n(df: DataFrame, n: int = 10, customer_id: int | None = None, ts: str = TX_DATETIME) -> DataFrame:
    """The newest ``n`` transactions of one customer, or of every customer at once."""
    if customer_id is not None:
        d = df.filter(F.col(CUSTOMER_ID) == customer_id)
        return d.orderBy(F.col(ts).desc_nulls_last(), F.col(TRANSACTION_ID)).limit(n).select(
            CUSTOMER_ID, TRANSACTION_ID, ts, TX_AMOUNT
        )
    w = Window.partitionBy(CUSTOMER_ID).orderBy(F.col(ts).desc_nulls_last(), F.col(TRANSACTION_ID))
    return (
        df.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
        .select(CUSTOMER_ID, "rank", TRANSACTION_ID, ts, TX_AMOUNT)
    )


def sample_n(df: DataFrame, n: int = 1000, seed: int = 42, id_col: str = TRANSACTION_ID) -> DataFrame:
    """min(n, rows) rows without replacement, reproducible by seed."""
    return df.orderBy(hash_order(id_col, seed), F.col(id_col)).limit(n)


def chronological(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    """Full sort by time for output files (range-partitioned, never between windows)."""
    return df.orderBy(F.col(ts).asc_nulls_last(), F.col(TRANSACTION_ID))

