"""Window features (2.E), stage-two features (2.K K1/K2) and calendar flags (2.H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.functions.calendar import add_calendar_flags
from cardrisk.operators.group_stats import terminal_means
from cardrisk.operators.rolling import customer_spending, probe_hot_keys, terminal_risk
from cardrisk.operators.sequence import add_customer_sequence, ordered_lags, lag_name, spending_drift
from cardrisk.plans.features import build_features, feature_matrix
from cardrisk.queries.registry import out, register
from cardrisk.schema import (
    CUSTOMER_ID,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_AMOUNT_SHIFTED,
    US,
    D,
    customer_avg_col,
    customer_count_col,
    terminal_count_col,
    terminal_risk_col,
)

W = (1, 7, 30)
CUST_COLS = [c for n in W for c in (customer_count_col(n), customer_avg_col(n))]
TERM_COLS = [c for n in W for c in (terminal_count_col(n), terminal_risk_col(n))]


def cust_sql(windows=W) -> str:
    parts = []
    for n in windows:
        fr = f"(PARTITION BY CUSTOMER_ID ORDER BY us RANGE BETWEEN {n * D - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"count(TX_AMOUNT) OVER {fr} AS {customer_count_col(n)}")
        parts.append(
            f"CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) OVER {fr} AS DOUBLE) / "
            f"nullif(count(TX_AMOUNT) OVER {fr}, 0) AS {customer_avg_col(n)}"
        )
    return ",\n  ".join(parts)


def term_sql(delay=7, windows=W) -> str:
    parts = []
    for n in windows:
        fr = (
            f"(PARTITION BY TERMINAL_ID ORDER BY us RANGE BETWEEN {(delay + n) * D - 1} PRECEDING "
            f"AND {delay * D} PRECEDING)"
        )
        parts.append(f"count(TX_FRAUD) OVER {fr} AS {terminal_count_col(n)}")
        parts.append(
            f"coalesce(CAST(sum(TX_FRAUD) OVER {fr} AS DOUBLE) / nullif(count(TX_FRAUD) OVER {fr}, 0), 0) "
            f"AS {terminal_risk_col(n)}"
        )
    return ",\n  ".join(parts)


# ---------------------------------------------------------------- E1 / E2


@register(
    "customer_rolling",
    f"SELECT TRANSACTION_ID, CUSTOMER_ID,\n  {cust_sql()}\nFROM tx WHERE CUSTOMER_ID IS NOT NULL",
)
def customer_rolling(spark, sf):
    d = customer_spending(fx.tx(spark, sf))
    return d.select(TRANSACTION_ID, CUSTOMER_ID, *CUST_COLS)


# E1x: row-end tie rule, checked by brute force (self-join) on tx_orders
def _row_exact_sql() -> str:
    sel = []
    for n in W:
        cond = f"b.us > a.us - {n * D}"
        sel.append(f"count(CASE WHEN {cond} THEN b.TX_AMOUNT END) AS {customer_count_col(n)}")
        sel.append(
            f"CAST(sum(CASE WHEN {cond} THEN CAST(b.TX_AMOUNT AS DECIMAL(18,2)) END) AS DOUBLE) / "
            f"nullif(count(CASE WHEN {cond} THEN b.TX_AMOUNT END), 0) AS {customer_avg_col(n)}"
        )
    return (
        "SELECT a.TRANSACTION_ID, a.CUSTOMER_ID,\n  " + ",\n  ".join(sel) + "\n"
        "FROM tx_orders a JOIN tx_orders b ON a.CUSTOMER_ID = b.CUSTOMER_ID\n"
        f"  AND b.us > a.us - {max(W) * D} AND (b.us < a.us OR (b.us = a.us AND b.TRANSACTION_ID <= a.TRANSACTION_ID))\n"
        "GROUP BY a.TRANSACTION_ID, a.CUSTOMER_ID"
    )


@register("customer_rolling_row_exact", _row_exact_sql(), views=("tx_orders",))
def customer_rolling_row_exact(spark, sf):
    # years of history with ties; 120-day time blocks exercise the hot-key path
    d = customer_spending(fx.tx_orders(spark, sf), ties="row", block_days=120)
    return d.select(TRANSACTION_ID, CUSTOMER_ID, *CUST_COLS)


# ---------------------------------------------------------------- E3 / E4


@register("terminal_risk", f"SELECT TRANSACTION_ID, TERMINAL_ID,\n  {term_sql()}\nFROM tx WHERE TERMINAL_ID IS NOT NULL")
def terminal_risk_q(spark, sf):
    d = terminal_risk(fx.tx(spark, sf))
    return d.select(TRANSACTION_ID, TERMINAL_ID, *TERM_COLS)


@register(
    "terminal_risk_orders",
    f"SELECT TRANSACTION_ID, TERMINAL_ID,\n  {term_sql()}\nFROM tx_orders WHERE TERMINAL_ID IS NOT NULL",
    views=("tx_orders",),
)
def terminal_risk_orders(spark, sf):
    """Delayed risk over years of history with same-day ties, on the hot-key path (time blocks)."""
    d = terminal_risk(fx.tx_orders(spark, sf), block_days=148)
    return d.select(TRANSACTION_ID, TERMINAL_ID, *TERM_COLS)


# B9: one terminal's 30-day risk with delay 7
@register(
    "terminal_risk_sample",
    f"SELECT TRANSACTION_ID, TX_DATETIME, TX_FRAUD, TERMINAL_ID,\n  {term_sql(7, (30,))}\n"
    "FROM tx WHERE TERMINAL_ID = 42",
)
def terminal_risk_sample(spark, sf, terminal_id: int = 42):
    d = fx.tx(spark, sf).filter(F.col(TERMINAL_ID) == terminal_id)
    d = terminal_risk(d, delay=7, windows=(30,))
    return out(d.select(TRANSACTION_ID, "TX_DATETIME", "TX_FRAUD", TERMINAL_ID, terminal_count_col(30), terminal_risk_col(30)))


# ---------------------------------------------------------------- H1 / H2


@register(
    "calendar_flags",
    "SELECT TRANSACTION_ID, CAST(isodow(TX_DATETIME) >= 6 AS INTEGER) AS TX_DURING_WEEKEND,\n"
    "  CAST(hour(TX_DATETIME) <= 6 AS INTEGER) AS TX_DURING_NIGHT FROM tx",
)
def calendar_flags(spark, sf):
    return add_calendar_flags(fx.tx(spark, sf)).select(TRANSACTION_ID, "TX_DURING_WEEKEND", "TX_DURING_NIGHT")


# ---------------------------------------------------------------- E5 - E8

LAG_W = "(PARTITION BY CUSTOMER_ID ORDER BY us, TRANSACTION_ID)"


@register(
    "time_since_last_tx",
    f"SELECT TRANSACTION_ID, CUSTOMER_ID, CAST(lag(TX_TIME_SECONDS) OVER {LAG_W} AS DOUBLE) AS TX_TIME_SECONDS_SHIFTED,\n"
    f"  coalesce(TX_TIME_SECONDS - lag(TX_TIME_SECONDS) OVER {LAG_W}, 999999) AS TIME_SINCE_LAST_TX FROM tx",
)
def time_since_last_tx(spark, sf):
    d = add_customer_sequence(fx.tx(spark, sf))
    return d.select(TRANSACTION_ID, CUSTOMER_ID, "TX_TIME_SECONDS_SHIFTED", "TIME_SINCE_LAST_TX")


@register(
    "amount_lags",
    "SELECT TRANSACTION_ID, CUSTOMER_ID,\n"
    + ",\n".join(f"  lag(TX_AMOUNT, {k}) OVER {LAG_W} AS TX_AMOUNT_SHIFTED_{k}" for k in (1, 2, 3))
    + "\nFROM tx",
)
def amount_lags(spark, sf):
    d = ordered_lags(fx.tx(spark, sf), {TX_AMOUNT: 3})
    return d.select(
        TRANSACTION_ID, CUSTOMER_ID, *[F.col(lag_name(TX_AMOUNT, k)).alias(TX_AMOUNT_SHIFTED[k - 1]) for k in (1, 2, 3)]
    )


@register(
    "amount_lags_orders",
    "SELECT TRANSACTION_ID, CUSTOMER_ID,\n"
    + ",\n".join(f"  lag(TX_AMOUNT, {k}) OVER {LAG_W} AS TX_AMOUNT_SHIFTED_{k}" for k in range(1, 6))
    + "\nFROM tx_orders",
    views=("tx_orders",),
)
def amount_lags_orders(spark, sf):
    """Lags over years of history with ties on the hot-key path: many time blocks, lags cross block starts."""
    d = ordered_lags(fx.tx_orders(spark, sf), {TX_AMOUNT: 5}, block_us=120 * D)
    return d.select(
        TRANSACTION_ID, CUSTOMER_ID, *[F.col(lag_name(TX_AMOUNT, k)).alias(f"TX_AMOUNT_SHIFTED_{k}") for k in range(1, 6)]
    )


def mean_present_sql(cols) -> str:
    s = " + ".join(f"coalesce({c}, 0)" for c in cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return f"({s}) / nullif({n}, 0)"


@register(
    "last3_mean",
    "WITH l AS (SELECT TRANSACTION_ID, CUSTOMER_ID,\n"
    + ",\n".join(f"  lag(TX_AMOUNT, {k}) OVER {LAG_W} AS a{k}" for k in (1, 2, 3))
    + "\nFROM tx)\n"
    f"SELECT TRANSACTION_ID, CUSTOMER_ID, coalesce({mean_present_sql(['a1', 'a2', 'a3'])}, 0) AS TX_AMOUNT_LAST3_MEAN FROM l",
)
def last3_mean(spark, sf):
    d = add_customer_sequence(fx.tx(spark, sf))
    return d.select(TRANSACTION_ID, CUSTOMER_ID, "TX_AMOUNT_LAST3_MEAN")


@register(
    "spending_drift",
    "WITH l AS (SELECT TRANSACTION_ID, CUSTOMER_ID, TX_AMOUNT,\n"
    + ",\n".join(f"  lag(TX_AMOUNT, {k}) OVER {LAG_W} AS a{k}" for k in range(1, 6))
    + "\nFROM tx), m AS (\n"
    f"SELECT TRANSACTION_ID, CUSTOMER_ID, TX_AMOUNT, {mean_present_sql([f'a{k}' for k in range(1, 6)])} AS AVG_LAST_TX_AMOUNT FROM l)\n"
    "SELECT TRANSACTION_ID, CUSTOMER_ID, AVG_LAST_TX_AMOUNT,\n"
    "  CASE WHEN AVG_LAST_TX_AMOUNT + 1e-5 = 0 THEN (CASE WHEN TX_AMOUNT = 0 THEN 1.0 ELSE 0.0 END)\n"
    "       ELSE coalesce(TX_AMOUNT / (AVG_LAST_TX_AMOUNT + 1e-5), 1.0) END AS SPENDING_DRIFT FROM m",
)
def spending_drift_q(spark, sf):
    d = spending_drift(fx.tx(spark, sf), window=5)
    return d.select(TRANSACTION_ID, CUSTOMER_ID, "AVG_LAST_TX_AMOUNT", "SPENDING_DRIFT")


# ---------------------------------------------------------------- H6, D18/H7, C3


@register(
    "amount_deviation",
    "SELECT TRANSACTION_ID, TX_AMOUNT - CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW AS TX_AMOUNT_DEVIATION FROM feat",
    views=("feat",),
)
def amount_deviation(spark, sf):
    d = customer_spending(fx.tx(spark, sf), windows=(1,))
    return d.select(TRANSACTION_ID, (F.col(TX_AMOUNT) - F.col(customer_avg_col(1))).alias("TX_AMOUNT_DEVIATION"))


TERM_MEAN_SQL = (
    "CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) OVER (PARTITION BY TERMINAL_ID) AS DOUBLE) / "
    "nullif(count(TX_AMOUNT) OVER (PARTITION BY TERMINAL_ID), 0)"
)
TERM_RATIO_SQL = (
    "CAST(sum(TX_FRAUD) OVER (PARTITION BY TERMINAL_ID) AS DOUBLE) / "
    "nullif(count(TX_FRAUD) OVER (PARTITION BY TERMINAL_ID), 0)"
)


@register(
    "amount_to_terminal_avg",
    "SELECT TRANSACTION_ID, TERMINAL_ID,\n"
    f"  CASE WHEN TERMINAL_ID IS NOT NULL THEN TX_AMOUNT / nullif({TERM_MEAN_SQL}, 0) END AS TX_AMOUNT_TO_TERMINAL_AVG FROM tx",
)
def amount_to_terminal_avg(spark, sf):
    return terminal_means(fx.tx(spark, sf)).select(TRANSACTION_ID, TERMINAL_ID, "TX_AMOUNT_TO_TERMINAL_AVG")


@register(
    "terminal_fraud_ratio",
    f"SELECT TRANSACTION_ID, TERMINAL_ID, CASE WHEN TERMINAL_ID IS NOT NULL THEN {TERM_RATIO_SQL} END AS TERMINAL_FRAUD_RATIO FROM tx",
)
def terminal_fraud_ratio(spark, sf):
    return terminal_means(fx.tx(spark, sf)).select(TRANSACTION_ID, TERMINAL_ID, "TERMINAL_FRAUD_RATIO")


# ---------------------------------------------------------------- K1 / K2

STAGE2_SQL = (
    "WITH l AS (SELECT *,\n"
    f"  lag(TX_TIME_SECONDS) OVER {LAG_W} AS prev_t,\n"
    + ",\n".join(f"  lag(TX_AMOUNT, {k}) OVER {LAG_W} AS TX_AMOUNT_SHIFTED_{k}" for k in (1, 2, 3))
    + "\nFROM feat)\n"
    "SELECT * EXCLUDE (prev_t), TX_AMOUNT - CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW AS TX_AMOUNT_DEVIATION,\n"
    "  CAST(prev_t AS DOUBLE) AS TX_TIME_SECONDS_SHIFTED,\n"
    "  coalesce(TX_TIME_SECONDS - prev_t, 999999) AS TIME_SINCE_LAST_TX,\n"
    f"  coalesce({mean_present_sql(['TX_AMOUNT_SHIFTED_1', 'TX_AMOUNT_SHIFTED_2', 'TX_AMOUNT_SHIFTED_3'])}, 0) AS TX_AMOUNT_LAST3_MEAN,\n"
    f"  TX_AMOUNT / nullif({TERM_MEAN_SQL}, 0) AS TX_AMOUNT_TO_TERMINAL_AVG,\n"
    f"  {TERM_RATIO_SQL} AS TERMINAL_FRAUD_RATIO\n"
    "FROM l"
)


@register("stage2_features", STAGE2_SQL, views=("feat",))
def stage2_features_q(spark, sf):
    return out(build_features(fx.tx(spark, sf), stage2=True))


def _matrix_sql() -> str:
    ints = ["CUSTOMER_ID", "TERMINAL_ID", "TX_TIME_SECONDS", "TX_TIME_DAYS", "TX_DURING_WEEKEND", "TX_DURING_NIGHT",
            *[customer_count_col(n) for n in W], *[terminal_count_col(n) for n in W], "TIME_SINCE_LAST_TX"]
    dbl = ["TX_AMOUNT", *[customer_avg_col(n) for n in W], *[terminal_risk_col(n) for n in W],
           "TX_TIME_SECONDS_SHIFTED", "TX_AMOUNT_SHIFTED_1", "TX_AMOUNT_SHIFTED_2", "TX_AMOUNT_SHIFTED_3",
           "TX_AMOUNT_DEVIATION", "TX_AMOUNT_LAST3_MEAN", "TX_AMOUNT_TO_TERMINAL_AVG", "TERMINAL_FRAUD_RATIO"]
    sel = [f"coalesce({c}, 0) AS {c}" for c in ints]
    sel += [f"CASE WHEN isinf(CAST({c} AS DOUBLE)) OR isnan(CAST({c} AS DOUBLE)) THEN 0.0 ELSE coalesce(CAST({c} AS DOUBLE), 0.0) END AS {c}" for c in dbl]
    sel.append("coalesce(TX_FRAUD, 0) AS TX_FRAUD")
    return f"WITH s AS ({STAGE2_SQL})\nSELECT " + ",\n  ".join(sel) + "\nFROM s"


@register("feature_matrix", _matrix_sql(), views=("feat",))
def feature_matrix_q(spark, sf):
    d = build_features(fx.tx(spark, sf), stage2=True)
    return feature_matrix(d, exclude=("TRANSACTION_ID", "TX_DATETIME", "TX_FRAUD", "TX_FRAUD_SCENARIO", "AVG_LAST_TX_AMOUNT", US))





# Hot keys for real: keyed by order status, two keys each hold about half of
# all orders over years of history.  The probe threshold is set low so the
# per-key block path runs with blocks shorter than the look-back (rows copied
# into several blocks); the result must still equal the plain SQL frames.
HOT_STATUS_SQL = (
    "s AS (SELECT o_orderkey AS TRANSACTION_ID,\n"
    "  CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS BIGINT) AS TERMINAL_ID,\n"
    "  CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS TX_FRAUD, epoch_us(o_orderdate) AS us FROM orders)"
)


@register(
    "terminal_risk_hot_key",
    f"WITH {HOT_STATUS_SQL}\nSELECT TRANSACTION_ID, TERMINAL_ID,\n  {term_sql()}\nFROM s",
    views=(),
)
def terminal_risk_hot_key(spark, sf):
    o = fx.load(spark, sf, "orders")
    ts = F.col("o_orderdate").cast("timestamp")
    d = o.select(
        F.col("o_orderkey").alias(TRANSACTION_ID),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
        .cast("bigint").alias(TERMINAL_ID),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("TX_FRAUD"),
        ts.alias("TX_DATETIME"),
        F.unix_micros(ts).alias(US),
    )
    blocks = probe_hot_keys(d, {TERMINAL_ID: 37 * D}, max_rows=20)[TERMINAL_ID]
    return terminal_risk(d, block_days=blocks).select(TRANSACTION_ID, TERMINAL_ID, *TERM_COLS)


@register(
    "amount_lags_hot_key",
    "WITH s AS (SELECT o_orderkey AS TRANSACTION_ID,\n"
    "  CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS BIGINT) AS CUSTOMER_ID,\n"
    "  o_totalprice AS TX_AMOUNT, epoch_us(o_orderdate) AS us FROM orders)\n"
    "SELECT TRANSACTION_ID, CUSTOMER_ID,\n"
    + ",\n".join(f"  lag(TX_AMOUNT, {k}) OVER {LAG_W} AS TX_AMOUNT_SHIFTED_{k}" for k in range(1, 6))
    + "\nFROM s",
    views=(),
)
def amount_lags_hot_key(spark, sf):
    """Row lags keyed by order status (about half of all rows per key, same-day ties), on the
    per-key block path: lags crossing block starts come from the block tails."""
    o = fx.load(spark, sf, "orders")
    ts = F.col("o_orderdate").cast("timestamp")
    d = o.select(
        F.col("o_orderkey").alias(TRANSACTION_ID),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
        .cast("bigint").alias(CUSTOMER_ID),
        F.col("o_totalprice").alias(TX_AMOUNT),
        ts.alias("TX_DATETIME"),
        F.unix_micros(ts).alias(US),
    )
    blocks = probe_hot_keys(d, {CUSTOMER_ID: D}, max_rows=20)[CUSTOMER_ID]
    out = ordered_lags(d, {TX_AMOUNT: 5}, block_us=blocks)
    return out.select(
        TRANSACTION_ID, CUSTOMER_ID, *[F.col(lag_name(TX_AMOUNT, k)).alias(f"TX_AMOUNT_SHIFTED_{k}") for k in range(1, 6)]
    )


@register(
    "customer_rolling_hot_key",
    "WITH s AS (SELECT o_orderkey AS TRANSACTION_ID,\n"
    "  CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS BIGINT) AS CUSTOMER_ID,\n"
    "  o_totalprice AS TX_AMOUNT, epoch_us(o_orderdate) AS us FROM orders)\n"
    f"SELECT TRANSACTION_ID, CUSTOMER_ID,\n  {cust_sql()}\nFROM s",
    views=(),
)
def customer_rolling_hot_key(spark, sf):
    """Rolling spend keyed by order status (about half of all rows per key) on the per-key
    block path with blocks shorter than the look-back."""
    o = fx.load(spark, sf, "orders")
    ts = F.col("o_orderdate").cast("timestamp")
    d = o.select(
        F.col("o_orderkey").alias(TRANSACTION_ID),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
        .cast("bigint").alias(CUSTOMER_ID),
        F.col("o_totalprice").alias(TX_AMOUNT),
        ts.alias("TX_DATETIME"),
        F.unix_micros(ts).alias(US),
    )
    blocks = probe_hot_keys(d, {CUSTOMER_ID: 30 * D}, max_rows=20)[CUSTOMER_ID]
    return customer_spending(d, block_days=blocks).select(TRANSACTION_ID, CUSTOMER_ID, *CUST_COLS)
