"""The feature pipeline as one Spark plan.

Stage one: calendar flags, optional history filter, per-customer rolling
spend, per-terminal delayed risk.  Stage two: deviation from the 1-day mean,
lags and time since the last transaction, mean of the last three amounts,
ratio to the terminal mean, terminal fraud ratio.

Without a hot key all customer-keyed work runs on one partitioning and all
terminal-keyed work on another: the whole pipeline shuffles the rows twice.  Hot
keys take the split path of ``rolling`` and ``sequence``.
``block_days=None`` partitions by the key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.functions.calendar import add_calendar_flags
from cardrisk.operators.filters import filter_min_day
from cardrisk.operators.group_stats import terminal_means
from cardrisk.operators.rolling import HOT_KEY_ROWS, customer_spending, probe_hot_keys, resolve_blocks, terminal_risk, with_us
from cardrisk.operators.sequence import add_customer_sequence
from cardrisk.schema import (
    CUSTOMER_ID,
    NON_FEATURE_COLS,
    TERMINAL_ID,
    RISK_DELAY_DAYS,
    TX_AMOUNT,
    TX_AMOUNT_DEVIATION,
    TX_FRAUD,
    WINDOWS_DAYS,
    D,
    customer_avg_col,
)
from cardrisk.session import cut_lineage


def build_features(
    df: DataFrame,
    stage2: bool = True,
    min_day: int | None = None,
    windows: Sequence[int] = WINDOWS_DAYS,
    delay: int = RISK_DELAY_DAYS,
    ties: str = "peer",
    amount_scale: int | None = 2,
    block_days: int | str | None = "auto",
    drift_window: int | None = None,
    fill_zero: bool = False,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    d = add_calendar_flags(with_us(df))
    d = filter_min_day(d, min_day)

    # time blocks only for a hot key (one probe of both keys, on the input)
    c_look, t_look = max(windows) * D, (delay + max(windows)) * D
    if block_days == "auto":
        probe = probe_hot_keys(d, {CUSTOMER_ID: c_look, TERMINAL_ID: t_look}, hot_key_rows)
        c_block, t_block = probe[CUSTOMER_ID], probe[TERMINAL_ID]
    else:
        c_block, t_block = resolve_blocks(c_look, block_days), resolve_blocks(t_look, block_days)

    # customer-keyed work: one partitioning
    d = customer_spending(d, windows=windows, ties=ties, amount_scale=amount_scale, block_days=c_block)
    if stage2:
        d = d.withColumn(TX_AMOUNT_DEVIATION, F.col(TX_AMOUNT) - F.col(customer_avg_col(min(windows))))
        d = add_customer_sequence(d, key=CUSTOMER_ID, drift_window=drift_window, block_us=c_block, max_rows=hot_key_rows)

    # terminal-keyed work: a second partitioning
    d = terminal_risk(d, delay=delay, windows=windows, block_days=t_block)
    if stage2:
        if t_block is not None:  # hot terminals: aggregate and join back, the features before it computed once
            d = terminal_means(cut_lineage(d), amount_scale=amount_scale)
        else:  # no hot terminal: reuse the risk windows' partitioning
            d = terminal_means(d, amount_scale=amount_scale, method="window")
    if fill_zero:
        d = d.fillna(0)
    return d


def stage1_features(df: DataFrame, min_day: int | None = 30, fill_zero: bool = True, **kw) -> DataFrame:
    """Calendar flags, history filter, customer rolling and terminal risk features."""
    return build_features(df, stage2=False, min_day=min_day, fill_zero=fill_zero, **kw)


def feature_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURE_COLS) -> list[str]:
    """Numeric columns that are model features (ids, time, label, scenario dropped)."""
    drop = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in drop and isinstance(f.dataType, T.NumericType)]


def clean_matrix_value(c) -> "F.Column":
    """+-inf and NaN and NULL become 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin(float("inf"), float("-inf")) | F.isnan(col), F.lit(0.0)).otherwise(F.coalesce(col, F.lit(0)))


def feature_matrix(df: DataFrame, exclude: Sequence[str] = NON_FEATURE_COLS, keep: Sequence[str] = ()) -> DataFrame:
    """Model input: every numeric feature with inf/NaN/null replaced by 0, plus the label.

    ``keep`` lists extra pass-through columns (e.g. TRANSACTION_ID for joins).
    """
    cols = feature_columns(df, exclude)
    sel = [F.col(k) for k in keep]
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            sel.append(clean_matrix_value(c).cast("double").alias(c))
        else:
            sel.append(F.coalesce(F.col(c), F.lit(0).cast(dt)).alias(c))
    if TX_FRAUD in df.columns:
        sel.append(F.coalesce(F.col(TX_FRAUD), F.lit(0)).alias(TX_FRAUD))
    return df.select(*sel)
