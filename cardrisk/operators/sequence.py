"""Ordered per-key sequence features: lags, mean of the last ``k``, spending drift.

Row order inside a key is always (time, TRANSACTION_ID), a total order, so the
result never depends on how the input was partitioned.

Hot keys.  With ``block_us`` a key's rows are split into time blocks and the
window runs per (key, block), so one key is no longer one task.  Lags that
reach back over a block start are filled from the previous blocks' last rows:
each block contributes at most ``K`` rows (its tail) to a small per-(key,
block) table; the ``K`` preceding non-empty blocks are certain to hold the
``K`` rows before any block start, so a short window over that table gives
every block its exact predecessors.  The small table is joined back on
(key, block), the partitioning the big side already has.

A burst can leave more than ``max_rows`` rows in one block, up to all of them in one
microsecond.  The rows of such blocks are laid out by (key, time, id) in even ranges, and a
block's rows in one range are a part of it, numbered in order; blocks within the limit have one part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.operators.rolling import BLEN, BLOCK, D, HOT_KEY_ROWS, Blocks, _floor_div, probe_hot_keys, with_block_length, with_us
from cardrisk.schema import (
    AVG_LAST_TX_AMOUNT,
    CUSTOMER_ID,
    SPENDING_DRIFT,
    TIME_SINCE_LAST_TX,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_AMOUNT_LAST3_MEAN,
    TX_AMOUNT_SHIFTED,
    TX_TIME_SECONDS,
    TX_TIME_SECONDS_SHIFTED,
    US,
)
from cardrisk.session import cut_lineage

# Marker for "no previous transaction" and drift guard.
NO_PREVIOUS_SECONDS = 999999
DRIFT_EPS = 1e-5


PART = "_part_of_block"


def lag_name(col: str, k: int) -> str:
    return f"_lag_{col}_{k}"


def ordered_lags(
    df: DataFrame,
    lags: Mapping[str, int],
    key: str = CUSTOMER_ID,
    order: Sequence[str] = (US, TRANSACTION_ID),
    block_us: Blocks | int | str | None = "auto",
    max_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Add ``lag_name(c, k)`` for ``k = 1..lags[c]``: the value ``k`` rows earlier in the key.

    ``block_us='auto'`` probes for hot keys (see ``rolling.probe_hot_keys``)
    and cuts only those into time blocks; a number cuts every key into blocks
    of that many microseconds, a ``Blocks`` is used as given, None partitions
    by the key alone.  Rows that already carry a block (from the rolling
    features) keep it, so the lags reuse that partitioning.
    """
    df = with_us(df)
    names = {(c, k): lag_name(c, k) for c, n in lags.items() for k in range(1, n + 1)}
    own_block = not (BLOCK in df.columns and BLEN in df.columns)
    if own_block:
        if block_us == "auto":
            block_us = None if df.isStreaming else probe_hot_keys(df, {key: D})[key]
        elif isinstance(block_us, int):
            block_us = Blocks(uniform_us=block_us)
        if block_us is None:
            w = Window.partitionBy(key).orderBy(*order)
            out = df.withColumns({nm: F.lag(c, k).over(w) for (c, k), nm in names.items()})
            return _blank_null_key(out, key, names.values())
        d = with_block_length(df.drop(*[c for c in (BLOCK, BLEN) if c in df.columns]), key, block_us)
        d = d.withColumn(BLOCK, F.when(F.col(BLEN).isNull(), F.lit(0).cast("bigint")).otherwise(_floor_div(F.col(US), F.col(BLEN))))
    else:
        d = df

    depth = max(lags.values())
    d = with_parts(d, key, order, max_rows)
    w = Window.partitionBy(key, BLOCK, PART).orderBy(*order)
    wd = Window.partitionBy(key, BLOCK, PART).orderBy(*[F.col(o).desc() for o in order])
    d = d.withColumns(
        {
            "_pos": F.row_number().over(w),
            "_rpos": F.row_number().over(wd),
            **{"_in" + nm: F.lag(c, k).over(w) for (c, k), nm in names.items()},
        }
    )
    # tails only of split keys: an unsplit key is one block holding all its rows
    rec = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in lags])
    tails = (
        d.filter((F.col("_rpos") <= depth) & F.col(BLEN).isNotNull())
        .groupBy(key, BLOCK, PART)
        .agg(F.collect_list(rec).alias("_tail"))
    )
    wt = Window.partitionBy(key).orderBy(BLOCK, PART).rowsBetween(-depth, -1)
    prev = tails.select(key, BLOCK, PART, F.sort_array(F.flatten(F.collect_list("_tail").over(wt))).alias("_p"))
    prev = prev.select(
        key, BLOCK, PART, F.slice("_p", F.greatest(F.size("_p") - depth + 1, F.lit(1)), depth).alias("_prev")
    )
    out = d.join(prev, [key, BLOCK, PART], "left")
    cols = {}
    for (c, k), nm in names.items():
        back = F.try_element_at(F.col("_prev"), F.least(F.col("_pos") - (k + 1), F.lit(-1)))
        cols[nm] = F.when(F.col("_pos") > k, F.col("_in" + nm)).otherwise(back.getField(c))
    out = out.withColumns(cols).drop("_pos", "_rpos", "_prev", PART, *["_in" + nm for nm in names.values()])
    if own_block:
        out = out.drop(BLOCK, BLEN)
    return _blank_null_key(out, key, names.values())


def with_parts(d: DataFrame, key: str, order: Sequence[str], max_rows: int) -> DataFrame:
    """Add ``PART``: 0, or for the rows of a split key's block of over ``max_rows`` the range that they fall in."""
    if d.isStreaming:
        return d.withColumn(PART, F.lit(0))
    d = cut_lineage(d)
    dense = d.filter(F.col(BLEN).isNotNull()).groupBy(key, BLOCK).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    dense = cut_lineage(dense)
    rows = dense.agg(F.sum("_n")).first()[0]
    if rows is None:
        return d.withColumn(PART, F.lit(0))
    blocks = dense.drop("_n")
    ranges = d.join(blocks, [key, BLOCK], "left_semi").repartitionByRange(max(2, -(-2 * rows // max_rows)), key, *order)
    parts = cut_lineage(ranges.withColumn(PART, F.spark_partition_id()))  # so that a row keeps its range
    return d.join(blocks, [key, BLOCK], "left_anti").withColumn(PART, F.lit(0)).select(*parts.columns).unionByName(parts)


def _blank_null_key(df: DataFrame, key: str, cols) -> DataFrame:
    # a row without a key has no sequence (pandas: NaN)
    return df.withColumns({c: F.when(F.col(key).isNotNull(), F.col(c)) for c in cols})


def mean_of_present(cols: Sequence[Column]) -> Column:
    """Mean of the non-null values, left to right; NULL when all are missing."""
    total = None
    n = None
    for c in cols:
        v = F.coalesce(c, F.lit(0.0))
        p = c.isNotNull().cast("int")
        total = v if total is None else total + v
        n = p if n is None else n + p
    return F.try_divide(total, F.nullif(n, F.lit(0)))


def _sequence_cols(amt: Sequence[Column], prev_t: Column, drift_window: int | None) -> dict[str, Column]:
    cols = {
        TX_TIME_SECONDS_SHIFTED: prev_t.cast("double"),  # NaN-able float, as a shifted column is
        TIME_SINCE_LAST_TX: F.coalesce(F.col(TX_TIME_SECONDS) - prev_t, F.lit(NO_PREVIOUS_SECONDS).cast("bigint")),
        TX_AMOUNT_SHIFTED[0]: amt[0],
        TX_AMOUNT_SHIFTED[1]: amt[1],
        TX_AMOUNT_SHIFTED[2]: amt[2],
        TX_AMOUNT_LAST3_MEAN: F.coalesce(mean_of_present(amt[:3]), F.lit(0.0)),
    }
    if drift_window:
        mean = mean_of_present(amt[:drift_window])
        cols[AVG_LAST_TX_AMOUNT] = mean
        cols[SPENDING_DRIFT] = drift_expr(F.col(TX_AMOUNT), mean)
    return cols


def add_customer_sequence(
    df: DataFrame,
    key: str = CUSTOMER_ID,
    drift_window: int | None = None,
    block_us: Blocks | int | str | None = "auto",
    max_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Time since the previous transaction, last three amounts, their mean, and
    optionally the spending drift against the mean of the last ``drift_window``."""
    depth = max(3, drift_window or 0)
    df = with_us(df)
    has_blocks = BLOCK in df.columns and BLEN in df.columns
    if not has_blocks and block_us == "auto":
        block_us = None if df.isStreaming else probe_hot_keys(df, {key: D})[key]
    if not has_blocks and block_us is None:
        # one step: identical lag windows are computed once by Spark
        w = Window.partitionBy(key).orderBy(US, TRANSACTION_ID)
        keyed = F.col(key).isNotNull()
        amt = [F.when(keyed, F.lag(TX_AMOUNT, k).over(w)) for k in range(1, depth + 1)]
        prev_t = F.when(keyed, F.lag(TX_TIME_SECONDS, 1).over(w))
        return df.withColumns(_sequence_cols(amt, prev_t, drift_window))
    d = ordered_lags(df, {TX_TIME_SECONDS: 1, TX_AMOUNT: depth}, key=key, block_us=block_us, max_rows=max_rows)
    amt = [F.col(lag_name(TX_AMOUNT, k)) for k in range(1, depth + 1)]
    d = d.withColumns(_sequence_cols(amt, F.col(lag_name(TX_TIME_SECONDS, 1)), drift_window))
    return d.drop(*[lag_name(TX_AMOUNT, k) for k in range(1, depth + 1)], lag_name(TX_TIME_SECONDS, 1))


def drift_expr(amount: Column, mean: Column) -> Column:
    """amount / (mean + eps); an infinite ratio becomes 0, a missing one 1."""
    den = mean + F.lit(DRIFT_EPS)
    return (
        F.when(den == 0, F.when(amount == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.coalesce(F.try_divide(amount, den), F.lit(1.0)))
    )


def spending_drift(df: DataFrame, window: int = 5, key: str = CUSTOMER_ID,
                   block_us: Blocks | int | str | None = "auto") -> DataFrame:
    d = ordered_lags(df, {TX_AMOUNT: window}, key=key, block_us=block_us)
    amt = [F.col(lag_name(TX_AMOUNT, k)) for k in range(1, window + 1)]
    d = d.withColumn(AVG_LAST_TX_AMOUNT, mean_of_present(amt))
    d = d.withColumn(SPENDING_DRIFT, drift_expr(F.col(TX_AMOUNT), F.col(AVG_LAST_TX_AMOUNT)))
    return d.drop(*[lag_name(TX_AMOUNT, k) for k in range(1, window + 1)])
