"""Stateful streaming window features per key (2.I I2/I3).

``applyInPandasWithState`` keeps, per key, the rows still inside the longest
look-back (30 days for customers, delay + 30 days for terminals) as three
long arrays.  Each micro-batch's rows of the key are appended in (time, id)
order and every new row gets its features from running sums over that
sorted history (numpy ``searchsorted`` on the times, cumulative sums on the
values) -- vectorised per group, no per-row Python loop.  Rows that left the
look-back behind the watermark are evicted (not behind the newest row seen, which one
wrong clock could set); an event-time timeout drops the state of a key that
has been quiet for a whole look-back.

Features are those known at arrival: for input in time order they equal the
batch operators (customer spend with the row-exact tie rule, delayed
terminal risk).  Money is summed in integer cents, so means match the batch
decimal sums exactly; amounts with more than ``amount_scale`` decimals are an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardrisk.session import ship_package
from cardrisk.schema import (
    CUSTOMER_ID,
    RISK_DELAY_DAYS,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_DATETIME,
    TX_FRAUD,
    US,
    WINDOWS_DAYS,
    D,
    customer_avg_col,
    customer_count_col,
    terminal_count_col,
    terminal_risk_col,
)

STATE = T.StructType(
    [
        T.StructField("us", T.ArrayType(T.LongType())),
        T.StructField("id", T.ArrayType(T.LongType())),
        T.StructField("v", T.ArrayType(T.LongType())),  # value: cents or 0/1 flag
        T.StructField("has", T.ArrayType(T.BooleanType())),
    ]
)


def _history(state: GroupState):
    if state.exists:
        us, ids, v, has = state.get
        return np.asarray(us, "int64"), np.asarray(ids, "int64"), np.asarray(v, "int64"), np.asarray(has, bool)
    e = np.zeros(0, "int64")
    return e, e, e, np.zeros(0, bool)


def _merge(state: GroupState, pdfs: Iterator[pd.DataFrame], value_of):
    """History plus new rows, sorted by (time, id); positions of the new rows in that order."""
    us0, id0, v0, h0 = _history(state)
    new = pd.concat(list(pdfs), ignore_index=True)
    v_new, h_new = value_of(new)
    us = np.concatenate([us0, new[US].to_numpy("int64")])
    ids = np.concatenate([id0, new[TRANSACTION_ID].to_numpy("int64")])
    v = np.concatenate([v0, v_new])
    has = np.concatenate([h0, h_new])
    order = np.lexsort((ids, us))
    us, ids, v, has = us[order], ids[order], v[order], has[order]
    pos = np.nonzero(order >= len(us0))[0]
    return pos, us, ids, v, has


def _store(state: GroupState, us, ids, v, has, lookback_us: int):
    # rows to come are not older than the watermark, so their frames reach back to here
    wm = state.getCurrentWatermarkMs()
    keep = us > wm * 1000 - lookback_us
    state.update((us[keep].tolist(), ids[keep].tolist(), v[keep].tolist(), has[keep].tolist()))
    # quiet for a whole look-back in event time -> nothing left to remember
    state.setTimeoutTimestamp(max(int(us.max() // 1000 + lookback_us // 1000 + 1), int(wm) + 1))


def _units(pdf: pd.DataFrame, factor: int):
    """Amounts in integer units of the last allowed digit."""
    a = pdf[TX_AMOUNT]
    has = a.notna().to_numpy()
    x = a.fillna(0).to_numpy("float64")
    units = np.round(x * factor)
    if (units / factor != x).any():
        raise ValueError(f"{TX_AMOUNT} has more digits than 1/{factor}: {x[units / factor != x][0]!r}")
    return units.astype("int64"), has


def _flag(pdf: pd.DataFrame):
    f = pdf[TX_FRAUD]
    has = f.notna().to_numpy()
    return np.where(has, f.fillna(0).to_numpy("float64"), 0).astype("int64"), has


def customer_state_fn(windows: Sequence[int] = WINDOWS_DAYS, amount_scale: int = 2):
    lookback, factor = max(windows) * D, 10**amount_scale

    def fn(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pos, us, ids, v, has = _merge(state, pdfs, lambda pdf: _units(pdf, factor))
        cnt = np.concatenate([[0], np.cumsum(has)])
        tot = np.concatenate([[0], np.cumsum(v)])
        # row-exact: the frame ends at the row itself in (time, id) order
        out = {TRANSACTION_ID: ids[pos], CUSTOMER_ID: np.repeat(key[0], len(pos))}
        for n in windows:
            lo = np.searchsorted(us, us[pos] - n * D, side="right")
            c = cnt[pos + 1] - cnt[lo]
            s = tot[pos + 1] - tot[lo]
            out[customer_count_col(n)] = c.astype("int64")
            with np.errstate(divide="ignore", invalid="ignore"):
                out[customer_avg_col(n)] = np.where(c > 0, (s / float(factor)) / np.maximum(c, 1), np.nan)
        _store(state, us, ids, v, has, lookback)
        yield pd.DataFrame(out)

    schema = T.StructType(
        [T.StructField(TRANSACTION_ID, T.LongType()), T.StructField(CUSTOMER_ID, T.LongType())]
        + [f for n in windows for f in (T.StructField(customer_count_col(n), T.LongType()),
                                         T.StructField(customer_avg_col(n), T.DoubleType()))]
    )
    return fn, schema


def terminal_state_fn(delay: int = RISK_DELAY_DAYS, windows: Sequence[int] = WINDOWS_DAYS):
    lookback = (delay + max(windows)) * D

    def fn(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pos, us, ids, v, has = _merge(state, pdfs, _flag)
        cnt = np.concatenate([[0], np.cumsum(has)])
        tot = np.concatenate([[0], np.cumsum(v)])
        t = us[pos]
        out = {TRANSACTION_ID: ids[pos], TERMINAL_ID: np.repeat(key[0], len(pos))}
        hi = np.searchsorted(us, t - delay * D, side="right")  # rows with time <= t - delay
        for n in windows:
            lo = np.searchsorted(us, t - (delay + n) * D, side="right")
            c = cnt[hi] - cnt[lo]
            f = tot[hi] - tot[lo]
            out[terminal_count_col(n)] = c.astype("int64")
            out[terminal_risk_col(n)] = np.where(c > 0, f / np.maximum(c, 1), 0.0)
        _store(state, us, ids, v, has, lookback)
        yield pd.DataFrame(out)

    schema = T.StructType(
        [T.StructField(TRANSACTION_ID, T.LongType()), T.StructField(TERMINAL_ID, T.LongType())]
        + [f for n in windows for f in (T.StructField(terminal_count_col(n), T.LongType()),
                                         T.StructField(terminal_risk_col(n), T.DoubleType()))]
    )
    return fn, schema


def _apply(stream: DataFrame, key: str, fn, schema, lookback_us: int, value_col: str) -> DataFrame:
    ship_package(stream.sparkSession)  # the state function runs in Python workers
    cols = [key, TRANSACTION_ID, US, value_col]
    d = stream.filter(stream[key].isNotNull()).select(*cols, TX_DATETIME)
    d = d.withWatermark(TX_DATETIME, f"{lookback_us // D} days")
    return d.groupBy(key).applyInPandasWithState(
        fn, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def customer_rolling_stream(stream: DataFrame, windows: Sequence[int] = WINDOWS_DAYS, amount_scale: int = 2) -> DataFrame:
    fn, schema = customer_state_fn(windows, amount_scale)
    return _apply(stream, CUSTOMER_ID, fn, schema, max(windows) * D, TX_AMOUNT)


def terminal_risk_stream(stream: DataFrame, delay: int = RISK_DELAY_DAYS, windows: Sequence[int] = WINDOWS_DAYS) -> DataFrame:
    fn, schema = terminal_state_fn(delay, windows)
    return _apply(stream, TERMINAL_ID, fn, schema, (delay + max(windows)) * D, TX_FRAUD)
