"""Streaming window features from cells of time in keyed map state (2.I I2/I3).

``transformWithStateInPandas`` keeps two states a key: the rows of each time cell (map state, a cell is read and
written by itself) and the running sums of the cells.  A window's count and sum are differences of
prefix sums: whole cells from the sums, and the rows of the two cells that its ends fall in.

A cell starts at a multiple of the width (``CELL``, an hour) and goes on to the next cell's start, a look-back at most.
One that gets over ``MOST`` rows is cut at multiples of the width, so a key of few rows reads and writes a cell or two
a batch, and a hot key's cells are as short as the width.  New rows are taken cell by cell, so a group holds a few cells
and the list of sums, never the key's look-back: that list has some 720 entries for 30 days, however many rows there are.

Cells that lie a look-back behind the watermark are removed as rows come; a timer removes the state of a
key that has been quiet for a look-back.  Features are those known at arrival, as in ``rolling_state``: input
in time order gives the batch operators' results.  Map state needs the RocksDB state store:
streams are made and started under ``rocksdb_state``, or in a session that names that store.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cardrisk.schema import CUSTOMER_ID, RISK_DELAY_DAYS, TERMINAL_ID, TRANSACTION_ID, TX_AMOUNT, TX_DATETIME, TX_FRAUD, US, WINDOWS_DAYS, D
from cardrisk.schema import customer_avg_col, customer_count_col, terminal_count_col, terminal_risk_col
from cardrisk.session import ship_package
from cardrisk.streaming import rolling_state
from cardrisk.streaming.rolling_state import _flag, _units, customer_state_fn, terminal_state_fn

CELL = 3600 * 10**6
#: A cell of more rows is cut, if it is longer than the width.
MOST = 512
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EMPTY = tuple(np.zeros(0, t) for t in ("int64", "int64", "int64", "bool"))


class Cells:
    """Rows of the cells by cell, and the sorted list of cells (first widths) with their counts, sums and last widths that
    have rows; ``load`` reads a cell's rows."""

    def __init__(self, load, cells: Sequence[int] = (), n: Sequence[int] = (), total: Sequence[int] = (), last: Sequence[int] | None = None):
        self.load, self.held = load, {}
        self.cells, self.n, self.total, self.last = (np.asarray(x, "int64") for x in (cells, n, total, cells if last is None else last))

    def rows(self, cell: int):
        if cell not in self.held:
            self.held[cell] = self.load(cell) if self._at(cell) is not None else _EMPTY
        return self.held[cell]

    def _at(self, cell: int) -> int | None:
        i = int(np.searchsorted(self.cells, cell))
        return i if i < len(self.cells) and self.cells[i] == cell else None

    def put(self, cell: int, rows, last: int | None = None) -> None:
        self.held[cell] = rows
        new = (cell, int(rows[3].sum()), int(rows[2].sum()), cell if last is None else last)
        i = self._at(cell)
        if i is None:
            i = int(np.searchsorted(self.cells, cell))
            self.cells, self.n, self.total, self.last = (np.insert(x, i, y) for x, y in zip((self.cells, self.n, self.total, self.last), new))
        else:
            _, self.n[i], self.total[i], self.last[i] = new

    def owners(self, widths: np.ndarray, span: int) -> np.ndarray:
        """The cell that each of the sorted ``widths`` belongs to; where none reaches, one starts there."""
        out = np.empty(len(widths), "int64")
        at = 0
        while at < len(widths):
            first = int(widths[at])
            i = int(np.searchsorted(self.cells, first, side="right"))
            own = int(self.cells[i - 1]) if i and first < self.cells[i - 1] + span else first
            end = min(own + span, int(self.cells[i])) if i < len(self.cells) else own + span
            to = int(np.searchsorted(widths, end))
            out[at:to] = own
            at = to
        return out

    def upto(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Count and sum of all rows with time at most ``x``."""
        own = x // width
        before = np.searchsorted(self.cells, own, side="right")
        # a cell without rows from x on counts whole, like those before it
        part = (before > 0) & (own <= np.concatenate([[-1], self.last])[before])
        before = before - part
        n = np.concatenate([[0], np.cumsum(self.n)])[before]
        total = np.concatenate([[0], np.cumsum(self.total)])[before]
        for i in np.unique(before[part]).tolist():
            us, _, v, has = self.rows(int(self.cells[i]))
            at = np.flatnonzero(part & (before == i))
            end = np.searchsorted(us, x[at], side="right")
            n[at] += np.concatenate([[0], np.cumsum(has)])[end]
            total[at] += np.concatenate([[0], np.cumsum(v)])[end]
        return n, total

    def keep(self, cells) -> None:
        """Forget the rows of all cells but these (their sums stay)."""
        self.held = {c: r for c, r in self.held.items() if c in cells}


def merged(old, us, ids, v, has):
    """Old and new rows of a cell by (time, id), and the new rows' positions."""
    every = [np.concatenate([a, b]) for a, b in zip(old, (us, ids, v, has))]
    order = np.lexsort((every[1], every[0]))
    place = np.empty(len(order), "int64")
    place[order] = np.arange(len(order))
    return tuple(x[order] for x in every), place[len(old[0]) :]


def cuts(widths: np.ndarray, most: int) -> list[tuple[int, int]]:
    """``[from, to)`` of the pieces that a cell's rows (their widths, sorted) are cut into: whole widths, about half of ``most`` rows or one width each."""
    if len(widths) <= most:
        return [(0, len(widths))]
    starts = np.flatnonzero(np.diff(widths, prepend=widths[0] - 1)).tolist()
    ends = [*starts[1:], len(widths)]
    found, at = [], 0
    for lo, hi in zip(starts, ends):
        if lo > at and hi - at > most // 2:
            found.append((at, lo))
            at = lo
    return [*found, (at, len(widths))]


class _Rolling(StatefulProcessor):
    """Shared state handling; ``lookback`` in microseconds, ``spec`` from a subclass."""

    def __init__(self, lookback: int, width: int):
        self.lookback, self.width = lookback, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cell_rows = handle.getMapState("rows", "cell long", "us array<long>, id array<long>, v array<long>, has array<boolean>")
        self.sums = handle.getValueState("sums", "cells array<long>, n array<long>, total array<long>, last array<long>, timer long")

    def _load(self, cell: int):
        us, ids, v, has = self.cell_rows.getValue((cell,))
        return np.asarray(us, "int64"), np.asarray(ids, "int64"), np.asarray(v, "int64"), np.asarray(has, bool)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        v, has = self.values(new)
        us, ids = new[US].to_numpy("int64"), new[TRANSACTION_ID].to_numpy("int64")
        stored = self.sums.get()
        order = np.lexsort((ids, us))
        us, ids, v, has = us[order], ids[order], v[order], has[order]
        cells = Cells(self._load, *(stored[:4] if stored else ()))
        owner = cells.owners(us // self.width, -(-self.lookback // self.width))
        edges = [*np.flatnonzero(np.diff(owner, prepend=owner[0] - 1)).tolist(), len(owner)]
        for lo, hi in zip(edges, edges[1:]):
            whole, place = merged(cells.rows(int(owner[lo])), us[lo:hi], ids[lo:hi], v[lo:hi], has[lo:hi])
            place, widths = np.sort(place), whole[0] // self.width
            for a, b in cuts(widths, MOST):
                cell = int(widths[a]) if a else int(owner[lo])
                rows = tuple(x[a:b] for x in whole)
                cells.put(cell, rows, int(widths[b - 1]))
                self.cell_rows.updateValue((cell,), tuple(x.tolist() for x in rows))
                new = place[(place >= a) & (place < b)] - a
                if len(new):
                    yield self.features(key, cells, cell, new)
                cells.keep((cell,))
        self._expire(cells, timerValues.getCurrentWatermarkInMs())
        last = int((cells.last[-1] + 1) * self.width // 1000) if len(cells.cells) else 0
        timer = max(last + self.lookback // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1)
        if stored:
            self.handle.deleteTimer(stored[4])
        self.handle.registerTimer(timer)
        self.sums.update((cells.cells.tolist(), cells.n.tolist(), cells.total.tolist(), cells.last.tolist(), timer))

    def _expire(self, cells: Cells, watermark_ms: int) -> None:
        # rows to come are not older than the watermark, so their frames reach back to here
        dead = (cells.last + 1) * self.width <= watermark_ms * 1000 - self.lookback
        for cell in cells.cells[dead].tolist():
            self.cell_rows.removeKey((cell,))
        cells.cells, cells.n, cells.total, cells.last = (x[~dead] for x in (cells.cells, cells.n, cells.total, cells.last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.cell_rows.clear()
        self.sums.clear()
        return iter([])

    def close(self) -> None:
        pass


class CustomerCells(_Rolling):
    """Rolling count and mean amount, the frame ending at the row itself in (time, id) order."""

    def __init__(self, windows: Sequence[int], amount_scale: int, width: int):
        super().__init__(max(windows) * D, width)
        self.windows, self.factor = windows, 10**amount_scale

    def values(self, new):
        return _units(new, self.factor)

    def features(self, key, cells: Cells, cell: int, place) -> pd.DataFrame:
        us, ids, v, has = cells.rows(cell)
        i = int(np.searchsorted(cells.cells, cell))
        n = int(cells.n[:i].sum()) + np.cumsum(has)[place]
        total = int(cells.total[:i].sum()) + np.cumsum(v)[place]
        out = {TRANSACTION_ID: ids[place], CUSTOMER_ID: np.repeat(key[0], len(place))}
        for w in self.windows:
            n0, total0 = cells.upto(us[place] - w * D, self.width)
            c, s = n - n0, total - total0
            out[customer_count_col(w)] = c.astype("int64")
            out[customer_avg_col(w)] = np.where(c > 0, (s / float(self.factor)) / np.maximum(c, 1), np.nan)
        return pd.DataFrame(out)


class TerminalCells(_Rolling):
    """Delayed count and fraud share."""

    def __init__(self, delay: int, windows: Sequence[int], width: int):
        super().__init__((delay + max(windows)) * D, width)
        self.delay, self.windows = delay, windows

    def values(self, new):
        return _flag(new)

    def features(self, key, cells: Cells, cell: int, place) -> pd.DataFrame:
        us, ids, _, _ = cells.rows(cell)
        t = us[place] - self.delay * D
        n, total = cells.upto(t, self.width)
        out = {TRANSACTION_ID: ids[place], TERMINAL_ID: np.repeat(key[0], len(place))}
        for w in self.windows:
            n0, total0 = cells.upto(t - w * D, self.width)
            c, f = n - n0, total - total0
            out[terminal_count_col(w)] = c.astype("int64")
            out[terminal_risk_col(w)] = np.where(c > 0, f / np.maximum(c, 1), 0.0)
        return pd.DataFrame(out)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The RocksDB state store for streams started within; the session's own setting stands again after."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _apply(stream: DataFrame, key: str, processor: _Rolling, schema, value: str) -> DataFrame:
    spark = stream.sparkSession
    ship_package(spark)  # the processor runs in Python workers
    if "RocksDB" not in spark.conf.get(PROVIDER):
        raise RuntimeError(f"map state needs the RocksDB state store: run under rocksdb_state(spark), or set {PROVIDER}")
    rows = stream.filter(stream[key].isNotNull()).select(key, TRANSACTION_ID, US, value, TX_DATETIME)
    rows = rows.withWatermark(TX_DATETIME, f"{processor.lookback // D} days")
    with _by_value():
        return rows.groupBy(key).transformWithStateInPandas(processor, schema, "Append", "EventTime")


@contextmanager
def _by_value():
    """Spark also runs the processor in a Python process of the driver, which does not get shipped
    packages: the modules it is made of are pickled with it."""
    from cardrisk import schema

    modules = [schema, rolling_state, sys.modules[__name__]]
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    try:
        yield
    finally:
        for m in modules:
            cloudpickle.unregister_pickle_by_value(m)


def customer_cells_stream(stream: DataFrame, windows: Sequence[int] = WINDOWS_DAYS, amount_scale: int = 2, width: int = CELL) -> DataFrame:
    return _apply(stream, CUSTOMER_ID, CustomerCells(windows, amount_scale, width), customer_state_fn(windows, amount_scale)[1], TX_AMOUNT)


def terminal_cells_stream(stream: DataFrame, delay: int = RISK_DELAY_DAYS, windows: Sequence[int] = WINDOWS_DAYS, width: int = CELL) -> DataFrame:
    return _apply(stream, TERMINAL_ID, TerminalCells(delay, windows, width), terminal_state_fn(delay, windows)[1], TX_FRAUD)
