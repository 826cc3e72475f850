"""Map-state windows, late rows, scoring from kept state, and streams without rows."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators.rolling import customer_spending, terminal_risk
from cardrisk.plans import model as mdl
from cardrisk.plans import scoring
from cardrisk.queries import q_streaming as q
from cardrisk.schema import D, US
from cardrisk.streaming import late, rolling_cells
from cardrisk.streaming.rolling_state import customer_state_fn
from conftest import SF_SMALL
from helpers import same_rows


def _append(stream, base):
    return stream.writeStream.outputMode("append").option("checkpointLocation", f"{base}/ckpt").format("parquet").option("path", f"{base}/out").trigger(availableNow=True).start()


def _hot(spark, folder):
    """Two files of transactions in time order; one customer and terminal has most of them, several in one microsecond."""
    rng = np.random.default_rng(3)
    n = 600
    t = np.sort(rng.integers(0, 50 * D, n) // 1000) * 1000
    t[100:160] = t[100]
    rows = [(i, int(t[i]) + fx.FIXTURE_START_US, 1 if i % 10 else int(i), 1 if i % 10 else None, None if i % 13 == 0 else round(float(rng.random()) * 90, 2), int(rng.random() < 0.3)) for i in range(n)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID long, us long, CUSTOMER_ID long, TERMINAL_ID long, TX_AMOUNT double, TX_FRAUD int").withColumn("TX_DATETIME", F.timestamp_micros("us"))
    return df, folder


@pytest.mark.parametrize("kind", ["customer", "terminal"])
def test_cells_equal_batch_on_a_hot_key(spark, tmp_dir, kind):
    df, _ = _hot(spark, tmp_dir)
    src = os.path.join(tmp_dir, "src")
    make = rolling_cells.customer_cells_stream if kind == "customer" else rolling_cells.terminal_cells_stream
    got = None
    for lo, hi in ((0, 250), (250, 600)):
        df.filter(F.col("TRANSACTION_ID").between(lo, hi - 1)).write.mode("append").parquet(src)
        with rolling_cells.rocksdb_state(spark):
            out = make(spark.readStream.schema(df.schema).parquet(src), width=D // 4)
            _append(out, tmp_dir).awaitTermination()
        got = spark.read.schema(out.schema).parquet(os.path.join(tmp_dir, "out"))
    want = customer_spending(df, ties="row") if kind == "customer" else terminal_risk(df).filter("TERMINAL_ID is not null")
    assert same_rows(got, want.select(*got.columns))


def test_a_group_holds_few_rows():
    """However many rows a key has, at most a few cells' rows are held, and the list of sums has an entry a cell."""
    width, per_cell = 3600 * 10**6, 50
    us = np.arange(40 * 24 * per_cell, dtype="int64") * (width // per_cell)
    store, held = {}, 0
    processor = rolling_cells.CustomerCells((1, 7, 30), 2, width)
    cells = rolling_cells.Cells(lambda c: store[c])
    for cell in np.unique(us // width).tolist():
        at = us[us // width == cell]
        whole, place = rolling_cells.merged(cells.rows(cell), at, at, np.full(len(at), 100), np.ones(len(at), bool))
        cells.put(cell, whole)
        store[cell] = whole
        out = processor.features((1,), cells, cell, np.sort(place))
        held = max(held, sum(len(r[0]) for r in cells.held.values()))
        cells.keep((cell,))
    assert held <= 8 * per_cell and len(cells.cells) == 40 * 24
    assert out["CUSTOMER_ID_NB_TX_30DAY_WINDOW"].iloc[-1] == 30 * 24 * per_cell and out["CUSTOMER_ID_AVG_AMOUNT_7DAY_WINDOW"].iloc[-1] == 1.0


class _Store(dict):
    """Map and value state of one key, with its reads and writes counted."""

    calls = 0

    def getValue(self, k):
        self.calls += 1
        return self[k]

    def updateValue(self, k, v):
        self.calls += 1
        self[k] = v

    removeKey = dict.__delitem__
    get = lambda self: dict.get(self, "sums")
    update = lambda self, v: self.__setitem__("sums", v)


def _processed(us, batches, most):
    """Features of a key's rows in some batches, and its states."""
    processor = rolling_cells.CustomerCells((1, 7, 30), 2, rolling_cells.CELL)
    timers = type("T", (), {"registerTimer": lambda self, t: None, "deleteTimer": lambda self, t: None})()
    processor.handle, processor.cell_rows, processor.sums = timers, _Store(), _Store()
    mark = type("W", (), {"getCurrentWatermarkInMs": lambda self: 0})()
    out, before = [], rolling_cells.MOST
    rolling_cells.MOST = most
    try:
        for part in np.array_split(np.arange(len(us)), batches):
            rows = pd.DataFrame({US: us[part], "TRANSACTION_ID": part, "TX_AMOUNT": 1.0 + part % 7}).sample(frac=1, random_state=1)
            out += list(processor.handleInputRows((1,), iter([rows[:5], rows[5:]]), mark))
    finally:
        rolling_cells.MOST = before
    return pd.concat(out, ignore_index=True), processor


@pytest.mark.parametrize("most", [512, 20, 1])
def test_long_cells_of_few_rows_and_cut_ones(most):
    """A key of a row an hour reads and writes a few cells; cells of many rows are cut down to the width; features stay."""
    us = np.sort(np.random.default_rng(5).integers(0, 70 * 24, 400)) * 3600 * 10**6
    us[200:260] = us[200]  # one hour has more than a cell takes
    found, processor = _processed(us, 3, most)
    assert sorted(found["TRANSACTION_ID"]) == list(range(400))
    found, amount = found.sort_values("TRANSACTION_ID"), 1.0 + np.arange(400) % 7
    for w in (1, 7, 30):
        frames = [np.arange(np.searchsorted(us, us[i] - w * D, side="right"), i + 1) for i in range(400)]
        assert found[f"CUSTOMER_ID_NB_TX_{w}DAY_WINDOW"].tolist() == [len(f) for f in frames]
        assert np.allclose(found[f"CUSTOMER_ID_AVG_AMOUNT_{w}DAY_WINDOW"], [amount[f].mean() for f in frames], rtol=1e-15)
    sizes = {k[0]: len(set(np.asarray(v[0]) // rolling_cells.CELL)) if len(v[0]) > most else 1 for k, v in processor.cell_rows.items()}
    assert set(sizes.values()) == {1}  # a cell over the limit is one width
    if most == 512:
        assert len(sizes) <= 4 and processor.cell_rows.calls <= 24  # cells of an hour: some 340, with three loads each


def test_expired_cells_go(spark):
    cells = rolling_cells.Cells(lambda c: rolling_cells._EMPTY, [0, 5, 90], [1, 1, 1], [7, 7, 7])
    processor = rolling_cells.CustomerCells((1,), 2, D)
    gone = []
    processor.cell_rows = type("M", (), {"removeKey": lambda self, k: gone.append(k)})()
    processor._expire(cells, 7 * D // 1000)
    assert gone == [(0,), (5,)] and cells.cells.tolist() == [90] and cells.total.tolist() == [7]


def test_late_rows_and_retry(spark, tmp_dir):
    day = lambda d, h: f"timestamp'2024-01-{d:02d} {h:02d}:00:00'"

    def rows(*given):
        sql = " union all ".join(f"select {i}L as TRANSACTION_ID, {t} as TX_DATETIME, {c} as CUSTOMER_ID, 10.0D as TX_AMOUNT, 1 as TX_FRAUD" for i, t, c in given)
        return spark.sql(sql)

    first = rows((1, day(1, 5), 1), (2, day(3, 1), 2), (3, "cast(null as timestamp)", 1))
    second = rows((4, day(1, 9), 1), (5, day(2, 9), 2), (6, day(5, 0), 2))
    third = rows((7, day(3, 9), 9), (8, day(4, 9), 9))
    for n, batch in ((0, first), (1, second), (1, second), (2, third)):  # batch 1 is run twice
        late.kpi_batch(spark, batch, tmp_dir, n)
    assert {tuple(r) for r in late.late_rows(spark, tmp_dir).select("batch", "TRANSACTION_ID", "reason").collect()} == {(0, 3, "no time"), (1, 4, "day closed"), (2, 7, "day closed")}
    balance = {r["batch"]: (r["n_read"], r["n_counted"], r["n_late"]) for r in late.progress(spark, tmp_dir).collect()}
    assert balance == {0: (3, 2, 1), 1: (3, 2, 1), 2: (2, 1, 1)}
    kpis = {str(r["TX_DATE"])[-2:]: (r["n_tx"], r["n_customers"]) for r in late.counted_kpis(spark, tmp_dir).collect()}
    assert kpis == {"01": (1, 1), "03": (1, 1), "02": (1, 1), "05": (1, 1), "04": (1, 1)}


def test_streams_of_an_empty_table(spark, tmp_dir):
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    for fn in (q.stream_daily_kpis, q.stream_customer_rolling, q.stream_late_balance):
        assert fn(spark, tmp_dir).filter("false").count() == 0


def test_scoring_reads_recent_days_and_last_rows_only(spark, tmp_dir):
    tx = fx.tx(spark, SF_SMALL)
    old = tx.withColumn("TX_DATETIME", F.col("TX_DATETIME") - F.expr("INTERVAL 200 DAYS")).withColumn(US, F.col(US) - F.lit(200 * D)).withColumn("TRANSACTION_ID", -1 - F.col("TRANSACTION_ID"))
    past = old.unionByName(tx.filter("TX_TIME_DAYS < 20"))
    new = tx.filter("TX_TIME_DAYS >= 20").drop("TX_FRAUD")
    model, thr, _, feats, stats = mdl.train_eval(past, maxIter=4, maxDepth=3)
    t = thr.first()["threshold"]
    scoring.store_batch(spark, tmp_dir, old, 0)
    scoring.store_batch(spark, tmp_dir, past.filter("TRANSACTION_ID >= 0"), 1)
    scoring.store_batch(spark, tmp_dir, past.filter("TRANSACTION_ID >= 0"), 1)  # again: the same state
    whole = mdl.score_new(model, t, new, past, feats, stats)
    kept = scoring.score_batch(spark, tmp_dir, new, 2, model, t, feats, stats)
    assert same_rows(kept, whole)
    import datetime as dt

    recent = scoring.recent_days(spark, tmp_dir, dt.datetime(2024, 1, 21), 2)
    days = {f.split("TX_DATE=")[1][:10] for f in recent.inputFiles()}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TX_DATE" in plan and len(days) > 37
    assert recent.agg(F.min("TX_DATETIME")).first()[0] >= dt.datetime(2023, 12, 15)
    assert scoring.last_rows(spark, tmp_dir, 2).groupBy("CUSTOMER_ID").count().agg(F.max("count")).first()[0] == 5
