"""Hand-made edge frames: frame edges, ties, nulls, empty input, constants, bins, order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk import fixtures as fx
from cardrisk.operators import aggregates as agg
from cardrisk.operators.rolling import customer_spending, terminal_risk
from cardrisk.operators.sequence import add_customer_sequence, spending_drift
from cardrisk.plans.features import build_features
from conftest import SF_MID
from helpers import same_rows

SCHEMA = T.StructType(
    [
        T.StructField("TRANSACTION_ID", T.LongType()),
        T.StructField("TX_DATETIME", T.TimestampType()),
        T.StructField("CUSTOMER_ID", T.LongType()),
        T.StructField("TERMINAL_ID", T.LongType()),
        T.StructField("TX_AMOUNT", T.DoubleType()),
        T.StructField("TX_TIME_SECONDS", T.LongType()),
        T.StructField("TX_FRAUD", T.IntegerType()),
        T.StructField("TX_FRAUD_SCENARIO", T.IntegerType()),
    ]
)


def frame(spark, rows):
    out = []
    for i, (ts, cust, term, amt, fraud) in enumerate(rows, start=1):
        secs = int((ts - dt.datetime(2020, 1, 1)).total_seconds())
        out.append((i, ts, cust, term, amt, secs, fraud, 0))
    return spark.createDataFrame(out, SCHEMA)


def by_id(df, col):
    return [r[col] for r in df.orderBy("TRANSACTION_ID").collect()]


@pytest.fixture()
def ties(spark):
    d = dt.datetime
    return frame(
        spark,
        [
            (d(2020, 1, 1), 1, 7, 1.0, 1),
            (d(2020, 1, 2), 1, 7, 2.0, 0),
            (d(2020, 1, 2), 1, 7, 4.0, 1),
            (d(2020, 1, 2, 0, 0, 1), 1, 7, None, 0),
            (d(2020, 1, 9), 1, 7, 16.0, 1),
        ],
    )


@pytest.mark.parametrize("strategy", ["prefix", "sliding"])
@pytest.mark.parametrize("block_days", [None, 1, 3])
def test_tie_rules(ties, strategy, block_days):
    row = customer_spending(ties, windows=(1,), ties="row", strategy=strategy, block_days=block_days)
    assert by_id(row, "CUSTOMER_ID_NB_TX_1DAY_WINDOW") == [1, 1, 2, 2, 1]
    assert [round(c * m) for c, m in zip(by_id(row, "CUSTOMER_ID_NB_TX_1DAY_WINDOW"), by_id(row, "CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"))] == [1, 2, 6, 6, 16]
    peer = customer_spending(ties, windows=(1,), ties="peer", strategy=strategy, block_days=block_days)
    assert by_id(peer, "CUSTOMER_ID_NB_TX_1DAY_WINDOW") == [1, 2, 2, 2, 1]


@pytest.mark.parametrize("block_days", [None, 2])
def test_delayed_terminal_frame(ties, block_days):
    r = terminal_risk(ties, delay=7, windows=(1,), block_days=block_days)
    assert by_id(r, "TERMINAL_ID_NB_TX_1DAY_WINDOW") == [0, 0, 0, 0, 2]
    assert by_id(r, "TERMINAL_ID_RISK_1DAY_WINDOW") == [0.0, 0.0, 0.0, 0.0, 0.5]


def test_left_open_boundary(spark):
    t = dt.datetime(2020, 3, 1)
    f = frame(spark, [(t, 1, 1, 1.0, 0), (t + dt.timedelta(days=1) - dt.timedelta(microseconds=1), 1, 1, 2.0, 0),
                      (t + dt.timedelta(days=1), 1, 1, 4.0, 0)])
    r = customer_spending(f, windows=(1,))
    assert by_id(r, "CUSTOMER_ID_NB_TX_1DAY_WINDOW") == [1, 2, 2]


def test_drift(spark):
    f = frame(spark, [(dt.datetime(2020, 1, i), 1, 1, float(i), 0) for i in range(1, 8)])
    r = spending_drift(f, window=5)
    assert by_id(r, "AVG_LAST_TX_AMOUNT") == [None, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0]
    assert by_id(r, "SPENDING_DRIFT")[0] == 1.0


def test_null_key(spark):
    d = dt.datetime
    f = frame(spark, [(d(2020, 1, 1), 1, 1, 1.0, 0), (d(2020, 1, 2), None, 1, 2.0, 0), (d(2020, 1, 3), 1, 1, 3.0, 0)])
    assert customer_spending(f).count() == 2  # grouping drops the null key
    s = add_customer_sequence(f)
    assert s.count() == 3
    assert s.filter("CUSTOMER_ID IS NULL").first()["TX_AMOUNT_SHIFTED_1"] is None


def test_single_row_keys(spark):
    d = dt.datetime
    f = frame(spark, [(d(2020, 1, 1), 1, 1, 1.0, 0), (d(2020, 1, 2), 2, 1, 2.0, 0)])
    s = add_customer_sequence(f)
    assert by_id(s, "TIME_SINCE_LAST_TX") == [999999, 999999]
    assert by_id(s, "TX_AMOUNT_LAST3_MEAN") == [0.0, 0.0]


def test_empty_input(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert agg.daily_kpis(e).count() == 0
    s = agg.fraud_summary(e).first()
    assert (s["n_tx"], s["n_fraud"], s["fraud_pct"]) == (0, 0, 0.0)
    assert [r["n"] for r in agg.class_counts(e).orderBy("TX_FRAUD").collect()] == [0, 0]
    assert agg.fraud_by_hour_filled(e).count() == 24
    assert build_features(e).count() == 0


def test_constant_column_corr(spark):
    d = dt.datetime
    f = frame(spark, [(d(2020, 1, i), 1, 1, 5.0, i % 2) for i in range(1, 6)])
    r = {x["feature"]: x["corr"] for x in agg.corr_with_label(f, columns=["TX_AMOUNT", "TX_TIME_SECONDS"]).collect()}
    assert r["TX_AMOUNT"] is None
    assert r["TX_TIME_SECONDS"] is not None


def test_amount_bins(spark):
    f = frame(spark, [(dt.datetime(2020, 1, 1), 1, 1, a, 0) for a in (0.0, 1.0, 5.0, 10.0)])
    bins = sorted(r["bin"] for r in agg.fraud_rate_by_amount_bin(f, bins=10).collect())
    assert bins == [1, 5, 10]
    n = {r["bin"]: r["n"] for r in agg.fraud_rate_by_amount_bin(f, bins=10).collect()}
    assert n[1] == 2


def test_order_independence(spark):
    tx = fx.tx(spark, SF_MID)
    shuffled = tx.orderBy(F.rand(7)).repartition(13)
    a = build_features(tx, stage2=True)
    b = build_features(shuffled, stage2=True)
    assert same_rows(a, b)


def test_row_count_kept(spark):
    tx = fx.tx(spark, SF_MID)
    assert build_features(tx, stage2=True).count() == tx.count()


def test_properties(spark):
    f = build_features(fx.tx(spark, SF_MID), stage2=False)
    bad = f.filter(
        (F.col("TERMINAL_ID_RISK_30DAY_WINDOW") < 0) | (F.col("TERMINAL_ID_RISK_30DAY_WINDOW") > 1)
        | (F.col("CUSTOMER_ID_NB_TX_1DAY_WINDOW") > F.col("CUSTOMER_ID_NB_TX_7DAY_WINDOW"))
        | (F.col("CUSTOMER_ID_NB_TX_7DAY_WINDOW") > F.col("CUSTOMER_ID_NB_TX_30DAY_WINDOW"))
    )
    assert bad.count() == 0


def test_daily_delta_uses_calendar_day(spark):
    d = dt.datetime
    f = frame(spark, [(d(2020, 1, 1), 1, 1, 1.0, 1), (d(2020, 1, 2), 1, 1, 1.0, 1), (d(2020, 1, 2, 5), 2, 1, 1.0, 1),
                      (d(2020, 1, 4), 1, 1, 1.0, 1)])
    r = {x["TX_DATE"].day: x["fraud_delta"] for x in agg.daily_kpis(f).collect()}
    assert r == {1: 1, 2: 1, 4: 1}


def test_terminal_means_window_equals_join(spark):
    from cardrisk.operators.group_stats import terminal_means

    t = fx.tx(spark, SF_MID)
    assert same_rows(terminal_means(t, method="window"), terminal_means(t, method="join"))
