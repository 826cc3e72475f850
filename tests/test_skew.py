"""The hot-key path (cells of the time axis, block tails for lags) is exact and bounded."""

import pytest
from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators.rolling import BLEN, US, D, customer_spending, point_cells, probe_hot_keys, terminal_risk, with_block_length, with_us
from cardrisk.operators.sequence import add_customer_sequence, ordered_lags
from cardrisk.plans.features import build_features
from conftest import SF_MID
from helpers import same_rows


@pytest.mark.parametrize("block_days", [2, 10, 45])
def test_blocked_rolling_equals_plain(spark, block_days):
    t = fx.tx_orders(spark, SF_MID)
    assert same_rows(customer_spending(t, block_days=None), customer_spending(t, block_days=block_days))
    assert same_rows(terminal_risk(t, block_days=None), terminal_risk(t, block_days=block_days))


@pytest.mark.parametrize("block_days", [1, 30, 400])
def test_blocked_lags_equal_plain(spark, block_days):
    t = fx.tx_orders(spark, SF_MID)
    a = ordered_lags(t, {"TX_AMOUNT": 5}, block_us=None)
    b = ordered_lags(t, {"TX_AMOUNT": 5}, block_us=block_days * D)
    assert same_rows(a, b)


def test_pipeline_hot_path_equals_plain(spark):
    t = fx.tx(spark, SF_MID)
    assert same_rows(build_features(t, block_days=None), build_features(t, block_days=3))
    assert same_rows(build_features(t, block_days=None), build_features(t, block_days="always"))


def test_probe_finds_hot_keys(spark):
    t = fx.tx(spark, SF_MID)
    none = probe_hot_keys(t, {"CUSTOMER_ID": 30 * D, "TERMINAL_ID": 37 * D})
    assert none == {"CUSTOMER_ID": None, "TERMINAL_ID": None}
    hot = probe_hot_keys(t, {"CUSTOMER_ID": 30 * D}, max_rows=50)["CUSTOMER_ID"]
    n_hot = t.groupBy("CUSTOMER_ID").count().filter("count > 50").count()
    assert hot is not None and hot.uniform_us is None and hot.hot.count() == n_hot
    assert hot.hot.filter("_len < 1").count() == 0


@pytest.mark.parametrize("hot_rows", [20, 50])
def test_per_key_hot_blocks_equal_plain(spark, hot_rows):
    """Only hot keys are split; results equal the unsplit plan."""
    t = fx.tx(spark, SF_MID)
    assert same_rows(build_features(t, block_days=None), build_features(t, hot_key_rows=hot_rows))
    o = fx.tx_orders(spark, SF_MID)
    blocks = probe_hot_keys(o, {"CUSTOMER_ID": 30 * D}, max_rows=5)["CUSTOMER_ID"]
    assert blocks is not None
    assert same_rows(customer_spending(o, block_days=None, ties="row"), customer_spending(o, block_days=blocks, ties="row"))
    assert same_rows(ordered_lags(o, {"TX_AMOUNT": 5}, block_us=None), ordered_lags(o, {"TX_AMOUNT": 5}, block_us=blocks))


def one_key(spark, n=20_000, days=74, burst=False):
    """One customer and terminal with ``n`` rows over ``days``; ``burst`` puts half of them into one second."""
    step = days * D // n
    at = F.when((F.col("id") % 2 == 0) & F.lit(burst), F.lit(40 * D) + F.col("id") * 50).otherwise(F.col("id") * step)
    return spark.range(n).select(
        F.col("id").alias("TRANSACTION_ID"), F.lit(1).cast("long").alias("CUSTOMER_ID"), F.lit(2).cast("long").alias("TERMINAL_ID"),
        F.timestamp_micros(at).alias("TX_DATETIME"), ((F.col("id") % 997) / 100).alias("TX_AMOUNT"), (F.col("id") % 13 == 0).cast("int").alias("TX_FRAUD"),
    )


@pytest.mark.parametrize("limit", [10_000, 1_000, 100])
@pytest.mark.parametrize("burst", [False, True])
def test_cells_hold_the_limit_below_the_look_back(spark, limit, burst):
    t = with_us(one_key(spark, burst=burst))
    blocks = probe_hot_keys(t, {"TERMINAL_ID": 37 * D}, max_rows=limit)["TERMINAL_ID"]
    points = with_block_length(t, "TERMINAL_ID", blocks).groupBy("TERMINAL_ID", US, BLEN).agg(F.sum("TX_FRAUD").alias("y"))
    edges = [7 * D, 8 * D, 14 * D, 37 * D]
    cells = point_cells(points, "TERMINAL_ID", ["y"], edges, limit).groupBy("TERMINAL_ID", "_cell").count()
    assert cells.agg(F.max("count")).first()[0] <= limit
    # a row is copied once for each edge, whatever the look-back
    assert cells.agg(F.sum("count")).first()[0] == points.count() * (1 + len(edges))


@pytest.mark.parametrize("burst", [False, True])
def test_one_hot_key_equals_plain(spark, burst):
    t = one_key(spark, 4_000, burst=burst)
    blocks = probe_hot_keys(with_us(t), {"CUSTOMER_ID": 30 * D, "TERMINAL_ID": 37 * D}, max_rows=100)
    assert same_rows(customer_spending(t, block_days=None), customer_spending(t, block_days=blocks["CUSTOMER_ID"]))
    assert same_rows(terminal_risk(t, block_days=None), terminal_risk(t, block_days=blocks["TERMINAL_ID"]))


def test_amounts_are_never_rounded(spark):
    """More digits than the scale is an error; without a scale sums are as exact as a frame's own."""
    t = one_key(spark, 4, days=1)
    small = t.withColumn("TX_AMOUNT", F.lit(0.004))
    with pytest.raises(Exception, match="more than 2 decimal digits"):
        customer_spending(small).collect()
    got = {r["CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"] for r in customer_spending(small, amount_scale=3).collect()}
    assert got == {0.004}
    wide = spark.range(3).select(
        F.col("id").alias("TRANSACTION_ID"), F.lit(1).cast("long").alias("CUSTOMER_ID"), F.lit(2).cast("long").alias("TERMINAL_ID"),
        F.timestamp_micros(F.col("id") * 2 * D).alias("TX_DATETIME"), F.element_at(F.array(F.lit(1e17), F.lit(1.25), F.lit(1.25)), F.col("id").cast("int") + 1).alias("TX_AMOUNT"),
        F.lit(0).alias("TX_FRAUD"), F.lit(0).cast("long").alias("TX_TIME_SECONDS"), F.lit(0).cast("long").alias("TX_TIME_DAYS"),
    )
    means = build_features(wide, amount_scale=None).orderBy("TRANSACTION_ID").select("CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW").collect()
    assert [r[0] for r in means] == [1e17, 1.25, 1.25]


def test_sequence_hot_path(spark):
    t = fx.tx_orders(spark, SF_MID).withColumn("TX_TIME_SECONDS", (F.col("us") / 1000000).cast("bigint"))
    a = add_customer_sequence(t, drift_window=5)
    b = add_customer_sequence(t, drift_window=5, block_us=7 * D)
    assert same_rows(a, b)


@pytest.mark.parametrize("instant", [False, True])
def test_bursts_are_cut_again_for_lags(spark, instant):
    """Half a key's rows within 10 ms, or in one microsecond: no part holds many more rows than the limit, and lags are exact."""
    from cardrisk.operators.rolling import BLOCK, Blocks, _floor_div
    from cardrisk.operators.sequence import PART, with_parts

    n, limit = 20_000, 1_000
    at = F.when(F.col("id") % 2 == 0, F.lit(40 * D) + (F.lit(0) if instant else F.floor(F.col("id") / 2))).otherwise(F.col("id") * (74 * D // n))
    t = with_us(spark.range(n).select(
        F.col("id").alias("TRANSACTION_ID"), F.lit(1).cast("long").alias("CUSTOMER_ID"), F.timestamp_micros(at.cast("long")).alias("TX_DATETIME"), (F.col("id") % 997).cast("double").alias("TX_AMOUNT"),
    ))
    d = with_block_length(t, "CUSTOMER_ID", Blocks(uniform_us=2 * D)).withColumn(BLOCK, _floor_div(F.col(US), F.col(BLEN)))
    assert d.groupBy(BLOCK).count().agg(F.max("count")).first()[0] > 10 * limit
    parts = with_parts(d, "CUSTOMER_ID", (US, "TRANSACTION_ID"), limit)
    assert parts.count() == n and parts.groupBy(BLOCK, PART).count().agg(F.max("count")).first()[0] <= 2 * limit
    whole = ordered_lags(t, {"TX_AMOUNT": 4}, block_us=None)
    assert same_rows(ordered_lags(t, {"TX_AMOUNT": 4}, block_us=2 * D, max_rows=limit), whole)
