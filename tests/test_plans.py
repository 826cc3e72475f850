"""Physical plan checks: shuffles, pushdown, pruning, no Python in the batch path."""

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators import filters as flt
from cardrisk.operators.aggregates import daily_kpis
from cardrisk.plans.features import build_features
from conftest import SF_MID


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_pipeline_shuffles_rows_twice(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(build_features(fx.tx(spark, SF_MID), stage2=False, block_days=None))
        assert p.count("Exchange hashpartitioning") == 2
        p2 = plan(build_features(fx.tx(spark, SF_MID), stage2=True, block_days=None))
        # two row shuffles; the terminal means add only a shuffle of partial aggregates
        assert p2.count("Exchange hashpartitioning(CUSTOMER_ID") == 1
        assert p2.count("Exchange hashpartitioning(TERMINAL_ID") <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_and_no_cartesian(spark):
    p = plan(build_features(fx.tx(spark, SF_MID), stage2=True, block_days="always"))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p


def test_point_lookup_pushed_down(spark):
    p = plan(flt.tx_lookup(fx.tx(spark, SF_MID), 4242))
    assert "PushedFilters: [IsNotNull(event_id), EqualTo(event_id,4242)]" in p


def test_column_pruning(spark):
    p = plan(daily_kpis(fx.tx(spark, SF_MID)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_date_range_pushed_down(spark):
    p = plan(flt.filter_date_range(fx.tx(spark, SF_MID), "2024-01-10", "2024-01-20"))
    assert "GreaterThanOrEqual(ts" in p and "LessThan" in p


def test_day_list_search_pushed_down(spark):
    d = flt.search_transactions(fx.tx(spark, SF_MID), days=["2024-01-10", "2024-01-12"])
    p = plan(d)
    assert "Or(And(GreaterThanOrEqual(ts" in p
    want = fx.tx(spark, SF_MID).filter(F.to_date("TX_DATETIME").isin("2024-01-10", "2024-01-12")).count()
    assert d.count() == want


def test_plain_pipeline_scans_once(spark):
    from cardrisk.plans.features import build_features

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(build_features(fx.tx(spark, SF_MID), stage2=True, block_days=None))
        assert p.count("FileScan parquet") == 1
        assert p.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
