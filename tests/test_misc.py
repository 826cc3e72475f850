"""Unit checks for helpers without a SQL query: parsing, pivots, sinks, streaming scoring, history watch."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.functions.calendar import parse_timestamp
from cardrisk.functions.scalar import null_to
from cardrisk.operators import aggregates as agg
from cardrisk.operators import filters as flt
from cardrisk.operators.detail import history_card
from cardrisk.operators.topk import chronological
from cardrisk.plans import model as mdl
from cardrisk.plans.features import build_features
from cardrisk.sources import readers, sinks
from cardrisk.streaming import kpis
from cardrisk.streaming.score import score_stream, watch_metric_history
from conftest import SF_SMALL


def test_parse_strict_and_lenient(spark):
    d = spark.createDataFrame([("2024-01-02 03:04:05",), ("not a time",)], "s string")
    lenient = d.select(parse_timestamp("s", lenient=True).alias("t"))
    assert flt.drop_null_timestamps(lenient, "t").count() == 1
    good = spark.createDataFrame([("2024-01-02 03:04:05",)], "s string")
    assert good.select(parse_timestamp("s").alias("t")).first()["t"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    with pytest.raises(Exception):
        d.select(parse_timestamp("s").alias("t")).collect()  # strict parse raises


def test_pivot_matches_long_form(spark):
    tx = fx.tx(spark, SF_SMALL)
    cust = tx.first()["CUSTOMER_ID"]
    wide = agg.customer_weekday_hour_pivot(tx, cust)
    assert wide.count() == 7 and len(wide.columns) == 25
    long = agg.customer_weekday_hour(tx, cust)
    total = long.agg(F.sum("n_tx")).first()[0]
    assert total == tx.filter(F.col("CUSTOMER_ID") == cust).count()
    assert wide.select(sum(F.col(str(h)) for h in range(24)).alias("s")).agg(F.sum("s")).first()[0] == total


def test_chronological_and_schema(spark):
    tx = fx.tx(spark, SF_SMALL)
    first = chronological(tx).first()
    assert first["TX_DATETIME"] == tx.agg(F.min("TX_DATETIME")).first()[0]
    assert "TX_AMOUNT" in tx.columns  # schema listing


def test_null_to_and_optional_score(spark):
    f = build_features(fx.tx(spark, SF_SMALL), stage2=False).withColumn("MODEL_SCORE", F.lit(0.5))
    card = history_card(f)
    assert "MODEL_SCORE" in card.columns and card.count() == 3 * f.count()
    d = spark.createDataFrame([(None,), (2.0,)], "x double")
    assert sorted(r[0] for r in d.select(null_to("x", 0.0)).collect()) == [0.0, 2.0]


def test_prediction_and_export_sinks(spark, tmp_dir):
    tx = fx.tx(spark, SF_SMALL)
    preds = tx.select("TRANSACTION_ID", F.col("TX_FRAUD").alias("PREDICTED_FRAUD"))
    sinks.write_predictions(preds, os.path.join(tmp_dir, "pred"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "pred"))
    assert back.count() == tx.count() and back.columns == ["TRANSACTION_ID", "PREDICTED_FRAUD"]
    found = flt.search_transactions(tx, amount_min=10, status="fraud")
    sinks.write_table(flt.search_view(found), os.path.join(tmp_dir, "export"), "csv")
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "export")).count() == found.count()


def test_cached_source(spark):
    d = readers.cached(fx.tx(spark, SF_SMALL))
    assert d.count() == 1000 and d.storageLevel.useDisk
    d.unpersist()


def test_stream_scoring(spark, tmp_dir):
    """Streamed feature rows get the scores that the batch gets."""
    tx = fx.tx(spark, SF_SMALL)
    model, thr, _, feats, _ = mdl.train_eval(tx, maxIter=3, maxDepth=2)
    threshold = thr.first()["threshold"]
    mat = mdl.matrix(tx)[0].select("TRANSACTION_ID", *feats)
    mat.repartition(3).write.parquet(f"{tmp_dir}/feat")
    stream = spark.readStream.schema(mat.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/feat")
    q = (score_stream(stream, model, threshold, feats).writeStream.format("parquet").option("path", f"{tmp_dir}/scores")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    want = mdl.score(model, mat).select("TRANSACTION_ID", "SCORE", (F.col("SCORE") >= threshold).cast("int").alias("PREDICTED_FRAUD"))
    got = spark.read.parquet(f"{tmp_dir}/scores")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 1000


def test_metric_history_watch(spark, tmp_dir):
    """The newest row is the last that arrived, also after midnight."""
    src = os.path.join(tmp_dir, "hist_in")
    os.makedirs(src)
    with open(os.path.join(src, "m1.csv"), "w") as f:
        f.write("Zeit,Precision,Recall,F1_Score,ROC_AUC,PR_AUC\n23:59:55,0.95,0.77,0.86,0.99,0.87\n00:00:05,0.95,0.77,0.70,0.99,0.87\n")
    q = watch_metric_history(spark, src, f"{tmp_dir}/hist", f"{tmp_dir}/alerts", f"{tmp_dir}/ck")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/hist").count() == 2
    alert = spark.read.parquet(f"{tmp_dir}/alerts").first()
    assert (alert["Zeit"], alert["alert"]) == ("00:00:05", "critical")


def test_session_keeps_the_callers_sizes(spark):
    from cardrisk.session import get_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert get_session().conf.get("spark.sql.shuffle.partitions") == "37"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_forwarded_flag_as_number_or_boolean(spark):
    from cardrisk.operators.filters import second_level_queue

    tx = fx.tx(spark, SF_SMALL)
    flag = F.col("TRANSACTION_ID") % 10 == 0
    as_number = second_level_queue(tx.withColumn("WEITERGELEITET_AN_SUPPORT", flag.cast("int")))
    as_boolean = second_level_queue(tx.withColumn("WEITERGELEITET_AN_SUPPORT", flag))
    ids = [r["TRANSACTION_ID"] for r in as_number.collect()]
    assert ids == [r["TRANSACTION_ID"] for r in as_boolean.collect()] and len(ids) == 10 and all(i % 10 == 0 for i in ids)


def test_far_future_row_does_not_wipe_a_state():
    """History goes by the watermark: one wrong clock leaves it alone."""
    import pandas as pd

    from cardrisk.streaming.rolling_state import customer_state_fn

    class State:
        exists = hasTimedOut = False

        def update(self, value):
            self.exists, self.get = True, value

        def getCurrentWatermarkMs(self):
            return 0

        def setTimeoutTimestamp(self, t):
            pass

    fn, _ = customer_state_fn()
    state, day = State(), 86400 * 10**6

    def feed(i, us):
        return next(fn((1,), iter([pd.DataFrame({"TRANSACTION_ID": [i], "us": [us], "TX_AMOUNT": [1.25]})]), state))["CUSTOMER_ID_NB_TX_7DAY_WINDOW"][0]

    assert [feed(1, day), feed(2, 2 * day), feed(3, 9000 * day), feed(4, 3 * day)] == [1, 2, 1, 3]
    with pytest.raises(ValueError, match="more digits"):
        next(fn((1,), iter([pd.DataFrame({"TRANSACTION_ID": [9], "us": [day], "TX_AMOUNT": [0.004]})]), state))


def test_passing_scratch_and_dropped_shuffles(spark, monkeypatch):
    """What a thread names within goes at the end, an error or not, and nothing else; the setting stands again after the last use."""
    from multiprocessing.pool import ThreadPool

    from cardrisk.session import SHUFFLE_CLEANUP, passing_scratch, scratch_path, shuffles_dropped, written
    from helpers import scratch_of_its_own

    left, d, clean_up = scratch_of_its_own(spark, monkeypatch), spark.range(5), spark.conf.get(SHUFFLE_CLEANUP)
    kept = scratch_path(spark, "kept-one")
    with pytest.raises(ValueError):
        with shuffles_dropped(spark), passing_scratch(spark):
            written(d, "outer")
            with ThreadPool(1) as pool:
                pool.apply(lambda: written(d, "other-thread"))
            with shuffles_dropped(spark), passing_scratch(spark):
                written(written(d, "inner"), "kept", kept)
                assert left() == ["inner", "kept-one", "other-thread", "outer", "passing", "passing"]
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true" and left() == ["kept-one", "other-thread", "outer", "passing"]
            raise ValueError
    assert left() == ["kept-one", "other-thread"] and spark.read.parquet(kept).count() == 5
    assert spark.conf.get(SHUFFLE_CLEANUP) == clean_up


def test_checkpoint_and_scale_conf(spark):
    from cardrisk.session import checkpoint_base, cut_lineage, scale_conf

    assert checkpoint_base(spark)
    d = cut_lineage(fx.tx(spark, SF_SMALL).select("TRANSACTION_ID"))
    assert d.count() == 1000
    c = scale_conf(100 * 1024**4)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"
