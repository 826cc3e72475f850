"""Streaming results equal the batch operators on in-order input (several micro-batches)."""

import os

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators.aggregates import daily_kpis
from cardrisk.operators.rolling import customer_spending, terminal_risk
from cardrisk.streaming import kpis, rolling_state
from conftest import SF_SMALL
from helpers import same_rows


def _day_files(spark, tmp_dir):
    """The events table split into one parquet folder per day (in time order)."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = os.path.join(tmp_dir, "events_by_day")
    ev.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(src)
    return ev.schema, src


def _stream(spark, tmp_dir):
    schema, src = _day_files(spark, tmp_dir)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).option("recursiveFileLookup", True).parquet(src)
    return fx.tx_from_events(s)


def _run(spark, stream, tmp_dir, name):
    q = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", os.path.join(tmp_dir, name, "ckpt"))
        .format("parquet")
        .option("path", os.path.join(tmp_dir, name, "out"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(os.path.join(tmp_dir, name, "out"))


def test_stream_customer_rolling_equals_batch(spark, tmp_dir):
    got = _run(spark, rolling_state.customer_rolling_stream(_stream(spark, tmp_dir)), tmp_dir, "cust")
    want = customer_spending(fx.tx(spark, SF_SMALL), ties="row").select(*got.columns)
    assert got.count() == want.count()
    assert same_rows(got, want)


def test_stream_terminal_risk_equals_batch(spark, tmp_dir):
    got = _run(spark, rolling_state.terminal_risk_stream(_stream(spark, tmp_dir)), tmp_dir, "term")
    want = terminal_risk(fx.tx(spark, SF_SMALL)).select(*got.columns)
    assert same_rows(got, want)


def test_stream_daily_kpis_equal_batch(spark, tmp_dir):
    out = os.path.join(tmp_dir, "kpis")
    q = kpis.write_batches(kpis.daily_kpi_stream(_stream(spark, tmp_dir)), f"{out}/out", f"{out}/ckpt")
    q.awaitTermination()
    got = kpis.daily_kpis_final(spark, f"{out}/out")
    want = daily_kpis(fx.tx(spark, SF_SMALL)).select(*got.columns)
    assert same_rows(got, want)


def test_history_mode_equals_batch(spark, tmp_dir, monkeypatch):
    """With a snapshot every third batch; what lies before it is not read."""
    from cardrisk.streaming import history_features
    from cardrisk.streaming.history_features import read_history_features, run_history_features

    monkeypatch.setattr(history_features, "SNAPSHOT_EVERY", 3)
    for kind, want in (
        ("customer", customer_spending(fx.tx(spark, SF_SMALL), ties="row")),
        ("terminal", terminal_risk(fx.tx(spark, SF_SMALL))),
    ):
        base = os.path.join(tmp_dir, f"hist_{kind}")
        q = run_history_features(spark, _stream(spark, os.path.join(tmp_dir, kind)), kind, base)
        q.awaitTermination()
        got = read_history_features(spark, base)
        assert got.count() == want.count()
        assert same_rows(got, want.select(*got.columns))
        assert any(d.startswith("snapshot=") for d in os.listdir(os.path.join(base, "history")))
