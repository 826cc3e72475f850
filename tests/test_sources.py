"""Sources and sinks on own small files (dirty CSV, JSON array, missing path, append)."""

import os

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.functions.scalar import f1_alert
from cardrisk.operators.aggregates import centroid
from cardrisk.operators.enrich import strip_index_column
from cardrisk.sources import readers, sinks
from conftest import SF_SMALL
from helpers import same_rows


def test_dirty_history_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "f1.csv")
    with open(p, "w") as f:
        f.write("Zeit,Wert\n10:00:00,0.91\n10:00:10,0.92\n\nZeit,Wert\n10:00:20,0.93\n")
    d = readers.read_single_metric_history(spark, p)
    assert sorted(r["Wert"] for r in d.collect()) == [0.91, 0.92, 0.93]


def test_missing_history_is_empty(spark, tmp_dir):
    d = readers.read_metric_history(spark, os.path.join(tmp_dir, "nope.csv"))
    assert d.count() == 0 and "F1_Score" in d.columns


def test_coords_json_and_centroid(spark, tmp_dir):
    p = os.path.join(tmp_dir, "coords.txt")
    with open(p, "w") as f:
        f.write('[{"latitude": 47.0, "longitude": 8.0}, {"latitude": 46.0, "longitude": 7.0}]')
    d = readers.read_coords(spark, p)
    assert d.count() == 2
    c = centroid(d).first()
    assert (c["latitude"], c["longitude"]) == (46.5, 7.5)


def test_csv_roundtrip_with_index_column(spark, tmp_dir):
    tx = fx.tx(spark, SF_SMALL).drop("us")
    p = os.path.join(tmp_dir, "tx_csv")
    sinks.write_table(tx.withColumn("Unnamed: 0", F.monotonically_increasing_id()), p, "csv")
    back = readers.read_transactions_csv(spark, p)
    assert "Unnamed: 0" not in back.columns
    assert same_rows(back, tx.select(*back.columns))


def test_source_dispatch(spark):
    tx = fx.tx(spark, SF_SMALL)
    assert readers.as_dataframe(spark, tx) is tx
    assert readers.as_dataframe(spark, f"{SF_SMALL}/events.parquet").count() == 1000


def test_append_history_and_alert(spark, tmp_dir):
    p = os.path.join(tmp_dir, "hist")
    rows = spark.createDataFrame([("10:00:00", 0.95331, 0.7, 0.8, 0.99, 0.86)], readers.METRIC_HISTORY)
    sinks.append_history(rows, p, ["Precision", "F1_Score"], base={"Precision": 0.9533})
    sinks.append_history(rows, p, ["Precision", "F1_Score"])
    back = readers.read_metric_history(spark, p)
    assert back.count() == 2
    assert {r["Precision"] for r in back.collect()} == {0.9533}
    assert back.select(f1_alert("F1_Score").alias("a")).first()["a"] == "watch"


def test_daily_partitions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "daily")
    sinks.write_daily_partitions(fx.tx(spark, SF_SMALL), p)
    days = [x for x in os.listdir(p) if x.startswith("TX_DATE=")]
    assert len(days) == 30


def test_strip_index(spark):
    d = spark.createDataFrame([(1, 2)], "`Unnamed: 0` int, a int")
    assert strip_index_column(d).columns == ["a"]


def test_daily_partition_pruning(spark, tmp_dir):
    p = os.path.join(tmp_dir, "daily_prune")
    sinks.write_daily_partitions(fx.tx(spark, SF_SMALL), p)
    d = readers.read_daily_partitions(spark, p, "2024-01-10", "2024-01-12")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TX_DATE" in plan
    want = fx.tx(spark, SF_SMALL).filter(F.to_date("TX_DATETIME").between("2024-01-10", "2024-01-12")).count()
    assert d.count() == want


def test_csv_header_order_by_name(spark, tmp_dir):
    """Files with other column orders are an error, or mapped by name; never read by position."""
    import pytest

    from cardrisk import fixtures as fx
    from cardrisk.schema import TRANSACTIONS
    from cardrisk.sources.readers import TS_WRITE_FORMAT, read_transactions_csv
    from conftest import SF_SMALL
    from helpers import same_rows

    tx = fx.tx(spark, SF_SMALL)
    names = [f.name for f in TRANSACTIONS.fields if f.name in tx.columns]
    tx = tx.select(*names)
    a, b = tx.filter("TRANSACTION_ID % 2 = 0"), tx.filter("TRANSACTION_ID % 2 = 1").select(*reversed(names))
    for part, where in ((a, "a"), (b, "b")):
        part.coalesce(1).write.option("header", True).option("timestampFormat", TS_WRITE_FORMAT).csv(f"{tmp_dir}/{where}")
    paths = [f"{tmp_dir}/a", f"{tmp_dir}/b"]
    with pytest.raises(Exception, match="(?i)header"):
        read_transactions_csv(spark, paths).collect()
    got = read_transactions_csv(spark, paths, mixed_headers=True).select(*names)
    want = read_transactions_csv(spark, paths[0]).select(*names).unionByName(read_transactions_csv(spark, paths[1]).select(*names))
    assert same_rows(got, want) and got.count() == 1000
