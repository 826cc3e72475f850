"""Reject tables, refreshed days, observed checks, wide vocabularies and mergeable day sketches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators import day_sketches as ds
from cardrisk.operators import enrich
from cardrisk.operators.aggregates import daily_kpis
from cardrisk.plans import jobs
from cardrisk.plans.features import stage1_features
from cardrisk.schema import TRANSACTIONS
from cardrisk.sources import rejects, sinks
from conftest import SF_SMALL
from helpers import same_rows

HEADER = "Zeit,Precision,Recall,F1_Score,ROC_AUC,PR_AUC"


def _file(folder, text):
    path = os.path.join(folder, "h.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_every_line_is_kept_or_rejected(spark, tmp_dir):
    lines = [HEADER, "10:00:00,0.1,0.2,0.3,0.4,0.5", "", "   ", HEADER, '"10,00",0.1,0.2,0.3,0.4,0.5', "1,2,3", "x,0.1,0.2,bad,0.4,0.5", "x,,0.2,0.3,0.4,0.5", "a,b,c,d,e,f,g", "x,1,2,3,4,5,6", ",1,2,3,4,5"]
    parsed = rejects.parsed_lines(spark, _file(tmp_dir, "\n".join(lines) + "\n"))
    good, bad = os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "bad")
    rejects.split_lines(parsed, good, bad)
    kept, gone = spark.read.parquet(good), spark.read.parquet(bad)
    assert kept.count() + gone.count() == len(lines)
    assert sorted((r["Zeit"] or "", r["F1_Score"]) for r in kept.collect()) == [("", 3.0), ("10,00", 0.3), ("10:00:00", 0.3)]
    found = {(r["line"], r["reason"]) for r in gone.collect()}
    assert found == {(HEADER, "header"), ("", "blank"), ("   ", "blank"), ("1,2,3", "malformed"), ("x,0.1,0.2,bad,0.4,0.5", "malformed"), ("x,,0.2,0.3,0.4,0.5", "missing"), ("a,b,c,d,e,f,g", "malformed"), ("x,1,2,3,4,5,6", "malformed")}
    assert all(r["file"].endswith("h.csv") for r in gone.collect())
    empty = rejects.parsed_lines(spark, _file(tmp_dir, ""))
    assert rejects.good_rows(empty).count() == rejects.rejected(empty).count() == 0


def test_rejects_of_transactions(spark, tmp_dir):
    head = ",".join(f.name for f in TRANSACTIONS.fields)
    text = "\n".join([head, "1,2024-01-01 00:00:01,1,2,3.5,1,0,0,0", "2,yesterday,1,2,3.5,1,0,0,0", "3,2024-01-01 00:00:01.250000,,2,,1,0,0,0"])
    parsed = rejects.parsed_lines(spark, _file(tmp_dir, text), TRANSACTIONS, required=["TRANSACTION_ID", "TX_DATETIME"])
    assert [r[0] for r in rejects.good_rows(parsed).orderBy("TRANSACTION_ID").select("TRANSACTION_ID").collect()] == [1, 3]
    assert {r["reason"] for r in rejects.rejected(parsed).collect()} == {"header", "malformed"}


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if "TX_DATE=" in d}


def test_refresh_of_one_day_leaves_the_others(spark, tmp_dir):
    tx = fx.tx(spark, SF_SMALL)
    days, out = os.path.join(tmp_dir, "days"), os.path.join(tmp_dir, "out")
    sinks.write_daily_partitions(tx, days)
    jobs.refresh_days(spark, days, out, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    before = _files(out)
    day = dt.date(2024, 1, 20)
    jobs.refresh_days(spark, days, out, day, day)
    after = _files(out)
    assert {f for f in before if "2024-01-20" not in f} == {f for f in after if "2024-01-20" not in f}
    assert all(before[f] == after[f] for f in after if "2024-01-20" not in f) and not set(before) & {f for f in after if "2024-01-20" in f}
    whole = stage1_features(tx, min_day=None, fill_zero=False)
    assert same_rows(spark.read.parquet(out).select(*whole.columns), whole)


def test_checks_are_observed_in_the_writing_pass(spark, tmp_dir):
    tx = fx.tx(spark, SF_SMALL)
    reads = spark.sparkContext.accumulator(0)
    counted = tx.rdd.map(lambda r: reads.add(1) or r).toDF(tx.schema)  # counts how often a row is read
    seen = sinks.write_features_checked(counted, os.path.join(tmp_dir, "f"))
    n = tx.count()
    assert reads.value == n and seen["n_rows"] == n
    assert seen["n_fraud"] == tx.filter("TX_FRAUD = 1").count() and seen["null_TERMINAL_ID"] == tx.filter("TERMINAL_ID is null").count()
    nothing = sinks.write_features_checked(tx.limit(0), os.path.join(tmp_dir, "g"))
    assert nothing["n_rows"] == 0 and nothing["n_fraud"] == 0 and nothing["first_time"] is None


def test_sparse_one_hot_of_a_wide_vocabulary(spark):
    wide = spark.range(200_000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"))
    words = enrich.vocabulary(wide, "c")
    rows = spark.createDataFrame([(1, "v0000000"), (2, "v0199999"), (3, "unseen"), (4, None), (5, "v0000777")], "id int, c string").withColumn("_index", F.lit("own"))
    got = {r["id"]: (r["one_hot"].size, r["one_hot"].indices.tolist(), r["_index"]) for r in enrich.one_hot_sparse(rows, "c", words).collect()}
    assert got == {1: (200_001, [0], "own"), 2: (200_001, [199_999], "own"), 3: (200_001, [200_000], "own"), 4: (200_001, [200_000], "own"), 5: (200_001, [777], "own")}


@pytest.mark.parametrize("days", [1, 9, 60])
def test_day_sketches_of_any_range(spark, tmp_dir, days):
    tx = fx.tx(spark, SF_SMALL)
    path = ds.write_day_sketches(tx, os.path.join(tmp_dir, "s"))
    first = dt.date(2024, 1, 3)
    ranges = spark.createDataFrame([(first, first + dt.timedelta(days=days - 1))], "first date, last date")
    sketches = spark.read.parquet(path)
    rows = tx.filter(F.to_date("TX_DATETIME").between(F.lit(first), F.lit(first + dt.timedelta(days=days - 1))))
    got = ds.range_kpis(sketches, ranges).first()
    exact = rows.agg(F.count(F.lit(1)), F.sum("TX_FRAUD"), F.countDistinct("CUSTOMER_ID")).first()
    assert (got["n_tx"], got["n_fraud"]) == (exact[0], exact[1]) and abs(got["n_customers"] - exact[2]) <= max(0.5, 0.04 * exact[2])
    if days == 1:
        day = daily_kpis(tx).filter(F.col("TX_DATE") == F.lit(first)).first()
        assert got["mean_amount"] == day["mean_amount"]
    for box in ds.range_boxes(sketches, ranges).collect():
        own = sorted(r[0] for r in rows.filter(F.col("TX_FRAUD") == box["TX_FRAUD"]).select("TX_AMOUNT").collect() if r[0] is not None)
        assert (box["n"], box["min"], box["max"]) == (len(own), own[0], own[-1])
        for name, q in ds.QUARTILES.items():
            assert sum(x < box[name] for x in own) <= q * len(own) + 0.02 * len(own) + 1 and sum(x <= box[name] for x in own) >= q * len(own) - 0.02 * len(own) - 1


def test_sketches_of_days_without_amounts(spark, tmp_dir):
    df = spark.sql("select 1L as TRANSACTION_ID, timestamp'2024-01-01 01:00:00' as TX_DATETIME, 5L as CUSTOMER_ID, cast(null as double) as TX_AMOUNT, 0 as TX_FRAUD "
                   "union all select 2L, cast(null as timestamp), 6L, 1.0D, 1 union all select 3L, timestamp'2024-01-01 02:00:00', null, double('NaN'), 0")
    sketches = ds.day_sketches(df, amount_scale=None)
    ranges = spark.sql("select date'2023-12-01' as first, date'2024-02-01' as last")
    box = ds.range_boxes(sketches, ranges).collect()
    assert len(box) == 1 and box[0]["n"] == 0 and box[0]["median"] is None
    kpis = ds.range_kpis(sketches, ranges).first()
    assert (kpis["n_tx"], kpis["n_fraud"], kpis["n_customers"], kpis["mean_amount"]) == (2, 0, 1, None)
    assert ds.range_kpis(sketches.limit(0), ranges).count() == 0


def test_timed_table(spark):
    from cardrisk.sources.readers import TimedTable

    now, loads = [0.0], []
    table = TimedTable(lambda: loads.append(1) or spark.range(len(loads)), 60.0, lambda: now[0])
    first = table.get()
    now[0] = 59.9
    assert table.get() is first and first.is_cached and len(loads) == 1
    now[0] = 60.0
    assert table.get().count() == 2 and not first.is_cached and first.count() == 1
    table.drop()
    assert table.get().count() == 3
    table.drop()
