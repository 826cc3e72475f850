"""Dirty files, daily refresh, checks in the writing pass, wide vocabularies, stream watch (2.A A2, A3, A7, A11; 2.D D20; 2.H H15; 2.I I5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators import enrich
from cardrisk.plans import jobs
from cardrisk.queries.q_aggregates import feat1
from cardrisk.queries.registry import out, register
from cardrisk.schema import CUSTOMER_ID, METRIC_HISTORY, TRANSACTION_ID, TX_DATETIME, TX_FRAUD
from cardrisk.session import scratch_path
from cardrisk.sources import readers, rejects, sinks
from cardrisk.streaming import score

HEADER = ",".join(f.name for f in METRIC_HISTORY.fields)


def _id():
    return F.col(TRANSACTION_ID)


def _metric_line(f1):
    zeit = F.format_string("%02d:%02d:%02d", _id() % 24, _id() % 60, _id() % 59)
    return F.concat_ws(",", zeit, F.lit("0.5"), F.lit("0.25"), f1, F.lit("0.9"), F.lit("0.8"))


def _dirty_file(spark, sf) -> str:
    """A metric history with a line a transaction, some of them bad."""
    good = (_id() % 1000 / 1000).cast("decimal(4,3)").cast("string")
    line = (
        F.when(_id() % 10 == 3, F.lit(HEADER)).when(_id() % 10 == 5, _metric_line(F.lit("n/a"))).when(_id() % 10 == 7, F.lit("10:00:00,0.5,0.5"))
        .when(_id() % 10 == 9, F.lit("  ")).when(_id() % 20 == 8, _metric_line(F.lit(""))).when(_id() % 20 == 4, F.concat(_metric_line(good), F.lit(",1"))).otherwise(_metric_line(good))
    )
    path = scratch_path(spark, "dirty_history")
    fx.tx(spark, sf).select(line.alias("value")).write.text(path)
    return path


@register(
    "history_rejects",
    "SELECT CASE WHEN TRANSACTION_ID % 10 = 3 THEN 'header' WHEN TRANSACTION_ID % 10 IN (5, 7) OR TRANSACTION_ID % 20 = 4 THEN 'malformed'\n"
    "  WHEN TRANSACTION_ID % 10 = 9 THEN 'blank' WHEN TRANSACTION_ID % 20 = 8 THEN 'missing' ELSE 'kept' END AS outcome, count(*) AS n_lines,\n"
    "  CAST(sum(CASE WHEN TRANSACTION_ID % 10 IN (3, 5, 7, 9) OR TRANSACTION_ID % 20 IN (4, 8) THEN NULL ELSE TRANSACTION_ID % 1000 END) AS BIGINT) AS f1_thousandths FROM tx GROUP BY 1",
)
def history_rejects(spark, sf):
    """Lines of a dirty history by outcome: kept rows, and the reject table by reason."""
    parsed = rejects.parsed_lines(spark, _dirty_file(spark, sf))
    good, bad = scratch_path(spark, "history-good"), scratch_path(spark, "history-rejects")
    rejects.split_lines(parsed, good, bad)
    kept = spark.read.schema(METRIC_HISTORY).parquet(good).select(F.lit("kept").alias("outcome"), F.round(F.col("F1_Score") * 1000).cast("bigint").alias("f1"))
    gone = spark.read.parquet(bad).select(F.col("reason").alias("outcome"), F.lit(None).cast("bigint").alias("f1"))
    return kept.unionByName(gone).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("f1").alias("f1_thousandths"))


@register("daily_refresh", "SELECT * FROM feat", views=("feat",))
def daily_refresh(spark, sf):
    """Features written for all days, then the last three refreshed a day at a time from their look-back folders."""
    days, target = scratch_path(spark, "tx_days"), scratch_path(spark, "feature_days")
    sinks.write_daily_partitions(fx.tx(spark, sf), days)
    dates = [r[0] for r in spark.read.parquet(days).select("TX_DATE").distinct().orderBy("TX_DATE").collect()]  # a row a day
    if not dates:
        return out(feat1(spark, sf))
    jobs.refresh_days(spark, days, target, dates[0], dates[-1])
    for day in dates[-3:]:
        jobs.refresh_days(spark, days, target, day, day)
    return out(spark.read.parquet(target).select(*feat1(spark, sf).columns))


@register(
    "cached_table_reload",
    "SELECT * FROM (SELECT 1 AS step, count(*) FILTER (TX_TIME_DAYS < 15) AS n_rows FROM tx UNION ALL SELECT 2, count(*) FILTER (TX_TIME_DAYS < 15) FROM tx\n"
    "  UNION ALL SELECT 3, count(*) FROM tx) t",
)
def cached_table_reload(spark, sf):
    """A table that grows while it is kept: the kept rows within its 60 seconds, all rows after them."""
    tx, now, rows = fx.tx(spark, sf), [0.0], []
    # another process writes: from second 30 on the folders hold the later days too (a write of this session would renew the kept rows)
    early, later = scratch_path(spark, "days-early"), scratch_path(spark, "days-later")
    sinks.write_table(tx.filter(F.col("TX_TIME_DAYS") < 15), early)
    sinks.write_table(tx.filter(F.col("TX_TIME_DAYS") >= 15), later)
    table = readers.TimedTable(lambda: spark.read.schema(tx.schema).parquet(early, *([later] if now[0] >= 30 else [])), 60.0, lambda: now[0])
    for step, at in ((1, 0.0), (2, 59.0), (3, 60.0)):
        now[0] = at
        rows.append((step, table.get().count()))
    table.drop()
    return spark.createDataFrame(rows, "step int, n_rows bigint")


_CHECKED = [CUSTOMER_ID, "TERMINAL_ID", "TX_AMOUNT", "TERMINAL_ID_RISK_7DAY_WINDOW", "CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"]


@register(
    "features_data_check",
    "SELECT count(*) AS n_rows, CAST(coalesce(sum(TX_FRAUD), 0) AS BIGINT) AS n_fraud, min(TX_DATETIME) AS first_time, max(TX_DATETIME) AS last_time,\n  "
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in _CHECKED) + " FROM feat",
    views=("feat",),
)
def features_data_check(spark, sf):
    """The data check taken in the pass that writes the features."""
    seen = sinks.write_features_checked(feat1(spark, sf), scratch_path(spark, "features-checked"))
    kind = "n_rows bigint, n_fraud bigint, first_time timestamp_ntz, last_time timestamp_ntz, " + ", ".join(f"null_{c} bigint" for c in _CHECKED)
    names = ["n_rows", "n_fraud", "first_time", "last_time", *[f"null_{c}" for c in _CHECKED]]
    return spark.createDataFrame([tuple(seen[c] for c in names)], kind)


@register(
    "one_hot_wide",
    "SELECT TRANSACTION_ID, CAST(v AS BIGINT) AS place, n AS places FROM (SELECT TRANSACTION_ID, dense_rank() OVER (ORDER BY concat('c', CAST(CUSTOMER_ID AS VARCHAR))) - 1 AS v FROM tx WHERE CUSTOMER_ID IS NOT NULL\n"
    "  UNION ALL SELECT TRANSACTION_ID, (SELECT count(DISTINCT CUSTOMER_ID) FROM tx) FROM tx WHERE CUSTOMER_ID IS NULL) a, (SELECT count(DISTINCT CUSTOMER_ID) + 1 AS n FROM tx) b",
)
def one_hot_wide(spark, sf):
    """Customers as sparse one-hot vectors over a fitted vocabulary table: the place of each row's 1 and the vector's length."""
    named = fx.tx(spark, sf).select(TRANSACTION_ID, F.concat(F.lit("c"), F.col(CUSTOMER_ID).cast("string")).alias("name"))
    encoded = enrich.one_hot_sparse(named, "name", enrich.vocabulary(named, "name"))
    # SQL has no function of a sparse vector's place; making it dense would cost a value a category
    place = F.udf(lambda v: (int(v.indices[0]), int(v.size)), "place bigint, places bigint")
    return encoded.select(TRANSACTION_ID, place("one_hot").alias("p")).select(TRANSACTION_ID, "p.place", "p.places")


@register(
    "source_dispatch",
    "SELECT kind, count(*) AS n, CAST(sum(TRANSACTION_ID) AS BIGINT) AS ids FROM tx, (VALUES ('csv'), ('parquet'), ('frame')) AS k(kind) GROUP BY kind",
)
def source_dispatch(spark, sf):
    """One table from a CSV path with a stray index column, a parquet path and a frame."""
    tx = fx.tx(spark, sf).select(*[c for c in fx.tx(spark, sf).columns if c != "us"])
    csv, parquet = scratch_path(spark, "dispatch") + ".csv", scratch_path(spark, "dispatch") + ".parquet"
    sinks.write_table(tx.withColumn("Unnamed: 0", F.monotonically_increasing_id()).select("Unnamed: 0", *tx.columns), csv, "csv")
    sinks.write_table(tx, parquet)
    parts = [readers.as_dataframe(spark, s).select(F.lit(k).alias("kind"), TRANSACTION_ID) for k, s in (("csv", csv), ("parquet", parquet), ("frame", tx))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(TRANSACTION_ID).alias("ids"))


@register(
    "stream_history_watch",
    "SELECT count(*) AS n_rows, CAST(sum(TRANSACTION_ID % 1000) AS BIGINT) AS f1_thousandths, count(DISTINCT TX_TIME_DAYS // 10) AS n_alerts FROM tx",
)
def stream_history_watch(spark, sf):
    """Metric files arriving in turn are appended to the history, with one alert level a batch."""
    base = scratch_path(spark, "watch")
    tx = fx.tx(spark, sf)
    part = F.expr("TX_TIME_DAYS div 10")
    line = _metric_line((_id() % 1000 / 1000).cast("decimal(4,3)").cast("string"))
    for n in sorted(r[0] for r in tx.select(part).distinct().collect()):  # a file folder every ten days
        rows = tx.filter(part == n).select(F.split(line, ",").alias("v")).select(*[F.col("v")[i].alias(f.name) for i, f in enumerate(METRIC_HISTORY.fields)])
        rows.write.mode("append").option("header", True).csv(f"{base}/in")
        score.watch_metric_history(spark, f"{base}/in", f"{base}/history", f"{base}/alerts", f"{base}/ckpt").awaitTermination()
    history, alerts = spark.read.schema(METRIC_HISTORY).parquet(f"{base}/history"), spark.read.parquet(f"{base}/alerts")
    counted = history.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col("F1_Score") * 1000).cast("bigint")).alias("f1_thousandths"))
    return counted.withColumn("n_alerts", F.lit(alerts.filter(F.col("alert").isNotNull()).count()).cast("bigint"))
