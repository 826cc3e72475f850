"""Structured Streaming queries (2.I): run to completion with availableNow, then read the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.plans import model as mdl
from cardrisk.plans import scoring
from cardrisk.queries.q_model import PARAMS
from cardrisk.queries.q_windows import cust_sql, term_sql
from cardrisk.queries.registry import register
from cardrisk.schema import TX_TIME_DAYS, D
from cardrisk.session import scratch_path
from cardrisk.streaming import history_features, kpis, late, rolling_cells, rolling_state


def by_time(batches: int = 4):
    """Batch numbers by even shares of the events' time span."""

    def number(events):
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        lo, hi = events.agg(F.min(us), F.max(us)).first()
        return F.coalesce(F.floor((us - lo) * batches / (hi - lo + 1)), F.lit(0)).cast("int") if lo is not None else F.lit(0)

    return number


def run_in_batches(spark, sf: str, start, number=None, where=None) -> None:
    """The events as a stream: batch after batch arrives in the source folder, and the query started by ``start`` takes up
    what is new from its checkpoint.

    One pass splits the table by ``number``; a batch has as many files as tasks wrote it and is read by as many.
    """
    events = fx.load(spark, sf, "events")
    if where is not None:
        events = events.filter(where)
    split, arrived = scratch_path(spark, "stream_split"), scratch_path(spark, "stream_events")
    part = (number or by_time())(events)
    events.withColumn("_batch", part).write.partitionBy("_batch").parquet(split)
    spark.createDataFrame([], events.schema).write.parquet(arrived)
    # a batch without rows only drops old state, which the next batch does as well
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    source = spark.read.schema(events.withColumn("_batch", part).schema).parquet(split)
    numbers = sorted(r[0] for r in events.select(part.alias("n")).distinct().collect())  # a row a batch
    try:
        for n in numbers or [None]:
            if n is not None:
                source.filter(F.col("_batch") == n).drop("_batch").write.mode("append").parquet(arrived)
            start(fx.tx_from_events(spark.readStream.schema(events.schema).parquet(arrived))).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


@register(
    "stream_daily_kpis",
    "WITH d AS (SELECT CAST(TX_DATETIME AS DATE) AS TX_DATE, count(*) AS n_tx, CAST(coalesce(sum(TX_FRAUD), 0) AS BIGINT) AS n_fraud,\n"
    "  CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(TX_AMOUNT), 0) AS mean_amount,\n"
    "  count(DISTINCT CUSTOMER_ID) AS n_customers FROM tx GROUP BY 1)\n"
    "SELECT a.TX_DATE, a.n_tx, a.n_fraud, a.mean_amount, a.n_customers,\n"
    "  coalesce(CAST(a.n_tx AS DOUBLE) / nullif(a.n_customers, 0), 0) AS tx_per_customer,\n"
    "  a.n_fraud - coalesce(b.n_fraud, 0) AS fraud_delta FROM d a LEFT JOIN d b ON b.TX_DATE + 1 = a.TX_DATE",
)
def stream_daily_kpis(spark, sf):
    base = scratch_path(spark, "stream_kpis")
    run_in_batches(spark, sf, lambda tx: kpis.write_batches(kpis.daily_kpi_stream(tx), f"{base}/out", f"{base}/ckpt"))
    return kpis.daily_kpis_final(spark, f"{base}/out")


def _run_append(spark, sf: str, features, name: str, batches: int = 4):
    base = scratch_path(spark, name)
    kinds = []

    def start(tx):
        out = features(tx)
        kinds.append(out.schema)
        sink = out.writeStream.outputMode("append").option("checkpointLocation", f"{base}/ckpt").format("parquet").option("path", f"{base}/out")
        return sink.trigger(availableNow=True).start()

    run_in_batches(spark, sf, start, by_time(batches))
    return spark.read.schema(kinds[0]).parquet(f"{base}/out")


# The events file arrives in time order and has no equal timestamps, so the
# features known at arrival equal the batch window features.
@register(
    "stream_customer_rolling",
    f"SELECT TRANSACTION_ID, CUSTOMER_ID,\n  {cust_sql()}\nFROM tx WHERE CUSTOMER_ID IS NOT NULL",
)
def stream_customer_rolling(spark, sf):
    """Per-customer rolling spend known at arrival (equals the row-exact batch form on in-order input)."""
    return _run_append(spark, sf, rolling_state.customer_rolling_stream, "stream_cust")


@register(
    "stream_terminal_risk",
    f"SELECT TRANSACTION_ID, TERMINAL_ID,\n  {term_sql()}\nFROM tx WHERE TERMINAL_ID IS NOT NULL",
)
def stream_terminal_risk(spark, sf):
    """Per-terminal delayed risk known at arrival (equals the batch form on in-order input)."""
    return _run_append(spark, sf, rolling_state.terminal_risk_stream, "stream_term")


@register(
    "stream_customer_rolling_history",
    f"SELECT TRANSACTION_ID, CUSTOMER_ID,\n  {cust_sql()}\nFROM tx WHERE CUSTOMER_ID IS NOT NULL",
)
def stream_customer_rolling_history(spark, sf):
    """Customer features per micro-batch through the batch operators and a history table (hot-key form)."""
    base = scratch_path(spark, "stream_cust_hist")
    run_in_batches(spark, sf, lambda tx: history_features.run_history_features(spark, tx, "customer", base))
    return history_features.read_history_features(spark, base)


@register(
    "stream_terminal_risk_history",
    f"SELECT TRANSACTION_ID, TERMINAL_ID,\n  {term_sql()}\nFROM tx WHERE TERMINAL_ID IS NOT NULL",
)
def stream_terminal_risk_history(spark, sf):
    """Terminal risk per micro-batch through the batch operators and a history table (hot-key form)."""
    base = scratch_path(spark, "stream_term_hist")
    run_in_batches(spark, sf, lambda tx: history_features.run_history_features(spark, tx, "terminal", base))
    return history_features.read_history_features(spark, base)


@register(
    "stream_score",
    "SELECT TRANSACTION_ID, TRUE AS score_in_range, TRUE AS pred_is_0_or_1, TRUE AS same_as_batch FROM tx WHERE TX_TIME_DAYS >= 23",
)
def stream_score(spark, sf, cut_day: int = 23):
    """Raw transactions scored as they arrive, from kept day folders and last rows; equal to scoring all of them at once."""
    tx = fx.tx(spark, sf)
    past, new = tx.filter(F.col(TX_TIME_DAYS) < cut_day), tx.filter(F.col(TX_TIME_DAYS) >= cut_day).drop("TX_FRAUD", "TX_FRAUD_SCENARIO")
    model, thr, _, feats, stats = mdl.train_eval(past, **PARAMS)
    threshold = thr.first()["threshold"]
    base = scratch_path(spark, "stream_score")
    scoring.store_batch(spark, f"{base}/state", past, 0)
    late = F.col("ts") >= F.timestamp_micros(F.lit(fx.FIXTURE_START_US + cut_day * D)).cast("timestamp_ntz")
    run_in_batches(
        spark, sf, where=late,
        start=lambda s: scoring.score_stream(spark, s.drop("TX_FRAUD"), f"{base}/state", f"{base}/out", f"{base}/ckpt", model, threshold, feats, stats),
    )
    kind = new.select("TRANSACTION_ID", F.lit(0.0).alias("SCORE"), F.lit(0).alias("PREDICTED_FRAUD")).schema
    got = spark.read.schema(kind).parquet(f"{base}/out")
    once = mdl.score_new(model, threshold, new, past, feats, stats).select("TRANSACTION_ID", F.col("SCORE").alias("_s"), F.col("PREDICTED_FRAUD").alias("_p"))
    same = ((F.col("SCORE") == F.col("_s")) & (F.col("PREDICTED_FRAUD") == F.col("_p"))).alias("same_as_batch")
    return got.join(once, "TRANSACTION_ID", "left").select(
        "TRANSACTION_ID", F.col("SCORE").between(0, 1).alias("score_in_range"), F.col("PREDICTED_FRAUD").isin(0, 1).alias("pred_is_0_or_1"), same
    )


@register(
    "stream_customer_cells",
    f"SELECT TRANSACTION_ID, CUSTOMER_ID,\n  {cust_sql()}\nFROM tx WHERE CUSTOMER_ID IS NOT NULL",
)
def stream_customer_cells(spark, sf):
    """Per-customer rolling spend from time cells in keyed map state."""
    with rolling_cells.rocksdb_state(spark):
        return _run_append(spark, sf, rolling_cells.customer_cells_stream, "stream_cust_cells", 2)


@register(
    "stream_terminal_cells",
    f"SELECT TRANSACTION_ID, TERMINAL_ID,\n  {term_sql()}\nFROM tx WHERE TERMINAL_ID IS NOT NULL",
)
def stream_terminal_cells(spark, sf):
    """Per-terminal delayed risk from time cells in keyed map state."""
    with rolling_cells.rocksdb_state(spark):
        return _run_append(spark, sf, rolling_cells.terminal_cells_stream, "stream_term_cells", 2)


# One event in ten arrives two batches after its time; its day is closed by then unless it was among the batch's last.
LATE_SQL = f"""a AS (SELECT *, CAST(CASE WHEN TRANSACTION_ID % 10 = 3 THEN least(k + 2, 3) ELSE k END AS INTEGER) AS batch
  FROM (SELECT *, floor((us - lo) * 4 / (hi - lo + 1)) AS k FROM tx, (SELECT min(us) AS lo, max(us) AS hi FROM tx) q) r),
m AS (SELECT batch, max(us) AS top FROM a GROUP BY batch),
w AS (SELECT x.batch, (SELECT max(y.top) FROM m y WHERE y.batch < x.batch) - {D} AS closed FROM m x),
s AS (SELECT a.*, coalesce((us // {D} + 1) * {D} <= closed, FALSE) AS late FROM a JOIN w ON w.batch = a.batch)"""


def _out_of_order(events):
    """Batches by time, but every tenth event comes two batches later."""
    k = by_time()(events)
    return F.when(F.col("event_id") % 10 == 3, F.least(k + 2, F.lit(3))).otherwise(k).cast("int")


def _late(spark, sf) -> str:
    base = scratch_path(spark, "stream_late")
    run_in_batches(spark, sf, lambda tx: late.kpis_with_late_rows(spark, tx, base), _out_of_order)
    return base


@register("stream_late_rows", f"WITH {LATE_SQL}\nSELECT batch, TRANSACTION_ID, 'day closed' AS reason FROM s WHERE late")
def stream_late_rows(spark, sf):
    """The side table of rows whose day was closed when they came."""
    return late.late_rows(spark, _late(spark, sf)).select("batch", "TRANSACTION_ID", "reason")


@register(
    "stream_late_balance",
    f"WITH {LATE_SQL}\nSELECT batch, count(*) AS n_read, count(*) FILTER (NOT late) AS n_counted, count(*) FILTER (late) AS n_late FROM s GROUP BY batch",
)
def stream_late_balance(spark, sf):
    """A row a batch: counted and late rows are all that was read."""
    return late.progress(spark, _late(spark, sf))


@register(
    "stream_counted_kpis",
    f"WITH {LATE_SQL},\nd AS (SELECT CAST(TX_DATETIME AS DATE) AS TX_DATE, count(*) AS n_tx, CAST(coalesce(sum(TX_FRAUD), 0) AS BIGINT) AS n_fraud,\n"
    "  CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(TX_AMOUNT), 0) AS mean_amount,\n"
    "  count(DISTINCT CUSTOMER_ID) AS n_customers FROM s WHERE NOT late GROUP BY 1)\n"
    "SELECT a.TX_DATE, a.n_tx, a.n_fraud, a.mean_amount, a.n_customers,\n"
    "  coalesce(CAST(a.n_tx AS DOUBLE) / nullif(a.n_customers, 0), 0) AS tx_per_customer,\n"
    "  a.n_fraud - coalesce(b.n_fraud, 0) AS fraud_delta FROM d a LEFT JOIN d b ON b.TX_DATE + 1 = a.TX_DATE",
)
def stream_counted_kpis(spark, sf):
    """Daily KPIs of an out-of-order stream without its late rows."""
    return late.counted_kpis(spark, _late(spark, sf))
