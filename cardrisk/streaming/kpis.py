"""Streaming sources and daily KPIs (2.I I1).

A stream of transaction files is read with a declared schema; the daily KPI
aggregation is an event-time window with a watermark, so state for a day is
dropped once the watermark passes it.  Results are written per micro-batch
(``update`` mode) into ``<out>/batch_id=<n>``, overwritten on retry, so the
sink is idempotent; readers take the newest row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators.aggregates import with_day_change
from cardrisk.operators.rolling import money
from cardrisk.schema import CUSTOMER_ID, TX_AMOUNT, TX_DATETIME, TX_FRAUD


def daily_kpi_stream(tx: DataFrame, watermark: str = "1 day", ts: str = TX_DATETIME, amount_scale: int | None = 2) -> DataFrame:
    """Per event-time day and customer: transactions, frauds, exact money sum and count.

    Customers stay apart so that a day's number of customers is exact; state is one row for
    each customer of an open day.  Rows later than ``watermark`` behind the newest are not
    counted (Spark's late-row rule; the query's progress has their number in
    ``numRowsDroppedByWatermark``).
    """
    return (
        tx.withWatermark(ts, watermark)
        .groupBy(F.window(ts, "1 day").alias("w"), CUSTOMER_ID)
        .agg(
            F.count(F.lit(1)).alias("n_tx"),
            F.coalesce(F.sum(TX_FRAUD), F.lit(0)).cast("bigint").alias("n_fraud"),
            F.sum(money(TX_AMOUNT, amount_scale)).alias("amount_sum"),
            F.count(TX_AMOUNT).alias("amount_n"),
        )
        .select(F.to_date(F.col("w.start")).alias("TX_DATE"), CUSTOMER_ID, "n_tx", "n_fraud", "amount_sum", "amount_n")
    )


def write_batches(stream: DataFrame, out: str, checkpoint: str, output_mode: str = "update",
                  available_now: bool = True, processing_time: str | None = None):
    """Start the query; each micro-batch overwrites ``<out>/batch_id=<n>`` (idempotent on retry)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def latest_per_key(spark: SparkSession, out: str, *keys: str) -> DataFrame:
    """The newest version of every key across the written micro-batches."""
    d = spark.read.parquet(out)
    values = F.struct(*[c for c in d.columns if c not in (*keys, "batch_id")])
    return d.groupBy(*keys).agg(F.max_by(values, "batch_id").alias("_v")).select(*keys, "_v.*")


def daily_kpis_final(spark: SparkSession, out: str) -> DataFrame:
    """The columns of ``aggregates.daily_kpis`` from the written micro-batches."""
    daily = latest_per_key(spark, out, "TX_DATE", CUSTOMER_ID).groupBy("TX_DATE").agg(
        F.sum("n_tx").alias("n_tx"),
        F.sum("n_fraud").alias("n_fraud"),
        F.try_divide(F.sum("amount_sum").cast("double"), F.sum("amount_n")).alias("mean_amount"),
        F.count(CUSTOMER_ID).alias("n_customers"),
    )
    return with_day_change(daily)
