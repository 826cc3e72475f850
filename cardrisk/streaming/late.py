"""Daily KPIs of a stream with a side table of its late rows (2.I I1).

A row is late if its day had ended a ``delay`` behind the newest time of the batches before its own; the day
is closed and the row goes to the side table with its batch and reason, so nothing is lost uncounted and a
closed day never changes.  Rows without a time have no day and go there too.  Each micro-batch writes
four folders, ``kpis``, ``late``, ``progress`` and nothing else, each ``batch=<n>`` with overwrite:
partial sums by day and customer, late rows, and what was read, counted and late with the newest time so far.
A batch reads the progress of the one before it, so a retried batch writes the same again; there is no other state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators.aggregates import with_day_change
from cardrisk.operators.rolling import money
from cardrisk.schema import CUSTOMER_ID, TRANSACTION_ID, TX_AMOUNT, TX_DATETIME, TX_FRAUD, D

PROGRESS = "n_read bigint, n_counted bigint, n_late bigint, top_us bigint"


def split_late(rows: DataFrame, closed_us: int | None) -> DataFrame:
    """Adds ``reason``: null for rows of open days."""
    us = F.unix_micros(F.col(TX_DATETIME).cast("timestamp"))
    day_end = (F.floor(us / F.lit(D)) + 1) * F.lit(D)
    late = F.lit(False) if closed_us is None else day_end <= F.lit(closed_us)
    return rows.withColumn("reason", F.when(us.isNull(), "no time").when(late, "day closed"))


def kpi_batch(spark: SparkSession, rows: DataFrame, base: str, batch: int, delay_us: int = D, amount_scale: int | None = 2) -> None:
    before = spark.read.schema(PROGRESS).parquet(f"{base}/progress/batch={batch - 1}").first()["top_us"] if batch > 0 else None
    split = split_late(rows, None if before is None else before - delay_us)
    counted = split.filter(F.col("reason").isNull())
    sums = counted.groupBy(F.to_date(TX_DATETIME).alias("TX_DATE"), CUSTOMER_ID).agg(
        F.count(F.lit(1)).alias("n_tx"), F.coalesce(F.sum(TX_FRAUD), F.lit(0)).cast("bigint").alias("n_fraud"),
        F.sum(money(TX_AMOUNT, amount_scale)).alias("amount_sum"), F.count(TX_AMOUNT).alias("amount_n"),
    )
    sums.write.mode("overwrite").parquet(f"{base}/kpis/batch={batch}")
    split.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{base}/late/batch={batch}")
    top = F.max(F.unix_micros(F.col(TX_DATETIME).cast("timestamp")))
    progress = split.agg(
        F.count(F.lit(1)).alias("n_read"), F.count(F.when(F.col("reason").isNull(), 1)).alias("n_counted"), F.count("reason").alias("n_late"),
        F.greatest(top, F.lit(before).cast("bigint")).alias("top_us"),
    )
    progress.write.mode("overwrite").parquet(f"{base}/progress/batch={batch}")


def kpis_with_late_rows(spark: SparkSession, stream: DataFrame, base: str, delay_us: int = D):
    """Start the stream (availableNow)."""

    def sink(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        try:
            kpi_batch(spark, rows, base, batch, delay_us)
        finally:
            rows.unpersist()

    return stream.writeStream.option("checkpointLocation", f"{base}/ckpt").foreachBatch(sink).trigger(availableNow=True).start()


def counted_kpis(spark: SparkSession, base: str) -> DataFrame:
    """The columns of ``aggregates.daily_kpis`` over the counted rows."""
    parts = spark.read.parquet(f"{base}/kpis").groupBy("TX_DATE", CUSTOMER_ID).agg(*[F.sum(c).alias(c) for c in ("n_tx", "n_fraud", "amount_sum", "amount_n")])
    daily = parts.groupBy("TX_DATE").agg(
        F.sum("n_tx").alias("n_tx"), F.sum("n_fraud").alias("n_fraud"),
        F.try_divide(F.sum("amount_sum").cast("double"), F.sum("amount_n")).alias("mean_amount"), F.count(CUSTOMER_ID).alias("n_customers"),
    )
    return with_day_change(daily)


def late_rows(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/late").select("batch", TRANSACTION_ID, TX_DATETIME, "reason")


def progress(spark: SparkSession, base: str) -> DataFrame:
    """A row a batch: read, counted, late."""
    return spark.read.parquet(f"{base}/progress").select("batch", "n_read", "n_counted", "n_late")
