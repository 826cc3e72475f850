"""Scoring against kept state: day folders and each customer's last rows (2.K K12, 2.I I4).

A store has two tables under one folder:

``days/TX_DATE=<day>/batch=<n>``
    the rows of every batch by day; a batch reads the ``lookback_days`` folders before its first row alone.
``last_rows/batch=<n>``
    each customer's ``MAX_LAG`` last rows after batch ``n``, made from the version before it and the batch.
    The lags look back by rows, not time, so without it the whole history would have to be ranked.

A batch reads what batches before it stored and overwrites its own folders, so a batch that is run again
(a lost driver, a retried micro-batch) reads the same state and leaves the same rows.  Batches come in time order;
versions of ``last_rows`` older than the one before are no longer read and may be deleted.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.plans import model as mdl
from cardrisk.schema import CUSTOMER_ID, TERMINAL_ID, TRANSACTION_ID, TX_AMOUNT, TX_DATETIME, TX_FRAUD, TX_TIME_DAYS, TX_TIME_SECONDS

LOOKBACK_DAYS, MAX_LAG = 37, 5
#: What features are made of; other columns are not kept.
KEPT = T.StructType([
    T.StructField(TRANSACTION_ID, T.LongType()), T.StructField(TX_DATETIME, T.TimestampType()), T.StructField(CUSTOMER_ID, T.LongType()),
    T.StructField(TERMINAL_ID, T.LongType()), T.StructField(TX_AMOUNT, T.DoubleType()), T.StructField(TX_TIME_SECONDS, T.LongType()),
    T.StructField(TX_TIME_DAYS, T.IntegerType()), T.StructField(TX_FRAUD, T.IntegerType()),
])


def _kept(rows: DataFrame) -> DataFrame:
    """The kept columns with their types; a column that is not there is null."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in KEPT])


def store_batch(spark: SparkSession, base: str, rows: DataFrame, batch: int, max_lag: int = MAX_LAG) -> None:
    """Keep a batch's rows (rows without a time have no day and are not kept) and the last rows after it."""
    kept = _kept(rows).filter(F.col(TX_DATETIME).isNotNull())
    days = kept.withColumn("TX_DATE", F.to_date(TX_DATETIME)).withColumn("batch", F.lit(batch))
    # a batch's own partitions alone are replaced; days are split over tasks by time
    days.repartitionByRange("TX_DATE", TX_DATETIME).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("TX_DATE", "batch").parquet(f"{base}/days")
    known = kept.filter(F.col(CUSTOMER_ID).isNotNull())
    before = last_rows(spark, base, batch)
    mdl.last_rows_of(known if before is None else before.unionByName(known), max_lag).write.mode("overwrite").parquet(f"{base}/last_rows/batch={batch}")


def last_rows(spark: SparkSession, base: str, batch: int) -> DataFrame | None:
    """The last rows before ``batch``; batches count from 0."""
    return spark.read.schema(KEPT).parquet(f"{base}/last_rows/batch={batch - 1}") if batch > 0 else None


def recent_days(spark: SparkSession, base: str, first: dt.datetime, batch: int, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows of the days from ``lookback_days`` before ``first``, as stored before ``batch``; other folders are not opened."""
    kind = T.StructType([*KEPT.fields, T.StructField("TX_DATE", T.DateType()), T.StructField("batch", T.IntegerType())])
    rows = spark.read.schema(kind).parquet(f"{base}/days")
    since = (first - dt.timedelta(days=lookback_days)).date()
    return rows.filter((F.col("TX_DATE") >= F.lit(since)) & (F.col("batch") < batch)).select(*KEPT.fieldNames())


def score_batch(spark: SparkSession, base: str, new: DataFrame, batch: int, model: PipelineModel, threshold: float, features, terminal_stats: DataFrame,
                lookback_days: int = LOOKBACK_DAYS, max_lag: int = MAX_LAG) -> DataFrame:
    """``TRANSACTION_ID, SCORE, PREDICTED_FRAUD`` of a batch's rows from the state that the batches before it left."""
    first = new.agg(F.min(F.unix_micros(F.col(TX_DATETIME).cast("timestamp")))).first()[0]
    start = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=first) if first is not None else dt.datetime(9999, 1, 1)
    if batch > 0:
        history, last = recent_days(spark, base, start, batch, lookback_days), last_rows(spark, base, batch)
    else:
        history = last = spark.createDataFrame([], KEPT)
    return mdl.score_new(model, threshold, _kept(new), history, features, terminal_stats, lookback_days, max_lag, last)


def score_stream(spark: SparkSession, stream: DataFrame, base: str, out: str, checkpoint: str, model: PipelineModel, threshold: float, features, terminal_stats: DataFrame, first_batch: int = 1):
    """Start scoring a stream of raw transactions; each micro-batch's scores overwrite ``<out>/batch=<n>``.

    ``base`` holds the batches before ``first_batch`` (``store_batch``).  A micro-batch is scored and then stored,
    so the next one's windows see it.
    """

    def sink(rows: DataFrame, n: int) -> None:
        batch, rows = first_batch + n, rows.persist()
        try:
            scored = score_batch(spark, base, rows, batch, model, threshold, features, terminal_stats)
            scored.write.mode("overwrite").parquet(f"{out}/batch={batch}")
            store_batch(spark, base, rows, batch)
        finally:
            rows.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
