"""Streaming window features through the batch operators (2.I I2/I3, hot-key form).

Keyed state (``rolling_state``) holds every key's look-back in one group,
which does not split a hot key.  This form keeps the history as a table
instead: each micro-batch is joined with the look-back slice of the history
(pruned by day partitions, semi-joined on the batch's keys) and run through
the batch operators, which cut hot keys into time blocks.  New rows get
their features; then they are appended to the history.

Both writes go to ``.../batch_id=<n>`` folders with overwrite, and a batch
reads only history of earlier batches, so a retried batch gives the same
result.  Every ``SNAPSHOT_EVERY`` batches the rows still inside the look-back
behind the newest are written as one snapshot, so a batch reads one snapshot and
the few batches since, however long the stream has run; what lies before the
newest snapshot is no longer read and may be deleted.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators.rolling import customer_spending, terminal_risk, with_us
from cardrisk.schema import CUSTOMER_ID, RISK_DELAY_DAYS, TERMINAL_ID, TX_DATETIME, US, WINDOWS_DAYS, D


SNAPSHOT_EVERY = 20


def read_history(spark: SparkSession, history: str, batch_id: int, schema) -> DataFrame | None:
    """The stored rows of the batches before ``batch_id``: the newest snapshot and the batches since."""
    snapshot = batch_id // SNAPSHOT_EVERY * SNAPSHOT_EVERY - 1  # the last batch in it
    paths = [f"{history}/batch_id={n}" for n in range(snapshot + 1, batch_id)]
    if snapshot >= 0:
        paths.append(f"{history}/snapshot={snapshot}")
    return spark.read.schema(schema).parquet(*paths) if paths else None


def history_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    history: str,
    key: str,
    lookback_days: int,
    features,
) -> DataFrame:
    """Features of one micro-batch's rows, computed with the stored look-back of their keys."""
    new = with_us(batch).withColumn("_new", F.lit(True))
    first_us = new.select(F.min(US)).scalar()
    keys = new.select(key).distinct()
    both = new
    stored = read_history(spark, history, batch_id, with_us(batch).schema)
    if stored is not None:
        hist = stored.filter(F.col(US) > first_us - F.lit(lookback_days * D))
        hist = hist.join(keys, key, "left_semi").withColumn("_new", F.lit(False))
        both = hist.unionByName(new, allowMissingColumns=True)
    return features(both).filter(F.col("_new")).drop("_new")


def store_batch(spark: SparkSession, batch: DataFrame, batch_id: int, history: str, lookback_days: int) -> None:
    """Append a batch to the history (an empty one too), and write the snapshot that is due."""
    rows = with_us(batch)
    rows.write.mode("overwrite").parquet(f"{history}/batch_id={batch_id}")
    if (batch_id + 1) % SNAPSHOT_EVERY == 0:
        older = read_history(spark, history, batch_id, rows.schema)
        live = rows if older is None else older.unionByName(rows)
        newest = live.agg(F.max(F.struct(TX_DATETIME, US))).first()[0]
        if newest is not None:
            # late rows up to one more look-back still find their frames
            live = live.filter(F.col(US) > newest[US] - 2 * lookback_days * D)
        live.write.mode("overwrite").parquet(f"{history}/snapshot={batch_id}")


def run_history_features(
    spark: SparkSession,
    stream: DataFrame,
    kind: str,
    base: str,
    windows=WINDOWS_DAYS,
    delay: int = RISK_DELAY_DAYS,
):
    """Start the stream (availableNow); features go to ``base/out``, history to ``base/history``."""
    if kind == "customer":
        key, lookback = CUSTOMER_ID, max(windows)
        cols = [c for n in windows for c in (f"CUSTOMER_ID_NB_TX_{n}DAY_WINDOW", f"CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW")]

        def features(d):
            return customer_spending(d, windows=windows, ties="row")
    elif kind == "terminal":
        key, lookback = TERMINAL_ID, delay + max(windows)
        cols = [c for n in windows for c in (f"TERMINAL_ID_NB_TX_{n}DAY_WINDOW", f"TERMINAL_ID_RISK_{n}DAY_WINDOW")]

        def features(d):
            return terminal_risk(d, delay=delay, windows=windows)
    else:
        raise ValueError("kind must be 'customer' or 'terminal'")
    history, out = os.path.join(base, "history"), os.path.join(base, "out")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by the features, their keys, and the history
        try:
            if not batch.isEmpty():
                f = history_batch(spark, batch, batch_id, history, key, lookback, features)
                f.select("TRANSACTION_ID", key, *cols).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            store_batch(spark, batch, batch_id, history, lookback)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", os.path.join(base, "ckpt"))
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )


def read_history_features(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, "out")).drop("batch_id")
