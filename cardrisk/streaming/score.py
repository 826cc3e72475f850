"""Streaming scoring and metric-history watch (2.I I4/I5)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.functions.scalar import f1_alert
from cardrisk.schema import METRIC_HISTORY, PREDICTED_FRAUD, TRANSACTION_ID


def score_stream(features: DataFrame, model: PipelineModel, threshold: float, feature_cols) -> DataFrame:
    """Apply a fitted pipeline to a stream of feature rows (transformers are stateless)."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(features.select(TRANSACTION_ID, *feature_cols))
    p = vector_to_array("probability")[1]
    return out.select(TRANSACTION_ID, p.alias("SCORE"), (p >= F.lit(threshold)).cast("int").alias(PREDICTED_FRAUD))


def watch_metric_history(spark, in_dir: str, history_out: str, alerts_out: str, checkpoint: str):
    """Append every new metric row to the history and record the alert level of the newest row.

    Newest is the last row of the newest file, as rows arrive; the time of day in
    ``Zeit`` starts anew at midnight.  A batch overwrites its own folder, so a retry stores nothing twice.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_row", F.monotonically_increasing_id())  # as the files list them
        arrival = [F.col(c).desc() for c in ("_time", "_file", "_start", "_row")]
        batch.drop("_time", "_file", "_start").write.mode("overwrite").parquet(f"{history_out}/batch_id={batch_id}")
        newest = rows.orderBy(*arrival).limit(1)
        newest.select("Zeit", "F1_Score", f1_alert("F1_Score").alias("alert"), F.lit(batch_id).alias("batch_id")) \
            .write.mode("overwrite").parquet(f"{alerts_out}/batch_id={batch_id}")

    stream = spark.readStream.schema(METRIC_HISTORY).option("header", True).option("mode", "DROPMALFORMED").csv(in_dir)
    meta = {"_time": "file_modification_time", "_file": "file_path", "_start": "file_block_start"}
    stream = stream.withColumns({c: F.col(f"_metadata.{m}") for c, m in meta.items()}).filter(F.col("F1_Score").isNotNull())
    return (
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()
    )
