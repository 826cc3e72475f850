"""Operators that no other section runs: table reads and sinks, null handling, concatenation, weights."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk import fixtures as fx
from cardrisk.functions.calendar import parse_timestamp
from cardrisk.functions.scalar import clip_round, null_to
from cardrisk.operators import aggregates as agg
from cardrisk.operators import filters as flt
from cardrisk.operators import metrics as m
from cardrisk.operators.detail import SCORE_COL, history_card, tx_detail
from cardrisk.operators.topk import chronological, top_transactions
from cardrisk.plans.model import with_class_weight
from cardrisk.queries.q_aggregates import feat1
from cardrisk.queries.q_metrics import CURVE_SQL, PRED_SQL, CONF
from cardrisk.queries.q_sources import TX_COLS, _detail_sql
from cardrisk.queries.registry import out, register
from cardrisk.schema import METRIC_HISTORY, TRANSACTIONS
from cardrisk.session import scratch_path, table_path
from cardrisk.sources import readers, sinks


@register("dimension_read", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def dimension_read(spark, sf):
    d = readers.read_table(spark, table_path(sf, "customer"))
    return d.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("predictions_roundtrip", "SELECT TRANSACTION_ID, TX_FRAUD AS PREDICTED_FRAUD FROM tx")
def predictions_roundtrip(spark, sf):
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(fx.tx(spark, sf).withColumn("PREDICTED_FRAUD", F.col("TX_FRAUD").cast("int")), path)
    return spark.read.option("header", True).schema("TRANSACTION_ID long, PREDICTED_FRAUD int").csv(path)


@register("filtered_export", "SELECT " + ", ".join(TX_COLS) + " FROM tx WHERE TX_FRAUD = 1")
def filtered_export(spark, sf):
    path = scratch_path(spark, "export")
    sinks.write_table(flt.fraud_only(fx.tx(spark, sf)).select(*TX_COLS), path, "csv")
    return out(readers.read_transactions_csv(spark, path))


METRICS = [f.name for f in METRIC_HISTORY.fields if f.name != "Zeit"]


@register(
    "history_append",
    "SELECT strftime(TX_DATETIME, '%Y-%m-%d') AS Zeit, "
    + ", ".join(f"CAST((count(*) + {i}) % 16 AS DOUBLE) / 16 AS {c}" for i, c in enumerate(METRICS))
    + " FROM tx WHERE TX_DATETIME IS NOT NULL GROUP BY 1",
)
def history_append(spark, sf):
    """Two appends to one history (so a repeated header), read back without its dirty lines."""
    tx = fx.tx(spark, sf).filter(F.col("TX_DATETIME").isNotNull())
    days = tx.groupBy(F.date_format("TX_DATETIME", "yyyy-MM-dd").alias("Zeit")).agg(F.count(F.lit(1)).alias("n"))
    days = days.select("Zeit", *[(((F.col("n") + i) % 16).cast("double") / 16).alias(c) for i, c in enumerate(METRICS)])
    path = scratch_path(spark, "metric-history")
    for part in (days.filter("Zeit < '2024-01-15'"), days.filter("Zeit >= '2024-01-15'")):
        sinks.append_history(part, path, METRICS)
    return readers.read_metric_history(spark, path)


@register("null_timestamps_dropped", "SELECT TRANSACTION_ID FROM tx WHERE TX_DATETIME IS NOT NULL AND TRANSACTION_ID % 5 <> 0")
def null_timestamps_dropped(spark, sf):
    tx = fx.tx(spark, sf)
    tx = tx.withColumn("TX_DATETIME", F.when(F.col("TRANSACTION_ID") % 5 != 0, F.col("TX_DATETIME")))
    return flt.drop_null_timestamps(tx).select("TRANSACTION_ID")


NUMERIC = [f.name for f in TRANSACTIONS.fields if isinstance(f.dataType, T.NumericType)]


@register("numeric_column_counts", "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, count({c}) AS n FROM tx" for c in NUMERIC))
def numeric_column_counts(spark, sf):
    tx = fx.tx(spark, sf).select(*TX_COLS)
    cols = agg.numeric_columns(tx)
    return tx.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "feature", "n")


@register("chronological_rows", "SELECT TRANSACTION_ID, TX_DATETIME FROM tx")
def chronological_rows(spark, sf):
    return out(chronological(fx.tx(spark, sf)).select("TRANSACTION_ID", "TX_DATETIME"))


@register("rows_concatenated", "SELECT TRANSACTION_ID, TX_FRAUD FROM tx WHERE TX_FRAUD = 1 UNION ALL SELECT TRANSACTION_ID, TX_FRAUD FROM tx WHERE TX_AMOUNT >= 100")
def rows_concatenated(spark, sf):
    tx = fx.tx(spark, sf).select("TRANSACTION_ID", "TX_FRAUD", "TX_AMOUNT")
    return flt.fraud_only(tx).unionByName(tx.filter("TX_AMOUNT >= 100")).drop("TX_AMOUNT")


@register("timestamps_parsed", "SELECT TRANSACTION_ID, date_trunc('second', TX_DATETIME) AS TX_DATETIME FROM tx")
def timestamps_parsed(spark, sf):
    text = fx.tx(spark, sf).select("TRANSACTION_ID", F.date_format("TX_DATETIME", "yyyy-MM-dd HH:mm:ss").alias("t"))
    return out(text.select("TRANSACTION_ID", parse_timestamp("t", "yyyy-MM-dd HH:mm:ss").alias("TX_DATETIME")))


@register("null_to_zero", "SELECT TRANSACTION_ID, CASE WHEN TRANSACTION_ID % 3 = 0 THEN 0 ELSE coalesce(TX_FRAUD, 0) END AS TX_FRAUD FROM tx")
def null_to_zero(spark, sf):
    tx = fx.tx(spark, sf).withColumn("TX_FRAUD", F.when(F.col("TRANSACTION_ID") % 3 != 0, F.col("TX_FRAUD")))
    return tx.select("TRANSACTION_ID", null_to("TX_FRAUD", 0).alias("TX_FRAUD"))


@register("clipped_amounts", "SELECT TRANSACTION_ID, round(least(greatest(TX_AMOUNT, 25.0), 75.0), 2) AS clipped FROM tx WHERE TX_AMOUNT IS NOT NULL")
def clipped_amounts(spark, sf):
    tx = fx.tx(spark, sf).filter(F.col("TX_AMOUNT").isNotNull())
    return tx.select("TRANSACTION_ID", clip_round("TX_AMOUNT", 50.0, 25.0, 2).alias("clipped"))


@register("detail_with_score", f"SELECT d.*, d.TX_AMOUNT * 2 AS {SCORE_COL} FROM ({_detail_sql()}) d", views=("feat",))
def detail_with_score(spark, sf):
    return history_card(feat1(spark, sf).withColumn(SCORE_COL, F.col("TX_AMOUNT") * 2))


@register("detail_of_one", f"SELECT * FROM ({_detail_sql()}) WHERE TRANSACTION_ID = (SELECT max(TRANSACTION_ID) FROM feat)", views=("feat",))
def detail_of_one(spark, sf):
    feat = feat1(spark, sf)
    return tx_detail(feat, feat.agg(F.max("TRANSACTION_ID")).first()[0])


@register(
    "class_weights",
    "SELECT TRANSACTION_ID, CASE WHEN TX_FRAUD = 1 THEN (SELECT CAST(count(CASE WHEN TX_FRAUD = 0 THEN 1 END) AS DOUBLE)\n"
    "  / count(CASE WHEN TX_FRAUD = 1 THEN 1 END) FROM tx) ELSE 1.0 END AS weight FROM tx",
)
def class_weights(spark, sf):
    return with_class_weight(fx.tx(spark, sf)).select("TRANSACTION_ID", "weight")


def _queue_sql() -> str:
    return "SELECT TRANSACTION_ID FROM tx WHERE TRANSACTION_ID % 10 = 0 ORDER BY TX_DATETIME DESC NULLS LAST, TRANSACTION_ID LIMIT 10"


@register("forwarded_queue_flag", _queue_sql())
def forwarded_queue_flag(spark, sf):
    tx = fx.tx(spark, sf).withColumn(flt.FORWARDED, (F.col("TRANSACTION_ID") % 10 == 0).cast("int"))
    return flt.second_level_queue(tx).select("TRANSACTION_ID")


@register("forwarded_queue_boolean", _queue_sql())
def forwarded_queue_boolean(spark, sf):
    tx = fx.tx(spark, sf).withColumn(flt.FORWARDED, F.col("TRANSACTION_ID") % 10 == 0)
    return flt.second_level_queue(tx).select("TRANSACTION_ID")


@register("centroid_of_dimension", "SELECT avg(c_nationkey) AS latitude, avg(c_custkey) AS longitude FROM customer")
def centroid_of_dimension(spark, sf):
    c = fx.load(spark, sf, "customer").select(F.col("c_nationkey").alias("latitude"), F.col("c_custkey").alias("longitude"))
    return agg.centroid(c)


@register(
    "recall_by_joined_id",
    f"WITH {CURVE_SQL},\n{PRED_SQL},\ncm AS (SELECT TX_FRAUD_SCENARIO, {CONF} FROM pred WHERE TX_FRAUD_SCENARIO IN (1, 2, 3) GROUP BY 1)\n"
    "SELECT TX_FRAUD_SCENARIO, tp + fn AS n_pos, tp, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall FROM cm",
    views=("scored",),
)
def recall_by_joined_id(spark, sf):
    """Predictions as a table of ids, joined to their source rows."""
    s = fx.scored(spark, sf)
    thr = m.best_threshold(m.pr_curve(s)).select("threshold").scalar()
    predictions = m.predict_at(s, thr).select("TRANSACTION_ID", "PRED")
    return m.recall_by_scenario(m.align(predictions, fx.tx(spark, sf)))


@register(
    "search_top5",
    "SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TX_AMOUNT, TX_FRAUD FROM tx WHERE CAST(TX_DATETIME AS DATE) IN (DATE '2024-01-10', DATE '2024-01-12')\n"
    "ORDER BY TX_AMOUNT DESC NULLS LAST, TRANSACTION_ID LIMIT 5",
)
def search_top5(spark, sf):
    """The largest of the searched transactions, not of all."""
    found = flt.search_transactions(fx.tx(spark, sf), days=["2024-01-10", "2024-01-12"])
    return out(top_transactions(found))
