"""Sources and sinks (2.A) as write-then-read round trips, and the detail card (H16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators.detail import history_card
from cardrisk.queries.q_aggregates import feat1
from cardrisk.queries.registry import out, register
from cardrisk.schema import TRANSACTIONS
from cardrisk.session import scratch_path
from cardrisk.sources import readers, sinks

TX_COLS = [f.name for f in TRANSACTIONS.fields]


@register("src_csv_roundtrip", "SELECT " + ", ".join(TX_COLS) + " FROM tx")
def src_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "tx_csv")
    sinks.write_table(fx.tx(spark, sf).select(*TX_COLS), path, "csv")
    return out(readers.read_transactions_csv(spark, path))


@register("sink_features_roundtrip", "SELECT * FROM feat", views=("feat",))
def sink_features_roundtrip(spark, sf):
    path = scratch_path(spark, "features")
    sinks.write_features(feat1(spark, sf), path)
    return out(spark.read.parquet(path))


@register("preview_first_n", "SELECT * FROM feat ORDER BY TX_DATETIME NULLS LAST, TRANSACTION_ID LIMIT 50", views=("feat",))
def preview_first_n(spark, sf):
    f = feat1(spark, sf)
    path = scratch_path(spark, "preview")
    sinks.write_preview(f, path, n=50, fmt="csv")
    back = (
        spark.read.option("header", True)
        .option("timestampFormat", readers.TS_FORMAT)
        .schema(f.schema)
        .csv(path)
    )
    return out(back)


@register(
    "daily_partition_counts",
    "SELECT CAST(DATE '2024-01-01' + TX_TIME_DAYS AS DATE) AS TX_DATE, count(*) AS n_tx, min(TX_TIME_SECONDS) AS first_second FROM tx GROUP BY 1",
)
def daily_partition_counts(spark, sf):
    path = scratch_path(spark, "daily")
    sinks.write_daily_partitions(fx.tx(spark, sf), path, start="2024-01-01")
    back = spark.read.parquet(path)
    return back.groupBy("TX_DATE").agg(F.count(F.lit(1)).alias("n_tx"), F.min("TX_TIME_SECONDS").alias("first_second"))


def _detail_sql(tid: int | None = None) -> str:
    where = f" WHERE TRANSACTION_ID = {tid}" if tid is not None else ""
    parts = []
    for n in (1, 7, 30):
        parts.append(
            f"SELECT TRANSACTION_ID, TX_AMOUNT, {n} AS window_days, CUSTOMER_ID_NB_TX_{n}DAY_WINDOW AS cust_nb_tx,\n"
            f"  CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW AS cust_avg_amount, TERMINAL_ID_NB_TX_{n}DAY_WINDOW AS term_nb_tx,\n"
            f"  TERMINAL_ID_RISK_{n}DAY_WINDOW AS term_risk,\n"
            "  CASE WHEN CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW <> 0 THEN (TX_AMOUNT - CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW)\n"
            "    / CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW * 100 WHEN CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW = 0 THEN 0.0 END AS amount_pct_dev_30d\n"
            f"FROM feat{where}"
        )
    return "\nUNION ALL\n".join(parts)


@register("tx_detail", _detail_sql(), views=("feat",))
def tx_detail_q(spark, sf):
    """The history card of every transaction (three rows each); ``tx_detail`` gives one."""
    return history_card(feat1(spark, sf))
