"""Test views over the driver tables, as Spark plans and as DuckDB SQL text.

``tx`` maps the ``events`` table onto the transaction model, ``tx_orders``
maps ``orders`` (whole-day timestamps, so real ties and years of history),
``feat`` is the stage-one feature table and ``scored`` adds a deterministic
score for the metric operators.  The SQL text of each view is inlined as a
CTE by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.schema import (
    CUSTOMER_ID,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_DATETIME,
    TX_FRAUD,
    TX_FRAUD_SCENARIO,
    TX_TIME_DAYS,
    TX_TIME_SECONDS,
    US,
)
from cardrisk.session import ensure_conf, table_path

# Origin of TX_TIME_SECONDS / TX_TIME_DAYS in the fixture
# (2024-01-01 00:00:00 UTC in microseconds).
FIXTURE_START_US = 1704067200000000


# Table handles per session, like catalog tables: the file listing and
# footer read happen once; DataFrames are immutable, so sharing is safe
# (``clear_tables()`` after the files change).
_TABLES: dict[tuple, DataFrame] = {}


def clear_tables() -> None:
    _TABLES.clear()


def _cached(spark: SparkSession, key: tuple, make) -> DataFrame:
    ensure_conf(spark)
    k = (id(spark), spark.sparkContext.applicationId, *key)
    if k not in _TABLES:
        _TABLES[k] = make()
    return _TABLES[k]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _cached(spark, ("table", sf_dir, name), lambda: spark.read.parquet(table_path(sf_dir, name)))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cached(spark, ("tx", sf_dir), lambda: tx_from_events(load(spark, sf_dir, "events")))


def tx_from_events(ev: DataFrame) -> DataFrame:
    """Map event rows onto the transaction model (works on batch and streaming frames)."""
    ts = F.col("ts").cast("timestamp")
    since = f"(unix_micros(cast(ts as timestamp)) - {FIXTURE_START_US})"
    return ev.select(
        F.col("event_id").alias(TRANSACTION_ID),
        ts.alias(TX_DATETIME),
        F.col("user_id").alias(CUSTOMER_ID),
        F.get_json_object("props", "$.k").cast("bigint").alias(TERMINAL_ID),
        F.col("value").alias(TX_AMOUNT),
        F.expr(f"{since} div 1000000").alias(TX_TIME_SECONDS),
        F.expr(f"cast({since} div 86400000000 as int)").alias(TX_TIME_DAYS),
        (F.col("event_type") == "error").cast("int").alias(TX_FRAUD),
        F.when(F.col("event_type") == "error", F.lit(1) + F.col("event_id") % 3)
        .otherwise(F.lit(0))
        .cast("int")
        .alias(TX_FRAUD_SCENARIO),
        F.unix_micros(ts).alias(US),
    )


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    ts = F.col("o_orderdate").cast("timestamp")
    return o.select(
        F.col("o_orderkey").alias(TRANSACTION_ID),
        ts.alias(TX_DATETIME),
        F.col("o_custkey").alias(CUSTOMER_ID),
        (F.col("o_orderkey") % 100).alias(TERMINAL_ID),
        F.col("o_totalprice").alias(TX_AMOUNT),
        (F.col("o_orderstatus") == "P").cast("int").alias(TX_FRAUD),
        F.unix_micros(ts).alias(US),
    )


def feat(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Stage-one features over ``tx`` (no day filter, no null fill)."""
    from cardrisk.plans.features import stage1_features

    return stage1_features(tx(spark, sf_dir), min_day=None, fill_zero=False, **kw)


def score_expr():
    # Integer arithmetic first and one division last, so every engine
    # produces the same double.
    return (F.col(TX_FRAUD) * 300 + (F.col(TRANSACTION_ID) * 7919) % 700) / 1000


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx(spark, sf_dir).withColumn("SCORE", score_expr())


# ---------------------------------------------------------------- SQL text

TX_SQL = """
SELECT event_id AS TRANSACTION_ID, ts AS TX_DATETIME, user_id AS CUSTOMER_ID,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS TERMINAL_ID,
       value AS TX_AMOUNT,
       (epoch_us(ts) - 1704067200000000) // 1000000 AS TX_TIME_SECONDS,
       CAST((epoch_us(ts) - 1704067200000000) // 86400000000 AS INTEGER) AS TX_TIME_DAYS,
       CAST(event_type = 'error' AS INTEGER) AS TX_FRAUD,
       CAST(CASE WHEN event_type = 'error' THEN 1 + event_id % 3 ELSE 0 END AS INTEGER) AS TX_FRAUD_SCENARIO,
       epoch_us(ts) AS us
FROM events
"""

TX_ORDERS_SQL = """
SELECT o_orderkey AS TRANSACTION_ID, o_orderdate AS TX_DATETIME, o_custkey AS CUSTOMER_ID,
       o_orderkey % 100 AS TERMINAL_ID, o_totalprice AS TX_AMOUNT,
       CAST(o_orderstatus = 'P' AS INTEGER) AS TX_FRAUD, epoch_us(o_orderdate) AS us
FROM orders
"""

FEAT_SQL = """
SELECT *,
  CAST(isodow(TX_DATETIME) >= 6 AS INTEGER) AS TX_DURING_WEEKEND,
  CAST(hour(TX_DATETIME) <= 6 AS INTEGER) AS TX_DURING_NIGHT,
  count(TX_AMOUNT) OVER c1 AS CUSTOMER_ID_NB_TX_1DAY_WINDOW,
  CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) OVER c1 AS DOUBLE) / nullif(count(TX_AMOUNT) OVER c1, 0) AS CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW,
  count(TX_AMOUNT) OVER c7 AS CUSTOMER_ID_NB_TX_7DAY_WINDOW,
  CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) OVER c7 AS DOUBLE) / nullif(count(TX_AMOUNT) OVER c7, 0) AS CUSTOMER_ID_AVG_AMOUNT_7DAY_WINDOW,
  count(TX_AMOUNT) OVER c30 AS CUSTOMER_ID_NB_TX_30DAY_WINDOW,
  CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) OVER c30 AS DOUBLE) / nullif(count(TX_AMOUNT) OVER c30, 0) AS CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW,
  count(TX_FRAUD) OVER t1 AS TERMINAL_ID_NB_TX_1DAY_WINDOW,
  coalesce(CAST(sum(TX_FRAUD) OVER t1 AS DOUBLE) / nullif(count(TX_FRAUD) OVER t1, 0), 0) AS TERMINAL_ID_RISK_1DAY_WINDOW,
  count(TX_FRAUD) OVER t7 AS TERMINAL_ID_NB_TX_7DAY_WINDOW,
  coalesce(CAST(sum(TX_FRAUD) OVER t7 AS DOUBLE) / nullif(count(TX_FRAUD) OVER t7, 0), 0) AS TERMINAL_ID_RISK_7DAY_WINDOW,
  count(TX_FRAUD) OVER t30 AS TERMINAL_ID_NB_TX_30DAY_WINDOW,
  coalesce(CAST(sum(TX_FRAUD) OVER t30 AS DOUBLE) / nullif(count(TX_FRAUD) OVER t30, 0), 0) AS TERMINAL_ID_RISK_30DAY_WINDOW
FROM tx
WINDOW
  c1  AS (PARTITION BY CUSTOMER_ID ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW),
  c7  AS (PARTITION BY CUSTOMER_ID ORDER BY us RANGE BETWEEN 604799999999 PRECEDING AND CURRENT ROW),
  c30 AS (PARTITION BY CUSTOMER_ID ORDER BY us RANGE BETWEEN 2591999999999 PRECEDING AND CURRENT ROW),
  t1  AS (PARTITION BY TERMINAL_ID ORDER BY us RANGE BETWEEN 691199999999 PRECEDING AND 604800000000 PRECEDING),
  t7  AS (PARTITION BY TERMINAL_ID ORDER BY us RANGE BETWEEN 1209599999999 PRECEDING AND 604800000000 PRECEDING),
  t30 AS (PARTITION BY TERMINAL_ID ORDER BY us RANGE BETWEEN 3196799999999 PRECEDING AND 604800000000 PRECEDING)
"""

SCORED_SQL = """
SELECT *, (TX_FRAUD * 300 + (TRANSACTION_ID * 7919) % 700) / 1000 AS SCORE FROM tx
"""

VIEWS = {"tx": TX_SQL, "tx_orders": TX_ORDERS_SQL, "feat": FEAT_SQL, "scored": SCORED_SQL}
DEPENDS = {"feat": ("tx",), "scored": ("tx",)}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the named views (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
