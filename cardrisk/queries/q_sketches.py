"""Date ranges answered from stored day sketches (2.D D1, D12), with their error against the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators import day_sketches as ds
from cardrisk.queries.registry import register
from cardrisk.schema import CUSTOMER_ID, TX_AMOUNT, TX_DATETIME, TX_FRAUD
from cardrisk.session import scratch_path

SPAN = 7
_RANGES = f"r AS (SELECT DISTINCT CAST(TX_DATETIME AS DATE) AS \"first\", CAST(TX_DATETIME AS DATE) + {SPAN - 1} AS \"last\" FROM tx WHERE TX_DATETIME IS NOT NULL)"


def _stored(spark, sf):
    """The sketches, written and read back, and every range of seven days that begins on a day of the table."""
    sketches = spark.read.parquet(ds.write_day_sketches(fx.tx(spark, sf), scratch_path(spark, "day-sketches")))
    days = sketches.select(F.col("TX_DATE").alias("first")).distinct()
    return sketches, days.withColumn("last", F.date_add("first", SPAN - 1))


def _rows(spark, sf, ranges):
    """The rows themselves by range, to hold the sketches against."""
    tx = fx.tx(spark, sf).withColumn("_d", F.to_date(TX_DATETIME))
    return tx.join(F.broadcast(ranges), F.col("_d").between(F.col("first"), F.col("last")))


@register(
    "range_kpis_from_sketches",
    f"WITH {_RANGES}\nSELECT r.\"first\", r.\"last\", count(*) AS n_tx, CAST(coalesce(sum(TX_FRAUD), 0) AS BIGINT) AS n_fraud,\n"
    "  CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(TX_AMOUNT), 0) AS mean_amount, TRUE AS customers_within_4_percent\n"
    "FROM tx JOIN r ON CAST(TX_DATETIME AS DATE) BETWEEN r.\"first\" AND r.\"last\" GROUP BY 1, 2",
)
def range_kpis_from_sketches(spark, sf):
    """KPIs of every seven days; whether the estimated customers are within 4 % (five standard errors) of their number."""
    sketches, ranges = _stored(spark, sf)
    exact = _rows(spark, sf, ranges).groupBy("first", "last").agg(F.countDistinct(CUSTOMER_ID).alias("_n"))
    found = ds.range_kpis(sketches, ranges).join(exact, ["first", "last"])
    close = F.abs(F.col("n_customers") - F.col("_n")) <= F.greatest(0.04 * F.col("_n"), F.lit(0.5))
    return found.select("first", "last", "n_tx", "n_fraud", "mean_amount", close.alias("customers_within_4_percent"))


@register(
    "range_boxes_from_sketches",
    f"WITH {_RANGES}\nSELECT r.\"first\", r.\"last\", TX_FRAUD, count(TX_AMOUNT) AS n, min(TX_AMOUNT) AS min, max(TX_AMOUNT) AS max, TRUE AS quartiles_within_2_percent\n"
    "FROM tx JOIN r ON CAST(TX_DATETIME AS DATE) BETWEEN r.\"first\" AND r.\"last\" GROUP BY 1, 2, 3",
)
def range_boxes_from_sketches(spark, sf):
    """Box statistics of every seven days by class; whether each quartile's rank among the rows is within 2 % of its share."""
    sketches, ranges = _stored(spark, sf)
    boxes = ds.range_boxes(sketches, ranges)
    rows = _rows(spark, sf, ranges).filter(F.col(TX_AMOUNT).isNotNull()).select("first", "last", TX_FRAUD, TX_AMOUNT)
    quartiles = list(ds.QUARTILES)
    below = [F.count(F.when(F.col(TX_AMOUNT) < F.col(q), 1)).alias(f"_lt_{q}") for q in quartiles] + [F.count(F.when(F.col(TX_AMOUNT) <= F.col(q), 1)).alias(f"_le_{q}") for q in quartiles]
    ranks = rows.join(F.broadcast(boxes.select("first", "last", TX_FRAUD, *quartiles)), ["first", "last", TX_FRAUD]).groupBy("first", "last", TX_FRAUD).agg(*below)
    close = F.lit(True)
    for q, share in ds.QUARTILES.items():  # the share lies between the rows under the quartile and those up to it, give or take
        slack = 0.02 * F.col("n") + 1
        close &= (F.col(f"_lt_{q}") <= share * F.col("n") + slack) & (F.col(f"_le_{q}") >= share * F.col("n") - slack)
    return boxes.join(ranks, ["first", "last", TX_FRAUD]).select("first", "last", TX_FRAUD, "n", "min", "max", close.alias("quartiles_within_2_percent"))
