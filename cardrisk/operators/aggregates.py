"""Aggregations for monitoring (2.D).

All are ``groupBy`` aggregates (partial aggregation before the shuffle, so a
hot group costs one row per map task).  Data-dependent constants (minimum,
maximum, latest day) are scalar subqueries.  Money means are exact decimal
sums divided once, so they do not depend on the order of additions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.functions.calendar import day_name, hour_of, iso_day, tx_date
from cardrisk.functions.scalar import safe_corr
from cardrisk.operators.metrics import running_totals
from cardrisk.operators.rolling import money
from cardrisk.schema import (
    CUSTOMER_ID,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_DATETIME,
    TX_FRAUD,
    TX_TIME_DAYS,
)

# Labels of the two classes.
CLASS_LABELS = {0: "Normal", 1: "Betrug"}
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def mean_money(col: str = TX_AMOUNT, scale: int | None = 2) -> Column:
    """Exact mean of a money column: decimal sum, cast once, divided by the count.

    More digits than ``scale`` are an error; ``scale=None`` sums the column as it is.
    """
    return F.try_divide(F.sum(money(col, scale)).cast("double"), F.count(col))


def rate(col: str = TX_FRAUD) -> Column:
    """Share of 1s among non-null values (exact integer sum / count)."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def daily_kpis(df: DataFrame, ts: str = TX_DATETIME, approx_customers: bool = False, amount_scale: int | None = 2) -> DataFrame:
    """Per calendar day: transactions, frauds, mean amount, customers, tx per customer,
    fraud change against the calendar day before (absent day = 0).

    ``approx_customers`` counts customers with a HyperLogLog sketch (bounded
    state per day) instead of an exact distinct count.
    """
    customers = F.approx_count_distinct(CUSTOMER_ID) if approx_customers else F.countDistinct(CUSTOMER_ID)
    daily = df.groupBy(tx_date(ts).alias("TX_DATE")).agg(
        F.count(F.lit(1)).alias("n_tx"),
        F.coalesce(F.sum(TX_FRAUD), F.lit(0)).cast("bigint").alias("n_fraud"),
        mean_money(scale=amount_scale).alias("mean_amount"),
        customers.alias("n_customers"),
    )
    return with_day_change(daily)


def with_day_change(daily: DataFrame) -> DataFrame:
    """Transactions per customer and the fraud change against the calendar day before."""
    # One row per calendar day (bounded by the calendar, not the data): a lag
    # over the ordered days finds the day before without scanning twice.
    w = Window.orderBy("TX_DATE")
    prev_is_yesterday = F.lag("TX_DATE").over(w) == F.date_sub("TX_DATE", 1)
    prev = F.when(prev_is_yesterday, F.lag("n_fraud").over(w)).otherwise(F.lit(0))
    return daily.select(
        "TX_DATE", "n_tx", "n_fraud", "mean_amount", "n_customers",
        F.coalesce(F.try_divide(F.col("n_tx").cast("double"), F.col("n_customers")), F.lit(0.0)).alias("tx_per_customer"),
        (F.col("n_fraud") - prev).alias("fraud_delta"),
    )


def summary(df: DataFrame, amount_scale: int | None = 2) -> DataFrame:
    """Count, mean amount, fraud share in percent, distinct customers (one row)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_tx"),
        mean_money(scale=amount_scale).alias("mean_amount"),
        (rate() * 100).alias("fraud_pct"),
        F.countDistinct(CUSTOMER_ID).alias("n_customers"),
    )


def fraud_summary(df: DataFrame) -> DataFrame:
    """Total, frauds, fraud ratio in percent (0 on empty input)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_tx"),
        F.coalesce(F.sum(F.when(F.col(TX_FRAUD) == 1, 1)), F.lit(0)).cast("bigint").alias("n_fraud"),
    ).withColumn("fraud_pct", F.coalesce(F.try_divide(F.col("n_fraud").cast("double"), F.col("n_tx")) * 100, F.lit(0.0)))


def class_domain(spark) -> DataFrame:
    return spark.createDataFrame(
        [(k, v) for k, v in CLASS_LABELS.items()],
        T.StructType([T.StructField(TX_FRAUD, T.IntegerType()), T.StructField("label", T.StringType())]),
    )


def class_counts(df: DataFrame) -> DataFrame:
    """Count per class, with both classes present (0 when absent) and labelled."""
    counts = df.groupBy(TX_FRAUD).agg(F.count(F.lit(1)).alias("n"))
    dom = F.broadcast(class_domain(df.sparkSession))
    return dom.join(counts, TX_FRAUD, "left").select(TX_FRAUD, "label", F.coalesce("n", F.lit(0)).alias("n"))


def fraud_rate_by_day(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    return df.groupBy(tx_date(ts).alias("TX_DATE")).agg((rate() * 100).alias("fraud_pct"))


def fraud_count_by_day(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    return df.filter(F.col(TX_FRAUD) == 1).groupBy(iso_day(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_fraud"))


def fraud_count_by_dayno(df: DataFrame) -> DataFrame:
    return df.filter(F.col(TX_FRAUD) == 1).groupBy(TX_TIME_DAYS).agg(F.count(F.lit(1)).alias("n_fraud"))


def hours(spark) -> DataFrame:
    return spark.range(24).select(F.col("id").cast("int").alias("hour"))


def fraud_by_hour_filled(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    """Frauds per hour of day, all 24 hours present (0 when none)."""
    counts = df.filter(F.col(TX_FRAUD) == 1).groupBy(hour_of(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return hours(df.sparkSession).join(counts, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n_fraud"))


def tx_by_hour(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    return df.groupBy(hour_of(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n_tx"))


def fraud_rate_by_hour(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    return df.groupBy(hour_of(ts).alias("hour")).agg(rate().alias("fraud_rate"))


def fraud_rate_by_weekday(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    return df.groupBy(day_name(ts).alias("weekday")).agg(rate().alias("fraud_rate"))


def _extent(df: DataFrame, col: str) -> tuple[Column, Column]:
    ext = df.select(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))).scalar()
    return ext.getField("lo"), ext.getField("hi")


def amount_histogram(df: DataFrame, col: str = TX_AMOUNT, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum falls in the last bin."""
    lo, hi = _extent(df, col)
    w = (hi - lo) / bins
    b = F.coalesce(F.least(F.floor(F.try_divide(F.col(col) - lo, w)), F.lit(bins - 1)), F.lit(0)).cast("bigint")
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_lo", lo + F.col("bin") * w)
        .withColumn("bin_hi", lo + (F.col("bin") + 1) * w)
    )


def fraud_rate_by_amount_bin(df: DataFrame, col: str = TX_AMOUNT, bins: int = 10) -> DataFrame:
    """Fraud rate per equal-width, right-closed amount bin; the first bin also takes the minimum."""
    lo, hi = _extent(df, col)
    w = (hi - lo) / bins
    b = F.coalesce(
        F.least(F.greatest(F.ceil(F.try_divide(F.col(col) - lo, w)), F.lit(1)), F.lit(bins)), F.lit(1)
    ).cast("bigint")
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(b.alias("bin"))
        .agg(rate().alias("fraud_rate"), F.count(F.lit(1)).alias("n"))
        .withColumn("bin_lo", lo + (F.col("bin") - 1) * w)
        .withColumn("bin_hi", lo + F.col("bin") * w)
    )


def amount_quartiles_by_class(df: DataFrame, col: str = TX_AMOUNT, digits: int = 6) -> DataFrame:
    """Box statistics per class: exact linear-interpolation quartiles.

    Values are counted, the counts run up over range partitions, and the values at
    the ranks around each quartile are picked; no class is gathered anywhere.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(TX_FRAUD, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    run = running_totals(counts, ["_v"], ["_n"], by=[TX_FRAUD])
    cols, n = {}, F.col("total__n")
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        at = (n - 1) * F.lit(q)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (rank < F.col("cum__n")) & (rank >= F.col("cum__n") - F.col("_n"))
            cols[f"_{name}_{side}"] = F.max(F.when(holds, F.col("_v")))
        cols[f"_{name}_w"] = F.max(at - F.floor(at))
    box = run.groupBy(TX_FRAUD).agg(F.max(n).alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"), *[c.alias(k) for k, c in cols.items()])

    def quartile(name: str) -> Column:
        lo, hi, w = (F.col(f"_{name}_{x}") for x in ("lo", "hi", "w"))
        return F.round(lo * (1 - w) + hi * w, digits).alias(name)

    empty = df.select(TX_FRAUD).distinct()
    out = empty.join(box, empty[TX_FRAUD].eqNullSafe(box[TX_FRAUD]), "left")
    return out.select(empty[TX_FRAUD], F.coalesce("n", F.lit(0)).alias("n"), "min", quartile("q1"), quartile("median"), quartile("q3"), "max")


def histogram2d(df: DataFrame, x: str, y: str, bins_x: int = 10, bins_y: int = 10) -> DataFrame:
    """Counts on an equal-width grid over the extents of ``x`` and ``y``."""
    ext = df.select(
        F.struct(
            F.min(x).cast("double").alias("xl"), F.max(x).cast("double").alias("xh"),
            F.min(y).cast("double").alias("yl"), F.max(y).cast("double").alias("yh"),
        )
    ).scalar()
    xl, xh, yl, yh = (ext.getField(k) for k in ("xl", "xh", "yl", "yh"))
    wx, wy = (xh - xl) / bins_x, (yh - yl) / bins_y
    bx = F.coalesce(F.least(F.floor(F.try_divide(F.col(x) - xl, wx)), F.lit(bins_x - 1)), F.lit(0)).cast("bigint")
    by = F.coalesce(F.least(F.floor(F.try_divide(F.col(y) - yl, wy)), F.lit(bins_y - 1)), F.lit(0)).cast("bigint")
    return (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(bx.alias("bin_x"), by.alias("bin_y"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weekday_hour_grid(spark) -> DataFrame:
    """The 7 x 24 grid of (weekday number, name, hour), Monday = 0."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    g = spark.range(7 * 24)
    return g.select(
        (F.col("id") / 24).cast("int").alias("weekday_no"),
        (F.col("id") % 24).cast("int").alias("hour"),
    ).withColumn("weekday", F.element_at(names, F.col("weekday_no") + 1))


def customer_weekday_hour(df: DataFrame, customer_id: int, ts: str = TX_DATETIME) -> DataFrame:
    """One customer's transactions per (weekday, hour), the full 7 x 24 grid with 0."""
    c = df.filter(F.col(CUSTOMER_ID) == customer_id)
    counts = c.groupBy(F.weekday(ts).alias("weekday_no"), hour_of(ts).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    grid = weekday_hour_grid(df.sparkSession)
    return grid.join(counts, ["weekday_no", "hour"], "left").select(
        "weekday_no", "weekday", "hour", F.coalesce("n", F.lit(0)).alias("n_tx")
    )


def weekday_hour_counts(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    """Transactions per (customer, weekday, hour) for all customers (observed cells only)."""
    return df.groupBy(CUSTOMER_ID, F.weekday(ts).alias("weekday_no"), hour_of(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("n_tx")
    )


def customer_weekday_hour_pivot(df: DataFrame, customer_id: int, ts: str = TX_DATETIME) -> DataFrame:
    """Wide form: one row per weekday, one column per hour 0..23."""
    c = df.filter(F.col(CUSTOMER_ID) == customer_id)
    wide = c.withColumn("_h", hour_of(ts)).groupBy(F.weekday(ts).alias("weekday_no")).pivot("_h", list(range(24))).count()
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday_no"))
    return days.join(wide, "weekday_no", "left").fillna(0)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    drop = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def corr_with_label(df: DataFrame, label: str = TX_FRAUD, columns: Sequence[str] | None = None, digits: int = 9) -> DataFrame:
    """Pearson correlation of every numeric column with the label (one pass, long form)."""
    cols = list(columns) if columns is not None else numeric_columns(df, exclude=(label,))
    wide = df.agg(*[safe_corr(c, label).alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "corr")
    return long.withColumn("corr", F.round(F.col("corr"), digits))


def corr_top(df: DataFrame, n: int = 20, **kw) -> DataFrame:
    c = corr_with_label(df, **kw)
    return c.orderBy(F.abs("corr").desc_nulls_last(), F.col("feature")).limit(n)


def class_weight(df: DataFrame, label: str = TX_FRAUD) -> DataFrame:
    """Class sizes and the negative/positive ratio (a class weight for positives)."""
    return df.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("n_neg"),
        F.count(F.when(F.col(label) == 1, 1)).alias("n_pos"),
    ).withColumn("neg_pos_ratio", F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos")))


def check_first10(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    """Data check: the first 10 transactions in time with weekday and hour, and the fraud total."""
    total = df.select(F.coalesce(F.sum(TX_FRAUD), F.lit(0)).cast("bigint")).scalar()
    first = df.orderBy(F.col(ts).asc_nulls_last(), F.col(TRANSACTION_ID)).limit(10)
    return first.select(
        TRANSACTION_ID, ts, F.weekday(ts).alias("weekday"), hour_of(ts).alias("hour"), total.alias("fraud_total")
    )


def filter_domain(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    """Distinct days (latest first) with the amount extent of the data."""
    lo, hi = _extent(df, TX_AMOUNT)
    days = df.select(tx_date(ts).alias("TX_DATE")).filter(F.col("TX_DATE").isNotNull()).distinct()
    return days.select("TX_DATE", lo.alias("min_amount"), hi.alias("max_amount")).orderBy(F.col("TX_DATE").desc())


def centroid(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.agg(F.avg(lat).alias(lat), F.avg(lon).alias(lon))
