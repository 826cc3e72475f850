"""Sources (2.A): transactions, dimensions, metric history, coordinates.

Every reader takes a declared schema (no inference pass over the data) and
raises on a missing path unless told otherwise; read errors are never
swallowed.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.schema import COORDS, METRIC_HISTORY, SINGLE_METRIC_HISTORY, TRANSACTION_ID, TRANSACTIONS, TX_AMOUNT
from cardrisk.session import ensure_conf

# Timestamps keep microseconds in text files.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
TS_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_transactions_csv(spark: SparkSession, path, schema: T.StructType = TRANSACTIONS, mixed_headers: bool = False) -> DataFrame:
    """Transactions from CSV with a header, typed by ``schema``; a stray index column is dropped.

    Every file's header is checked against the first one's, and another column order is an
    error.  ``mixed_headers`` maps the columns by name for each file instead (one more pass
    for the headers).  NaN amounts become NULL (pandas treats NaN as missing).
    """
    ensure_conf(spark)
    if mixed_headers:
        df = _csv_by_name(spark, path, schema)
    else:
        # the header decides the column order; known columns get the declared
        # type, others (a stray index column) are read as text
        header = spark.read.option("header", True).csv(path).columns
        known = {f.name: f for f in schema.fields}
        typed = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
        df = (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("timestampFormat", TS_FORMAT)
            .option("mode", "FAILFAST")
            .schema(typed)
            .csv(path)
        )
        df = df.drop("Unnamed: 0", "_c0")
    if TX_AMOUNT in df.columns:
        df = df.withColumn(TX_AMOUNT, F.when(F.isnan(TX_AMOUNT), None).otherwise(F.col(TX_AMOUNT)))
    return df


def _csv_by_name(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` from files whose headers differ in order; a missing column is NULL."""
    width = len(spark.read.csv(path).columns)
    text = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(max(width, len(schema) + 1))])
    raw = spark.read.schema(text).csv(path).select(F.array(*text.fieldNames()).alias("v"), F.col("_metadata.file_path").alias("file"))
    is_header = F.array_contains("v", F.lit(TRANSACTION_ID))
    headers = raw.filter(is_header).select(F.col("file").alias("of"), F.col("v").alias("names"))  # one row for each file
    rows = raw.filter(~F.coalesce(is_header, F.lit(False))).join(headers, F.col("file") == F.col("of"))

    def column(f: T.StructField):
        value = F.try_element_at("v", F.nullif(F.array_position("names", F.lit(f.name)), F.lit(0)).cast("int"))
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.to_timestamp(value, TS_FORMAT).cast(f.dataType).alias(f.name)
        return value.cast(f.dataType).alias(f.name)

    return rows.select(*[column(f) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet (default) or CSV by extension; used for dimension tables."""
    ensure_conf(spark)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if path.endswith(".csv"):
        return r.option("header", True).option("inferSchema", schema is None).csv(path).drop("Unnamed: 0", "_c0")
    return r.parquet(path)


def as_dataframe(spark: SparkSession, source) -> DataFrame:
    """Source dispatch: a DataFrame is used as is, a path is read by its extension."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str):
        if source.endswith(".csv"):
            return read_transactions_csv(spark, source)
        return read_table(spark, source)
    raise TypeError(f"unsupported source {type(source).__name__}")


def read_metric_history(
    spark: SparkSession, path: str, schema: T.StructType = METRIC_HISTORY, missing_ok: bool = True
) -> DataFrame:
    """Metric history CSV; repeated headers and blank lines are dropped.

    A missing file gives an empty frame with the schema when ``missing_ok``.
    """
    ensure_conf(spark)
    try:
        df = spark.read.option("header", True).option("mode", "DROPMALFORMED").schema(schema).csv(path)
        df.schema  # resolve the path now
    except Exception as e:  # noqa: BLE001
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise
    # a repeated header parses its numeric fields as NULL under DROPMALFORMED
    # only when those fields are read, so filter on them explicitly
    numeric = [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]
    cond = F.lit(True)
    for c in numeric:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def read_single_metric_history(spark: SparkSession, path: str) -> DataFrame:
    return read_metric_history(spark, path, SINGLE_METRIC_HISTORY)


def read_coords(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of {latitude, longitude} objects, one row per element."""
    ensure_conf(spark)
    return spark.read.schema(COORDS).option("multiLine", True).json(path)


def cached(df: DataFrame) -> DataFrame:
    """Keep a loaded table for repeated dashboard queries (memory, spilling to disk).

    Call ``df.unpersist()`` to force a fresh read.
    """
    from pyspark import StorageLevel

    return df.persist(StorageLevel.MEMORY_AND_DISK)


class TimedTable:
    """A loaded table kept for repeated queries, loaded again once it is ``seconds`` old.

    ``get`` gives the kept frame; frames handed out before stay valid, as Spark reads their files again.
    """

    def __init__(self, load: Callable[[], DataFrame], seconds: float = 60.0, clock: Callable[[], float] = time.monotonic):
        self.load, self.seconds, self.clock = load, seconds, clock
        self._kept: DataFrame | None = None
        self._since = 0.0

    def get(self) -> DataFrame:
        if self._kept is None or self.clock() - self._since >= self.seconds:
            self.drop()
            self._kept, self._since = cached(self.load()), self.clock()
        return self._kept

    def drop(self) -> None:
        """Forget the kept table; the next ``get`` loads it."""
        if self._kept is not None:
            self._kept.unpersist()
            self._kept = None


def read_daily_partitions(spark: SparkSession, path: str, first=None, last=None, ts: str = "TX_DATETIME") -> DataFrame:
    """Read a day-partitioned table; a day range prunes partitions (folders) before any file is opened.

    Spark does not derive ``TX_DATE`` predicates from ``TX_DATETIME`` ones, so
    both are written here.
    """
    import datetime as dt

    ensure_conf(spark)
    df = spark.read.parquet(path)
    if first is not None:
        f = dt.date.fromisoformat(first) if isinstance(first, str) else first
        df = df.filter((F.col("TX_DATE") >= F.lit(f)) & (F.col(ts) >= F.lit(dt.datetime(f.year, f.month, f.day))))
    if last is not None:
        d = dt.date.fromisoformat(last) if isinstance(last, str) else last
        nxt = dt.datetime(d.year, d.month, d.day) + dt.timedelta(days=1)
        df = df.filter((F.col("TX_DATE") <= F.lit(d)) & (F.col(ts) < F.lit(nxt)))
    return df
