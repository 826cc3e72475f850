"""Dimension joins, null fill, code labels, one-hot (2.C, H15).

Dimension tables (customers, terminals) grow with the business, so nothing is
broadcast by hand: AQE turns a join into a broadcast from measured bytes or
splits it when one key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.functions.scalar import scenario_label
from cardrisk.operators.metrics import running_totals
from cardrisk.schema import CUSTOMER_ID, TERMINAL_ID, TX_FRAUD_SCENARIO

def strip_index_column(df: DataFrame) -> DataFrame:
    """Drop a stray CSV index column ('Unnamed: 0' or '_c0')."""
    return df.drop("Unnamed: 0", "_c0")


def enrich_dimensions(
    tx: DataFrame,
    customers: DataFrame,
    terminals: DataFrame,
    customer_key: str = CUSTOMER_ID,
    terminal_key: str = TERMINAL_ID,
    fill: float | None = -999,
) -> DataFrame:
    """Left-join customer and terminal attributes; fill numeric nulls with ``fill``."""
    c = strip_index_column(customers)
    t = strip_index_column(terminals)
    if customer_key != CUSTOMER_ID:
        c = c.withColumnRenamed(customer_key, CUSTOMER_ID)
    if terminal_key != TERMINAL_ID:
        t = t.withColumnRenamed(terminal_key, TERMINAL_ID)
    d = strip_index_column(tx)
    d = d.join(c, CUSTOMER_ID, "left")
    d = d.join(t, TERMINAL_ID, "left")
    return fill_numeric(d, fill) if fill is not None else d


def fill_numeric(df: DataFrame, value: float) -> DataFrame:
    """Null → value for numeric columns only (strings and times stay NULL)."""
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            cols[f.name] = F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType))
    return df.withColumns(cols)


def with_scenario_label(df: DataFrame, code: str = TX_FRAUD_SCENARIO) -> DataFrame:
    return df.withColumn("SCENARIO_LABEL", scenario_label(code))


def category_values(df: DataFrame, col: str) -> list:
    """Sorted distinct values of a column, read now: the fitted vocabulary of a one-hot."""
    return [r[0] for r in df.select(col).distinct().filter(F.col(col).isNotNull()).orderBy(col).collect()]


def vocabulary(df: DataFrame, col: str) -> DataFrame:
    """``value, index``: the different values of a column, numbered from 0 in their order; a table, however many there are."""
    values = df.select(F.col(col).alias("value")).filter(F.col(col).isNotNull()).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(values, ["value"], ["_one"]).select("value", (F.col("cum__one") - 1).alias("index"))


def one_hot_sparse(df: DataFrame, col: str, words: DataFrame, out: str = "one_hot") -> DataFrame:
    """Adds a sparse 0/1 vector with a place for every value of the fitted ``vocabulary`` and one more.

    Values that the vocabulary lacks, and nulls, have their 1 in the last place.  The driver learns the number of values alone.
    """
    size = words.count()
    index, value = free_column("_index", df.columns), free_column("_value", df.columns)
    d = df.join(words.select(F.col("value").alias(value), F.col("index").alias(index)), F.col(col) == F.col(value), "left").drop(value)
    d = d.withColumn(index, F.coalesce(F.col(index), F.lit(size)).cast("double"))
    sizes = df.sparkSession.range(size, size + 1).select(F.col("id").cast("double").alias(index))  # the encoder learns its width from the greatest index
    return OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=False).fit(sizes).transform(d).drop(index)


def free_column(name: str, columns: Sequence[str]) -> str:
    """``name``, with underscores before it as long as a column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def one_hot(df: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    """0/1 indicator columns ``<col>_<value>`` for the listed values of each column.

    The values are fitted once (``category_values`` of the training data or of the
    dimension table), so every input gets the same columns; other values and nulls are 0 in all.
    """
    out = df
    for c, vals in values.items():
        out = out.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)) for v in vals}).drop(c)
    return out
