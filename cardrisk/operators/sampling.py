"""Reproducible stratified splits (2.K K3).

Rows of a label are ranked by the md5 of ``'id:seed'`` and cut by rank, so every
part has its exact share of every label, on any engine and any partitioning.
The rank is distributed: hash prefixes are buckets, the buckets' counts run up, and
a row is numbered within its bucket.  No label is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.schema import TRANSACTION_ID, TX_FRAUD

PREFIX_DIGITS = 4  # hex digits of a bucket: 65536 of them


def hash_order(id_col: str = TRANSACTION_ID, seed: int = 42) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))


def with_rank(df: DataFrame, label: str, seed: int, id_col: str = TRANSACTION_ID) -> DataFrame:
    """Add ``_rank`` (from 1, by hash within the label) and ``_size`` (rows of the label)."""
    d = df.withColumn("_h", hash_order(id_col, seed)).withColumn("_b", F.substring("_h", 1, PREFIX_DIGITS))
    counts = d.groupBy(F.col(label).alias("_l"), F.col("_b").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_l").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # 16**PREFIX_DIGITS rows at most
    offsets = counts.select("_l", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"), F.sum("_n").over(Window.partitionBy("_l")).alias("_size"))
    w = Window.partitionBy(label, "_b").orderBy("_h", id_col)
    d = d.withColumn("_r", F.row_number().over(w)).join(F.broadcast(offsets), F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_p")))
    return d.withColumn("_rank", F.col("_o") + F.col("_r")).drop("_h", "_b", "_l", "_p", "_o", "_r")


def stratified_split(
    df: DataFrame, test: float = 0.2, valid: float = 0.1, seed: int = 42, id_col: str = TRANSACTION_ID, label: str = TX_FRAUD
) -> DataFrame:
    """Add ``split`` in {'test', 'valid', 'train'}; ``valid`` is the share of the non-test rows.

    Shares are rounded to whole rows for every label, half up.
    """
    d = with_rank(df, label, seed, id_col)
    n_test = F.floor(F.col("_size") * F.lit(float(test)) + 0.5)
    n_valid = F.floor((F.col("_size") - n_test) * F.lit(float(valid)) + 0.5)
    split = F.when(F.col("_rank") <= n_test, "test").when(F.col("_rank") <= n_test + n_valid, "valid").otherwise("train")
    return d.withColumn("split", split).drop("_rank", "_size")


def fold_column(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = TRANSACTION_ID, label: str = TX_FRAUD) -> DataFrame:
    """Fold number 0..k-1 for cross-validation: ranks within the label dealt out in turn."""
    return with_rank(df, label, seed + 1, id_col).withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_size")
