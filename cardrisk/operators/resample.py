"""Synthetic minority rows between nearest neighbours (2.K K4).

The smaller class is filled up to the size of the larger one.  Every synthetic row stands on the
segment from a minority row to one of its ``k`` nearest minority rows.  The rows to
make are dealt evenly over the minority rows, the first ones by hash get one more; neighbour and place
on the segment come from an md5 of ``id:copy:seed``, so any engine and any partitioning gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.operators.neighbours import nearest
from cardrisk.operators.sampling import with_rank
from cardrisk.schema import TRANSACTION_ID, TX_FRAUD
from cardrisk.session import passing_scratch, scratch_path, shuffles_dropped, written

NEIGHBOURS = 5
SOURCE, COPY, OTHER, GAP = "SMOTE_SOURCE", "SMOTE_COPY", "SMOTE_NEIGHBOUR", "SMOTE_GAP"


def _digits(id_col: Column, copy: Column, seed: int, start: int, n: int) -> Column:
    """``n`` hex digits of the row's md5 as a number."""
    text = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), copy.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(text, start, n), 16, 10).cast("bigint")


def synthetic_rows(df: DataFrame, features: Sequence[str], label: str = TX_FRAUD, id_col: str = TRANSACTION_ID,
                   k: int = NEIGHBOURS, seed: int = 42, minority: int = 1) -> DataFrame:
    """The synthetic rows of class ``minority`` alone: the features as doubles, the label and where each row comes from.

    No minority row, or as many as others: no rows.  A single minority row is repeated as it is (no neighbour, gap 0).
    """
    size = df.agg(F.count(F.when(F.col(label) == minority, 1)).alias("few"), F.count(F.when(F.col(label) != minority, 1)).alias("many")).first()
    few, make = size["few"], size["many"] - size["few"]
    rows = with_rank(df.filter(F.col(label) == minority).select(id_col, label, *features), label, seed, id_col)
    near = nearest(rows, features, k, id_col)
    share, more = divmod(make, few) if few and make > 0 else (0, 0)
    each = near.withColumn("_copies", F.lit(share).cast("bigint") + (F.col("_rank") <= more).cast("bigint")).filter("_copies > 0")
    each = each.withColumn(COPY, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    n = F.size("neighbours")
    pick = F.when(n > 0, F.pmod(_digits(F.col(id_col), F.col(COPY), seed, 1, 8), n)).cast("int")
    each = each.withColumn("_other", F.when(n > 0, F.element_at("neighbours", pick + 1)))
    gap = F.when(n > 0, _digits(F.col(id_col), F.col(COPY), seed, 9, 13) / F.lit(float(1 << 52))).otherwise(0.0)
    each = each.withColumn(GAP, gap)
    values = []
    for i, c in enumerate(features):
        a = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        values.append(F.when(n > 0, a + F.col(GAP) * (F.col("_other")["v"][i] - a)).otherwise(a).alias(c))
    return each.select(F.col(id_col).alias(SOURCE), COPY, F.col("_other")[id_col].alias(OTHER), GAP, F.col(label).cast("int").alias(label), *values)


def smote(df: DataFrame, features: Sequence[str], label: str = TX_FRAUD, id_col: str = TRANSACTION_ID,
          k: int = NEIGHBOURS, seed: int = 42, minority: int = 1) -> DataFrame:
    """``features`` (doubles) and the label of all given rows and of the synthetic ones."""
    given = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features], F.col(label).cast("int").alias(label))
    path = scratch_path(df.sparkSession, "smote")
    with passing_scratch(df.sparkSession), shuffles_dropped(df.sparkSession):
        made = written(synthetic_rows(df, features, label, id_col, k, seed, minority).select(*features, label), "smote", path)
    return given.unionByName(made)
