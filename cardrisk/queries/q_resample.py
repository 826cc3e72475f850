"""Resampling of the minority class (2.K K4): exact nearest neighbours and the synthetic rows between them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators import resample as rs
from cardrisk.operators.neighbours import nearest
from cardrisk.queries.registry import register
from cardrisk.schema import (
    CUSTOMER_ID, TERMINAL_ID, TRANSACTION_ID, TX_AMOUNT, TX_DURING_NIGHT, TX_DURING_WEEKEND, TX_FRAUD, TX_TIME_DAYS, TX_TIME_SECONDS, WINDOWS_DAYS,
    customer_avg_col, customer_count_col, terminal_count_col, terminal_risk_col,
)

FEATURES = [
    CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS, TX_DURING_WEEKEND, TX_DURING_NIGHT,
    *[c(n) for n in WINDOWS_DAYS for c in (customer_count_col, customer_avg_col, terminal_count_col, terminal_risk_col)],
]

_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURES)
NEAR_SQL = f"""f AS (SELECT TRANSACTION_ID, TX_FRAUD, {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in FEATURES)} FROM feat),
m AS (SELECT * FROM f WHERE TX_FRAUD = 1),
near AS (SELECT a.TRANSACTION_ID AS id, b.TRANSACTION_ID AS other, {_D2} AS d2,
    row_number() OVER (PARTITION BY a.TRANSACTION_ID ORDER BY {_D2}, b.TRANSACTION_ID) AS rank
  FROM m a JOIN m b ON a.TRANSACTION_ID <> b.TRANSACTION_ID QUALIFY rank <= {rs.NEIGHBOURS})"""


@register("smote_neighbours", f"WITH {NEAR_SQL}\nSELECT id AS TRANSACTION_ID, CAST(rank AS INTEGER) AS rank, other AS neighbour, d2 FROM near", views=("feat",))
def smote_neighbours(spark, sf):
    """The five nearest frauds of every fraud, over all stage-one features."""
    frauds = fx.feat(spark, sf).filter(F.col(TX_FRAUD) == 1).select(TRANSACTION_ID, *FEATURES)
    near = nearest(frauds, FEATURES, rs.NEIGHBOURS, TRANSACTION_ID)
    each = near.select(TRANSACTION_ID, F.posexplode("neighbours").alias("rank", "n"))
    return each.select(TRANSACTION_ID, (F.col("rank") + 1).alias("rank"), F.col("n")[TRANSACTION_ID].alias("neighbour"), F.col("n.d2").alias("d2"))


_MD5 = f"md5(concat(CAST(id AS VARCHAR), ':', CAST({rs.COPY} AS VARCHAR), ':42'))"


@register(
    "smote_rows",
    f"""WITH {NEAR_SQL},
size AS (SELECT count(*) FILTER (TX_FRAUD = 1) AS few, count(*) FILTER (TX_FRAUD <> 1) - count(*) FILTER (TX_FRAUD = 1) AS make FROM f),
ranked AS (SELECT TRANSACTION_ID AS id, row_number() OVER (ORDER BY md5(concat(CAST(TRANSACTION_ID AS VARCHAR), ':42')), TRANSACTION_ID) AS rank FROM m),
copies AS (SELECT id, unnest(range(1, CAST(make // few + CASE WHEN rank <= make % few THEN 1 ELSE 0 END AS BIGINT) + 1)) AS {rs.COPY} FROM ranked, size WHERE make > 0),
drawn AS (SELECT id, {rs.COPY}, CAST('0x' || substr({_MD5}, 1, 8) AS BIGINT) AS pick, CAST('0x' || substr({_MD5}, 9, 13) AS BIGINT) / CAST({1 << 52} AS DOUBLE) AS {rs.GAP} FROM copies),
many AS (SELECT id, count(*) AS n FROM near GROUP BY id)
SELECT d.id AS {rs.SOURCE}, d.{rs.COPY}, b.TRANSACTION_ID AS {rs.OTHER}, d.{rs.GAP}, 1 AS TX_FRAUD, {', '.join(f'a.{c} + d.{rs.GAP} * (b.{c} - a.{c}) AS {c}' for c in FEATURES)}
FROM drawn d JOIN many USING (id) JOIN near ON near.id = d.id AND near.rank = d.pick % many.n + 1 JOIN m a ON a.TRANSACTION_ID = d.id JOIN m b ON b.TRANSACTION_ID = near.other""",
    views=("feat",),
)
def smote_rows(spark, sf):
    """Every synthetic fraud that fills the class up, with the two rows it stands between."""
    return rs.synthetic_rows(fx.feat(spark, sf), FEATURES)


@register("smote_class_counts", "SELECT TX_FRAUD, max(count(*)) OVER () AS n_rows FROM feat GROUP BY TX_FRAUD", views=("feat",))
def smote_class_counts(spark, sf):
    """Rows of each class after resampling: as many of one as of the other."""
    return rs.smote(fx.feat(spark, sf), FEATURES).groupBy(TX_FRAUD).agg(F.count(F.lit(1)).alias("n_rows"))
