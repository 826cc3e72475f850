"""Model metrics on the deterministic fixture score (2.K K3, K8-K11, H13) with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.functions.scalar import f1_alert
from cardrisk.operators import metrics as m
from cardrisk.operators.sampling import stratified_split
from cardrisk.queries.registry import register

CURVE_SQL = """
g AS (SELECT SCORE, CAST(sum(TX_FRAUD) AS BIGINT) AS p, CAST(sum(1 - TX_FRAUD) AS BIGINT) AS n
      FROM scored WHERE SCORE IS NOT NULL AND TX_FRAUD IS NOT NULL GROUP BY SCORE),
c AS (SELECT SCORE, p, n, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
             CAST(sum(p) OVER () AS BIGINT) AS P1, CAST(sum(n) OVER () AS BIGINT) AS N1
      FROM g WINDOW w AS (ORDER BY SCORE DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pr AS (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / nullif(P1, 0) AS recall FROM c),
curve AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-6) AS f1 FROM pr),
best AS (SELECT SCORE AS best_score, f1 AS best_f1, SCORE * 0.85 AS threshold FROM curve ORDER BY f1 DESC NULLS LAST, SCORE LIMIT 1)
""".strip()

PRED_SQL = "pred AS (SELECT *, CAST(SCORE >= (SELECT threshold FROM best) AS INTEGER) AS PRED FROM scored)"

CONF = (
    "count(CASE WHEN TX_FRAUD = 0 AND PRED = 0 THEN 1 END) AS tn, count(CASE WHEN TX_FRAUD = 0 AND PRED = 1 THEN 1 END) AS fp,\n"
    "  count(CASE WHEN TX_FRAUD = 1 AND PRED = 0 THEN 1 END) AS fn, count(CASE WHEN TX_FRAUD = 1 AND PRED = 1 THEN 1 END) AS tp"
)


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def _curve(spark, sf):
    return m.pr_curve(fx.scored(spark, sf))


def _predicted(spark, sf):
    s = fx.scored(spark, sf)
    thr = m.best_threshold(m.pr_curve(s)).select("threshold").scalar()
    return m.predict_at(s, thr)


@register("pr_curve", f"WITH {CURVE_SQL}\nSELECT SCORE, p, n, tp, fp, precision, recall, P1, N1, f1 FROM curve", views=("scored",))
def pr_curve(spark, sf):
    return _curve(spark, sf)


@register(
    "average_precision",
    f"WITH {CURVE_SQL}\nSELECT round(sum(CAST(p AS DOUBLE) / nullif(P1, 0) * precision), 10) AS average_precision FROM curve",
    views=("scored",),
)
def average_precision(spark, sf):
    return m.average_precision(_curve(spark, sf))


@register(
    "roc_auc",
    f"WITH {CURVE_SQL}\nSELECT CAST(sum(n * (tp * 2 - p)) AS DOUBLE) / CAST(max(P1) * max(N1) * 2 AS DOUBLE) AS roc_auc FROM curve",
    views=("scored",),
)
def roc_auc(spark, sf):
    return m.roc_auc(_curve(spark, sf))


@register("best_threshold", f"WITH {CURVE_SQL}\nSELECT * FROM best", views=("scored",))
def best_threshold(spark, sf):
    return m.best_threshold(_curve(spark, sf))


@register(
    "binary_metrics",
    f"WITH {CURVE_SQL},\n{PRED_SQL},\ncm AS (SELECT {CONF} FROM pred)\n"
    "SELECT tn, fp, fn, tp,\n"
    f"  {_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'tp + fn')} AS recall,\n"
    f"  {_ratio('tp * 2', 'tp * 2 + fp + fn')} AS f1, {_ratio('fp', 'fp + tn')} AS fpr,\n"
    f"  {_ratio('fn', 'fn + tp')} AS fnr, {_ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy FROM cm",
    views=("scored",),
)
def binary_metrics(spark, sf):
    return m.binary_metrics(_predicted(spark, sf))


@register("confusion_matrix", f"WITH {CURVE_SQL},\n{PRED_SQL}\nSELECT {CONF} FROM pred", views=("scored",))
def confusion_matrix(spark, sf):
    return m.confusion(_predicted(spark, sf))


@register(
    "recall_by_scenario",
    f"WITH {CURVE_SQL},\n{PRED_SQL},\ncm AS (SELECT TX_FRAUD_SCENARIO, {CONF} FROM pred WHERE TX_FRAUD_SCENARIO IN (1, 2, 3) GROUP BY 1)\n"
    f"SELECT TX_FRAUD_SCENARIO, tp + fn AS n_pos, tp, {_ratio('tp', 'tp + fn')} AS recall FROM cm",
    views=("scored",),
)
def recall_by_scenario(spark, sf):
    return m.recall_by_scenario(_predicted(spark, sf))


@register(
    "f1_by_scenario",
    f"WITH {CURVE_SQL},\n{PRED_SQL},\ncm AS (SELECT TX_FRAUD_SCENARIO, {CONF} FROM pred GROUP BY 1)\n"
    f"SELECT TX_FRAUD_SCENARIO, tp, fp, fn, coalesce({_ratio('tp * 2', 'tp * 2 + fp + fn')}, 0) AS f1 FROM cm",
    views=("scored",),
)
def f1_by_scenario(spark, sf):
    return m.f1_by_scenario(_predicted(spark, sf))


@register(
    "class_report",
    f"WITH {CURVE_SQL},\n{PRED_SQL},\ncm AS (SELECT {CONF} FROM pred),\n"
    "r AS (SELECT 0 AS class, tn AS t, fn AS f_pos, fp AS f_neg, tn + fp AS support, tn, fp, fn, tp FROM cm\n"
    "      UNION ALL SELECT 1, tp, fp, fn, tp + fn, tn, fp, fn, tp FROM cm)\n"
    f"SELECT class, {_ratio('t', 't + f_pos')} AS precision, {_ratio('t', 't + f_neg')} AS recall,\n"
    f"  {_ratio('t * 2', 't * 2 + f_pos + f_neg')} AS f1, support, {_ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy FROM r",
    views=("scored",),
)
def class_report(spark, sf):
    return m.class_report(_predicted(spark, sf))


@register(
    "metric_alert",
    f"WITH {CURVE_SQL},\n{PRED_SQL},\n"
    f"cm AS (SELECT CAST(TX_DATETIME AS DATE) AS TX_DATE, {CONF} FROM pred GROUP BY 1),\n"
    f"d AS (SELECT TX_DATE, {_ratio('tp', 'tp + fp')} AS precision, {_ratio('tp', 'tp + fn')} AS recall,\n"
    f"  {_ratio('tp * 2', 'tp * 2 + fp + fn')} AS f1 FROM cm)\n"
    "SELECT *, CASE WHEN f1 < 0.75 THEN 'critical' WHEN f1 < 0.85 THEN 'watch' WHEN f1 IS NOT NULL THEN 'ok' END AS alert FROM d",
    views=("scored",),
)
def metric_alert(spark, sf):
    d = m.daily_model_metrics(_predicted(spark, sf), "TX_DATETIME")
    return d.withColumn("alert", f1_alert("f1"))


SPLIT_SQL = """
WITH r AS (SELECT TRANSACTION_ID, TX_FRAUD,
  row_number() OVER (PARTITION BY TX_FRAUD ORDER BY md5(CAST(TRANSACTION_ID AS VARCHAR) || ':42'), TRANSACTION_ID) AS k,
  count(*) OVER (PARTITION BY TX_FRAUD) AS n FROM tx),
c AS (SELECT *, floor(n * CAST(0.2 AS DOUBLE) + 0.5) AS n_test FROM r),
s AS (SELECT TRANSACTION_ID, TX_FRAUD, CASE WHEN k <= n_test THEN 'test'
  WHEN k <= n_test + floor((n - n_test) * CAST(0.1 AS DOUBLE) + 0.5) THEN 'valid' ELSE 'train' END AS split FROM c)
""".strip()


@register("stratified_split", f"{SPLIT_SQL}\nSELECT TRANSACTION_ID, TX_FRAUD, split FROM s")
def stratified_split_q(spark, sf):
    d = stratified_split(fx.tx(spark, sf), test=0.2, valid=0.1, seed=42)
    return d.select("TRANSACTION_ID", "TX_FRAUD", "split")


@register("split_class_balance", f"{SPLIT_SQL}\nSELECT split, TX_FRAUD, count(*) AS n FROM s GROUP BY 1, 2")
def split_class_balance(spark, sf):
    d = stratified_split(fx.tx(spark, sf), test=0.2, valid=0.1, seed=42)
    return d.groupBy("split", "TX_FRAUD").agg(F.count(F.lit(1)).alias("n"))
