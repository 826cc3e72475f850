"""Binary classification metrics as Spark jobs (2.K K8-K11).

Scores are first reduced to one row per distinct score (positives ``p``,
negatives ``n``), so ties are handled exactly.  The precision-recall curve
needs running totals by falling score.  A window ordered over the whole table
would run in one task, so the distinct scores are range-partitioned (as many
ranges as the session has shuffle partitions), each range has its own
ordered window, and the totals of the ranges before it (one row for each range)
are added as an offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.schema import TRANSACTION_ID, TX_FRAUD, TX_FRAUD_SCENARIO
from cardrisk.session import cut_lineage

SCORE = "SCORE"
F1_EPS = 1e-6
# Fixed value: the chosen threshold is scaled down by this factor.
THRESHOLD_FACTOR = 0.85


def score_counts(df: DataFrame, score: str = SCORE, label: str = TX_FRAUD) -> DataFrame:
    """One row per distinct score with its positives and negatives."""
    y = F.col(label).cast("bigint")
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias(SCORE))
        .agg(F.sum(y).alias("p"), F.sum(F.lit(1) - y).alias("n"))
    )


def running_totals(g: DataFrame, order: list[str | Column], cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Add ``cum_<c>`` (sum of ``c`` up to this row in ``order``) and ``total_<c>``, within ``by``.

    Rows must be distinct in ``by`` and ``order``.  The range partitions are written once, so
    that a row's range is the same wherever it is read.
    """
    by = by or []
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    ranges = g.repartitionByRange(*by, *keys).withColumn("_range", F.spark_partition_id())
    ranges = cut_lineage(ranges)
    totals = ranges.groupBy("_range", *by).agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    # one row for each range (and each value of ``by`` in it)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        F.col("_range").alias("_r"), *[F.col(k).alias(f"_k_{k}") for k in by],
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in cols],
        *[F.sum(f"_t_{c}").over(whole).alias(f"total_{c}") for c in cols],
    )
    same = F.col("_range") == F.col("_r")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    w = Window.partitionBy("_range", *by).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    return ranges.join(offsets, same).select(
        *g.columns,
        *[(F.sum(c).over(w) + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in cols],
        *[f"total_{c}" for c in cols],
    )


def pr_curve(df: DataFrame, score: str = SCORE, label: str = TX_FRAUD) -> DataFrame:
    """Per distinct score s: tp, fp (rows with score >= s), precision, recall, F1."""
    g = score_counts(df, score, label)
    c = running_totals(g, [F.col(SCORE).desc()], ["p", "n"])
    c = c.withColumnsRenamed({"cum_p": "tp", "cum_n": "fp", "total_p": "P1", "total_n": "N1"})
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("P1"))
    c = c.withColumns({"precision": prec, "recall": rec})
    return c.withColumn("f1", f1_expr(F.col("precision"), F.col("recall")))


def f1_expr(p: Column, r: Column) -> Column:
    return F.lit(2) * p * r / (p + r + F.lit(F1_EPS))


def average_precision(curve: DataFrame, digits: int = 10) -> DataFrame:
    """Step-wise area under the PR curve: sum over scores of (recall gain) * precision."""
    term = F.try_divide(F.col("p").cast("double"), F.col("P1")) * F.col("precision")
    return curve.agg(F.round(F.sum(term), digits).alias("average_precision"))


def roc_auc(curve: DataFrame) -> DataFrame:
    """Mann-Whitney AUC with ties counted half, from exact integer sums."""
    num = F.sum(F.col("n").cast("decimal(38,0)") * (F.col("tp").cast("decimal(38,0)") * 2 - F.col("p")))
    den = (F.max("P1").cast("decimal(38,0)") * F.max("N1").cast("decimal(38,0)") * 2).cast("double")
    return curve.agg(F.try_divide(num.cast("double"), den).alias("roc_auc"))


def best_threshold(curve: DataFrame, factor: float = THRESHOLD_FACTOR) -> DataFrame:
    """Score with the highest F1 (lowest score on ties), and the applied threshold (x factor)."""
    best = curve.orderBy(F.col("f1").desc_nulls_last(), F.col(SCORE)).limit(1)
    return best.select(
        F.col(SCORE).alias("best_score"),
        F.col("f1").alias("best_f1"),
        (F.col(SCORE) * F.lit(factor)).alias("threshold"),
    )


def predict_at(df: DataFrame, threshold, score: str = SCORE) -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn("PRED", (F.col(score) >= t).cast("int"))


def align(predictions: DataFrame, source: DataFrame, key: str = TRANSACTION_ID) -> DataFrame:
    """Predictions with the columns of their source rows, joined by id; a prediction without a source row stays."""
    extra = [c for c in predictions.columns if c != key]
    return predictions.join(source.drop(*extra), key, "left")


def confusion(df: DataFrame, label: str = TX_FRAUD, pred: str = "PRED", by: list[str] | None = None) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    aggs = [
        F.count(F.when((y == 0) & (p == 0), 1)).alias("tn"),
        F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
        F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"),
        F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b)


def binary_metrics(df: DataFrame, label: str = TX_FRAUD, pred: str = "PRED") -> DataFrame:
    """Precision, recall, F1, FPR, FNR, accuracy and the confusion counts (one row)."""
    c = confusion(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        "tn", "fp", "fn", "tp",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
        _ratio(fp, fp + tn).alias("fpr"),
        _ratio(fn, fn + tp).alias("fnr"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )


def recall_by_scenario(df: DataFrame, scenarios=(1, 2, 3), label: str = TX_FRAUD, pred: str = "PRED",
                       scenario: str = TX_FRAUD_SCENARIO) -> DataFrame:
    d = df.filter(F.col(scenario).isin(list(scenarios)))
    c = confusion(d, label, pred, by=[scenario])
    return c.select(scenario, (F.col("tp") + F.col("fn")).alias("n_pos"), "tp",
                    _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def f1_by_scenario(df: DataFrame, label: str = TX_FRAUD, pred: str = "PRED", scenario: str = TX_FRAUD_SCENARIO) -> DataFrame:
    """F1 per scenario value (0 when undefined)."""
    c = confusion(df, label, pred, by=[scenario])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(scenario, "tp", "fp", "fn", F.coalesce(_ratio(tp * 2, tp * 2 + fp + fn), F.lit(0.0)).alias("f1"))


def class_report(df: DataFrame, label: str = TX_FRAUD, pred: str = "PRED") -> DataFrame:
    """Per class: precision, recall, F1, support; accuracy on every row."""
    c = confusion(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    acc = _ratio(tp + tn, tp + tn + fp + fn)
    # class 1 sees (tp, fp, fn); class 0 sees (tn, fn, fp)
    rows = F.array(
        F.struct(F.lit(0).alias("class"), tn.alias("t"), fn.alias("f_pos"), fp.alias("f_neg"), (tn + fp).alias("support")),
        F.struct(F.lit(1).alias("class"), tp.alias("t"), fp.alias("f_pos"), fn.alias("f_neg"), (tp + fn).alias("support")),
    )
    e = c.select(acc.alias("accuracy"), F.inline(rows))
    t, f_pos, f_neg = F.col("t"), F.col("f_pos"), F.col("f_neg")
    return e.select(
        "class",
        _ratio(t, t + f_pos).alias("precision"),
        _ratio(t, t + f_neg).alias("recall"),
        _ratio(t * 2, t * 2 + f_pos + f_neg).alias("f1"),
        "support",
        "accuracy",
    )


def daily_model_metrics(df: DataFrame, ts: str, label: str = TX_FRAUD, pred: str = "PRED") -> DataFrame:
    """Precision, recall and F1 per calendar day (for monitoring and alerts)."""
    c = confusion(df.withColumn("TX_DATE", F.to_date(ts)), label, pred, by=["TX_DATE"])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        "TX_DATE",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )
