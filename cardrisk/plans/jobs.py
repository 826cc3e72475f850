"""Batch jobs: features, train (fit or load, evaluate, store), score new data.

Run with ``python -m cardrisk <job> ...`` (or ``spark-submit``).  Every input
is a path or a DataFrame; outputs are folders (overwrite), so a rerun after
a failure writes the same result.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.operators import metrics as m
from cardrisk.operators.filters import filter_date_range
from cardrisk.plans import model as mdl
from cardrisk.plans.features import build_features
from cardrisk.schema import RISK_DELAY_DAYS, TX_DATETIME, WINDOWS_DAYS
from cardrisk.sources import readers, sinks


def features_job(spark: SparkSession, source, out: str, min_day: int | None = 30, begin=None, end=None,
                 stage2: bool = False, fmt: str = "parquet", preview_out: str | None = None) -> DataFrame:
    """Stage-one (optionally stage-two) features of a transaction source, written to ``out``."""
    tx = readers.as_dataframe(spark, source)
    if begin is not None or end is not None:
        tx = filter_date_range(tx, begin or "0001-01-01", end or "9999-12-31")
    feats = build_features(tx, stage2=stage2, min_day=min_day, fill_zero=True)
    sinks.write_features(feats, out, fmt)
    if preview_out:
        sinks.write_preview(spark.read.format(fmt).load(out) if fmt == "parquet" else feats, preview_out)
    return feats


def refresh_days(spark: SparkSession, days: str, out: str, first: dt.date, last: dt.date, lookback_days: int = RISK_DELAY_DAYS + max(WINDOWS_DAYS), **how) -> None:
    """Stage-one features of the days from ``first`` to ``last`` anew, from a day-partitioned table.

    Only their folders and those of the ``lookback_days`` before are read (the longest window's reach), and only their
    folders under ``out`` are replaced; a day that has no rows any more keeps its old folder.
    """
    rows = readers.read_daily_partitions(spark, days, first - dt.timedelta(days=lookback_days), last)
    feats = build_features(rows.drop("TX_DATE"), stage2=False, **how).withColumn("TX_DATE", F.to_date(TX_DATETIME))
    feats = feats.filter(F.col("TX_DATE").between(F.lit(first), F.lit(last)))
    feats.repartitionByRange("TX_DATE", TX_DATETIME).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("TX_DATE").parquet(out)


def train_job(spark: SparkSession, source, model_dir: str, metrics_out: str | None = None, seed: int = 42,
              class_weight: bool = False, grid: dict | None = None, folds: int = mdl.CV_FOLDS, retrain: bool = False, **params) -> dict:
    """Search (with a grid), fit on train rows, threshold on validation, metrics on test; or load.

    A model that is stored already is loaded and evaluated on the same test rows; ``retrain`` fits anew.
    The fitted model's feature importance goes to ``<model_dir>/importance``.
    """
    tx = readers.as_dataframe(spark, source)
    if not retrain and mdl.stored(model_dir, spark):
        model, threshold = mdl.load(model_dir, spark)
        mat, _, _ = mdl.matrix(tx, seed)
        test_pred = m.predict_at(mdl.score(model, mat.filter("split = 'test'")), threshold)
    else:
        model, thr, test_pred, feats, stats = mdl.train_eval(tx, seed=seed, class_weight=class_weight, grid=grid, folds=folds, **params)
        threshold = thr.first()["threshold"]
        spark.createDataFrame(mdl.feature_importance(model, feats), "feature string, importance double").coalesce(1).write.mode("overwrite").parquet(f"{model_dir}/importance")
        mdl.save(model, threshold, model_dir, spark, feats, stats)
    metrics = m.binary_metrics(test_pred).first().asDict()
    curve = m.pr_curve(test_pred)
    metrics["roc_auc"] = m.roc_auc(curve).first()["roc_auc"]
    metrics["average_precision"] = m.average_precision(curve).first()["average_precision"]
    metrics["threshold"] = threshold
    if metrics_out:
        spark.createDataFrame([metrics]).write.mode("overwrite").json(metrics_out)
    return metrics


def score_job(spark: SparkSession, model_dir: str, new_source, history_source, out: str, fmt: str = "csv") -> DataFrame:
    """Score new transactions with a stored model; history gives the windows their past."""
    model, threshold = mdl.load(model_dir, spark)
    feats = [r[0] for r in spark.read.parquet(f"{model_dir}/features").collect()]  # bounded: one row per feature
    stats = spark.read.parquet(f"{model_dir}/terminal_stats")
    new = readers.as_dataframe(spark, new_source)
    history = readers.as_dataframe(spark, history_source)
    preds = mdl.score_new(model, threshold, new, history, feats, stats).drop(m.SCORE)
    sinks.write_predictions(preds, out, fmt)
    return preds


def main(argv: list[str] | None = None) -> None:
    from cardrisk.session import get_session

    ap = argparse.ArgumentParser(prog="cardrisk")
    sub = ap.add_subparsers(dest="job", required=True)
    f = sub.add_parser("features")
    f.add_argument("source")
    f.add_argument("out")
    f.add_argument("--min-day", type=int, default=30)
    f.add_argument("--begin")
    f.add_argument("--end")
    f.add_argument("--stage2", action="store_true")
    f.add_argument("--preview-out")
    t = sub.add_parser("train")
    t.add_argument("source")
    t.add_argument("model_dir")
    t.add_argument("--metrics-out")
    t.add_argument("--class-weight", action="store_true")
    t.add_argument("--search", action="store_true", help="cross-validated search over the whole grid first")
    t.add_argument("--retrain", action="store_true", help="fit anew although a model is stored")
    t.add_argument("--max-iter", type=int, default=100)
    t.add_argument("--max-depth", type=int, default=5)
    s = sub.add_parser("score")
    s.add_argument("model_dir")
    s.add_argument("new_source")
    s.add_argument("history_source")
    s.add_argument("out")
    a = ap.parse_args(argv)
    spark = get_session()
    if a.job == "features":
        features_job(spark, a.source, a.out, a.min_day, a.begin, a.end, a.stage2, preview_out=a.preview_out)
    elif a.job == "train":
        res = train_job(spark, a.source, a.model_dir, a.metrics_out, class_weight=a.class_weight,
                        grid=mdl.GRID if a.search else None, retrain=a.retrain, maxIter=a.max_iter, maxDepth=a.max_depth)
        print(json.dumps(res, default=str))
    else:
        score_job(spark, a.model_dir, a.new_source, a.history_source, a.out)
