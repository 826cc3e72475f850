"""Model fit and batch scoring (2.K K6/K7/K12).

The score itself is MLlib's; SQL states the rows, their labels and that scores and predictions are in range.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators.group_stats import fitted_stats_lookup
from cardrisk.plans import model as mdl
from cardrisk.plans.features import build_features, feature_matrix
from cardrisk.queries.q_metrics import SPLIT_SQL
from cardrisk.queries.registry import register
from cardrisk.schema import TX_TIME_DAYS
from cardrisk.session import written

PARAMS = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1}


def in_range():
    return F.col("SCORE").between(0, 1).alias("score_in_range")


@register("model_fit_scores", f"{SPLIT_SQL}\nSELECT TRANSACTION_ID, TX_FRAUD, TRUE AS score_in_range, TRUE AS pred_is_0_or_1 FROM s WHERE split = 'test'")
def model_fit_scores(spark, sf):
    """The test rows with their labels; whether score and prediction are in range."""
    test_pred = mdl.train_eval(fx.tx(spark, sf), **PARAMS)[2]
    return test_pred.select("TRANSACTION_ID", "TX_FRAUD", in_range(), F.col("PRED").isin(0, 1).alias("pred_is_0_or_1"))


@register("score_batch", "SELECT TRANSACTION_ID, TRUE AS score_in_range, TRUE AS pred_is_0_or_1, TRUE AS same_with_whole_history FROM tx WHERE TX_TIME_DAYS >= 23")
def score_batch(spark, sf, cut_day: int = 23):
    """Fit on days before ``cut_day``, then score the later days as new data with their history; whether each score is that of
    the whole history at once, without a look-back."""
    tx = written(fx.tx(spark, sf), "tx")
    past = tx.filter(F.col(TX_TIME_DAYS) < cut_day)
    new = tx.filter(F.col(TX_TIME_DAYS) >= cut_day).drop("TX_FRAUD", "TX_FRAUD_SCENARIO")
    model, thr, _, feats, stats = mdl.train_eval(past, **PARAMS)
    threshold = thr.first()["threshold"]
    out = mdl.score_new(model, threshold, new, past, feats, stats)
    # the features of all rows together, as the batch plan makes them; only rows with an id of the new ones are compared, so only they are scored
    again = written(past.select("TRANSACTION_ID").join(new.select("TRANSACTION_ID"), "TRANSACTION_ID", "left_semi").distinct(), "again")
    asked = F.lit(True).alias("_asked")
    rows = past.join(again.select("TRANSACTION_ID", asked), "TRANSACTION_ID", "left").unionByName(new.select("*", asked), allowMissingColumns=True)
    every = build_features(rows, stage2=True).filter("_asked")
    whole = feature_matrix(fitted_stats_lookup(every, stats), exclude=mdl.EXCLUDE, keep=["TRANSACTION_ID"])
    whole = mdl.score(model, whole.select("TRANSACTION_ID", *feats)).select("TRANSACTION_ID", F.col("SCORE").alias("_whole"))
    same = (F.col("SCORE") == F.col("_whole")).alias("same_with_whole_history")
    return out.join(whole, "TRANSACTION_ID", "left").select("TRANSACTION_ID", in_range(), F.col("PREDICTED_FRAUD").isin(0, 1).alias("pred_is_0_or_1"), same)
