"""End-to-end batch jobs on the small fixture: features, train + store, score with history."""

import os

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.plans import jobs
from conftest import SF_SMALL


def test_features_train_score(spark, tmp_dir):
    tx = fx.tx(spark, SF_SMALL).drop("us")
    feats = jobs.features_job(spark, tx, os.path.join(tmp_dir, "feat"), min_day=7,
                              preview_out=os.path.join(tmp_dir, "preview"))
    back = spark.read.parquet(os.path.join(tmp_dir, "feat"))
    assert back.count() == tx.filter("TX_TIME_DAYS >= 7").count()
    assert back.filter(F.col("CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW").isNull()).count() == 0  # null fill
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "preview")).count() == 50
    past, new = tx.filter("TX_TIME_DAYS < 22"), tx.filter("TX_TIME_DAYS >= 22").drop("TX_FRAUD", "TX_FRAUD_SCENARIO")
    res = jobs.train_job(spark, past, os.path.join(tmp_dir, "model"), os.path.join(tmp_dir, "metrics"), maxIter=5, maxDepth=3)
    assert 0 <= res["roc_auc"] <= 1 and 0 <= res["threshold"] <= 1
    again = jobs.train_job(spark, past, os.path.join(tmp_dir, "model"), maxIter=1)  # loads: the parameters have no effect
    assert again == res
    assert spark.read.parquet(os.path.join(tmp_dir, "model", "importance")).count() > 10
    preds = jobs.score_job(spark, os.path.join(tmp_dir, "model"), new, past, os.path.join(tmp_dir, "pred"))
    assert preds.count() == new.count()
    assert feats is not None
