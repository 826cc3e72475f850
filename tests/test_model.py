"""MLlib model plan: fit, threshold, scoring, importance, store/load, grid search."""

from pyspark.sql import functions as F

from cardrisk import fixtures as fx
from cardrisk.operators.group_stats import fit_terminal_stats
from cardrisk.operators.sampling import fold_column, stratified_split
from cardrisk.plans import model as mdl
from cardrisk.plans.features import build_features, feature_columns, feature_matrix
from cardrisk.queries import q_model
from cardrisk.session import SHUFFLE_CLEANUP
from conftest import SF_SMALL
from helpers import scratch_of_its_own

PARAMS = {"maxIter": 5, "maxDepth": 3}


def test_train_eval_and_store(spark, tmp_dir):
    tx = fx.tx(spark, SF_SMALL)
    model, thr, test_pred, feats, stats = mdl.train_eval(tx, **PARAMS)
    t = thr.first()
    assert 0 <= t["threshold"] <= 1
    n = test_pred.count()
    assert n > 0 and test_pred.filter(F.col("SCORE").between(0, 1)).count() == n
    imp = mdl.feature_importance(model, feats)
    assert len(imp) == len(feats) and abs(sum(v for _, v in imp) - 1) < 1e-6
    assert not mdl.stored(f"{tmp_dir}/m", spark)
    mdl.save(model, t["threshold"], f"{tmp_dir}/m", spark, feats, stats)
    m2, t2 = mdl.load(f"{tmp_dir}/m", spark)
    assert t2 == t["threshold"] and mdl.stored(f"{tmp_dir}/m", spark)


def test_split_is_exact_for_every_label(spark):
    d = stratified_split(fx.tx(spark, SF_SMALL), test=0.2, valid=0.1)
    counts = {(r["TX_FRAUD"], r["split"]): r["count"] for r in d.groupBy("TX_FRAUD", "split").count().collect()}
    for label in {k for k, _ in counts}:
        n = sum(c for (k, _), c in counts.items() if k == label)
        test = int(n * 0.2 + 0.5)
        assert counts.get((label, "test"), 0) == test and counts.get((label, "valid"), 0) == int((n - test) * 0.1 + 0.5)
    folds = fold_column(d, 5).groupBy("TX_FRAUD", "fold").count().groupBy("TX_FRAUD").agg((F.max("count") - F.min("count")).alias("gap")).collect()
    assert all(r["gap"] <= 1 for r in folds)


def test_every_new_row_is_scored_alike_in_any_batch(spark):
    tx = fx.tx(spark, SF_SMALL)
    past, new = tx.filter("TX_TIME_DAYS < 20"), tx.filter("TX_TIME_DAYS >= 20").drop("TX_FRAUD")
    model, thr, _, feats, stats = mdl.train_eval(past, **PARAMS)
    t = thr.first()["threshold"]
    odd = new.limit(3).withColumn("CUSTOMER_ID", F.lit(None).cast("long")).unionByName(new.limit(2).withColumn("TERMINAL_ID", F.lit(None).cast("long")))
    odd = odd.withColumn("TRANSACTION_ID", F.col("TRANSACTION_ID") + 10**9)
    every = mdl.score_new(model, t, new.unionByName(odd), past, feats, stats)
    assert every.count() == new.count() + 5
    assert set(every.columns) == {"TRANSACTION_ID", "SCORE", "PREDICTED_FRAUD"} and every.filter("SCORE between 0 and 1").count() == every.count()
    # the same rows in a small batch, the others given as history, the small batch itself among them
    few = new.filter("TRANSACTION_ID % 7 = 0")
    alone = mdl.score_new(model, t, few, past.unionByName(new, allowMissingColumns=True), feats, stats)
    whole = {r[0]: (r[1], r[2]) for r in mdl.score_new(model, t, new, past, feats, stats).collect()}
    got = {r[0]: (r[1], r[2]) for r in alone.collect()}
    assert got and all(whole[i] == v for i, v in got.items())


def _counted(spark, rows):
    """The rows again, and how many were computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def look(row):
        seen.add(1)
        return row

    return spark.createDataFrame(rows.rdd.map(look), rows.schema, verifySchema=False), seen


def test_matrix_and_scores_compute_their_rows_once_or_twice(spark):
    """The split reads its rows twice (counts, ranks), scoring its history (look-back, last rows); features, probe and statistics read what is written."""
    tx = fx.tx(spark, SF_SMALL)
    n = tx.count()
    counted, seen = _counted(spark, tx)
    mat, feats, stats = mdl.matrix(counted)
    assert mat.count() == n and stats.count() > 0 and seen.value <= 2 * n
    train = tx.join(mat.filter("split = 'train'").select("TRANSACTION_ID"), "TRANSACTION_ID")
    assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, fit_terminal_stats(train).collect()))
    model = mdl.fit(mat.filter("split = 'train'"), feats, maxIter=2, maxDepth=2, seed=1)
    past, new = tx.filter("TX_TIME_DAYS < 20"), tx.filter("TX_TIME_DAYS >= 20").drop("TX_FRAUD", "TX_FRAUD_SCENARIO")
    history, seen = _counted(spark, past)
    fresh, again = _counted(spark, new)
    assert mdl.score_new(model, 0.5, fresh, history, feats, stats).count() == new.count()
    assert seen.value <= 2 * past.count() and again.value == new.count()


def test_grid_search_small(spark):
    d = build_features(fx.tx(spark, SF_SMALL))
    mat = feature_matrix(d, exclude=mdl.EXCLUDE, keep=["TRANSACTION_ID"])
    feats = feature_columns(d, mdl.EXCLUDE)
    best, results = mdl.grid_search(mat, feats, grid={"maxDepth": (2, 3), "maxIter": (3,)}, folds=2, parallelism=2)
    assert len(results) == 2 and best in [r[0] for r in results] and all(0 <= a <= 1 for _, a in results)


def test_class_weight(spark):
    w = mdl.with_class_weight(fx.tx(spark, SF_SMALL))
    r = w.groupBy("TX_FRAUD").agg(F.max("weight").alias("w")).orderBy("TX_FRAUD").collect()
    assert r[0]["w"] == 1.0 and r[1]["w"] > 1.0


def test_first_trees_score_as_a_shorter_fit(spark):
    """A stored ensemble cut to its first trees scores what a fit of that many trees scores."""
    mat, feats, _ = mdl.matrix(fx.tx(spark, SF_SMALL))
    rows, valid = mat.filter("split = 'train'"), mat.filter("split = 'valid'")
    model = mdl.fit(rows, feats, maxIter=6, maxDepth=3, seed=7)
    for n in (1, 4):
        short = mdl.fit(rows, feats, maxIter=n, maxDepth=3, seed=7)
        cut = mdl.first_trees(model, n)
        assert cut.stages[-1].getNumTrees == n
        a = {r[0]: r[1] for r in mdl.score(cut, valid).select("TRANSACTION_ID", "SCORE").collect()}
        assert a == {r[0]: r[1] for r in mdl.score(short, valid).select("TRANSACTION_ID", "SCORE").collect()}
    assert mdl.first_trees(model, 6) is model
    for how in ({"class_weight": True}, {"resample": True}):
        final = mdl.final_fit(mat, feats, **{"class_weight": False, **how}, maxIter=6, maxDepth=3, seed=7)
        assert final.stages[-1].getNumTrees == mdl.best_prefix(final, valid)


def test_final_fit_fits_once(spark, monkeypatch):
    calls = []
    own = mdl.fit
    monkeypatch.setattr(mdl, "fit", lambda *a, **k: calls.append(1) or own(*a, **k))
    mat, feats, _ = mdl.matrix(fx.tx(spark, SF_SMALL))
    mdl.final_fit(mat, feats, maxIter=4, maxDepth=2, seed=1)
    assert len(calls) == 1


def test_out_of_fold_rows_and_no_leak(spark, monkeypatch):
    """Each row is scored once a setting, and no fit sees a row of the fold it scores, not as an end of a synthetic row either."""
    from cardrisk.operators import resample as rs

    mat, feats, _ = mdl.matrix(fx.tx(spark, SF_SMALL))
    train = mat.filter("split = 'train'")
    seen = []
    own = rs.synthetic_rows
    monkeypatch.setattr(rs, "synthetic_rows", lambda df, *a, **k: seen.append({r[0] for r in df.select("TRANSACTION_ID").collect()}) or own(df, *a, **k))
    scored = mdl.out_of_fold(train, feats, {"maxDepth": (2, 3), "maxIter": (2,)}, 2, resample=True)
    rows = [tuple(r) for r in scored.select("setting", "TRANSACTION_ID", "fold").collect()]
    ids = {r[0] for r in train.select("TRANSACTION_ID").collect()}
    assert len(rows) == 2 * len(ids) and {(s, i) for s, i, _ in rows} == {(s, i) for s in (0, 1) for i in ids}
    fold = {i: k for _, i, k in rows}
    assert len(seen) == 2 and all({fold[i] for i in part} == {1 - k} for k, part in enumerate(seen))


def test_out_of_fold_keeps_little_on_disk(spark, monkeypatch):
    """Only the table of scores stays of a search; a fold is balanced and fitted after the other, many rows one setting at a time."""
    import threading

    mat, feats, _ = mdl.matrix(fx.tx(spark, SF_SMALL))
    train = mat.filter("split = 'train'")
    left, running, most, rows_of, lock = scratch_of_its_own(spark, monkeypatch), [], [], [], threading.Lock()
    own = mdl.fit

    def fit(rows, *a, **k):
        with lock:
            running.append(1)
            most.append(len(running))
        rows_of.append([x for x in left() if x not in ("passing", "out-of-fold")])
        try:
            return own(rows, *a, **k)
        finally:
            with lock:
                running.pop()

    monkeypatch.setattr(mdl, "fit", fit)
    monkeypatch.setattr(mdl, "AT_ONCE_ROWS", 1, raising=False)
    clean_up = spark.conf.get(SHUFFLE_CLEANUP)
    scored = mdl.out_of_fold(train, feats, {"maxDepth": (2, 3), "maxIter": (2,)}, 2, resample=True)
    assert max(most) == 1 and len(most) == 4
    assert rows_of == [["folds", "smote"]] * 4  # nothing of the neighbours, nor of the fold before
    assert left() == ["out-of-fold"]
    assert scored.count() == 2 * train.count() and spark.conf.get(SHUFFLE_CLEANUP) == clean_up


def test_matrix_keeps_itself_alone(spark, monkeypatch):
    left = scratch_of_its_own(spark, monkeypatch)
    mat, _, stats = mdl.matrix(fx.tx(spark, SF_SMALL))
    assert left() == ["matrix"]
    assert mat.count() == fx.tx(spark, SF_SMALL).count() and stats.count() > 0


def test_final_fit_reads_even_parts(spark, monkeypatch):
    """However the matrix is cut into files, each core has as many rows of the fit as another."""
    mat, feats, _ = mdl.matrix(fx.tx(spark, SF_SMALL))
    sizes = []
    own = mdl.fit

    def fit(rows, *a, **k):
        sizes.extend(r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect())
        return own(rows, *a, **k)

    monkeypatch.setattr(mdl, "fit", fit)
    monkeypatch.setattr(mdl, "PART_ROWS", 50, raising=False)
    cores, train = spark.sparkContext.defaultParallelism, mat.filter("split = 'train'").count()
    mdl.final_fit(mat, feats, class_weight=False, maxIter=2, maxDepth=2, seed=1)
    assert sum(sizes) == train and len(sizes) == min(3 * cores, train // 50) > cores and max(sizes) - min(sizes) <= 4
    monkeypatch.undo()
    assert mdl.in_even_parts(mat).rdd.getNumPartitions() == 1  # few rows: one part
    assert mdl.in_even_parts(mat.limit(0)).count() == 0


def test_score_batch_scores_compared_rows_alone(spark, tmp_dir, monkeypatch):
    """Of the whole history's rows those with an id of the new ones; a new id that is in the past too has a row for each, as the join gives."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    tx = fx.tx_from_events(ev)
    past, new = tx.filter("TX_TIME_DAYS < 23"), tx.filter("TX_TIME_DAYS >= 23")
    old, late = past.agg(F.min("TRANSACTION_ID")).first()[0], new.agg(F.max("TRANSACTION_ID")).first()[0]
    ev = ev.withColumn("event_id", F.when(F.col("event_id") != old, F.col("event_id")).otherwise(F.lit(late)))
    ev.coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    scored = []
    own = mdl.score
    monkeypatch.setattr(mdl, "score", lambda model, df: scored.append(df) or own(model, df))
    monkeypatch.setattr(q_model, "PARAMS", {"maxIter": 2, "maxDepth": 2})
    got = q_model.score_batch(spark, tmp_dir)
    ids = [r[0] for r in got.collect()]
    assert len(ids) == new.count() + 1 and sum(i == late for i in ids) == 2
    assert scored[-1].count() == len(ids)
    assert got.filter("TRANSACTION_ID <> " + str(late)).filter("not same_with_whole_history").count() == 0
