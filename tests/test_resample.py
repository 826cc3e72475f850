"""Nearest neighbours against brute force (copies, ties, hot vectors, small blocks), and synthetic rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardrisk.operators import neighbours as nb
from cardrisk.operators.neighbours import nearest
from cardrisk.operators.resample import COPY, GAP, OTHER, SOURCE, smote, synthetic_rows
from cardrisk.operators.sampling import with_rank
from helpers import scratch_of_its_own

COLS = ["a", "b", "c"]


def _rows(n, seed, spread=1000.0):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(size=(n, 3)) * [spread, 1, 30], 2)
    v[: n // 3] = v[0]  # a third of all rows are one vector
    v[n // 3 : n // 3 + 60] = np.round(v[n // 3 : n // 3 + 60] / 500) * 500  # many equal distances
    v[-40:, 0] += 90 * spread  # a far clump, and one row further still
    v[-1, 0] += 1e6
    return [(int(i), *map(float, x)) for i, x in zip(rng.permutation(n), v)]


def _by_hand(rows, k):
    v = np.array([r[1:] for r in rows])
    ids = np.array([r[0] for r in rows])
    out = {}
    for i in range(len(rows)):
        d = np.zeros(len(rows))
        for f in range(3):
            e = v[i, f] - v[:, f]
            d += e * e
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[rows[i][0]] = [(float(d[j]), int(ids[j])) for j in order]
    return out


def _table(spark, rows):
    return spark.createDataFrame(rows, "TRANSACTION_ID long, a double, b double, c double").repartition(3)


def _found(df):
    return {r["TRANSACTION_ID"]: [(x["d2"], x["TRANSACTION_ID"]) for x in r["neighbours"]] for r in df.collect()}


@pytest.mark.parametrize("block, pivots, per_block", [(16, 40, 1), (64, 3, 16), (4096, 4096, 16)])
def test_nearest_is_exact(spark, monkeypatch, block, pivots, per_block):
    monkeypatch.setattr(nb, "PER_BLOCK", per_block)
    monkeypatch.setattr(nb, "HOT", 4)
    rows = _rows(700, 3)
    assert _found(nearest(_table(spark, rows), COLS, 5, "TRANSACTION_ID", block, pivots)) == _by_hand(rows, 5)


def test_nearest_looks_at_few_blocks(spark):
    """On clumped data a vector reaches its own clump's blocks alone."""
    rng = np.random.default_rng(1)
    v = rng.integers(0, 30, (4000, 1)) * [[1e5, 0, 0]] + rng.normal(size=(4000, 3))
    rows = [(i, *map(float, x)) for i, x in enumerate(v)]
    base = _table(spark, rows).select(F.array(*COLS).alias("v"), F.col("TRANSACTION_ID").alias("first"), F.col("TRANSACTION_ID").alias("row"))
    vectors = nb.distinct_vectors(base, 6)
    placed, points = nb.cells(vectors, 4000, 60, 3)
    blocks = nb.blocks(placed, 64)
    own = nb.within_blocks(blocks, points, 6, 3)
    sizes = blocks.agg(F.max("n"), F.count(F.lit(1))).first()
    assert sizes[0] <= 4 * 64
    assert own.filter("need is not null").count() < 4000 * sizes[1] / 10


def _count_distances(monkeypatch):
    """Distances that are computed from now on, as a list of counts."""
    plain, counts = nb.squared, []
    monkeypatch.setattr(nb, "squared", lambda a, b: counts.append(len(a) * len(b)) or plain(a, b))
    return counts


def test_a_vector_is_compared_with_few_pivots(monkeypatch):
    """Nearest pivots and needed blocks are those of all pivots, from a small part of the distances."""
    rng = np.random.default_rng(2)
    points, v = rng.integers(0, 60, (900, 2)).astype(float), np.round(rng.random((3000, 2)) * 60, 1)  # ties among them
    tops = points[:30]
    gaps = np.sqrt(nb.squared(tops, points))
    order = np.argsort(gaps, axis=1, kind="stable")
    all_d2 = nb.squared(v, points)
    counts = _count_distances(monkeypatch)
    cell, d2 = nb._nearest_pivots(v, points, tops, order, np.take_along_axis(gaps, order, 1))
    assert (cell == all_d2.argmin(1)).all() and (d2 == all_d2.min(1)).all()
    assert sum(counts) < all_d2.size / 3
    # a block a pivot: every vector of one small part of the plane
    lo, hi = np.zeros(900), np.full(900, 1.5)
    q = v[(v < 8).all(1)]
    counts.clear()
    who, which, reach = nb._needed(q, np.full(len(q), 2.0), points, np.arange(900), lo, hi, hi, np.arange(900) != 5)
    away = np.sqrt(((q[:, None] - points[None]) ** 2).sum(-1))
    must = away - hi <= np.minimum(2.0, (away + hi).min(1))[:, None]
    must[:, 5] = False
    assert set(zip(*np.nonzero(must))) <= set(zip(who.tolist(), which.tolist())) and len(who) < 1.5 * must.sum()
    assert sum(counts) < len(q) * 900 / 4


def test_cut_cells_make_few_blocks(spark):
    v = np.random.default_rng(3).random((3000, 3))
    base = _table(spark, [(i, *map(float, x)) for i, x in enumerate(v)]).select(F.array(*COLS).alias("v"), F.col("TRANSACTION_ID").alias("first"), F.col("TRANSACTION_ID").alias("row"))
    placed, _ = nb.cells(nb.distinct_vectors(base, 6), 3000, 1, 3)
    cells = placed.groupBy("cell").count().collect()
    found = nb.blocks(placed, 1024, 3000)
    assert found.count() <= sum(-(-r["count"] * nb.RINGS_PER_BLOCK // 1024) + 1 for r in cells)
    assert found.agg(F.sum("n")).first()[0] == 3000


def test_nearest_edges(spark):
    few = [(1, 0.0, 0.0, 0.0), (2, 3.0, 4.0, 0.0), (2, 3.0, 4.0, 0.0), (None, 0.0, None, -0.0)]
    got = sorted((r["TRANSACTION_ID"] or 0, [(x["d2"], x["TRANSACTION_ID"]) for x in r["neighbours"]]) for r in nearest(_table(spark, few), COLS, 2, "TRANSACTION_ID").collect())
    assert got == [(0, [(0.0, 1), (25.0, 2)]), (1, [(0.0, None), (25.0, 2)]), (2, [(0.0, 2), (25.0, 1)]), (2, [(0.0, 2), (25.0, 1)])]
    assert [r["neighbours"] for r in nearest(_table(spark, few[:1]), COLS, 5, "TRANSACTION_ID").collect()] == [[]]
    empty = nearest(_table(spark, []), COLS, 5, "TRANSACTION_ID")
    assert empty.collect() == [] and empty.columns == ["TRANSACTION_ID", *COLS, "neighbours"]


def test_nearest_keeps_rows_and_lists_alone(spark, monkeypatch):
    left = scratch_of_its_own(spark, monkeypatch)
    near = nearest(_table(spark, _rows(300, 5)), COLS, 5, "TRANSACTION_ID", 16, 40)
    assert left() == ["knn-lists", "knn-rows"]
    assert near.count() == 300


def test_rank_moves_rows_once(spark):
    """The buckets' offsets are broadcast: the rows are shuffled for the window alone."""
    df, _ = _labelled(spark, 40, 150)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = with_rank(df, "TX_FRAUD", 42)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def _labelled(spark, n_few, n_many):
    rng = np.random.default_rng(n_few)
    rows = [(i, int(i < n_few), *map(float, np.round(rng.normal(size=3), 3))) for i in range(n_few + n_many)]
    return spark.createDataFrame(rows, "TRANSACTION_ID long, TX_FRAUD int, a double, b double, c double"), {r[0]: np.array(r[2:]) for r in rows}


def test_synthetic_rows_stand_between_neighbours(spark):
    df, at = _labelled(spark, 40, 150)
    near = {r["TRANSACTION_ID"]: {x["TRANSACTION_ID"] for x in r["neighbours"]} for r in nearest(df.filter("TX_FRAUD = 1"), COLS, 5, "TRANSACTION_ID").collect()}
    made = synthetic_rows(df, COLS).collect()
    assert len(made) == 110
    per_row = [sum(r[SOURCE] == i for r in made) for i in range(40)]
    assert set(per_row) == {2, 3} and sorted({r[COPY] for r in made}) == [1, 2, 3]
    for r in made:
        assert r[OTHER] in near[r[SOURCE]] and 0 <= r[GAP] < 1 and r["TX_FRAUD"] == 1
        assert [r[c] for c in COLS] == [float(x) for x in at[r[SOURCE]] + r[GAP] * (at[r[OTHER]] - at[r[SOURCE]])]
    assert len({r[GAP] for r in made}) > 100 and len({r[OTHER] for r in made}) > 20
    again = sorted(tuple(r) for r in synthetic_rows(df.repartition(7), COLS).collect())
    assert again == sorted(tuple(r) for r in made)
    assert {r["TX_FRAUD"]: r["count"] for r in smote(df, COLS).groupBy("TX_FRAUD").count().collect()} == {0: 150, 1: 150}


def test_smote_edges(spark):
    single, _ = _labelled(spark, 1, 4)
    made = synthetic_rows(single, COLS).collect()
    assert len(made) == 3 and all(r[OTHER] is None and r[GAP] == 0 for r in made)
    for few, many in ((0, 5), (4, 4), (5, 2), (0, 0)):
        df, _ = _labelled(spark, few, many)
        assert synthetic_rows(df, COLS).count() == 0
        assert smote(df, COLS).count() == few + many


def test_ranks_are_of_scores_not_rows(spark):
    """The AUC by mean ranks, from a row a score in the window."""
    from cardrisk.queries.q_search import rank_auc

    rng = np.random.default_rng(4)
    rows = [(0, f, float(rng.integers(0, 6)) / 8, int(rng.random() < 0.3)) for f in (0, 1) for _ in range(300)]
    found = rank_auc(spark.createDataFrame(rows, "setting int, fold int, SCORE double, TX_FRAUD int"))
    got = {r["fold"]: r["by_rank"] for r in found.collect()}
    for f in (0, 1):
        pos, neg = ([r[2] for r in rows if r[1] == f and r[3] == y] for y in (1, 0))
        assert abs(got[f] - sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))) < 1e-12
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.rindex("Window") :]


def test_the_package_is_shipped_once_by_threads(monkeypatch, tmp_path):
    """Folds are resampled at the same time: all threads ship one archive."""
    import time
    from multiprocessing.pool import ThreadPool
    from types import SimpleNamespace

    from cardrisk import session

    added = []
    context = SimpleNamespace(applicationId="app-of-threads", addPyFile=lambda path: (time.sleep(0.2), added.append(path)))
    monkeypatch.setattr(session, "_SHIPPED", set())
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    with ThreadPool(4) as pool:
        pool.map(lambda _: session.ship_package(SimpleNamespace(sparkContext=context)), range(4))
    assert len(added) == 1
