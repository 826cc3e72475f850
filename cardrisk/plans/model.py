"""Model training, threshold choice, evaluation and batch scoring with MLlib (2.K).

The booster is MLlib's ``GBTClassifier`` (distributed tree learning), not
the reference's library, so scores differ from it; the workflow is the same:
exact stratified split, cross-validated search, class weights, a final fit with the best
setting and its best number of trees on a validation set, a threshold at the
best F1 of the validation precision-recall curve (scaled by 0.85), metrics on the
test rows, scoring of new rows with their history.

The terminals' mean amount and fraud ratio are fitted on train rows only and
stored with the model, so a score does not depend on the batch it is computed in.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardrisk.functions.calendar import add_calendar_flags
from cardrisk.operators import metrics as m
from cardrisk.operators.group_stats import fit_terminal_stats, fitted_stats_lookup
from cardrisk.operators.resample import smote
from cardrisk.operators.rolling import with_us
from cardrisk.operators.sampling import fold_column, stratified_split
from cardrisk.plans.features import build_features, feature_columns, feature_matrix
from cardrisk.session import cut_lineage, passing_scratch, scratch_path, shuffles_dropped, written
from cardrisk.schema import (
    CUSTOMER_ID,
    NON_FEATURE_COLS,
    PREDICTED_FRAUD,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_DATETIME,
    TX_FRAUD,
    US,
)

SCORE = m.SCORE
EXCLUDE = (*NON_FEATURE_COLS, US, "split", "fold", "weight")

# The search grid (64 settings), as booster parameter -> values,
# mapped to MLlib names: max_depth -> maxDepth, n_estimators -> maxIter,
# learning_rate -> stepSize, subsample -> subsamplingRate, colsample_bytree ->
# featureSubsetStrategy (per node in MLlib), gamma -> minInfoGain (another
# scale), random_state -> seed.
GRID = {
    "maxDepth": (4, 6),
    "maxIter": (50, 100),
    "stepSize": (0.1, 0.3),
    "subsamplingRate": (0.9, 1.0),
    "featureSubsetStrategy": ("0.9", "all"),
    "minInfoGain": (0.0, 1.0),
    "seed": (0,),
}
CV_FOLDS = 5


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def gbt(label: str = TX_FRAUD, valid_col: str | None = None, weight_col: str | None = None, seed: int = 42, **params) -> GBTClassifier:
    g = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    if valid_col:
        g = g.setValidationIndicatorCol(valid_col)
    if weight_col:
        g = g.setWeightCol(weight_col)
    return g


def with_class_weight(df: DataFrame, label: str = TX_FRAUD) -> DataFrame:
    """Weight positives by negatives/positives (a scalar subquery), negatives 1."""
    ratio = df.select(F.try_divide(F.count(F.when(F.col(label) == 0, 1)).cast("double"),
                                   F.count(F.when(F.col(label) == 1, 1)))).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(F.lit(1.0)))


def fit(train: DataFrame, features: Sequence[str], label: str = TX_FRAUD, valid_col: str | None = None,
        weight_col: str | None = None, **params) -> PipelineModel:
    pipe = Pipeline(stages=[assembler(features), gbt(label, valid_col, weight_col, **params)])
    return pipe.fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add SCORE = probability of class 1 (JVM-side vector access, no Python UDF)."""
    out = model.transform(df)
    return out.withColumn(SCORE, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def choose_threshold(scored: DataFrame, label: str = TX_FRAUD, factor: float = m.THRESHOLD_FACTOR) -> DataFrame:
    return m.best_threshold(m.pr_curve(scored, SCORE, label), factor)


def prepare(tx: DataFrame, seed: int = 42, test: float = 0.2, valid: float = 0.1, parity: bool = False) -> tuple[DataFrame, DataFrame]:
    """Features (both stages) with their split, and the terminal statistics of the train rows.

    With ``parity`` the features keep the statistics over all rows.  The split goes by id and label alone, so it is made
    on the rows as they come and written: the rank moves no features, and the statistics need no windows.
    """
    d = written(stratified_split(tx, test=test, valid=valid, seed=seed), "split")
    stats = fit_terminal_stats(d.filter(F.col("split") == "train"))
    feats = build_features(d, stage2=True)
    return (feats if parity else fitted_stats_lookup(feats, stats)), stats


def matrix(tx: DataFrame, seed: int = 42, parity: bool = False) -> tuple[DataFrame, list[str], DataFrame]:
    """(model matrix with ``split`` and ``is_valid``, feature names, terminal statistics).

    The window pipeline runs once: search, fitting and scoring read the written matrix.
    """
    spark = tx.sparkSession
    path = scratch_path(spark, "matrix")
    with passing_scratch(spark), shuffles_dropped(spark):
        d, stats = prepare(tx, seed=seed, parity=parity)
        mat = feature_matrix(d, exclude=EXCLUDE, keep=[TRANSACTION_ID, "split", TX_DATETIME, "TX_FRAUD_SCENARIO"])
        mat = written(mat.withColumn("is_valid", F.col("split") == "valid"), "matrix", path)
        return mat, feature_columns(d, EXCLUDE), cut_lineage(stats)


# Rows of a part: fewer than the least are not worth a task, more than the most are a long one.
PART_ROWS, MOST_PART_ROWS, PARTS_PER_CORE = 10_000, 500_000, 3


def in_even_parts(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly, to a few parts for each core.

    Every level of every tree is a stage over all rows, so a part more than there are cores, as the files of a
    written table leave it, is a second wave of tasks in each of them.
    """
    n = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(PARTS_PER_CORE * cores, n // PART_ROWS), -(-n // MOST_PART_ROWS)))


def first_trees(model: PipelineModel, trees: int) -> PipelineModel:
    """The model with its first ``trees`` trees alone.

    The booster's stored form has a row a node with its ``treeID``: those of later trees are left out.
    Nothing is fitted.
    """
    booster = model.stages[-1]
    if trees >= booster.getNumTrees:
        return model
    spark = SparkSession.getActiveSession()
    whole, cut = scratch_path(spark, "booster"), scratch_path(spark, "booster-prefix")
    booster.write().save(whole)
    spark.read.parquet(f"{whole}/data").filter(F.col("treeID") < trees).write.parquet(f"{cut}/data")
    spark.read.parquet(f"{whole}/treesMetadata").filter(F.col("_1") < trees).coalesce(1).write.parquet(f"{cut}/treesMetadata")
    about = json.loads(spark.read.text(f"{whole}/metadata").first()[0])
    about["numTrees"] = trees
    spark.createDataFrame([(json.dumps(about, separators=(",", ":")),)], "value string").coalesce(1).write.text(f"{cut}/metadata")
    return PipelineModel([*model.stages[:-1], GBTClassificationModel.load(cut)])


def best_prefix(model: PipelineModel, valid: DataFrame) -> int:
    """Number of trees with the least loss on the validation rows (the first of equals)."""
    assembled = model.stages[0].transform(valid)
    if "weight" not in assembled.columns:  # validation rows count as they are
        assembled = assembled.withColumn("weight", F.lit(1.0))
    loss = model.stages[-1].evaluateEachIteration(assembled)
    return loss.index(min(loss)) + 1


def final_fit(mat: DataFrame, features: Sequence[str], class_weight: bool = True, resample: bool = False, **params) -> PipelineModel:
    """Fit on train rows and keep the first trees that are best on the validation rows; one fit.

    The classes are weighted, or with ``resample`` evened out by synthetic rows; both never.
    """
    rows = mat.filter(F.col("split") == "train")
    params = {k: v for k, v in params.items() if k != "validationTol"}
    with passing_scratch(mat.sparkSession):
        rows, weight = _balanced(rows, features, class_weight, resample)
        model = fit(in_even_parts(rows.select(*features, TX_FRAUD, *([weight] if weight else []))), features, weight_col=weight, **params)
    valid = mat.filter(F.col("split") == "valid")
    return model if valid.isEmpty() else first_trees(model, best_prefix(model, valid))


def _balanced(rows: DataFrame, features: Sequence[str], class_weight: bool, resample: bool, label: str = TX_FRAUD) -> tuple[DataFrame, str | None]:
    """Written rows for a fit and the name of their weight, if any."""
    if resample:
        return smote(rows, features, label), None
    return (written(with_class_weight(rows, label), "weighted"), "weight") if class_weight else (rows, None)


def train_eval(tx: DataFrame, seed: int = 42, class_weight: bool = False, parity: bool = False,
               grid: Mapping[str, Sequence] | None = None, folds: int = CV_FOLDS, resample: bool = False, **params):
    """Search (with a ``grid``), fit on train with the best setting and prefix, threshold on valid, score test.

    Returns (model, threshold DataFrame, scored test rows, feature names, terminal statistics).
    """
    mat, feats, stats = matrix(tx, seed, parity)
    if grid:
        params = {**params, **grid_search(mat.filter(F.col("split") == "train"), feats, grid, folds, seed=seed, resample=resample)[0]}
    params.setdefault("seed", seed)
    model = final_fit(mat, feats, class_weight or bool(grid), resample, **params)
    valid_scored = score(model, mat.filter(F.col("split") == "valid"))
    thr = choose_threshold(valid_scored)
    test_scored = score(model, mat.filter(F.col("split") == "test"))
    test_pred = m.predict_at(test_scored, thr.select("threshold").scalar())
    return model, thr, test_pred, feats, stats


def last_rows_of(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` last rows of every customer by time and id (a limit within each task comes before the shuffle)."""
    w = Window.partitionBy(CUSTOMER_ID).orderBy(F.col(TX_DATETIME).desc(), F.col(TRANSACTION_ID).desc())
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def score_new(
    model: PipelineModel,
    threshold: float,
    new_tx: DataFrame,
    history: DataFrame,
    features: Sequence[str],
    terminal_stats: DataFrame,
    lookback_days: int = 37,
    max_lag: int = 5,
    last_rows: DataFrame | None = None,
) -> DataFrame:
    """A score and a prediction for every new row: ``TRANSACTION_ID, SCORE, PREDICTED_FRAUD``.

    History rows of the same customers/terminals from the ``lookback_days``
    before the first new row are unioned in so the windows see their past, rows that
    are themselves new left out.  The lags look back by rows: ``last_rows`` is a kept table of each
    customer's ``max_lag`` last rows (``plans.scoring``); without it they are taken from the whole ``history``.
    Terminal statistics come from training.  A
    row without customer, terminal or time has no window features; they are 0.
    New rows and history are joined once and written; the features and their probe of hot keys read that.
    """
    new = new_tx if TX_FRAUD in new_tx.columns else new_tx.withColumn(TX_FRAUD, F.lit(None).cast("int"))
    new = written(new.withColumn("_row", F.monotonically_increasing_id()), "new")
    history = history.join(new.select(TRANSACTION_ID), TRANSACTION_ID, "left_anti")
    first = new.select(F.min(F.col(TX_DATETIME).cast("timestamp"))).scalar()
    hist = history.filter(F.col(TX_DATETIME).cast("timestamp") >= first - F.expr(f"INTERVAL {lookback_days} DAYS"))
    customers = new.select(CUSTOMER_ID).distinct()
    # lags look back by rows, not time: also each new customer's last rows of any age
    if last_rows is None:
        last_rows = last_rows_of(history.join(customers, CUSTOMER_ID, "left_semi"), max_lag)
    else:
        last_rows = last_rows.join(new.select(TRANSACTION_ID), TRANSACTION_ID, "left_anti").join(customers, CUSTOMER_ID, "left_semi")
        last_rows = last_rows.select(*hist.columns)
    terminals = new.select(TERMINAL_ID).distinct()
    near = (
        hist.join(customers.withColumn("_customer", F.lit(True)), CUSTOMER_ID, "left")
        .join(terminals.withColumn("_terminal", F.lit(True)), TERMINAL_ID, "left")
        .filter(F.col("_customer").isNotNull() | F.col("_terminal").isNotNull())
        .select(*hist.columns)
    )
    hist = near.unionByName(last_rows).dropDuplicates([TRANSACTION_ID])
    both = written(hist.withColumn("_row", F.lit(None).cast("bigint")).unionByName(new, allowMissingColumns=True), "scored-with")
    feats = build_features(both, stage2=True).filter(F.col("_row").isNotNull())
    plain = fitted_stats_lookup(add_calendar_flags(with_us(new)), terminal_stats)
    window_cols = [c for c in features if c not in plain.columns]
    rows = plain.join(feats.select("_row", *window_cols), "_row", "left")
    mat = feature_matrix(rows, exclude=(*EXCLUDE, "_row"), keep=[TRANSACTION_ID])
    s = score(model, mat.select(TRANSACTION_ID, *features))
    return s.select(TRANSACTION_ID, SCORE, (F.col(SCORE) >= F.lit(threshold)).cast("int").alias(PREDICTED_FRAUD))


def settings_of(grid: Mapping[str, Sequence] | None = None) -> list[dict]:
    """Every combination of the grid's values."""
    grid = grid or GRID
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


# Rows of a search that are fitted at the same time: each fit keeps its own rows' bins, those beyond memory on disk.
AT_ONCE_ROWS = 10_000_000


def out_of_fold(
    train: DataFrame,
    features: Sequence[str],
    grid: Mapping[str, Sequence] | None = None,
    folds: int = CV_FOLDS,
    parallelism: int = 4,
    label: str = TX_FRAUD,
    seed: int = 42,
    class_weight: bool = True,
    resample: bool = False,
) -> DataFrame:
    """``setting, fold, TRANSACTION_ID, label, SCORE``: every train row scored once a setting, by a model that has not seen it.

    Rows are balanced within each fold's own train part, so no synthetic row has a held-out row as its end; a
    part is balanced and written once, serves all settings, and goes with what it was made from when its fits are done,
    so one fold's neighbours and synthetic rows are on disk at a time.
    ``setting`` counts ``settings_of(grid)``.
    The table is written, a folder a fold and setting, so a lost fit is repeated alone.
    """
    spark = train.sparkSession
    settings = list(enumerate(settings_of(grid)))
    path = scratch_path(spark, "out-of-fold")
    with passing_scratch(spark), shuffles_dropped(spark):
        keep = dict.fromkeys((TRANSACTION_ID, label, *features))
        rows = written(fold_column(train.select(*keep), folds, seed, label=label), "folds")
        at_once = max(1, min(parallelism, AT_ONCE_ROWS // max(1, rows.count())))

        for k in range(folds):
            with passing_scratch(spark):
                part, weight = _balanced(rows.filter(F.col("fold") != k), features, class_weight, resample, label)

                def one(job: tuple[int, dict]) -> None:
                    i, setting = job
                    model = fit(part, features, label, weight_col=weight, **{"seed": seed, **setting})
                    held = score(model, rows.filter(F.col("fold") == k))
                    held.select(TRANSACTION_ID, F.col(label).cast("int").alias(label), SCORE).write.parquet(f"{path}/setting={i}/fold={k}")

                with ThreadPool(min(at_once, len(settings))) as pool:
                    pool.map(inheritable_thread_target(spark)(one), settings)
    kind = f"{TRANSACTION_ID} {train.schema[TRANSACTION_ID].dataType.simpleString()}, {label} int, {SCORE} double, setting int, fold int"
    return spark.read.schema(kind).parquet(path)


def fold_aucs(scored: DataFrame, settings: int, folds: int, label: str = TX_FRAUD, parallelism: int = 4) -> list[tuple[int, int, float | None]]:
    """``(setting, fold, AUC)`` from an out-of-fold table; exact, ties counted half; None for a fold of one class."""

    def one(job: tuple[int, int]) -> tuple[int, int, float | None]:
        i, k = job
        return i, k, m.roc_auc(m.pr_curve(scored.filter((F.col("setting") == i) & (F.col("fold") == k)), SCORE, label)).first()[0]

    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(scored.sparkSession)(one), list(itertools.product(range(settings), range(folds))))


def grid_search(
    train: DataFrame,
    features: Sequence[str],
    grid: Mapping[str, Sequence] | None = None,
    folds: int = CV_FOLDS,
    parallelism: int = 4,
    label: str = TX_FRAUD,
    seed: int = 42,
    class_weight: bool = True,
    resample: bool = False,
) -> tuple[dict, list[tuple[dict, float]]]:
    """Cross-validated ROC-AUC over a parameter grid on stratified folds (``out_of_fold``).

    Returns the best setting and every setting with its mean AUC over the folds that hold both classes.
    """
    settings = settings_of(grid)
    scored = out_of_fold(train, features, grid, folds, parallelism, label, seed, class_weight, resample)
    known: dict[int, list[float]] = {}
    for i, _, auc in fold_aucs(scored, len(settings), folds, label):
        if auc is not None:
            known.setdefault(i, []).append(auc)
    results = [(setting, sum(known[i]) / len(known[i]) if i in known else 0.0) for i, setting in enumerate(settings)]
    return max(results, key=lambda r: r[1])[0], results


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) sorted by importance; one value per feature, small."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, imp)), key=lambda t: (-t[1], t[0]))


def save(model: PipelineModel, threshold: float, path: str, spark: SparkSession, features: Sequence[str] = (), stats: DataFrame | None = None) -> None:
    """Store the model with what scoring needs; the threshold is written last and marks a whole store."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(f,) for f in features], "feature string").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    if stats is not None:
        stats.write.mode("overwrite").parquet(f"{path}/terminal_stats")
    spark.createDataFrame([(float(threshold),)], "threshold double").write.mode("overwrite").parquet(f"{path}/threshold")


def load(path: str, spark: SparkSession) -> tuple[PipelineModel, float]:
    model = PipelineModel.load(f"{path}/model")
    thr = spark.read.parquet(f"{path}/threshold").first()[0]
    return model, thr


def stored(path: str, spark: SparkSession) -> bool:
    """Whether a whole model is stored at the path."""
    try:
        return not spark.read.parquet(f"{path}/threshold").isEmpty()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise
