"""Stratified folds, Spark ML learners, out-of-fold scores, calibration and search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import ranked_by_hash
from provisio.functions.semantics import clip
from provisio.operators import calibration
from provisio.operators.metrics import auc
from provisio.session import new_path, use_checkpoints

SEED = 42
PD_FLOOR, PD_CEILING = 0.001, 0.999


def assign_folds(df: DataFrame, k: int = 5, y: str = "target", key: str = "sk_id_curr", seed: int = SEED) -> DataFrame:
    """Stratified folds: rows of each class in hash order, dealt out in turn.

    Class sizes per fold differ by at most one. The ranking is split by hash range, so the
    large class is never sorted in one task.
    """
    ranked = ranked_by_hash(df, key, seed, within=y, name="_rank")
    return ranked.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank")


def class_weights(df: DataFrame, y: str = "target") -> dict[str, float]:
    row = df.agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")).first()
    n = row["pos"] + row["neg"]
    return {
        "pos_weight": row["neg"] / row["pos"],
        "balanced_1": n / (2 * row["pos"]), "balanced_0": n / (2 * row["neg"]),
    }


def class_weight_table(df: DataFrame, y: str = "target") -> DataFrame:
    counts = df.filter(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("row_count"))
    whole = Window.partitionBy()  # one row per class
    return counts.select(
        y, "row_count",
        (F.sum("row_count").over(whole) / (F.col("row_count") * F.count(F.lit(1)).over(whole))).alias("balanced"),
        ((F.sum("row_count").over(whole) - F.col("row_count")) / F.col("row_count")).alias("other_to_own"),
    )


def with_weight(df: DataFrame, y: str = "target") -> DataFrame:
    w = class_weights(df, y)
    return df.withColumn("weight", F.when(F.col(y) == 1, w["balanced_1"]).otherwise(w["balanced_0"]))


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)


# Learners: each factory returns an unfitted estimator on (features, target).


def gbt(trees: int = 200, step: float = 0.05, depth: int = 6, subsample: float = 0.8, early_stop: bool = True,
        weight: str | None = "weight", min_leaf: int = 5, seed: int = SEED) -> GBTClassifier:
    out = GBTClassifier(
        labelCol="target", maxIter=trees, stepSize=step, maxDepth=depth, subsamplingRate=subsample,
        minInstancesPerNode=min_leaf, seed=seed, checkpointInterval=10,
    )
    if weight:
        out = out.setWeightCol(weight)
    if early_stop:
        out = out.setValidationIndicatorCol("is_validation")
    return out


def random_forest(trees: int = 300, depth: int = 10, min_leaf: int = 20, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="target", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed
    )


def logistic(reg: float = 0.0, max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(labelCol="target", regParam=reg, maxIter=max_iter, standardization=True)


def positive_probability() -> Column:
    return vector_to_array(F.col("probability")).getItem(1)


def score_with(model: Model, df: DataFrame, name: str = "pred_prob") -> DataFrame:
    """Add the probability of default; the learner's own columns are dropped."""
    out = model.transform(df).withColumn(name, positive_probability())
    return out.drop("rawPrediction", "probability", "prediction")


def fit_folds(df: DataFrame, factory: Callable[[], object], features: Sequence[str], k: int,
              parallel: int = 3) -> list[Model]:
    """One model per fold, fitted on the other folds; the held-out fold stops boosting early.

    The learners pass over the rows many times, so the vectors are persisted while they fit.
    The folds are fitted side by side, as cross validation does.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    needed = [c for c in ("target", "fold", "weight") if c in df.columns]
    ready = assemble(df, features).select("features", *needed).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(i: int) -> Model:
        estimator = factory()
        if isinstance(estimator, GBTClassifier) and estimator.isSet("validationIndicatorCol"):
            return estimator.fit(ready.withColumn("is_validation", F.col("fold") == i))
        return estimator.fit(ready.filter(F.col("fold") != i))

    try:
        with ThreadPool(min(k, parallel)) as pool:
            # One target per fold: each holds its own copy of the thread's properties.
            targets = [inheritable_thread_target(spark)(partial(fit, i)) for i in range(k)]
            return pool.map(lambda target: target(), targets)
    finally:
        ready.unpersist()


def oof_scores(df: DataFrame, models: Sequence[Model], features: Sequence[str], name: str = "pred_prob") -> DataFrame:
    """Each row scored by the model that did not see its fold.

    The rows are written once, dealt by fold, so each model reads the files of its own fold only.
    """
    spark = df.sparkSession
    path = new_path(spark, "folds")
    kind = df.schema["fold"].dataType
    assemble(df, features).withColumn("_fold", F.col("fold").cast("int")).write.partitionBy("_fold").parquet(path)
    stored = spark.read.parquet(path)
    parts = [
        score_with(m, stored.filter(F.col("_fold") == i), name).drop("features", "_fold") for i, m in enumerate(models)
    ]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("fold", F.col("fold").cast(kind)).select(*df.columns, name)


def oof_predict(df: DataFrame, factory: Callable[[], object], features: Sequence[str], k: int = 5,
                name: str = "pred_prob") -> DataFrame:
    return oof_scores(df, fit_folds(df, factory, features, k), features, name)


def ensemble_predict(df: DataFrame, models: Sequence[Model], features: Sequence[str], name: str = "pred_prob") -> DataFrame:
    """Mean probability of the fold models, all in one projection chain over the rows."""
    out = assemble(df, features)
    cols = []
    for i, m in enumerate(models):
        out = score_with(m, out, f"_p{i}")
        cols.append(F.col(f"_p{i}"))
    mean = reduce(lambda a, b: a + b, cols) / F.lit(float(len(cols)))
    return out.withColumn(name, mean).drop("features", *[f"_p{i}" for i in range(len(cols))])


# Calibration


fit_isotonic, apply_isotonic, cross_calibrate = calibration.fit, calibration.apply, calibration.cross


def clip_pd(c) -> Column:
    return clip(c, PD_FLOOR, PD_CEILING)


# Search

# Ranges of the boosting parameters that Spark's learner has.
SEARCH_SPACE = {
    "trees": ("int", 200, 2000, 100),
    "step": ("log", 0.005, 0.15),
    "depth": ("int", 3, 10, 1),
    "subsample": ("float", 0.5, 1.0),
    "min_leaf": ("int", 10, 200, 1),
}


def sample_candidates(space: dict, n: int, seed: int = SEED) -> list[dict]:
    """Seeded draws: whole numbers on a step grid, uniform and log-uniform numbers."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        one = {}
        for name, (kind, lo, hi, *step) in space.items():
            if kind == "int":
                one[name] = rng.randrange(lo, hi + 1, step[0] if step else 1)
            elif kind == "log":
                one[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                one[name] = rng.uniform(lo, hi)
        out.append(one)
    return out


def random_search(df: DataFrame, features: Sequence[str], space: dict | None = None, n: int = 100, k: int = 3,
                  seed: int = SEED) -> DataFrame:
    """Out-of-fold AUC of each candidate; the feature frame is cached across the fits."""
    folded = with_weight(assign_folds(df, k, seed=seed)).cache()
    rows = []
    try:
        for trial, params in enumerate(sample_candidates(space or SEARCH_SPACE, n, seed)):
            scored = oof_predict(folded, lambda p=params: gbt(**p), features, k)
            rows.append((trial, float(auc(scored).first()[0]), {a: float(b) for a, b in params.items()}))
    finally:
        folded.unpersist()
    return df.sparkSession.createDataFrame(rows, "trial int, auc double, params map<string,double>")


def best_trial(trials: DataFrame) -> DataFrame:
    return trials.orderBy(F.desc("auc"), "trial").limit(1)


def best_so_far(trials: DataFrame, order: str = "trial", value: str = "auc") -> DataFrame:
    """Running best over the trials (one row per trial)."""
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best", F.max(value).over(upto))
