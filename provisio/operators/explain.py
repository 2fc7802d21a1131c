"""Importance, additive contributions and partial dependence of fitted models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import hash_order, ranked_by_hash
from provisio.operators.metrics import auc_by
from provisio.operators.models import assemble, score_with

SAMPLE_ROWS = 10_000
GRID_POINTS = 40


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = 42, key: str = "sk_id_curr") -> DataFrame:
    """At most n rows without replacement, the same ones on every run (a top-n, no full sort)."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def model_importance(spark, model: Model, features: Sequence[str]) -> DataFrame:
    weights = model.featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def shuffle_column(df: DataFrame, c: str, key: str = "sk_id_curr", seed: int = 1) -> DataFrame:
    """The same rows with one column permuted: values in one hash order, rows in another."""
    rows = ranked_by_hash(df.drop(c), key, seed, name="_rank")
    values = ranked_by_hash(df.select(key, c), key, seed + 1, name="_rank").drop(key)
    return rows.join(values, "_rank").drop("_rank").select(*df.columns)


def with_partner(df: DataFrame, cols: Sequence[str], key: str = "sk_id_curr", seed: int = 1) -> DataFrame:
    """Each row with the values (as ``_partner``) of another row drawn without replacement: one permutation, one join."""
    rows = ranked_by_hash(df, key, seed, name="_rank")
    values = ranked_by_hash(df.select(key, *cols), key, seed + 1, name="_rank")
    return rows.join(values.select("_rank", F.struct(*cols).alias("_partner")), "_rank").drop("_rank")


def permutation_importance(df: DataFrame, model: Model | Callable[[DataFrame], DataFrame], features: Sequence[str],
                           key: str = "sk_id_curr", which: Sequence[str] | None = None) -> DataFrame:
    """Drop of the AUC when one feature is permuted (``which`` limits the features tried).

    ``model`` is a fitted model, or a function that adds the score ``_p`` to rows with the features.

    All features share one permutation and one plan: each row is scored as it is and once for each feature
    taken from its partner, and all AUCs come from one count by (feature, score).
    """
    names = list(which or features)
    labelled = df.select(key, "target", *features)
    variants = [F.struct(F.lit("").alias("feature"), *features)] + [
        F.struct(F.lit(f).alias("feature"), *[F.col(f"_partner.{c}" if c == f else c).alias(c) for c in features]) for f in names
    ]
    rows = with_partner(labelled, features, key).select(F.col("target").alias("_y"), F.inline(F.array(*variants)))
    scored = score_with(model, assemble(rows, features), "_p") if isinstance(model, Model) else model(rows)
    scored = scored.select("feature", "_y", "_p")
    found = auc_by(scored, "feature", "_y", "_p")
    whole = Window.partitionBy()  # one row per feature
    base = F.max(F.when(F.col("feature") == "", F.col("auc"))).over(whole)
    drops = found.select("feature", (base - F.col("auc")).alias("auc_drop")).filter("feature <> ''")
    return drops.orderBy(F.desc("auc_drop"), "feature")


def contributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float], k: int = 10,
                  key: str = "sk_id_curr") -> DataFrame:
    """Largest additive contributions beta * (x - mean) of each row, in long form."""
    parts = [
        F.struct(
            (-F.abs(F.lit(b) * (F.col(f) - F.lit(means[f])))).alias("o"), F.lit(i).alias("i"),
            F.lit(f).alias("feature"), (F.lit(b) * (F.col(f) - F.lit(means[f]))).alias("contribution"),
        )
        for i, (f, b) in enumerate(coefficients.items())
    ]
    top = F.slice(F.array_sort(F.array(*parts)), 1, k)
    return df.select(key, F.posexplode(top).alias("position", "e")).select(
        key, (F.col("position") + 1).alias("position"), "e.feature", "e.contribution"
    )


def mean_contributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float]) -> DataFrame:
    """Global importance: mean absolute contribution of each feature, one aggregate."""
    rows = [
        F.struct(F.lit(f).alias("feature"), F.avg(F.abs(F.lit(b) * (F.col(f) - F.lit(means[f])))).alias("importance"))
        for f, b in coefficients.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r")).orderBy(F.desc("importance"), "feature")


def grid_points(df: DataFrame, feature: str, n: int = GRID_POINTS) -> list[float]:
    lo, hi = df.agg(F.min(F.col(feature).cast("double")), F.max(F.col(feature).cast("double"))).first()
    return [lo + (hi - lo) * i / (n - 1) for i in range(n)]


def partial_dependence(df: DataFrame, model: Model, features: Sequence[str], feature: str, n: int = GRID_POINTS,
                       rows: int | None = None) -> DataFrame:
    """Mean score over all rows (or a sample of ``rows``) when one feature is set to each grid value."""
    points = grid_points(df, feature, n)
    sample = df if rows is None else sample_rows(df, rows)
    moved = sample.withColumn(feature, F.explode(F.array(*[F.lit(p) for p in points])))
    scored = score_with(model, assemble(moved, features), "_p")
    return scored.groupBy(F.col(feature).alias("grid_value")).agg(F.avg("_p").alias("mean_score")).select(
        F.lit(feature).alias("feature"), "grid_value", "mean_score"
    )
