"""Exact model metrics: AUC with ties, KS, Brier, calibration, ROC, PSI."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_quantiles, range_splits, range_splits_many, running_totals
from provisio.functions.semantics import bin_index, distinct_edges, qcut_bin


def score_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """Positives and negatives per distinct score; equal scores merge before the shuffle."""
    return (
        df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
        .groupBy(F.col(p).cast("double").alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    )


def _auc_of() -> Column:
    """AUC from counts per score with the running count of negatives: each positive beats the
    negatives below it and half of its ties."""
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2))
    return F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg").cast("double"))


def auc(df: DataFrame, y: str = "target", p: str = "pred_prob", max_distinct: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties, from one aggregation by score."""
    splits = range_splits(df, p, max_distinct)
    return running_totals(score_counts(df, y, p), "score", {"neg": "neg_upto"}, splits).agg(_auc_of().alias("auc"))


def gini(auc_value: Column) -> Column:
    return 2 * auc_value - 1


def decile_edges(df: DataFrame, p: str, n: int = 10) -> list[float]:
    return distinct_edges(exact_quantiles(df, {p: [i / n for i in range(n + 1)]})[p])


def ks_table(df: DataFrame, y: str = "target", p: str = "pred_prob", n: int = 10) -> DataFrame:
    """Good and bad counts per score bucket with cumulative shares (at most n rows)."""
    scored = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    edges = decile_edges(scored, p, n)
    counts = (
        scored.groupBy(qcut_bin(p, edges).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("total"), F.sum(F.col(y).cast("long")).alias("defaults"))
        .withColumn("goods", F.col("total") - F.col("defaults"))
    )
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()

    def cumulative(c: str) -> Column:
        return F.sum(c).over(upto) / F.greatest(F.sum(c).over(whole), F.lit(1)).cast("double")

    return counts.select(
        "bucket", "total", "defaults", "goods",
        cumulative("defaults").alias("cum_defaults"), cumulative("goods").alias("cum_goods"),
    )


def ks(df: DataFrame, y: str = "target", p: str = "pred_prob", n: int = 10) -> DataFrame:
    return ks_table(df, y, p, n).agg(F.max(F.abs(F.col("cum_goods") - F.col("cum_defaults"))).alias("ks"))


def brier(df: DataFrame, y: str = "target", p: str = "pred_prob") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"))


def calibration_curve(df: DataFrame, y: str = "target", p: str = "pred_prob", n: int = 10) -> DataFrame:
    """Mean score and observed rate in equal-width bins of [0, 1]; empty bins do not appear."""
    inner = [i / n for i in range(1, n)]
    return (
        df.filter(F.col(p).isNotNull() & F.col(y).isNotNull())
        .groupBy(bin_index(p, inner).alias("bin"))
        .agg(F.avg(p).alias("mean_predicted"), F.avg(F.col(y).cast("double")).alias("observed_rate"),
             F.count(F.lit(1)).alias("row_count"))
    )


def roc_points(df: DataFrame, y: str = "target", p: str = "pred_prob", max_distinct: int | None = None) -> DataFrame:
    """False and true positive rate when every score from the threshold up counts as positive."""
    counts = score_counts(df, y, p)
    n = counts.agg(F.sum("pos"), F.sum("neg")).first()
    total_pos, total_neg = float(n[0] or 0), float(n[1] or 0)
    splits = range_splits(df, p, max_distinct)
    sums = running_totals(counts, "score", {"pos": "pos_upto", "neg": "neg_upto"}, splits)
    above = {c: F.lit(t) - F.col(f"{c}_upto") + F.col(c) for c, t in (("pos", total_pos), ("neg", total_neg))}
    return sums.select(
        F.col("score").alias("threshold"),
        F.try_divide(above["neg"], F.lit(total_neg)).alias("fpr"),
        F.try_divide(above["pos"], F.lit(total_pos)).alias("tpr"),
    )


def confusion(df: DataFrame, t: float, y: str = "target", p: str = "pred_prob") -> DataFrame:
    hit, actual = F.col(p) >= t, F.col(y) == 1
    good = F.col(y) == 0
    return df.agg(
        F.count_if(actual & hit).alias("tp"), F.count_if(good & hit).alias("fp"),
        F.count_if(actual & ~hit).alias("fn"), F.count_if(good & ~hit).alias("tn"),
    )


def missed_default_profile(
    df: DataFrame, features: Sequence[str], t: float, y: str = "target", p: str = "pred_prob"
) -> DataFrame:
    """Defaults that score below the cut-off against the portfolio: count, rate, mean deltas."""
    default = F.col(y) == 1
    missed = default & (F.col(p) < t)
    rows = [
        F.struct(
            F.lit(f).alias("feature"), F.avg(F.when(missed, F.col(f).cast("double"))).alias("missed_mean"),
            F.avg(F.col(f).cast("double")).alias("portfolio_mean"),
        )
        for f in features
    ]
    return (
        df.agg(
            F.count_if(missed).alias("missed"),
            F.try_divide(F.count_if(missed), F.count_if(default)).alias("fnr"),
            F.array(*rows).alias("r"),
        )
        .select("missed", "fnr", F.inline("r"))
        .withColumn("delta", F.col("missed_mean") - F.col("portfolio_mean"))
    )


PSI_FLOOR = 1e-4
PSI_ALERTS = ((0.25, "shift"), (0.10, "watch"))


def bin_shares(df: DataFrame, c: str, edges: Sequence[float]) -> dict[int, int]:
    rows = (
        df.filter(F.col(c).isNotNull()).groupBy(bin_index(c, edges[1:-1]).alias("b"))
        .agg(F.count(F.lit(1)).alias("n")).collect()
    )
    return {r["b"]: r["n"] for r in rows}


def psi_alert(value: Column) -> Column:
    out = F.when(value > PSI_ALERTS[0][0], PSI_ALERTS[0][1])
    for bound, name in PSI_ALERTS[1:]:
        out = out.when(value > bound, name)
    return out.otherwise("stable")


def psi_bins(base: DataFrame, other: DataFrame, c: str, n: int = 10) -> DataFrame:
    """Shares of both samples in the quantile bins of the base (at most n rows)."""
    edges = decile_edges(base, c, n)
    tagged = base.select(F.col(c).alias("v"), F.lit(1).alias("is_base")).unionByName(
        other.select(F.col(c).alias("v"), F.lit(0).alias("is_base"))
    )
    counts = (
        tagged.filter("v is not null").groupBy(bin_index("v", edges[1:-1]).alias("bin"))
        .agg(F.count_if(F.col("is_base") == 1).alias("base_n"), F.count_if(F.col("is_base") == 0).alias("other_n"))
    )
    whole = Window.partitionBy()

    def part(name: str) -> Column:
        return F.greatest(F.try_divide(F.col(name), F.sum(name).over(whole)), F.lit(PSI_FLOOR))

    return counts.select("bin", "base_n", "other_n", part("base_n").alias("base_share"), part("other_n").alias("other_share"))


def psi(base: DataFrame, other: DataFrame, c: str, n: int = 10) -> DataFrame:
    a, b = F.col("base_share"), F.col("other_share")
    return psi_bins(base, other, c, n).agg(F.sum((b - a) * F.log(b / a)).alias("psi")).withColumn(
        "alert", psi_alert(F.col("psi"))
    )


def csi(base: DataFrame, other: DataFrame, cols: Sequence[str], n: int = 10) -> DataFrame:
    """Stability index of each feature: one fit of all edges, one count by (feature, bin)."""
    edges = exact_quantiles(base, {c: [i / n for i in range(n + 1)] for c in cols})

    def entries(df: DataFrame, is_base: int) -> DataFrame:
        bins = [F.struct(F.lit(c).alias("feature"), bin_index(c, distinct_edges(edges[c])[1:-1]).alias("bin")) for c in cols]
        kept = [F.when(F.col(c).isNotNull(), e) for c, e in zip(cols, bins)]
        return df.select(F.inline(F.array_compact(F.array(*kept)))).withColumn("is_base", F.lit(is_base))

    counts = entries(base, 1).unionByName(entries(other, 0)).groupBy("feature", "bin").agg(
        F.count_if(F.col("is_base") == 1).alias("base_n"), F.count_if(F.col("is_base") == 0).alias("other_n"))
    whole = Window.partitionBy("feature")  # at most n bins

    def part(name: str) -> Column:
        return F.greatest(F.try_divide(F.col(name), F.sum(name).over(whole)), F.lit(PSI_FLOOR))

    shares = counts.select("feature", part("base_n").alias("a"), part("other_n").alias("b"))
    found = shares.groupBy("feature").agg(F.sum((F.col("b") - F.col("a")) * F.log(F.col("b") / F.col("a"))).alias("psi"))
    return found.withColumn("alert", psi_alert(F.col("psi")))


def ece(df: DataFrame, y: str = "target", p: str = "pred_prob", n: int = 10) -> DataFrame:
    gap = F.abs(F.col("mean_predicted") - F.col("observed_rate"))
    return calibration_curve(df, y, p, n).agg(
        (F.sum(gap * F.col("row_count")) / F.sum("row_count")).alias("ece")
    )


def auc_by(df: DataFrame, by: str, y: str = "target", p: str = "pred_prob", max_distinct: int | None = None) -> DataFrame:
    """Exact ROC AUC of each group, all from one count by (group, score)."""
    known = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    counts = known.groupBy(by, F.col(p).cast("double").alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    splits = range_splits(known, p, max_distinct)
    return running_totals(counts, "score", {"neg": "neg_upto"}, splits, by=[by]).groupBy(by).agg(_auc_of().alias("auc"))


def fold_auc(df: DataFrame, folds: int, y: str = "target", p: str = "pred_prob", fold: str = "fold") -> DataFrame:
    numbered = df.filter(F.col(fold).between(0, folds - 1)).withColumn("_fold", F.col(fold).cast("int"))
    return auc_by(numbered, "_fold", y, p).select(F.col("_fold").alias("fold"), "auc")


def fold_auc_std(df: DataFrame, folds: int, y: str = "target", p: str = "pred_prob") -> DataFrame:
    return fold_auc(df, folds, y, p).agg(F.avg("auc").alias("mean_auc"), F.stddev_samp("auc").alias("std_auc"))


def lift(value: float, baseline: float) -> float:
    return value - baseline


def leaderboard(df: DataFrame, scores: dict[str, str], y: str = "target", max_distinct: int | None = None) -> DataFrame:
    """One rounded row per model (score column), best AUC first.

    All models share one aggregation by (model, score); AUC, KS and Brier all follow from
    those counts.
    """
    models, cols = list(scores), list(scores.values())
    labelled = df.filter(F.col(y).isNotNull())
    edges = exact_quantiles(labelled, {c: [i / 10 for i in range(11)] for c in cols})
    all_splits = range_splits_many(labelled, cols, max_distinct)
    splits = sorted({s for c in cols for s in all_splits[c]})
    pairs = F.array(*[
        F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("score")) for i, c in enumerate(cols)
    ])
    counts = (
        labelled.select(F.col(y).alias("y"), F.explode(pairs).alias("e")).filter("e.score is not null")
        .groupBy(F.col("e.m").alias("m"), F.col("e.score").alias("score"))
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    )
    p, n = F.col("score"), F.col("pos") + F.col("neg")
    errors = F.col("pos") * F.pow(p - 1, 2) + F.col("neg") * F.pow(p, 2)
    ranked = running_totals(counts, "score", {"neg": "neg_upto"}, splits, by=["m"])
    direct = ranked.groupBy("m").agg(_auc_of().alias("auc"), (F.sum(errors) / F.sum(n)).alias("brier"))
    bucket = F.lit(None).cast("int")
    for i, c in enumerate(cols):
        bucket = F.when(F.col("m") == i, qcut_bin("score", distinct_edges(edges[c]))).otherwise(bucket)
    buckets = counts.groupBy("m", bucket.alias("b")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    upto = Window.partitionBy("m").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("m")

    def cumulative(c: str) -> Column:
        return F.sum(c).over(upto) / F.greatest(F.sum(c).over(whole), F.lit(1)).cast("double")

    gaps = buckets.select("m", F.abs(cumulative("neg") - cumulative("pos")).alias("gap"))
    ks_rows = gaps.groupBy("m").agg(F.max("gap").alias("ks"))
    name = F.element_at(F.array(*[F.lit(m) for m in models]), F.col("m") + 1)
    return direct.join(ks_rows, "m").select(
        name.alias("model"), F.bround("auc", 4).alias("oof_auc"), F.bround(gini(F.col("auc")), 4).alias("gini"),
        F.bround(F.col("ks") * 100, 2).alias("ks_pct"), F.bround("brier", 5).alias("brier"),
    ).orderBy(F.desc("oof_auc"), "model")


def best_model(board: DataFrame) -> DataFrame:
    return board.agg(F.max_by("model", F.struct("oof_auc", "model")).alias("model"), F.max("oof_auc").alias("oof_auc"))
