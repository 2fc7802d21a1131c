"""Batch scoring of applicants: validation, feature rows, score, tier, ECL and risk factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_quantiles
from provisio.functions.semantics import map_lookup, present_names, ratio
from provisio.operators.models import apply_isotonic, clip_pd, ensemble_predict

# Bounds of the request fields as (low, high, low is exclusive).
BOUNDS = {
    "ext_source_1": (0, 1, False), "ext_source_2": (0, 1, False), "ext_source_3": (0, 1, False),
    "amt_credit": (0, None, True), "amt_income_total": (0, None, True), "amt_annuity": (0, None, True),
    "amt_goods_price": (0, None, True), "age_years": (18, 70, False), "years_employed": (0, None, False),
    "cnt_children": (0, 15, False), "bureau_bad_debt_flag": (0, 1, False),
    "prev_refused_ratio": (0, 1, False), "inst_late_ratio": (0, 1, False),
    "cc_utilization_mean": (0, None, False), "bureau_loan_count": (0, None, False),
}
# Tier bins of the score and the recommendation of each tier.
TIER_BINS = (0.0, 0.27892775991838853, 0.45654430591731376, 0.6493265692008885, 1.0)
TIERS = ("Very Low", "Low", "Medium", "High")
RECOMMENDATIONS = {
    "Very Low": "AUTO-APPROVE: Eligible for fast-track approval and preferential rate.",
    "Low": "STANDARD: Approve via standard process. Income verification recommended.",
    "Medium": "CONDITIONAL: Approve with conditions — reduce limit by 20%, require documentation.",
    "High": "REVIEW: Manual underwriter review required. Consider collateral or co-borrower.",
}
SCORING_LGD = 0.65
AUTO_RATIOS = {
    "credit_income_ratio": ("amt_credit", "amt_income_total"),
    "annuity_income_ratio": ("amt_annuity", "amt_income_total"),
    "credit_term": ("amt_credit", "amt_annuity"),
}


def violations(df: DataFrame, bounds: dict | None = None) -> Column:
    """Names of the given fields that are out of bounds."""
    checks = {}
    for c, (lo, hi, open_low) in (bounds or BOUNDS).items():
        if c not in df.columns:
            continue
        bad = F.col(c) <= lo if open_low else F.col(c) < lo
        if hi is not None:
            bad = bad | (F.col(c) > hi)
        checks[c] = bad
    return present_names(checks)


def validate_applicants(df: DataFrame) -> DataFrame:
    return df.withColumn("violations", violations(df)).withColumn("is_valid", F.size("violations") == 0)


def feature_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """median, mean, std, p01 and p99 per feature."""
    q = exact_quantiles(df, {c: [0.5, 0.01, 0.99] for c in cols})
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(q[c][0]).cast("double").alias("median"),
            F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.lit(q[c][1]).cast("double").alias("p01"), F.lit(q[c][2]).cast("double").alias("p99"),
        )
        for c in cols
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def medians_of(stats: DataFrame) -> dict[str, float]:
    return {r["feature"]: r["median"] for r in stats.select("feature", "median").collect()}


def auto_ratio(name: str, df: DataFrame) -> Column:
    """Ratio of two given amounts when the ratio itself is not given."""
    num, den = AUTO_RATIOS[name]
    if num not in df.columns or den not in df.columns:
        return F.lit(None).cast("double")
    given = F.col(num).isNotNull() & F.col(den).isNotNull()
    return F.when(given, ratio(num, den))


def assemble_features(df: DataFrame, medians: dict[str, float], extra: str | None = "extra_features",
                      keep: Sequence[str] = ("sk_id_curr",)) -> DataFrame:
    """One complete row of known features per applicant.

    Free-form values come first, then the given field, then an automatic ratio, then the
    training median. A supplied ratio is used.
    """
    cols = [F.col(c) for c in keep]
    cols.append((F.col("amt_credit") if "amt_credit" in df.columns else F.lit(None)).cast("double").alias("requested_amount"))
    for f, m in medians.items():
        choices = []
        if extra and extra in df.columns:
            choices.append(F.try_element_at(F.col(extra), F.lit(f)))
        if f in df.columns:
            choices.append(F.col(f).cast("double"))
        if f in AUTO_RATIOS:
            choices.append(auto_ratio(f, df))
        choices.append(F.lit(0.0 if m is None else float(m)))
        cols.append(F.coalesce(*choices).alias(f))
    return df.select(*cols)


def assign_tier(p, bins: Sequence[float] = TIER_BINS, labels: Sequence[str] = TIERS) -> Column:
    """First bin that contains the score, both bounds included; anything else is High."""
    p = F.col(p) if isinstance(p, str) else p
    out = None
    for lo, hi, label in zip(bins, bins[1:], labels):
        inside = p.between(lo, hi)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.otherwise("High")


def recommendation(tier) -> Column:
    return map_lookup(tier, RECOMMENDATIONS, "REVIEW")


def ecl_estimate(p, amount) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return p * SCORING_LGD * F.coalesce(F.col(amount) if isinstance(amount, str) else amount, F.lit(0.0))


def top_risk_factors(medians: dict[str, float], k: int = 3) -> Column:
    """Features furthest from their median in relative terms; zero medians are skipped."""
    parts = [
        F.struct(
            (-F.abs((F.col(f) - F.lit(m)) / F.lit(abs(m) + 1e-9))).alias("d"), F.lit(i).alias("i"), F.lit(f).alias("f")
        )
        for i, (f, m) in enumerate(medians.items()) if m
    ]
    return F.transform(F.slice(F.array_sort(F.array(*parts)), 1, k), lambda e: e["f"])


def decisions(scored: DataFrame, medians: dict[str, float], raw: str = "pd_raw", calibrated: str = "pd_calibrated",
              keep: Sequence[str] = ("sk_id_curr",)) -> DataFrame:
    """Response columns of scored feature rows, rounded as reported."""
    tier = assign_tier(calibrated)
    return scored.select(
        *keep, F.bround(raw, 6).alias("pd_raw"), F.bround(calibrated, 6).alias("pd_calibrated"),
        tier.alias("risk_tier"), F.bround(ecl_estimate(calibrated, "requested_amount"), 2).alias("ecl_estimate"),
        recommendation(tier).alias("recommendation"), top_risk_factors(medians).alias("top_risk_factors"),
    )


def score(rows: DataFrame, models: Sequence[Model], features: Sequence[str], calibrator=None) -> DataFrame:
    """Mean of the fold models, calibrated and clipped."""
    out = ensemble_predict(rows, models, features, "pd_raw")
    if calibrator is None:
        return out.withColumn("pd_calibrated", F.col("pd_raw"))
    return apply_isotonic(out, calibrator, "pd_raw", "pd_calibrated").withColumn(
        "pd_calibrated", clip_pd("pd_calibrated")
    )


def rejected_rows(checked: DataFrame, keep: Sequence[str] = ("sk_id_curr",)) -> DataFrame:
    """Invalid applicants in the shape of the response, with the reason."""
    return checked.filter(~F.col("is_valid")).select(
        *keep, F.lit(0.0).alias("pd_raw"), F.lit(0.0).alias("pd_calibrated"), F.lit("Unknown").alias("risk_tier"),
        F.lit(0.0).alias("ecl_estimate"),
        F.concat(F.lit("ERROR: "), F.array_join("violations", ", ")).alias("recommendation"),
        F.array().cast("array<string>").alias("top_risk_factors"),
    )


def score_batch(df: DataFrame, medians: dict[str, float], scorer, keep: Sequence[str] = ("sk_id_curr",)) -> DataFrame:
    """Score all applicants in one job; bad rows get tier 'Unknown' and do not stop the others.

    ``scorer`` adds pd_raw and pd_calibrated to complete feature rows.
    """
    checked = validate_applicants(df)
    rows = assemble_features(checked.filter("is_valid"), medians, keep=keep)
    return decisions(scorer(rows), medians, keep=keep).unionByName(rejected_rows(checked, keep))


def model_info(spark, version: str, features: Sequence[str], metrics: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(
        [(version, len(features), list(features), metrics)],
        "model_version string, feature_count int, features array<string>, metrics map<string,double>",
    )
