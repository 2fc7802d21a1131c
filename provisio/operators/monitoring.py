"""Tier reports, cut-offs, policy flags, income stress and metric alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_quantiles
from provisio.functions.semantics import col_or, flag, present_names, ratio
from provisio.operators.metrics import roc_points

TIER_SHARES = (0.40, 0.25, 0.20, 0.15)
# Alert limits as (limit, alert when above).
ALERT_RULES = {
    "psi_watch": ("psi", 0.10, True), "psi_shift": ("psi", 0.25, True), "csi": ("csi", 0.10, True),
    "brier": ("brier", 0.10, True), "auc": ("auc", 0.73, False), "ecl_delta": ("ecl_delta", 0.10, True),
}


def tier_report(df: DataFrame, y: str = "target", p: str = "pred_prob") -> DataFrame:
    rows = df.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("loan_count"), F.avg(F.col(y).cast("double")).alias("default_rate"),
        F.avg(p).alias("avg_pd"), F.sum("ecl").alias("ecl"),
    )
    whole = Window.partitionBy()  # one row per tier
    return rows.withColumns({
        "portfolio_pct": F.col("loan_count") * 100.0 / F.sum("loan_count").over(whole),
        "ecl_pct": F.try_divide(F.col("ecl") * 100.0, F.sum("ecl").over(whole)),
    })


def fit_tiers(df: DataFrame, shares: Sequence[float] = TIER_SHARES, p: str = "pred_prob") -> list[float]:
    """Score quantiles that give the tiers the wanted shares of the portfolio."""
    cuts, total = [], 0.0
    for s in shares[:-1]:
        total += s
        cuts.append(round(total, 10))
    return [0.0, *exact_quantiles(df, {p: cuts})[p], 1.0]


def ks_threshold(df: DataFrame, y: str = "target", p: str = "pred_prob", max_distinct: int | None = None) -> DataFrame:
    """Threshold with the largest tpr - fpr; the lowest threshold wins ties."""
    gap = F.col("tpr") - F.col("fpr")
    points = roc_points(df, y, p, max_distinct).withColumn("gap", gap)
    order = F.struct(F.col("gap"), -F.col("threshold"))
    return points.agg(F.max_by("threshold", order).alias("threshold"), F.max("gap").alias("gap"))


def policy_rules(df: DataFrame) -> dict[str, Column]:
    age = -F.col("days_birth") / 365.0
    return {
        "cap_credit_80": F.col("credit_income_ratio") > 5,
        "cut_limit_25": col_or(df, "bureau_bad_debt_flag", 0) == 1,
        "manual_review": col_or(df, "prev_refused_ratio", 0.0) > 0.30,
        "early_warning": col_or(df, "inst_late_ratio", 0.0) > 0.10,
        "risk_based_pricing": (age >= 20) & (age <= 25),
    }


def policy_flags(df: DataFrame) -> DataFrame:
    """Names of the policies that apply and the credit limit they leave."""
    rules = policy_rules(df)
    limit = (
        F.col("amt_credit") * F.when(rules["cap_credit_80"], 0.8).otherwise(1.0)
        * F.when(rules["cut_limit_25"], 0.75).otherwise(1.0)
    )
    return df.withColumns({"policies": present_names(rules), "policy_limit": limit})


def income_stress(df: DataFrame, drop: float = 0.20, lti: float = 5.0) -> DataFrame:
    """Income ratios before and after an income drop for high-LTI clients with a clean bureau."""
    hit = (F.col("credit_income_ratio") > lti) & (col_or(df, "bureau_bad_debt_flag", 0) == 0)
    lower = F.col("amt_income_total") * (1 - drop)
    after = {
        "credit_income_ratio": ratio("amt_credit", lower), "annuity_income_ratio": ratio("amt_annuity", lower),
    }
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.count_if(hit).alias("clients"),
            F.avg(F.when(hit, F.col(c))).alias("before"), F.avg(F.when(hit, new)).alias("after"),
        )
        for c, new in after.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r")).withColumn(
        "delta", F.col("after") - F.col("before")
    )


def alerts(metrics: DataFrame, rules: dict | None = None) -> DataFrame:
    """Each rule against the metric it names: limit, direction and whether it fires."""
    rows = [(n, m, float(v), above) for n, (m, v, above) in (rules or ALERT_RULES).items()]
    table = metrics.sparkSession.createDataFrame(rows, "rule string, metric string, limit double, above boolean")
    fires = F.when(F.col("above"), F.col("value") > F.col("limit")).otherwise(F.col("value") < F.col("limit"))
    return table.join(metrics.select("metric", "value"), "metric", "inner").withColumn("alert", flag(fires))


