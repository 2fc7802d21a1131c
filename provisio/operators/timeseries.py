"""Vintage, migration, projection, cohort and intraday tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.semantics import (
    clip, col_or, cut, days_before_reference, map_lookup, ordinal, quarter_label,
)
from provisio.operators.features import WEEKDAYS

BILLION = 1e9
HIGH_RISK = 0.48
DECAY = 0.98  # fixed value: monthly run-off of the exposure
# PD scalar of each scenario in months 1 to 12, and the scenario weights.
PATHS = {
    "Optimistic": (0.98, 0.97, 0.96, 0.95, 0.94, 0.93, 0.92, 0.91, 0.90, 0.89, 0.88, 0.87),
    "Base": (1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00),
    "Adverse": (1.05, 1.08, 1.10, 1.12, 1.13, 1.15, 1.16, 1.17, 1.18, 1.19, 1.20, 1.20),
    "Severe": (1.10, 1.18, 1.25, 1.32, 1.38, 1.45, 1.50, 1.54, 1.57, 1.60, 1.62, 1.65),
}
PATH_WEIGHTS = {"Optimistic": 0.20, "Base": 0.50, "Adverse": 0.20, "Severe": 0.10}
# Edges and labels of the cohort bands.
TERM_BANDS = ((0, 12, 18, 24, 36, 60), ("≤12m", "13-18m", "19-24m", "25-36m", "37m+"))
AGE_BANDS = ((18, 25, 35, 45, 55, 70), ("18-25", "26-35", "36-45", "46-55", "56+"))
TENURE_BANDS = ((-0.01, 1, 3, 5, 10, 20), ("<1yr", "1-3yr", "3-5yr", "5-10yr", ">10yr"))
NO_BAND = "nan"
DAY_ORDER = tuple(WEEKDAYS.values())


def _rate(df: DataFrame) -> Column:
    """Default rate, or the mean score where there are no labels."""
    return F.avg(F.col("target" if "target" in df.columns else "pred_prob").cast("double"))


def vintage(df: DataFrame) -> DataFrame:
    """Quarter of onboarding by loan-term band: default rate, count, mean PD, exposure."""
    date = days_before_reference(clip(F.abs(F.col("days_id_publish")), 0, 1460))
    term = F.coalesce(clip(F.col("credit_term").cast("double"), 6.0, 60.0), F.lit(24.0))
    return (
        df.filter(F.col("days_id_publish").isNotNull())
        .groupBy(quarter_label(date).alias("cohort"), cut(term, *TERM_BANDS, outside=NO_BAND).alias("term_band"))
        .agg(_rate(df).alias("default_rate"), F.count("sk_id_curr").alias("loan_count"),
             F.avg("pred_prob").alias("avg_pd"), F.sum("ead").alias("total_ead"))
        .withColumns({
            "default_rate_pct": F.col("default_rate") * 100, "avg_pd_pct": F.col("avg_pd") * 100,
            "total_ead_b": F.col("total_ead") / BILLION,
        })
    )


def migration_stage(df: DataFrame, score: Column) -> Column:
    """Stage from score and behaviour; a bad debt alone gives stage 2 here."""
    bad = col_or(df, "bureau_bad_debt_flag", 0) == 1
    late = col_or(df, "inst_late_ratio", 0.0) > 0.30
    return F.when(score > 0.70, 3).when((score > 0.20) | bad | late, 2).otherwise(1)


def migration_long(df: DataFrame, scalar: float = 1.25) -> DataFrame:
    """Exposure (billions) by current and stressed stage: all nine cells, empty ones 0."""
    now = migration_stage(df, F.col("pred_prob"))
    then = migration_stage(df, clip(F.col("pred_prob") * scalar, 0.0, 0.999))
    flows = df.select(now.alias("s0"), then.alias("s1"), "ead")
    cells = [
        F.struct(
            F.lit(a).alias("stage_t"), F.lit(b).alias("stage_t1"),
            (F.coalesce(F.sum(F.when((F.col("s0") == a) & (F.col("s1") == b), F.col("ead"))), F.lit(0.0)) / BILLION).alias("ead_b"),
        )
        for a in (1, 2, 3) for b in (1, 2, 3)
    ]
    return flows.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def migration_pct_long(cells: DataFrame) -> DataFrame:
    total = F.sum("ead_b").over(Window.partitionBy("stage_t"))  # three cells per stage
    return cells.withColumn("pct", F.try_divide(F.col("ead_b"), total) * 100)


def migration_matrix(cells: DataFrame, value: str = "ead_b") -> DataFrame:
    """3 x 3 matrix, one row per current stage."""
    wide = cells.groupBy("stage_t").pivot("stage_t1", [1, 2, 3]).agg(F.first(value))
    return wide.select("stage_t", *[F.col(str(s)).alias(f"to_stage_{s}") for s in (1, 2, 3)])


def ecl_projection(df: DataFrame, months: int = 12) -> DataFrame:
    """ECL now times scenario path times run-off; paths end after 12 months."""
    points = [
        F.struct(
            F.lit(name).alias("scenario"), F.lit(m).alias("month"), F.lit(s).alias("scalar"),
            F.lit(PATH_WEIGHTS[name]).alias("weight"),
        )
        for name, path in PATHS.items() for m, s in enumerate(path[:months], 1)
    ]
    now = df.agg((F.sum("ecl") / BILLION).alias("ecl_current_b"), (F.sum("ead") / BILLION).alias("ead_current_b"))
    grid = now.select("ecl_current_b", "ead_current_b", F.inline(F.array(*points)))
    value = F.col("ecl_current_b") * F.col("scalar") * F.pow(F.lit(DECAY), F.col("month"))
    return grid.select(
        "month", "scenario", F.bround(value, 3).alias("ecl_b"), "weight", "ecl_current_b", "ead_current_b"
    )


def cohort_default(df: DataFrame) -> DataFrame:
    """Default rate by age band and tenure band, ordered by age band.

    The youngest age (18 after clipping) is on the open edge and has no band.
    """
    age = clip(F.bround(-F.col("days_birth") / 365.0, 0), 18.0, 70.0)
    tenure = clip(-F.col("days_employed") / 365.0, 0.0, 20.0)
    return (
        df.groupBy(cut(age, *AGE_BANDS, outside=NO_BAND).alias("age_band"),
                   cut(tenure, *TENURE_BANDS, outside=NO_BAND).alias("tenure_band"))
        .agg(_rate(df).alias("default_rate"), F.count("sk_id_curr").alias("loan_count"),
             F.sum("ead").alias("total_ead"), F.avg("ecl").alias("avg_ecl"), F.avg("pred_prob").alias("avg_pd"))
        .withColumns({
            "default_rate_pct": F.col("default_rate") * 100, "total_ead_b": F.col("total_ead") / BILLION,
            "avg_ecl_k": F.col("avg_ecl") / 1e3, "age_ord": ordinal("age_band", AGE_BANDS[1]),
        })
        .orderBy(F.asc_nulls_last("age_ord"), "tenure_band")
    )


def weekday_label(c: str = "weekday_appr_process_start") -> Column:
    return map_lookup(F.upper(F.col(c)), WEEKDAYS, "Unknown")


def _high_risk() -> Column:
    return F.when(F.col("pred_prob") > HIGH_RISK, 1.0).otherwise(0.0)


def intraday_cells(df: DataFrame, day: Column, hour: str = "hour_appr_process_start") -> DataFrame:
    return (
        df.filter(F.col(hour).isNotNull()).groupBy(day.alias("weekday"), F.col(hour).alias("hour"))
        .agg((F.avg(_high_risk()) * 100).alias("high_risk_pct"))
    )


def intraday_heatmap(df: DataFrame, day: Column, hour: str = "hour_appr_process_start") -> DataFrame:
    """Weekday by hour share of high scores in percent; missing cells 0, Monday first."""
    cells = intraday_cells(df, day, hour).filter(F.col("weekday").isin(list(DAY_ORDER)))
    wide = cells.groupBy("weekday").pivot("hour", list(range(24))).agg(F.first("high_risk_pct"))
    return (
        wide.select("weekday", *[F.coalesce(F.col(str(h)), F.lit(0.0)).alias(f"h{h:02d}") for h in range(24)])
        .orderBy(ordinal("weekday", DAY_ORDER))
    )


def _risk_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    return (
        df.filter(key.isNotNull()).groupBy(key.alias(name))
        .agg(F.avg(_high_risk()).alias("high_risk_rate"), F.count("sk_id_curr").alias("volume"))
        .withColumn("high_risk_pct", F.col("high_risk_rate") * 100)
    )


def intraday_hourly(df: DataFrame, hour: str = "hour_appr_process_start") -> DataFrame:
    return _risk_by(df, F.col(hour), "hour").orderBy("hour")


def intraday_daily(df: DataFrame, day: Column) -> DataFrame:
    return (
        _risk_by(df, day, "weekday").filter(F.col("weekday").isin(list(DAY_ORDER)))
        .orderBy(ordinal("weekday", DAY_ORDER))
    )


def monthly_rate(df: DataFrame, month: str = "disbursement_month") -> DataFrame:
    return (
        df.filter(F.col(month).isNotNull()).groupBy(month)
        .agg(_rate(df).alias("default_rate"), F.count(F.lit(1)).alias("loan_count")).orderBy(month)
    )


def linear_trend(series: DataFrame, period: str = "disbursement_month", value: str = "default_rate") -> DataFrame:
    """Least-squares line over the period index with the fitted value of each period."""
    x = series.withColumn("x", F.row_number().over(Window.orderBy(period)) - 1)  # one row per month
    whole = Window.partitionBy()
    fitted = x.withColumns({
        "slope": F.regr_slope(F.col(value), F.col("x")).over(whole),
        "intercept": F.regr_intercept(F.col(value), F.col("x")).over(whole),
    })
    return fitted.withColumn("trend", F.col("slope") * F.col("x") + F.col("intercept"))


def cumulative_default(df: DataFrame, cohort: Column, month: str = "disbursement_month") -> DataFrame:
    """Running defaults and running rate per origination cohort (one row per cohort month)."""
    monthly = df.filter(F.col(month).isNotNull()).groupBy(cohort.alias("cohort"), month).agg(
        F.count(F.lit(1)).alias("loan_count"), F.count_if(F.col("target") == 1).alias("defaults")
    )
    upto = Window.partitionBy("cohort").orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumns({
        "cum_loans": F.sum("loan_count").over(upto), "cum_defaults": F.sum("defaults").over(upto),
    }).withColumn("cum_default_rate", F.col("cum_defaults") / F.col("cum_loans"))
