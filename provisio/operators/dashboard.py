"""Datasets behind the portfolio charts: small grouped aggregates of the banded loans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provisio.functions.semantics import safe_div
from provisio.operators import bands as B

MILLION = 1e6


def _kpi_columns(when: Column | None = None) -> dict[str, Column]:
    """KPI aggregates, optionally restricted to the rows that satisfy a condition."""
    def pick(c: Column) -> Column:
        return c if when is None else F.when(when, c)

    def rows(cond: Column) -> Column:
        return F.count_if(cond if when is None else cond & when)

    high = F.col("risk_tier") == "High"
    amount, ecl = F.sum(pick(F.col("amt_credit"))), F.sum(pick(F.col("ecl")))
    return {
        "male": rows(F.col("code_gender") == "M"), "female": rows(F.col("code_gender") == "F"),
        "exposure": amount, "ecl": ecl, "default_rate": F.avg(pick(F.col("target").cast("double"))),
        "high_risk_share": F.avg(pick(F.when(high, 1.0).otherwise(0.0))),
        "high_risk_ecl": F.coalesce(F.sum(pick(F.when(high, F.col("ecl")))), F.lit(0.0)),
        "coverage": F.coalesce(F.try_divide(ecl, amount), F.lit(0.0)),
    }


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in _kpi_columns().items()])


def kpi_deltas(df: DataFrame, condition: Column) -> DataFrame:
    """Filtered value, whole value and difference of each KPI from one scan.

    No difference when nothing was filtered out or the whole value is 0.
    """
    part, whole = _kpi_columns(condition), _kpi_columns()
    rows = [
        F.struct(F.lit(n).alias("kpi"), part[n].cast("double").alias("filtered"),
                 whole[n].cast("double").alias("portfolio")) for n in whole
    ]
    cut_off = (F.count_if(condition) < F.count(F.lit(1))).alias("is_filtered")
    flat = df.agg(F.array(*rows).alias("r"), cut_off).select("is_filtered", F.inline("r"))
    return flat.select(
        "kpi", "filtered", "portfolio",
        F.when(F.col("is_filtered") & (F.col("portfolio") != 0), F.col("filtered") - F.col("portfolio")).alias("delta"),
    )


def defaults_by_income_type(df: DataFrame) -> DataFrame:
    return (
        df.filter((F.col("target") == 1) & F.col("name_income_type").isNotNull())
        .groupBy("name_income_type").agg(F.count(F.lit(1)).alias("default_count"))
        .orderBy("default_count", "name_income_type")
    )


def defaults_by_term(df: DataFrame) -> DataFrame:
    return (
        df.filter((F.col("target") == 1) & F.col("term_bin").isNotNull())
        .groupBy("term_bin").agg(F.count(F.lit(1)).alias("default_count"))
        .orderBy(B.band_order("term_bin", B.TERM))
    )


def _banded(df: DataFrame, band: str, spec, *aggs: Column) -> DataFrame:
    return (
        df.filter(F.col(band).isNotNull()).groupBy(band).agg(*aggs).orderBy(B.band_order(band, spec))
    )


def _rate() -> Column:
    return F.avg(F.col("target").cast("double")).alias("default_rate")


def exposure_by_amount_band(df: DataFrame) -> DataFrame:
    return _banded(df, "cred_bin", B.AMOUNT, F.sum("amt_credit").alias("exposure"), _rate(), F.sum("ecl").alias("ecl"))


def pd_distribution(df: DataFrame) -> DataFrame:
    return _banded(df, "pd_band", B.PD, F.count(F.lit(1)).alias("loan_count"), _rate())


def ecl_by_dti(df: DataFrame) -> DataFrame:
    return _banded(df, "dti_bin", B.DTI, (F.sum("ecl") / MILLION).alias("ecl_m"), _rate())


def by_stage(df: DataFrame) -> DataFrame:
    label = F.concat(F.lit("Stage "), F.col("stage").cast("string"))
    return df.groupBy("stage").agg(
        F.count("amt_credit").alias("loan_count"), F.sum("amt_credit").alias("ead"), F.sum("ecl").alias("ecl")
    ).withColumn("label", label).orderBy("stage")


def insights(df: DataFrame) -> DataFrame:
    """High-risk share of the ECL, income type with most defaults, worst loan-to-income band.

    Both groupings come from one (income type, band) aggregate of a few rows.
    """
    bad = F.col("target") == 1
    base = df.groupBy("name_income_type", "lti_bin").agg(
        F.count_if(bad).alias("bad"), F.count("target").alias("n"),
        F.sum(F.when(F.col("risk_tier") == "High", F.col("ecl")).otherwise(0.0)).alias("high"),
        F.sum("ecl").alias("ecl"),
    )
    income = base.filter("name_income_type is not null").groupBy("name_income_type").agg(F.sum("bad").alias("bad"))
    lti = base.filter("lti_bin is not null").groupBy("lti_bin").agg(safe_div(F.sum("bad"), F.sum("n")).alias("rate"))
    parts = [
        base.agg(safe_div(F.sum("high"), F.sum("ecl")).cast("string").alias("v")).select(F.lit("high_risk_ecl_share").alias("insight"), F.format_number(F.col("v").cast("double"), 4).alias("value")),
        income.agg(F.min_by("name_income_type", F.struct(-F.col("bad"), F.col("name_income_type"))).alias("value")).select(F.lit("top_default_income").alias("insight"), "value"),
        lti.agg(F.min_by("lti_bin", F.struct(-F.col("rate"), B.band_order("lti_bin", B.LTI))).alias("value")).select(F.lit("worst_lti").alias("insight"), "value"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stage_cards(df: DataFrame) -> DataFrame:
    return by_stage(df).select(
        "stage", "loan_count", "ead", "ecl", safe_div("ecl", "ead", 0.0).alias("coverage")
    )


def by_region(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("region_rating").isNotNull()).groupBy("region_rating")
        .agg(F.sum("amt_credit").alias("exposure"), F.sum("ecl").alias("ecl")).orderBy("exposure")
    )


def trend_kpis(projection: DataFrame, migration: DataFrame, hourly: DataFrame) -> DataFrame:
    """ECL now, base and severe ECL at the horizon, stage-1 downgrade share, riskiest hour."""
    end = {
        n: F.max_by(F.when(F.col("scenario") == s, F.col("ecl_b")), F.when(F.col("scenario") == s, F.col("month")))
        for n, s in (("ecl_base_end", "Base"), ("ecl_severe_end", "Severe"))
    }
    proj = projection.agg(
        F.max("ecl_current_b").alias("ecl_now"), *[c.alias(n) for n, c in end.items()]
    ).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("kpi"), F.col(n).alias("value")) for n in ("ecl_now", *end)
    ])))
    down = migration.agg(
        F.coalesce(F.sum(F.when((F.col("stage_t") == 1) & (F.col("stage_t1") > 1), F.col("pct"))), F.lit(0.0)).alias("value")
    ).select(F.lit("stage1_downgrade_pct").alias("kpi"), "value")
    peak = hourly.agg(
        F.min_by(F.col("hour").cast("double"), F.struct(-F.col("high_risk_pct"), F.col("hour"))).alias("value")
    ).select(F.lit("peak_hour").alias("kpi"), "value")
    return proj.unionByName(down).unionByName(peak)


def scenario_summary(projection: DataFrame) -> DataFrame:
    return projection.groupBy("scenario").agg(
        F.max_by("ecl_b", "month").alias("end_ecl_b"), F.max("ecl_current_b").alias("ecl_current_b"),
        F.max("weight").alias("weight"),
    ).select(
        "scenario", "end_ecl_b",
        ((safe_div("end_ecl_b", "ecl_current_b") - 1) * 100).alias("change_pct"), "weight",
    )


def capital_buffer(projection: DataFrame) -> DataFrame:
    at = {
        s: F.max_by(F.when(F.col("scenario") == s, F.col("ecl_b")), F.when(F.col("scenario") == s, F.col("month")))
        for s in ("Severe", "Base")
    }
    return projection.agg((at["Severe"] - at["Base"]).alias("capital_buffer_b"))


def mean_rate(grouped: DataFrame, c: str = "default_rate_pct") -> DataFrame:
    return grouped.agg(F.avg(c).alias("mean_rate_pct"))


def off_hours_gap(hourly: DataFrame) -> DataFrame:
    off = (F.col("hour") < 6) | (F.col("hour") >= 22)
    business = (F.col("hour") >= 9) & (F.col("hour") < 17)
    return hourly.agg(
        F.avg(F.when(off, F.col("high_risk_pct"))).alias("off_hours_pct"),
        F.avg(F.when(business, F.col("high_risk_pct"))).alias("business_hours_pct"),
    ).withColumn("gap", F.col("off_hours_pct") - F.col("business_hours_pct"))
