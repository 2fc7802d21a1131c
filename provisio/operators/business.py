"""Department lists, warehouse views and table checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "sk_id_curr"
RISK_TIERS = ("Very Low", "Low", "Medium", "High")


def applicant_risk_profile(a: DataFrame, f: DataFrame, p: DataFrame, version: str = "lgbm_v1") -> DataFrame:
    """Training applicants with features and the prediction of one model version."""
    from_a = [
        KEY, "target", "code_gender", "name_income_type", "name_education_type", "name_contract_type",
        "amt_credit", "amt_income_total", "ext_source_2", "ext_source_3",
    ]
    scored = p.filter(F.col("model_version") == version).select(KEY, "default_probability", "risk_tier")
    features = f.select(KEY, "age_years", "credit_income_ratio", "bureau_bad_debt_flag", "prev_refused_ratio")
    return (
        a.filter(F.col("is_test") == 0).select(*from_a)
        .join(features, KEY, "left").join(scored, KEY, "left")
    )


def default_rate_by_segment(a: DataFrame) -> DataFrame:
    return (
        a.filter(F.col("is_test") == 0)
        .groupBy("name_income_type", "name_education_type", "code_gender")
        .agg(
            F.count(F.lit(1)).alias("applicant_count"), F.sum(F.col("target").cast("long")).alias("default_count"),
            (F.avg(F.col("target").cast("double")) * 100).alias("default_rate_pct"),
            F.avg("amt_credit").alias("avg_credit_amount"), F.avg("amt_income_total").alias("avg_income"),
        )
    )


def phone(key: Column) -> Column:
    return F.concat(F.lit("09"), F.right((key.cast("long") * 1234567).cast("string"), F.lit(8)))


def email(key: Column) -> Column:
    return F.concat(F.lit("khachhang_"), key.cast("string"), F.lit("@gmail.com"))


def contact_columns(df: DataFrame, key: str = KEY) -> DataFrame:
    """Invented contact data derived from the key."""
    return df.withColumns({"phone": phone(F.col(key)), "email": email(F.col(key))})


def _money(c: str | Column) -> Column:
    """Two places, half away from zero, decided on the decimal value as the warehouse does."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(24,6)"), 2).cast("double")


def _pct(c: str = "default_probability") -> Column:
    return _money(F.col(c) * 100)


def collections_list(p: DataFrame, a: DataFrame, n: int = 1000, cutoff: float = 0.48) -> DataFrame:
    """Highest-risk customers first: a top-n, so no full sort."""
    picked = p.filter((F.col("risk_tier") == "High") & (F.col("default_probability") > cutoff))
    top = picked.join(
        a.select(KEY, "code_gender", "name_income_type", "amt_income_total", "amt_credit"), KEY
    ).orderBy(F.desc("default_probability"), KEY).limit(n)
    return contact_columns(top).select(
        KEY, "code_gender", "name_income_type", "amt_income_total", "amt_credit",
        _pct().alias("default_pct"), "risk_tier", _money("ecl").alias("expected_loss"), "phone", "email",
    )


def auto_approve_list(p: DataFrame, a: DataFrame) -> DataFrame:
    picked = p.filter((F.col("default_probability") < 0.15) & F.col("risk_tier").isin("Very Low", "Low"))
    return (
        picked.join(a.select(KEY, "amt_credit", "amt_income_total"), KEY)
        .orderBy("default_probability", KEY)
        .select(KEY, "amt_credit", "amt_income_total", _pct().alias("default_pct"),
                F.lit("AUTO-APPROVE").alias("decision"), F.current_timestamp().alias("decided_at"))
    )


def provision_by_stage(p: DataFrame) -> DataFrame:
    return (
        p.filter(F.col("stage").isNotNull()).groupBy("stage")
        .agg(F.count(KEY).alias("loan_count"), F.sum("ead").alias("total_ead"), F.sum("ecl").alias("total_ecl"))
        .withColumn("coverage_pct", _money(F.try_divide("total_ecl", "total_ead") * 100))
        .orderBy("stage")
    )


def upsell_list(p: DataFrame, a: DataFrame) -> DataFrame:
    wealthy = a.filter(F.col("amt_income_total") > 200000).select(KEY, "amt_income_total", "name_income_type")
    return (
        p.filter(F.col("default_probability") < 0.05).join(wealthy, KEY)
        .orderBy(F.desc("amt_income_total"), KEY)
        .select(KEY, "amt_income_total", "name_income_type", _pct().alias("default_pct"),
                F.lit("Telesale - Mo The Tin Dung").alias("campaign"))
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ])


def target_share(a: DataFrame) -> DataFrame:
    counts = a.filter(F.col("is_test") == 0).groupBy("target").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.withColumn("pct", F.col("cnt") * 100.0 / F.sum("cnt").over(Window.partitionBy()))


def anomaly_unfixed(a: DataFrame) -> DataFrame:
    bad = (F.col("days_employed") > 0) & (F.col("emp_anomaly") == 0)
    return a.agg(F.count_if(bad).alias("emp_anomaly_unfixed"))


def is_correct(p: Column, y: Column) -> Column:
    hit = ((p >= 0.5) & (y == 1)) | ((p < 0.5) & (y == 0))
    return F.when(y.isNull(), F.lit(None).cast("int")).when(hit, 1).otherwise(0)


def prediction_rules() -> dict[str, Column]:
    """Violations of the constraints of the predictions table."""
    return {
        "risk_tier_in_set": ~F.col("risk_tier").isin(*RISK_TIERS),
        "probability_in_range": ~F.col("default_probability").between(0, 1),
        "key_not_null": F.col(KEY).isNull() | F.col("model_version").isNull(),
    }


def check_constraints(df: DataFrame, rules: dict[str, Column], key: list[str]) -> DataFrame:
    """Violations per rule: one aggregate for row rules, one grouped count for the key."""
    rows = [F.struct(F.lit(n).alias("rule"), F.count_if(v).alias("violations")) for n, v in rules.items()]
    checked = df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
    repeats = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")
    ).select(F.lit("primary_key").alias("rule"), "violations")
    return checked.unionByName(repeats)
