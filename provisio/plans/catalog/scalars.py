"""Scalar functions of the engine on whole tables."""

from pyspark.sql import functions as F

from provisio.functions import semantics as S
from provisio.plans.catalog.registry import query


@query(
    "sca01_arithmetic",
    "select sk_id_curr, abs(days_birth) as age_days, -days_birth as negated, amt_credit + amt_income_total as total, amt_credit - amt_income_total as gap, amt_credit / 12e0 as monthly from px_application",
    {"monthly": 6},
)
def _(v):
    a, b = F.col("amt_credit"), F.col("amt_income_total")
    return v.application.select(
        "sk_id_curr", F.abs("days_birth").alias("age_days"), (-F.col("days_birth")).alias("negated"),
        (a + b).alias("total"), (a - b).alias("gap"), (a / 12.0).alias("monthly"),
    )


@query("sca02_power", "select sk_id_curr, pow(1e0 - pred_prob, coalesce(credit_term, 36e0) / 12e0) as survival from px_scored", {"survival": 9})
def _(v):
    return v.scored.select(
        "sk_id_curr", F.pow(1.0 - F.col("pred_prob"), F.coalesce("credit_term", F.lit(36.0)) / 12.0).alias("survival")
    )


@query("sca03_natural_log", "select sk_id_curr, ln(amt_income_total) as log_income from px_application", {"log_income": 9})
def _(v):
    return v.application.select("sk_id_curr", F.log("amt_income_total").alias("log_income"))


@query(
    "sca04_rounding",
    "select l_orderkey, l_linenumber, round_even(l_quantity / 2e0, 0) as half_even, round(l_quantity / 2e0, 0) as half_up from lineitem",
)
def _(v):
    half = F.col("l_quantity") / 2.0
    return v.table("lineitem").select("l_orderkey", "l_linenumber", F.bround(half, 0).alias("half_even"), F.round(half, 0).alias("half_up"))


@query(
    "sca07_boolean_to_int",
    "select sk_id_curr, case when ext_source_1 > 0.5 then 1 else 0 end as strong from px_application",
)
def _(v):
    return v.application.select("sk_id_curr", S.flag(F.col("ext_source_1") > 0.5).alias("strong"))


@query(
    "sca08_text_search",
    "select sk_id_curr, contains(upper(name_contract_type), 'CASH') as is_cash, upper(code_gender) as gender from px_application",
)
def _(v):
    return v.application.select(
        "sk_id_curr", F.upper("name_contract_type").contains("CASH").alias("is_cash"), F.upper("code_gender").alias("gender")
    )


@query(
    "sca13_period_labels",
    """select sk_id_curr, cast(year(d) as varchar) || 'Q' || cast(quarter(d) as varchar) as cohort, strftime(d, '%Y-%m') as month
    from (select sk_id_curr, date '2016-06-01' - cast(least(abs(days_id_publish), 1460) as integer) as d from px_scored)""",
)
def _(v):
    d = S.days_before_reference(S.clip(F.abs(F.col("days_id_publish")), 0, 1460))
    return v.scored.select("sk_id_curr", S.quarter_label(d).alias("cohort"), S.month_label(d).alias("month"))


@query("sca14_current_timestamp", "select sk_id_curr, true as stamped from px_application")
def _(v):
    return v.application.select("sk_id_curr", (F.current_timestamp() > F.lit("2016-06-01").cast("timestamp")).alias("stamped"))


@query(
    "sca15_map_lookup",
    "select sk_id_curr, case weekday_appr_process_start when 'MONDAY' then 1 when 'SUNDAY' then 7 else 0 end as day_number from px_scored",
)
def _(v):
    return v.scored.select("sk_id_curr", S.map_lookup("weekday_appr_process_start", {"MONDAY": 1, "SUNDAY": 7}, 0).alias("day_number"))
