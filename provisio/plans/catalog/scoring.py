"""Batch-scoring queries. The applicants of px_application are the requests; the fixed score
below stands for the models, so that SQL can check everything around them."""

from pyspark.sql import functions as F

from provisio.operators import models as MD
from provisio.operators import scoring as S
from provisio.plans.catalog.registry import PARTS, query

FEATURES = ["ext_source_1", "ext_source_2", "ext_source_3", "amt_credit", "amt_annuity", "amt_income_total",
            "credit_income_ratio", "cnt_children"]

# Requests: some fields out of bounds, some missing, one free-form value.
PARTS["px_requests"] = """
select sk_id_curr, case when sk_id_curr % 50 = 0 then 1.5e0 else ext_source_2 end as ext_source_2, ext_source_3,
 case when sk_id_curr % 61 = 0 then 0e0 else amt_credit end as amt_credit, amt_income_total, cast(amt_annuity as double) as amt_annuity,
 -days_birth / 365e0 as age_years, cast(cnt_children as int) as cnt_children,
 case when sk_id_curr % 9 = 0 then 3.5e0 end as credit_income_ratio from px_application"""
_BAD = """case when ext_source_2 < 0 or ext_source_2 > 1 then 'ext_source_2' end, case when amt_credit <= 0 then 'amt_credit' end,
 case when age_years < 18 or age_years > 70 then 'age_years' end"""


def requests(v):
    a = v.application
    k = F.col("sk_id_curr")
    return a.select(
        "sk_id_curr", F.when(k % 50 == 0, 1.5).otherwise(F.col("ext_source_2")).alias("ext_source_2"), "ext_source_3",
        F.when(k % 61 == 0, 0.0).otherwise(F.col("amt_credit")).alias("amt_credit"), "amt_income_total",
        F.col("amt_annuity").cast("double").alias("amt_annuity"), (-F.col("days_birth") / 365.0).alias("age_years"),
        F.col("cnt_children").cast("int").alias("cnt_children"),
        F.when(k % 9 == 0, 3.5).alias("credit_income_ratio"),
        F.when(k % 10 == 0, F.create_map(F.lit("ext_source_1"), F.lit(0.9))).alias("extra_features"),
    )


def stats(v):
    train = v.application.filter("is_train = 1").withColumn(
        "credit_income_ratio", F.col("amt_credit") / (F.col("amt_income_total") + 1e-6)
    )
    return S.feature_stats(train, FEATURES)


PARTS["px_stat_rows"] = "select *, amt_credit / (amt_income_total + 1e-6) as credit_income_ratio from px_application where is_train = 1"
PARTS["px_stats"] = " union all ".join(
    f"""select '{c}' as feature, cast(median({c}) as double) as median, avg({c}) as mean, stddev_samp({c}) as std,
    cast(quantile_cont({c}, 0.01) as double) as p01, cast(quantile_cont({c}, 0.99) as double) as p99 from px_stat_rows""" for c in FEATURES
)
PARTS["px_request_rows"] = """
select sk_id_curr, amt_credit as requested_amount,
 coalesce(case when sk_id_curr % 10 = 0 then 0.9e0 end, (select median from px_stats where feature = 'ext_source_1')) as ext_source_1,
 """ + ", ".join(
    f"coalesce({c}, (select median from px_stats where feature = '{c}')) as {c}"
    for c in ("ext_source_2", "ext_source_3", "amt_credit", "amt_annuity", "amt_income_total", "cnt_children")
) + """,
 coalesce(credit_income_ratio, amt_credit / (amt_income_total + 1e-6), (select median from px_stats where feature = 'credit_income_ratio')) as credit_income_ratio
from px_requests"""


@query(
    "sco01_validate",
    f"select sk_id_curr, concat_ws(',', {_BAD}) as violations, concat_ws(',', {_BAD}) = '' as is_valid from px_requests",
)
def _(v):
    return S.validate_applicants(requests(v)).select("sk_id_curr", F.array_join("violations", ",").alias("violations"), "is_valid")


@query("sco02_feature_rows", f"select sk_id_curr, {', '.join(FEATURES)} from px_request_rows", {" ".join(FEATURES): 6})
def _(v):
    return S.assemble_features(requests(v), S.medians_of(stats(v))).select("sk_id_curr", *FEATURES)


@query(
    "sco03_auto_ratios",
    "select sk_id_curr, coalesce(credit_income_ratio, amt_credit / (amt_income_total + 1e-6)) as credit_income_ratio from px_requests",
    {"credit_income_ratio": 7},
)
def _(v):
    df = requests(v)
    return df.select("sk_id_curr", F.coalesce("credit_income_ratio", S.auto_ratio("credit_income_ratio", df)).alias("credit_income_ratio"))


def _tier_sql(p):
    b = [f"{x}::double" for x in ("0.0", "0.27892775991838853", "0.45654430591731376", "0.6493265692008885", "1.0")]
    return "case " + " ".join(
        f"when {p} between {b[i]} and {b[i + 1]} then '{t}'" for i, t in enumerate(("Very Low", "Low", "Medium", "High"))
    ) + " else 'High' end"


@query("sco05_assign_tier", f"select sk_id_curr, {_tier_sql('pred_prob * 1.3e0 - 0.1e0')} as risk_tier from px_scored")
def _(v):
    return v.scored.select("sk_id_curr", S.assign_tier(F.col("pred_prob") * 1.3 - 0.1).alias("risk_tier"))


@query(
    "sco06_recommendation",
    "select risk_tier, case risk_tier " + """when 'Very Low' then 'AUTO-APPROVE: Eligible for fast-track approval and preferential rate.'
     when 'Low' then 'STANDARD: Approve via standard process. Income verification recommended.'
     when 'Medium' then 'CONDITIONAL: Approve with conditions — reduce limit by 20%, require documentation.'
     when 'High' then 'REVIEW: Manual underwriter review required. Consider collateral or co-borrower.'"""
    + " end as recommendation, count(*) as loan_count from px_predictions group by 1, 2",
)
def _(v):
    return v.predictions.groupBy("risk_tier", S.recommendation("risk_tier").alias("recommendation")).agg(
        F.count(F.lit(1)).alias("loan_count")
    )


@query("sco07_ecl_estimate", "select sk_id_curr, pred_prob * 0.65e0 * coalesce(amt_credit, 0e0) as ecl_estimate from px_scored", {"ecl_estimate": 4})
def _(v):
    return v.scored.select("sk_id_curr", S.ecl_estimate("pred_prob", "amt_credit").alias("ecl_estimate"))


_LONG = " union all ".join(
    f"select sk_id_curr, {i} as i, '{f}' as f, {f}::double as x, (select median from px_stats where feature = '{f}') as m from px_request_rows"
    for i, f in enumerate(FEATURES)
)
PARTS["px_top_factors"] = f"""
select sk_id_curr, string_agg(f, ',' order by r) as top_risk_factors from (
 select sk_id_curr, f, row_number() over (partition by sk_id_curr order by abs((x - m) / (abs(m) + 1e-9)) desc, i) as r from ({_LONG}) where m <> 0)
where r <= 3 group by sk_id_curr"""


@query("sco08_top_risk_factors", "select * from px_top_factors")
def _(v):
    medians = S.medians_of(stats(v))
    rows = S.assemble_features(requests(v), medians)
    return rows.select("sk_id_curr", F.array_join(S.top_risk_factors(medians), ",").alias("top_risk_factors"))


def scorer(rows):
    """Fixed stand-in for the models: falls with the external score, rises with leverage."""
    raw = 0.9 - 0.8 * F.col("ext_source_2") + 0.01 * F.col("credit_income_ratio")
    return rows.withColumn("pd_raw", raw).withColumn("pd_calibrated", MD.clip_pd(raw))


_RAW = "(0.9e0 - 0.8e0 * ext_source_2 + 0.01e0 * credit_income_ratio)"


@query(
    "sco09_score_batch",
    f"""with ok as (select r.*, least(greatest({_RAW.replace('ext_source_2', 'r.ext_source_2').replace('credit_income_ratio', 'r.credit_income_ratio')}, 0.001e0), 0.999e0) as p,
      {_RAW.replace('ext_source_2', 'r.ext_source_2').replace('credit_income_ratio', 'r.credit_income_ratio')} as raw from px_request_rows r
      where sk_id_curr in (select sk_id_curr from px_requests where concat_ws(',', {_BAD}) = ''))
    select sk_id_curr, round_even(raw, 6) as pd_raw, round_even(p, 6) as pd_calibrated, {_tier_sql('p')} as risk_tier,
     round_even(p * 0.65e0 * coalesce(requested_amount, 0e0), 2) as ecl_estimate, top_risk_factors from ok join px_top_factors using (sk_id_curr)
    union all select sk_id_curr, 0e0, 0e0, 'Unknown', 0e0, '' from px_requests where concat_ws(',', {_BAD}) <> ''""",
    {"pd_raw pd_calibrated": 6, "ecl_estimate": 2},
)
def _(v):
    out = S.score_batch(requests(v), S.medians_of(stats(v)), scorer)
    return out.select(
        "sk_id_curr", "pd_raw", "pd_calibrated", "risk_tier", "ecl_estimate", F.array_join("top_risk_factors", ",").alias("top_risk_factors")
    )


@query("sco10_feature_stats", "select * from px_stats", {"median mean std p01 p99": 5})
def _(v):
    return stats(v)
