"""Threshold, band, filter and dashboard queries."""

from pyspark.sql import functions as F

from provisio.functions import semantics as S
from provisio.operators import bands as B
from provisio.operators import dashboard as D
from provisio.operators import explain as E
from provisio.operators import roi as R
from provisio.operators import timeseries as T
from provisio.plans.catalog.registry import PARTS, query

PARTS["px_sweep_counts"] = """
with g as (select i, case when i = 99 then 0.99e0 else 0.01e0 + i * ((0.99e0 - 0.01e0) / 99) end as threshold from range(100) t(i))
select threshold, count(*) filter (target = 1 and pred_prob >= threshold) as tp, count(*) filter (target = 0 and pred_prob >= threshold) as fp,
 count(*) filter (target = 1 and pred_prob < threshold) as fn, count(*) filter (target = 0 and pred_prob < threshold) as tn
from g, px_scored group by threshold"""
PARTS["px_sweep"] = """
select *, revenue_m - opp_cost_m - loan_loss_m - opex_m as net_profit_m from (
 select s.*, tn * 0.035e0 * m / 1e6 as revenue_m, fp * 0.015e0 * m / 1e6 as opp_cost_m, fn * 0.65e0 * m / 1e6 as loan_loss_m,
  (tn + fn) * 0.002e0 * m / 1e6 as opex_m, (tn + fn) / (tp + fp + fn + tn) as approval_rate
 from px_sweep_counts s, (select avg(amt_credit) as m from px_scored))"""
_MONEY = "revenue_m opp_cost_m loan_loss_m opex_m net_profit_m"


@query("roi01_threshold_sweep", "select * from px_sweep", {"threshold approval_rate": 9, _MONEY: 5})
def _(v):
    return R.threshold_sweep(v.scored)


@query(
    "roi02_approval_quality",
    """select threshold, case when tn + fn > 0 then tn / (tn + fn) else 0e0 end as approval_precision,
     case when tn + fp > 0 then tn / (tn + fp) else 0e0 end as approval_recall from px_sweep""",
    {"threshold approval_precision approval_recall": 9},
)
def _(v):
    return R.approval_quality(R.threshold_sweep(v.scored))


@query(
    "roi03_best_threshold",
    "select * from px_sweep order by net_profit_m desc, threshold limit 1",
    {"threshold approval_rate": 9, _MONEY: 5},
)
def _(v):
    return R.best_threshold(R.threshold_sweep(v.scored))


@query(
    "roi04_decision",
    """select sk_id_curr, case when pred_prob < t then 'Approved' else 'Denied' end as decision_status
    from px_scored, (select threshold as t from px_sweep order by net_profit_m desc, threshold limit 1)""",
)
def _(v):
    best = R.best_threshold(R.threshold_sweep(v.scored)).first()["threshold"]
    return R.decision(v.scored, best).select("sk_id_curr", "decision_status")


@query(
    "roi05_credit_band",
    """select sk_id_curr, case when pred_prob <= a then 'Very Low Risk' when pred_prob <= b then 'Low Risk' when pred_prob <= c then 'Medium Risk'
     else 'High Risk' end as credit_band from px_scored, (select quantile_cont(pred_prob, 0.25) as a, median(pred_prob) as b,
     quantile_cont(pred_prob, 0.75) as c from px_scored)""",
)
def _(v):
    return R.credit_band(v.scored, R.fit_credit_band(v.scored)).select("sk_id_curr", "credit_band")


_BANDS = {
    "bnd01_term_band": ("term_bin", B.term_band), "bnd02_lti_band": ("lti_bin", B.lti_band),
    "bnd03_dti_band": ("dti_bin", B.dti_band), "bnd04_credit_amount_band": ("cred_bin", B.credit_amount_band),
    "bnd05_pd_band": ("pd_band", B.pd_band), "bnd06_risk_tier_simple": ("risk_tier", B.risk_tier_simple),
    "bnd07_stage_simple": ("stage", B.stage_simple), "bnd09_disbursement_month": ("disbursement_month", B.disbursement_month),
}
for _key, (_name, _make) in _BANDS.items():
    query(_key, f"select sk_id_curr, {_name} from px_banded")(
        lambda v, name=_name, make=_make: v.scored.select("sk_id_curr", make().alias(name))
    )


@query("bnd08_ecl_simple", "select sk_id_curr, ecl from px_banded", {"ecl": 5})
def _(v):
    return v.scored.select("sk_id_curr", B.ecl_simple().alias("ecl"))


@query("prj09_narrow", "select sk_id_curr::integer as sk_id_curr, region_rating::integer as region_rating, pred_prob::float::double as pred_prob from px_scored")
def _(v):
    df = B.narrow(v.scored.select("sk_id_curr", "region_rating", "pred_prob"), ["sk_id_curr", "region_rating", "pred_prob"])
    return df.withColumn("pred_prob", F.col("pred_prob").cast("double"))


@query(
    "prj11_two_way_conditional",
    "select sk_id_curr, case when pred_prob < 0.5 then 'Approved' else 'Denied' end as decision_status from px_scored",
)
def _(v):
    return R.decision(v.scored, 0.5).select("sk_id_curr", "decision_status")


@query("prj12_multi_way_conditional", "select risk_tier, stage, count(*) as loan_count from px_banded group by 1, 2")
def _(v):
    return v.banded.groupBy("risk_tier", "stage").agg(F.count(F.lit(1)).alias("loan_count"))


@query(
    "flt01_predicates",
    "select sk_id_curr, pred_prob, credit_term from px_scored where pred_prob > 0.48 and credit_term is not null and code_gender = 'M' and region_rating <= 2",
)
def _(v):
    return v.scored.filter(
        (F.col("pred_prob") > 0.48) & F.col("credit_term").isNotNull() & (F.col("code_gender") == "M") & (F.col("region_rating") <= 2)
    ).select("sk_id_curr", "pred_prob", "credit_term")


@query("flt02_membership", "select sk_id_curr, risk_tier from px_banded where risk_tier in ('Low', 'High')")
def _(v):
    return v.banded.filter(F.col("risk_tier").isin("Low", "High")).select("sk_id_curr", "risk_tier")


FACETS = {"family": ("Single", "Married"), "region": 2, "tiers": ("High", "Medium"), "terms": ("12", "24")}
_FACET_SQL = """name_family_status in ('Married', 'Separated', 'Single / not married', 'Widow') and region_rating = 2
 and risk_tier in ('High', 'Medium') and term_bin in ('≤18m', '24m')"""


@query("flt03_facets", f"select sk_id_curr, name_family_status, risk_tier, term_bin from px_banded where {_FACET_SQL}")
def _(v):
    return B.apply_filters(v.banded, **FACETS).select("sk_id_curr", "name_family_status", "risk_tier", "term_bin")


@query(
    "flt05_seeded_sample",
    "select sk_id_curr, pred_prob from px_scored order by md5('42:' || cast(sk_id_curr as varchar)), sk_id_curr limit 10000",
)
def _(v):
    return E.sample_rows(v.scored).select("sk_id_curr", "pred_prob")


# Dashboard


_KPIS = {
    "male": "count(*) filter ({w} code_gender = 'M')", "female": "count(*) filter ({w} code_gender = 'F')",
    "exposure": "sum(amt_credit) {f}", "ecl": "sum(ecl) {f}", "default_rate": "avg(target) {f}",
    "high_risk_share": "avg(case when risk_tier = 'High' then 1e0 else 0e0 end) {f}",
    "high_risk_ecl": "coalesce(sum(ecl) filter ({w} risk_tier = 'High'), 0e0)", "coverage": "sum(ecl) {f} / sum(amt_credit) {f}",
}


@query(
    "dsh01_kpis",
    "select " + ", ".join(f"{e.format(w='', f='')} as {n}" for n, e in _KPIS.items()) + " from px_banded",
    {"exposure ecl high_risk_ecl": 1, "default_rate high_risk_share coverage": 8},
)
def _(v):
    return D.kpis(v.banded)


@query(
    "dsh02_kpi_deltas",
    "select kpi, filtered, portfolio, case when portfolio <> 0 then filtered - portfolio end as delta from (" + " union all ".join(
        f"select '{n}' as kpi, cast({e.format(w=_FACET_SQL + ' and', f=f'filter ({_FACET_SQL})')} as double) as filtered, cast({e.format(w='', f='')} as double) as portfolio from px_banded"
        for n, e in _KPIS.items()
    ) + ")",
    {"filtered portfolio delta": 3},
)
def _(v):
    return D.kpi_deltas(v.banded, B.facet_condition(**FACETS))


@query(
    "dsh03_defaults_by_income_type",
    "select name_income_type, count(*) as default_count from px_banded where target = 1 and name_income_type is not null group by 1",
)
def _(v):
    return D.defaults_by_income_type(v.banded)


@query(
    "dsh04_defaults_by_term",
    "select term_bin, count(*) as default_count from px_banded where target = 1 and term_bin is not null group by 1",
)
def _(v):
    return D.defaults_by_term(v.banded)


@query(
    "dsh05_exposure_by_amount",
    "select cred_bin, sum(amt_credit) as exposure, avg(target) as default_rate, sum(ecl) as ecl from px_banded where cred_bin is not null group by 1",
    {"exposure ecl": 1, "default_rate": 8},
)
def _(v):
    return D.exposure_by_amount_band(v.banded)


@query(
    "dsh06_pd_distribution",
    "select pd_band, count(*) as loan_count, avg(target) as default_rate from px_banded where pd_band is not null group by 1",
    {"default_rate": 8},
)
def _(v):
    return D.pd_distribution(v.banded)


@query(
    "dsh07_ecl_by_dti",
    "select dti_bin, sum(ecl) / 1e6 as ecl_m, avg(target) as default_rate from px_banded where dti_bin is not null group by 1",
    {"ecl_m": 5, "default_rate": 8},
)
def _(v):
    return D.ecl_by_dti(v.banded)


PARTS["px_by_stage"] = "select stage, count(amt_credit) as loan_count, sum(amt_credit) as ead, sum(ecl) as ecl from px_banded group by stage"


@query("dsh08_by_stage", "select *, 'Stage ' || cast(stage as varchar) as label from px_by_stage", {"ead ecl": 1})
def _(v):
    return D.by_stage(v.banded)


@query(
    "dsh09_insights",
    """select 'high_risk_ecl_share' as insight, printf('%.4f', sum(case when risk_tier = 'High' then ecl else 0 end) / sum(ecl)) as value from px_banded
    union all (select 'top_default_income', name_income_type from px_banded where target = 1 and name_income_type is not null group by 2 order by count(*) desc, 2 limit 1)
    union all (select 'worst_lti', lti_bin from px_banded where lti_bin is not null group by 2 order by avg(target) desc limit 1)""",
)
def _(v):
    return D.insights(v.banded)


@query(
    "dsh10_stage_cards",
    "select stage, loan_count, ead, ecl, case when ead = 0 then 0e0 else ecl / ead end as coverage from px_by_stage",
    {"ead ecl": 1, "coverage": 8},
)
def _(v):
    return D.stage_cards(v.banded)


@query(
    "dsh11_by_region",
    "select region_rating, sum(amt_credit) as exposure, sum(ecl) as ecl from px_banded group by 1",
    {"exposure ecl": 1},
)
def _(v):
    return D.by_region(v.banded)


_PATHS = ", ".join(
    f"('{n}', {m}, {float(s)!r}, {T.PATH_WEIGHTS[n]!r}::double)" for n, p in T.PATHS.items() for m, s in enumerate(p, 1)
)
PARTS["px_projection"] = f"""
select m as month, n as scenario, round_even(e * s::double * pow(0.98e0, m), 3) as ecl_b, w as weight, e as ecl_current_b, d as ead_current_b
from (values {_PATHS}) t(n, m, s, w), (select sum(ecl) / 1e9 as e, sum(ead) / 1e9 as d from px_loans)"""
PARTS["px_migration_stage"] = """
select ead, case when pred_prob > 0.7 then 3 when pred_prob > 0.2 or bureau_bad_debt_flag = 1 or inst_late_ratio > 0.3 then 2 else 1 end as s0,
 case when p1 > 0.7 then 3 when p1 > 0.2 or bureau_bad_debt_flag = 1 or inst_late_ratio > 0.3 then 2 else 1 end as s1
from (select *, least(greatest(pred_prob * 1.25e0, 0e0), 0.999e0) as p1 from px_loans)"""
PARTS["px_migration"] = """
select a as stage_t, b as stage_t1, coalesce((select sum(ead) from px_migration_stage where s0 = a and s1 = b), 0e0) / 1e9 as ead_b
from (values (1), (2), (3)) x(a), (values (1), (2), (3)) y(b)"""
PARTS["px_hourly"] = """
select hour_appr_process_start as hour, avg(case when pred_prob > 0.48 then 1e0 else 0e0 end) as high_risk_rate, count(sk_id_curr) as volume,
 avg(case when pred_prob > 0.48 then 1e0 else 0e0 end) * 1e2 as high_risk_pct from px_scored group by 1"""


@query(
    "dsh12_trend_kpis",
    """select 'ecl_now' as kpi, max(ecl_current_b) as value from px_projection
    union all select 'ecl_base_end', max(ecl_b) filter (scenario = 'Base' and month = 12) from px_projection
    union all select 'ecl_severe_end', max(ecl_b) filter (scenario = 'Severe' and month = 12) from px_projection
    union all select 'stage1_downgrade_pct', sum(case when stage_t1 > 1 then ead_b end) / sum(ead_b) * 100 from px_migration where stage_t = 1
    union all (select 'peak_hour', cast(hour as double) from px_hourly order by high_risk_pct desc, hour limit 1)""",
    {"value": 6},
)
def _(v):
    cells = T.migration_pct_long(T.migration_long(v.loans))
    return D.trend_kpis(T.ecl_projection(v.loans), cells, T.intraday_hourly(v.loans))


@query(
    "dsh13_scenario_summary",
    """select scenario, max(ecl_b) filter (month = 12) as end_ecl_b, (max(ecl_b) filter (month = 12) / max(ecl_current_b) - 1) * 100 as change_pct, max(weight) as weight
    from px_projection group by scenario""",
    {"end_ecl_b": 3, "change_pct": 6},
)
def _(v):
    return D.scenario_summary(T.ecl_projection(v.loans))


@query(
    "dsh14_capital_buffer",
    """select max(ecl_b) filter (scenario = 'Severe' and month = 12) - max(ecl_b) filter (scenario = 'Base' and month = 12) as capital_buffer_b from px_projection""",
    {"capital_buffer_b": 6},
)
def _(v):
    return D.capital_buffer(T.ecl_projection(v.loans))


@query(
    "dsh16_off_hours_gap",
    """select *, off_hours_pct - business_hours_pct as gap from (select avg(high_risk_pct) filter (hour < 6 or hour >= 22) as off_hours_pct,
     avg(high_risk_pct) filter (hour between 9 and 16) as business_hours_pct from px_hourly)""",
    {"off_hours_pct business_hours_pct gap": 7},
)
def _(v):
    return D.off_hours_gap(T.intraday_hourly(v.scored))


@query(
    "sca17_unit_scaling",
    "select sum(ecl) / 1e3 as thousands, sum(ecl) / 1e6 as millions, sum(ecl) / 1e9 as billions from px_banded",
    {"thousands": 2, "millions": 5, "billions": 8},
)
def _(v):
    total = F.sum("ecl")
    return v.banded.agg((total / 1e3).alias("thousands"), (total / 1e6).alias("millions"), (total / 1e9).alias("billions"))


@query(
    "sca11_parse_label",
    "select distinct lti_bin, try_cast(split_part(lti_bin, '-', 1) as double) as lower_bound from px_banded where lti_bin is not null",
)
def _(v):
    return v.banded.filter("lti_bin is not null").select("lti_bin").distinct().withColumn(
        "lower_bound", S.parse_label("lti_bin", "-")
    )


@query(
    "sca12_dates",
    """select sk_id_curr, date '2016-06-01' - cast(least(abs(days_id_publish), 1460) as integer) as app_date from px_scored""",
)
def _(v):
    days = S.clip(F.abs(F.col("days_id_publish")), 0, 1460)
    return v.scored.select("sk_id_curr", S.days_before_reference(days).alias("app_date"))
