"""Credit-loss queries."""

from pyspark.sql import functions as F

from provisio.operators import credit_loss as C
from provisio.plans.catalog.registry import query


@query("ecl01_lgd", "select sk_id_curr, name_contract_type, lgd from px_loan_base")
def _(v):
    return C.lgd(v.scored).select("sk_id_curr", "name_contract_type", "lgd")


@query("ecl02_ead", "select sk_id_curr, ead from px_loan_base", {"ead": 4})
def _(v):
    return C.ead(v.scored).select("sk_id_curr", "ead")


@query(
    "ecl03_lgd_sensitivity",
    """
    with m as (select sum(ead) as e, avg(pred_prob) as p, avg(lgd) as b from px_loan_base),
    s as (select 'Optimistic' as scenario, greatest(0.1e0, b - 0.15e0) as avg_lgd, e, p from m
     union all select 'Base', b, e, p from m
     union all select 'Adverse', least(0.95e0, b + 0.15e0), e, p from m
     union all select 'Severe', least(0.99e0, b + 0.3e0), e, p from m)
    select scenario, avg_lgd, e * p * avg_lgd as total_ecl, e * p * avg_lgd / e * 1e2 as coverage_pct from s
    """,
    {"avg_lgd coverage_pct": 8, "total_ecl": 1},
)
def _(v):
    return C.lgd_sensitivity(C.ead(C.lgd(v.scored)))


@query("ecl04_stage", "select sk_id_curr, stage from px_loan_base")
def _(v):
    return C.classify_stage(v.scored).select("sk_id_curr", "stage")


@query(
    "ecl05_pd_term",
    "select sk_id_curr, pd_12m, pd_lifetime, pd_multiplier, loan_term_yrs from px_loan_term",
    {"pd_12m pd_lifetime pd_multiplier loan_term_yrs": 9},
)
def _(v):
    return C.pd_term(v.scored).select("sk_id_curr", "pd_12m", "pd_lifetime", "pd_multiplier", "loan_term_yrs")


_OVERLAY = ["sk_id_curr"] + [
    f"{b}_{n}" for b in ("pd_12m", "pd_lifetime") for n in ("optimistic", "base", "adverse", "severe", "macro")
] + ["macro_uplift_12m_pct"]


@query("ecl06_macro_overlay", f"select {', '.join(_OVERLAY)} from px_loans", {" ".join(_OVERLAY[1:]): 9})
def _(v):
    return C.macro_overlay(C.pd_term(v.scored)).select(*_OVERLAY)


@query("ecl08_loan_ecl", "select sk_id_curr, stage, ecl, ecl_rate from px_loans", {"ecl": 4, "ecl_rate": 8})
def _(v):
    return v.loans.select("sk_id_curr", "stage", "ecl", "ecl_rate")


@query(
    "ecl09_stage_summary",
    """
    select stage, count(ecl) as loan_count, round_even(sum(ead) / 1e9, 2) as total_ead_b,
     round_even(sum(ecl) / 1e9, 2) as total_ecl_b, avg(pd_12m_macro) as avg_pd_12m,
     avg(pd_lifetime_macro) as avg_pd_lifetime, avg(lgd) as avg_lgd, avg(ecl_rate) as ecl_coverage
    from px_loans group by stage
    """,
    {"avg_pd_12m avg_pd_lifetime avg_lgd ecl_coverage": 8},
)
def stage_summary(v):
    return C.stage_summary(v.loans)


@query(
    "ecl10_stage_distribution",
    """
    select stage, count(*) as loan_count, sum(ead) as ead, sum(ecl) as ecl,
     count(*) * 100e0 / sum(count(*)) over () as pct from px_loans group by stage
    """,
    {"ead ecl": 1, "pct": 8},
)
def _(v):
    return C.stage_distribution(v.loans)


@query(
    "ecl10_portfolio_totals",
    "select count(*) as loan_count, sum(ead) as ead, sum(ecl) as ecl, sum(ecl) / sum(ead) * 1e2 as coverage_pct from px_loans",
    {"ead ecl": 1, "coverage_pct": 8},
)
def _(v):
    return C.portfolio_totals(v.loans)


def _scenario_sql(name, weight):
    n = name.lower()
    return f"""select '{name}' as scenario, {weight} as weight, sum(case stage when 1 then pd_12m_{n} * lgd * ead
     when 2 then pd_lifetime_{n} * lgd * ead else lgd * ead end) as total_ecl from px_loans"""


@query(
    "ecl11_scenario_ecl",
    " union all ".join(
        _scenario_sql(n, w) for n, w in (("Optimistic", "0.2e0"), ("Base", "0.5e0"), ("Adverse", "0.2e0"), ("Severe", "0.1e0"))
    ),
    {"total_ecl": 1},
)
def _(v):
    return C.scenario_ecl(v.loans)


@query(
    "ecl12_overlay_report",
    """
    select avg(pd_12m) as pd_12m_before, avg(pd_12m_macro) as pd_12m_after, avg(pd_lifetime) as pd_lifetime_before,
     avg(pd_lifetime_macro) as pd_lifetime_after, (avg(pd_12m_macro) / avg(pd_12m) - 1) * 1e2 as uplift_pct from px_loans
    """,
    {"pd_12m_before pd_12m_after pd_lifetime_before pd_lifetime_after uplift_pct": 8},
)
def _(v):
    return C.overlay_report(v.loans)


@query(
    "prj13_priority_stage",
    "select stage, count(*) as loan_count from px_loan_base group by stage",
)
def _(v):
    return C.classify_stage(v.scored).groupBy("stage").agg(F.count(F.lit(1)).alias("loan_count"))
