"""Per-client aggregates and joins."""

from pyspark.sql import functions as F

from provisio.operators import business as B
from provisio.operators import cleaning as C
from provisio.operators import credit_loss as L
from provisio.operators import history as H
from provisio.operators import joins as J
from provisio.operators.audit import missing_rates
from provisio.plans.catalog.registry import PARTS, query
from provisio.session import write_once


def _r(num, den):
    return f"{num} / ({den} + 1e-6)"


PARTS["px_bureau_agg"] = f"""
select *, case when bureau_bad_debt_count > 0 then 1 else 0 end as bureau_bad_debt_flag,
 {_r('bureau_active_count', 'bureau_loan_count')} as bureau_active_ratio, {_r('bureau_debt_sum', 'bureau_credit_sum')} as bureau_debt_credit_ratio
from (select sk_id_curr, count(sk_id_bureau) as bureau_loan_count, count(*) filter (credit_active = 'Active') as bureau_active_count,
 count(*) filter (credit_active = 'Closed') as bureau_closed_count, coalesce(sum(amt_credit_sum), 0e0) as bureau_credit_sum,
 avg(amt_credit_sum) as bureau_credit_mean, max(amt_credit_sum) as bureau_credit_max, coalesce(sum(amt_credit_sum_debt), 0e0) as bureau_debt_sum,
 avg(amt_credit_sum_overdue) as bureau_overdue_mean, max(amt_credit_sum_overdue) as bureau_overdue_max, avg(days_credit) as bureau_days_credit_mean,
 max(days_credit_enddate) as bureau_days_enddate_max, count(*) filter (credit_day_overdue > 0) as bureau_bad_debt_count,
 max(credit_day_overdue) as bureau_overdue_days_max, cast(coalesce(sum(cnt_credit_prolong), 0) as bigint) as bureau_prolong_sum
 from px_bureau group by sk_id_curr)"""
PARTS["px_previous_agg"] = f"""
select *, {', '.join(f"{_r(f'prev_{n}_count', 'prev_app_count')} as prev_{n}_ratio" for n in ('refused', 'approved', 'canceled', 'consumer'))}
from (select sk_id_curr, count(sk_id_prev) as prev_app_count,
 {', '.join(f"count(*) filter (name_contract_status = '{s}') as prev_{s.lower()}_count" for s in ('Approved', 'Refused', 'Canceled'))},
 avg(amt_credit) as prev_credit_mean, max(amt_credit) as prev_credit_max, avg(amt_annuity) as prev_annuity_mean,
 avg(amt_down_payment) as prev_down_payment_mean, avg(days_decision) as prev_days_decision_mean,
 {', '.join(f"count(*) filter (name_contract_type = '{t} loans') as prev_{t.lower()}_count" for t in ('Consumer', 'Cash', 'Revolving'))}
 from px_previous_application group by sk_id_curr)"""
PARTS["px_inst_agg"] = f"""
select *, {_r('inst_late_payment_count', 'inst_total_count')} as inst_late_ratio
from (select sk_id_curr, avg(payment_diff) as inst_payment_diff_mean, max(payment_diff) as inst_payment_diff_max,
 coalesce(sum(payment_diff), 0e0) as inst_payment_diff_sum, avg(days_past_due) as inst_days_past_due_mean,
 max(days_past_due) as inst_days_past_due_max, count(*) filter (days_past_due > 0) as inst_late_payment_count,
 count(*) filter (days_past_due = 0) as inst_on_time_count, count(days_past_due) as inst_total_count,
 avg(amt_payment) as inst_amt_payment_mean, avg(amt_instalment) as inst_amt_instalment_mean from px_inst_clean group by sk_id_curr)"""
PARTS["px_pos_agg"] = f"""
select *, {_r('pos_completed_count', 'pos_months_count')} as pos_completed_ratio, {_r('pos_late_count', 'pos_months_count')} as pos_late_ratio
from (select sk_id_curr, avg(sk_dpd) as pos_dpd_mean, max(sk_dpd) as pos_dpd_max, avg(sk_dpd_def) as pos_dpd_def_mean,
 max(sk_dpd_def) as pos_dpd_def_max, count(months_balance) as pos_months_count, avg(cnt_instalment) as pos_cnt_instalment_mean,
 count(*) filter (name_contract_status = 'Active') as pos_active_count, count(*) filter (name_contract_status = 'Completed') as pos_completed_count,
 count(*) filter (sk_dpd > 0) as pos_late_count from px_pos_cash group by sk_id_curr)"""
PARTS["px_card_agg"] = f"""
select *, {_r('cc_late_count', 'cc_months_count')} as cc_late_ratio
from (select sk_id_curr, avg(amt_balance) as cc_balance_mean, max(amt_balance) as cc_balance_max, avg(amt_credit_limit_actual) as cc_limit_mean,
 max(amt_credit_limit_actual) as cc_limit_max, avg(utilization_ratio) as cc_utilization_mean, max(utilization_ratio) as cc_utilization_max,
 avg(sk_dpd) as cc_dpd_mean, max(sk_dpd) as cc_dpd_max, avg(sk_dpd_def) as cc_dpd_def_mean, count(months_balance) as cc_months_count,
 avg(amt_drawings_current) as cc_drawings_mean, max(amt_drawings_current) as cc_drawings_max, avg(amt_payment_current) as cc_payment_mean,
 count(*) filter (sk_dpd > 0) as cc_late_count from px_card_clean group by sk_id_curr)"""

_SHARES = ["bureau_active_ratio", "bureau_debt_credit_ratio"]


def bureau_agg(v):
    return H.bureau_features(v.bureau)


def previous_agg(v):
    return H.previous_features(v.previous)


def inst_agg(v, columns=C.INSTALMENT_COLUMNS):
    """Instalment aggregates; only ``columns`` of the view go through the join, the fit and the write."""
    inst = write_once(v.instalments.select(H.KEY, *columns), "instalments")
    return H.instalment_features(C.clean_instalments(inst))


def pos_agg(v):
    return H.pos_features(v.pos)


def card_agg(v):
    return H.card_features(C.clean_card(v.card))


@query(
    "agg01_bureau_features", "select * from px_bureau_agg",
    {"bureau_credit_sum bureau_credit_mean bureau_debt_sum bureau_overdue_mean bureau_days_credit_mean": 4, " ".join(_SHARES): 8},
)
def _(v):
    return bureau_agg(v)


@query(
    "agg02_previous_features", "select * from px_previous_agg",
    {"prev_credit_mean prev_annuity_mean prev_down_payment_mean prev_days_decision_mean": 4,
     "prev_refused_ratio prev_approved_ratio prev_canceled_ratio prev_consumer_ratio": 8},
)
def _(v):
    return previous_agg(v)


@query(
    "agg03_instalment_features", "select * from px_inst_agg",
    {"inst_payment_diff_mean inst_payment_diff_max inst_payment_diff_sum inst_days_past_due_mean inst_amt_payment_mean inst_amt_instalment_mean": 4,
     "inst_late_ratio": 8},
)
def _(v):
    return inst_agg(v)


@query(
    "agg04_pos_features", "select * from px_pos_agg",
    {"pos_dpd_mean pos_dpd_def_mean pos_cnt_instalment_mean": 6, "pos_completed_ratio pos_late_ratio": 8},
)
def _(v):
    return pos_agg(v)


@query(
    "agg05_card_features", "select * from px_card_agg",
    {"cc_balance_mean cc_balance_max cc_limit_mean cc_utilization_mean cc_utilization_max cc_dpd_mean cc_dpd_def_mean cc_drawings_mean cc_payment_mean cc_drawings_max": 6,
     "cc_late_ratio": 8},
)
def _(v):
    return card_agg(v)


def joined(v, inst_columns=C.INSTALMENT_DAYS):
    """Applicants with their history; with the days alone, the aggregates of instalment amounts are left out."""
    return J.join_history(v.application, [bureau_agg(v), previous_agg(v), inst_agg(v, inst_columns), pos_agg(v), card_agg(v)])


PARTS["px_joined"] = """
select * from px_application left join px_bureau_agg using (sk_id_curr) left join px_previous_agg using (sk_id_curr)
 left join px_inst_agg using (sk_id_curr) left join px_pos_agg using (sk_id_curr) left join px_card_agg using (sk_id_curr)"""
_PICK = ["bureau_loan_count", "prev_refused_ratio", "inst_late_ratio", "pos_dpd_mean", "cc_utilization_mean"]


@query(
    "agg06_history_missing",
    "select * from (" + " union all ".join(
        f"select '{c}' as \"column\", avg(case when {c} is null then 1e0 else 0e0 end) as missing_rate from px_joined" for c in _PICK
    ) + ") where missing_rate > 0",
    {"missing_rate": 8},
)
def _(v):
    return H.history_missing(joined(v), _PICK)


@query(
    "agg06_fill_history",
    "select sk_id_curr, " + ", ".join(f"coalesce({c}, 0) as {c}" for c in _PICK) + " from px_joined",
    {" ".join(_PICK[1:]): 7},
)
def _(v):
    return H.fill_history(joined(v), _PICK).select("sk_id_curr", *_PICK)


@query(
    "jon01_join_history",
    f"select sk_id_curr, is_train, amt_credit, {', '.join(_PICK)} from px_joined",
    {" ".join(_PICK[1:]): 7},
)
def _(v):
    return joined(v).select("sk_id_curr", "is_train", "amt_credit", *_PICK)


@query(
    "jon02_unique_key",
    """select cast(sum(n) as bigint) as row_count, count(*) as key_count, count(*) filter (n > 1) as repeated_keys
    from (select count(*) as n from px_previous_application group by sk_id_curr)""",
)
def _(v):
    J.assert_unique_key(previous_agg(v))
    return J.unique_key_report(v.previous)


@query(
    "jon03_enrich_inner",
    """select s.sk_id_curr, s.pred_prob, a.ext_source_2, a.cnt_children from px_scored s join px_application a on s.sk_id_curr = a.sk_id_curr""",
)
def _(v):
    return J.enrich_inner(v.scored, v.application).select("sk_id_curr", "pred_prob", "ext_source_2", "cnt_children")


@query(
    "jon04_attach_text",
    """select s.sk_id_curr, s.name_income_type, a.name_income_type as name_income_type_raw, a.name_education_type
    from px_scored s left join px_application a on s.sk_id_curr = a.sk_id_curr""",
)
def _(v):
    return J.attach_text(v.scored, v.application, ["name_income_type", "name_education_type"]).select(
        "sk_id_curr", "name_income_type", "name_income_type_raw", "name_education_type"
    )


@query(
    "jon05_ead_lookup",
    """with j as (select s.sk_id_curr, a.amt_credit from px_scored s left join px_application a on s.sk_id_curr = a.sk_id_curr)
    select sk_id_curr, coalesce(amt_credit, (select median(amt_credit) from j)) as amt_credit from j""",
    {"amt_credit": 4},
)
def _(v):
    return J.ead_lookup(v.scored, v.application).select("sk_id_curr", "amt_credit")


@query(
    "jon06_predictions_inner",
    "select p.sk_id_curr, default_probability, risk_tier, amt_income_total from px_predictions p join px_application a on p.sk_id_curr = a.sk_id_curr",
)
def _(v):
    return J.predictions_with_application(v.predictions, v.application).select(
        "sk_id_curr", "default_probability", "risk_tier", "amt_income_total"
    )


@query(
    "jon07_left_join_version",
    """select a.sk_id_curr, f.bureau_loan_count, p.default_probability from px_application a left join px_bureau_agg f on f.sk_id_curr = a.sk_id_curr
    left join px_predictions p on p.sk_id_curr = a.sk_id_curr and p.model_version = 'lgbm_v1'""",
)
def _(v):
    return J.left_join_version(
        v.application.select("sk_id_curr"), bureau_agg(v).select("sk_id_curr", "bureau_loan_count"),
        v.predictions.select("sk_id_curr", "model_version", "default_probability"), "lgbm_v1",
    ).select("sk_id_curr", "bureau_loan_count", "default_probability")


@query(
    "jon08_lookup_default",
    """select s.sk_id_curr, coalesce(m.n_name, 'UNKNOWN') as n_name from (select sk_id_curr, region_rating * 9 as k from px_scored) s
    left join nation m on s.k = m.n_nationkey""",
)
def _(v):
    df = v.scored.select("sk_id_curr", (F.col("region_rating") * 9).alias("k"))
    return J.lookup(df, "k", v.table("nation"), "n_nationkey", "n_name", "UNKNOWN").select("sk_id_curr", "n_name")


@query(
    "jon09_orphans",
    """select user_id as sk_id_curr, count(*) as row_count from events where user_id not in (select c_custkey from customer where c_custkey > 20)
    group by user_id""",
)
def _(v):
    child = v.table("events").select(F.col("user_id").alias("sk_id_curr"))
    return J.orphans(child, v.application.filter("sk_id_curr > 20"))


@query(
    "src10_ensure_columns",
    """select s.sk_id_curr, s.amt_credit, a.ext_source_2, a.name_education_type from px_scored s left join px_application a on s.sk_id_curr = a.sk_id_curr""",
)
def _(v):
    return J.ensure_columns(v.scored, v.application, ["amt_credit", "ext_source_2", "name_education_type", "not_there"]).select(
        "sk_id_curr", "amt_credit", "ext_source_2", "name_education_type"
    )


@query(
    "set01_union_by_name",
    """select sk_id_curr, target, amt_credit from px_application where is_train = 1
    union all select sk_id_curr, null, amt_credit from px_application where is_train = 0""",
)
def _(v):
    a = v.application.filter("is_train = 1").select("sk_id_curr", "target", "amt_credit")
    b = v.application.filter("is_train = 0").select("amt_credit", "sk_id_curr")
    return B.union_by_name(a, b)


@query(
    "set02_union_all",
    "select sk_id_curr, sk_dpd from px_pos_cash union all select sk_id_curr, sk_dpd from px_credit_card",
)
def _(v):
    return B.union_all([v.pos.select("sk_id_curr", "sk_dpd"), v.card.select("sk_id_curr", "sk_dpd")])


@query(
    "agg_top_missing_after_join",
    "select 'bureau_credit_mean' as \"column\", avg(case when bureau_credit_mean is null then 1e0 else 0e0 end) as missing_rate from px_joined",
    {"missing_rate": 8},
)
def _(v):
    return missing_rates(joined(v).select("bureau_credit_mean"))


@query(
    "agg_portfolio_exposure",
    "select sum(ead) as total_ead, avg(lgd) as avg_lgd from px_loan_base",
    {"total_ead": 1, "avg_lgd": 8},
)
def _(v):
    return L.ead(L.lgd(v.scored)).agg(F.sum("ead").alias("total_ead"), F.avg("lgd").alias("avg_lgd"))
