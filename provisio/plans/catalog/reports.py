"""Department lists, warehouse views, table checks and monitoring reports."""

from pyspark.sql import functions as F

from provisio.operators import business as B
from provisio.operators import metrics as M
from provisio.operators import monitoring as D
from provisio.plans.catalog import features as FQ
from provisio.plans.catalog import history as HQ
from provisio.plans.catalog import metrics as MQ
from provisio.plans.catalog.registry import query

_PROFILE = [
    "sk_id_curr", "target", "code_gender", "name_income_type", "name_education_type", "name_contract_type", "amt_credit",
    "amt_income_total", "age_years", "credit_income_ratio", "bureau_bad_debt_flag", "prev_refused_ratio", "ext_source_2",
    "ext_source_3", "default_probability", "risk_tier",
]


@query(
    "sql01_applicant_risk_profile",
    """select a.sk_id_curr, a.target, a.code_gender, a.name_income_type, a.name_education_type, a.name_contract_type, a.amt_credit, a.amt_income_total,
     f.age_years, f.credit_income_ratio, b.bureau_bad_debt_flag, r.prev_refused_ratio, a.ext_source_2, a.ext_source_3, p.default_probability, p.risk_tier
    from px_wh_application a left join px_engineered f on f.sk_id_curr = a.sk_id_curr left join px_bureau_agg b on b.sk_id_curr = a.sk_id_curr
     left join px_previous_agg r on r.sk_id_curr = a.sk_id_curr
     left join px_predictions p on p.sk_id_curr = a.sk_id_curr and p.model_version = 'lgbm_v1' where a.is_test = 0""",
    {"age_years credit_income_ratio prev_refused_ratio": 7},
)
def _(v):
    features = (
        FQ.engineered(v).select("sk_id_curr", "age_years", "credit_income_ratio")
        .join(HQ.bureau_agg(v).select("sk_id_curr", "bureau_bad_debt_flag"), "sk_id_curr", "left")
        .join(HQ.previous_agg(v).select("sk_id_curr", "prev_refused_ratio"), "sk_id_curr", "left")
    )
    return B.applicant_risk_profile(v.warehouse_application, features, v.predictions).select(*_PROFILE)


@query(
    "sql02_default_rate_by_segment",
    """select name_income_type, name_education_type, code_gender, count(*) as applicant_count, cast(sum(target) as bigint) as default_count,
     avg(cast(target as double)) * 100 as default_rate_pct, avg(amt_credit) as avg_credit_amount, avg(amt_income_total) as avg_income
    from px_wh_application where is_test = 0 group by 1, 2, 3""",
    {"default_rate_pct": 7, "avg_credit_amount avg_income": 4},
)
def _(v):
    return B.default_rate_by_segment(v.warehouse_application)


_PHONE = "'09' || right(cast(cast({k} as bigint) * 1234567 as varchar), 8)"


@query(
    "sql03_collections_list",
    f"""select p.sk_id_curr, a.code_gender, a.name_income_type, a.amt_income_total, a.amt_credit, cast(round(cast(default_probability * 100 as decimal(24,6)), 2) as double) as default_pct,
     p.risk_tier, cast(round(cast(ecl as decimal(24,6)), 2) as double) as expected_loss, {_PHONE.format(k='p.sk_id_curr')} as phone, 'khachhang_' || cast(p.sk_id_curr as varchar) || '@gmail.com' as email
    from px_predictions p join px_application a on p.sk_id_curr = a.sk_id_curr where p.risk_tier = 'High' and default_probability > 0.48
    order by default_probability desc, p.sk_id_curr limit 1000""",
    {"default_pct expected_loss": 2},
)
def _(v):
    return B.collections_list(v.predictions, v.application)


@query(
    "sql04_contact_columns",
    f"select sk_id_curr, {_PHONE.format(k='sk_id_curr')} as phone, 'khachhang_' || cast(sk_id_curr as varchar) || '@gmail.com' as email from px_application",
)
def _(v):
    return B.contact_columns(v.application.select("sk_id_curr"))


@query(
    "sql05_auto_approve_list",
    """select p.sk_id_curr, a.amt_credit, a.amt_income_total, cast(round(cast(default_probability * 100 as decimal(24,6)), 2) as double) as default_pct, 'AUTO-APPROVE' as decision, true as is_stamped
    from px_predictions p join px_application a on p.sk_id_curr = a.sk_id_curr where default_probability < 0.15 and risk_tier in ('Very Low', 'Low')""",
    {"default_pct": 2},
)
def _(v):
    out = B.auto_approve_list(v.predictions, v.application)
    return out.withColumn("is_stamped", F.col("decided_at") <= F.current_timestamp()).drop("decided_at")


@query(
    "sql06_provision_by_stage",
    """select stage, count(sk_id_curr) as loan_count, sum(ead) as total_ead, sum(ecl) as total_ecl, cast(round(cast(sum(ecl) / sum(ead) * 100 as decimal(24,6)), 2) as double) as coverage_pct
    from px_predictions where stage is not null group by stage""",
    {"total_ead total_ecl": 1, "coverage_pct": 2},
)
def _(v):
    return B.provision_by_stage(v.predictions)


@query(
    "sql07_upsell_list",
    """select p.sk_id_curr, a.amt_income_total, a.name_income_type, cast(round(cast(default_probability * 100 as decimal(24,6)), 2) as double) as default_pct, 'Telesale - Mo The Tin Dung' as campaign
    from px_predictions p join px_application a on p.sk_id_curr = a.sk_id_curr where default_probability < 0.05 and a.amt_income_total > 200000""",
    {"default_pct": 2},
)
def _(v):
    return B.upsell_list(v.predictions, v.application)


_TABLES = {
    "application": "px_application", "bureau": "px_bureau", "previous_application": "px_previous_application",
    "installments_payments": "px_installments", "pos_cash_balance": "px_pos_cash", "credit_card_balance": "px_credit_card",
}


@query(
    "sql08_table_counts",
    " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {t}" for n, t in _TABLES.items()),
)
def _(v):
    return B.table_counts({n: v.proxy(t) for n, t in _TABLES.items()})


@query(
    "sql09_target_share",
    "select target, count(*) as cnt, count(*) * 100.0 / sum(count(*)) over () as pct from px_wh_application where is_test = 0 group by target",
    {"pct": 7},
)
def _(v):
    return B.target_share(v.warehouse_application)


@query("win03_share_of_total", "select risk_tier, count(*) * 1e0 / sum(count(*)) over () as share from px_predictions group by 1", {"share": 9})
def _(v):
    from pyspark.sql import Window
    counts = v.predictions.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("risk_tier", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


@query(
    "sql10_anomaly_unfixed",
    "select count(*) filter (days_employed > 0 and emp_anomaly = 0) as emp_anomaly_unfixed from px_wh_application",
)
def _(v):
    return B.anomaly_unfixed(v.warehouse_application)


@query(
    "sql11_check_constraints",
    """select 'risk_tier_in_set' as rule, count(*) filter (risk_tier not in ('Very Low', 'Low', 'Medium', 'High')) as violations from px_predictions
    union all select 'probability_in_range', count(*) filter (default_probability < 0 or default_probability > 1) from px_predictions
    union all select 'key_not_null', count(*) filter (sk_id_curr is null or model_version is null) from px_predictions
    union all select 'primary_key', cast(sum(n - 1) as bigint) from (select count(*) as n from px_predictions group by sk_id_curr, model_version)""",
)
def _(v):
    return B.check_constraints(v.predictions, B.prediction_rules(), ["sk_id_curr", "model_version"])


@query(
    "prj14_is_correct",
    """select sk_id_curr, case when actual_target is null then null when default_probability >= 0.5 and actual_target = 1 then 1
     when default_probability < 0.5 and actual_target = 0 then 1 else 0 end as is_correct
    from (select sk_id_curr, default_probability, case when sk_id_curr % 10 = 0 then null else actual_target end as actual_target from px_predictions)""",
)
def _(v):
    y = F.when(F.col("sk_id_curr") % 10 != 0, F.col("actual_target"))
    return v.predictions.select("sk_id_curr", B.is_correct(F.col("default_probability"), y).alias("is_correct"))


@query(
    "sca10_concat_right_cast",
    "select sk_id_curr, right(cast(sk_id_curr as varchar), 2) as tail, 'id-' || cast(sk_id_curr as varchar) as label from px_application",
)
def _(v):
    text = F.col("sk_id_curr").cast("string")
    return v.application.select("sk_id_curr", F.right(text, F.lit(2)).alias("tail"), F.concat(F.lit("id-"), text).alias("label"))


# Sorts and top rows


@query(
    "srt01_sort",
    "select cast(row_number() over (order by amt_income_total desc, sk_id_curr) as bigint) as rank, sk_id_curr, amt_income_total from px_application",
)
def _(v):
    from provisio.functions.ranking import ranked
    df = v.application.select("sk_id_curr", "amt_income_total")
    return ranked(df, "amt_income_total", "sk_id_curr").select("rank", "sk_id_curr", "amt_income_total")


@query(
    "srt01_sort_whole",
    "select cast(row_number() over (order by amt_income_total desc, sk_id_curr) as bigint) as rank, sk_id_curr from px_application",
)
def _(v):
    from provisio.functions.ranking import ranked
    return ranked(v.application.select("sk_id_curr", "amt_income_total"), "amt_income_total", "sk_id_curr").select("rank", "sk_id_curr")


@query("srt03_top_k", "select sk_id_curr, ecl from px_loans order by ecl desc, sk_id_curr limit 25", {"ecl": 3})
def _(v):
    return v.loans.select("sk_id_curr", "ecl").orderBy(F.desc("ecl"), "sk_id_curr").limit(25)


@query("srt04_arg_max", "select sk_id_curr, amt_income_total from px_application order by amt_income_total desc, sk_id_curr limit 1")
def _(v):
    best = F.struct("amt_income_total", -F.col("sk_id_curr"))
    return v.application.agg(F.max_by("sk_id_curr", best).alias("sk_id_curr"), F.max("amt_income_total").alias("amt_income_total"))


@query("srt05_first_where", "select sk_id_curr, pred_prob from px_scored where pred_prob > 0.7 order by sk_id_curr limit 1")
def _(v):
    return v.scored.filter("pred_prob > 0.7").orderBy("sk_id_curr").limit(1).select("sk_id_curr", "pred_prob")


@query(
    "win02_sequential_rank",
    "select name_income_type, cast(row_number() over (order by count(*) desc, name_income_type) as integer) as rank from px_application where name_income_type is not null group by 1",
)
def _(v):
    from pyspark.sql import Window
    counts = v.application.filter("name_income_type is not null").groupBy("name_income_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("name_income_type", F.row_number().over(Window.orderBy(F.desc("n"), "name_income_type")).alias("rank"))


# Monitoring reports


@query(
    "doc01_tier_report",
    """select risk_tier, count(*) as loan_count, avg(actual_target) as default_rate, avg(default_probability) as avg_pd, sum(ecl) as ecl,
     count(*) * 1e2 / sum(count(*)) over () as portfolio_pct, sum(ecl) * 1e2 / sum(sum(ecl)) over () as ecl_pct from px_predictions group by 1""",
    {"default_rate avg_pd portfolio_pct ecl_pct": 7, "ecl": 1},
)
def _(v):
    return D.tier_report(v.predictions, "actual_target", "default_probability")


@query(
    "doc02_fit_tiers",
    """select 0e0 as b0, quantile_cont(pred_prob, 0.40) as b1, quantile_cont(pred_prob, 0.65) as b2, quantile_cont(pred_prob, 0.85) as b3, 1e0 as b4 from px_scored""",
    {"b1 b2 b3": 9},
)
def _(v):
    return v.spark.createDataFrame([tuple(D.fit_tiers(v.scored))], "b0 double, b1 double, b2 double, b3 double, b4 double")


@query(
    "doc04_policy_flags",
    """select sk_id_curr, amt_credit * case when lti then 0.8e0 else 1e0 end * case when bad then 0.75e0 else 1e0 end as policy_limit,
     concat_ws(',', case when lti then 'cap_credit_80' end, case when bad then 'cut_limit_25' end, case when coalesce(prev_refused_ratio, 0) > 0.3 then 'manual_review' end,
      case when inst_late_ratio > 0.1 then 'early_warning' end, case when -days_birth / 365e0 between 20 and 25 then 'risk_based_pricing' end) as policies
    from (select *, amt_credit / (amt_income_total + 1e-6) > 5 as lti, bureau_bad_debt_flag = 1 as bad from px_scored)""",
    {"policy_limit": 4},
)
def _(v):
    df = v.scored.withColumn("credit_income_ratio", F.col("amt_credit") / (F.col("amt_income_total") + 1e-6))
    return D.policy_flags(df).select("sk_id_curr", "policy_limit", F.array_join("policies", ",").alias("policies"))


@query(
    "doc05_income_stress",
    """with t as (select *, amt_credit / (amt_income_total + 1e-6) as c0, amt_annuity / (amt_income_total + 1e-6) as a0,
      amt_credit / (amt_income_total * 0.8e0 + 1e-6) as c1, amt_annuity / (amt_income_total * 0.8e0 + 1e-6) as a1 from px_application),
     h as (select * from t where c0 > 5)
    select *, after - before as delta from (
     select 'credit_income_ratio' as feature, count(*) as clients, avg(c0) as before, avg(c1) as after from h
     union all select 'annuity_income_ratio', count(*), avg(a0), avg(a1) from h)""",
    {"before after delta": 7},
)
def _(v):
    return D.income_stress(FQ.engineered(v))


@query(
    "doc07_alerts",
    f"""with m as (select 'auc' as metric, auc as value from ({MQ.auc_sql('pred_prob')}) union all select 'brier', avg(pow(pred_prob - target, 2)) from px_scored
     union all select 'psi', psi from ({MQ.psi_sql('ext_source_2', 'px_app_train', 'px_app_test')})),
    r as (select * from (values ('psi_watch', 'psi', 0.10::double, true), ('psi_shift', 'psi', 0.25::double, true), ('brier', 'brier', 0.10::double, true), ('auc', 'auc', 0.73::double, false)) t(rule, metric, "limit", above))
    select m.metric, rule, "limit", above, value, case when above and value > "limit" or not above and value < "limit" then 1 else 0 end as alert from r join m on r.metric = m.metric""",
    {"value": 8},
)
def _(v):
    train, test = v.application.filter("is_train = 1"), v.application.filter("is_train = 0")
    parts = [
        M.auc(v.scored).select(F.lit("auc").alias("metric"), F.col("auc").alias("value")),
        M.brier(v.scored).select(F.lit("brier").alias("metric"), F.col("brier").alias("value")),
        M.psi(train, test, "ext_source_2").select(F.lit("psi").alias("metric"), F.col("psi").alias("value")),
    ]
    return D.alerts(B.union_all(parts))
