"""Cleaning queries."""

from pyspark.sql import functions as F

from provisio.functions import semantics as S
from provisio.operators import cleaning as C
from provisio.plans.catalog.registry import query
from provisio.session import write_once


@query(
    "cln01_null_sentinel",
    """select sk_id_curr, nullif(days_employed, 365243) as days_employed,
     case when days_employed = 365243 then 1 else 0 end as emp_anomaly from px_application""",
)
def _(v):
    return C.null_sentinel(v.application, "days_employed").select("sk_id_curr", "days_employed", "emp_anomaly")


@query(
    "cln02_null_sentinels",
    """select sk_id_prev, nullif(days_first_drawing, 365243) as days_first_drawing,
     nullif(days_termination, 365243) as days_termination from px_previous_application""",
)
def _(v):
    return C.null_sentinels(v.previous).select("sk_id_prev", "days_first_drawing", "days_termination")


@query(
    "cln03_recode",
    "select sk_id_curr, case when code_gender = 'XNA' then 'Unknown' else code_gender end as code_gender from px_application",
)
def _(v):
    return C.recode(v.application, "code_gender", {"XNA": "Unknown"}).select("sk_id_curr", "code_gender")


_SPARSE_COLS = [
    "sk_id_curr", "name_income_type", "amt_annuity", "amt_goods_price", "ext_source_1", "ext_source_2",
    "ext_source_3", "days_last_phone_change", "def_30_cnt_social_circle", "own_car_age",
]


@query(
    "cln04_sparse_columns",
    "select * from (" + " union all ".join(
        f"select '{c}' as column_name, avg(case when {c} is null then 1e0 else 0e0 end) as missing_rate from px_application where is_train = 1"
        for c in _SPARSE_COLS
    ) + ") where missing_rate > 0.4 and column_name not in ('ext_source_1', 'ext_source_2', 'ext_source_3')",
    {"missing_rate": 8},
)
def _(v):
    train = v.application.filter("is_train = 1").select(*_SPARSE_COLS)
    shares = C.missing_share(train)
    rows = [(c, shares[c]) for c in C.fit_sparse_columns(train)]
    return v.spark.createDataFrame(rows, "column_name string, missing_rate double")


def _median_sql(c, table, where="true"):
    return f"coalesce({c}, (select median({c}) from {table} where {where}))"


@query(
    "cln05_median_impute",
    f"""select sk_id_curr, {_median_sql('ext_source_1', 'px_application')} as ext_source_1,
     {_median_sql('ext_source_3', 'px_application')} as ext_source_3,
     {_median_sql('nullif(days_employed, 365243)', 'px_application')} as days_employed from px_application""",
    {"ext_source_1 ext_source_3 days_employed": 9},
)
def _(v):
    df = C.null_sentinel(v.application, "days_employed")
    return C.impute_median(df, ["ext_source_1", "ext_source_3", "days_employed"]).select(
        "sk_id_curr", "ext_source_1", "ext_source_3", F.col("days_employed").cast("double").alias("days_employed")
    )


@query(
    "cln06_median_days",
    """with p as (select sk_id_prev, nullif(days_first_drawing, 365243) as a, nullif(days_termination, 365243) as b from px_previous_application)
    select sk_id_prev, coalesce(a, (select median(a) from p)) as days_first_drawing,
     coalesce(b, (select median(b) from p)) as days_termination from p""",
    {"days_first_drawing days_termination": 6},
)
def _(v):
    df = C.null_sentinels(v.previous)
    return C.impute_median(df, C.missing_days_columns(df)).select("sk_id_prev", "days_first_drawing", "days_termination")


@query(
    "cln07_zero_as_missing",
    """select sk_id_bureau, coalesce(nullif(amt_credit_sum, 0), (select median(nullif(amt_credit_sum, 0)) from px_bureau)) as amt_credit_sum
    from px_bureau""",
    {"amt_credit_sum": 4},
)
def _(v):
    bureau = write_once(v.bureau.select("sk_id_bureau", "amt_credit_sum"), "bureau")
    return C.zero_as_missing(bureau, "amt_credit_sum")


@query(
    "cln08_constant_impute",
    """select sk_id_bureau, coalesce(amt_credit_sum_overdue, 0e0) as amt_credit_sum_overdue,
     coalesce(cast(days_credit_enddate as double), 0e0) as days_credit_enddate from px_bureau""",
)
def _(v):
    return C.fill_constant(v.bureau, ["amt_credit_sum_overdue", "days_credit_enddate"]).select(
        "sk_id_bureau", "amt_credit_sum_overdue", "days_credit_enddate"
    )


@query(
    "cln09_mode_impute",
    """select sk_id_curr, coalesce(name_income_type, (select name_income_type from px_application where name_income_type is not null
     group by name_income_type order by count(*) desc, name_income_type limit 1)) as name_income_type from px_application""",
)
def _(v):
    return C.fill_mode(v.application).select("sk_id_curr", "name_income_type")


_NUMS = ["amt_annuity", "amt_goods_price", "days_last_phone_change", "def_30_cnt_social_circle", "own_car_age"]


@query(
    "cln10_median_remaining",
    "select sk_id_curr, " + ", ".join(f"cast({_median_sql(c, 'px_application')} as double) as {c}" for c in _NUMS) + " from px_application",
    {" ".join(_NUMS): 6},
)
def _(v):
    return C.fill_median(v.application, exclude=["target"]).select("sk_id_curr", *_NUMS)


@query(
    "cln11_cap_quantile",
    """select sk_id_curr, least(amt_income_total, (select quantile_cont(amt_income_total, 0.99) from px_application)) as amt_income_total
    from px_application""",
    {"amt_income_total": 4},
)
def _(v):
    return C.cap_quantile(v.application, "amt_income_total").select("sk_id_curr", "amt_income_total")


@query(
    "cln12_cap_constant",
    """select sk_id_curr, case when def_30_cnt_social_circle > 20 then 20 else def_30_cnt_social_circle end as def_30_cnt_social_circle
    from px_application""",
)
def _(v):
    return C.cap(v.application, C.APPLICATION_CAPS).select("sk_id_curr", "def_30_cnt_social_circle")


@query(
    "cln13_clamp",
    """select sk_id_prev, case when amt_down_payment < 0 then 0e0 else amt_down_payment end as amt_down_payment
    from px_previous_application""",
)
def _(v):
    return C.clamp(v.previous, "amt_down_payment", 0.0).select("sk_id_prev", "amt_down_payment")


@query(
    "cln14_payment_diff",
    "select sk_id_prev, num_instalment_number, amt_instalment - amt_payment as payment_diff from px_installments",
    {"payment_diff": 4},
)
def _(v):
    return v.instalments.select("sk_id_prev", "num_instalment_number", C.payment_diff().alias("payment_diff"))


@query(
    "cln15_days_past_due",
    """select sk_id_prev, num_instalment_number, case when days_entry_payment - days_instalment < 0 then 0e0
     else days_entry_payment - days_instalment end as days_past_due from px_installments""",
)
def _(v):
    return v.instalments.select("sk_id_prev", "num_instalment_number", C.days_past_due().alias("days_past_due"))


@query(
    "cln16_utilization",
    "select sk_id_curr, months_balance, utilization_ratio from px_card_clean",
    {"utilization_ratio": 8},
)
def _(v):
    return v.card.select("sk_id_curr", "months_balance", C.utilization().alias("utilization_ratio"))


@query(
    "cln17_completeness",
    " union all ".join(
        f"select '{c}' as \"column\", count(*) - count({c}) as missing from px_application" for c in _SPARSE_COLS
    ),
)
def _(v):
    return C.completeness_report(v.application.select(*_SPARSE_COLS))


@query(
    "cln17_force_fill",
    f"""select sk_id_curr, coalesce(name_income_type, (select name_income_type from px_application where name_income_type is not null
     group by 1 order by count(*) desc, 1 limit 1)) as name_income_type,
     {_median_sql('amt_goods_price', 'px_application')} as amt_goods_price from px_application""",
    {"amt_goods_price": 6},
)
def _(v):
    return C.require_complete(v.application.select("sk_id_curr", "name_income_type", "amt_goods_price"))


@query(
    "cln18_cleaning_summary",
    """select 'before' as stage, count(*) as row_count, 3 as column_count,
     (avg(case when sk_id_prev is null then 1e0 else 0e0 end) + avg(case when days_entry_payment is null then 1e0 else 0e0 end)
      + avg(case when amt_payment is null then 1e0 else 0e0 end)) / 3e0 as missing_rate from px_installments
    union all select 'after', count(*), 5, 0e0 from px_installments""",
    {"missing_rate": 9},
)
def _(v):
    inst = write_once(v.instalments.select("sk_id_prev", *C.INSTALMENT_COLUMNS), "instalments")
    raw = inst.select("sk_id_prev", "days_entry_payment", "amt_payment")
    after = C.clean_instalments(inst).select(
        "sk_id_prev", "days_entry_payment", "amt_payment", "payment_diff", "days_past_due"
    )
    return C.cleaning_summary(raw, after)


_RULES_SQL = {
    "sentinel_employed": "days_employed = 365243", "gender_unknown": "code_gender = 'XNA'",
    "annuity_filled": "amt_annuity is null", "social_circle_capped": "def_30_cnt_social_circle > 20",
}


@query(
    "cln19_rule_counts",
    " union all ".join(
        f"select '{n}' as rule, count(*) filter ({p}) as row_count, avg(case when {p} then 1e0 else 0e0 end) as row_share from px_application"
        for n, p in _RULES_SQL.items()
    ),
    {"row_share": 8},
)
def _(v):
    return C.rule_counts(v.application, {n: F.expr(p) for n, p in _RULES_SQL.items()})


_APP_OUT = ["amt_income_total", "amt_annuity", "amt_goods_price", "ext_source_1", "ext_source_3", "days_employed"]


@query(
    "cln_application_table",
    f"""with t as (select * replace (nullif(days_employed, 365243) as days_employed) from px_application),
    tr as (select * from t where is_train = 1)
    select sk_id_curr, case when code_gender = 'XNA' then 'Unknown' else code_gender end as code_gender,
     case when days_employed is null then 1 else 0 end as emp_anomaly,
     least(amt_income_total, (select quantile_cont(amt_income_total, 0.99) from tr)) as amt_income_total,
     {', '.join(f"cast(coalesce({c}, (select median({c}) from tr)) as double) as {c}" for c in _APP_OUT[1:])},
     coalesce(name_income_type, (select name_income_type from tr where name_income_type is not null group by 1 order by count(*) desc, 1 limit 1)) as name_income_type
    from t""",
    {" ".join(_APP_OUT): 6},
)
def _(v):
    state = C.fit_application(v.application.filter("is_train = 1"))
    return C.clean_application(v.application, state).select(
        "sk_id_curr", "code_gender", "emp_anomaly", *_APP_OUT, "name_income_type"
    )


@query(
    "cln_bureau_table",
    """select sk_id_bureau, coalesce(nullif(amt_credit_sum, 0), (select median(nullif(amt_credit_sum, 0)) from px_bureau)) as amt_credit_sum,
     least(credit_day_overdue, 365) as credit_day_overdue, coalesce(amt_credit_sum_overdue, 0e0) as amt_credit_sum_overdue,
     cast(coalesce(days_credit_enddate, (select median(days_credit_enddate) from px_bureau)) as double) as days_credit_enddate from px_bureau""",
    {"amt_credit_sum days_credit_enddate": 4},
)
def _(v):
    bureau = v.bureau.select(
        "sk_id_bureau", "amt_credit_sum", "credit_day_overdue", "amt_credit_sum_overdue", "days_credit_enddate"
    )
    return C.clean_bureau(write_once(bureau, "bureau"))


@query(
    "cln_previous_table",
    """with p as (select *, nullif(days_first_drawing, 365243) as a from px_previous_application)
    select sk_id_prev, case when amt_down_payment is null or amt_down_payment < 0 then 0e0 else amt_down_payment end as amt_down_payment,
     cast(coalesce(a, (select median(a) from p)) as double) as days_first_drawing from p""",
    {"days_first_drawing": 4},
)
def _(v):
    return C.clean_previous(v.previous).select("sk_id_prev", "amt_down_payment", "days_first_drawing")


@query(
    "cln_pos_table",
    """select sk_id_prev, months_balance, coalesce(cnt_instalment, (select median(cnt_instalment) from px_pos_cash)) as cnt_instalment,
     least(sk_dpd, 365) as sk_dpd, case when name_contract_status = 'XNA' then 'Unknown' else name_contract_status end as name_contract_status
    from px_pos_cash""",
)
def _(v):
    return C.clean_pos(v.pos).select("sk_id_prev", "months_balance", "cnt_instalment", "sk_dpd", "name_contract_status")


@query(
    "cln_card_table",
    "select sk_id_curr, months_balance, amt_drawings_current, amt_payment_current, sk_dpd, utilization_ratio from px_card_clean",
    {"amt_drawings_current amt_payment_current utilization_ratio": 8},
)
def _(v):
    return C.clean_card(v.card).select(
        "sk_id_curr", "months_balance", "amt_drawings_current", "amt_payment_current", "sk_dpd", "utilization_ratio"
    )


@query(
    "sca05_clip_null_safe",
    "select sk_id_prev, case when amt_down_payment is null then null else least(greatest(amt_down_payment, 0e0), 9e3) end as clipped from px_previous_application",
)
def _(v):
    return v.previous.select("sk_id_prev", S.clip("amt_down_payment", 0.0, 9e3).alias("clipped"))
