"""Audit queries."""

from pyspark.sql import functions as F

from provisio.operators import audit as A
from provisio.operators import cleaning as C
from provisio.operators import history as H
from provisio.plans.catalog.registry import query

_COLS = [
    "sk_id_curr", "target", "name_income_type", "amt_annuity", "amt_goods_price", "ext_source_1",
    "ext_source_3", "days_last_phone_change", "own_car_age", "code_gender",
]


def _missing(cols, table="px_application"):
    return " union all ".join(
        f"select '{c}' as \"column\", avg(case when {c} is null then 1e0 else 0e0 end) as missing_rate from {table}" for c in cols
    )


@query("aud01_shape", "select count(*) as row_count, 10 as column_count from px_bureau")
def _(v):
    return A.shape(v.bureau)


@query(
    "aud02_target_distribution",
    """select target, count(*) as row_count, count(*) * 100e0 / sum(count(*)) over () as pct from px_application
    where target is not null group by target""",
    {"pct": 8},
)
def _(v):
    return A.target_distribution(v.application)


_DUP = "user_id, event_type"


@query(
    "aud03_duplicate_rows",
    f"select cast(sum(n - 1) as bigint) as duplicate_rows from (select count(*) as n from events group by {_DUP})",
)
def _(v):
    return A.duplicate_rows(v.table("events").select("user_id", "event_type"))


@query(
    "aud04_duplicate_keys",
    "select cast(sum(n - 1) as bigint) as duplicate_keys from (select count(*) as n from px_bureau group by sk_id_curr)",
)
def _(v):
    return A.duplicate_keys(v.bureau, "sk_id_curr")


@query(
    "aud05_missing_rates",
    f"select * from ({_missing(_COLS)}) order by missing_rate desc, \"column\" limit 6",
    {"missing_rate": 8},
)
def _(v):
    return A.missing_rates(v.application.select(*_COLS), 6)


@query(
    "aud06_missing_bands",
    f"""select count(*) filter (missing_rate > 0.4) as above_high, count(*) filter (missing_rate > 0.15 and missing_rate <= 0.4) as between_,
     count(*) filter (missing_rate > 0 and missing_rate <= 0.15) as below_low, count(*) filter (missing_rate = 0) as complete
    from ({_missing(_COLS)})""",
)
def _(v):
    return A.missing_bands(v.application.select(*_COLS)).withColumnRenamed("between", "between_")


@query(
    "aud07_sentinel_profile",
    """with t as (select nullif(days_employed, 365243) as d, days_employed from px_application)
    select count(*) filter (days_employed = 365243) as sentinel_rows, avg(case when days_employed = 365243 then 1e0 else 0e0 end) as sentinel_share,
     min(d) as min_days, max(d) as max_days, -max(d) / 365e0 as min_years, -min(d) / 365e0 as max_years from t""",
    {"sentinel_share min_years max_years": 8},
)
def _(v):
    return A.sentinel_profile(v.application, "days_employed", 365243)


@query(
    "aud08_value_counts",
    "select credit_active, count(*) as row_count from px_bureau where credit_active is not null group by 1",
)
def _(v):
    return A.value_counts(v.bureau, "credit_active")


@query(
    "aud09_tail_quantiles",
    """with q as (select quantile_cont(amt_income_total, 0.99) as p99, quantile_cont(amt_income_total, 0.999) as p99_9 from px_application)
    select any_value(p99) as p99, any_value(p99_9) as p99_9, max(amt_income_total) as max_value, count(*) filter (amt_income_total > p99) as rows_above
    from px_application, q""",
    {"p99 p99_9": 4},
)
def _(v):
    return A.tail_quantiles(v.application, "amt_income_total")


_STATS = ["ext_source_1", "ext_source_2", "ext_source_3", "amt_annuity"]


@query(
    "aud10_column_stats",
    " union all ".join(
        f"""select '{c}' as "column", avg(case when {c} is null then 1e0 else 0e0 end) * 1e2 as missing_pct, avg(cast({c} as double)) as mean,
        min(cast({c} as double)) as min, max(cast({c} as double)) as max from px_application""" for c in _STATS
    ),
    {"missing_pct mean": 6},
)
def _(v):
    return A.column_stats(v.application, _STATS)


_DOMAIN = {
    "bureau_overdue": ("credit_day_overdue > 0",), "bureau_long_overdue": ("credit_day_overdue > 365",),
    "end_in_future": ("days_credit_enddate > 0",), "zero_amount": ("amt_credit_sum = 0",),
}


@query(
    "aud11_domain_rules",
    " union all ".join(
        f"select '{n}' as rule, count(*) filter ({p}) as row_count, avg(case when {p} then 1e0 else 0e0 end) as row_share from px_bureau"
        for n, (p,) in _DOMAIN.items()
    ),
    {"row_share": 8},
)
def _(v):
    return A.rule_counts(v.bureau, {n: F.expr(p) for n, (p,) in _DOMAIN.items()})


@query(
    "aud12_flag_sum",
    """with t as (select cast(flag_document_2 + flag_document_3 + flag_document_4 as double) as s from px_application)
    select count(*) filter (s = 0) as rows_without_flag, max(s) as max_flags from t""",
)
def _(v):
    return A.flag_sum_profile(v.application, ["flag_document_2", "flag_document_3", "flag_document_4"])


_CATS = ["name_income_type", "name_contract_type", "code_gender"]


@query(
    "aud13_categorical_profile",
    " union all ".join(
        f"""select '{c}' as "column", count(distinct {c}) as distinct_count,
        (select {c} from px_application where {c} is not null group by {c} order by count(*) desc, {c} limit 1) as top_value,
        (count(*) - count({c})) * 1e2 / count(*) as missing_pct from px_application""" for c in _CATS
    ),
    {"missing_pct": 8},
)
def _(v):
    return A.categorical_profile(v.application, _CATS)


@query(
    "aud13_high_cardinality",
    """select 'l_comment_key' as "column", count(distinct k) as distinct_count,
     (select k from (select cast(l_partkey as varchar) as k from lineitem) group by k order by count(*) desc, k limit 1) as top_value,
     0e0 as missing_pct from (select cast(l_partkey as varchar) as k from lineitem)""",
    {"missing_pct": 8},
)
def _(v):
    return A.categorical_profile(v.table("lineitem").select(F.col("l_partkey").cast("string").alias("l_comment_key")))


_Z = ["l_quantity", "l_extendedprice", "l_tax", "heavy"]


@query(
    "aud14_zscore_outliers",
    """with t as (select *, case when l_orderkey % 5003 = 0 and l_linenumber = 1 then 1e6 else l_quantity end as heavy from lineitem),
    m as (select avg(heavy) as a, stddev_samp(heavy) as s, avg(l_extendedprice) as a2, stddev_samp(l_extendedprice) as s2 from t)
    select * from (
     select 'heavy' as "column", count(*) filter (abs((heavy - a) / s) > 10) as outliers, max(heavy) as max_value from t, m
     union all select 'l_extendedprice', count(*) filter (abs((l_extendedprice - a2) / s2) > 10), max(l_extendedprice) from t, m)
    where outliers > 0""",
)
def _(v):
    df = v.table("lineitem").withColumn(
        "heavy", F.when((F.col("l_orderkey") % 5003 == 0) & (F.col("l_linenumber") == 1), 1e6).otherwise(F.col("l_quantity"))
    )
    return A.zscore_outliers(df, cols=_Z)


@query(
    "aud15_negative_counts",
    """select 'amt_balance' as "column", count(*) filter (amt_balance < 0) as negatives from px_credit_card
    union all select 'amt_payment_current', count(*) filter (amt_payment_current < 0) from px_credit_card""",
)
def _(v):
    return A.negative_counts(v.card, ["amt_balance", "amt_payment_current"])


@query(
    "aud16_key_coverage",
    """with c as (select count(distinct sk_id_curr) as child_keys from px_pos_cash), p as (select count(distinct sk_id_curr) as parent_keys from px_application),
    s as (select count(distinct sk_id_curr) as shared_keys from px_application where sk_id_curr in (select sk_id_curr from px_pos_cash))
    select child_keys, parent_keys, shared_keys, child_keys / parent_keys as ratio, shared_keys / parent_keys as coverage from c, p, s""",
    {"ratio coverage": 8},
)
def _(v):
    return A.key_coverage(v.pos, v.application, "sk_id_curr")


@query(
    "aud17_rows_per_key",
    """with s as (select count(*) as n from px_bureau group by sk_id_curr)
    select min(n) as min_rows, max(n) as max_rows, avg(n) as mean_rows, median(n) as median_rows, count(*) filter (n > 20) as keys_with_many from s""",
    {"mean_rows": 6},
)
def _(v):
    return A.rows_per_key(v.bureau, "sk_id_curr")


@query(
    "aud18_payment_shares",
    """with t as (select amt_instalment - amt_payment as d, days_entry_payment - days_instalment as l from px_installments)
    select avg(case when d > 0 then 1e0 else 0e0 end) as under, avg(case when d < 0 then 1e0 else 0e0 end) as over,
     avg(case when d = 0 then 1e0 else 0e0 end) as exact, avg(case when l > 0 then 1e0 else 0e0 end) as late,
     avg(case when l > 30 then 1e0 else 0e0 end) as very_late from t""",
    {"under over exact late very_late": 8},
)
def _(v):
    return A.payment_shares(v.instalments)


_PREVIEW = ["cc_balance_mean", "cc_limit_mean", "cc_utilization_max", "cc_dpd_mean"]
_PREVIEW_SQL = """select sk_id_curr, avg(amt_balance) as cc_balance_mean, max(amt_balance) as cc_balance_max, avg(amt_credit_limit_actual) as cc_limit_mean,
 avg(amt_balance / (amt_credit_limit_actual + 1)) as cc_utilization_mean, max(amt_balance / (amt_credit_limit_actual + 1)) as cc_utilization_max,
 avg(sk_dpd) as cc_dpd_mean, max(sk_dpd) as cc_dpd_max, count(months_balance) as cc_months_count from px_credit_card group by sk_id_curr"""


@query(
    "aud19_describe_preview",
    f"with p as ({_PREVIEW_SQL}) " + " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std, min({c}) as min, quantile_cont({c}, 0.25) as p25,
        median({c}) as p50, quantile_cont({c}, 0.75) as p75, max({c}) as max from p""" for c in _PREVIEW
    ),
    {"mean std min p25 p50 p75 max": 5},
)
def _(v):
    return A.describe(H.card_preview(v.card), _PREVIEW)


@query("agg07_card_preview", _PREVIEW_SQL, {"cc_balance_mean cc_limit_mean cc_utilization_mean cc_utilization_max cc_dpd_mean cc_balance_max": 6})
def _(v):
    return H.card_preview(v.card)


_DRIFT = ["name_income_type", "amt_annuity", "ext_source_1", "ext_source_3", "own_car_age"]


@query(
    "aud21_missing_drift",
    "select *, case when abs(left_rate - right_rate) > 0.05 then 1 else 0 end as drift from (" + " union all ".join(
        f"""select '{c}' as "column", avg(case when {c} is null then 1e0 else 0e0 end) filter (is_train = 1) as left_rate,
        avg(case when {c} is null then 1e0 else 0e0 end) filter (is_train = 0) as right_rate from px_application""" for c in _DRIFT
    ) + ")",
    {"left_rate right_rate": 8},
)
def _(v):
    train, test = (v.application.filter(f"is_train = {i}").select(*_DRIFT) for i in (1, 0))
    return A.missing_drift(train, test)


@query(
    "sca06_null_handling",
    """select count(*) - count(amt_annuity) as missing_annuity, count(nullif(days_employed, 365243)) as employed,
     sum(coalesce(amt_annuity, 0)) as filled_sum from px_application""",
    {"filled_sum": 2},
)
def _(v):
    return v.application.agg(
        F.count_if(F.col("amt_annuity").isNull()).alias("missing_annuity"),
        F.count(F.nullif(F.col("days_employed"), F.lit(C.SENTINEL_DAYS))).alias("employed"),
        F.sum(F.coalesce("amt_annuity", F.lit(0))).alias("filled_sum"),
    )
