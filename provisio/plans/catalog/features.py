"""Feature queries."""

from pyspark.sql import functions as F

from provisio.functions import semantics as S
from provisio.operators import features as X
from provisio.plans.catalog import history as HQ
from provisio.plans.catalog.registry import PARTS, query
from provisio.session import new_path
from provisio.sources.writers import write_version

PARTS["px_engineered"] = """
select *, amt_credit / (amt_income_total + 1e-6) as credit_income_ratio, amt_annuity / (amt_income_total + 1e-6) as annuity_income_ratio,
 amt_credit / (amt_annuity + 1e-6) as credit_term, amt_goods_price / (amt_credit + 1e-6) as goods_credit_ratio,
 amt_goods_price - amt_credit as credit_downpayment, -days_birth / 365e0 as age_years, -days_employed / 365e0 as years_employed,
 -days_id_publish / 365e0 as years_id_publish, -days_last_phone_change / 365e0 as years_last_phone_change,
 days_employed / (days_birth + 1e-6) as days_employed_ratio,
 cast(flag_document_2 + flag_document_3 + flag_document_4 as double) as flag_docs_sum,
 cnt_children / greatest(cnt_fam_members, 1) as cnt_children_ratio
from px_application"""


def engineered(v):
    return X.engineer(v.application)


@query(
    "prj01_tag_split",
    """select sk_id_curr, case when is_train = 1 then target end as target, is_train from px_application""",
)
def _(v):
    train = v.application.filter("is_train = 1").select("sk_id_curr", "target")
    test = v.application.filter("is_train = 0").select("sk_id_curr", "target")
    return X.tag_split(train, test).select("sk_id_curr", "target", "is_train")


@query("prj02_sanitize_columns", 'select sk_id_curr as "id", amt_credit as loan_amount_eur_ from px_application')
def _(v):
    raw = v.application.select(F.col("sk_id_curr").alias("id"), F.col("amt_credit").alias("loan amount (eur)"))
    return X.sanitize_columns(raw)


@query(
    "prj06_drop_columns",
    "select sk_id_bureau, sk_id_curr, credit_active, days_credit from px_bureau",
)
def _(v):
    keep = {"sk_id_bureau", "sk_id_curr", "credit_active", "days_credit"}
    return v.bureau.drop(*[c for c in v.bureau.columns if c not in keep])


@query(
    "prj07_column_or_default",
    "select sk_id_curr, coalesce(amt_goods_price, 0e0) as goods, 0.5e0 as absent from px_application",
)
def _(v):
    df = v.application
    return df.select(
        "sk_id_curr", S.col_or(df, "amt_goods_price", 0.0).alias("goods"), S.col_or(df, "no_such_column", 0.5).alias("absent")
    )


@query(
    "fea01_financial_ratios",
    "select sk_id_curr, credit_income_ratio, annuity_income_ratio, credit_term, goods_credit_ratio, credit_downpayment from px_engineered",
    {"credit_income_ratio annuity_income_ratio credit_term goods_credit_ratio": 8, "credit_downpayment": 4},
)
def _(v):
    return X.financial_ratios(v.application).select(
        "sk_id_curr", "credit_income_ratio", "annuity_income_ratio", "credit_term", "goods_credit_ratio", "credit_downpayment"
    )


@query(
    "fea02_time_features",
    "select sk_id_curr, age_years, years_employed, years_id_publish, years_last_phone_change, days_employed_ratio from px_engineered",
    {"age_years years_employed years_id_publish years_last_phone_change days_employed_ratio": 8},
)
def _(v):
    return X.time_features(v.application).select(
        "sk_id_curr", "age_years", "years_employed", "years_id_publish", "years_last_phone_change", "days_employed_ratio"
    )


@query(
    "fea03_document_features",
    "select sk_id_curr, flag_docs_sum, cnt_children_ratio from px_engineered",
    {"cnt_children_ratio": 8},
)
def _(v):
    return X.document_features(v.application).select("sk_id_curr", "flag_docs_sum", "cnt_children_ratio")


@query(
    "fea04_binary_encoding",
    """select sk_id_curr, case name_contract_type when 'Cash loans' then 0 when 'Revolving loans' then 1 end as name_contract_type,
     case flag_own_car when 'N' then 0 when 'Y' then 1 end as flag_own_car from px_application""",
)
def _(v):
    df = v.application.select("sk_id_curr", "name_contract_type", "flag_own_car")
    return X.apply_binary(df, X.fit_encoding(df))


@query(
    "fea05_onehot",
    "select sk_id_curr, " + ", ".join(
        f"case when name_income_type = '{s}' then 1e0 else 0e0 end as name_income_type_{s}"
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    ) + " from px_application",
)
def _(v):
    df = v.application.select("sk_id_curr", "name_income_type")
    return X.apply_onehot(df, X.fit_encoding(df))


PARTS["px_wide_values"] = """
select sk_id_curr, 'area' as feature, concat('a', cast(sk_id_curr * 31 % 7001 as varchar(10))) as value from px_scored
union all select sk_id_curr, 'income_type', name_income_type from px_scored where name_income_type is not null"""
_WIDE = ["area", "income_type"]


def _wide(v):
    """Loans with a text of thousands of values and one with a few and gaps."""
    area = F.concat(F.lit("a"), (F.col("sk_id_curr") * 31 % 7001).cast("string"))
    return v.scored.select("sk_id_curr", area.alias("area"), F.col("name_income_type").alias("income_type"))


@query("fea05_value_index", "select feature, value, row_number() over (order by feature, value) - 1 as position from (select distinct feature, value from px_wide_values)")
def _(v):
    return X.fit_value_index(_wide(v), _WIDE)


@query(
    "fea05_sparse_entries",
    """select sk_id_curr, position, 1e0 as hot from px_wide_values join (
     select feature, value, row_number() over (order by feature, value) - 1 as position from (select distinct feature, value from px_wide_values)) using (feature, value)""",
)
def _(v):
    df = _wide(v)
    return X.sparse_entries(df, X.fit_value_index(df, _WIDE), _WIDE)


_MED = ["amt_annuity", "ext_source_1", "days_last_phone_change"]


@query(
    "fea06_train_median",
    "with tr as (select * from px_application where is_train = 1) select sk_id_curr, "
    + ", ".join(f"cast(coalesce({c}, (select median({c}) from tr)) as double) as {c}" for c in _MED) + " from px_application",
    {" ".join(_MED): 8},
)
def _(v):
    state = X.fit_median(v.application.filter("is_train = 1"), _MED)
    return X.apply_median(v.application, state).select("sk_id_curr", *_MED)


@query(
    "fea07_interactions",
    """select sk_id_curr, age_years * credit_income_ratio as stress_age_x_credit,
     greatest(years_employed, 0e0) * annuity_income_ratio as stress_emp_x_annuity,
     flag_docs_sum * credit_income_ratio as stress_docs_x_credit from px_engineered""",
    {"stress_age_x_credit stress_emp_x_annuity stress_docs_x_credit": 7},
)
def _(v):
    return X.interactions(engineered(v)).select(
        "sk_id_curr", "stress_age_x_credit", "stress_emp_x_annuity", "stress_docs_x_credit"
    )


@query(
    "fea08_quality_composite",
    """with j as (select sk_id_curr, greatest(coalesce(bureau_overdue_mean, 0e0), 0e0) as o, coalesce(prev_refused_ratio, 0e0) as r,
      coalesce(inst_late_ratio, 0e0) as l from px_joined),
    q as (select quantile_cont(o, 0.99) as p from j)
    select sk_id_curr, (1 - least(o / (p + 1e-6), 1e0)) * 0.40e0 + (1 - least(r, 1e0)) * 0.35e0 + (1 - least(l, 1e0)) * 0.25e0 as bureau_quality_composite
    from j, q""",
    {"bureau_quality_composite": 7},
)
def _(v):
    df = HQ.joined(v).select("sk_id_curr", "bureau_overdue_mean", "prev_refused_ratio", "inst_late_ratio").fillna(0.0)
    df = write_version(df, new_path(v.spark, "features"), "joined")  # read twice below
    return X.quality_composite(df, X.fit_quality(df)).select("sk_id_curr", "bureau_quality_composite")


@query(
    "fea09_clean_bureau_high_lti",
    """select j.sk_id_curr, case when coalesce(bureau_bad_debt_flag, 0) = 0 and credit_income_ratio > 5 then 1 else 0 end as clean_bureau_high_lti
    from px_engineered j left join px_bureau_agg b on j.sk_id_curr = b.sk_id_curr""",
)
def _(v):
    df = engineered(v).join(HQ.bureau_agg(v).select("sk_id_curr", "bureau_bad_debt_flag"), "sk_id_curr", "left")
    return X.clean_bureau_high_lti(df).select("sk_id_curr", "clean_bureau_high_lti")


@query(
    "fea10_ext_source_stats",
    """with l as (select sk_id_curr, unnest([ext_source_1, ext_source_2, ext_source_3]) as x from px_application)
    select sk_id_curr, avg(x) as ext_source_mean, min(x) as ext_source_min, product(x) as ext_source_product,
     coalesce(stddev_samp(x), 0e0) as ext_source_std from l group by sk_id_curr""",
    {"ext_source_mean ext_source_product ext_source_std": 8},
)
def _(v):
    return X.ext_source_stats(v.application).select(
        "sk_id_curr", "ext_source_mean", "ext_source_min", "ext_source_product", "ext_source_std"
    )


_VAR = ["ext_source_1", "ext_source_2", "cnt_children", "flag_document_4", "amt_credit"]


@query(
    "fea11_low_variance",
    "select * from (" + " union all ".join(f"select '{c}' as feature, var_samp({c}) as variance from px_application" for c in _VAR) + ") where variance < 0.01",
    {"variance": 8},
)
def _(v):
    low = X.fit_low_variance(v.application, _VAR)
    return X.variances(v.application, _VAR).filter(F.col("feature").isin(low))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net"]


@query(
    "fea12_correlation_pairs",
    "with t as (select *, l_extendedprice * (1 - l_discount) as net from lineitem) " + " union all ".join(
        f"select '{_CORR[i]}' as left_feature, '{_CORR[j]}' as right_feature, corr({_CORR[i]}, {_CORR[j]}) as r from t"
        for j in range(len(_CORR)) for i in range(j)
    ),
    {"r": 6},
)
def _(v):
    return X.correlation_pairs(_with_net(v), _CORR)


_WIDE_CORR = [
    "amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "days_birth", "days_employed", "days_id_publish", "ext_source_1",
    "ext_source_2", "ext_source_3", "cnt_children", "cnt_fam_members", "days_last_phone_change", "flag_document_2", "flag_document_3",
    "flag_document_4", "def_30_cnt_social_circle", "own_car_age", "target", "is_train",
]


@query(
    "fea12_correlation_wide",
    " union all ".join(
        f"""select '{a}' as left_feature, '{b}' as right_feature, case when isfinite(r) then r end as r from (
         select case when count(*) > 0 and stddev_pop(a) > 0 and stddev_pop(b) > 0 then covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) end as r
         from (select cast({a} as double) as a, cast({b} as double) as b from px_application) where a is not null and b is not null)"""
        for j, b in enumerate(_WIDE_CORR) for a in _WIDE_CORR[:j]
    ),
    {"r": 6},
)
def _(v):
    return X.correlation_pairs(v.application, _WIDE_CORR)


def _with_net(v):
    return v.table("lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query(
    "fea12_correlation_filter",
    """with t as (select *, l_extendedprice * (1 - l_discount) as net from lineitem)
    select f as feature from (
     select 'l_extendedprice' as f, abs(corr(l_quantity, l_extendedprice)) as r from t
     union all select 'l_discount', greatest(abs(corr(l_quantity, l_discount)), abs(corr(l_extendedprice, l_discount))) from t
     union all select 'l_tax', greatest(abs(corr(l_quantity, l_tax)), abs(corr(l_extendedprice, l_tax)), abs(corr(l_discount, l_tax))) from t
     union all select 'net', greatest(abs(corr(l_quantity, net)), abs(corr(l_extendedprice, net)), abs(corr(l_discount, net)), abs(corr(l_tax, net))) from t)
    where r > 0.95""",
)
def _(v):
    dropped = X.fit_correlated(_with_net(v), _CORR)
    return v.spark.createDataFrame([(c,) for c in dropped], "feature string")


_TC = ["ext_source_1", "ext_source_2", "ext_source_3", "amt_credit", "amt_annuity", "cnt_children", "days_birth"]


@query(
    "fea13_target_correlation",
    "select * from (" + " union all ".join(
        f"select '{c}' as feature, abs(corr(cast({c} as double), target)) as abs_r from px_application where is_train = 1" for c in _TC
    ) + ") order by abs_r desc nulls last, feature limit 5",
    {"abs_r": 7},
)
def _(v):
    return X.target_correlation(v.application.filter("is_train = 1"), _TC, k=5)


@query(
    "fea14_output_checks",
    """select count(*) filter (is_train = 1) as train_rows, count(*) filter (is_train <> 1) as test_rows,
     count(*) filter (is_train = 1 and target is null) as missing_targets from px_application""",
)
def _(v):
    return X.output_checks(X.assert_outputs(v.application))


_DAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]


@query(
    "fea15_decode_weekday",
    """select sk_id_curr, case weekday_appr_process_start when 'TUESDAY' then 'Tue' when 'WEDNESDAY' then 'Wed'
     when 'THURSDAY' then 'Thu' when 'FRIDAY' then 'Fri' when 'SATURDAY' then 'Sat' when 'SUNDAY' then 'Sun' else 'Mon' end as weekday from px_scored""",
)
def _(v):
    # A row without a weekday has only zeros, so the first column wins, as argmax does.
    hot = [
        F.when(F.col("weekday_appr_process_start") == d, 1.0).otherwise(0.0).alias(f"weekday_appr_process_start_{d}") for d in _DAYS
    ]
    return X.decode_weekday(v.scored.select("sk_id_curr", *hot)).select("sk_id_curr", "weekday")


@query(
    "flt04_split_back",
    "select sk_id_curr, amt_credit from px_application where is_train = 0",
)
def _(v):
    return X.split(v.application)[1].select("sk_id_curr", "amt_credit")


@query(
    "sca16_row_statistics",
    """select sk_id_curr, coalesce(ext_source_1, 0) + ext_source_2 + coalesce(ext_source_3, 0) as total,
     case when ext_source_1 >= coalesce(ext_source_2, -1) and ext_source_1 >= coalesce(ext_source_3, -1) then 'ext_source_1'
      when ext_source_2 >= coalesce(ext_source_3, -1) then 'ext_source_2' else 'ext_source_3' end as largest from px_application""",
    {"total": 8},
)
def _(v):
    cols = list(X.EXT_SOURCES)
    return v.application.select("sk_id_curr", S.row_sum(cols).alias("total"), S.row_argmax(cols).alias("largest"))


@query(
    "sca09_replace_text",
    """select sk_id_curr, replace(name_contract_type, ' loans', '') as product, regexp_replace(name_education_type, '[^A-Za-z0-9_]+', '_', 'g') as education,
     upper(name_contract_type) as upper_type, contains(name_contract_type, 'Rev') as is_revolving from px_application""",
)
def _(v):
    c = F.col("name_contract_type")
    return v.application.select(
        "sk_id_curr", F.replace(c, F.lit(" loans"), F.lit("")).alias("product"),
        F.regexp_replace("name_education_type", "[^A-Za-z0-9_]+", "_").alias("education"),
        F.upper(c).alias("upper_type"), c.contains("Rev").alias("is_revolving"),
    )
