"""Time-series and cohort queries."""

from pyspark.sql import functions as F

from provisio.functions import semantics as S
from provisio.operators import dashboard as D
from provisio.operators import timeseries as T
from provisio.plans.catalog import portfolio  # noqa: F401  (projection and migration parts)
from provisio.plans.catalog.registry import PARTS, cut_sql, query

PARTS["px_vintage"] = f"""
select cohort, term_band, avg(target) as default_rate, count(sk_id_curr) as loan_count, avg(pred_prob) as avg_pd, sum(ead) as total_ead,
 avg(target) * 1e2 as default_rate_pct, avg(pred_prob) * 1e2 as avg_pd_pct, sum(ead) / 1e9 as total_ead_b
from (select *, cast(year(d) as varchar) || 'Q' || cast(quarter(d) as varchar) as cohort, {cut_sql('term', (0, 12, 18, 24, 36, 60), ('≤12m', '13-18m', '19-24m', '25-36m', '37m+'), outside='nan')} as term_band
 from (select *, date '2016-06-01' - cast(least(abs(days_id_publish), 1460) as integer) as d,
  case when credit_term is null then 24e0 else least(greatest(credit_term, 6e0), 60e0) end as term from px_loans)) group by 1, 2"""
PARTS["px_cohort"] = f"""
select age_band, tenure_band, avg(target) as default_rate, count(sk_id_curr) as loan_count, sum(ead) as total_ead, avg(ecl) as avg_ecl,
 avg(pred_prob) as avg_pd, avg(target) * 1e2 as default_rate_pct, sum(ead) / 1e9 as total_ead_b, avg(ecl) / 1e3 as avg_ecl_k,
 case age_band when '18-25' then 0 when '26-35' then 1 when '36-45' then 2 when '46-55' then 3 when '56+' then 4 end as age_ord
from (select *, {cut_sql('age', (18, 25, 35, 45, 55, 70), ('18-25', '26-35', '36-45', '46-55', '56+'), outside='nan')} as age_band, {cut_sql('tenure', (-0.01, 1, 3, 5, 10, 20), ('<1yr', '1-3yr', '3-5yr', '5-10yr', '>10yr'), outside='nan')} as tenure_band
 from (select *, least(greatest(round_even(-days_birth / 365e0, 0), 18e0), 70e0) as age, least(greatest(-days_employed / 365e0, 0e0), 20e0) as tenure
  from px_loans)) group by 1, 2"""
_DAY = "case weekday_appr_process_start " + " ".join(f"when '{d}' then '{d[0] + d[1:3].lower()}'" for d in ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")) + " else 'Unknown' end"
_DAILY = f"""select {_DAY} as weekday, avg(case when pred_prob > 0.48 then 1e0 else 0e0 end) as high_risk_rate, count(sk_id_curr) as volume,
 avg(case when pred_prob > 0.48 then 1e0 else 0e0 end) * 1e2 as high_risk_pct from px_scored group by 1"""


@query(
    "tse01_vintage", "select * from px_vintage",
    {"default_rate avg_pd default_rate_pct avg_pd_pct total_ead_b": 8, "total_ead": 1},
)
def _(v):
    return T.vintage(v.loans)


@query(
    "tse02_migration_stage",
    "select s0, s1, count(*) as loan_count from px_migration_stage group by 1, 2",
)
def _(v):
    now = T.migration_stage(v.loans, F.col("pred_prob"))
    then = T.migration_stage(v.loans, S.clip(F.col("pred_prob") * 1.25, 0.0, 0.999))
    return v.loans.groupBy(now.alias("s0"), then.alias("s1")).agg(F.count(F.lit(1)).alias("loan_count"))


_MATRIX = ", ".join(f"max(ead_b) filter (stage_t1 = {s}) as to_stage_{s}" for s in (1, 2, 3))


@query(
    "tse03_migration_matrix", f"select stage_t, {_MATRIX} from px_migration group by stage_t",
    {"to_stage_1 to_stage_2 to_stage_3": 8},
)
def _(v):
    return T.migration_matrix(T.migration_long(v.loans))


@query(
    "tse04_migration_pct",
    """select stage_t, stage_t1, ead_b, ead_b / nullif(sum(ead_b) over (partition by stage_t), 0) * 100 as pct from px_migration""",
    {"ead_b pct": 8},
)
def _(v):
    return T.migration_pct_long(T.migration_long(v.loans))


@query("win05_group_total", "select stage_t, stage_t1, sum(ead_b) over (partition by stage_t) as total from px_migration", {"total": 8})
def _(v):
    from pyspark.sql import Window
    cells = T.migration_long(v.loans)
    return cells.select("stage_t", "stage_t1", F.sum("ead_b").over(Window.partitionBy("stage_t")).alias("total"))


@query(
    "tse05_ecl_projection", "select * from px_projection", {"ecl_b": 3, "ecl_current_b ead_current_b": 8},
)
def _(v):
    return T.ecl_projection(v.loans)


@query(
    "tse06_cohort_default", "select * from px_cohort",
    {"default_rate avg_pd default_rate_pct total_ead_b avg_ecl_k": 7, "total_ead": 1, "avg_ecl": 3},
)
def _(v):
    return T.cohort_default(v.loans)


_HOURS = ", ".join(
    f"coalesce(avg(case when pred_prob > 0.48 then 1e2 else 0e0 end) filter (hour_appr_process_start = {h}), 0e0) as h{h:02d}" for h in range(24)
)


@query(
    "tse07_intraday_heatmap",
    f"select weekday, {_HOURS} from (select *, {_DAY} as weekday from px_scored) where weekday <> 'Unknown' group by weekday",
    {" ".join(f"h{h:02d}" for h in range(24)): 7},
)
def _(v):
    return T.intraday_heatmap(v.scored, T.weekday_label())


@query("tse08_intraday_hourly", "select * from px_hourly", {"high_risk_rate high_risk_pct": 8})
def _(v):
    return T.intraday_hourly(v.scored)


@query("tse09_intraday_daily", f"select * from ({_DAILY}) where weekday <> 'Unknown'", {"high_risk_rate high_risk_pct": 8})
def _(v):
    return T.intraday_daily(v.scored, T.weekday_label())


PARTS["px_monthly"] = "select disbursement_month, avg(target) as default_rate, count(*) as loan_count from px_banded group by 1"


@query("tse10_monthly_rate", "select * from px_monthly", {"default_rate": 8})
def _(v):
    return T.monthly_rate(v.banded)


@query(
    "tse11_linear_trend",
    """with x as (select *, row_number() over (order by disbursement_month) - 1 as x from px_monthly)
    select disbursement_month, x, default_rate, slope * x + intercept as trend from x,
     (select regr_slope(default_rate, x) as slope, regr_intercept(default_rate, x) as intercept from x)""",
    {"default_rate trend": 8},
)
def _(v):
    return T.linear_trend(T.monthly_rate(v.banded)).select(
        "disbursement_month", F.col("x").cast("long").alias("x"), "default_rate", "trend"
    )


@query("dsh15_mean_vintage_rate", "select avg(default_rate_pct) as mean_rate_pct from px_vintage", {"mean_rate_pct": 7})
def _(v):
    return D.mean_rate(T.vintage(v.loans))


@query("dsh15_mean_cohort_rate", "select avg(default_rate_pct) as mean_rate_pct from px_cohort", {"mean_rate_pct": 7})
def _(v):
    return D.mean_rate(T.cohort_default(v.loans))


@query(
    "doc06_cumulative_default",
    """with m as (select cast(year(d) as varchar) || 'Q' || cast(quarter(d) as varchar) as cohort, disbursement_month, count(*) as loan_count,
      count(*) filter (target = 1) as defaults from (select *, date '2016-06-01' - cast(least(abs(days_id_publish), 1095) as integer) as d from px_banded) group by 1, 2)
    select *, cum_defaults / cum_loans as cum_default_rate from (select *, cast(sum(loan_count) over w as bigint) as cum_loans, cast(sum(defaults) over w as bigint) as cum_defaults
     from m window w as (partition by cohort order by disbursement_month rows between unbounded preceding and current row))""",
    {"cum_default_rate": 8},
)
def _(v):
    date = S.days_before_reference(S.clip(F.abs(F.col("days_id_publish")), 0, 1095))
    return T.cumulative_default(v.banded, S.quarter_label(date))


@query(
    "srt02_custom_order",
    f"select weekday, volume, cast(row_number() over (order by case weekday {' '.join(f'''when '{d}' then {i}''' for i, d in enumerate(T.DAY_ORDER))} end) as integer) as position from ({_DAILY}) where weekday <> 'Unknown'",
)
def _(v):
    from pyspark.sql import Window
    daily = T.intraday_daily(v.scored, T.weekday_label()).select("weekday", "volume")
    return daily.withColumn("position", F.row_number().over(Window.orderBy(S.ordinal("weekday", T.DAY_ORDER))))
