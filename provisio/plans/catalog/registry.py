"""Registry of the queries: a Spark plan over the test views and, where SQL can express it,
the same result as DuckDB SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.plans.proxy import PROXIES, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Named intermediate results of the oracle SQL, on top of the proxy views.
PARTS: dict[str, str] = dict(PROXIES)
PARTS["px_inst_clean"] = """
select *, amt_instalment - amt_payment as payment_diff,
 case when days_entry_payment - days_instalment < 0 then 0e0 else days_entry_payment - days_instalment end as days_past_due
from (select * replace (coalesce(amt_payment, (select median(amt_payment) from px_installments)) as amt_payment)
      from px_installments)"""
PARTS["px_card_clean"] = """
select sk_id_curr, months_balance, amt_balance, amt_credit_limit_actual,
 coalesce(amt_drawings_current, 0e0) as amt_drawings_current,
 coalesce(amt_payment_current, 0e0) as amt_payment_current,
 least(sk_dpd, 365) as sk_dpd, least(sk_dpd_def, 365) as sk_dpd_def,
 case when amt_credit_limit_actual > 0 then least(amt_balance / amt_credit_limit_actual, 2e0) else 0e0 end as utilization_ratio
from px_credit_card"""
PARTS["px_loan_base"] = """
select *, case when contains(upper(name_contract_type), 'CASH') then case when amt_down_payment > 0 then 0.55e0 else 0.75e0 end
  when contains(upper(name_contract_type), 'REV') then case when amt_down_payment > 0 then 0.45e0 else 0.65e0 end
  else case when amt_down_payment > 0 then 0.35e0 else 0.50e0 end end as lgd,
 coalesce(amt_credit, (select median(amt_credit) from px_scored))
   * case when contains(name_contract_type, 'Rev') then 1.2e0 else 1e0 end as ead,
 case when pred_prob > 0.70 or bureau_bad_debt_flag = 1 then 3
  when pred_prob > 0.20 or coalesce(inst_late_ratio, 0) > 0.30 or coalesce(prev_refused_ratio, 0) > 0.50 then 2
  else 1 end as stage,
 least(greatest(pred_prob, 0.001e0), 0.999e0) as pd_12m,
 case when credit_term is null then 36e0 else least(greatest(credit_term, 6e0), 120e0) end / 12e0 as loan_term_yrs
from px_scored"""
PARTS["px_loan_term"] = """
select *, pd_lifetime / pd_12m as pd_multiplier from (
 select *, least(greatest(1e0 - pow(1e0 - pd_12m, loan_term_yrs), pd_12m), 0.999e0) as pd_lifetime from px_loan_base)"""


def _overlay(base: str, scalar: str) -> str:
    return f"least(greatest({base} * {scalar}, 0.001e0), 0.999e0)"


_SCALARS = {"optimistic": ("0.85e0", "0.2e0"), "base": ("1e0", "0.5e0"), "adverse": ("1.35e0", "0.2e0"), "severe": ("1.75e0", "0.1e0")}
PARTS["px_loan_macro"] = (
    "select *, " + ", ".join(f"{_overlay(b, s)} as {b}_{n}" for b in ("pd_12m", "pd_lifetime") for n, (s, _w) in _SCALARS.items())
    + ", " + ", ".join(
        " + ".join(f"{_overlay(b, s)} * {w}" for _n, (s, w) in _SCALARS.items()) + f" as {b}_macro" for b in ("pd_12m", "pd_lifetime")
    ) + " from px_loan_term"
)
PARTS["px_loans"] = """
select *, ecl / greatest(ead, 1e0) as ecl_rate from (
 select *, (pd_12m_macro / pd_12m - 1) * 1e2 as macro_uplift_12m_pct,
  case stage when 1 then pd_12m_macro * lgd * ead when 2 then pd_lifetime_macro * lgd * ead else lgd * ead end as ecl
 from px_loan_macro)"""


def cut_sql(c: str, edges, labels, outside: str | None = None) -> str:
    other = "null" if outside is None else f"'{outside}'"
    arms = " ".join(f"when {c} <= {float(e)!r} then '{t}'" for e, t in zip(edges[1:], labels))
    return f"case when {c} is null or {c} <= {float(edges[0])!r} then {other} {arms} else {other} end"


def _banded() -> str:
    ratio = "{} / greatest(amt_income_total, 1e0)"
    return f"""
select *, {cut_sql('term_m', (-1, 18, 30, 42, 9999), ('≤18m', '24m', '36m', '48m+'))} as term_bin,
 {cut_sql(ratio.format('amt_credit'), (-1, 1, 2, 3, 5, 999), ('0–1×', '1–2×', '2–3×', '3–5×', '>5×'))} as lti_bin,
 {cut_sql(ratio.format('amt_annuity'), (-1, .1, .2, .3, .5, 9), ('0–10%', '10–20%', '20–30%', '30–50%', '>50%'))} as dti_bin,
 {cut_sql('amt_credit', (0, 1e5, 2e5, 3e5, 5e5, 9e9), ('$0–100k', '$100–200k', '$200–300k', '$300–500k', '$500k+'))} as cred_bin,
 {cut_sql('pred_prob', (0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1.01), [f'{i}0–{i + 1}0%' if i else '0–10%' for i in range(10)])} as pd_band,
 strftime(date '2016-06-01' - cast(least(abs(days_id_publish), 1095) as integer), '%Y-%m') as disbursement_month,
 case when pred_prob < 0.08 then 'Very Low' when pred_prob < 0.18 then 'Low' when pred_prob < 0.40 then 'Medium' else 'High' end as risk_tier,
 case when pred_prob < 0.20 then 1 when pred_prob < 0.50 then 2 else 3 end as stage,
 pred_prob * 0.45e0 * amt_credit as ecl
from (select *, round_even(amt_credit / greatest(amt_annuity, 1e0), 0) as term_m from px_scored)"""


PARTS["px_banded"] = _banded()
PARTS["px_predictions"] = """
select sk_id_curr, case when sk_id_curr % 3 = 0 then 'lgbm_v2' else 'lgbm_v1' end as model_version,
 pred_prob as default_probability,
 case when pred_prob between 0 and 0.27892775991838853e0 then 'Very Low'
  when pred_prob between 0.27892775991838853e0 and 0.45654430591731376e0 then 'Low'
  when pred_prob between 0.45654430591731376e0 and 0.6493265692008885e0 then 'Medium' else 'High' end as risk_tier,
 target as actual_target, stage, ead, ecl from px_loans"""
PARTS["px_wh_application"] = """
select * replace (nullif(days_employed, 365243) as days_employed),
 case when days_employed = 365243 then 1 else 0 end as emp_anomaly, 1 - is_train as is_test from px_application"""


def _needs(sql: str, seen: list[str]) -> list[str]:
    for name in re.findall(r"\bpx_\w+", sql):
        if name in PARTS and name not in seen:
            _needs(PARTS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_parts(sql: str) -> str:
    """The SQL with the named parts it uses in front."""
    parts = _needs(sql, [])
    ctes = ",\n".join(f"{p} as ({PARTS[p].strip()})" for p in parts)
    return f"with {ctes}\nselect * from (\n{sql.strip()}\n)" if ctes else sql.strip()


def _digits(spec: dict[str, int] | None) -> dict[str, int]:
    return {c: d for cols, d in (spec or {}).items() for c in cols.split()}


def _tolerance(digits: int) -> float:
    """Values this close below a tie round up, so that the order of a float sum cannot matter."""
    return 3.1 * 10.0 ** (-digits - 3)


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named float columns (sums differ in the last digits between engines)."""
    return df.select(*[
        F.round(F.col(c).cast("double") + F.lit(_tolerance(digits[c])), digits[c]).alias(c)
        if c in digits else F.col(f"`{c}`")
        for c in df.columns
    ])


def query(key: str, sql: str | None = None, digits: dict[str, int] | None = None):
    """Register ``fn(views) -> DataFrame`` under a key, with its oracle."""
    places = _digits(digits)

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(fn(Views(spark, folder)), places)

        if key in QUERIES:
            raise ValueError(f"{key} registered twice")
        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            text = with_parts(sql)
            if places:
                cols = ", ".join(f"round(cast({c} as double) + {_tolerance(d)!r}, {d}) + 0e0 as {c}" for c, d in places.items())
                text = f"select * replace ({cols}) from (\n{text}\n)"
            ORACLES[key] = text
        return fn

    return add
