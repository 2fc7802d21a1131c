"""Scorecard queries: two quantile-binned numbers, one ten-valued number and two texts."""

from pyspark.sql import functions as F

from provisio.operators import woe as W
from provisio.plans.catalog.registry import PARTS, query

_VALUE = ["name_income_type", "name_education_type", "cnt_children"]
_QUANT = ["ext_source_2", "ext_source_1", "amt_credit"]
FEATURES = _VALUE + _QUANT

PARTS["px_train"] = "select * from px_application where is_train = 1"


def _edges(c):
    return ", ".join(f"quantile_cont({c}, {i / 10}) as e{i}" for i in range(11))


def _bin(c):
    return " + ".join(f"case when t.{c} > e{i} then 1 else 0 end" for i in range(1, 10))


PARTS["px_bins"] = " union all ".join(
    [f"select '{c}' as feature, cast({c} as varchar) as bin, target as y from px_train where {c} is not null" for c in _VALUE]
    + [
        f"select '{c}', lpad(cast({_bin(c)} as varchar), 3, '0'), t.target from px_train t, (select {_edges(c)} from px_train) where t.{c} is not null"
        for c in _QUANT
    ]
)
PARTS["px_bin_table"] = """
select feature, bin, cast(sum(y) as bigint) as events, count(*) as total, cast(count(*) - sum(y) as bigint) as nonevents from px_bins group by feature, bin"""
PARTS["px_woe"] = """
select b.*, (events + 0.5e0) / (e + 0.5e0) as pct_ev, (nonevents + 0.5e0) / (n + 0.5e0) as pct_nev,
 ln(((events + 0.5e0) / (e + 0.5e0)) / ((nonevents + 0.5e0) / (n + 0.5e0))) as woe,
 ((events + 0.5e0) / (e + 0.5e0) - (nonevents + 0.5e0) / (n + 0.5e0)) * ln(((events + 0.5e0) / (e + 0.5e0)) / ((nonevents + 0.5e0) / (n + 0.5e0))) as iv
from px_bin_table b, (select sum(target) as e, count(*) - sum(target) as n from px_train)"""
PARTS["px_iv"] = """
select feature, round_even(iv, 6) as iv, case when iv > 0.5 then 'Suspicious' when iv > 0.3 then 'Strong' when iv > 0.1 then 'Medium'
 when iv > 0.02 then 'Weak' else 'Useless' end as flag from (select feature, sum(iv) as iv from px_woe group by feature)"""


def train(v):
    return v.application.filter("is_train = 1")


@query(
    "woe01_bins",
    " union all ".join(
        [f"select '{c}' as feature, 'value' as kind, null::integer as position, null::double as edge from px_train group by 1" for c in _VALUE]
        + [f"select '{c}', 'quantile', cast(row_number() over (order by edge) - 1 as integer), edge from (select distinct unnest([{', '.join(f'cast(e{i} as double)' for i in range(11))}]) as edge from (select {_edges(c)} from px_train))"
           for c in _QUANT]
    ),
    {"edge": 9},
)
def _(v):
    """One row per edge of the quantile features, one for each feature that bins by value."""
    bins = W.fit_bins(train(v), FEATURES)
    rows = [(f, rule["kind"], i, e) for f, rule in bins.items() for i, e in (enumerate(map(float, rule["edges"])) if "edges" in rule else [(None, None)])]
    return v.spark.createDataFrame(rows, "feature string, kind string, position int, edge double")


@query(
    "woe01_bin_edges",
    " union all ".join(
        f"select '{c}' as feature, cast(row_number() over (order by edge) - 1 as integer) as position, edge from (select distinct unnest([{', '.join(f'cast(e{i} as double)' for i in range(11))}]) as edge from (select {_edges(c)} from px_train))"
        for c in _QUANT
    ),
    {"edge": 9},
)
def _(v):
    bins = W.fit_bins(train(v), FEATURES)
    rows = [(f, i, float(e)) for f, rule in bins.items() for i, e in enumerate(rule.get("edges", []))]
    return v.spark.createDataFrame(rows, "feature string, position int, edge double")


@query("woe02_bin_table", "select * from px_bin_table")
def _(v):
    return W.bin_table(train(v), W.fit_bins(train(v), FEATURES))


def _table(v):
    return W.woe_table(W.bin_table(train(v), W.fit_bins(train(v), FEATURES)), W.totals(train(v)))


@query("woe03_weights", "select * from px_woe", {"pct_ev pct_nev woe iv": 8})
def _(v):
    return _table(v)


@query("woe04_information_value", "select feature, iv from px_iv", {"iv": 6})
def _(v):
    return W.information_value(_table(v)).select("feature", "iv")


@query("woe05_iv_flag", "select feature, flag from px_iv")
def _(v):
    return W.information_value(_table(v)).select("feature", "flag")


@query(
    "woe06_iv_screen",
    """select cast(row_number() over (order by iv desc, feature) as integer) as rank, feature, iv, flag, flag not in ('Useless', 'Suspicious') as keep from px_iv""",
    {"iv": 6},
)
def _(v):
    return W.iv_screen(train(v), FEATURES)


@query("woe06_strength_counts", "select flag, count(*) as features from px_iv group by flag")
def _(v):
    return W.iv_strength_counts(W.iv_screen(train(v), FEATURES))


@query("woe07_fit_weights", "select feature, bin, woe from px_woe", {"woe": 8})
def _(v):
    return W.fit_woe(train(v), FEATURES)[1]


def _applied(c, value):
    key = f"cast(t.{c} as varchar)" if value else f"lpad(cast({_bin(c)} as varchar), 3, '0')"
    return (
        f"select t.sk_id_curr, '{c}' as f, case when t.{c} is null then 0e0 else coalesce(w.woe, 0e0) end as x from px_application t"
        + ("" if value else f" cross join (select {_edges(c)} from px_train)")
        + f" left join px_woe w on w.feature = '{c}' and w.bin = {key}"
    )


@query(
    "woe08_apply_weights",
    "select sk_id_curr, " + ", ".join(f"max(x) filter (f = '{c}') as {c}_woe" for c in FEATURES) + " from ("
    + " union all ".join([_applied(c, True) for c in _VALUE] + [_applied(c, False) for c in _QUANT]) + ") group by sk_id_curr",
    {" ".join(f"{c}_woe" for c in FEATURES): 8},
)
def _(v):
    bins, weights = W.fit_woe(train(v), FEATURES)
    return W.apply_woe(v.application, bins, weights).select("sk_id_curr", *[f"{c}_woe" for c in FEATURES])


@query(
    "woe_scored_portfolio",
    """with s as (select sk_id_curr, target, name_contract_type, region_rating from px_scored), t as (select sum(target) as e, count(*) - sum(target) as n from s),
    b as (select 'name_contract_type' as feature, name_contract_type as bin, target as y from s union all
          select 'region_rating', cast(region_rating as varchar), target from s)
    select feature, bin, cast(sum(y) as bigint) as events, count(*) as total,
     ln(((sum(y) + 0.5e0) / (any_value(e) + 0.5e0)) / ((count(*) - sum(y) + 0.5e0) / (any_value(n) + 0.5e0))) as woe from b, t group by feature, bin""",
    {"woe": 8},
)
def _(v):
    fields = ["name_contract_type", "region_rating"]
    bins = W.fit_bins(v.scored, fields)
    return W.woe_table(W.bin_table(v.scored, bins), W.totals(v.scored)).select("feature", "bin", "events", "total", F.col("woe"))
