"""Metric queries over the scored loans."""

from pyspark.sql import functions as F

from provisio.operators import metrics as M
from provisio.operators import monitoring as D
from provisio.plans.catalog.registry import PARTS, query

PARTS["px_score_counts"] = """
select pred_prob as score, count(*) filter (target = 1) as pos, count(*) filter (target = 0) as neg from px_scored group by pred_prob"""
PARTS["px_roc"] = """
select score as threshold, sum(neg) over w / sum(neg) over () as fpr, sum(pos) over w / sum(pos) over () as tpr from px_score_counts
 window w as (order by score desc rows between unbounded preceding and current row)"""


def auc_sql(p, table="px_scored"):
    """Midrank form of the AUC of an expression."""
    return f"""select (sum(r) filter (target = 1) - count(*) filter (target = 1) * (count(*) filter (target = 1) + 1) / 2.0)
     / (count(*) filter (target = 1) * 1e0 * count(*) filter (target = 0)) as auc
    from (select target, (rank() over (order by {p}) + rank() over (order by {p}) + count(*) over (partition by {p}) - 1) / 2.0 as r from {table})"""


def ks_sql(p, table="px_scored"):
    edges = ", ".join(f"quantile_cont({p}, {i / 10}) as e{i}" for i in range(1, 10))
    b = " + ".join(f"case when {p} > e{i} then 1 else 0 end" for i in range(1, 10))
    return f"""select bucket, total, defaults, total - defaults as goods,
     sum(defaults) over w / greatest(sum(defaults) over (), 1) as cum_defaults, sum(total - defaults) over w / greatest(sum(total - defaults) over (), 1) as cum_goods
    from (select {b} as bucket, count(*) as total, cast(sum(target) as bigint) as defaults from {table}, (select {edges} from {table}) group by 1)
    window w as (order by bucket rows between unbounded preceding and current row)"""


@query("met01_auc", auc_sql("pred_prob"), {"auc": 10})
def _(v):
    return M.auc(v.scored)


@query("met02_gini", f"select 2 * auc - 1 as gini from ({auc_sql('pred_prob')})", {"gini": 10})
def _(v):
    return M.auc(v.scored).select(M.gini(F.col("auc")).alias("gini"))


@query("met03_ks", f"select max(abs(cum_goods - cum_defaults)) as ks from ({ks_sql('pred_prob')})", {"ks": 9})
def _(v):
    return M.ks(v.scored)


@query("win01_cumulative_sum", ks_sql("pred_prob"), {"cum_defaults cum_goods": 9})
def _(v):
    return M.ks_table(v.scored)


@query("met04_brier", "select avg(pow(pred_prob - target, 2)) as brier from px_scored", {"brier": 9})
def _(v):
    return M.brier(v.scored)


_CAL = " + ".join(f"case when pred_prob > {i / 10}e0 then 1 else 0 end" for i in range(1, 10))
PARTS["px_calibration"] = f"""
select {_CAL} as bin, avg(pred_prob) as mean_predicted, avg(target) as observed_rate, count(*) as row_count from px_scored group by 1"""


@query("met05_calibration_curve", "select * from px_calibration", {"mean_predicted observed_rate": 9})
def _(v):
    return M.calibration_curve(v.scored)


@query("met06_roc_points", "select * from px_roc", {"fpr tpr": 10})
def _(v):
    return M.roc_points(v.scored)


@query(
    "met07_confusion",
    """select count(*) filter (target = 1 and pred_prob >= 0.4) as tp, count(*) filter (target = 0 and pred_prob >= 0.4) as fp,
     count(*) filter (target = 1 and pred_prob < 0.4) as fn, count(*) filter (target = 0 and pred_prob < 0.4) as tn from px_scored""",
)
def _(v):
    return M.confusion(v.scored, 0.4)


_MD = ["amt_income_total", "inst_late_ratio", "prev_refused_ratio"]


@query(
    "met08_missed_defaults",
    "select *, missed_mean - portfolio_mean as delta from (" + " union all ".join(
        f"""select count(*) filter (target = 1 and pred_prob < 0.48) as missed,
        count(*) filter (target = 1 and pred_prob < 0.48) / count(*) filter (target = 1) as fnr, '{c}' as feature,
        avg({c}) filter (target = 1 and pred_prob < 0.48) as missed_mean, avg({c}) as portfolio_mean from px_scored""" for c in _MD
    ) + ")",
    {"fnr": 8, "missed_mean portfolio_mean delta": 5},
)
def _(v):
    return M.missed_default_profile(v.scored, _MD, 0.48)


def psi_sql(c, base, other):
    edges = ", ".join(f"quantile_cont({c}, {i / 10}) as e{i}" for i in range(1, 10))
    b = " + ".join(f"case when {c} > e{i} then 1 else 0 end" for i in range(1, 10))
    return f"""select sum((o - s) * ln(o / s)) as psi from (
     select greatest(bn / sum(bn) over (), 1e-4) as s, greatest(otn / sum(otn) over (), 1e-4) as o from (
      select {b} as bin, count(*) filter (k = 1) as bn, count(*) filter (k = 0) as otn
      from (select {c}, 1 as k from {base} where {c} is not null union all select {c}, 0 from {other} where {c} is not null),
       (select {edges} from {base}) group by 1))"""


PARTS["px_app_train"] = "select * from px_application where is_train = 1"
PARTS["px_app_test"] = "select * from px_application where is_train = 0"
_ALERT = "case when psi > 0.25 then 'shift' when psi > 0.10 then 'watch' else 'stable' end as alert"


@query("met09_psi", f"select psi, {_ALERT} from ({psi_sql('ext_source_2', 'px_app_train', 'px_app_test')})", {"psi": 8})
def _(v):
    return M.psi(v.application.filter("is_train = 1"), v.application.filter("is_train = 0"), "ext_source_2")


_CSI = ["ext_source_1", "amt_credit", "days_birth"]


@query(
    "met09_csi",
    " union all ".join(f"select '{c}' as feature, psi, {_ALERT} from ({psi_sql(c, 'px_app_train', 'px_app_test')})" for c in _CSI),
    {"psi": 8},
)
def _(v):
    return M.csi(v.application.filter("is_train = 1"), v.application.filter("is_train = 0"), _CSI)


@query(
    "met10_ece",
    "select sum(abs(mean_predicted - observed_rate) * row_count) / sum(row_count) as ece from px_calibration",
    {"ece": 9},
)
def _(v):
    return M.ece(v.scored)


PARTS["px_fold_scored"] = "select *, sk_id_curr % 5 as fold from px_scored"


@query(
    "met10_fold_auc_std",
    "select avg(auc) as mean_auc, stddev_samp(auc) as std_auc from (" + " union all ".join(
        auc_sql("pred_prob", f"(select * from px_fold_scored where fold = {i})") for i in range(5)
    ) + ")",
    {"mean_auc std_auc": 9},
)
def _(v):
    return M.fold_auc_std(v.scored.withColumn("fold", F.col("sk_id_curr") % 5), 5)


@query(
    "met10_lift",
    f"select a.auc - b.auc as lift from ({auc_sql('pred_prob')}) a, ({auc_sql('inst_late_ratio')}) b",
    {"lift": 9},
)
def _(v):
    value = M.lift(M.auc(v.scored).first()[0], M.auc(v.scored, p="inst_late_ratio").first()[0])
    return v.spark.createDataFrame([(value,)], "lift double")


PARTS["px_models"] = "select *, 1 - pred_prob as rev, (pred_prob + inst_late_ratio) / 2 as mix from px_scored"
_MODELS = {"primary": "pred_prob", "reversed": "rev", "mixed": "mix"}
PARTS["px_leaderboard"] = " union all ".join(
    f"""select '{m}' as model, round_even((select auc from ({auc_sql(c, 'px_models')})), 4) as oof_auc,
    round_even(2 * (select auc from ({auc_sql(c, 'px_models')})) - 1, 4) as gini,
    round_even((select max(abs(cum_goods - cum_defaults)) from ({ks_sql(c, 'px_models')})) * 100, 2) as ks_pct,
    round_even((select avg(pow({c} - target, 2)) from px_models), 5) as brier from customer group by 1""" for m, c in _MODELS.items()
)


def _board(v):
    df = v.scored.withColumns({"rev": 1 - F.col("pred_prob"), "mix": (F.col("pred_prob") + F.col("inst_late_ratio")) / 2})
    return M.leaderboard(df, _MODELS)


@query("mod10_leaderboard", "select * from px_leaderboard", {"oof_auc gini": 4, "ks_pct": 2, "brier": 5})
def _(v):
    return _board(v)


@query("mod10_best_model", "select arg_max(model, oof_auc) as model, max(oof_auc) as oof_auc from px_leaderboard", {"oof_auc": 4})
def _(v):
    return M.best_model(_board(v))


@query(
    "doc03_ks_threshold",
    """select threshold, tpr - fpr as gap from px_roc order by round(tpr - fpr, 12) desc, threshold limit 1""",
    {"gap": 9},
)
def _(v):
    return D.ks_threshold(v.scored)


@query(
    "met01_auc_wide_scores",
    auc_sql("s", "(select s, case when l_returnflag = 'R' then 1 else 0 end as target from (select l_returnflag, l_extendedprice * (1 - l_tax) as s from lineitem))"),
    {"auc": 10},
)
def _(v):
    df = v.table("lineitem").select(
        (F.col("l_extendedprice") * (1 - F.col("l_tax"))).alias("s"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("target"),
    )
    return M.auc(df, p="s")
