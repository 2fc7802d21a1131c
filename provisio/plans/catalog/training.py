"""Folds, learners, calibration and explanations on the scored loans.

The learners run with few trees here; their defaults are those of the library.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.operators import explain as E
from provisio.operators import metrics as M
from provisio.operators import models as MD
from provisio.operators import woe as W
from provisio.plans.catalog.metrics import auc_sql
from provisio.plans.catalog.registry import PARTS, query
from provisio.session import write_once

FEATURES = ["inst_late_ratio", "amt_income_total", "days_birth", "credit_term"]


def frame(v):
    """Labelled rows with complete features: real labels of documents by text size and source.

    Written once: fits, folds and scores read the features many times and the texts not again.
    """
    docs = v.table("documents").join(v.table("labels"), "doc_id")
    words = F.size(F.split("text", r"\s+")).cast("double")
    rows = docs.select(
        F.col("doc_id").alias("sk_id_curr"), F.col("quality").alias("target"),
        F.col("n_chars").cast("double").alias("chars"), words.alias("words"),
        (F.col("n_chars") / words).alias("chars_per_word"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("digits"),
    )
    return write_once(rows, "frame")


X = ["chars", "words", "chars_per_word", "digits"]


def loans(v):
    return v.scored.select("sk_id_curr", "target", *[
        F.coalesce(F.col(c).cast("double"), F.lit(36.0)).alias(c) for c in FEATURES
    ])


@query(
    "mod01_stratified_folds",
    """select sk_id_curr, target, cast((row_number() over (partition by target order by md5('42:' || cast(sk_id_curr as varchar)), sk_id_curr) - 1) % 5 as integer) as fold
    from px_scored""",
)
def _(v):
    return MD.assign_folds(v.scored, 5).select("sk_id_curr", "target", "fold")


@query(
    "mod02_class_weights",
    """select target, count(*) as row_count, sum(count(*)) over () / (count(*) * 2e0) as balanced,
     (sum(count(*)) over () - count(*)) / count(*) as other_to_own from px_scored group by target""",
    {"balanced other_to_own": 8},
)
def _(v):
    return MD.class_weight_table(v.scored)


def _small_gbt():
    return MD.gbt(trees=8, depth=3, step=0.2)


def _folded(v, k=3):
    return MD.with_weight(MD.assign_folds(frame(v), k))


def _whole(v, factory):
    """A model of all labelled rows, and those rows."""
    df = MD.with_weight(frame(v))
    return factory().fit(MD.assemble(df, X)), df


@query("mod03_gbt_oof")
def _(v):
    return MD.oof_predict(_folded(v), _small_gbt, X, 3).select("sk_id_curr", "target", "fold", "pred_prob")


@query("mod04_random_forest_oof")
def _(v):
    return MD.oof_predict(_folded(v), lambda: MD.random_forest(trees=20, depth=5, min_leaf=5), X, 3).select(
        "sk_id_curr", "target", "fold", "pred_prob"
    )


def _scorecard(v):
    df = frame(v)
    bins, weights = W.fit_woe(df, X)
    woe_cols = [f"{c}_woe" for c in X]
    return W.apply_woe(df, bins, weights).select("sk_id_curr", "target", *woe_cols), woe_cols


@query("mod05_logistic_scorecard")
def _(v):
    df, cols = _scorecard(v)
    return MD.oof_predict(MD.assign_folds(df, 3), MD.logistic, cols, 3).select("sk_id_curr", "target", "pred_prob")


@query("mod06_oof_logistic_loans")
def _(v):
    return MD.oof_predict(MD.assign_folds(loans(v), 3), MD.logistic, FEATURES, 3).select("sk_id_curr", "fold", "pred_prob")


@query(
    "mod06_score_equations",
    "select fold, feature, true as is_solved from (select unnest([0, 1, 2]) as fold), (select unnest(['intercept', "
    + ", ".join(f"'{f}'" for f in X) + "]) as feature), (select count(*) as n from labels) where n > 0",
)
def _(v):
    """Each fold's logistic fit solves its score equations on the other folds: residuals sum to zero, also times each feature."""
    df = _folded(v).drop("weight")
    scored = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(2)))).filter("other <> fold")
    models = MD.fit_folds(df, MD.logistic, X, 3)
    own = reduce(DataFrame.unionByName, [MD.score_with(m, MD.assemble(scored.filter(F.col("other") == i), X), "p") for i, m in enumerate(models)])
    gap = F.col("target") - F.col("p")
    sums = [F.struct(F.lit("intercept").alias("feature"), (F.abs(F.avg(gap)) < 1e-4).alias("is_solved"))] + [
        F.struct(F.lit(f).alias("feature"), (F.abs(F.avg(gap * F.col(f))) < 1e-4 * F.stddev(f)).alias("is_solved")) for f in X]
    return own.groupBy(F.col("other").alias("fold")).agg(F.array(*sums).alias("r")).select("fold", F.inline("r"))


@query("mod07_ensemble_mean", "select doc_id as sk_id_curr, true as is_mean from documents join labels using (doc_id)")
def _(v):
    """The ensemble score of each row is the mean of the scores of the fold models."""
    df = _folded(v)
    models = MD.fit_folds(df, MD.logistic, X, 3)
    out = MD.ensemble_predict(df, models, X)
    for i, m in enumerate(models):
        out = MD.score_with(m, MD.assemble(out, X), f"p{i}").drop("features")
    mean = reduce(lambda a, b: a + b, [F.col(f"p{i}") for i in range(3)]) / 3
    return out.select("sk_id_curr", (F.abs(F.col("pred_prob") - mean) < 1e-12).alias("is_mean"))


@query("mod07_ensemble")
def _(v):
    df = _folded(v)
    models = MD.fit_folds(df, lambda: MD.logistic(), X, 3)
    return MD.ensemble_predict(df, models, X).select("sk_id_curr", "pred_prob")


def _isotonic_sql(points: str) -> str:
    """Fitted value v at each score x of points (f, x, t, w): the largest, over all starts, of the least mean from there on."""
    return f"""
     select f, x, max(least_mean) as v from (
      select a.f, b.x, min((b.ct - a.ct + a.t) / (b.cw - a.cw + a.w)) over (partition by a.f, a.x order by b.x desc) as least_mean
      from ({points}) a join ({points}) b on a.f = b.f and a.x <= b.x) group by f, x"""


PARTS["px_score_points"] = """
select 0 as f, x, t, w, sum(t) over (order by x) as ct, sum(w) over (order by x) as cw
from (select pred_prob as x, cast(sum(target) as double) as t, cast(count(*) as double) as w from px_scored group by 1)"""
PARTS["px_fold_of"] = """
select sk_id_curr, target, pred_prob, cast((row_number() over (partition by target order by md5('42:' || cast(sk_id_curr as varchar)), sk_id_curr) - 1) % 5 as integer) as fold
from px_scored"""
PARTS["px_fold_points"] = """
select *, sum(t) over (partition by f order by x) as ct, sum(w) over (partition by f order by x) as cw from (
 select f, pred_prob as x, cast(sum(target) as double) as t, cast(count(*) as double) as w
 from px_fold_of, (select unnest([0, 1, 2, 3, 4]) as f) where fold <> f group by 1, 2)"""
PARTS["px_fold_fitted"] = _isotonic_sql("select * from px_fold_points")


@query(
    "mod08_isotonic",
    f"select sk_id_curr, pred_prob, v as pd_calibrated from px_scored join ({_isotonic_sql('select * from px_score_points')}) on x = pred_prob",
    {"pd_calibrated": 9},
)
def _(v):
    return MD.apply_isotonic(v.scored, MD.fit_isotonic(v.scored)).select("sk_id_curr", "pred_prob", "pd_calibrated")


@query(
    "mod08_cross_calibrated",
    """select sk_id_curr, fold, case when lo.x is null then hi.v when hi.x is null or hi.x = lo.x then lo.v
      else lo.v + (hi.v - lo.v) * (pred_prob - lo.x) / (hi.x - lo.x) end as pd_calibrated
    from px_fold_of r asof left join px_fold_fitted lo on r.fold = lo.f and r.pred_prob >= lo.x
     asof left join px_fold_fitted hi on r.fold = hi.f and r.pred_prob <= hi.x""",
    {"pd_calibrated": 9},
)
def _(v):
    return MD.cross_calibrate(MD.assign_folds(v.scored, 5), 5).select("sk_id_curr", "fold", "pd_calibrated")


@query(
    "mod09_clip_pd",
    "select sk_id_curr, least(greatest(pred_prob * 1.2e0 - 0.1e0, 0.001e0), 0.999e0) as pd from px_scored",
    {"pd": 9},
)
def _(v):
    return v.scored.select("sk_id_curr", MD.clip_pd(F.col("pred_prob") * 1.2 - 0.1).alias("pd"))


SPACE = {"trees": ("int", 3, 6, 1), "step": ("log", 0.05, 0.3), "depth": ("int", 2, 3, 1)}


@query("mod11_random_search")
def _(v):
    return MD.random_search(frame(v), X, SPACE, n=4, k=3).select("trial", "auc", "params")


@query(
    "mod12_best_so_far",
    """select cast(l_linenumber as integer) as trial, avg(l_extendedprice) as auc, max(avg(l_extendedprice)) over (order by l_linenumber) as best
    from lineitem group by l_linenumber""",
    {"auc best": 4},
)
def _(v):
    trials = v.table("lineitem").groupBy(F.col("l_linenumber").alias("trial")).agg(F.avg("l_extendedprice").alias("auc"))
    return MD.best_so_far(trials)


@query(
    "win04_running_max",
    """select hour, high_risk_pct, max(high_risk_pct) over (order by hour) as best from px_hourly""",
    {"high_risk_pct best": 7},
)
def _(v):
    from provisio.operators.timeseries import intraday_hourly
    hourly = intraday_hourly(v.scored).select("hour", "high_risk_pct")
    return MD.best_so_far(hourly, "hour", "high_risk_pct")


@query("xpl01_model_importance")
def _(v):
    model, _rows = _whole(v, lambda: MD.gbt(trees=8, depth=3, step=0.2, early_stop=False))
    return E.model_importance(v.spark, model, X)


@query("xpl01_permutation_importance")
def _(v):
    model, df = _whole(v, MD.logistic)
    return E.permutation_importance(df, model, X)


_MEANS = ", ".join(f"avg({c}) as m_{c}" for c in FEATURES)
BETAS = {"inst_late_ratio": 1.5, "amt_income_total": -2e-6, "days_birth": 3e-5, "credit_term": 0.01}
_PARTS = " union all ".join(
    f"select sk_id_curr, {i} as i, '{f}' as feature, {b!r}::double * ({f} - m_{f}) as contribution from l, m" for i, (f, b) in enumerate(BETAS.items())
)
_L = "l as (select sk_id_curr, target, " + ", ".join(f"coalesce(cast({c} as double), 36e0) as {c}" for c in FEATURES) + " from px_scored)"


def _means(df):
    row = df.agg(*[F.avg(c).alias(c) for c in BETAS]).first()
    return row.asDict()


@query(
    "xpl02_contributions",
    f"""with {_L}, m as (select {_MEANS} from l)
    select sk_id_curr, cast(position as integer) as position, feature, contribution from (
     select *, row_number() over (partition by sk_id_curr order by abs(contribution) desc, i) as position from ({_PARTS})) where position <= 2""",
    {"contribution": 7},
)
def _(v):
    df = loans(v)
    return E.contributions(df, BETAS, _means(df), 2)


@query(
    "xpl02_mean_contributions",
    f"with {_L}, m as (select {_MEANS} from l) select feature, avg(abs(contribution)) as importance from ({_PARTS}) group by feature",
    {"importance": 8},
)
def _(v):
    df = loans(v)
    return E.mean_contributions(df, BETAS, _means(df))


PARTS["px_linear_rows"] = f"with {_L} select *, row_number() over (order by md5('1:' || cast(sk_id_curr as varchar)), sk_id_curr) as i, row_number() over (order by md5('2:' || cast(sk_id_curr as varchar)), sk_id_curr) as j from l"
PARTS["px_linear_pairs"] = "select a.*, " + ", ".join(f"b.{f} as o_{f}" for f in BETAS) + " from px_linear_rows a join px_linear_rows b on a.i = b.j"


def _linear_sql(moved: str | None) -> str:
    """The linear score with one feature taken from the partner row."""
    return " + ".join(f"{b!r}::double * {'o_' if f == moved else ''}{f}" for f, b in BETAS.items())


@query(
    "xpl01_permutation_linear",
    " union all ".join(
        f"select '{f}' as feature, (select auc from ({auc_sql(_linear_sql(None), 'px_linear_pairs')})) - (select auc from ({auc_sql(_linear_sql(f), 'px_linear_pairs')})) as auc_drop"
        for f in BETAS),
    {"auc_drop": 9},
)
def _(v):
    def scorer(rows):
        return rows.withColumn("_p", reduce(lambda a, b: a + b, [F.lit(b) * F.col(f) for f, b in BETAS.items()]))

    return E.permutation_importance(loans(v), scorer, list(BETAS))


@query("xpl03_partial_dependence")
def _(v):
    model, df = _whole(v, MD.logistic)
    return reduce(DataFrame.unionByName, [E.partial_dependence(df, model, X, f) for f in X])


@query("mod10_oof_leaderboard")
def _(v):
    df = _folded(v, 2)
    scored = MD.oof_predict(df, MD.logistic, X, 2, "p_logistic")
    scored = MD.oof_predict(scored, _small_gbt, X, 2, "p_gbt")
    return M.leaderboard(scored, {"logistic": "p_logistic", "gbt": "p_gbt"})


@query("sco04_ensemble_score")
def _(v):
    from provisio.operators import scoring as S
    df = _folded(v, 2)
    models = MD.fit_folds(df, MD.logistic, X, 2)
    calibrator = MD.fit_isotonic(MD.oof_scores(df, models, X))
    return S.score(df, models, X, calibrator).select("sk_id_curr", "pd_raw", "pd_calibrated")
