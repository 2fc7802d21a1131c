"""Isotonic fit in ranges, correlation of any width, encoding without a limit, stored state, gate, grouped metrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from provisio.functions import ranking as R
from provisio.operators import bands as B
from provisio.operators import calibration as K
from provisio.operators import cleaning as C
from provisio.operators import explain as E
from provisio.operators import features as X
from provisio.operators import joins as J
from provisio.operators import metrics as M
from provisio.operators import models as MD
from provisio.operators import woe as W
from provisio.sources import state as ST


def brute_isotonic(x, total, weight):
    order = np.argsort(x)
    x, t, w = x[order], np.cumsum(np.append(0, total[order])), np.cumsum(np.append(0, weight[order]))
    n = len(x)
    return x, np.array([max(min((t[b + 1] - t[a]) / (w[b + 1] - w[a]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


@pytest.mark.parametrize("most, shape", [(200_000, "noise"), (7, "noise"), (5, "falling"), (6, "rising"), (9, "saw")])
def test_isotonic_in_ranges_equals_brute_force(spark, most, shape):
    rng = np.random.default_rng(4)
    x = np.sort(rng.random(90))
    rate = {"noise": rng.random(90), "falling": 1 - x, "rising": x, "saw": (np.arange(90) % 10) / 20 + x / 2}[shape]
    weight = rng.integers(1, 9, 90).astype(float)
    points = spark.createDataFrame([(float(a), float(r * w), float(w)) for a, r, w in zip(x, rate, weight)], "score double, total double, weight double")
    model = K.fit_points(points.repartition(4), max_points=most)
    xs, want = brute_isotonic(x, rate * weight, weight)
    probes = np.concatenate([xs, (xs[1:] + xs[:-1]) / 2, [-1.0, 2.0]])
    got = K.apply(spark.createDataFrame([(float(p),) for p in probes] + [(None,)], "pred_prob double"), model)
    values = {r["pred_prob"]: r["pd_calibrated"] for r in got.collect()}
    np.testing.assert_allclose([values[p] for p in probes], np.interp(probes, xs, want), rtol=1e-9, atol=1e-12)
    assert values[None] is None and got.count() == len(probes) + 1


def test_cross_calibration_leaves_the_own_fold_out(spark, scored):
    folded = MD.assign_folds(scored.filter("pred_prob is not null"), 3).cache()
    got = {r["sk_id_curr"]: r["pd_calibrated"] for r in MD.cross_calibrate(folded, 3).collect()}
    assert len(got) == folded.count()
    for i in range(3):
        one = MD.apply_isotonic(folded.filter(F.col("fold") == i), MD.fit_isotonic(folded.filter(F.col("fold") != i)))
        assert all(abs(got[r["sk_id_curr"]] - r["pd_calibrated"]) < 1e-12 for r in one.collect())


@pytest.mark.parametrize("width", [3, 40])
def test_correlation_with_gaps_at_any_width(spark, width):
    rng = np.random.default_rng(6)
    data = rng.normal(0, 1, (300, width)) @ rng.normal(0, 1, (width, width)) * 10.0 ** rng.integers(-4, 7, width) + 1e3
    data[:, 1] = 5.0
    data[rng.random(data.shape) < 0.2] = np.nan
    data[:150, 2] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in data]
    names = [f"c{i}" for i in range(width)]
    r = X.correlation_matrix(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5), names)
    for i in range(width):
        for j in range(i):
            both = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
            if 1 in (i, j):
                assert np.isnan(r[i, j]) and np.isnan(r[j, i])
            else:
                assert abs(r[i, j] - np.corrcoef(data[both, i], data[both, j])[0, 1]) < 1e-9 and r[i, j] == pytest.approx(r[j, i])


def test_encoding_has_no_limit(spark):
    df = spark.range(9000).select(
        F.col("id").alias("sk_id_curr"), F.concat(F.lit("v"), F.col("id") % 6000).alias("wide"), F.when(F.col("id") % 10 != 3, F.lit("hot")).alias("most"))
    state = X.fit_encoding(df)
    assert state["sparse"] == ["wide"] and state["binary"] == {"most": ["hot", "nan"]}
    cols = ["wide", "most"]
    index = X.fit_value_index(df.repartition(6), cols)
    want = {p: i for i, p in enumerate(sorted([("most", "hot")] + [("wide", f"v{i}") for i in range(6000)]))}
    assert {(r["feature"], r["value"]): r["position"] for r in index.collect()} == want
    more = df.union(spark.createDataFrame([(-1, "unseen", None)], "a long, b string, c string"))
    rows = {r["sk_id_curr"]: r["positions"] for r in X.sparse_rows(more, index, cols).collect()}
    assert rows[-1] == [] and len(rows) == 9001
    for i in (0, 3, 5999, 6001, 8999):
        assert rows[i] == sorted([want["wide", f"v{i % 6000}"]] + ([want["most", "hot"]] if i % 10 != 3 else []))


def test_state_scores_like_the_fitted_parts(spark, tmp_path):
    df = spark.range(1200).select(
        F.col("id").alias("sk_id_curr"), F.when(F.col("id") % 9 != 1, (F.col("id") * 37) % 101 / 101.0).alias("a"), ((F.col("id") * 53) % 97 / 97.0).alias("b"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("kind"), ((F.col("id") * 7919) % 101 < 20 + (F.col("id") * 37) % 101 / 3).cast("int").alias("target"))
    encoding, medians = X.fit_encoding(df, ["kind"]), X.fit_median(df, ["a"])
    ready = X.apply_median(X.apply_binary(df, encoding), medians)
    bins, weights = W.fit_woe(ready, ["a", "b"])
    woe = MD.assign_folds(W.apply_woe(ready, bins, weights), 2)
    features = ["a_woe", "b_woe", "kind"]
    models = MD.fit_folds(woe, MD.logistic, features, 2)
    calibrator = MD.fit_isotonic(MD.oof_scores(woe, models, features))
    state = ST.FittedState(features, medians, {}, encoding, bins, [0.1, 0.5], models, weights, X.fit_value_index(df, ["kind"]), calibrator)
    ST.write_state(spark, state, str(tmp_path / "s"))
    again = ST.read_state(spark, str(tmp_path / "s"))
    assert again.bins == bins and again.medians == medians and again.tiers == [0.1, 0.5] and again.index.count() == 2
    direct = {r["sk_id_curr"]: (r["pd_raw"], r["pd_calibrated"]) for r in state.score(df).collect()}
    stored = {r["sk_id_curr"]: (r["pd_raw"], r["pd_calibrated"]) for r in again.score(df).collect()}
    assert direct == stored and len(stored) == 1200 and len(set(stored.values())) > 20


def test_gate_counts_what_is_written(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a"), (2, 3.0, None), (3, None, "c")], "k int, x double, t string")
    path, whole = str(tmp_path / "t"), str(tmp_path / "u")
    df.repartition(2).write.parquet(path)
    assert C.written_gaps(spark, path) == (3, {"k": 0, "x": 2, "t": 1})
    with pytest.raises(ValueError, match="missing values left"):
        C.require_written(spark, path)
    C.fill_gaps(df, ["x", "t"]).write.parquet(whole)
    assert C.require_written(spark, whole) == 3 and C.require_written(spark, path, ["k"]) == 3
    for key in C.FOOTERS:  # the settings are as before
        assert spark.conf.get(key, None) != C.FOOTERS[key]


def test_gate_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("x", F.when(F.col("id") % 4 > 0, F.col("id"))).write.parquet(path)
    for key, value in C.FOOTERS.items():
        spark.conf.set(key, value)
    try:
        plan = spark.read.parquet(path).agg(F.count(F.lit(1)), F.count("x"))._jdf.queryExecution().toString()
    finally:
        for key in C.FOOTERS:
            spark.conf.unset(key)
    assert "PushedAggregation: [COUNT(*), COUNT(x)]" in plan


def test_cleaning_fills_flags(spark):
    df = spark.createDataFrame([(i, 0, None if i == 3 else i % 2, "F", 5.0 + i, 1) for i in range(9)],
                               "sk_id_curr int, target int, flag_document_2 int, code_gender string, amt_income_total double, days_employed int")
    out = C.clean_application(df, C.fit_application(df))
    assert C.incomplete_columns(out) == {}


def test_metrics_by_group_equal_those_of_each_group(scored):
    df = scored.withColumn("fold", F.col("sk_id_curr") % 4)
    got = {r["fold"]: r["auc"] for r in M.fold_auc(df, 4).collect()}
    for i in range(4):
        assert got[i] == pytest.approx(M.auc(df.filter(F.col("fold") == i)).first()[0], abs=1e-12)
    base, other = df.filter("fold < 2"), df.filter("fold >= 2").withColumn("amt_credit", F.col("amt_credit") * 2)
    found = {r["feature"]: (r["psi"], r["alert"]) for r in M.csi(base, other, ["pred_prob", "amt_credit"]).collect()}
    for c, (value, alert) in found.items():
        one = M.psi(base, other, c).first()
        assert value == pytest.approx(one["psi"], abs=1e-12) and alert == one["alert"]


def test_one_permutation_serves_all_features(spark):
    df = spark.range(800).select(F.col("id").alias("sk_id_curr"), *[((F.col("id") * k) % 101 / 101.0).alias(c) for k, c in ((37, "a"), (53, "b"), (71, "c"))])
    df = df.withColumn("target", (F.col("a") > 0.6).cast("int"))
    partner = E.with_partner(df, ["a", "b", "c"])
    assert partner.count() == 800 and partner.select("_partner.a").exceptAll(df.select("a")).count() == 0
    assert partner.filter("a = _partner.a and b = _partner.b and c = _partner.c").count() < 60
    model = MD.fit_folds(MD.assign_folds(df, 2), lambda: MD.logistic(reg=0.01), ["a", "b", "c"], 2)[0]
    rows = {r["feature"]: r["auc_drop"] for r in E.permutation_importance(df, model, ["a", "b", "c"]).collect()}
    moved = partner.withColumn("a", F.col("_partner.a")).select(*df.columns)
    score = lambda d: M.auc(MD.score_with(model, MD.assemble(d, ["a", "b", "c"]), "p"), p="p").first()[0]
    assert rows["a"] == pytest.approx(score(df) - score(moved), abs=1e-12) and rows["a"] > 0.3 > abs(rows["b"])


def test_bands_prefer_the_ratios_of_the_table(spark):
    df = spark.createDataFrame([(100.0, 10.0, 50.0, 0.3, 700)], "amt_credit double, amt_annuity double, amt_income_total double, pred_prob double, days_id_publish int")
    plain = B.with_bands(df).first()
    assert (plain["lti_bin"], plain["dti_bin"], plain["term_bin"], plain["credit_term"]) == ("1–2×", "10–20%", "≤18m", 10.0)
    given = B.with_bands(df.withColumn("credit_income_ratio", F.lit(4.0)).withColumn("annuity_income_ratio", F.lit(0.4)).withColumn("credit_term", F.lit(33.0))).first()
    assert (given["lti_bin"], given["dti_bin"], given["credit_term"]) == ("3–5×", "30–50%", 33.0)
    unknown = B.with_bands(df.withColumn("amt_annuity", F.lit(None).cast("double"))).first()
    assert unknown["credit_term"] in (24.0, 60.0)


def test_salts_follow_the_counts(spark):
    """A key with a third of the rows, missing keys, keys without an entry; a hundred times the rows give the same join."""
    base = spark.range(60).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 7).alias("k"))
    many = base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(99))))
    table = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k long, v string")
    for df, limit in ((base, 4), (many, 150), (many, 10**6)):
        got = J.salted_left_join(df, table, "k", rows=limit)
        want = df.join(table, "k", "left").select(*df.columns, "v")
        assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_hash_ranges_grow_with_the_rows(spark, monkeypatch):
    assert [R.hash_digits(n) for n in (0, 10**6, 16 * 10**6, 16 * 10**6 + 1, 10**12)] == [1, 1, 1, 2, 5]
    df = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"))
    few = {(r["k"], r["rank"]) for r in R.ranked_by_hash(df, "k", 7, within="y").collect()}
    monkeypatch.setattr(R, "HASH_ROWS", 3)
    assert few == {(r["k"], r["rank"]) for r in R.ranked_by_hash(df, "k", 7, within="y").collect()}
