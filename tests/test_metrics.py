import math

import pytest
from pyspark.sql import functions as F

from provisio.operators import metrics as M
from provisio.operators import monitoring as D
from provisio.operators import roi as R


def scores(spark, pairs):
    return spark.createDataFrame(pairs, "pred_prob double, target int")


def brute_auc(pairs):
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_extremes(spark):
    assert M.auc(scores(spark, [(0.5, 1), (0.5, 0), (0.5, 0)])).first()[0] == 0.5
    assert M.auc(scores(spark, [(0.9, 1), (0.1, 0), (0.2, 0)])).first()[0] == 1.0
    assert M.auc(scores(spark, [(0.1, 1), (0.9, 0), (0.2, 0)])).first()[0] == 0.0
    assert M.auc(scores(spark, [(0.1, 1), (0.9, 1)])).first()[0] is None


def test_auc_matches_all_pairs_and_reverses(spark, scored):
    small = scored.filter("sk_id_curr < 400")
    pairs = [(r["pred_prob"], r["target"]) for r in small.collect()]
    value = M.auc(small).first()[0]
    assert math.isclose(value, brute_auc(pairs), rel_tol=1e-12)
    reverse = M.auc(small.withColumn("pred_prob", 1 - F.col("pred_prob"))).first()[0]
    assert math.isclose(value + reverse, 1.0, rel_tol=1e-9)


def test_leaderboard_agrees_with_single_metrics(scored):
    df = scored.withColumn("worse", 1 - F.col("pred_prob"))
    for limit in (None, 30):
        board = {r["model"]: r for r in M.leaderboard(df, {"a": "pred_prob", "b": "worse"}, max_distinct=limit).collect()}
        assert board["a"]["oof_auc"] == round(M.auc(df).first()[0], 4)
        assert board["a"]["ks_pct"] == round(M.ks(df).first()[0] * 100, 2)
        assert board["a"]["brier"] == round(M.brier(df).first()[0], 5)
        assert abs(board["a"]["gini"] - (2 * board["a"]["oof_auc"] - 1)) <= 2e-4
        assert M.best_model(M.leaderboard(df, {"a": "pred_prob", "b": "worse"})).first()["model"] == "a"


def test_confusion_sums_to_all_rows(scored):
    row = M.confusion(scored, 0.3).first()
    assert sum(row) == scored.count()


def test_sweep_equals_direct_counts(scored):
    grid = R.threshold_grid()
    sweep = R.threshold_sweep(scored).collect()
    assert len(sweep) == 100 and [r["threshold"] for r in sorted(sweep, key=lambda r: r["threshold"])] == grid
    for r in sweep[::17]:
        direct = M.confusion(scored, r["threshold"]).first()
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == tuple(direct)


def test_published_sweep_rows(spark):
    """Published counts give the published profit for the published mean amount."""
    rows = [
        (0.01, 24648, 258462, 177, 24224, -1912.6552735523223, 0.07935000699161981),
        (0.06939393939393938, 19097, 96533, 5728, 186153, 575.3033720653567, 0.6239809307634524),
        (0.99, 7, 0, 24818, 282686, -4104.944270131263, 0.9999772365866587),
    ]
    df = spark.createDataFrame(rows, "threshold double, tp long, fp long, fn long, tn long, profit double, approval double")
    out = R.profit_columns(df, F.lit(599025.9997057016))
    for r in out.collect():
        assert math.isclose(r["net_profit_m"], r["profit"], rel_tol=1e-9)
        assert math.isclose(r["approval_rate"], r["approval"], rel_tol=1e-12)
    assert R.best_threshold(out).first()["threshold"] == 0.06939393939393938


def test_credit_band_with_few_scores(spark):
    same = scores(spark, [(0.4, 0)] * 5)
    assert {r[0] for r in R.credit_band(same, R.fit_credit_band(same)).select("credit_band").collect()} == {"Very Low Risk"}
    three = scores(spark, [(0.1, 0), (0.5, 0), (0.9, 0)])
    bands = [r[0] for r in R.credit_band(three, R.fit_credit_band(three)).orderBy("pred_prob").select("credit_band").collect()]
    assert bands[0] == "Very Low Risk" and None not in bands


def test_psi_of_equal_samples_is_zero(scored):
    assert abs(M.psi(scored, scored, "pred_prob").first()["psi"]) < 1e-12
    shifted = scored.withColumn("pred_prob", F.col("pred_prob") * 0.3)
    row = M.psi(scored, shifted, "pred_prob").first()
    assert row["psi"] > 0.25 and row["alert"] == "shift"


def test_ks_threshold_matches_roc(scored):
    points = [(r["tpr"] - r["fpr"], -r["threshold"]) for r in M.roc_points(scored).collect()]
    row = D.ks_threshold(scored).first()
    assert (row["gap"], -row["threshold"]) == max(points)


@pytest.mark.parametrize("value,expected", [(0.05, 0), (0.2, 1)])
def test_alerts(spark, value, expected):
    metrics = spark.createDataFrame([("psi", value)], "metric string, value double")
    row = D.alerts(metrics).filter("rule = 'psi_watch'").first()
    assert row["alert"] == expected
