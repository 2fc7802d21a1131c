import pytest
from pyspark.sql import functions as F

from provisio.operators import explain as E
from provisio.operators import metrics as M
from provisio.operators import models as MD
from provisio.operators import scoring as S


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(900).select(
        F.col("id").alias("sk_id_curr"), ((F.col("id") * 37) % 101 / 101.0).alias("a"), ((F.col("id") * 53) % 97 / 97.0).alias("b"),
    ).withColumn("target", F.when(F.col("a") + 0.3 * F.sin(F.col("sk_id_curr") * 1.7) > 0.75, 1).otherwise(0))
    df = MD.with_weight(MD.assign_folds(df, 3)).cache()
    yield df
    df.unpersist()


def test_folds_are_stratified(data):
    for y in (0, 1):
        sizes = [r["count"] for r in data.filter(F.col("target") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_balanced_weights(data):
    sums = {r["target"]: r["s"] for r in data.groupBy("target").agg(F.sum("weight").alias("s")).collect()}
    assert abs(sums[0] - 450) < 1e-6 and abs(sums[1] - 450) < 1e-6


@pytest.mark.parametrize("factory", [lambda: MD.gbt(trees=10, depth=3, step=0.3), lambda: MD.random_forest(20, 4, 5), MD.logistic])
def test_out_of_fold_scores_cover_each_row_once(data, factory):
    scored = MD.oof_predict(data, factory, ["a", "b"], 3)
    assert scored.count() == 900 and scored.select("sk_id_curr").distinct().count() == 900
    assert scored.filter("pred_prob is null or pred_prob < 0 or pred_prob > 1").count() == 0
    assert M.auc(scored).first()[0] > 0.8


def test_ensemble_is_the_mean(data):
    models = MD.fit_folds(data, MD.logistic, ["a", "b"], 3)
    out = MD.ensemble_predict(data, models, ["a", "b"])
    parts = [MD.score_with(m, MD.assemble(data, ["a", "b"]), "p").select("sk_id_curr", "p") for m in models]
    mean = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("sk_id_curr").agg(F.avg("p").alias("mean"))
    assert out.join(mean, "sk_id_curr").filter("abs(pred_prob - mean) > 1e-12").count() == 0


def test_isotonic_is_monotone_and_clamped(spark, scored):
    model = MD.fit_isotonic(scored)
    out = MD.apply_isotonic(scored, model).orderBy("pred_prob").select("pred_prob", "pd_calibrated").collect()
    values = [r["pd_calibrated"] for r in out]
    assert values == sorted(values) and 0 <= values[0] and values[-1] <= 1
    outside = MD.apply_isotonic(spark.createDataFrame([(-1.0,), (2.0,)], "pred_prob double"), model).collect()
    assert (outside[0]["pd_calibrated"], outside[1]["pd_calibrated"]) == (values[0], values[-1])


def test_isotonic_on_counts_equals_isotonic_on_rows(scored):
    from pyspark.ml.regression import IsotonicRegression
    rows = scored.select("pred_prob", F.col("target").cast("double").alias("y"))
    direct = IsotonicRegression(featuresCol="pred_prob", labelCol="y").fit(rows)
    ours = MD.apply_isotonic(scored, MD.fit_isotonic(scored))
    both = direct.transform(ours)
    assert both.filter("abs(prediction - pd_calibrated) > 1e-9").count() == 0


def test_calibration_lowers_brier(scored):
    folded = MD.assign_folds(scored, 4)
    out = MD.cross_calibrate(folded, 4)
    assert out.count() == scored.count()
    assert M.brier(out, p="pd_calibrated").first()[0] < M.brier(out).first()[0]


def test_search_is_reproducible_and_in_range():
    draws = MD.sample_candidates(MD.SEARCH_SPACE, 50, seed=5)
    assert draws == MD.sample_candidates(MD.SEARCH_SPACE, 50, seed=5)
    assert all(200 <= d["trees"] <= 2000 and d["trees"] % 100 == 0 for d in draws)
    assert all(0.005 <= d["step"] <= 0.15 and 3 <= d["depth"] <= 10 for d in draws)


def test_permuted_column_keeps_its_values(data):
    out = E.shuffle_column(data, "a")
    assert out.select("a").exceptAll(data.select("a")).count() == 0
    assert out.select("sk_id_curr", "b").exceptAll(data.select("sk_id_curr", "b")).count() == 0
    assert out.join(data.select("sk_id_curr", F.col("a").alias("a0")), "sk_id_curr").filter("a = a0").count() < 100


def test_permutation_importance_ranks_the_signal(data):
    model = MD.fit_folds(data, MD.logistic, ["a", "b"], 1 + 1)[0]
    rows = E.permutation_importance(data, model, ["a", "b"]).collect()
    assert rows[0]["feature"] == "a" and rows[0]["auc_drop"] > 0.2 > rows[1]["auc_drop"]


def test_partial_dependence_rises_with_the_signal(data):
    model = MD.fit_folds(data, MD.logistic, ["a", "b"], 2)[0]
    rows = E.partial_dependence(data, model, ["a", "b"], "a", n=10, rows=100).orderBy("grid_value").collect()
    means = [r["mean_score"] for r in rows]
    assert len(rows) == 10 and means == sorted(means)


def test_tier_edges(spark):
    values = [0.0, 0.27892775991838853, 0.28, 1.0, 1.2, -0.1]
    df = spark.createDataFrame([(v,) for v in values], "p double").select(S.assign_tier("p"))
    assert [r[0] for r in df.collect()] == ["Very Low", "Very Low", "Low", "High", "High", "High"]


def test_risk_factors_skip_zero_medians_and_keep_order(spark):
    medians = {"z": 0.0, "a": 2.0, "b": -2.0, "c": 4.0, "d": 1.0}
    df = spark.createDataFrame([(9.0, 4.0, -4.0, 4.0, 3.0)], "z double, a double, b double, c double, d double")
    assert df.select(S.top_risk_factors(medians)).first()[0] == ["d", "a", "b"]


def test_bad_rows_do_not_stop_the_others(spark):
    df = spark.createDataFrame([(1, 0.5, 100.0), (2, 1.5, 100.0), (3, None, -1.0)], "sk_id_curr int, ext_source_2 double, amt_credit double")
    def scorer(rows):
        return rows.withColumn("pd_raw", F.col("ext_source_2")).withColumn("pd_calibrated", F.col("ext_source_2"))
    out = {r["sk_id_curr"]: r for r in S.score_batch(df, {"ext_source_2": 0.4, "amt_credit": 50.0}, scorer).collect()}
    assert out[1]["risk_tier"] == "Medium" and out[1]["ecl_estimate"] == 32.5
    assert out[2]["risk_tier"] == out[3]["risk_tier"] == "Unknown"
    assert out[3]["recommendation"] == "ERROR: amt_credit"
