import math

import pytest
from pyspark.sql import functions as F

from provisio.operators import features as X
from provisio.operators import woe as W


def labelled(spark, n=3000):
    return spark.range(n).select(
        F.col("id").alias("sk_id_curr"), F.when((F.col("id") * 7919) % 100 < 20 + (F.col("id") % 10) * 4, 1).otherwise(0).alias("target"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 10).cast("double") + (F.col("id") % 97) / 100.0).alias("x"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 5)).alias("s"),
    )


def test_weights_are_finite_with_empty_cells(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), (None, 1)], "s string, target int")
    bins = W.fit_bins(df, ["s"])
    assert W.totals(df) == (2, 2)
    rows = {r["bin"]: r for r in W.woe_table(W.bin_table(df, bins), W.totals(df)).collect()}
    assert rows["a"]["events"] == 0 and all(math.isfinite(r["woe"]) for r in rows.values())
    assert math.isclose(rows["b"]["pct_ev"], 1.5 / 2.5)


def test_degenerate_target_has_no_information(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "s string, target int")
    row = W.iv_screen(df, ["s"]).first()
    assert (row["iv"], row["flag"], row["keep"]) == (0.0, "Useless", False)


def test_strength_bounds(spark):
    values = [0.02, 0.0201, 0.10, 0.30, 0.50, 0.5001]
    df = spark.createDataFrame([(v,) for v in values], "iv double").select(W.iv_flag(F.col("iv")))
    assert [r[0] for r in df.collect()] == ["Useless", "Weak", "Weak", "Medium", "Strong", "Suspicious"]


@pytest.mark.parametrize("literal", [1000, 0])
def test_apply_with_literals_and_with_joins(spark, monkeypatch, literal):
    monkeypatch.setattr(W, "LITERAL_BINS", literal)
    df = labelled(spark)
    bins, weights = W.fit_woe(df, ["x", "s"])
    out = W.apply_woe(df, bins, weights)
    assert out.count() == 3000
    fitted = {(r["feature"], r["bin"]): r["woe"] for r in weights.collect()}
    for r in out.filter("sk_id_curr < 40").collect():
        assert r["s_woe"] == fitted[("s", r["s"])]
        assert (r["x_woe"] == 0.0) == (r["x"] is None)
    unseen = W.apply_woe(spark.createDataFrame([(1, 0, 99.0, "new")], df.schema), bins, weights).first()
    assert unseen["s_woe"] == 0.0 and unseen["x_woe"] == fitted[("x", "009")]


def test_split_maps_hold_all_bins(spark):
    weights = spark.range(500).select(F.lit("f").alias("feature"), F.col("id").cast("string").alias("bin"), F.rand(1).alias("woe"))
    maps = W.weight_maps(weights, size=100)
    assert maps.count() == 5
    assert maps.select(F.explode("weights")).count() == 500


def test_qcut_with_mostly_zeros(spark):
    df = spark.createDataFrame([(0.0 if i < 95 else float(i), i % 2) for i in range(100)], "x double, target int")
    bins = W.fit_bins(df.withColumn("x", F.when(F.col("x") > 0, F.col("x")).otherwise(F.col("x"))), ["x"], n=10)
    table = W.bin_table(df, bins)
    assert table.agg(F.sum("total")).first()[0] == 100


def test_binary_and_onehot_encoding(spark):
    df = spark.createDataFrame([("N", "a"), ("Y", "b"), (None, "c"), ("Y", None)], "flag string, cat string")
    state = X.fit_encoding(df)
    assert state["binary"] == {"flag": ["N", "Y", "nan"]} and state["onehot"] == {"cat": ["a", "b", "c"]}
    assert [r[0] for r in X.apply_binary(df, state).select("flag").collect()] == [0, 1, 2, 1]
    hot = X.apply_onehot(df, state)
    assert hot.columns == ["flag", "cat_a", "cat_b", "cat_c"]
    assert [tuple(r)[1:] for r in hot.collect()][3] == (0.0, 0.0, 0.0)


def test_correlated_columns_depend_on_column_order(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + F.sin("id")).alias("b"), F.cos(F.col("id") * 1.0).alias("c"),
    )
    assert X.fit_correlated(df, ["a", "b", "c"]) == ["b"]
    assert X.fit_correlated(df, ["b", "a", "c"]) == ["a"]


def test_correlation_with_a_constant_is_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert df.agg(X.safe_corr(F.col("a"), F.col("b"))).first()[0] is None


def test_sanitize_and_split(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c-d` int")
    assert X.sanitize_columns(df).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError, match="collide"):
        X.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    train = spark.createDataFrame([(1, 0)], "sk_id_curr int, target int")
    both = X.tag_split(train, train.drop("target"))
    assert sorted((r["is_train"], r["target"]) for r in both.collect() if r["is_train"]) == [(1, 0)]
    with pytest.raises(ValueError, match="unexpected output"):
        X.assert_outputs(both, train_rows=5)
