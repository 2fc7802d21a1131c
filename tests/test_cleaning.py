import pytest
from pyspark.sql import functions as F

from provisio.operators import audit as A
from provisio.operators import cleaning as C
from provisio.operators import history as H
from provisio.operators import joins as J


def col(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_zero_as_missing_uses_the_other_values(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 2.0), (2, 4.0), (3, None)], "i int, x double")
    assert col(C.zero_as_missing(df, "x"), "x") == [3.0, 2.0, 4.0, 3.0]


def test_median_of_even_count(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate([1, 2, 4, 9, None])], "i int, x int")
    assert C.fit_medians(df, ["x"]) == {"x": 3.0}
    assert col(C.impute_median(df, ["x"]), "x") == [1.0, 2.0, 4.0, 9.0, 3.0]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(["b", "a", "a", "b", None])], "i int, x string")
    assert C.fit_modes(df) == {"x": "a"}


def test_utilization(spark):
    df = spark.createDataFrame([(0, 7.0, 0), (1, 5.0, 2), (2, -1.0, 2), (3, None, 2)], "i int, amt_balance double, amt_credit_limit_actual int")
    assert col(df.withColumn("u", C.utilization()), "u") == [0.0, 2.0, -0.5, 0.0]


def test_days_past_due(spark):
    df = spark.createDataFrame([(0, -5.0, -3.0), (1, -3.0, -3.0), (2, 4.0, -3.0), (3, None, -3.0)], "i int, days_entry_payment double, days_instalment double")
    assert col(df.withColumn("d", C.days_past_due()), "d") == [0.0, 0.0, 7.0, None]


def test_sparse_drop_bounds(spark):
    df = spark.range(100).select(
        F.when(F.col("id") >= 41, 1).alias("a"), F.when(F.col("id") >= 40, 1).alias("b"),
        F.when(F.col("id") >= 60, 1).alias("ext_source_1"),
    )
    assert C.fit_sparse_columns(df) == ["a"]


def test_cap_quantile_and_sentinel(spark):
    df = spark.range(1, 102).select(F.col("id").alias("i"), F.col("id").cast("double").alias("x"))
    assert max(col(C.cap_quantile(df, "x", 0.99), "x")) == 100.0
    out = C.null_sentinel(spark.createDataFrame([(0, 365243), (1, -5), (2, None)], "i int, d int"), "d", indicator="f")
    assert col(out, "d") == [None, -5, None] and col(out, "f") == [1, 0, 0]


def test_require_complete(spark):
    df = spark.createDataFrame([(0, 1.0, "a"), (1, None, None), (2, 3.0, "a")], "i int, x double, s string")
    out = C.require_complete(df)
    assert col(out, "x") == [1.0, 2.0, 3.0] and col(out, "s") == ["a", "a", "a"]
    with pytest.raises(ValueError, match="missing values left"):
        C.require_complete(df.withColumn("x", F.lit(None).cast("double")))


def test_state_depends_on_train_only(spark):
    from provisio.plans.proxy import Views
    v = Views(spark, "/root/testdata/sf0.001")
    train, test = v.application.filter("is_train = 1"), v.application.filter("is_train = 0")
    before = C.fit_application(train)
    changed = train.unionByName(test.withColumn("amt_income_total", F.lit(1e9)))
    assert C.fit_application(changed.filter("is_train = 1")) == before
    cleaned = C.clean_application(v.application, before).drop("target")
    assert C.incomplete_columns(cleaned) == {}


def test_salted_join_equals_plain_join(spark):
    rows = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    table = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", 99)], "k string, v long")
    )
    plain = rows.join(table, "k", "left")
    salted = J.salted_left_join(rows, table, "k", rows=5)
    assert salted.count() == 3000
    assert plain.select("id", "k", "v").exceptAll(salted.select("id", "k", "v")).count() == 0


def test_join_checks(spark):
    with pytest.raises(ValueError, match="not unique"):
        J.assert_unique_key(spark.createDataFrame([(1,), (1,), (2,)], "sk_id_curr int"))
    child = spark.createDataFrame([(1,), (1,), (9,), (9,)], "sk_id_curr int")
    parent = spark.createDataFrame([(1,)], "sk_id_curr int")
    assert [tuple(r) for r in J.orphans(child, parent).collect()] == [(9, 2)]
    cover = A.key_coverage(child, parent, "sk_id_curr").first()
    assert (cover["child_keys"], cover["parent_keys"], cover["shared_keys"], cover["ratio"]) == (2, 1, 1, 2.0)


def test_history_of_a_client_without_values(spark):
    pos = spark.createDataFrame(
        [(1, 5, -1, None, "Active", 0, 0), (1, 5, -2, None, "Completed", 3, 0)],
        "sk_id_prev int, sk_id_curr int, months_balance int, cnt_instalment double, name_contract_status string, sk_dpd int, sk_dpd_def int",
    )
    row = H.pos_features(pos).first()
    assert row["pos_cnt_instalment_mean"] is None and row["pos_late_count"] == 1 and row["pos_months_count"] == 2
    assert abs(row["pos_late_ratio"] - 0.5) < 1e-6


def test_hot_client_is_reduced_before_the_shuffle(spark):
    """A client with a third of all rows is merged map-side: the plan aggregates on both sides."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("sk_id_curr"), F.col("id").alias("sk_id_prev"),
        F.lit("Active").alias("name_contract_status"), F.lit(-1).alias("months_balance"),
        F.lit(1.0).alias("cnt_instalment"), F.lit(0).alias("sk_dpd"), F.lit(0).alias("sk_dpd_def"),
    )
    out = H.pos_features(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "partial_count" in plan
    assert out.filter("sk_id_curr = -7").first()["pos_months_count"] == 3000
