import math

import pytest
from pyspark.sql import functions as F

from provisio.operators import credit_loss as C
from provisio.operators import timeseries as T


def test_stage_bounds_are_strict(spark):
    rows = [(0.70, 0), (0.7001, 0), (0.20, 0), (0.2001, 0), (0.01, 1), (None, 0)]
    df = spark.createDataFrame(rows, "pred_prob double, bureau_bad_debt_flag int")
    assert [r["stage"] for r in C.classify_stage(df).collect()] == [2, 3, 1, 2, 3, 1]


def test_stage_signals_default_to_harmless(spark):
    df = spark.createDataFrame([(0.1, 0.31, None), (0.1, None, 0.51), (0.1, 0.30, 0.50)],
                               "pred_prob double, inst_late_ratio double, prev_refused_ratio double")
    assert [r["stage"] for r in C.classify_stage(df).collect()] == [2, 2, 1]


def test_pd_term_limits(spark):
    df = spark.createDataFrame([(0.0, None), (1.0, 3.0), (0.1, 200.0)], "pred_prob double, credit_term double")
    rows = C.pd_term(df).collect()
    assert [r["pd_12m"] for r in rows] == [0.001, 0.999, 0.1]
    assert [r["loan_term_yrs"] for r in rows] == [3.0, 0.5, 10.0]
    assert all(r["pd_12m"] <= r["pd_lifetime"] <= 0.999 for r in rows)
    assert math.isclose(rows[2]["pd_lifetime"], 1 - 0.9 ** 10)


def test_lgd_by_product_and_collateral(spark):
    rows = [("Cash loans", 5.0), ("Cash loans", None), ("Revolving loans", 0.0), ("Consumer loans", 1.0), (None, None)]
    df = spark.createDataFrame(rows, "name_contract_type string, amt_down_payment double")
    assert [r["lgd"] for r in C.lgd(df).collect()] == [0.55, 0.75, 0.65, 0.35, 0.50]
    assert C.lgd(spark.range(1)).first()["lgd"] == 0.65
    assert C.lgd(df, C.DOCUMENTED_RATES).collect()[2]["lgd"] == 0.85


def test_ead_fills_the_median_and_scales_revolving(spark):
    df = spark.createDataFrame([(100.0, "Cash loans"), (300.0, "Revolving loans"), (None, "Cash loans")], "amt_credit double, name_contract_type string")
    assert [r["ead"] for r in C.ead(df).collect()] == [100.0, 360.0, 200.0]
    assert C.ead(spark.range(1)).first()["ead"] == 500_000.0


def test_scenario_weights_must_sum_to_one():
    with pytest.raises(ValueError, match="weights"):
        C.Scenarios((C.Scenario("a", 0.5, 1.0),))


def portfolio(spark, n=2000):
    df = spark.range(n).select(
        F.col("id").alias("sk_id_curr"), ((F.col("id") * 37) % 1000 / 1000.0).alias("pred_prob"),
        F.lit("Cash loans").alias("name_contract_type"), (F.col("id") + 1000.0).alias("amt_credit"),
        ((F.col("id") % 100) + 3.0).alias("credit_term"), F.lit(0.0).alias("amt_down_payment"),
    )
    return C.provision(df)


def test_provision_identities(spark):
    loans = portfolio(spark).cache()
    bad = loans.filter("stage = 3 and abs(ecl - lgd * ead) > 1e-6").count()
    assert bad == 0 and loans.filter("ecl > lgd * ead + 1e-6").count() == 0
    totals = [r["total_ecl"] for r in C.scenario_ecl(loans).collect()]
    assert totals == sorted(totals)
    weighted = sum(r["total_ecl"] * r["weight"] for r in C.scenario_ecl(loans).collect())
    total = C.portfolio_totals(loans).first()["ecl"]
    assert math.isclose(weighted, total, rel_tol=1e-9)
    assert sum(r["loan_count"] for r in C.stage_summary(loans).collect()) == 2000


def test_provision_is_projection_only(spark):
    df = spark.range(10).select(
        F.col("id").alias("sk_id_curr"), F.lit(0.1).alias("pred_prob"), F.lit("Cash loans").alias("name_contract_type"),
        F.lit(5.0).alias("amt_credit"),
    )
    plan = C.provision(df, median=5.0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_migration_without_stage_three(spark):
    df = spark.createDataFrame([(0.05, 10.0), (0.19, 20.0)], "pred_prob double, ead double")
    cells = T.migration_long(df, 1.25)
    assert cells.count() == 9
    pct = {(r["stage_t"], r["stage_t1"]): r["pct"] for r in T.migration_pct_long(cells).collect()}
    assert pct[(3, 1)] is None and math.isclose(pct[(1, 1)] + pct[(1, 2)] + pct[(1, 3)], 100.0)
    assert math.isclose(pct[(1, 2)], 100 * 20 / 30)


@pytest.mark.parametrize("months,rows", [(3, 12), (12, 48), (24, 48)])
def test_projection_length(spark, months, rows):
    df = spark.createDataFrame([(1e9, 2e9)], "ecl double, ead double")
    out = T.ecl_projection(df, months)
    assert out.count() == rows
    first = out.filter("scenario = 'Severe' and month = 1").first()
    assert first["ecl_b"] == round(1.10 * 0.98, 3)


def test_age_of_eighteen_has_no_band(spark):
    df = spark.createDataFrame([(1, -18 * 365, 0, 0.1, 1.0, 1.0, 1), (2, -30 * 365, -400, 0.1, 1.0, 1.0, 0)],
                               "sk_id_curr int, days_birth int, days_employed int, pred_prob double, ead double, ecl double, target int")
    bands = {r["age_band"]: r["tenure_band"] for r in T.cohort_default(df).collect()}
    assert bands == {"nan": "<1yr", "26-35": "1-3yr"}
