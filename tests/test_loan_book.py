"""The whole way from the loan tables to decisions, with one small learner."""

import math

from pyspark.sql import functions as F

from provisio.operators import credit_loss as L
from provisio.operators import metrics as M
from provisio.operators import models as MD
from provisio.plans import loan_book as LB
from provisio.plans.catalog.book import tables
from provisio.plans.proxy import Views


def test_tables_to_decisions(spark, tmp_path):
    v, root = Views(spark, "/root/testdata/sf0.001"), str(tmp_path)
    source = tables(v)
    n_train, n_test = source["train"].count(), source["test"].count()
    joined = LB.join_tables(LB.clean_tables(source, root), root)
    assert joined.count() == n_train + n_test

    train, test, names = LB.build_features(joined, root)
    assert (train.count(), test.count()) == (n_train, n_test) and "target" not in test.columns
    gaps = train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    assert not any(gaps) and len(names) > 20

    ranking, train_woe, test_woe = LB.build_scorecard(train, test, names, root)
    kept = [r["feature"] for r in ranking.filter("keep").collect()]
    assert ranking.count() == len(names) and f"{kept[0]}_woe" in test_woe.columns
    assert train_woe.count() == n_train

    scored, board = LB.train_models(train, names[:6], {"logistic": lambda: MD.logistic(0.01, 5), "flat": lambda: MD.logistic(1e6, 2)}, root, k=2)
    assert board.count() == 2 and scored.count() == n_train
    assert scored.filter("pred_prob < 0.001 or pred_prob > 0.999").count() == 0
    best = board.orderBy(F.desc("oof_auc"), "model").first()
    assert abs(M.auc(scored).first()[0] - best["oof_auc"]) < 1e-3

    loans, summary = LB.provision_book(scored, v.application, root)
    assert sum(r["loan_count"] for r in summary.collect()) == n_train
    assert math.isclose(L.portfolio_totals(loans).first()["ecl"], loans.agg(F.sum("ecl")).first()[0])
    sweep, final = LB.decide(loans, root)
    assert sweep.count() == 100 and final.filter("decision_status is null or credit_band is null").count() == 0


def test_fit_on_train_ignores_test_rows(spark, tmp_path):
    v = Views(spark, "/root/testdata/sf0.001")
    joined = LB.join_tables(LB.clean_tables(tables(v), str(tmp_path / "a")), str(tmp_path / "a"))
    moved = joined.withColumn("amt_credit", F.when(F.col("is_train") == 0, 1e12).otherwise(F.col("amt_credit")))
    one, _t, names = LB.build_features(joined, str(tmp_path / "b"))
    two, _t, others = LB.build_features(moved, str(tmp_path / "c"))
    assert names == others and one.exceptAll(two).count() == 0
