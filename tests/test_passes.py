"""Results that must not depend on the number of rows, and inputs that are read once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from provisio.operators import cleaning as C
from provisio.operators import features as X
from provisio.operators import history as H
from provisio.operators import joins as J
from provisio.plans.catalog import QUERIES, book, history, training
from provisio.plans.proxy import Views
from provisio.session import write_once


def test_correlation_over_rows_where_a_column_is_constant_is_missing(spark):
    """Sums of many equal standardised values differ by rounding, which is not a variance."""
    rows = spark.range(0, 100_000, 1, 1).select(
        F.when(F.col("id") % 7 != 6, ((F.col("id") * 7919) % 100 < 8).cast("int")).alias("target"),
        (F.col("id") % 7 != 6).cast("int").alias("is_train"),
        ((F.col("id") * 6151) % 90001).alias("amount"),
    )
    r = X.correlation_matrix(rows, ["target", "is_train", "amount"])
    assert np.isnan(r[0, 1]) and np.isnan(r[1, 0])
    assert abs(r[0, 2]) < 0.1 and abs(r[1, 2]) < 0.1


def test_correlation_of_columns_that_hardly_vary_in_common_rows(spark):
    """Each of the 100 rows with both has values near 1e4, far from the rest of the column."""
    rows = spark.range(0, 5_000, 1, 3).select(
        (F.when(F.col("id") < 100, 1e4 + F.col("id") * 1e-4).otherwise(F.col("id") % 10)).alias("a"),
        F.when(F.col("id") < 100, 3e4 - F.col("id") * 1e-4).alias("b"),
    )
    assert X.correlation_matrix(rows, ["a", "b"])[0, 1] < -0.999999


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    spark.range(40).selectExpr("id as o_orderkey", "id % 9 as o_custkey", "'F' as o_orderstatus", "'5-LOW' as o_orderpriority", "id * 10e0 as o_totalprice").write.parquet(f"{root}/orders.parquet")
    spark.range(120).selectExpr(
        "id % 50 as l_orderkey", "cast(id % 7 + 1 as int) as l_linenumber", "id * 3e0 as l_extendedprice", "(id % 4) / 1e1 as l_discount",
        "(id % 3) / 1e1 as l_tax", "id % 50 + 1e0 as l_quantity", "'A' as l_returnflag").write.parquet(f"{root}/lineitem.parquet")
    spark.range(9).selectExpr("id as c_custkey", "cast(id % 3 as int) as c_nationkey", "'Customer' as c_name", "'M' as c_mktsegment", "id * 1e2 as c_acctbal").write.parquet(f"{root}/customer.parquet")
    spark.range(30).selectExpr("id as doc_id", "concat('some 1 text ', id) as text", "length(concat('some 1 text ', id)) as n_chars").write.parquet(f"{root}/documents.parquet")
    spark.range(20).selectExpr("id as doc_id", "cast(id % 2 as int) as quality").write.parquet(f"{root}/labels.parquet")
    spark.range(9).selectExpr("id as event_id", "id as user_id", "'view' as event_type", "id * 1e0 as value").write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", ["cln07_zero_as_missing", "cln_bureau_table", "cln18_cleaning_summary", "agg03_instalment_features"])
def test_fits_and_result_read_one_stored_join(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.count() and not any("lineitem" in f or "orders" in f for f in df.inputFiles())


def test_book_cleans_stored_joins(spark, folder):
    found = book.tables(Views(spark, folder))
    for name in ("bureau", "instalments"):
        assert not any("lineitem" in f for f in found[name].inputFiles())


@pytest.mark.parametrize("name", ["jon01_join_history", "agg06_fill_history", "fea08_quality_composite"])
def test_joined_history_carries_only_the_instalment_columns_it_needs(spark, folder, name, monkeypatch):
    stored = []
    monkeypatch.setattr(history, "write_once", lambda df, label: stored.append(df.columns) or write_once(df, label))
    assert QUERIES[name](spark, folder).count()
    assert stored == [["sk_id_curr", "days_instalment", "days_entry_payment"]]


def test_aggregates_of_instalment_days_are_the_same_without_the_amounts(spark):
    rows = spark.range(60).selectExpr(
        "id % 7 as sk_id_curr", "id * 3e0 as amt_instalment", "case when id % 4 > 0 then id * 2e0 end as amt_payment",
        "case when id % 9 > 0 then -(id % 5) * 1e0 end as days_instalment", "case when id % 6 > 0 then id % 8 - 6e0 end as days_entry_payment")
    whole = H.instalment_features(C.clean_instalments(rows))
    days = H.instalment_features(C.clean_instalments(rows.select("sk_id_curr", *C.INSTALMENT_DAYS)))
    assert "inst_amt_payment_mean" in whole.columns and "inst_amt_payment_mean" not in days.columns
    assert days.orderBy("sk_id_curr").collect() == whole.select(days.columns).orderBy("sk_id_curr").collect()


def test_learners_read_stored_features(spark, folder):
    df = training.frame(Views(spark, folder))
    assert df.count() == 20 and not any("documents" in f for f in df.inputFiles())


def test_median_of_looked_up_amounts_passes_over_stored_values(spark, monkeypatch):
    """All passes of the fit read files of the values, the join is not repeated."""
    read = []
    monkeypatch.setattr(J, "exact_medians", lambda df, cols: read.append(df) or {c: 2.0 for c in cols})
    loans = spark.createDataFrame([(1, 5.0), (2, 6.0), (None, 7.0)], "sk_id_curr int, amt_credit double")
    amounts = spark.createDataFrame([(1, 2.0)], "sk_id_curr int, amt_credit double")
    got = J.ead_lookup(loans, amounts)
    assert [r["amt_credit"] for r in got.collect()] == [2.0] * 3
    assert read[0].count() == 3 and read[0].inputFiles()
