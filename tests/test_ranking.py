import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from provisio.functions import ranking as R
from provisio.operators import metrics as M


@pytest.fixture(scope="module")
def numbers(spark):
    """A wide column, one with a hot value on a third of the rows, one with few values."""
    rng = np.random.default_rng(7)
    wide = rng.normal(0, 1e5, 20000)
    hot = np.where(rng.random(20000) < 0.34, 12.5, rng.gamma(2.0, 30.0, 20000))
    few = rng.integers(0, 7, 20000)
    rows = [(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(wide, hot, few))]
    df = spark.createDataFrame(rows, "id long, wide double, hot double, few int").repartition(8).cache()
    yield df, wide, hot, few
    df.unpersist()


QS = [0.0, 0.01, 0.1, 0.25, 0.333, 0.5, 0.75, 0.9, 0.99, 0.999, 1.0]


@pytest.mark.parametrize("limit, cells", [(None, 1 << 16), (200, 1 << 16), (3, 4)])
def test_exact_quantiles_match_numpy(numbers, limit, cells, monkeypatch):
    df, wide, hot, few = numbers
    monkeypatch.setattr(R, "CELLS", cells)
    got = R.exact_quantiles(df, {"wide": QS, "hot": QS, "few": QS}, max_distinct=limit)
    for name, data in (("wide", wide), ("hot", hot), ("few", few)):
        np.testing.assert_allclose(got[name], np.quantile(data, QS), rtol=1e-12, atol=1e-9)


def test_quantiles_of_doubles_of_all_sizes(spark):
    """Subnormal and huge numbers, both zeros, neighbours one bit apart, infinities, NaN and a hot value."""
    rng = np.random.default_rng(3)
    data = np.concatenate([
        rng.normal(0, 1, 300) * 10.0 ** rng.integers(-320, 300, 300), [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, math.inf, -math.inf],
        np.nextafter(1.0, 2.0) * np.ones(3), np.ones(5), 1.0 + np.arange(40) * 2.0**-52, np.full(200, 7.25),
    ])
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,)], "x double").repartition(5)
    order, n = np.sort(data), len(data)
    spots = [0, 1, 2, 50, 150, 299, 300, 340, 360, 399, 500, n - 3, n - 2, n - 1]
    got = R.exact_quantiles(df, {"x": [s / (n - 1) for s in spots]}, max_distinct=10)["x"]
    for s, value in zip(spots, got):
        spot = s / (n - 1) * (n - 1)
        assert value == order[s] or min(order[math.floor(spot)], order[math.ceil(spot)]) <= value <= max(order[math.floor(spot)], order[math.ceil(spot)])
    with_nan = df.union(spark.createDataFrame([(math.nan,)], "x double"))
    assert math.isnan(R.exact_quantiles(with_nan, {"x": [1.0]})["x"][0])


def test_two_hundred_columns_in_one_plan(spark, monkeypatch):
    """All columns above the limit for counting by value; the plan does not grow with the ranks."""
    rng = np.random.default_rng(11)
    data = rng.normal(0, 1, (400, 200)) * 10.0 ** rng.integers(-3, 6, 200)
    data[:, 5] = 3.5
    frame = spark.createDataFrame(pa.table({f"c{j}": data[:, j] for j in range(200)}))
    frame = frame.withColumn("c7", F.when(F.col("c7") > 0, F.col("c7"))).repartition(4).cache()
    plans = []
    inner = R._inner_cells

    def watched(*args):
        out = inner(*args)
        plans.append(out._jdf.queryExecution().analyzed().toString().count("\n"))
        return out

    monkeypatch.setattr(R, "_inner_cells", watched)
    got = R.exact_quantiles(frame, {f"c{j}": QS for j in range(200)}, max_distinct=5)
    many = plans[:]
    plans.clear()
    R.exact_quantiles(frame, {f"c{j}": [0.5] for j in range(200)}, max_distinct=5)
    assert many[0] == plans[0] and len(many) <= 4
    for j in range(200):
        column = data[:, j] if j != 7 else data[data[:, 7] > 0, 7]
        np.testing.assert_allclose(got[f"c{j}"], np.quantile(column, QS), rtol=1e-12, atol=1e-12)
    frame.unpersist()


def test_quantiles_of_missing_and_small_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5), (2.0, None, None), (4.0, None, None), (9.0, None, None)], "a double, b double, c int")
    got = R.exact_quantiles(df, {"a": [0.5], "b": [0.5], "c": [0.1, 0.9]})
    assert got == {"a": [3.0], "b": [None], "c": [5.0, 5.0]}


def test_running_totals_in_ranges_equal_one_window(numbers, spark):
    df, wide, _hot, _few = numbers
    counts = df.groupBy(F.col("wide").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    splits = R.range_splits(counts, "v", max_distinct=500)
    assert len(splits) > 30
    got = {r["v"]: r["upto"] for r in R.running_totals(counts, "v", {"n": "upto"}, splits).collect()}
    order = np.sort(wide)
    assert len(got) == len(order)
    assert all(got[v] == i + 1 for i, v in enumerate(order))


def test_many_splits_use_binary_search(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    splits = [float(x) for x in range(10, 5000, 10)]
    rows = R.running_totals(df, "v", {"n": "upto"}, splits).filter("upto <> v + 1").count()
    assert rows == 0


def test_hash_rank_is_a_permutation_per_class(spark):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 20 == 0, 1).otherwise(0).alias("y"))
    ranked = R.ranked_by_hash(df, "id", seed=3, within="y").cache()
    for y, n in ((0, 4750), (1, 250)):
        ranks = sorted(r["rank"] for r in ranked.filter(F.col("y") == y).collect())
        assert ranks == list(range(n))
    again = R.ranked_by_hash(df.repartition(3), "id", seed=3, within="y")
    assert ranked.join(again, ["id", "rank"]).count() == 5000
    other = R.ranked_by_hash(df, "id", seed=4, within="y")
    assert ranked.join(other, ["id", "rank"]).count() < 500


def test_ranged_metrics_equal_the_plain_ones(scored):
    plain = M.auc(scored).first()[0]
    assert abs(M.auc(scored, max_distinct=40).first()[0] - plain) < 1e-12
    a = {tuple(r) for r in M.roc_points(scored).collect()}
    b = {tuple(r) for r in M.roc_points(scored, max_distinct=25).collect()}
    assert a == b


def test_ranked_numbers_all_rows(spark):
    """Ties, a hot value and nulls, dealt into many ranges."""
    from provisio.functions.ranking import ranked

    rows = [((i * 7919) % 1999, None if i % 50 == 0 else 5.0 if i % 3 == 0 else float((i * 31) % 97)) for i in range(1999)]
    df = spark.createDataFrame(rows, "sk_id_curr long, value double").repartition(4)
    want = [k for k, _ in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))]
    for most in (None, 20):
        got = {r["rank"]: r["sk_id_curr"] for r in ranked(df, "value", "sk_id_curr", max_distinct=most).collect()}
        assert [got[i + 1] for i in range(len(rows))] == want
