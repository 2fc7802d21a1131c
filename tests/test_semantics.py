import math

from pyspark.sql import functions as F

from provisio.functions import semantics as S


def values(df, c="v"):
    return [r[c] for r in df.orderBy("i").select(c).collect()]


def frame(spark, items, kind="double"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")


def test_nan_becomes_null(spark):
    df = S.nan_to_null(frame(spark, [float("nan"), 1.0]))
    row = df.agg(F.avg("x"), F.count("x")).first()
    assert tuple(row) == (1.0, 1)


def test_clip_keeps_null(spark):
    df = frame(spark, [None, 1.0, 3.0])
    assert values(df.withColumn("v", S.clip("x", None, 2.0))) == [None, 1.0, 2.0]
    assert values(df.withColumn("v", S.clip("x", 1.5, 2.0))) == [None, 1.5, 2.0]


def test_cut_is_right_closed_and_open_on_the_left(spark):
    df = frame(spark, [17.0, 18.0, 25.0, 26.0, 70.0, 70.5, None])
    v = S.cut("x", (18, 25, 35, 45, 55, 70), ("a", "b", "c", "d", "e"))
    assert values(df.withColumn("v", v)) == [None, None, "a", "b", "e", None, None]


def test_bin_index_counts_edges(spark):
    edges = [0.1 * i for i in range(1, 100)]
    items = [0.0, 0.05, edges[0], edges[41], 4.21, 99.0, None]
    df = frame(spark, items)
    below = [None if x is None else sum(e < x for e in edges) for x in items]
    upto = [None if x is None else sum(e <= x for e in edges) for x in items]
    assert values(df.withColumn("v", S.bin_index("x", edges))) == below
    assert values(df.withColumn("v", S.bin_index("x", edges, right_closed=False))) == upto


def test_half_even_round(spark):
    df = frame(spark, [0.5, 1.5, 2.5])
    assert values(df.withColumn("v", F.bround("x", 0))) == [0.0, 2.0, 2.0]


def test_sum_of_nothing_is_zero(spark):
    row = frame(spark, [None, None]).agg(S.sum0("x").alias("s"), F.count("x").alias("n")).first()
    assert (row["s"], row["n"]) == (0.0, 0)


def test_row_statistics_skip_missing(spark):
    df = spark.createDataFrame([(1.0, None, None), (1.0, 2.0, 4.0), (None, None, None)], "a double, b double, c double")
    cols = ["a", "b", "c"]
    rows = df.select(
        S.row_mean(cols), S.row_min(cols), S.row_product(cols), S.row_std(cols), S.row_sum(cols)
    ).collect()
    assert tuple(rows[0]) == (1.0, 1.0, 1.0, 0.0, 1.0)
    assert rows[1][0] == 7 / 3 and rows[1][2] == 8.0 and math.isclose(rows[1][3], 1.5275252316519468)
    assert tuple(rows[2]) == (None, None, 1.0, 0.0, 0.0)


def test_argmax_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (None, -1.0)], "a double, b double")
    assert [r[0] for r in df.select(S.row_argmax(["a", "b"])).collect()] == ["a", "b", "b"]


def test_labels(spark):
    df = spark.createDataFrame([(0,), (400,)], "d int").select(S.days_before_reference(F.col("d")).alias("x"))
    rows = df.select(S.quarter_label(F.col("x")), S.month_label(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [("2016Q2", "2016-06"), ("2015Q2", "2015-04")]
    parsed = spark.createDataFrame([("10-20%",), ("High",)], "x string").select(S.parse_label("x", "-"))
    assert [r[0] for r in parsed.collect()] == [10.0, None]
