"""Isotonic calibration of scores at any number of distinct scores.

Points (one per distinct score) are pooled inside ranges of the score, range by range in parallel, and the pooled
blocks are dealt into new, wider ranges until no two neighbouring ranges are out of order. The fitted function is a
table of intervals between block ends, and a score is looked up by the number of its range and the
interval that holds it, so the function never has to fit the driver or one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import range_splits, with_range
from provisio.session import new_path

POOL_POINTS = 200_000  # points that one task pools in the first round
LOOKUP_RANGES = 4096  # ranges of the lookup at most, whatever the number of blocks
LOOKUP_BLOCKS = 32  # blocks in a range of the lookup, as far as the ranges go
BLOCK = "lo double, hi double, total double, weight double"


@dataclass(frozen=True)
class Isotonic:
    """A fitted step-and-slope function: intervals [lo, hi) with the values at both ends, dealt by ``splits``."""

    intervals: DataFrame
    splits: list[float]
    by: tuple[str, ...] = ()


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _pool(by: Sequence[str]):
    def run(table: pa.Table) -> pa.Table:
        """Pool adjacent violators among the blocks of one range."""
        table = table.sort_by("lo")
        lo, hi, total, weight = [], [], [], []
        for a, b, t, w in zip(*(table[c].to_pylist() for c in ("lo", "hi", "total", "weight"))):
            while lo and total[-1] * w >= t * weight[-1]:
                a, t, w = lo.pop(), t + total.pop(), w + weight.pop()
                hi.pop()
            lo.append(a)
            hi.append(b)
            total.append(t)
            weight.append(w)
        group = [pa.array([table[c][0].as_py()] * len(lo), table[c].type) for c in by]
        return pa.table([*group, *(pa.array(x, pa.float64()) for x in (lo, hi, total, weight))], names=[*by, "lo", "hi", "total", "weight"])

    return run


def _out_of_order(blocks: DataFrame, by: Sequence[str]) -> bool:
    """Whether a range ends higher than its next one begins (one row per range)."""
    mean = F.col("total") / F.col("weight")
    ends = blocks.groupBy(*by, "_range").agg(F.min_by(mean, "lo").alias("first"), F.max_by(mean, "lo").alias("last"))
    before = Window.partitionBy(*by).orderBy("_range")
    return not ends.withColumn("before", F.lag("last").over(before)).filter("before > first").isEmpty()


def fit_points(points: DataFrame, by: Sequence[str] = (), max_points: int = POOL_POINTS) -> Isotonic:
    """Isotonic fit of points (``score``, ``total`` of the labels, ``weight``), for each group of ``by``."""
    kinds = dict(points.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), BLOCK])
    blocks = points.select(*by, F.col("score").alias("lo"), F.col("score").alias("hi"), F.col("total").cast("double").alias("total"), F.col("weight").cast("double").alias("weight"))
    blocks, limit = _stored(blocks, "isotonic-points"), max_points
    while True:
        splits = range_splits(blocks, "lo", math.ceil(limit))
        pooled = with_range(blocks, "lo", splits).groupBy(*by, "_range").applyInArrow(_pool(by), schema)
        blocks = _stored(pooled, "isotonic-blocks")
        if not splits or not _out_of_order(with_range(blocks, "lo", splits), by):
            break
        limit *= 1.5  # other boundaries in the next round
    return _intervals(blocks, by, splits)


def _intervals(blocks: DataFrame, by: Sequence[str], pool_splits: list[float]) -> Isotonic:
    """Intervals between the ends of blocks; before the first and after the last end the function is constant."""
    value = F.col("total") / F.col("weight")
    points = blocks.select(*by, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("lo"), value.alias("v_lo"))
    points = with_range(points, "lo", pool_splits)
    inside, across = Window.partitionBy(*by, "_range").orderBy("lo"), Window.partitionBy(*by).orderBy("_range")
    # One row per range: where the next range of the group begins.
    starts = points.groupBy(*by, "_range").agg(F.min("lo").alias("lo"), F.min_by("v_lo", "lo").alias("v_lo"))
    starts = starts.select(*by, "_range", F.lead("lo").over(across).alias("next_lo"), F.lead("v_lo").over(across).alias("next_v"), (F.row_number().over(across) == 1).alias("is_first"))
    ahead = points.join(F.broadcast(starts), [*by, "_range"]).select(
        *by, "lo", "v_lo", F.coalesce(F.lead("lo").over(inside), "next_lo", F.lit(math.inf)).alias("hi"),
        F.coalesce(F.lead("v_lo").over(inside), "next_v", "v_lo").alias("v_hi"), (F.col("is_first") & (F.row_number().over(inside) == 1)).alias("is_first"))
    below = ahead.filter("is_first").select(*by, F.lit(-math.inf).alias("lo"), F.col("v_lo"), F.col("lo").alias("hi"), F.col("v_lo").alias("v_hi"))
    whole = _stored(ahead.drop("is_first").unionByName(below), "isotonic-intervals")
    n = whole.agg(F.approx_count_distinct("lo")).first()[0]
    splits = range_splits(whole.filter(F.col("lo") > -math.inf), "lo", max(LOOKUP_BLOCKS, math.ceil(n / LOOKUP_RANGES)))
    first = with_range(whole, "lo", splits, "_a")
    dealt = with_range(first, "hi", splits, "_b").withColumn("_range", F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")
    return Isotonic(_stored(dealt, "isotonic"), splits, tuple(by))


def fit(df: DataFrame, y: str = "target", p: str = "pred_prob", max_points: int = POOL_POINTS) -> Isotonic:
    """Isotonic fit on one weighted point per distinct score (the same fit as on all rows)."""
    known = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    points = known.groupBy(F.col(p).cast("double").alias("score")).agg(F.sum(F.col(y).cast("double")).alias("total"), F.count(F.lit(1)).alias("weight"))
    return fit_points(points, (), max_points)


def apply(df: DataFrame, model: Isotonic, p: str = "pred_prob", name: str = "pd_calibrated") -> DataFrame:
    """Value of the function at each score, also of a stream; a missing score gives NULL.

    The intervals are broadcast if Spark finds them small, else both sides are dealt by group and range.
    """
    keys = [*model.by, "_range"]
    table = model.intervals.select(*[F.col(c).alias(f"_m_{c}") for c in keys], *[F.col(c).alias(f"_m_{c}") for c in ("lo", "hi", "v_lo", "v_hi")])
    rows = with_range(df.withColumn("_score", F.col(p).cast("double")), "_score", model.splits)
    on = (F.col("_score") >= F.col("_m_lo")) & (F.col("_score") < F.col("_m_hi"))
    for c in keys:
        on = on & (F.col(c) == F.col(f"_m_{c}"))
    lo, hi, a, b = (F.col(f"_m_{c}") for c in ("lo", "hi", "v_lo", "v_hi"))
    value = F.when((a == b) | (lo == -math.inf) | (hi == math.inf), a).otherwise(a + (b - a) * (F.col("_score") - lo) / (hi - lo))
    return rows.join(table, on, "left").select(*df.columns, value.alias(name))


def cross(df: DataFrame, k: int, y: str = "target", p: str = "pred_prob", name: str = "pd_calibrated") -> DataFrame:
    """Each fold calibrated by a fit on the other folds: one count by fold and score serves all fits."""
    known = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    own = _stored(known.groupBy(F.col("fold").cast("int").alias("fold"), F.col(p).cast("double").alias("score")).agg(
        F.sum(F.col(y).cast("double")).alias("total"), F.count(F.lit(1)).alias("weight")), "isotonic-folds")
    whole = own.groupBy("score").agg(F.sum("total").alias("all_total"), F.sum("weight").alias("all_weight"))
    each = whole.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(k)])))
    rest = each.join(own, ["fold", "score"], "left").select(
        "fold", "score", (F.col("all_total") - F.coalesce("total", F.lit(0.0))).alias("total"), (F.col("all_weight") - F.coalesce("weight", F.lit(0))).alias("weight"))
    return apply(df, fit_points(rest.filter("weight > 0"), ["fold"]), p, name)


def write(model: Isotonic, path: str) -> None:
    spark = model.intervals.sparkSession
    model.intervals.write.mode("overwrite").parquet(f"{path}/intervals")
    spark.createDataFrame([(model.splits, list(model.by))], "splits array<double>, by array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")


def read(spark: SparkSession, path: str) -> Isotonic:
    shape = spark.read.parquet(f"{path}/shape").first()
    return Isotonic(spark.read.parquet(f"{path}/intervals"), list(shape["splits"]), tuple(shape["by"]))
