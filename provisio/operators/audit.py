"""Data-quality audit: each report is one or two aggregates over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_quantiles
from provisio.functions.semantics import flag, numeric_columns, row_sum, share, string_columns
from provisio.operators.cleaning import days_past_due, payment_diff, rule_counts

__all__ = ["rule_counts"]


def _per_column(df: DataFrame, cols: Sequence[str], stats: dict) -> DataFrame:
    """One row per column from one global aggregate; ``stats`` maps a name to an aggregate."""
    rows = [
        F.struct(F.lit(c).alias("column"), *[make(F.col(c)).alias(name) for name, make in stats.items()])
        for c in cols
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"))


def target_distribution(df: DataFrame, y: str = "target") -> DataFrame:
    counts = df.filter(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())  # a few class rows
    return counts.select(y, "row_count", (F.col("row_count") * F.lit(100.0) / total).alias("pct"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Copies beyond the first of fully equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))


def missing_rates(df: DataFrame, k: int | None = None) -> DataFrame:
    rates = _per_column(df, df.columns, {"missing_rate": lambda c: F.avg(flag(c.isNull()))})
    rates = rates.orderBy(F.desc("missing_rate"), "column")
    return rates if k is None else rates.limit(k)


def missing_bands(df: DataFrame, high: float = 0.40, low: float = 0.15) -> DataFrame:
    r = F.col("missing_rate")
    return missing_rates(df).agg(
        F.count_if(r > high).alias("above_high"),
        F.count_if((r > low) & (r <= high)).alias("between"),
        F.count_if((r > 0) & (r <= low)).alias("below_low"),
        F.count_if(r == 0).alias("complete"),
    )


def sentinel_profile(df: DataFrame, c: str, value) -> DataFrame:
    normal = F.when(F.col(c) != value, F.col(c))
    return df.agg(
        F.count_if(F.col(c) == value).alias("sentinel_rows"),
        share(F.col(c) == value).alias("sentinel_share"),
        F.min(normal).alias("min_days"), F.max(normal).alias("max_days"),
        (-F.max(normal) / 365.0).alias("min_years"), (-F.min(normal) / 365.0).alias("max_years"),
    )


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return (
        df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), c)
    )


def tail_quantiles(df: DataFrame, c: str, qs: Sequence[float] = (0.99, 0.999)) -> DataFrame:
    edges = exact_quantiles(df, {c: list(qs)})[c]
    return df.agg(
        *[F.lit(e).cast("double").alias(f"p{str(round(q * 100, 3)).replace('.0', '').replace('.', '_')}")
          for q, e in zip(qs, edges)],
        F.max(c).alias("max_value"), F.count_if(F.col(c) > F.lit(edges[0])).alias("rows_above"),
    )


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _per_column(df, cols, {
        "missing_pct": lambda c: F.avg(flag(c.isNull())) * 100.0,
        "mean": lambda c: F.avg(c.cast("double")),
        "min": lambda c: F.min(c.cast("double")),
        "max": lambda c: F.max(c.cast("double")),
    })


def flag_sum_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    total = row_sum(cols)
    return df.agg(F.count_if(total == 0).alias("rows_without_flag"), F.max(total).alias("max_flags"))


def categorical_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct count, most frequent value and missing share of every text column.

    Values are counted per (column, value) before the shuffle, so a column with very many
    values is spread over all tasks.
    """
    cols = list(cols or string_columns(df))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    counts = (
        df.select(F.explode(pairs).alias("e")).groupBy("e.column", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    present = F.col("value").isNotNull()
    return counts.groupBy("column").agg(
        F.count_if(present).alias("distinct_count"),
        F.min_by(F.col("value"), F.when(present, F.struct(-F.col("n"), F.col("value")))).alias("top_value"),
        (F.sum(F.when(present, 0).otherwise(F.col("n"))) * F.lit(100.0) / F.sum("n")).alias("missing_pct"),
    )


def zscore_outliers(df: DataFrame, z: float = 10.0, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with rows further than ``z`` standard deviations from the mean."""
    cols = list(cols or [c for c in numeric_columns(df) if c not in ("sk_id_curr", "target")])
    row = df.agg(*[F.struct(F.avg(c), F.stddev_samp(c)).alias(c) for c in cols]).first()
    moments = {c: row[c] for c in cols if row[c][1]}
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.abs((F.col(c) - F.lit(m)) / F.lit(s)) > z).alias("outliers"),
            F.max(F.col(c).cast("double")).alias("max_value"),
        )
        for c, (m, s) in moments.items()
    ]
    return (
        df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
        .filter("outliers > 0").orderBy(F.desc("outliers"), "column")
    )


def negative_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _per_column(df, cols, {"negatives": lambda c: F.count_if(c < 0)})


def key_coverage(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys, distinct parent keys, their ratio and the true overlap.

    One shuffle on the key; equal keys are merged before it.
    """
    both = child.select(key, F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(
        parent.select(key, F.lit(0).alias("c"), F.lit(1).alias("p"))
    )
    keys = both.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("c").alias("c"), F.max("p").alias("p"))
    return keys.agg(
        F.sum("c").alias("child_keys"), F.sum("p").alias("parent_keys"),
        F.sum(F.col("c") * F.col("p")).alias("shared_keys"),
    ).withColumns({
        "ratio": F.try_divide(F.col("child_keys"), F.col("parent_keys")),
        "coverage": F.try_divide(F.col("shared_keys"), F.col("parent_keys")),
    })


def rows_per_key(df: DataFrame, key: str, many: int = 20) -> DataFrame:
    """Distribution of group sizes. Sizes are counted again, so the median reads few values."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    freq = sizes.groupBy("size").agg(F.count(F.lit(1)).alias("keys"))
    return freq.agg(
        F.min("size").alias("min_rows"), F.max("size").alias("max_rows"),
        (F.sum(F.col("size") * F.col("keys")) / F.sum("keys")).alias("mean_rows"),
        F.percentile("size", 0.5, F.col("keys")).alias("median_rows"),
        F.coalesce(F.sum(F.when(F.col("size") > many, F.col("keys"))), F.lit(0)).alias("keys_with_many"),
    )


def payment_shares(inst: DataFrame) -> DataFrame:
    diff, late = payment_diff(), days_past_due()
    return inst.agg(
        share(diff > 0).alias("under"), share(diff < 0).alias("over"), share(diff == 0).alias("exact"),
        share(late > 0).alias("late"), share(late > 30).alias("very_late"),
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, with exact quartiles."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in cols})
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"),
            *[F.lit(v).cast("double").alias(n) for n, v in zip(("p25", "p50", "p75"), quartiles[c])],
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in cols
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def schema_diff(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ("target",)) -> DataFrame:
    left = [c for c in a.columns if c not in b.columns and c not in ignore]
    right = [c for c in b.columns if c not in a.columns]
    rows = [(c, "only_left") for c in left] + [(c, "only_right") for c in right]
    return a.sparkSession.createDataFrame(rows, "column string, side string")


def missing_drift(a: DataFrame, b: DataFrame, k: int = 10, tolerance: float = 0.05) -> DataFrame:
    top = missing_rates(a, k).withColumnRenamed("missing_rate", "left_rate")
    other = missing_rates(b).withColumnRenamed("missing_rate", "right_rate")
    gap = F.abs(F.col("left_rate") - F.col("right_rate"))
    return top.join(other, "column", "left").withColumn("drift", flag(gap > tolerance))


def predicate_rates(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return rule_counts(df, rules)
