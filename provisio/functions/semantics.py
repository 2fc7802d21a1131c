"""Column expressions with the missing-value, rounding and binning rules of the engine.

Missing is NULL everywhere (NaN is turned into NULL on load), aggregates skip it, clipping
keeps it, and interval bins are right-closed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPSILON = 1e-6
FLOATS = (T.DoubleType, T.FloatType)
NUMBERS = (T.NumericType,)


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, FLOATS)}
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def clip(c, lo=None, hi=None) -> Column:
    """Limit to [lo, hi]; NULL stays NULL (``least`` and ``greatest`` alone would skip it)."""
    c = as_col(c)
    out = None
    if lo is not None:
        out = F.when(c < lo, lo)
    if hi is not None:
        out = F.when(c > hi, hi) if out is None else out.when(c > hi, hi)
    return c if out is None else out.otherwise(c)


def ratio(num, den) -> Column:
    """num / (den + 1e-6), the guarded division of all engineered ratios."""
    return as_col(num) / (as_col(den) + F.lit(EPSILON))


def safe_div(num, den, default=None) -> Column:
    out = F.try_divide(as_col(num), as_col(den))
    return out if default is None else F.coalesce(out, F.lit(default))


def flag(predicate: Column) -> Column:
    """1 where the predicate holds, 0 where it is false or unknown."""
    return F.when(predicate, 1).otherwise(0)


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def sum0(c) -> Column:
    """Sum that is 0, not NULL, over a group without values."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0).cast("double"))


def share(predicate: Column) -> Column:
    """Share of all rows for which the predicate holds; unknown counts as no."""
    return F.avg(F.when(predicate, 1.0).otherwise(0.0))


def col_or(df: DataFrame, name: str, default) -> Column:
    """The column with missing values filled, or the constant if there is no such column."""
    value = F.lit(default)
    return F.coalesce(F.col(name), value) if name in df.columns else value


def bin_index(c, edges: Sequence[float], right_closed: bool = True) -> Column:
    """Number of edges below the value (right-closed) or not above it (left-closed).

    A balanced tree of comparisons, so 100 edges cost seven tests per row.
    """
    c = as_col(c)
    edges = sorted(float(e) for e in edges)

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        left = c <= F.lit(edges[mid]) if right_closed else c < F.lit(edges[mid])
        return F.when(left, tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(c.isNotNull(), tree(0, len(edges)))


def cut(c, edges: Sequence[float], labels: Sequence, outside=None) -> Column:
    """Label of the right-closed interval that holds the value.

    The first edge itself is outside; rows outside every interval get ``outside``.
    """
    c = as_col(c)
    out = F.when(c <= F.lit(float(edges[0])), F.lit(outside))
    for upper, label in zip(edges[1:], labels, strict=True):
        out = out.when(c <= F.lit(float(upper)), F.lit(label))
    return out.otherwise(F.lit(outside))


def distinct_edges(quantiles: Sequence[float]) -> list[float]:
    """Quantile edges of a qcut without repeats, ascending."""
    return sorted(set(float(q) for q in quantiles))


def qcut_bin(c, edges: Sequence[float]) -> Column:
    """0-based quantile bin for de-duplicated edges; the lowest value is in bin 0.

    Values outside the fitted range go to the first or the last bin.
    """
    return bin_index(c, edges[1:-1])


def ordinal(c, order: Sequence) -> Column:
    """Position of a label in a given order (for ordered categories)."""
    c = as_col(c)
    out = F.lit(None).cast("int")
    for i in reversed(range(len(order))):
        out = F.when(c == F.lit(order[i]), F.lit(i)).otherwise(out)
    return out


def map_lookup(c, mapping: dict, default=None) -> Column:
    """Constant lookup for a handful of keys."""
    c = as_col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(c == F.lit(key), F.lit(value)) if out is None else out.when(c == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


# Row-wise statistics that skip missing values.


def row_sum(cols: Sequence) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_count(cols: Sequence) -> Column:
    return reduce(lambda a, b: a + b, [flag(as_col(c).isNotNull()) for c in cols])


def row_mean(cols: Sequence) -> Column:
    return F.try_divide(row_sum(cols), row_count(cols))


def row_min(cols: Sequence) -> Column:
    """Smallest present value (``least`` skips missing ones)."""
    return F.least(*[as_col(c).cast("double") for c in cols])


def row_product(cols: Sequence) -> Column:
    return reduce(lambda a, b: a * b, [F.coalesce(as_col(c).cast("double"), F.lit(1.0)) for c in cols])


def row_std(cols: Sequence) -> Column:
    """Sample standard deviation over the present values; 0 when fewer than two."""
    mean, n = row_mean(cols), row_count(cols)
    squares = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.pow(as_col(c).cast("double") - mean, 2), F.lit(0.0)) for c in cols],
    )
    return F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(F.lit(0.0))


def row_argmax(cols: Sequence[str]) -> Column:
    """Name of the column with the largest value; the first one wins ties."""
    best = F.array_max(
        F.array(
            *[
                F.struct(F.coalesce(as_col(c).cast("double"), F.lit(float("-inf"))).alias("v"),
                         F.lit(-i).alias("o"), F.lit(c).alias("n"))
                for i, c in enumerate(cols)
            ]
        )
    )
    return best["n"]


# Calendar helpers around the fixed reference date of the portfolio.

REFERENCE_DATE = "2016-06-01"


def days_before_reference(days: Column) -> Column:
    return F.date_sub(F.lit(REFERENCE_DATE).cast("date"), days.cast("int"))


def quarter_label(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def parse_label(c, sep: str, position: int = 0) -> Column:
    """Number in one part of a text label, NULL when the part is no number."""
    return F.split(as_col(c), sep).getItem(position).try_cast("double")


def present_names(conditions: dict[str, Column]) -> Column:
    """Names whose condition holds, in order, without a per-element lambda."""
    found = F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()])
    return F.array_except(found, F.array(F.lit(None).cast("string")))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def columns_like(df: DataFrame, token: str) -> list[str]:
    return [c for c in df.columns if token.lower() in c.lower()]


def feature_columns(df: DataFrame, exclude=("sk_id_curr", "target", "is_train")) -> list[str]:
    hidden = {e.lower() for e in exclude}
    return [c for c in df.columns if c.lower() not in hidden]
