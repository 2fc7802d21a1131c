"""Exact order statistics without one task ever seeing an unbounded group.

``percentile`` keeps every distinct value of a group in one buffer and a window without
``partitionBy`` sorts the whole input in one task. The functions here give the same exact
results from bounded pieces:

* ``exact_quantiles`` narrows brackets around the wanted ranks by exact counts, a range at a time,
  until each holds one value.
* ``running_totals`` splits the order into ranges of bounded size, sums each range, and adds
  the sum of all lower ranges to a window inside each range.
* ``ranked_by_hash`` numbers rows in a reproducible random order the same way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.semantics import as_col, bin_index

MAX_DISTINCT = 1_000_000  # distinct values that one task may sort
FEW_ROWS = 20_000  # a bracket with no more rows is counted by value
CELLS = 1 << 16  # equal parts of a larger bracket
OCTAVE = 32  # parts of a power of two in the first pass
ACCURACY = 1_000  # of percentile_approx: rank error at most n / ACCURACY
SAMPLE_ROWS = 2_000_000  # rows behind one sketch, whatever the size of the table


def exact_quantiles(
    df: DataFrame, wanted: dict[str, Sequence[float]], max_distinct: int | None = None
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of any number of numeric columns, exact at any size.

    Selection by passes over rows (column number, value):

    1. The first pass counts each column by sign and magnitude, ``OCTAVE`` cells for each power of two, and
       keeps the cells that hold a wanted rank, with their smallest and largest value.
    2. Every further pass looks each value up among those brackets (a join on the column and the range), cuts
       brackets into ``CELLS`` equal parts, or into single values if they have few rows, and keeps the
       parts that hold a rank. A part with one value is an answer.

    A bracket shrinks to a 65536th part in a pass, so doubles need five passes at most, and tables of
    millions of rows two or three. Brackets and ranks are rows of small tables that grow with what is asked,
    so the plan is the same for any number of quantiles; counts are summed before the shuffle, and one window
    sorts the cells of one bracket. NaN is the largest value.
    """
    cols = [c for c in wanted if len(wanted[c])]
    if not cols:
        return {c: [] for c in wanted}
    few = max_distinct or FEW_ROWS
    asked = _local(df, {"i": [i for i, c in enumerate(cols) for _ in wanted[c]], "q": [float(q) for c in cols for q in wanted[c]]})
    totals: dict[int, int] = {}
    values: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple] = {}  # (column, rank) -> smallest, largest, rows, rank inside

    def settle(key, row, inside):
        lo, hi = row["lo"], row["hi"]
        if lo == hi or lo != lo:
            values[key] = lo
        else:
            open_[key] = (lo, hi, row["n"], inside)

    for row in _first_cells(df, cols, asked).collect():
        totals[row["i"]] = row["total"]
        settle((row["i"], row["r"]), row, row["r"] - row["before"])
    while open_:
        spans = sorted({(i, lo, hi, n) for (i, _r), (lo, hi, n, _k) in open_.items()})
        number = {(i, lo, hi): b for b, (i, lo, hi, _n) in enumerate(spans)}
        place = {(number[(key[0], lo, hi)], k): key for key, (lo, hi, _n, k) in open_.items()}
        open_ = {}
        rows = _inner_cells(df, cols, spans, sorted(place), few).collect()
        if len(rows) != len(place):
            raise RuntimeError("the table changed between two passes over it")
        for row in rows:
            settle(place[(row["b"], row["k"])], row, row["k"] - row["before"])

    out: dict[str, list[float | None]] = {c: [] for c in wanted}
    for i, c in enumerate(cols):
        for q in wanted[c]:
            if i not in totals:
                out[c].append(None)
                continue
            spot = q * (totals[i] - 1)
            low, high = math.floor(spot), math.ceil(spot)
            a, b = values[(i, low)], values[(i, high)]
            out[c].append(a if a == b else (high - spot) * a + (spot - low) * b)
    return out


def _local(df: DataFrame, columns: dict[str, list]) -> DataFrame:
    """A small table that is part of the plan."""
    return df.sparkSession.createDataFrame(pa.table(columns))


def _cells(rows: DataFrame, group: str, cell: Column) -> DataFrame:
    """Rows (n) and extreme values (lo, hi) of each cell, and the rows up to it (upto) and in all (total) of its group."""
    counts = rows.groupBy(group, cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    order = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy(group)))


def _first_cells(df: DataFrame, cols: Sequence[str], asked: DataFrame) -> DataFrame:
    x = F.col("x")
    size = F.floor(F.log2(F.abs(x)) * OCTAVE) + 2000 * OCTAVE  # above 0 for all doubles
    cell = (
        F.when(F.isnan(x), 1e6).when(x == 0, 0.0).when(F.abs(x) == math.inf, F.signum(x) * 5e5)
        .otherwise(F.signum(x) * size)
    )
    cells = _cells(_as_rows(df, cols).filter(x.isNotNull()), "i", cell).join(F.broadcast(asked), "i")
    spot = F.col("q") * (F.col("total") - 1)
    found = cells.withColumn("r", F.explode(F.array(F.floor(spot), F.ceil(spot)))).withColumn("before", F.col("upto") - F.col("n"))
    return found.filter("before <= r and r < upto").select("i", "r", "n", "lo", "hi", "before", "total").distinct()


def _inner_cells(df: DataFrame, cols: Sequence[str], spans: list[tuple], ranks: list[tuple], few: int) -> DataFrame:
    needed = sorted({i for i, _lo, _hi, _n in spans})  # only columns with open ranks are read
    at = {i: j for j, i in enumerate(needed)}
    brackets = _local(df, {
        "b": list(range(len(spans))), "bi": [at[s[0]] for s in spans], "low": [s[1] for s in spans], "high": [s[2] for s in spans],
        "rows": [s[3] for s in spans],
    })
    x, low, high = F.col("x"), F.col("low"), F.col("high")
    rows = _as_rows(df, [cols[i] for i in needed]).join(F.broadcast(brackets), (F.col("i") == F.col("bi")) & (x >= low) & (x <= high))
    part = F.floor((x - low) / (high - low) * CELLS).cast("double")
    cells = _cells(rows, "b", F.when(F.col("rows") <= few, x).otherwise(part)).withColumn("before", F.col("upto") - F.col("n"))
    wanted = _local(df, {"wb": [b for b, _k in ranks], "k": [k for _b, k in ranks]})
    holds = (F.col("b") == F.col("wb")) & (F.col("before") <= F.col("k")) & (F.col("k") < F.col("upto"))
    return cells.join(F.broadcast(wanted), holds).select("b", "k", "n", "lo", "hi", "before")


def _as_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row (column number i, value x) per value."""
    return df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("i", "x"))


def _sizes(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, int]]:
    """Rows, distinct values (sketched), smallest and largest value per column.

    A few columns are counted side by side. Many are counted as rows of one grouped aggregate,
    because each sketch takes some fifty buffer fields of the generated code.
    """
    def aggs(c: str, i="") -> list[Column]:
        x = F.col(c).cast("double")
        return [
            F.count(c).alias(f"n{i}"), F.approx_count_distinct(c).alias(f"d{i}"),
            F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
        ]

    names = ("n", "d", "lo", "hi")
    if len(cols) > 8:
        rows = {r["i"]: r for r in _as_rows(df, cols).groupBy("i").agg(*aggs("x")).collect()}
        return {c: {k: rows[i][k] if i in rows else 0 for k in names} for i, c in enumerate(cols)}
    row = df.agg(*[a for i, c in enumerate(cols) for a in aggs(c, i)]).first()
    return {c: {k: row[f"{k}{i}"] for k in names} for i, c in enumerate(cols)}


def distinct_sketch(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Sketched number of distinct values of numeric columns."""
    return {c: s["d"] for c, s in _sizes(df, list(cols)).items()}


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, {c: [0.5] for c in cols}).items()}


def range_splits(df: DataFrame, c: str, max_distinct: int | None = None) -> list[float]:
    """Split points that cut a column into ranges of at most about ``max_distinct`` values."""
    return range_splits_many(df, [c], max_distinct)[c]


def range_splits_many(df: DataFrame, cols: Sequence[str], max_distinct: int | None = None) -> dict[str, list[float]]:
    """Split points of several columns: one sketch of the sizes, then one scan per large column."""
    limit = max_distinct or MAX_DISTINCT
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    out: dict[str, list[float]] = {}
    for c in cols:
        parts = math.ceil(sizes[c] * 1.2 / limit)
        if parts <= 1:
            out[c] = []
            continue
        distinct = df.select(F.col(c).cast("double").alias(c)).filter(F.col(c).isNotNull()).distinct()
        probs = [i / parts for i in range(1, parts)]
        drawn = distinct.filter(F.rand(17) < min(1.0, SAMPLE_ROWS / sizes[c]))
        splits = drawn.agg(F.percentile_approx(c, probs, max(ACCURACY, 10 * parts)).alias("s")).first()["s"]
        out[c] = sorted(set(splits))
    return out


def with_range(df: DataFrame, c: str, splits: Sequence[float], name: str = "_range") -> DataFrame:
    """Add the number of the range that holds the value (binary search beyond 200 splits)."""
    if len(splits) <= 200:
        return df.withColumn(name, bin_index(c, splits, right_closed=False))
    model = Bucketizer(
        splits=[-math.inf, *splits, math.inf], inputCol=c, outputCol=name, handleInvalid="keep"
    )
    return model.transform(df).withColumn(name, F.col(name).cast("int"))


def running_totals(
    df: DataFrame, order: str, sums: dict[str, str], splits: Sequence[float], by: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums in the order of a numeric column with distinct values.

    ``sums`` maps a value column to the name of its running total, ``splits`` are the split
    points of ``range_splits`` for the values of ``order``, so that one task sorts one range
    of one group.
    """
    ranged = with_range(df, order, splits)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    if not splits:
        return ranged.select(*df.columns, *[F.sum(v).over(inside).alias(name) for v, name in sums.items()])
    # One row per group and range: len(splits) + 1 rows for each of a few groups.
    offsets = (
        ranged.groupBy(*by, "_range").agg(*[F.sum(v).alias(f"_t_{v}") for v in sums])
        .select(*by, "_range", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in sums])
    )
    return ranged.join(F.broadcast(offsets), [*by, "_range"]).select(
        *df.columns, *[(F.sum(v).over(inside) + F.col(f"_o_{v}")).alias(name) for v, name in sums.items()]
    )


HASH_ROWS = 1_000_000  # rows that one task numbers, about


def hash_order(key, seed: int = 0) -> Column:
    """Reproducible pseudo-random order key of a row."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_col(key).cast("string")))


def ranked_by_hash(
    df: DataFrame, key: str, seed: int = 0, within: str | None = None, name: str = "rank"
) -> DataFrame:
    """Number rows 0, 1, 2, ... in hash order of a unique key, per value of ``within``.

    The hash is uniform, so its first digits split any group, also one that holds nearly all
    rows, into ranges of equal size. The number of digits follows the number of rows, so that a range has about
    ``HASH_ROWS`` rows at any size, and Spark broadcasts the range counts where they are small.
    """
    group = [within] if within else []
    digits = hash_digits(df.count())
    hashed = df.withColumn("_hash", hash_order(key, seed)).withColumn("_part", F.substring("_hash", 1, digits))
    counts = hashed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_part").alias("_g_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    on = F.col("_part") == F.col("_g_part")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = Window.partitionBy(*group, "_part").orderBy("_hash", key)
    numbered = hashed.withColumn("_row", F.row_number().over(inside) - 1)
    return numbered.join(offsets, on).select(
        *df.columns, (F.col("_row") + F.col("_before")).cast("long").alias(name)
    )


def hash_digits(rows: int) -> int:
    """Hex digits of the hash that cut so many rows into ranges of ``HASH_ROWS`` or fewer; 16 ranges at least."""
    digits = 1
    while rows > HASH_ROWS * 16**digits:
        digits += 1
    return digits


def ranked(df: DataFrame, order: str, key: str, name: str = "rank", max_distinct: int | None = None) -> DataFrame:
    """Number rows 1, 2, 3, ... by a numeric column, largest first and nulls last, then by a unique numeric key.

    Rows before a value come from running totals over the values, rows before a range of the key inside one value from
    the counts of such cells, and one task numbers a cell, so neither many values nor a hot one fill a task.
    """
    placed = df.withColumn("_order", -F.coalesce(F.col(order).cast("double"), F.lit(-math.inf)))
    placed = with_range(placed, key, range_splits(df, key, max_distinct), "_cell")
    cells = placed.groupBy("_order", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    values = cells.groupBy("_order").agg(F.sum("_n").alias("_all"))
    upto = running_totals(values, "_order", {"_all": "_upto"}, range_splits(values, "_order", max_distinct))
    before = Window.partitionBy("_order").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.join(upto, "_order").select(
        "_order", "_cell", (F.col("_upto") - F.col("_all") + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_before"))
    inside = Window.partitionBy("_order", "_cell").orderBy(key)
    return placed.join(offsets, ["_order", "_cell"]).select(
        *df.columns, (F.col("_before") + F.row_number().over(inside)).cast("long").alias(name))
