"""Weight-of-evidence binning, information value and the scorecard transform.

The fitted bins are a small dictionary; the bin table of all features comes from one pass
that counts (feature, bin) before the shuffle. Scoring uses the fitted edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provisio.functions.ranking import distinct_sketch, exact_quantiles
from provisio.functions.semantics import distinct_edges, map_lookup, qcut_bin
from provisio.operators.joins import salted_left_join

MAX_VALUES = 10
SMOOTHING = 0.5
# Strength bands of the information value, lower bounds exclusive.
IV_BANDS = (("Suspicious", 0.50), ("Strong", 0.30), ("Medium", 0.10), ("Weak", 0.02))
LITERAL_BINS = 1000  # value bins beyond this are joined instead of written into the plan


def fit_bins(df: DataFrame, features: Sequence[str], n: int = 10) -> dict[str, dict]:
    """Binning rule per feature.

    Texts, booleans and numbers with at most ten values bin by value, other numbers by
    quantiles with repeated edges dropped. The first scan only sketches the distinct counts;
    columns near the limit are then counted exactly, which is cheap because they are small.
    """
    by_value, numeric = [], []
    for c in features:
        if isinstance(df.schema[c].dataType, (T.StringType, T.BooleanType)):
            by_value.append(c)
        else:
            numeric.append(c)
    if numeric:
        sketch = distinct_sketch(df, numeric)
        near = [c for c in numeric if sketch[c] <= 20 * MAX_VALUES]
        exact = {}
        if near:
            pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in near])
            counts = (
                df.select(F.explode(pairs).alias("e")).filter("e.v is not null")
                .select("e.c", "e.v").distinct().groupBy("c").count()
            )
            exact = {r["c"]: r["count"] for r in counts.collect()}
        by_value += [c for c in near if exact.get(c, 0) <= MAX_VALUES]
    quantiled = [c for c in numeric if c not in by_value]
    probs = [i / n for i in range(n + 1)]
    edges = exact_quantiles(df, {c: probs for c in quantiled}) if quantiled else {}
    out: dict[str, dict] = {}
    for c in features:
        if c in by_value:
            out[c] = {"kind": "value"}
            continue
        fitted = distinct_edges(edges[c])
        if len(fitted) < 2:  # cannot happen with more than ten values; equal-width fallback
            row = df.agg(F.min(c), F.max(c)).first()
            step = (row[1] - row[0]) / n
            fitted = [row[0] + i * step for i in range(n + 1)]
        out[c] = {"kind": "quantile", "edges": fitted}
    return out


def bin_column(c: str, rule: dict) -> Column:
    """Bin key of a value as text; NULL for a missing value."""
    if rule["kind"] == "value":
        return F.col(c).cast("string")
    return F.lpad(qcut_bin(c, rule["edges"]).cast("string"), 3, "0")


def bin_table(df: DataFrame, bins: dict[str, dict], y: str = "target") -> DataFrame:
    """events, total and non-events per (feature, bin) from one pass over the rows."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("feature"), bin_column(c, rule).alias("bin")) for c, rule in bins.items()
    ])
    long = (
        df.filter(F.col(y).isNotNull()).select(F.col(y).alias("y"), F.explode(entries).alias("e"))
        .filter("e.bin is not null")
    )
    return (
        long.groupBy(F.col("e.feature").alias("feature"), F.col("e.bin").alias("bin"))
        .agg(F.sum(F.col("y").cast("long")).alias("events"), F.count(F.lit(1)).alias("total"))
        .withColumn("nonevents", F.col("total") - F.col("events"))
    )


def totals(df: DataFrame, y: str = "target") -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(y) == 1), F.count_if(F.col(y) == 0)).first()
    return row[0], row[1]


def woe_table(table: DataFrame, all_rows: tuple[int, int]) -> DataFrame:
    """Smoothed shares, weight of evidence (positive = riskier) and bin IV.

    The totals are those of all rows, also rows in which the feature is missing.
    """
    events, nonevents = all_rows
    if events == 0 or nonevents == 0:
        table = table.filter(F.lit(False))
    share_ev = (F.col("events") + SMOOTHING) / F.lit(events + SMOOTHING)
    share_nev = (F.col("nonevents") + SMOOTHING) / F.lit(nonevents + SMOOTHING)
    return (
        table.withColumns({"pct_ev": share_ev, "pct_nev": share_nev})
        .withColumn("woe", F.log(F.col("pct_ev") / F.col("pct_nev")))
        .withColumn("iv", (F.col("pct_ev") - F.col("pct_nev")) * F.col("woe"))
    )


def information_value(woe: DataFrame) -> DataFrame:
    return woe.groupBy("feature").agg(F.sum("iv").alias("iv_raw")).select(
        "feature", F.bround("iv_raw", 6).alias("iv"), iv_flag(F.col("iv_raw")).alias("flag")
    )


def iv_flag(iv: Column) -> Column:
    out = F.when(iv > IV_BANDS[0][1], IV_BANDS[0][0])
    for name, bound in IV_BANDS[1:]:
        out = out.when(iv > bound, name)
    return out.otherwise("Useless")


def iv_screen(df: DataFrame, features: Sequence[str], y: str = "target", bins: dict | None = None) -> DataFrame:
    """Ranking of all features by IV; weak and suspicious ones are not kept."""
    bins = bins or fit_bins(df, features)
    found = information_value(woe_table(bin_table(df, bins, y), totals(df, y)))
    names = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    ranked = names.join(found, "feature", "left").select(
        "feature", F.coalesce("iv", F.lit(0.0)).alias("iv"), F.coalesce("flag", F.lit("Useless")).alias("flag")
    )
    order = Window.orderBy(F.desc("iv"), "feature")  # one row per feature
    return ranked.select(
        F.row_number().over(order).alias("rank"), "feature", "iv", "flag",
        (~F.col("flag").isin("Useless", "Suspicious")).alias("keep"),
    )


def iv_strength_counts(ranking: DataFrame) -> DataFrame:
    return ranking.groupBy("flag").agg(F.count(F.lit(1)).alias("features"))


def bin_label(rule: dict, key: str) -> str:
    """Readable bin: the value itself or the right-closed interval."""
    if rule["kind"] == "value":
        return key
    i, edges = int(key), rule["edges"]
    lo = edges[0] - 0.001 if i == 0 else edges[i]
    return f"({lo:g}, {edges[i + 1]:g}]"


def fit_woe(df: DataFrame, features: Sequence[str], y: str = "target", n: int = 10) -> tuple[dict, DataFrame]:
    """Bins and weights of the kept features: (binning rules, table feature/bin/woe)."""
    bins = fit_bins(df, features, n)
    return bins, woe_table(bin_table(df, bins, y), totals(df, y)).select("feature", "bin", "woe")


def apply_woe(df: DataFrame, bins: dict, weights: DataFrame, suffix: str = "_woe") -> DataFrame:
    """Add one weight column per feature; a bin that was never seen weighs 0.

    Small weight tables become constants in one projection. A text feature with more values
    is joined instead, salted because one value (or a missing one) may hold most rows.
    """
    features = [f for f in bins if f in df.columns]
    weights = weights.persist()  # a row per bin; two jobs read it, which would fit it twice
    sizes = {
        r["feature"]: r["n"]
        for r in weights.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    small = [f for f in features if sizes.get(f, 0) <= LITERAL_BINS]
    rows = weights.filter(F.col("feature").isin(small)).collect() if small else []
    if len(small) == len(features):
        weights.unpersist()
    maps: dict[str, dict] = {f: {} for f in small}
    for r in rows:
        maps[r["feature"]][r["bin"]] = r["woe"]
    out = df.withColumns({
        f + suffix: F.coalesce(_weight(f, bins[f], maps[f]), F.lit(0.0)) for f in small
    })
    for f in features:
        if f in small:
            continue
        table = weights.filter(F.col("feature") == f).select(F.col("bin").alias("_bin"), F.col("woe").alias("_woe"))
        joined = salted_left_join(out.withColumn("_bin", bin_column(f, bins[f])), table, "_bin")
        out = joined.withColumn(f + suffix, F.coalesce("_woe", F.lit(0.0))).drop("_bin", "_woe")
    return out


def _weight(c: str, rule: dict, weights: dict) -> Column:
    if not weights:
        return F.lit(0.0)
    if rule["kind"] == "value":
        if len(weights) <= 20:
            return map_lookup(F.col(c).cast("string"), weights)
        pairs = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        return F.try_element_at(pairs, F.col(c).cast("string"))
    index = qcut_bin(c, rule["edges"])
    return map_lookup(index, {int(k): w for k, w in weights.items()})


MAP_BINS = 10_000


def weight_maps(weights: DataFrame, size: int = MAP_BINS) -> DataFrame:
    """Maps bin -> weight per feature, the form that is written as JSON.

    A feature with many values is split over several maps of about ``size`` entries by a hash
    of the bin, so no map grows with the data.
    """
    sizes = weights.groupBy(F.col("feature").alias("_f")).agg(F.ceil(F.count(F.lit(1)) / size).alias("_parts"))
    parted = weights.join(sizes, F.col("feature") == F.col("_f")).withColumn(
        "part", F.pmod(F.xxhash64("bin"), F.col("_parts")).cast("int")
    )
    return parted.groupBy("feature", "part").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "woe"))).alias("weights")
    )


