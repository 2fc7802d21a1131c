"""Joins of applicants with their history, scores and raw text columns.

Histories are aggregated to one row per key before they are joined, so no join multiplies
rows and no join sees a hot key. Sides are broadcast only when Spark's own size check allows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_medians
from provisio.functions.semantics import map_lookup
from provisio.session import write_once

KEY = "sk_id_curr"


def join_history(app: DataFrame, aggs: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    return reduce(lambda df, agg: df.join(agg, key, "left"), aggs, app)


def unique_key_report(df: DataFrame, key: str = KEY) -> DataFrame:
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def assert_unique_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """The row-count check of the joins: a right side with a unique key cannot add rows."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"{key} is not unique: {[r[0] for r in repeated]}")
    return df


def enrich_inner(df: DataFrame, other: DataFrame, key: str = KEY) -> DataFrame:
    new = [c for c in other.columns if c not in df.columns]
    return df.join(other.select(key, *new), key, "inner")


def attach_text(df: DataFrame, raw: DataFrame, cols: Sequence[str], key: str = KEY, suffix: str = "_raw") -> DataFrame:
    """Left join of raw columns; a name already taken gets a suffix."""
    picked = [F.col(c).alias(c + suffix if c in df.columns else c) for c in cols]
    return df.join(raw.select(key, *picked), key, "left")


def ensure_columns(df: DataFrame, src: DataFrame, cols: Sequence[str], key: str = KEY) -> DataFrame:
    """Add the listed columns that are missing, if the source has them."""
    wanted = [c for c in cols if c not in df.columns and c in src.columns]
    return df.join(src.select(key, *wanted), key, "left") if wanted else df


def ead_lookup(df: DataFrame, features: DataFrame, key: str = KEY, amount: str = "amt_credit") -> DataFrame:
    """Amount of each loan looked up by key; gaps get the median of the looked-up amounts."""
    joined = df.drop(amount).join(features.select(key, amount), key, "left")
    amounts = write_once(joined.select(amount), "amounts")  # the fit passes over the values, not over the join
    median = exact_medians(amounts, [amount])[amount]
    return joined.withColumn(amount, F.coalesce(F.col(amount).cast("double"), F.lit(median)))


def predictions_with_application(p: DataFrame, a: DataFrame, key: str = KEY) -> DataFrame:
    return p.join(a, key, "inner")


def left_join_version(a: DataFrame, f: DataFrame, p: DataFrame, version: str, key: str = KEY) -> DataFrame:
    """Left joins; the version condition belongs to the join, so it filters the right side."""
    return a.join(f, key, "left").join(p.filter(F.col("model_version") == version), key, "left")


SALT_ROWS = 1_000_000  # rows of one key in one task


def salted_left_join(df: DataFrame, table: DataFrame, key: str, rows: int = SALT_ROWS) -> DataFrame:
    """Left join of rows with hot (or missing) keys to a table with a unique key.

    The rows of each key are counted first. A key with more than ``rows`` rows is spread over as many salts as it
    fills tasks, by a hash of the whole row, and only its entry in the table is repeated, once per salt; all other
    keys stay as they are. Rows without a key cannot match and do not take part in the join. There is at most one hot
    key for every ``rows`` rows, so the table of hot keys is a small fraction of the data.
    """
    hashable = [c for c, t in df.dtypes if not t.startswith("map")]
    known = df.filter(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > rows).select(key, F.ceil(F.col("_n") / rows).cast("int").alias("_salts"))
    salt = F.pmod(F.xxhash64(*hashable), F.coalesce("_salts", F.lit(1))).cast("int")
    salted = known.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    entries = table.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    joined = salted.join(entries, [key, "_salt"], "left").drop("_salt")
    added = [F.lit(None).cast(t).alias(c) for c, t in table.dtypes if c != key]
    missing = df.filter(F.col(key).isNull()).select("*", *added)
    return joined.unionByName(missing).select(*df.columns, *[c for c in table.columns if c != key])


def lookup(df: DataFrame, c: str, mapping: DataFrame, key: str, value: str, default=None, hot: bool = False) -> DataFrame:
    """Replace-by-table: value of the matching key, else the default.

    A small table is broadcast by Spark's own size check; ``hot`` salts the join with a large
    table when a few keys hold most rows.
    """
    table = mapping.select(F.col(key).alias(c), value)
    out = salted_left_join(df, table, c) if hot else df.join(table, c, "left")
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def lookup_constant(c, mapping: dict, default=None) -> Column:
    return map_lookup(c, mapping, default)


def orphans(child: DataFrame, parent: DataFrame, key: str = KEY) -> DataFrame:
    """Child rows without a parent, counted per key; empty when the reference holds."""
    return (
        child.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
        .join(parent.select(key), key, "left_anti")
    )
