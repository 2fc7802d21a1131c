"""Feature engineering: ratios, encodings, imputation, interactions and selection."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_medians, exact_quantiles
from provisio.functions.semantics import (
    clip, col_or, columns_like, flag, map_lookup, ratio, row_argmax, row_mean, row_min, row_product,
    row_std, row_sum, string_columns,
)
from provisio.operators.joins import salted_left_join
from provisio.session import new_path

DAYS_PER_YEAR = 365.0
EXT_SOURCES = ("ext_source_1", "ext_source_2", "ext_source_3")
QUALITY_WEIGHTS = {"bureau_overdue_mean": 0.40, "prev_refused_ratio": 0.35, "inst_late_ratio": 0.25}
HIGH_LTI = 5.0
WEEKDAYS = {
    "MONDAY": "Mon", "TUESDAY": "Tue", "WEDNESDAY": "Wed", "THURSDAY": "Thu", "FRIDAY": "Fri",
    "SATURDAY": "Sat", "SUNDAY": "Sun",
}
WEEKDAY_PREFIX = "weekday_appr_process_start"


def tag_split(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both splits in one table: is_train tag, NULL target on the unlabelled one."""
    unlabelled = test.drop("target").withColumn("target", F.lit(None).cast(train.schema["target"].dataType))
    return train.withColumn("is_train", F.lit(1)).unionByName(
        unlabelled.withColumn("is_train", F.lit(0)), allowMissingColumns=True
    )


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        df.filter("is_train = 1").drop("is_train"),
        df.filter("is_train = 0").drop("is_train", "target"),
    )


def sanitize_columns(df: DataFrame) -> DataFrame:
    names = [re.sub(r"[^A-Za-z0-9_]+", "_", c) for c in df.columns]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("column names collide after cleaning")
    return df.toDF(*names)


def financial_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "credit_income_ratio": ratio("amt_credit", "amt_income_total"),
        "annuity_income_ratio": ratio("amt_annuity", "amt_income_total"),
        "credit_term": ratio("amt_credit", "amt_annuity"),
        "goods_credit_ratio": ratio("amt_goods_price", "amt_credit"),
        "credit_downpayment": F.col("amt_goods_price") - F.col("amt_credit"),
    })


def time_features(df: DataFrame) -> DataFrame:
    years = {
        "age_years": "days_birth", "years_employed": "days_employed",
        "years_id_publish": "days_id_publish", "years_last_phone_change": "days_last_phone_change",
    }
    new = {n: -F.col(c) / DAYS_PER_YEAR for n, c in years.items() if c in df.columns}
    new["days_employed_ratio"] = ratio("days_employed", "days_birth")
    return df.withColumns(new)


def document_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "flag_docs_sum": row_sum(columns_like(df, "flag_document")),
        "cnt_children_ratio": F.col("cnt_children") / clip("cnt_fam_members", 1),
    })


# Encodings


def _distinct_values(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct texts per column; they become columns, so they must fit a schema."""
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cols])
    rows = (
        df.select(F.explode(pairs).alias("e")).filter("e.v is not null")
        .select("e.c", "e.v").distinct().collect()
    )
    out: dict[str, list[str]] = {c: [] for c in cols}
    for c, v in rows:
        out[c].append(v)
    return {c: sorted(vs) for c, vs in out.items()}


def fit_encoding(df: DataFrame, cols: Sequence[str] | None = None, max_values: int = 5000) -> dict:
    """Which text columns are binary (at most two values) and the values of the others.

    A first bounded sketch finds the columns that would become more than about ``max_values`` columns of a schema;
    they are named under ``sparse`` and encoded by ``fit_value_index`` as rows, without a limit.
    """
    cols = list(cols if cols is not None else string_columns(df))
    if not cols:
        return {"binary": {}, "onehot": {}, "sparse": []}
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    wide = [c for c in cols if sizes[c] > max_values]
    cols = [c for c in cols if c not in wide]
    if not cols:
        return {"binary": {}, "onehot": {}, "sparse": wide}
    values = _distinct_values(df, cols)
    missing = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first()
    binary, onehot = {}, {}
    for c in cols:
        if len(values[c]) <= 2:
            # A missing value is the text 'nan' here and takes part in the alphabetical order.
            binary[c] = sorted(values[c] + (["nan"] if missing[c] else []))
        else:
            onehot[c] = values[c]
    return {"binary": binary, "onehot": onehot, "sparse": wide}


def apply_binary(df: DataFrame, state: dict) -> DataFrame:
    return df.withColumns({
        c: map_lookup(F.coalesce(F.col(c), F.lit("nan")), {v: i for i, v in enumerate(values)})
        for c, values in state["binary"].items() if values
    })


def apply_onehot(df: DataFrame, state: dict) -> DataFrame:
    """One 0/1 column per fitted value, all in one projection; missing gives all zeros."""
    keep = [F.col(c) for c in df.columns if c not in state["onehot"]]
    new = [
        F.when(F.col(c) == v, 1.0).otherwise(0.0).alias(f"{c}_{v}")
        for c, values in state["onehot"].items() for v in values
    ]
    return df.select(*keep, *new)


def _entries(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]))


def fit_value_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Position (from 0, by feature and value) of every value of the columns, however many there are.

    Distinct values are sorted by range; a range adds the number of values before it (one row per partition).
    """
    spark = df.sparkSession
    found = df.select(_entries(df, cols).alias("e")).select("e.*").filter("value is not null").distinct()
    path = new_path(spark, "value-index")
    ranged = found.repartitionByRange("feature", "value").sortWithinPartitions("feature", "value")
    ranged.withColumn("id", F.monotonically_increasing_id()).write.parquet(path)
    part, place = F.shiftrightunsigned("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    local = spark.read.parquet(path).select("feature", "value", part.alias("part"), place.alias("place"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = local.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return local.join(F.broadcast(starts), "part").select("feature", "value", (F.col("start") + F.col("place")).alias("position"))


def sparse_entries(df: DataFrame, index: DataFrame, cols: Sequence[str], key: str = "sk_id_curr") -> DataFrame:
    """One row (key, position, 1.0) per value that the index knows: the one-hot matrix without its zeros."""
    rows = df.select(key, _entries(df, cols).alias("entry")).filter("entry.value is not null")
    table = index.select(F.struct("feature", "value").alias("entry"), "position")
    found = salted_left_join(rows, table, "entry")  # a value may be in most rows
    return found.filter("position is not null").select(key, "position", F.lit(1.0).alias("hot"))


def sparse_rows(df: DataFrame, index: DataFrame, cols: Sequence[str], key: str = "sk_id_curr") -> DataFrame:
    """The positions of each row as one ascending array (at most one for each column); rows without a known value have none."""
    hot = sparse_entries(df, index, cols, key).groupBy(key).agg(F.sort_array(F.collect_list("position")).alias("positions"))
    none = F.array().cast("array<bigint>")
    return df.select(key).join(hot, key, "left").withColumn("positions", F.coalesce("positions", none))


def fit_median(train: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return exact_medians(train, cols)


def apply_median(df: DataFrame, medians: dict) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items() if m is not None
    })


# Interactions


def interactions(df: DataFrame) -> DataFrame:
    docs = columns_like(df, "flag_document")
    total = row_sum(docs) if docs else col_or(df, "flag_docs_sum", 0.0)
    return df.withColumns({
        "stress_age_x_credit": F.col("age_years") * F.col("credit_income_ratio"),
        "stress_emp_x_annuity": clip("years_employed", 0.0) * F.col("annuity_income_ratio"),
        "stress_docs_x_credit": total * F.col("credit_income_ratio"),
    })


def fit_quality(df: DataFrame, c: str = "bureau_overdue_mean", q: float = 0.99) -> float:
    """99th percentile of the mean overdue amount, floored at zero (state of the composite)."""
    if c not in df.columns:
        return 0.0
    floored = df.select(clip(F.col(c).cast("double"), 0.0).alias(c))
    return exact_quantiles(floored, {c: [q]})[c][0] or 0.0


def quality_composite(df: DataFrame, scale: float) -> DataFrame:
    overdue = clip(clip(col_or(df, "bureau_overdue_mean", 0.0), 0.0) / F.lit(scale + 1e-6), 0.0, 1.0)
    refused = clip(col_or(df, "prev_refused_ratio", 0.0), 0.0, 1.0)
    late = clip(col_or(df, "inst_late_ratio", 0.0), 0.0, 1.0)
    w = list(QUALITY_WEIGHTS.values())
    return df.withColumn(
        "bureau_quality_composite", (1 - overdue) * w[0] + (1 - refused) * w[1] + (1 - late) * w[2]
    )


def clean_bureau_high_lti(df: DataFrame) -> DataFrame:
    clean = col_or(df, "bureau_bad_debt_flag", 0) == 0
    return df.withColumn("clean_bureau_high_lti", flag(clean & (F.col("credit_income_ratio") > HIGH_LTI)))


def ext_source_stats(df: DataFrame, cols: Sequence[str] = EXT_SOURCES) -> DataFrame:
    cols = [c for c in cols if c in df.columns]
    if len(cols) < 2:
        return df
    return df.withColumns({
        "ext_source_mean": row_mean(cols), "ext_source_min": row_min(cols),
        "ext_source_product": row_product(cols), "ext_source_std": row_std(cols),
    })


# Selection


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("feature"), F.var_samp(F.col(c).cast("double")).alias("variance"))
        for c in cols
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def fit_low_variance(df: DataFrame, cols: Sequence[str], limit: float = 0.01) -> list[str]:
    low = {r["feature"] for r in variances(df, cols).filter(F.col("variance") < limit).collect()}
    return [c for c in cols if c in low]


FLAT = 1e-3  # variance, as a share of the second moment, below which sums of floats do not settle r
PAIRS = 100  # pairs of columns in one aggregate


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson r of each pair of columns over the rows that have both; NaN if one is constant there.

    One pass for any number of columns: a row becomes the vector of its standardised values, of their squares
    and of its presence marks, and Spark sums the outer products block by block and merges them in a tree. The
    parts of that matrix hold count, sums, squares and products of every pair. Where a column hardly varies over
    the rows of a pair, the difference of such sums is rounding that grows with the rows, and these few pairs are
    computed from their own moments.
    """
    k = len(cols)
    if not k:
        return np.zeros((0, 0))
    x = [F.col(c).cast("double") for c in cols]
    scale = df.agg(F.array(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")) for c in x]).alias("r")).first()["r"]
    values = [
        F.coalesce((c - F.lit(r["m"])) / F.lit(r["s"]), F.lit(0.0)) if r["s"] else F.lit(0.0) for c, r in zip(x, scale)
    ]
    marks = [c.isNotNull().cast("double") for c in x]
    v = F.array(*values)
    stacked = df.select(array_to_vector(F.concat(v, F.transform(v, lambda a: a * a), F.array(*marks))).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(stacked, "v")).computeGramianMatrix().toArray()
    n, sums, squares, products = gram[2 * k :, 2 * k :], gram[:k, 2 * k :], gram[k : 2 * k, 2 * k :], gram[:k, :k]
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = squares - sums * sums / n
        flat = spread <= FLAT * squares
        spread = np.where(flat, np.nan, spread)
        r = (products - sums * sums.T / n) / np.sqrt(spread * spread.T)
    _flat_pairs(df, cols, r, flat | flat.T)
    np.fill_diagonal(r, 1.0)
    return np.clip(r, -1.0, 1.0)


def _flat_pairs(df: DataFrame, cols: Sequence[str], r: np.ndarray, flat: np.ndarray) -> None:
    """Fill in r of the marked pairs, a bounded number of them in one aggregate."""
    pairs = [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(flat, 1)))]
    for start in range(0, len(pairs), PAIRS):
        part = pairs[start : start + PAIRS]
        found = df.agg(F.array(*[safe_corr(F.col(cols[i]), F.col(cols[j])) for i, j in part]).alias("r")).first()["r"]
        for (i, j), value in zip(part, found):
            r[i, j] = r[j, i] = np.nan if value is None else value


def fit_correlated(df: DataFrame, cols: Sequence[str], limit: float = 0.95) -> list[str]:
    """Columns whose absolute correlation with any earlier column is above the limit."""
    r = np.abs(correlation_matrix(df, cols))
    return [c for j, c in enumerate(cols) if np.nanmax(np.append(r[:j, j], 0.0)) > limit]


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    r = correlation_matrix(df, cols)
    rows = [
        (cols[i], cols[j], None if np.isnan(r[i, j]) else float(r[i, j]))
        for j in range(len(cols)) for i in range(j)
    ]
    return df.sparkSession.createDataFrame(rows, "left_feature string, right_feature string, r double")


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r from moments over the rows where both are present; NULL if one is constant.

    Merged deviations of equal values need not be exactly 0, so the extremes tell whether a column is constant.
    """
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when(varies, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def target_correlation(df: DataFrame, cols: Sequence[str], y: str = "target", k: int | None = 20) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("feature"), F.abs(safe_corr(F.col(c), F.col(y))).alias("abs_r")) for c in cols
    ]
    out = df.agg(F.array(*rows).alias("r")).select(F.inline("r")).orderBy(F.desc_nulls_last("abs_r"), "feature")
    return out.limit(k) if k else out


def output_checks(df: DataFrame) -> DataFrame:
    train = F.col("is_train") == 1
    return df.agg(
        F.count_if(train).alias("train_rows"), F.count_if(~train).alias("test_rows"),
        F.count_if(train & F.col("target").isNull()).alias("missing_targets"),
    )


def assert_outputs(df: DataFrame, train_rows: int | None = None, test_rows: int | None = None) -> DataFrame:
    row = output_checks(df).first()
    wrong = {
        k: row[k]
        for k, want in (("train_rows", train_rows), ("test_rows", test_rows), ("missing_targets", 0))
        if want is not None and row[k] != want
    }
    if wrong:
        raise ValueError(f"unexpected output: {wrong}")
    return df


def decode_weekday(df: DataFrame, name: str = "weekday") -> DataFrame:
    """Label of the hot weekday column (first one wins ties); anything else is 'Unknown'."""
    cols = [c for c in df.columns if c.lower().startswith(WEEKDAY_PREFIX + "_")]
    if not cols:
        return df.withColumn(name, F.lit("Unknown"))
    raw = F.upper(F.regexp_replace(row_argmax(cols), f"(?i)^{WEEKDAY_PREFIX}_", ""))
    return df.withColumn(name, map_lookup(raw, WEEKDAYS, "Unknown"))


def engineer(app: DataFrame) -> DataFrame:
    return document_features(time_features(financial_ratios(app)))
