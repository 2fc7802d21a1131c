"""Cleaning rules: sentinels, recodes, imputation, caps and derived payment columns.

Every data-dependent rule is a pair: a ``fit_*`` step that runs one or two aggregates and
returns a small dictionary, and a projection that applies it. Fit on the training split.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_medians, exact_quantiles
from provisio.functions.semantics import (
    as_col, clip, columns_like, flag, numeric_columns, sum0, string_columns,
)

SENTINEL_DAYS = 365243
PROTECTED = ("ext_source_1", "ext_source_2", "ext_source_3")
SPARSE_LIMIT = 0.40

# Caps of the applicant table.
APPLICATION_CAPS = {
    "amt_req_credit_bureau_qrt": 12,
    "def_30_cnt_social_circle": 20,
    "def_60_cnt_social_circle": 20,
    "obs_30_cnt_social_circle": 100,
    "obs_60_cnt_social_circle": 100,
}
OVERDUE_CAP_DAYS = 365
UTILIZATION_CAP = 2.0
SENTINEL_COLUMNS = (
    "days_first_drawing", "days_first_due", "days_last_due_1st_version", "days_last_due",
    "days_termination",
)
INSTALMENT_AMOUNTS = ("amt_instalment", "amt_payment")
INSTALMENT_DAYS = ("days_instalment", "days_entry_payment")
INSTALMENT_COLUMNS = (*INSTALMENT_AMOUNTS, *INSTALMENT_DAYS)
CARD_ZERO_COLUMNS = (
    "amt_drawings_atm_current", "amt_drawings_current", "amt_drawings_other_current",
    "amt_drawings_pos_current", "cnt_drawings_atm_current", "cnt_drawings_other_current",
    "cnt_drawings_pos_current", "amt_payment_current", "amt_inst_min_regularity",
    "cnt_instalment_mature_cum",
)
BUREAU_ZERO_COLUMNS = (
    "amt_credit_max_overdue", "days_enddate_fact", "amt_credit_sum_debt",
    "amt_credit_sum_limit", "amt_credit_sum_overdue",
)


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Replace or append columns in one projection."""
    return df.withColumns(new) if new else df


def _existing(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in cols if c.lower() in have]


# Sentinels and recodes


def null_sentinel(df: DataFrame, c: str, value=SENTINEL_DAYS, indicator: str = "emp_anomaly") -> DataFrame:
    return _replace(df, {indicator: flag(F.col(c) == value), c: F.nullif(F.col(c), F.lit(value))})


def null_sentinels(df: DataFrame, cols: Sequence[str] = SENTINEL_COLUMNS, value=SENTINEL_DAYS) -> DataFrame:
    return _replace(df, {c: F.nullif(F.col(c), F.lit(value)) for c in _existing(df, cols)})


def recode(df: DataFrame, c: str, mapping: dict[str, str]) -> DataFrame:
    return df.replace(mapping, subset=[c])


# Sparse columns


def missing_share(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(flag(F.col(c).isNull())).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fit_sparse_columns(df: DataFrame, limit: float = SPARSE_LIMIT, keep: Sequence[str] = PROTECTED) -> list[str]:
    return [c for c, m in missing_share(df).items() if m is not None and m > limit and c not in keep]


# Imputation


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """Fill missing values; numbers are filled as doubles so that no median is truncated."""
    new = {}
    for c, v in values.items():
        if v is None or c not in df.columns:
            continue
        value = F.col(c) if isinstance(v, str) else F.col(c).cast("double")
        new[c] = F.coalesce(value, F.lit(v))
    return _replace(df, new)


def fill_constant(df: DataFrame, cols: Sequence[str], value=0.0) -> DataFrame:
    return fill_values(df, {c: float(value) for c in _existing(df, cols)})


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return exact_medians(df, _existing(df, cols))


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fill_values(df, fit_medians(df, cols))


def missing_days_columns(df: DataFrame) -> list[str]:
    days = columns_like(df, "days_")
    return [c for c, m in missing_share(df, days).items() if m] if days else []


def fit_modes(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """Most frequent value per text column; the smallest one wins ties.

    Value counts are aggregated before the shuffle and stay distributed; only one row per
    column comes back.
    """
    cols = list(cols if cols is not None else string_columns(df))
    if not cols:
        return {}
    entries = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols]
    counts = (
        df.select(F.explode(F.array(*entries)).alias("e")).select("e.c", "e.v").filter("v is not null")
        .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    rows = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v")).collect()
    return {r["c"]: r["v"] for r in rows}


def fill_mode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return fill_values(df, fit_modes(df, cols))


def fit_remaining_medians(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, float | None]:
    """Medians of all numeric columns that have missing values, from one combined fit."""
    cols = [c for c in numeric_columns(df) if c not in exclude]
    gaps = [c for c, m in missing_share(df, cols).items() if m] if cols else []
    return exact_medians(df, gaps)


def fill_median(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return fill_values(df, fit_remaining_medians(df, exclude))


def zero_to_null(df: DataFrame, c: str) -> DataFrame:
    return _replace(df, {c: F.nullif(F.col(c), F.lit(0))})


def zero_as_missing(df: DataFrame, c: str) -> DataFrame:
    """Zero means missing: median over the non-zero values fills zeros and gaps."""
    return impute_median(zero_to_null(df, c), [c])


# Caps


def fit_quantile_cap(df: DataFrame, c: str, q: float = 0.99) -> float | None:
    return exact_quantiles(df, {c: [q]})[c][0]


def cap(df: DataFrame, caps: dict[str, float]) -> DataFrame:
    new = {c: clip(c, None, F.lit(v).cast(df.schema[c].dataType)) for c, v in caps.items() if c in df.columns}
    return _replace(df, new)


def cap_quantile(df: DataFrame, c: str, q: float = 0.99) -> DataFrame:
    limit = fit_quantile_cap(df, c, q)
    return df if limit is None else _replace(df, {c: clip(F.col(c).cast("double"), None, limit)})


def clamp(df: DataFrame, c: str, lo=None, hi=None) -> DataFrame:
    return _replace(df, {c: clip(c, lo, hi)})


# Derived payment columns


def payment_diff(instalment="amt_instalment", payment="amt_payment") -> Column:
    return as_col(instalment) - as_col(payment)


def days_past_due(entry="days_entry_payment", due="days_instalment") -> Column:
    return clip(as_col(entry) - as_col(due), 0.0)


def utilization(balance="amt_balance", limit="amt_credit_limit_actual", top: float = UTILIZATION_CAP) -> Column:
    used = F.when(as_col(limit) > 0, as_col(balance) / as_col(limit))
    return F.coalesce(clip(used, None, top), F.lit(0.0))


# Gates and reports


def incomplete_columns(df: DataFrame) -> dict[str, int]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return {c: row[c] for c in df.columns if row[c]}


def fill_gaps(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Medians for numbers, most frequent values (else 'Unknown') for texts."""
    texts = [c for c in string_columns(df) if c in cols]
    values: dict = exact_medians(df, [c for c in numeric_columns(df) if c in cols])
    modes = fit_modes(df, texts)
    values.update({c: modes.get(c, "Unknown") for c in texts})
    return fill_values(df, values)


def require_complete(df: DataFrame) -> DataFrame:
    """Force-fill the columns that still have gaps, then raise if any is left."""
    gaps = incomplete_columns(df)
    if gaps:
        df = fill_gaps(df, list(gaps))
        gaps = incomplete_columns(df)
    if gaps:
        raise ValueError(f"missing values left: {gaps}")
    return df


FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def written_gaps(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """Rows of a written Parquet table and the missing values of each column, from the counts in the files' footers.

    Counts are pushed down to the footers, so the gate behind a write reads no column again.
    """
    before = {k: spark.conf.get(k, None) for k in FOOTERS}
    for k, v in FOOTERS.items():
        spark.conf.set(k, v)
    try:
        df = spark.read.parquet(path)
        cols = list(cols if cols is not None else df.columns)
        found = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return found["rows"], {c: found["rows"] - found[f"n{i}"] for i, c in enumerate(cols)}


def require_written(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> int:
    """Rows of a written table; raises if a column has gaps."""
    rows, missing = written_gaps(spark, path, cols)
    gaps = {c: n for c, n in missing.items() if n}
    if gaps:
        raise ValueError(f"missing values left: {gaps}")
    return rows


def completeness_report(df: DataFrame) -> DataFrame:
    """Missing values per column, one row per column, from one aggregate."""
    return df.agg(
        F.array(*[F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("missing"))
                  for c in df.columns]).alias("r")
    ).select(F.inline("r"))


def _shape_row(df: DataFrame, stage: str) -> DataFrame:
    gaps = [F.avg(flag(F.col(c).isNull())) for c in df.columns]
    total = sum(gaps[1:], gaps[0])
    return df.agg(
        F.lit(stage).alias("stage"), F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        (total / F.lit(float(len(df.columns)))).alias("missing_rate"),
    )


def cleaning_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    return _shape_row(before, "before").unionByName(_shape_row(after, "after"))


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows and share of rows that satisfy each rule; all rules in one pass."""
    return df.agg(
        F.array(*[
            F.struct(F.lit(n).alias("rule"), F.count_if(p).alias("row_count"),
                     F.avg(F.when(p, 1.0).otherwise(0.0)).alias("row_share"))
            for n, p in rules.items()
        ]).alias("r")
    ).select(F.inline("r"))


def split_total(df: DataFrame, c: str):
    return df.agg(sum0(c)).first()[0]


# Whole-table cleaning


def fit_application(train: DataFrame) -> dict:
    """State of the applicant cleaning: dropped columns, cap, medians and modes of train."""
    df = recode(null_sentinel(train, "days_employed"), "code_gender", {"XNA": "Unknown"})
    shares = missing_share(df)
    dropped = [c for c, m in shares.items() if m is not None and m > SPARSE_LIMIT and c not in (*PROTECTED, "target")]
    df = df.drop(*dropped)
    df = cap(df, APPLICATION_CAPS)
    fixed = ("sk_id_curr", "target", "is_train", "emp_anomaly")
    # Flags stay whole numbers where none is missing.
    amounts = [c for c in numeric_columns(df) if c not in fixed and (shares[c] or not c.startswith("flag_"))]
    # Capping the income at its p99 does not move its median, so one fit gives both.
    found = exact_quantiles(df, {c: [0.5, 0.99] if c == "amt_income_total" else [0.5] for c in amounts})
    return {
        "dropped": dropped, "income_cap": found["amt_income_total"][1], "modes": fit_modes(df),
        "medians": {c: q[0] for c, q in found.items()},
    }


def clean_application(df: DataFrame, state: dict) -> DataFrame:
    df = recode(null_sentinel(df, "days_employed"), "code_gender", {"XNA": "Unknown"})
    df = cap(df.drop(*state["dropped"]), APPLICATION_CAPS)
    df = _replace(df, {"amt_income_total": clip(F.col("amt_income_total").cast("double"), None, state["income_cap"])})
    return fill_values(df, {**state["medians"], **state["modes"]})


def clean_bureau(df: DataFrame) -> DataFrame:
    df = fill_constant(df.drop("amt_annuity"), BUREAU_ZERO_COLUMNS)
    df = zero_to_null(cap(df, {"credit_day_overdue": OVERDUE_CAP_DAYS}), "amt_credit_sum")
    return impute_median(df, ["amt_credit_sum", "days_credit_enddate"])


def clean_previous(df: DataFrame) -> DataFrame:
    df = null_sentinels(df.drop("rate_interest_primary", "rate_interest_privileged"))
    if "amt_down_payment" in df.columns:
        df = fill_constant(clamp(df, "amt_down_payment", 0.0), ["amt_down_payment"])
    df = fill_mode(fill_median(df))
    if "rate_down_payment" in df.columns:
        df = clamp(fill_constant(df, ["rate_down_payment"]), "rate_down_payment", 0.0, 1.0)
    return df


def clean_instalments(df: DataFrame) -> DataFrame:
    """Gaps filled and differences added; of a frame without the amounts, the days alone."""
    df = impute_median(df, ["days_entry_payment", "amt_payment"])
    new = {"days_past_due": days_past_due()}
    if len(_existing(df, INSTALMENT_AMOUNTS)) == len(INSTALMENT_AMOUNTS):
        new = {"payment_diff": payment_diff(), **new}
    return _replace(df, new)


def clean_pos(df: DataFrame) -> DataFrame:
    df = cap(df, {"sk_dpd": OVERDUE_CAP_DAYS, "sk_dpd_def": OVERDUE_CAP_DAYS})
    df = impute_median(df, ["cnt_instalment", "cnt_instalment_future"])
    return recode(df, "name_contract_status", {"XNA": "Unknown"})


def clean_card(df: DataFrame) -> DataFrame:
    df = fill_constant(df, CARD_ZERO_COLUMNS)
    df = cap(df, {"sk_dpd": OVERDUE_CAP_DAYS, "sk_dpd_def": OVERDUE_CAP_DAYS})
    return _replace(df, {"utilization_ratio": utilization()})
