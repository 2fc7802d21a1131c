"""Per-client aggregates of the five history tables.

Each is one grouped aggregation of plain sums, counts, means and extremes. Spark merges rows
of a client before the shuffle, so a client with very many rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.functions.semantics import count_where, flag, ratio, sum0
from provisio.operators.audit import missing_rates

KEY = "sk_id_curr"


def _is(c: str, value: str):
    return count_where(F.col(c) == value)


def bureau_features(bureau: DataFrame, key: str = KEY) -> DataFrame:
    base = bureau.groupBy(key).agg(
        F.count("sk_id_bureau").alias("bureau_loan_count"),
        _is("credit_active", "Active").alias("bureau_active_count"),
        _is("credit_active", "Closed").alias("bureau_closed_count"),
        sum0("amt_credit_sum").alias("bureau_credit_sum"),
        F.avg("amt_credit_sum").alias("bureau_credit_mean"),
        F.max("amt_credit_sum").alias("bureau_credit_max"),
        sum0("amt_credit_sum_debt").alias("bureau_debt_sum"),
        F.avg("amt_credit_sum_overdue").alias("bureau_overdue_mean"),
        F.max("amt_credit_sum_overdue").alias("bureau_overdue_max"),
        F.avg("days_credit").alias("bureau_days_credit_mean"),
        F.max("days_credit_enddate").alias("bureau_days_enddate_max"),
        count_where(F.col("credit_day_overdue") > 0).alias("bureau_bad_debt_count"),
        F.max("credit_day_overdue").alias("bureau_overdue_days_max"),
        F.coalesce(F.sum("cnt_credit_prolong"), F.lit(0)).alias("bureau_prolong_sum"),
    )
    return base.withColumns({
        "bureau_bad_debt_flag": flag(F.col("bureau_bad_debt_count") > 0),
        "bureau_active_ratio": ratio("bureau_active_count", "bureau_loan_count"),
        "bureau_debt_credit_ratio": ratio("bureau_debt_sum", "bureau_credit_sum"),
    })


def previous_features(prev: DataFrame, key: str = KEY) -> DataFrame:
    base = prev.groupBy(key).agg(
        F.count("sk_id_prev").alias("prev_app_count"),
        _is("name_contract_status", "Approved").alias("prev_approved_count"),
        _is("name_contract_status", "Refused").alias("prev_refused_count"),
        _is("name_contract_status", "Canceled").alias("prev_canceled_count"),
        F.avg("amt_credit").alias("prev_credit_mean"),
        F.max("amt_credit").alias("prev_credit_max"),
        F.avg("amt_annuity").alias("prev_annuity_mean"),
        F.avg("amt_down_payment").alias("prev_down_payment_mean"),
        F.avg("days_decision").alias("prev_days_decision_mean"),
        _is("name_contract_type", "Consumer loans").alias("prev_consumer_count"),
        _is("name_contract_type", "Cash loans").alias("prev_cash_count"),
        _is("name_contract_type", "Revolving loans").alias("prev_revolving_count"),
    )
    return base.withColumns({
        f"prev_{n}_ratio": ratio(f"prev_{n}_count", "prev_app_count")
        for n in ("refused", "approved", "canceled", "consumer")
    })


def instalment_features(inst: DataFrame, key: str = KEY) -> DataFrame:
    """Aggregates of the cleaned instalments; of a frame without the amounts, those of the days alone."""
    late = F.col("days_past_due")
    diffs = [
        F.avg("payment_diff").alias("inst_payment_diff_mean"),
        F.max("payment_diff").alias("inst_payment_diff_max"),
        sum0("payment_diff").alias("inst_payment_diff_sum"),
    ]
    amounts = [
        F.avg("amt_payment").alias("inst_amt_payment_mean"),
        F.avg("amt_instalment").alias("inst_amt_instalment_mean"),
    ]
    if "payment_diff" not in inst.columns:
        diffs, amounts = [], []
    base = inst.groupBy(key).agg(
        *diffs,
        F.avg(late).alias("inst_days_past_due_mean"),
        F.max(late).alias("inst_days_past_due_max"),
        count_where(late > 0).alias("inst_late_payment_count"),
        count_where(late == 0).alias("inst_on_time_count"),
        F.count(late).alias("inst_total_count"),
        *amounts,
    )
    return base.withColumn("inst_late_ratio", ratio("inst_late_payment_count", "inst_total_count"))


def pos_features(pos: DataFrame, key: str = KEY) -> DataFrame:
    base = pos.groupBy(key).agg(
        F.avg("sk_dpd").alias("pos_dpd_mean"),
        F.max("sk_dpd").alias("pos_dpd_max"),
        F.avg("sk_dpd_def").alias("pos_dpd_def_mean"),
        F.max("sk_dpd_def").alias("pos_dpd_def_max"),
        F.count("months_balance").alias("pos_months_count"),
        F.avg("cnt_instalment").alias("pos_cnt_instalment_mean"),
        _is("name_contract_status", "Active").alias("pos_active_count"),
        _is("name_contract_status", "Completed").alias("pos_completed_count"),
        count_where(F.col("sk_dpd") > 0).alias("pos_late_count"),
    )
    return base.withColumns({
        "pos_completed_ratio": ratio("pos_completed_count", "pos_months_count"),
        "pos_late_ratio": ratio("pos_late_count", "pos_months_count"),
    })


def card_features(card: DataFrame, key: str = KEY) -> DataFrame:
    base = card.groupBy(key).agg(
        F.avg("amt_balance").alias("cc_balance_mean"),
        F.max("amt_balance").alias("cc_balance_max"),
        F.avg("amt_credit_limit_actual").alias("cc_limit_mean"),
        F.max("amt_credit_limit_actual").alias("cc_limit_max"),
        F.avg("utilization_ratio").alias("cc_utilization_mean"),
        F.max("utilization_ratio").alias("cc_utilization_max"),
        F.avg("sk_dpd").alias("cc_dpd_mean"),
        F.max("sk_dpd").alias("cc_dpd_max"),
        F.avg("sk_dpd_def").alias("cc_dpd_def_mean"),
        F.count("months_balance").alias("cc_months_count"),
        F.avg("amt_drawings_current").alias("cc_drawings_mean"),
        F.max("amt_drawings_current").alias("cc_drawings_max"),
        F.avg("amt_payment_current").alias("cc_payment_mean"),
        count_where(F.col("sk_dpd") > 0).alias("cc_late_count"),
    )
    return base.withColumn("cc_late_ratio", ratio("cc_late_count", "cc_months_count"))


def card_preview(card: DataFrame, key: str = KEY) -> DataFrame:
    """Reduced card aggregate of the audit, with balance / (limit + 1) as utilisation."""
    used = F.col("amt_balance") / (F.col("amt_credit_limit_actual") + 1)
    return card.groupBy(key).agg(
        F.avg("amt_balance").alias("cc_balance_mean"),
        F.max("amt_balance").alias("cc_balance_max"),
        F.avg("amt_credit_limit_actual").alias("cc_limit_mean"),
        F.avg(used).alias("cc_utilization_mean"),
        F.max(used).alias("cc_utilization_max"),
        F.avg("sk_dpd").alias("cc_dpd_mean"),
        F.max("sk_dpd").alias("cc_dpd_max"),
        F.count("months_balance").alias("cc_months_count"),
    )


def history_missing(joined: DataFrame, agg_cols: Sequence[str], k: int = 10) -> DataFrame:
    """Missing share of the history columns after the join (clients without history), top k."""
    return missing_rates(joined.select(*agg_cols)).filter("missing_rate > 0").limit(k)


def fill_history(joined: DataFrame, agg_cols: Sequence[str]) -> DataFrame:
    return joined.fillna(0, subset=list(agg_cols))
