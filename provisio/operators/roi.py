"""Approval threshold sweep, decisions and credit bands."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_quantiles
from provisio.functions.semantics import bin_index, distinct_edges, map_lookup, qcut_bin, safe_div

MILLION = 1e6


@dataclass(frozen=True)
class ProfitRates:
    """Shares of the loan amount."""
    margin: float = 0.035
    loss: float = 0.65
    opportunity: float = 0.015
    opex: float = 0.002


def threshold_grid(n: int = 100, lo: float = 0.01, hi: float = 0.99) -> list[float]:
    step = (hi - lo) / (n - 1)
    return [lo + i * step for i in range(n - 1)] + [hi]


def confusion_sweep(df: DataFrame, grid: list[float], y: str = "target", p: str = "pred_prob",
                    amount: str | None = None) -> DataFrame:
    """Confusion counts at every threshold, and the mean amount, from one pass.

    Each score is reduced to the number of thresholds not above it; those counts (at most
    one row per threshold, one below and one without score) are then summed from both ends.
    """
    scored = F.col(p).isNotNull()
    aggs = [F.count_if((F.col(y) == 1) & scored).alias("pos"), F.count_if((F.col(y) == 0) & scored).alias("neg")]
    if amount:
        aggs += [F.sum(F.col(amount).cast("double")).alias("s"), F.count(amount).alias("n")]
    counts = df.groupBy(bin_index(p, grid, right_closed=False).alias("b")).agg(*aggs)
    thresholds = df.sparkSession.range(1, len(grid) + 1).select(
        F.col("id").cast("int").alias("b"),
        F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("id").cast("int")).alias("threshold"),
    )
    # The outer join keeps bin 0 (below the first threshold) and thresholds without a score.
    full = thresholds.join(counts, "b", "full").fillna(0, ["pos", "neg"])
    order = F.asc_nulls_first("b")
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    out = [
        "threshold", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
        F.coalesce(F.sum("pos").over(upto), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(upto), F.lit(0)).alias("tn"),
    ]
    if amount:
        out.append(F.try_divide(F.sum("s").over(whole), F.sum("n").over(whole)).alias("mean_amount"))
    return full.select(*out).filter(F.col("threshold").isNotNull())


def profit_columns(sweep: DataFrame, amount: Column, rates: ProfitRates = ProfitRates()) -> DataFrame:
    """P&L of each row of confusion counts for one mean loan amount, in millions."""
    approved = F.col("tn") + F.col("fn")
    return (
        sweep.withColumns({
            "revenue_m": F.col("tn") * rates.margin * amount / MILLION,
            "opp_cost_m": F.col("fp") * rates.opportunity * amount / MILLION,
            "loan_loss_m": F.col("fn") * rates.loss * amount / MILLION,
            "opex_m": approved * rates.opex * amount / MILLION,
            "approval_rate": approved / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
        })
        .withColumn(
            "net_profit_m", F.col("revenue_m") - F.col("opp_cost_m") - F.col("loan_loss_m") - F.col("opex_m")
        )
    )


def threshold_sweep(df: DataFrame, rates: ProfitRates = ProfitRates(), grid: list[float] | None = None,
                    amount: str = "amt_credit") -> DataFrame:
    sweep = confusion_sweep(df, grid or threshold_grid(), amount=amount)
    return profit_columns(sweep, F.col("mean_amount"), rates).drop("mean_amount")


def approval_quality(sweep: DataFrame) -> DataFrame:
    return sweep.select(
        "threshold",
        safe_div(F.col("tn"), F.col("tn") + F.col("fn"), 0.0).alias("approval_precision"),
        safe_div(F.col("tn"), F.col("tn") + F.col("fp"), 0.0).alias("approval_recall"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Row with the largest profit; the lowest threshold wins ties."""
    return sweep.orderBy(F.desc("net_profit_m"), "threshold").limit(1)


def decision(df: DataFrame, t: float, p: str = "pred_prob") -> DataFrame:
    return df.withColumn("decision_status", F.when(F.col(p) < t, "Approved").otherwise("Denied"))


CREDIT_BANDS = ("Very Low Risk", "Low Risk", "Medium Risk", "High Risk")


def fit_credit_band(df: DataFrame, p: str = "pred_prob") -> list[float]:
    return distinct_edges(exact_quantiles(df, {p: [0.0, 0.25, 0.5, 0.75, 1.0]})[p])


def credit_band(df: DataFrame, edges: list[float], p: str = "pred_prob") -> DataFrame:
    """Quartile band of the score; with fewer distinct edges the first labels are used."""
    index = qcut_bin(p, edges)
    return df.withColumn("credit_band", map_lookup(index, dict(enumerate(CREDIT_BANDS))))
