"""Loss given default, exposure, stages, PD term structure, macro overlay and ECL."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.functions.ranking import exact_medians
from provisio.functions.semantics import clip, col_or, safe_div

BILLION = 1e9


@dataclass(frozen=True)
class LossRates:
    """Fixed values: (with collateral, without) per product, default rate, revolving factor."""
    cash: tuple[float, float] = (0.55, 0.75)
    revolving: tuple[float, float] = (0.45, 0.65)
    consumer: tuple[float, float] = (0.35, 0.50)
    unknown: float = 0.65
    revolving_factor: float = 1.2
    default_amount: float = 500_000.0


# The documented alternative to the default rates.
DOCUMENTED_RATES = LossRates(revolving=(0.70, 0.85))


@dataclass(frozen=True)
class StageRules:
    pd_stage2: float = 0.20
    pd_stage3: float = 0.70
    late_ratio: float = 0.30
    refused_ratio: float = 0.50


@dataclass(frozen=True)
class Scenario:
    name: str
    weight: float
    scalar: float


@dataclass(frozen=True)
class Scenarios:
    """Probability weights and PD scalars of the macro scenarios."""
    items: tuple[Scenario, ...] = field(default=(
        Scenario("Optimistic", 0.20, 0.85),
        Scenario("Base", 0.50, 1.00),
        Scenario("Adverse", 0.20, 1.35),
        Scenario("Severe", 0.10, 1.75),
    ))

    def __post_init__(self):
        total = sum(s.weight for s in self.items)
        if abs(total - 1.0) >= 0.001:
            raise ValueError(f"scenario weights sum to {total}")


def _contract_column(df: DataFrame) -> str | None:
    return next((c for c in df.columns if "CONTRACT_TYPE" in c.upper()), None)


def lgd(df: DataFrame, rates: LossRates = LossRates()) -> DataFrame:
    """Loss rate by product (from the contract text) and collateral (a down payment)."""
    contract = _contract_column(df)
    if contract is None:
        return df.withColumn("lgd", F.lit(rates.unknown))
    text = F.upper(F.coalesce(F.col(contract), F.lit("")))
    secured = F.col("amt_down_payment") > 0 if "amt_down_payment" in df.columns else F.lit(False)

    def rate(pair):
        return F.when(secured, pair[0]).otherwise(pair[1])

    return df.withColumn(
        "lgd",
        F.when(text.contains("CASH"), rate(rates.cash))
        .when(text.contains("REV"), rate(rates.revolving))
        .otherwise(rate(rates.consumer)),
    )


def amount_column(df: DataFrame) -> str | None:
    """The amount column, else the first column whose name contains CREDIT."""
    if "amt_credit" in df.columns:
        return "amt_credit"
    return next((c for c in df.columns if "CREDIT" in c.upper()), None)


def ead(df: DataFrame, rates: LossRates = LossRates(), median: float | None = None) -> DataFrame:
    """Exposure: the amount (missing: the median) times 1.2 for revolving contracts."""
    c = amount_column(df)
    if c is None:
        base = F.lit(rates.default_amount)
    else:
        median = exact_medians(df, [c])[c] if median is None else median
        base = F.coalesce(F.col(c).cast("double"), F.lit(median))
    factor = F.lit(1.0)
    if "name_contract_type" in df.columns:
        factor = F.when(F.col("name_contract_type").contains("Rev"), rates.revolving_factor).otherwise(1.0)
    return df.withColumn("ead", base * factor)


def lgd_sensitivity(df: DataFrame) -> DataFrame:
    """Total ECL and coverage when the mean LGD moves; one aggregate, four rows."""
    row = df.agg(F.sum("ead").alias("total_ead"), F.avg("pred_prob").alias("avg_pd"), F.avg("lgd").alias("base"))
    base = F.col("base")
    cases = [
        ("Optimistic", F.greatest(F.lit(0.1), base - 0.15)), ("Base", base),
        ("Adverse", F.least(F.lit(0.95), base + 0.15)), ("Severe", F.least(F.lit(0.99), base + 0.30)),
    ]
    out = row.select("total_ead", "avg_pd", F.inline(F.array(*[
        F.struct(F.lit(n).alias("scenario"), v.alias("avg_lgd")) for n, v in cases
    ])))
    ecl = F.col("total_ead") * F.col("avg_pd") * F.col("avg_lgd")
    return out.select(
        "scenario", "avg_lgd", ecl.alias("total_ecl"), (safe_div(ecl, "total_ead", 0.0) * 100).alias("coverage_pct")
    )


def stage_column(df: DataFrame, rules: StageRules = StageRules(), p: str = "pred_prob") -> Column:
    """Stage 3, then 2, then 1; all bounds are strict, missing signals are harmless."""
    score = F.coalesce(F.col(p), F.lit(0.0)) if p in df.columns else F.lit(0.1)
    bad = col_or(df, "bureau_bad_debt_flag", 0) == 1
    late = col_or(df, "inst_late_ratio", 0.0) > rules.late_ratio
    refused = col_or(df, "prev_refused_ratio", 0.0) > rules.refused_ratio
    return (
        F.when((score > rules.pd_stage3) | bad, 3)
        .when((score > rules.pd_stage2) | late | refused, 2).otherwise(1)
    )


def classify_stage(df: DataFrame, rules: StageRules = StageRules()) -> DataFrame:
    return df.withColumn("stage", stage_column(df, rules))


def pd_term(df: DataFrame, p: str = "pred_prob") -> DataFrame:
    """12-month and lifetime PD under a constant hazard over the loan term."""
    pd12 = clip(F.col(p), 0.001, 0.999)
    months = F.coalesce(clip("credit_term", 6.0, 120.0), F.lit(36.0)) if "credit_term" in df.columns else F.lit(36.0)
    years = months / 12.0
    life = 1.0 - F.pow(1.0 - F.col("pd_12m"), F.col("loan_term_yrs"))
    return (
        df.withColumns({"pd_12m": pd12, "loan_term_yrs": years})
        .withColumn("pd_lifetime", clip(life, F.col("pd_12m"), 0.999))
        .withColumn("pd_multiplier", F.col("pd_lifetime") / F.col("pd_12m"))
    )


def macro_overlay(df: DataFrame, scenarios: Scenarios = Scenarios()) -> DataFrame:
    """PDs under each scenario and their probability-weighted mean."""
    new: dict[str, Column] = {}
    for base in ("pd_12m", "pd_lifetime"):
        for s in scenarios.items:
            new[f"{base}_{s.name.lower()}"] = clip(F.col(base) * s.scalar, 0.001, 0.999)
    mixed = {
        f"{base}_macro": reduce(
            lambda a, b: a + b, [F.col(f"{base}_{s.name.lower()}") * s.weight for s in scenarios.items]
        )
        for base in ("pd_12m", "pd_lifetime")
    }
    return df.withColumns(new).withColumns(mixed).withColumn(
        "macro_uplift_12m_pct", (F.col("pd_12m_macro") / F.col("pd_12m") - 1) * 100
    )


def _stage_loss(twelve: Column, lifetime: Column) -> Column:
    loss = F.col("lgd") * F.col("ead")
    return F.when(F.col("stage") == 1, twelve * loss).when(F.col("stage") == 2, lifetime * loss).otherwise(loss)


def compute_ecl(df: DataFrame) -> DataFrame:
    """Loan ECL from stage, overlaid PDs, LGD and EAD; rate over an exposure of at least 1."""
    return df.withColumn(
        "ecl", _stage_loss(F.col("pd_12m_macro"), F.col("pd_lifetime_macro"))
    ).withColumn("ecl_rate", F.col("ecl") / clip("ead", 1.0))


def provision(df: DataFrame, rates: LossRates = LossRates(), scenarios: Scenarios = Scenarios(),
              median: float | None = None) -> DataFrame:
    """Scored loans to stage, PDs, LGD, EAD and ECL: projections only, no shuffle."""
    staged = classify_stage(ead(lgd(df, rates), rates, median))
    return compute_ecl(macro_overlay(pd_term(staged), scenarios))


def stage_summary(loans: DataFrame) -> DataFrame:
    return loans.groupBy("stage").agg(
        F.count("ecl").alias("loan_count"),
        F.bround(F.sum("ead") / BILLION, 2).alias("total_ead_b"),
        F.bround(F.sum("ecl") / BILLION, 2).alias("total_ecl_b"),
        F.avg("pd_12m_macro").alias("avg_pd_12m"),
        F.avg("pd_lifetime_macro").alias("avg_pd_lifetime"),
        F.avg("lgd").alias("avg_lgd"),
        F.avg("ecl_rate").alias("ecl_coverage"),
    )


def stage_distribution(loans: DataFrame) -> DataFrame:
    counts = loans.groupBy("stage").agg(
        F.count(F.lit(1)).alias("loan_count"), F.sum("ead").alias("ead"), F.sum("ecl").alias("ecl")
    )
    whole = Window.partitionBy()  # three stage rows
    return counts.withColumn("pct", F.col("loan_count") * 100.0 / F.sum("loan_count").over(whole))


def portfolio_totals(loans: DataFrame) -> DataFrame:
    return loans.agg(
        F.count(F.lit(1)).alias("loan_count"), F.sum("ead").alias("ead"), F.sum("ecl").alias("ecl")
    ).withColumn("coverage_pct", safe_div("ecl", "ead") * 100)


def scenario_ecl(loans: DataFrame, scenarios: Scenarios = Scenarios()) -> DataFrame:
    """Total ECL if one scenario were certain: conditional sums in one pass, one row each."""
    rows = [
        F.struct(
            F.lit(s.name).alias("scenario"), F.lit(s.weight).alias("weight"),
            F.sum(_stage_loss(F.col(f"pd_12m_{s.name.lower()}"), F.col(f"pd_lifetime_{s.name.lower()}"))).alias("total_ecl"),
        )
        for s in scenarios.items
    ]
    return loans.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def overlay_report(loans: DataFrame) -> DataFrame:
    return loans.agg(
        F.avg("pd_12m").alias("pd_12m_before"), F.avg("pd_12m_macro").alias("pd_12m_after"),
        F.avg("pd_lifetime").alias("pd_lifetime_before"), F.avg("pd_lifetime_macro").alias("pd_lifetime_after"),
    ).withColumn("uplift_pct", (F.col("pd_12m_after") / F.col("pd_12m_before") - 1) * 100)


