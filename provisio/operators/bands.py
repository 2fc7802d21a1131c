"""Display bands of the portfolio: term, loan to income, debt to income, amount, PD, tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provisio.functions.semantics import (
    clip, cut, days_before_reference, month_label, ordinal, safe_div,
)

# Edges and labels of the display bands (intervals closed on the right).
TERM = ((-1, 18, 30, 42, 9999), ("≤18m", "24m", "36m", "48m+"))
LTI = ((-1, 1, 2, 3, 5, 999), ("0–1×", "1–2×", "2–3×", "3–5×", ">5×"))
DTI = ((-1, 0.10, 0.20, 0.30, 0.50, 9), ("0–10%", "10–20%", "20–30%", "30–50%", ">50%"))
AMOUNT = ((0, 100e3, 200e3, 300e3, 500e3, 9e9), ("$0–100k", "$100–200k", "$200–300k", "$300–500k", "$500k+"))
PD = (
    (0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.01),
    ("0–10%", "10–20%", "20–30%", "30–40%", "40–50%", "50–60%", "60–70%", "70–80%", "80–90%", "90–100%"),
)
TIERS = ("Very Low", "Low", "Medium", "High")
SIMPLE_LGD = 0.45
MAX_MONTH_DAYS = 1095


def term_months() -> Column:
    return F.bround(F.col("amt_credit") / clip("amt_annuity", 1.0), 0)


def term_band() -> Column:
    return cut(term_months(), *TERM)


def lti_band(df: DataFrame | None = None) -> Column:
    """Band of the loan to income, of the column ``credit_income_ratio`` if the table has it."""
    ready = df is not None and "credit_income_ratio" in df.columns
    return cut(F.col("credit_income_ratio") if ready else safe_div("amt_credit", clip("amt_income_total", 1.0)), *LTI)


def dti_band(df: DataFrame | None = None) -> Column:
    """Band of the annuity to income, of the column ``annuity_income_ratio`` if the table has it."""
    ready = df is not None and "annuity_income_ratio" in df.columns
    return cut(F.col("annuity_income_ratio") if ready else safe_div("amt_annuity", clip("amt_income_total", 1.0)), *DTI)


def filled_credit_term() -> Column:
    """Term in months for tables without ``credit_term``: from amount and annuity, 24 if unknown, 6 to 60."""
    return clip(F.coalesce(term_months(), F.lit(24.0)), 6.0, 60.0)


def credit_amount_band() -> Column:
    return cut("amt_credit", *AMOUNT)


def pd_band(p: str = "pred_prob") -> Column:
    return cut(p, *PD)


def risk_tier_simple(p: str = "pred_prob") -> Column:
    p = F.col(p)
    return F.when(p < 0.08, "Very Low").when(p < 0.18, "Low").when(p < 0.40, "Medium").otherwise("High")


def stage_simple(p: str = "pred_prob") -> Column:
    return F.when(F.col(p) < 0.20, 1).when(F.col(p) < 0.50, 2).otherwise(3)


def ecl_simple(p: str = "pred_prob") -> Column:
    return F.col(p) * SIMPLE_LGD * F.col("amt_credit")


def disbursement_month(c: str = "days_id_publish") -> Column:
    days = clip(F.abs(F.coalesce(F.col(c), F.lit(-365))), 0, MAX_MONTH_DAYS)
    return month_label(days_before_reference(days))


def with_bands(df: DataFrame) -> DataFrame:
    """All display columns in one projection; tier, stage and ECL only where there is none."""
    new = {
        "term_m": term_months(), "term_bin": term_band(), "lti_bin": lti_band(df), "dti_bin": dti_band(df),
        "cred_bin": credit_amount_band(), "pd_band": pd_band(), "disbursement_month": disbursement_month(),
    }
    for name, make in (("credit_term", filled_credit_term), ("risk_tier", risk_tier_simple), ("stage", stage_simple), ("ecl", ecl_simple)):
        if name not in df.columns:
            new[name] = make()
    return df.withColumns(new)


def band_order(c: str, spec) -> Column:
    return ordinal(c, spec[1])


def narrow(df: DataFrame, cols) -> DataFrame:
    """Doubles to float and longs to int, to halve the size of a cached display frame."""
    types = {"double": "float", "bigint": "int"}
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.col(c).cast(types[kinds[c]]) for c in cols if kinds.get(c) in types})


# Facets: family status groups and loan term labels as shown to the user.
FAMILY = {
    "Married": ["Married"],
    "Single": ["Single / not married", "Separated", "Widow"],
    "Divorced": ["Separated"],
}
TERM_FACET = {"12": "≤18m", "24": "24m", "36": "36m", "48+": "48m+"}


def facet_condition(family=(), region=None, tiers=(), terms=()) -> Column:
    """Conjunction of the facets that are set; an unset facet filters nothing."""
    out = F.lit(True)
    if family:
        out = out & F.col("name_family_status").isin(sorted({s for f in family for s in FAMILY[f]}))
    if region is not None:
        out = out & (F.col("region_rating") == region)
    if tiers:
        out = out & F.col("risk_tier").isin(list(tiers))
    if terms:
        out = out & F.col("term_bin").isin([TERM_FACET[t] for t in terms])
    return out


def apply_filters(df: DataFrame, **facets) -> DataFrame:
    return df.filter(facet_condition(**facets))
