"""The whole way from the loan tables to provisions and decisions.

Each stage writes its result below ``root`` and reads it back: the fits of the next stage scan
it several times, and a lost executor costs no more than one stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.functions.semantics import feature_columns
from provisio.operators import cleaning as C
from provisio.operators import credit_loss as L
from provisio.operators import features as X
from provisio.operators import history as H
from provisio.operators import joins as J
from provisio.operators import metrics as M
from provisio.operators import models as MD
from provisio.operators import roi as R
from provisio.operators import woe as W
from provisio.sources.writers import write_version


def clean_tables(tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Cleaned applicants (state fitted on train) and histories.

    ``tables`` holds train, test, bureau, previous, instalments, pos and card.
    """
    state = C.fit_application(tables["train"])
    cleaners = {
        "train": lambda df: C.clean_application(df, state),
        "test": lambda df: C.clean_application(df.drop("target"), state),
        "bureau": C.clean_bureau, "previous": C.clean_previous, "instalments": C.clean_instalments,
        "pos": C.clean_pos, "card": C.clean_card,
    }
    return {n: _write_cleaned(n, cleaners[n](df), root) for n, df in tables.items()}


def _write_cleaned(name: str, df: DataFrame, root: str) -> DataFrame:
    """Applicants must be complete: a table whose footers show gaps is filled and written again."""
    spark, stage = df.sparkSession, f"cleaned/{name}"
    written = write_version(df, root, stage)
    if name in ("train", "test"):
        watched = [c for c in df.columns if c != "target"]
        gaps = [c for c, n in C.written_gaps(spark, f"{root}/{stage}", watched)[1].items() if n]
        if gaps:
            stage += "-filled"
            written = write_version(C.fill_gaps(written, gaps), root, stage)
            C.require_written(spark, f"{root}/{stage}", watched)
    return written


def join_tables(clean: dict[str, DataFrame], root: str) -> DataFrame:
    """Both splits with ratios and history aggregates; no history counts as zero."""
    app = X.engineer(X.tag_split(clean["train"], clean["test"]))
    aggs = [
        H.bureau_features(clean["bureau"]), H.previous_features(clean["previous"]),
        H.instalment_features(clean["instalments"]), H.pos_features(clean["pos"]), H.card_features(clean["card"]),
    ]
    added = [c for a in aggs for c in a.columns if c != H.KEY]
    return write_version(H.fill_history(J.join_history(app, aggs), added), root, "joined")


def build_features(joined: DataFrame, root: str, fit_on: str = "train") -> tuple[DataFrame, DataFrame, list[str]]:
    """Encoded, complete and selected features: train, test and the feature names.

    ``fit_on='all'`` fits encodings and filters on both splits; medians are always of train.
    """
    def part(df: DataFrame) -> DataFrame:
        return df.filter("is_train = 1") if fit_on == "train" else df

    encoding = X.fit_encoding(part(joined))
    df = X.sanitize_columns(X.apply_onehot(X.apply_binary(joined, encoding), encoding))
    names = feature_columns(df)
    df = X.apply_median(df, X.fit_median(df.filter("is_train = 1"), names))
    df = X.clean_bureau_high_lti(X.interactions(df))
    df = X.ext_source_stats(X.quality_composite(df, X.fit_quality(part(df))))
    df = write_version(df, root, "complete")
    names = feature_columns(df)
    low = X.fit_low_variance(part(df), names)
    names = [c for c in names if c not in low]
    correlated = X.fit_correlated(part(df), names)
    names = [c for c in names if c not in correlated]
    chosen = write_version(df.select("sk_id_curr", "target", "is_train", *names), root, "features")
    train, test = X.split(X.assert_outputs(chosen))
    return train, test, names


def build_scorecard(train: DataFrame, test: DataFrame, names: Sequence[str], root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """IV ranking, and both splits with the weights of the kept features."""
    bins = W.fit_bins(train, names)
    ranking = write_version(W.iv_screen(train, names, bins=bins), root, "iv_ranking")
    kept = [r["feature"] for r in ranking.filter("keep").select("feature").collect()]
    weights = W.woe_table(W.bin_table(train, {f: bins[f] for f in kept}), W.totals(train)).select("feature", "bin", "woe")
    weights = write_version(weights, root, "woe_weights")
    rules = {f: bins[f] for f in kept}
    return (
        ranking,
        write_version(W.apply_woe(train.select("sk_id_curr", "target", *kept), rules, weights), root, "train_woe"),
        write_version(W.apply_woe(test.select("sk_id_curr", *kept), rules, weights), root, "test_woe"),
    )


def train_models(train: DataFrame, names: Sequence[str], factories: dict[str, Callable[[], object]], root: str,
                 k: int = 5) -> tuple[DataFrame, DataFrame]:
    """Calibrated out-of-fold scores of every model, the best one as ``pred_prob``; leaderboard.

    The result of each model is written before the next one starts, so the plan does not grow
    with the number of models.
    """
    df = write_version(MD.with_weight(MD.assign_folds(train, k)), root, "folds")
    for name, factory in factories.items():
        scored = MD.oof_predict(df, factory, names, k, f"raw_{name}")
        scored = write_version(scored, root, f"oof_{name}")
        calibrator = MD.fit_isotonic(scored, p=f"raw_{name}")
        df = MD.apply_isotonic(scored, calibrator, f"raw_{name}", f"pd_{name}")
    board = write_version(M.leaderboard(df, {n: f"pd_{n}" for n in factories}), root, "leaderboard")
    best = M.best_model(board).first()["model"]
    scored = df.withColumn("pred_prob", MD.clip_pd(f"pd_{best}")).withColumn("champion", F.lit(best))
    return write_version(scored, root, "scored"), board


def provision_book(scored: DataFrame, texts: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Stage and ECL per loan and the stage summary; raw contract texts come from ``texts``."""
    loans = J.attach_text(scored.drop("name_contract_type"), texts, ["name_contract_type"])
    loans = write_version(L.provision(loans), root, "ecl")
    return loans, L.stage_summary(loans)


def decide(loans: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Threshold sweep, and each loan with its decision and credit band."""
    sweep = write_version(R.threshold_sweep(loans), root, "roi_sweep")
    best = R.best_threshold(sweep).first()["threshold"]
    final = R.credit_band(R.decision(loans, best), R.fit_credit_band(loans))
    return sweep, write_version(final, root, "final")
