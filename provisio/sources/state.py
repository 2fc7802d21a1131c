"""One folder with everything that was fitted: models, calibration, bins with edges, weights, encodings, medians, tiers.

    <path>/rules.json      features, medians, cleaning and encoding state, bins with edges, tier bounds, number of models
    <path>/models/<i>      fold models, by Spark ML's own writers
    <path>/weights         weight of evidence per (feature, bin)
    <path>/index           positions of values that are encoded as rows
    <path>/calibration     intervals of the isotonic function

A state is written to a path of its own and read back whole, so scoring needs no training data.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from provisio.operators import calibration
from provisio.operators.cleaning import clean_application
from provisio.operators.features import apply_binary, apply_median, apply_onehot
from provisio.operators.models import clip_pd, ensemble_predict
from provisio.operators.woe import apply_woe

RULES = ("features", "medians", "cleaning", "encoding", "bins", "tiers")


@dataclass
class FittedState:
    """Fitted parts; those that are None or empty are left out of scoring."""

    features: list[str] = field(default_factory=list)  # inputs of the models, in order
    medians: dict = field(default_factory=dict)
    cleaning: dict = field(default_factory=dict)  # of ``cleaning.fit_application``
    encoding: dict = field(default_factory=dict)  # of ``features.fit_encoding``
    bins: dict = field(default_factory=dict)  # of ``woe.fit_bins``: values, or quantile edges
    tiers: list = field(default_factory=list)  # upper bounds of the risk tiers
    models: Sequence[Model] = ()
    weights: DataFrame | None = None
    index: DataFrame | None = None
    calibrator: calibration.Isotonic | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Raw rows to model inputs: cleaning, encoding, medians, weights of evidence."""
        if self.cleaning:
            df = clean_application(df, self.cleaning)
        if self.encoding:
            df = apply_onehot(apply_binary(df, self.encoding), self.encoding)
        if self.medians:
            df = apply_median(df, self.medians)
        return apply_woe(df, self.bins, self.weights) if self.weights is not None else df

    def score(self, df: DataFrame) -> DataFrame:
        """``pd_raw`` (mean of the fold models) and ``pd_calibrated`` for prepared or raw rows."""
        out = ensemble_predict(self.prepare(df), self.models, self.features, "pd_raw")
        if self.calibrator is None:
            return out.withColumn("pd_calibrated", clip_pd("pd_raw"))
        return calibration.apply(out, self.calibrator, "pd_raw", "pd_calibrated").withColumn("pd_calibrated", clip_pd("pd_calibrated"))


def write_state(spark: SparkSession, state: FittedState, path: str) -> None:
    for i, model in enumerate(state.models):
        model.write().overwrite().save(f"{path}/models/{i}")
    for name in ("weights", "index"):
        table = getattr(state, name)
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/{name}")
    if state.calibrator is not None:
        calibration.write(state.calibrator, f"{path}/calibration")
    rules = {name: getattr(state, name) for name in RULES}
    rules["parts"] = [name for name in ("weights", "index", "calibrator") if getattr(state, name) is not None]
    rules["models"] = len(state.models)
    # The rules come last: a folder without them is not a whole state.
    spark.createDataFrame([(json.dumps(rules),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/rules.json")


def read_state(spark: SparkSession, path: str) -> FittedState:
    rules = json.loads(spark.read.text(f"{path}/rules.json", wholetext=True).first()["value"])
    state = FittedState(**{name: rules[name] for name in RULES})
    state.models = [DefaultParamsReader.loadParamsInstance(f"{path}/models/{i}", spark.sparkContext) for i in range(rules["models"])]
    for name in ("weights", "index"):
        if name in rules["parts"]:
            setattr(state, name, spark.read.parquet(f"{path}/{name}"))
    if "calibrator" in rules["parts"]:
        state.calibrator = calibration.read(spark, f"{path}/calibration")
    return state
