"""Feature importance per state."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tractwise.columns import NUMERIC_FEATURES, SHARE
from tractwise.operators.attribution import (
    attribution_table, rank_attributions, rank_attributions_wide, sampled_attributions, training_baseline,
    transpose_attributions,
)
from tractwise.operators.models import PREDICTION, predict
from tractwise.operators.tree_attribution import STRUCT, can_be_exact, exact_attributions

MODEL_FEATURES = ["state", *NUMERIC_FEATURES]


def importance_predictions(
    top: DataFrame, training: DataFrame, model: PipelineModel, **options: object
) -> DataFrame:
    """State, tract and signed importance struct for each row of ``top``."""
    return scored_predictions(top, training, model, **options).select("state", "geo_id", STRUCT)


def scored_predictions(
    top: DataFrame, training: DataFrame, model: PipelineModel, **options: object
) -> DataFrame:
    """The rows of ``top`` with their prediction and importance struct.

    Linear and tree models are explained exactly, where the rows are read. For other
    models, importances are sampled (``options``: ``permutations``, ``seed``).
    """
    baseline = training_baseline(training, NUMERIC_FEATURES, ["state"], label=SHARE)
    scored = predict(top, model)
    if can_be_exact(model):
        return exact_attributions(
            scored, model, baseline=baseline, features=MODEL_FEATURES, keys=[*top.columns, PREDICTION])
    importances = sampled_attributions(
        top, model, baseline=baseline, features=MODEL_FEATURES, keys=["state", "geo_id"], **options)
    return scored.join(importances, ["state", "geo_id"])


def importance_table(predictions: DataFrame) -> DataFrame:
    return attribution_table(predictions)


def ranked_importance(table: DataFrame) -> DataFrame:
    """State, tract, feature, importance, absolute value and rank."""
    return rank_attributions(table).withColumnRenamed("state_code", "state")


def importance_report(table: DataFrame, tracts: int = 2) -> DataFrame:
    """The report of each state: features as rows, its tracts as columns, the first tract's largest importance first."""
    return rank_attributions_wide(transpose_attributions(table, slots=tracts)).withColumnRenamed("state_code", "state")
