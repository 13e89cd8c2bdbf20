"""Model inputs, what-if reports and scenarios."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tractwise.columns import FEATURES, GRADUATES, MEASURE, NUMERIC_FEATURES, SHARE
from tractwise.operators.columns import scenario_grid
from tractwise.operators.groups import argmax_rows, top_k_rows
from tractwise.operators.joins import restrict_to
from tractwise.operators.models import (
    baseline_prediction, fit_best, fit_linear, score_scenarios, what_if,
)
from tractwise.plans.staging import STATE_PREFIX
from tractwise.operators.joins import prefix_join


def most_disengaged(tracts: DataFrame, states: DataFrame) -> DataFrame:
    """The tract(s) with the largest prime-age count per state, every tie."""
    located = prefix_join(
        tracts.select("geo_id", MEASURE, SHARE),
        states.select("fips", F.col("postal_code").alias("state")),
        column="geo_id", prefix="fips", keep=["state"], length=STATE_PREFIX,
    )
    return argmax_rows(located, "state", MEASURE).select("state", "geo_id", MEASURE, SHARE)


def top_tracts(tracts: DataFrame, k: int = 2) -> DataFrame:
    """Model features of the ``k`` most disengaged tracts per state."""
    top = top_k_rows(
        tracts.select(*FEATURES, MEASURE), "state", MEASURE, k, tie_break="geo_id", unique=True
    )
    return top.drop(MEASURE)


def scenario_tracts(top: DataFrame, disengaged: DataFrame) -> DataFrame:
    """Top tracts that also hold their state's maximum. A state with more ties
    than top tracts keeps only those in both."""
    return restrict_to(top, disengaged, "geo_id")


def graduate_scenarios(tracts: DataFrame, states: DataFrame) -> DataFrame:
    """Six steps of growing high-school graduates, for all listed states in one job."""
    codes = states.select(F.col("postal_code").alias("state"))
    return scenario_grid(restrict_to(tracts, codes, "state"), GRADUATES)


def income_model(training: DataFrame, *, categorical: tuple[str, ...] = ()) -> PipelineModel:
    """Income per head from the share out of the labour force.

    ``categorical=("geo_id",)`` adds an effect per tract. With one row per
    tract that leaves the share's coefficient undetermined, so it is not the default.
    """
    return fit_linear(
        training, label="income_per_capita", numeric=[SHARE], categorical=categorical
    )


def labor_model(training: DataFrame, **options: object) -> PipelineModel:
    """Share out of the labour force from the features: the best of several regressors."""
    return fit_best(
        training, label=SHARE, numeric=NUMERIC_FEATURES, categorical=["state"], **options
    )


def economic_impact_input(disengaged: DataFrame, model: PipelineModel) -> DataFrame:
    return baseline_prediction(disengaged, model)


def economic_impact(
    inputs: DataFrame, model: PipelineModel, *, state: str | None = None
) -> DataFrame:
    """What one percentage point fewer out of the labour force brings, optionally one state."""
    return what_if(inputs.where(F.col("state") == state) if state else inputs, model)


def scenario_report(
    scenarios: DataFrame, model: PipelineModel, *, state: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Graduates and predicted share, ascending, optionally for one state or with columns to ``keep``."""
    rows = scenarios.where(F.col("state") == state) if state else scenarios
    return score_scenarios(rows, model, keep=keep)
