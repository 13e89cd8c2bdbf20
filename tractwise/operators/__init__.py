"""DataFrame-to-DataFrame operators, usable through ``df.transform``."""

from tractwise.operators.attribution import (
    attribution_table, attributions_long, expand_struct, linear_attributions,
    rank_attributions, rank_attributions_wide, sampled_attributions,
    training_baseline, transpose_attributions,
)
from tractwise.operators.boundaries import simplify_boundaries, simplify_coverage
from tractwise.operators.columns import (
    derived_population, dispatch_measure, dispatch_unpivot, drop_columns,
    random_amount, replace_last, scenario_grid, select_features, weighted_exposure,
)
from tractwise.operators.effects import AbsorbedModel, fit_absorbed, load_absorbed
from tractwise.operators.groups import argmax_rows, group_max, top_k_rows
from tractwise.operators.joins import (
    cast_key_join, cross_dimension, period_diff, prefix_join, restrict_to, union_all,
)
from tractwise.operators.models import (
    baseline_prediction, fit_best, fit_linear, load_model, predict, save_model,
    score_scenarios, what_if,
)
from tractwise.operators.tree_attribution import exact_attributions

__all__ = [
    "AbsorbedModel", "argmax_rows", "attribution_table", "attributions_long", "baseline_prediction",
    "cast_key_join", "cross_dimension", "derived_population", "dispatch_measure",
    "dispatch_unpivot", "drop_columns", "exact_attributions", "expand_struct", "fit_absorbed", "fit_best", "fit_linear",
    "group_max", "linear_attributions", "load_absorbed", "load_model", "period_diff", "predict",
    "prefix_join", "random_amount", "rank_attributions", "rank_attributions_wide",
    "replace_last", "restrict_to", "sampled_attributions", "save_model",
    "scenario_grid", "score_scenarios", "select_features", "simplify_boundaries", "simplify_coverage",
    "top_k_rows", "training_baseline", "transpose_attributions", "union_all",
    "weighted_exposure", "what_if",
]
