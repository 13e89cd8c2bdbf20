"""Exact attributions against the sum over all subsets of features."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tractwise.operators import (
    exact_attributions, fit_best, fit_linear, linear_attributions, predict, sampled_attributions, training_baseline,
)

FEATURES = ["a", "b", "c", "d", "color", "kind"]


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(600).select(
        i.cast("string").alias("geo_id"),
        F.when(i % 31 > 0, (i % 17).cast("double")).alias("a"), ((i * 7) % 23).cast("double").alias("b"),
        ((i * 13) % 41).cast("double").alias("c"), (i % 2).cast("double").alias("d"),
        F.when(i % 29 > 0, F.get(F.array(*map(F.lit, ["red", "blue", "green", "grey"])), (i * 11 % 4).cast("int"))).alias("color"),
        F.when(i % 3 == 0, "x").otherwise("y").alias("kind"),
    ).withColumn("y", F.expr(
        "coalesce(a, 3) * b / 10 + if(color = 'red', c, -d * 5) + if(kind = 'x' and b > 11, 8, 0)")).cache()


def all_subsets(model, rows, baseline):
    """Shapley values by scoring every mixture of each row with the baseline."""
    own = {r.geo_id: r for r in rows.collect()}
    masks = [set(m) for k in range(len(FEATURES) + 1) for m in combinations(range(len(FEATURES)), k)]
    mixed = [
        (g, j, *[r[f] if i in mask else baseline[f] for i, f in enumerate(FEATURES)])
        for g, r in own.items() for j, mask in enumerate(masks)]
    kinds = ", ".join(f"{f} {'string' if f in ('color', 'kind') else 'double'}" for f in FEATURES)
    scored = predict(rows.sparkSession.createDataFrame(mixed, f"geo_id string, mask int, {kinds}"), model)
    value = {(r.geo_id, r.mask): r.predicted_label for r in scored.collect()}
    place = {frozenset(m): j for j, m in enumerate(masks)}
    n = len(FEATURES)
    return {g: [
        sum(math.factorial(len(m)) * math.factorial(n - len(m) - 1) / math.factorial(n)
            * (value[g, place[frozenset(m | {i})]] - value[g, j]) for j, m in enumerate(masks) if i not in m)
        for i in range(n)] for g in own}


@pytest.mark.parametrize("kind, options", [
    (DecisionTreeRegressor, {"maxDepth": 6, "maxBins": 64}), (RandomForestRegressor, {"numTrees": 6, "seed": 2}),
    (GBTRegressor, {"maxIter": 6, "maxDepth": 4, "seed": 1}), (LinearRegression, {})])
def test_equals_all_subsets(rows, kind, options):
    model = fit_best(rows, label="y", numeric=FEATURES[:4], categorical=FEATURES[4:], candidates=[kind(**options)])
    baseline = training_baseline(rows, FEATURES[:4], FEATURES[4:])
    some = rows.where("cast(geo_id as int) % 40 < 2")
    found = {r.geo_id: list(r.feature_importance) for r in exact_attributions(
        some, model, baseline=baseline, features=FEATURES, keys=["geo_id"]).collect()}
    expected = all_subsets(model, some, baseline)
    assert found.keys() == expected.keys()
    for g in expected:
        assert found[g] == pytest.approx(expected[g], abs=1e-9)


def test_parts_add_up_and_nothing_is_shuffled(rows, plan_of):
    model = fit_best(rows, label="y", numeric=FEATURES[:4], categorical=FEATURES[4:], candidates=[GBTRegressor(maxIter=8, seed=1)])
    baseline = training_baseline(rows, FEATURES[:4], FEATURES[4:])
    parts = exact_attributions(rows, model, baseline=baseline, features=FEATURES, keys=["geo_id"])
    assert "Exchange" not in plan_of(parts) and parts.columns == ["geo_id", "feature_importance"]
    kinds = {f: rows.schema[f].dataType for f in FEATURES}
    at_base = predict(rows.limit(1).select(*[F.lit(baseline[f]).cast(kinds[f]).alias(f) for f in FEATURES]), model)
    base = at_base.first().predicted_label
    predicted = {r.geo_id: r.predicted_label for r in predict(rows, model).collect()}
    for r in parts.collect():
        assert sum(r.feature_importance) == pytest.approx(predicted[r.geo_id] - base, abs=1e-9)


def test_repeated_keys_clashing_names_and_no_rows(rows):
    model = fit_best(rows, label="y", numeric=["a", "b"], categorical=["kind"], candidates=[DecisionTreeRegressor(seed=1)])
    baseline = training_baseline(rows, FEATURES[:4], FEATURES[4:])
    features = ["kind", "a", "b", "d"]  # the model does not use d, and kind is a key too
    twice = rows.unionByName(rows).withColumn("prediction", F.lit("x"))
    parts = exact_attributions(twice, model, baseline=baseline, features=features, keys=["kind", "geo_id"])
    assert parts.count() == 1200 and parts.where("feature_importance.d != 0").count() == 0
    assert exact_attributions(rows.where("false"), model, baseline=baseline, features=features, keys=["geo_id"]).count() == 0


def test_linear_forms_agree_and_one_hot_slots_are_one_feature(rows):
    model = fit_linear(rows, label="y", numeric=["b", "c"])
    baseline = training_baseline(rows, FEATURES[:4], FEATURES[4:])
    exact = exact_attributions(rows, model, baseline=baseline, features=["b", "c"], keys=["geo_id"])
    plain = linear_attributions(rows, model, baseline=baseline, keys=["geo_id"])
    other = {r.geo_id: list(r.feature_importance) for r in plain.collect()}
    assert all(list(r.feature_importance) == pytest.approx(other[r.geo_id], abs=1e-9) for r in exact.collect())
    hot = fit_linear(rows, label="y", numeric=["b"], categorical=["color"])
    few = rows.limit(40)
    exact = exact_attributions(few, hot, baseline=baseline, features=["b", "color"], keys=["geo_id"])
    sampled = sampled_attributions(few, hot, baseline=baseline, features=["b", "color"], keys=["geo_id"], permutations=2)
    other = {r.geo_id: list(r.feature_importance) for r in sampled.collect()}
    assert all(np.allclose(list(r.feature_importance), other[r.geo_id]) for r in exact.collect())


def test_other_models_are_refused(rows):
    class Other:
        stages = [None, None]

    with pytest.raises(ValueError, match="sampled_attributions"):
        exact_attributions(rows, Other(), baseline={}, features=[], keys=[])
