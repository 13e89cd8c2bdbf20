import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tractwise.operators import (
    attribution_table, attributions_long, expand_struct, fit_best, fit_linear,
    linear_attributions, predict, rank_attributions, rank_attributions_wide,
    sampled_attributions, training_baseline, transpose_attributions,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).select(
        F.col("id").cast("string").alias("geo_id"),
        F.when(F.col("id") % 5 < 3, "AL").otherwise("AK").alias("state"),
        F.when(F.col("id") % 40 > 0, (F.col("id") % 17).cast("double")).alias("a"),
        ((F.col("id") * 7) % 23).cast("double").alias("b"),
    ).withColumn("y", F.coalesce("a", F.lit(3.0)) * 2 + F.col("b") * F.when(F.col("state") == "AL", 1.0).otherwise(-1.0)).cache()


def flat(df, *keys):
    return {tuple(r[k] for k in keys): r.feature_importance.asDict() for r in df.collect()}


def test_baseline(rows):
    baseline = training_baseline(rows, ["a", "b"], ["state"])
    assert baseline["state"] == "AL"
    assert baseline["a"] == pytest.approx(rows.agg(F.avg("a")).first()[0])


def test_linear_attributions_sum_to_the_prediction_and_equal_sampled(rows):
    model = fit_linear(rows, label="y", numeric=["a", "b"])
    baseline = training_baseline(rows, ["a", "b"])
    exact = flat(linear_attributions(rows, model, baseline=baseline, keys=["geo_id"]), "geo_id")
    sampled = flat(sampled_attributions(
        rows, model, baseline=baseline, features=["a", "b"], keys=["geo_id"], permutations=3
    ), "geo_id")
    predicted = {(r.geo_id,): r.predicted_label for r in predict(rows, model).collect()}
    mean = sum(predicted.values()) / len(predicted)
    for key, parts in exact.items():
        assert sum(parts.values()) == pytest.approx(predicted[key] - mean, abs=1e-6)
        assert sampled[key] == pytest.approx(parts, abs=1e-9)


def test_sampled_attributions_of_trees_telescope(rows):
    features = ["state", "a", "b"]
    model = fit_best(rows, label="y", numeric=["a", "b"], categorical=["state"],
                     candidates=[GBTRegressor(maxIter=5, maxDepth=3, seed=1)])
    baseline = training_baseline(rows, ["a", "b"], ["state"])
    out = sampled_attributions(
        rows, model, baseline=baseline, features=features, keys=["state", "geo_id"], permutations=5
    )
    assert out.columns == ["state", "geo_id", "feature_importance"]
    at_baseline = predict(
        rows.limit(1).select(*[F.lit(baseline[c]).alias(c) for c in features]), model
    ).first().predicted_label
    predicted = {(r.state, r.geo_id): r.predicted_label for r in predict(rows, model).collect()}
    got = flat(out, "state", "geo_id")
    assert len(got) == 400
    for key, parts in got.items():
        assert sum(parts.values()) == pytest.approx(predicted[key] - at_baseline, abs=1e-9)
    again = sampled_attributions(
        rows.repartition(3), model, baseline=baseline, features=features,
        keys=["state", "geo_id"], permutations=5,
    )
    for key, parts in flat(again, "state", "geo_id").items():
        assert parts == pytest.approx(got[key], abs=1e-12)


def test_keys_must_identify_rows(rows):
    model = fit_linear(rows, label="y", numeric=["a"])
    out = sampled_attributions(rows, model, baseline={"a": 0.0}, features=["a"], keys=["state"])
    with pytest.raises(Exception, match="do not identify a row"):
        out.collect()


def test_linear_form_refuses_categories(rows):
    model = fit_linear(rows, label="y", numeric=["a"], categorical=["state"])
    with pytest.raises(ValueError):
        linear_attributions(rows, model, baseline={"a": 0.0}, keys=["geo_id"])


PREDICTIONS = [
    ("AL", "t1", (1.0, -3.0, 3.0, None)),
    ("AL", "t2", (5.0, 0.5, -0.1, 2.0)),
    ("AL", "t3", (9.0, 9.0, 9.0, 9.0)),
    ("AK", "t4", (0.0, 1.0, -2.0, 0.25)),
]


@pytest.fixture
def table(spark):
    predictions = spark.createDataFrame(
        PREDICTIONS,
        "state string, geo_id string, feature_importance struct<state:double,p:double,q:double,r:double>",
    )
    assert expand_struct(predictions, "feature_importance").columns == ["state", "p", "q", "r"]
    return attribution_table(predictions)


def test_ranks_are_by_absolute_value_with_ties_by_name(table, plan_of):
    ranked = rank_attributions(table)
    got = [(r.feature, r["rank"]) for r in ranked.where("tract = 't1'").orderBy("rank").collect()]
    assert got == [("p", 1), ("q", 2), ("state", 3), ("r", 4)]
    row = ranked.where("tract = 't1' and feature = 'p'").first()
    assert (row.importance, row.abs_value) == (-3.0, 3.0)
    assert ranked.count() == 16
    assert "Exchange" not in plan_of(ranked)


def test_transposed_report_ranks_by_the_first_tract(table):
    with pytest.raises(Exception, match="more than 2 rows"):  # none is left out silently
        transpose_attributions(table).collect()
    every = transpose_attributions(table, slots=3).where("state_code = 'AL' and feature = 'p'").first()
    assert (every.tract_1, every.tract_2, every.tract_3) == (-3.0, 0.5, 9.0)
    wide = transpose_attributions(table.where("tract != 't3'"))
    assert wide.columns == ["state_code", "feature", "tract_1", "tract_2"]
    al = {r.feature: (r.tract_1, r.tract_2) for r in wide.where("state_code = 'AL'").collect()}
    assert al == {"state": (1.0, 5.0), "p": (-3.0, 0.5), "q": (3.0, -0.1), "r": (None, 2.0)}
    ak = {r.feature: (r.tract_1, r.tract_2) for r in wide.where("state_code = 'AK'").collect()}
    assert ak["q"] == (-2.0, None)
    ranked = rank_attributions_wide(wide).where("state_code = 'AL'").orderBy("rank")
    assert [r.feature for r in ranked.collect()] == ["p", "q", "state", "r"]


def test_transposing_twice_gives_the_table_back(table):
    long = attributions_long(table)
    back = long.groupBy("state_code", "tract").pivot("feature", ["state", "p", "q", "r"]).agg(
        F.first("importance")
    )
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_baseline_uses_the_numbers_and_rows_the_model_is_fitted_to(spark):
    rows = spark.createDataFrame(
        [(1.0, 1.0), (float("nan"), 2.0), (float("inf"), 3.0), (None, 4.0), (3.0, 5.0), (100.0, None)],
        "x double, y double")
    assert training_baseline(rows, ["x"], label="y") == {"x": 2.0}
