"""The model search: rounds, budget, and the winner a full search finds."""

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tractwise.operators import fit_best, models, predict
from tractwise.operators.models import _with_share


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(1200).select(
        i, (i * 7 % 31).cast("double").alias("a"), (i * 11 % 29).cast("double").alias("b"),
        F.when(i % 3 == 0, "x").otherwise("y").alias("c"),
    ).withColumn("step", F.expr("case when a > 15 and b > 10 then 9.0 when c = 'x' then 4.0 else 1.0 end")).withColumn(
        "plane", F.expr("3 * a - b")).cache()


def candidates():
    return [
        LinearRegression(), DecisionTreeRegressor(maxDepth=1), DecisionTreeRegressor(maxDepth=5),
        RandomForestRegressor(numTrees=9, maxDepth=2, seed=1), GBTRegressor(maxIter=9, maxDepth=1, seed=1),
        RandomForestRegressor(numTrees=9, maxDepth=3, seed=1), GBTRegressor(maxIter=9, maxDepth=2, stepSize=0.01, seed=1)]


@pytest.mark.parametrize("label, kind", [("step", "DecisionTreeRegressionModel"), ("plane", "LinearRegressionModel")])
def test_rounds_find_the_winner_of_a_full_search(rows, label, kind):
    trials = []
    model = fit_best(rows, label=label, numeric=["a", "b"], categorical=["c"], candidates=candidates(), trials=trials)
    assert type(model.stages[-1]).__name__ == kind
    assert sorted(t.share for t in trials) == [1 / 3] * 7 + [1.0] * 3
    everything = []
    full = fit_best(rows, label=label, numeric=["a", "b"], categorical=["c"], candidates=candidates(), shrink=7, trials=everything)
    assert type(full.stages[-1]).__name__ == kind and {t.share for t in everything} == {1.0}
    least = min(everything, key=lambda t: t.rmse)
    assert min((t for t in trials if t.share == 1), key=lambda t: t.rmse).candidate == least.candidate
    exact = predict(rows, model).where(f"abs(predicted_label - {label}) > 1e-6").count()
    assert exact == 0


def test_a_share_is_of_trees_or_rounds_never_of_rows(spark):
    assert _with_share(RandomForestRegressor(numTrees=10), 1 / 3).getNumTrees() == 4
    assert _with_share(GBTRegressor(maxIter=20), 1 / 9).getMaxIter() == 3
    assert _with_share(GBTRegressor(maxIter=2), 1 / 9).getMaxIter() == 1
    assert _with_share(LinearRegression(maxIter=50), 1 / 9).getMaxIter() == 50


def test_after_the_budget_no_fit_begins(rows):
    trials = []
    model = fit_best(rows, label="step", numeric=["a", "b"], candidates=candidates(), budget_seconds=0.0, parallelism=1, trials=trials)
    assert len(trials) == 1 and trials[0].candidate == 0
    assert type(model.stages[-1]).__name__ == "LinearRegressionModel"


def test_ties_go_to_the_first(rows):
    same = [DecisionTreeRegressor(maxDepth=5), DecisionTreeRegressor(maxDepth=4)]
    model = fit_best(rows, label="step", numeric=["a", "b"], categorical=["c"], candidates=same, parallelism=2)
    assert model.stages[-1].getMaxDepth() == 5


def test_stored_vectors_take_the_room_of_their_values(rows, tmp_path, monkeypatch):
    # encoded, ten thousand equal rows are one: a task would read, and the trees keep, any number of them
    monkeypatch.setattr(models, "scratch_path", lambda spark, name: str(tmp_path / name))
    many = rows.crossJoin(rows.sparkSession.range(20).select(F.col("id").alias("copy")))
    fit_best(many, label="plane", numeric=["a", "b"], candidates=[LinearRegression(), LinearRegression(regParam=1.0)])
    size = sum(f.stat().st_size for f in (tmp_path / "vectors").glob("*.parquet"))
    assert size > 1200 * 20 * 3 * 8
