"""Trees grown from stored blocks of bins: MLlib's models, without its rows of objects."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from checks import operators, registry  # noqa: F401
from tractwise.operators import fit_best, histogram_trees, models, predict
from tractwise.operators.histogram_trees import HistogramTrees, condensed, copies, thresholds_of


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(3000, numPartitions=3).select(
        (F.xxhash64("id") % 1000 / 10.0).alias("a"), (i * 11 % 29).cast("double").alias("b"),
        F.when(i % 7 == 0, "x").when(i % 5 == 0, "y").when(i % 3 == 0, "z").otherwise("w").alias("c"),
    ).withColumn("y", F.expr("a * b / 10 + sin(a) * 5 + case c when 'x' then 20 when 'y' then -30 when 'z' then 7 else 1 end")).cache()


@pytest.fixture(scope="module")
def vectors(rows):
    prepared = Pipeline(stages=[
        StringIndexer(inputCols=["c"], outputCols=["i"], handleInvalid="keep"),
        VectorAssembler(inputCols=["a", "b", "i"], outputCol="features")]).fit(rows)
    return prepared.transform(rows).select(F.col("y").alias("label"), "features").cache()


def of(vectors):
    return HistogramTrees(vectors, vectors.count(), label="label", vector="features")


def apart(vectors, one, other):
    both = other.transform(one.transform(vectors).withColumnRenamed("prediction", "p"))
    return both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0]


@pytest.mark.parametrize("kind, options", [
    (DecisionTreeRegressor, dict(maxDepth=4, maxBins=32)),
    (DecisionTreeRegressor, dict(maxDepth=3, maxBins=16, minInstancesPerNode=200, minInfoGain=2.0)),
    (RandomForestRegressor, dict(numTrees=2, maxDepth=3, bootstrap=False, featureSubsetStrategy="all", seed=1)),
    (GBTRegressor, dict(maxIter=6, maxDepth=2, seed=1)),
], ids=["deep", "held back", "forest", "boosted"])
def test_models_are_mllibs(vectors, kind, options, tmp_path):
    regressor = kind(**options)
    theirs, ours = regressor.fit(vectors), of(vectors).fit(regressor)
    assert type(ours) is type(theirs)
    assert apart(vectors, theirs, ours) < 1e-9
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())
    ours.save(str(tmp_path / "model"))
    assert apart(vectors, theirs, type(ours).load(str(tmp_path / "model"))) < 1e-9


def test_nodes_that_do_not_fit_one_pass_take_more(vectors, monkeypatch):
    regressor = DecisionTreeRegressor(maxDepth=3)
    monkeypatch.setattr(histogram_trees, "PASS_BYTES", 1)
    assert apart(vectors, regressor.fit(vectors), of(vectors).fit(regressor)) < 1e-9


def test_a_forest_draws_rows_and_features(vectors):
    regressor = RandomForestRegressor(numTrees=3, maxDepth=3, seed=5)
    trees = of(vectors)
    model = trees.fit(regressor)
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) == 3
    assert apart(vectors, model, trees.fit(regressor)) < 1e-9
    drawn = copies(5, 0, 1, 200_000)
    assert drawn.mean() == pytest.approx(1, abs=0.01) and drawn.var() == pytest.approx(1, abs=0.02)
    assert (drawn == copies(5, 0, 1, 200_000)).all() and (drawn != copies(5, 1, 1, 200_000)).any()


def test_many_rows_are_not_kept_as_objects(rows, monkeypatch):
    def kept(self, dataset):
        raise AssertionError("fitted by MLlib")

    for kind in (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor):
        monkeypatch.setattr(kind, "_fit", kept)
    candidates = [LinearRegression(), RandomForestRegressor(numTrees=2, maxDepth=2), DecisionTreeRegressor(maxDepth=5)]
    trials = []
    model = fit_best(rows, label="y", numeric=["a", "b"], categorical=["c"], candidates=candidates, trials=trials, many_rows=1)
    assert {t.candidate for t in trials} == {0, 1, 2}
    assert type(model.stages[-1]).__name__ == "DecisionTreeRegressionModel"
    assert predict(rows, model).where("abs(predicted_label - y) < 60").count() > 2500
    assert models.MANY_ROWS > 3000


def test_other_settings_are_for_mllib(spark):
    assert HistogramTrees.can_fit(GBTRegressor()) and HistogramTrees.can_fit(RandomForestRegressor())
    for regressor in (
            LinearRegression(), GBTRegressor(lossType="absolute"), GBTRegressor(subsamplingRate=0.5), DecisionTreeRegressor(weightCol="w"),
            DecisionTreeRegressor(maxDepth=9), RandomForestRegressor(featureSubsetStrategy="0.5")):
        assert not HistogramTrees.can_fit(regressor)


def test_targets_that_are_no_numbers_fail(vectors):
    with pytest.raises(Exception, match="finite"):
        of(vectors.withColumn("label", F.lit(float("nan")))).fit(DecisionTreeRegressor(maxDepth=1))


def test_rows_without_anything_to_split_are_one_leaf(spark):
    same = VectorAssembler(inputCols=["v"], outputCol="features").transform(
        spark.range(40).select(F.lit(1.0).alias("v"), F.col("id").cast("double").alias("label")))
    model = of(same).fit(GBTRegressor(maxIter=2, maxDepth=2))
    assert {r.prediction for r in model.transform(same).collect()} == {19.5}


def test_thresholds_part_the_rows_evenly():
    values, weights = condensed(np.random.default_rng(1).random(200_000))
    assert len(values) == histogram_trees.POINTS and weights.sum() == 200_000
    found = thresholds_of(values, weights, 9)
    assert found == pytest.approx(np.arange(1, 10) / 10, abs=0.01)
    assert thresholds_of(np.array([1.0, 2.0, 5.0]), np.ones(3), 9).tolist() == [1.5, 3.5]


def test_an_evenly_dealt_table_is_not_shuffled(spark, tmp_path, monkeypatch):
    def stored(self, df):
        raise AssertionError("stored")

    spark.range(4000, numPartitions=4).selectExpr(
        "id as l_orderkey", "1 as l_linenumber", "if(id % 2 = 0, 'A', 'N') as l_returnflag", "id % 50 + 1D as l_quantity",
        "id % 11 / 100D as l_discount", "id % 9 / 100D as l_tax").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(models, "default_candidates", lambda: [LinearRegression(), DecisionTreeRegressor(maxDepth=1)])
    monkeypatch.setattr(registry.Tables, "stored", stored)
    found = registry.QUERIES["automl_fit"](spark, str(tmp_path))
    exact = F.expr("round((l_orderkey % 50 + 1) * 3D - (l_orderkey % 11) / 50D + l_orderkey % 9, 3)")
    assert found.where(F.abs(exact - F.col("predicted_label")) < 1e-6).count() == 4000
