import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tractwise.operators import (
    baseline_prediction, fit_best, fit_linear, load_model, predict, save_model, score_scenarios,
    scenario_grid, what_if,
)


@pytest.fixture(scope="module")
def table(spark):
    noise = (F.xxhash64("id") % 1000) / 1000.0
    df = spark.range(2000).select(
        F.concat(F.lit("t"), "id").alias("geo_id"),
        F.when(F.col("id") % 3 == 0, "AL").when(F.col("id") % 3 == 1, "AK").alias("state"),
        F.when(F.col("id") % 50 != 0, (F.col("id") % 97) / 97.0).alias("percent_not_in_labor_force"),
        (F.col("id") % 13).cast("double").alias("prime_age_not_in_labor_force"),
        noise.alias("noise"),
    )
    income = 30000 - 20000 * F.col("percent_not_in_labor_force")
    return df.withColumn("income", F.when(F.col("noise") > -0.9, income)).cache()


@pytest.fixture(scope="module")
def linear(table):
    return fit_linear(table, label="income", numeric=["percent_not_in_labor_force"])


def test_linear_recovers_the_line(linear):
    regression = linear.stages[-1]
    assert regression.coefficients[0] == pytest.approx(-20000)
    assert regression.intercept == pytest.approx(30000)


def test_predict_passes_inputs_through_and_fills_null(table, linear):
    scored = predict(table, linear)
    assert scored.columns == [*table.columns, "predicted_label"]
    missing = scored.where("percent_not_in_labor_force is null")
    trained = table.where("income is not null")
    mean = trained.agg(F.avg("percent_not_in_labor_force")).first()[0]
    assert missing.count() == 40
    assert missing.first().predicted_label == pytest.approx(30000 - 20000 * mean)


def test_columns_without_values_and_nan(spark):
    df = spark.createDataFrame(
        [(float(i), None, float(i) if i != 3 else float("nan"), 2.0 * i) for i in range(40)],
        "v double, never double, gap double, y double",
    )
    for fit in (fit_linear, lambda *a, **k: fit_best(
        *a, candidates=[LinearRegression(), DecisionTreeRegressor(maxDepth=1)], **k
    )):
        model = fit(df, label="y", numeric=["v", "never", "gap"])
        scored = predict(df.withColumn("never", F.lit(5.0)), model)
        assert all(abs(r.predicted_label - r.y) < 1e-6 for r in scored.collect())


def test_categories_unseen_or_null(table):
    model = fit_linear(table, label="prime_age_not_in_labor_force", numeric=["noise"], categorical=["state"])
    odd = table.limit(1).withColumn("state", F.lit("XX"))
    assert predict(odd, model).first().predicted_label is not None
    assert predict(table.where("state is null"), model).count() > 0


def test_category_effects_are_exact_means(spark):
    data = [("x", 1.0), ("x", 3.0), ("y", 10.0), ("z", 0.1), ("z", 0.3)]
    for extra in ([], [(None, 50.0), (None, 70.0)]):
        df = spark.createDataFrame(data + extra, "g string, y double")
        model = fit_linear(df, label="y", numeric=[], categorical=["g"])
        got = {r.g: r.predicted_label for r in predict(df, model).collect()}
        expected = {"x": 2.0, "y": 10.0, "z": 0.2, **({None: 60.0} if extra else {})}
        assert got == pytest.approx(expected, abs=1e-9)
    single = spark.createDataFrame([("x", 1.0, 1.0), ("x", 2.0, 3.0), ("x", 3.0, 5.0)], "g string, v double, y double")
    model = fit_linear(single, label="y", numeric=["v"], categorical=["g"])
    assert predict(single, model).orderBy("v").first().predicted_label == pytest.approx(1.0)


def test_what_if_effect_is_the_same_for_every_row(table, linear):
    rows = table.where("percent_not_in_labor_force is not null")
    inputs = baseline_prediction(rows, linear)
    assert inputs.columns == [
        "state", "geo_id", "percent_not_in_labor_force", "prime_age_not_in_labor_force",
        "baseline_avg_income",
    ]
    report = what_if(inputs, linear)
    assert report.columns == ["state", "geo_id", "new_labor_force", "new_income", "net_income_increase"]
    assert dict(report.dtypes)["new_labor_force"] == "bigint"
    joined = report.join(inputs, "geo_id").withColumn(
        "people", F.try_divide("prime_age_not_in_labor_force", "percent_not_in_labor_force")
    )
    for r in joined.limit(300).collect():
        if r.people is None:
            assert r.new_labor_force is None and r.net_income_increase is None
        else:
            assert abs(r.new_labor_force - 0.01 * r.people) <= 0.5
            assert abs(r.net_income_increase - 200 * r.people) <= 0.5 + 1e-6
        assert r.new_income == pytest.approx(r.baseline_avg_income + 200, abs=0.006)


def test_best_candidate_wins(table):
    steps = table.withColumn("y", F.when(F.col("noise") > 0.3, 5.0).otherwise(1.0))
    candidates = [LinearRegression(), DecisionTreeRegressor(maxDepth=3, maxBins=64)]
    model = fit_best(steps, label="y", numeric=["noise"], categorical=["state"], candidates=candidates)
    assert "DecisionTree" in type(model.stages[-1]).__name__
    model = fit_best(
        table, label="income", numeric=["percent_not_in_labor_force"], candidates=candidates
    )
    assert "LinearRegression" in type(model.stages[-1]).__name__


def test_default_search_scores_scenarios_in_order(table):
    model = fit_best(table, label="income", numeric=["noise", "prime_age_not_in_labor_force"])
    grid = scenario_grid(table.limit(20), "prime_age_not_in_labor_force")
    values = [r[0] for r in score_scenarios(
        grid, model, column="prime_age_not_in_labor_force", output="income_predicted"
    ).collect()]
    assert values == sorted(values) and len(values) == 120


def test_store_replaces(table, linear, tmp_path):
    other = fit_linear(table, label="noise", numeric=["percent_not_in_labor_force"])
    save_model(other, str(tmp_path), "m")
    save_model(linear, str(tmp_path), "m")
    loaded = load_model(str(tmp_path), "m")
    first = table.orderBy("geo_id").limit(5)
    assert [tuple(r) for r in predict(first, loaded).collect()] == [
        tuple(r) for r in predict(first, linear).collect()
    ]


def test_search_fails_without_a_hold_out(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "v double, y double")
    with pytest.raises(ValueError, match="too few rows"):
        fit_best(one, label="y", numeric=["v"])


def test_trees_take_as_many_bins_as_a_category_has_values(spark):
    rows = spark.createDataFrame([(f"c{i % 200}", float(i % 200)) for i in range(800)], "c string, y double")
    model = fit_best(rows, label="y", numeric=[], categorical=["c"], candidates=[DecisionTreeRegressor(maxBins=32)])
    assert predict(rows, model).count() == 800
