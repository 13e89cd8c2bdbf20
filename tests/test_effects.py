"""Effects of many categories against indicators and least squares in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractwise.operators import fit_absorbed, fit_linear, load_absorbed, predict


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(900).select(
        i, F.when(i % 41 > 0, F.concat(F.lit("g"), (F.pmod(F.xxhash64(i), F.lit(60))).cast("string"))).alias("g"),
        F.pmod(F.xxhash64(i, F.lit(3)), F.lit(25)).cast("int").alias("h"),
        F.when(i % 37 > 0, (i * 7 % 101).cast("double")).alias("x"), (i * 13 % 89 / 7.0).alias("z"),
    ).withColumn("y", F.expr(
        "case when id % 53 = 0 then null else coalesce(x, 50) * 2 - z * z / 9 + 10 * length(coalesce(g, 'none')) + h + id % 5 end")).cache()


def by_indicators(rows, categories):
    data = [r for r in rows.orderBy("id").collect()]
    kept = [r for r in data if r.y is not None]
    mean = {c: np.mean([r[c] for r in kept if r[c] is not None]) for c in ("x", "z")}
    columns = [[r[c] if r[c] is not None else mean[c] for r in data] for c in ("x", "z")]
    for c in categories:
        columns += [[float(r[c] == v) for r in data] for v in {r[c] for r in kept}]
    design = np.array(columns).T
    there = np.array([r.y is not None for r in data])
    beta = np.linalg.lstsq(design[there], np.array([r.y for r in kept]), rcond=None)[0]
    return beta[:2], {r.id: v for r, v in zip(data, design @ beta)}


@pytest.mark.parametrize("categories", [["g"], ["h", "g"]])
def test_equals_indicators(rows, categories, tmp_path):
    model = fit_absorbed(rows, label="y", numeric=["x", "z"], categorical=categories)
    beta, expected = by_indicators(rows, categories)
    assert [model.coefficients["x"], model.coefficients["z"]] == pytest.approx(beta, abs=1e-7)
    scored = model.transform(rows)
    assert scored.columns == [*rows.columns, "predicted_label"] and scored.count() == 900
    assert {r.id: r.predicted_label for r in scored.collect()} == pytest.approx(expected, abs=1e-6)
    assert (model.sweeps == 1) == (len(categories) == 1)
    model.save(str(tmp_path), "effects")
    model.save(str(tmp_path), "effects")
    again = load_absorbed(rows.sparkSession, str(tmp_path), "effects").transform(rows)
    assert {r.id: r.predicted_label for r in again.collect()} == pytest.approx(expected, abs=1e-6)


def test_equals_the_other_linear_fit(rows):
    some = rows.where("g is not null and y is not null and x is not null")
    other = {r.id: r.predicted_label for r in predict(
        some, fit_linear(some, label="y", numeric=["x", "z"], categorical=["g"])).collect()}
    model = fit_absorbed(some, label="y", numeric=["x", "z"], categorical=["g"])
    assert {r.id: r.predicted_label for r in model.transform(some).collect()} == pytest.approx(other, abs=1e-5)


def test_a_category_per_row_leaves_no_coefficient(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("geo_id"), (F.col("id") / 7).alias("x"), F.sqrt("id").alias("y"))
    model = fit_absorbed(df, label="y", numeric=["x"], categorical=["geo_id"])
    assert model.coefficients == {"x": 0.0}
    assert all(r.predicted_label == pytest.approx(r.y, abs=1e-9) for r in model.transform(df).collect())
    constant = df.select((F.col("geo_id").cast("int") % 5).alias("g"), (F.col("geo_id").cast("int") % 5 / 3).alias("x"), "y")
    assert fit_absorbed(constant, label="y", numeric=["x"], categorical=["g"]).coefficients == {"x": 0.0}


def test_unseen_null_and_missing(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 5.0), (None, 2.0, 13.0), ("b", float("nan"), 4.0), ("c", 1.0, None)],
                               "g string, x double, y double")
    model = fit_absorbed(df, label="y", numeric=["x"], categorical=["g"])
    assert model.coefficients["x"] == pytest.approx(2) and model.means["x"] == pytest.approx(2)
    new = spark.createDataFrame([("zz", 2.0, "k"), (None, 2.0, "k"), ("a", None, "k")], "g string, x double, value string")
    found = {r.g: r.predicted_label for r in model.transform(new).collect()}
    assert found == pytest.approx({"zz": (3 * 2 + 13 + 4) / 4, None: 13, "a": 3}) and model.transform(new).columns[:3] == new.columns
    with pytest.raises(ValueError, match="no row"):
        fit_absorbed(df.where("false"), label="y", numeric=["x"], categorical=["g"])
    with pytest.raises(ValueError, match="fit_linear"):
        fit_absorbed(df, label="y", numeric=["x"], categorical=[])


def test_categories_that_hardly_differ_are_refused(spark):
    df = spark.range(200).select((F.col("id") % 20).alias("g"), ((F.col("id") + F.when(F.col("id") < 190, 0).otherwise(1)) % 20).alias("h"),
                                 F.rand(1).alias("x"), F.rand(2).alias("y"))
    with pytest.raises(ValueError, match="still move"):
        fit_absorbed(df, label="y", numeric=["x"], categorical=["g", "h"], most_sweeps=3)
