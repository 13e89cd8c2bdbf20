import pytest
from pyspark.sql import functions as F

from tractwise.columns import EXPOSURES, EXPOSURE_TOTAL, INDUSTRY_COLUMNS
from tractwise.operators import (
    derived_population, dispatch_measure, dispatch_unpivot, drop_columns, random_amount,
    replace_last, scenario_grid, select_features, weighted_exposure,
)


def test_exposure_total_is_null_if_a_part_is(spark):
    columns = [c for c, _, _ in EXPOSURES]
    df = spark.createDataFrame(
        [tuple([100.0] * 10), (None, *[100.0] * 9)], ", ".join(f"{c} double" for c in columns)
    )
    full, partial = weighted_exposure(
        df, EXPOSURES, total="total_vulnerable", total_of=EXPOSURE_TOTAL
    ).collect()
    assert full.employed_retail_trade_vulnerable == 51.0
    assert full.total_vulnerable == pytest.approx(100 * sum(w for _, w, _ in EXPOSURES))
    assert partial.total_vulnerable is None and partial.employed_retail_trade_vulnerable == 51.0
    assert "employed_information_vulernable" in full.asDict()


def test_dispatch_by_label_and_by_unpivot(spark):
    columns = list(dict.fromkeys(INDUSTRY_COLUMNS.values()))
    df = spark.createDataFrame(
        [("z", *[float(i) for i in range(len(columns))])],
        "zip string, " + ", ".join(f"{c} double" for c in columns),
    )
    dim = spark.createDataFrame(
        [(label, 0.5) for label in INDUSTRY_COLUMNS] + [("Unknown", 0.5)], "occupation string, rate double"
    )
    chosen = dispatch_measure(
        df.join(dim), key="occupation", mapping=INDUSTRY_COLUMNS, factor="rate", output="v"
    )
    by_label = {r.occupation: r.v for r in chosen.collect()}
    assert by_label.pop("Unknown") is None
    assert by_label == {label: columns.index(c) * 0.5 for label, c in INDUSTRY_COLUMNS.items()}
    long = dispatch_unpivot(
        df, dim, key="occupation", mapping=INDUSTRY_COLUMNS, factor="rate", output="v", keep=["zip"]
    )
    assert {r.occupation: r.v for r in long.collect()} == by_label


def test_population_clamp(spark):
    df = spark.createDataFrame(
        [(5.0, 10.0), (-5.0, 10.0), (None, 10.0), (5.0, 0.0), (-5.0, 0.0), (5.0, None)],
        "raw double, total_pop double",
    )
    rows = derived_population(df, raw=F.col("raw"), count="n", share="p").collect()
    assert [(r.n, r.p) for r in rows] == [
        (5.0, 0.5), (0.0, 0.0), (None, None), (5.0, None), (0.0, None), (5.0, None),
    ]


def test_scenario_grid(spark):
    df = spark.createDataFrame([(1, 10.0, "x"), (2, None, "y")], "id int, v double, w string")
    grid = scenario_grid(df, "v", step="j")
    assert grid.columns == ["id", "w", "j", "v"]
    rows = grid.collect()
    assert len(rows) == 12
    assert sorted(r.v for r in rows if r.id == 1) == [10.0 * 1.5 ** j for j in range(6)]
    assert all(r.v is None for r in rows if r.id == 2)
    first = scenario_grid(df, "v", step="j").where("j = 0").drop("j").select(*df.columns)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, df.collect()))


def test_grid_and_population_accept_a_stream(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as double) v").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("v double").parquet(str(tmp_path / "in"))
    assert scenario_grid(stream, "v").isStreaming
    assert derived_population(stream, raw=F.col("v"), total="v").isStreaming


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert replace_last(df, "a", F.col("a") * 2).collect()[0].asDict() == {"b": 2, "c": 3, "a": 2}
    assert replace_last(df, "a", F.col("a")).columns == ["b", "c", "a"]
    assert drop_columns(df, ["b", "zz"]).columns == ["a", "c"]
    assert select_features(df, ["c", "a"]).columns == ["c", "a"]


def test_random_amount(spark):
    df = spark.range(1000)
    keyed = [r.v for r in random_amount(df, "v", keys=["id"]).collect()]
    assert keyed == [r.v for r in random_amount(df.repartition(7), "v", keys=["id"]).orderBy("id").collect()]
    plain = [r.v for r in random_amount(df, "v").collect()]
    for values in (keyed, plain):
        assert 0 <= min(values) and max(values) < 100 and 45 < sum(values) / 1000 < 55
