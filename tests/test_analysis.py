"""The whole analysis on small census tables."""

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression

from tests import fixtures
from tractwise.__main__ import main
from tractwise.columns import EXPOSURES, FEATURES, INDUSTRY_COLUMNS, LEAKS, MEASURE, SHARE
from tractwise.plans import importance, job


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    spark.sql("create schema if not exists census")
    for name, df in fixtures.tables(spark).items():
        df.write.mode("overwrite").saveAsTable(f"census.{name}")
    folder = tmp_path_factory.mktemp("analysis")
    (folder / "codes.csv").write_text(fixtures.STATE_CODES)
    models = str(folder / "models")
    main(["tables", "--source", "census", "--states", str(folder / "codes.csv"), "--buckets", "2"])
    job.build_models(spark, models, candidates=[LinearRegression(), DecisionTreeRegressor(maxDepth=2, maxBins=64)], train_ratio=0.6)
    main(["inputs", "--models", models])
    job.build_importance(spark, models, run="1", export=str(folder / "export"))
    return models


def rows(spark, name):
    return spark.table(name).collect()


def test_row_loss_and_income_change(built, spark):
    change = {r.geo_id: r.median_income_diff for r in rows(spark, "staging.median_income_diff_by_tract")}
    assert change["01000000001"] == 10.0
    assert "01000000011" not in change and "01000000012" not in change and "99000000000" not in change
    kept = {r.geo_id for r in rows(spark, "staging.census_tract_all")}
    assert kept == set(change) - {"11000000010"}


def test_measures_and_leaks(built, spark):
    tracts = {r.geo_id: r for r in rows(spark, "staging.census_tract_all")}
    assert (tracts["01000000001"][MEASURE], tracts["01000000001"][SHARE]) == (50.0, 0.05)
    assert (tracts["01000000005"][MEASURE], tracts["01000000005"][SHARE]) == (0.0, 0.0)
    assert (tracts["04000000007"][MEASURE], tracts["04000000007"][SHARE]) == (None, None)
    assert (tracts["05000000008"][MEASURE], tracts["05000000008"][SHARE]) == (90.0, None)
    assert tracts["05000000009"][MEASURE] == 75.0
    assert tracts["02000000006"].state == "AK"
    everything = spark.table("staging.census_tract_all").columns
    assert everything[0] == "state" and everything[-3:] == ["median_income_diff", MEASURE, SHARE]
    training = spark.table("staging.census_tract_training").columns
    assert training == [c for c in everything if c not in LEAKS]


def test_zip_tables(built, spark):
    zips = rows(spark, "staging.census_zip")
    assert sorted((r.geo_id, r.state_name) for r in zips) == [
        ("00501", "New York"), ("00502", "New York"), ("00503", "New Jersey"), ("00503", "New York"),
    ]
    by_id = {r.geo_id: r for r in zips}
    assert by_id["00501"].total_vulnerable == pytest.approx(100 * sum(w for _, w, _ in EXPOSURES))
    assert by_id["00502"].total_vulnerable is None
    assert len(by_id["00501"].zip_geom) == 5
    curated = rows(spark, "curated.census_zip_non_labor")
    assert len(curated) == 4 * 13
    first = [r for r in curated if r.geo_id == "00501"]
    assert {r.occupation: r.vulnerable_employees for r in first} == {
        **dict.fromkeys(INDUSTRY_COLUMNS, 50.0), "Fortune Telling": None,
    }
    assert all((r[MEASURE], r[SHARE]) == (5.0, 0.05) for r in first)
    assert all(0 <= r.num_claims < 100 for r in curated)
    assert spark.table("staging.census_zip_xjoin_industries").columns[:2] == ["occupation", "percent_jobs_vulnerable"]
    assert spark.table("staging.census_zip_vuln_workers").count() == 52


def test_top_tracts_and_scenarios(built, spark):
    top = sorted((r.state, r.geo_id) for r in rows(spark, "staging.max_not_in_labor_per_state"))
    assert top == [
        ("AK", "02000000006"), ("AL", "01000000002"), ("AL", "01000000003"), ("AL", "01000000004"),
        ("AR", "05000000008"),
    ]
    baseline = spark.table("staging.ml_input_automl_baseline")
    assert baseline.columns == FEATURES
    assert sorted((r.state, r.geo_id) for r in baseline.collect()) == [
        ("AK", "02000000006"), ("AL", "01000000002"), ("AL", "01000000003"),
        ("AR", "05000000008"), ("AR", "05000000009"), ("AZ", "04000000007"),
    ]
    chosen = sorted(r.geo_id for r in rows(spark, "staging.max_automl_scenario"))
    assert chosen == ["01000000002", "01000000003", "02000000006", "05000000008"]
    grid = spark.table("staging.ml_input_automl_scenarios")
    assert grid.columns[-1] == "high_school_including_ged" and grid.count() == 24
    assert sorted(r[0] for r in grid.where("geo_id = '02000000006'").select("high_school_including_ged").collect()) == [
        106.0 * 1.5 ** j for j in range(6)
    ]


def test_reports(built, spark, capsys):
    report = job.impact_report(spark, built, state="AL")
    assert report.columns == ["state", "geo_id", "new_labor_force", "new_income", "net_income_increase"]
    assert {r.new_labor_force for r in report.collect()} == {10}
    assert job.impact_report(spark, built).where("geo_id = '05000000008'").first().new_labor_force is None
    scenario = job.scenario_report(spark, built)
    assert scenario.columns == ["high_school_including_ged", SHARE] and scenario.count() == 24
    assert job.scenario_report(spark, built, state="AK").count() == 6
    stored = spark.table("staging.labor_scenarios")
    assert stored.columns == ["state", "geo_id", "high_school_including_ged", SHARE] and stored.count() == 24
    main(["impact", "--models", built, "--state", "AK"])
    assert {r.state for r in rows(spark, "staging.economic_impact")} == {"AK", "AL", "AR"}
    assert "02000000006" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["tables", "--source", "census"])


def test_importance_tables(built, spark):
    wide = spark.table("prediction_1.feature_importance")
    assert wide.count() == 6 and set(importance.MODEL_FEATURES) < set(wide.columns)
    ranked = spark.table("prediction_1.ranked_importance")
    assert ranked.count() == 6 * 71
    assert set(ranked.columns) == {"state", "tract", "feature", "importance", "abs_value", "rank"}
    al = ranked.where("state = 'AL' and tract = '01000000002'").orderBy("rank").collect()
    sizes = [r.abs_value for r in al]
    assert sizes == sorted(sizes, reverse=True) and [r["rank"] for r in al] == list(range(1, 72))
    stored = spark.table("prediction_1.predictions")
    assert stored.columns[-2:] == ["predicted_label", "feature_importance"]
    report = spark.table("prediction_1.importance_report")
    assert set(report.columns) == {"state", "feature", "tract_1", "tract_2", "rank"} and report.count() == 4 * 71
    by_tract = {(r.tract, r.feature): r.importance for r in ranked.collect()}
    ak = report.where("state = 'AL'").orderBy("rank").collect()
    assert [by_tract["01000000002", r.feature] for r in ak] == [r.tract_1 for r in ak]
    assert [by_tract["01000000003", r.feature] for r in ak] == [r.tract_2 for r in ak]
    assert [abs(r.tract_1) for r in ak] == sorted((abs(r.tract_1) for r in ak), reverse=True)
    exported = f"{built.rsplit('/', 1)[0]}/export"
    assert spark.read.option("header", True).csv(f"{exported}/importance_report").count() == 4 * 71
    assert spark.read.option("header", True).csv(f"{exported}/feature_importance").count() == 6
