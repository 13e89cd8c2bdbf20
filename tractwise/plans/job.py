"""The analysis as steps over catalog tables.

Steps run in the order tables, models, inputs, importance. Each reads stored
tables and stores its results, so a lost driver repeats one step only.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tractwise.columns import GRADUATES, LEAKS, SHARE
from tractwise.operators.models import load_model, save_model
from tractwise.plans import importance, scenarios, staging
from tractwise.sources.files import export_csv, read_state_codes
from tractwise.sources.tables import (
    ensure_schema, replace_table, replace_view, write_counted,
)

INCOME_MODEL = "economic_impact"
LABOR_MODEL = "labor_force_prediction"
PREDICTIONS = "prediction_"


def build_tables(
    spark: SparkSession,
    source: str,
    states_csv: str,
    *,
    stage: str = "staging",
    curated: str = "curated",
    buckets: int | None = None,
) -> None:
    """All area tables, from the census tables in schema ``source``.

    The three tables by industry are each computed from ``census_zip``, which is
    a twelfth of their size. The training table is a view that leaves columns out.
    ``buckets`` stores the income changes by hash of the area id, so that census
    tables bucketed alike are joined to them without a shuffle.
    """
    layout = (buckets, "geo_id") if buckets else None

    def given(name: str) -> DataFrame:
        return spark.table(f"{source}.{name}")

    ensure_schema(spark, stage)
    ensure_schema(spark, curated)
    loaded = write_counted(read_state_codes(spark, states_csv), f"{stage}.state_fips")
    print(f"Loaded {loaded} rows into {stage}.state_fips")
    states = spark.table(f"{stage}.state_fips")

    tract_change = replace_table(
        staging.income_change(given("tract_2018"), given("tract_2015")),
        f"{stage}.median_income_diff_by_tract", buckets=layout,
    )
    zip_change = replace_table(
        staging.income_change(given("zip_2018"), given("zip_2015")),
        f"{stage}.median_income_diff_by_zipcode", buckets=layout,
    )
    zips = replace_table(
        staging.zip_exposure(given("zip_2017"), zip_change, given("zip_boundaries")),
        f"{stage}.census_zip",
    )
    by_industry = staging.zip_by_industry(zips, given("vulnerable_industries"))
    workers = staging.zip_vulnerable_workers(by_industry)
    replace_table(by_industry, f"{stage}.census_zip_xjoin_industries")
    replace_table(workers, f"{stage}.census_zip_vuln_workers")
    replace_table(staging.zip_non_labor(workers), f"{curated}.census_zip_non_labor")
    replace_table(
        staging.tract_all(given("tract_2017"), tract_change, states), f"{stage}.census_tract_all"
    )
    replace_view(
        spark, f"{stage}.census_tract_training",
        f"SELECT * EXCEPT ({', '.join(LEAKS)}) FROM {stage}.census_tract_all",
    )


def build_models(
    spark: SparkSession, models: str, *, stage: str = "staging", **options: object
) -> None:
    """Fit and store both models under the path ``models``."""
    training = spark.table(f"{stage}.census_tract_training")
    save_model(scenarios.income_model(training), models, INCOME_MODEL)
    save_model(scenarios.labor_model(training, **options), models, LABOR_MODEL)


def build_inputs(spark: SparkSession, models: str, *, stage: str = "staging") -> None:
    """Tables the models are applied to."""
    tracts, states = spark.table(f"{stage}.census_tract_all"), spark.table(f"{stage}.state_fips")
    disengaged = replace_table(
        scenarios.most_disengaged(tracts, states), f"{stage}.max_not_in_labor_per_state"
    )
    replace_table(
        scenarios.economic_impact_input(disengaged, load_model(models, INCOME_MODEL)),
        f"{stage}.ml_input_econ_impact",
    )
    top = replace_table(scenarios.top_tracts(tracts), f"{stage}.ml_input_automl_baseline")
    chosen = replace_table(
        scenarios.scenario_tracts(top, disengaged), f"{stage}.max_automl_scenario"
    )
    replace_table(
        scenarios.graduate_scenarios(chosen, states), f"{stage}.ml_input_automl_scenarios"
    )


def build_importance(
    spark: SparkSession, models: str, *, stage: str = "staging", run: str | None = None, export: str | None = None,
    **options: object,
) -> None:
    """Score the top tracts with attributions into a schema of their own, then store
    them per state: wide, ranked per tract, and as the report with tracts as columns.
    Only this run's schema is read back. ``export`` is a folder for the wide table and
    the report as CSV."""
    run = run or datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
    ensure_schema(spark, f"{PREDICTIONS}{run}")
    predictions = importance.scored_predictions(
        spark.table(f"{stage}.ml_input_automl_baseline"),
        spark.table(f"{stage}.census_tract_training"),
        load_model(models, LABOR_MODEL),
        **options,
    )
    replace_table(predictions, f"{PREDICTIONS}{run}.predictions")
    found = f"{PREDICTIONS}{run}"
    table = replace_table(
        importance.importance_table(spark.table(f"{found}.predictions")),
        f"{found}.feature_importance", group="state_code",
    )
    replace_table(importance.ranked_importance(table), f"{found}.ranked_importance", group="state")
    report = replace_table(importance.importance_report(table), f"{found}.importance_report", group="state")
    if export:
        export_csv(table, f"{export.rstrip('/')}/feature_importance")
        export_csv(report, f"{export.rstrip('/')}/importance_report")


def impact_report(
    spark: SparkSession, models: str, *, stage: str = "staging", state: str | None = None
) -> DataFrame:
    """The what-if result of all states, stored as ``economic_impact``; of it all, or one state."""
    inputs = spark.table(f"{stage}.ml_input_econ_impact")
    stored = replace_table(
        scenarios.economic_impact(inputs, load_model(models, INCOME_MODEL)), f"{stage}.economic_impact")
    return stored.where(F.col("state") == state) if state else stored


def scenario_report(
    spark: SparkSession, models: str, *, stage: str = "staging", state: str | None = None
) -> DataFrame:
    """Graduates and predicted share of all tracts and steps, stored as ``labor_scenarios``; of it the two
    columns in ascending order, for all or one state."""
    rows = spark.table(f"{stage}.ml_input_automl_scenarios")
    stored = replace_table(
        scenarios.scenario_report(rows, load_model(models, LABOR_MODEL), keep=("state", "geo_id")),
        f"{stage}.labor_scenarios")
    kept = stored.where(F.col("state") == state) if state else stored
    return kept.select(GRADUATES, SHARE).orderBy(GRADUATES)
