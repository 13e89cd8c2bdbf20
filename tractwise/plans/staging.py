"""Area tables: income change, exposure by industry, the prime-age measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tractwise.columns import (
    BOUNDARY_TOLERANCE_M, EXPOSURES, EXPOSURE_TOTAL, INDUSTRY_COLUMNS, LEAKS,
)
from tractwise.operators.boundaries import simplify_boundaries
from tractwise.operators.columns import (
    derived_population, dispatch_measure, drop_columns, random_amount, weighted_exposure,
)
from tractwise.operators.joins import cast_key_join, cross_dimension, period_diff, prefix_join

#: State codes are two characters, so the prefix of an area id is a plain key.
STATE_PREFIX = 2


def income_change(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Change of median income per area, 2015 to 2018."""
    return period_diff(
        current, previous, key="geo_id", measure="median_income", labels=("2018", "2015")
    )


def zip_exposure(
    census: DataFrame,
    change: DataFrame,
    boundaries: DataFrame,
    *,
    tolerance_m: float = BOUNDARY_TOLERANCE_M,
) -> DataFrame:
    """ZIP areas with state name, income change, vulnerable jobs and outline."""
    outlines = simplify_boundaries(
        boundaries.select("zip_code", "state_name", "zip_code_geom"),
        "zip_code_geom", tolerance_m=tolerance_m,
    ).withColumnRenamed("zip_code_geom", "zip_geom")
    base = cast_key_join(
        census.alias("census"), change, left_key="geo_id", right_key="geo_id", keep=["median_income_diff"]
    )
    joined = cast_key_join(
        base, outlines, left_key="geo_id", right_key="zip_code", keep=["state_name", "zip_geom"]
    )
    exposed = weighted_exposure(
        joined, EXPOSURES, total="total_vulnerable", total_of=EXPOSURE_TOTAL
    )
    return exposed.select(
        "state_name", "census.*", "median_income_diff",
        *[out for _, _, out in EXPOSURES], "zip_geom", "total_vulnerable",
    )


def zip_by_industry(zips: DataFrame, industries: DataFrame) -> DataFrame:
    """Every ZIP area with every industry."""
    return cross_dimension(zips, industries)


def zip_vulnerable_workers(zips_by_industry: DataFrame, *, seed: int = 0) -> DataFrame:
    """Vulnerable employees of the row's industry, and a placeholder claim count."""
    workers = dispatch_measure(
        zips_by_industry, key="occupation", mapping=INDUSTRY_COLUMNS,
        factor="percent_jobs_vulnerable", output="vulnerable_employees",
    )
    return random_amount(workers, "num_claims", keys=["geo_id", "occupation"], seed=seed)


def zip_non_labor(workers: DataFrame) -> DataFrame:
    """The prime-age measure next to each ZIP and industry. A ZIP's measure
    repeats per industry; do not sum it over this table."""
    return derived_population(workers)


def tract_all(census: DataFrame, change: DataFrame, states: DataFrame) -> DataFrame:
    """Tracts with state, income change and the prime-age measure. Tracts without
    an income change or a known state prefix are left out."""
    located = prefix_join(
        census.alias("census"), states.select("fips", F.col("postal_code").alias("state")),
        column="geo_id", prefix="fips", keep=["state"], length=STATE_PREFIX,
    )
    joined = cast_key_join(
        located, change, left_key="geo_id", right_key="geo_id", keep=["median_income_diff"]
    )
    return derived_population(joined.select("state", "census.*", "median_income_diff"))


def tract_training(tracts: DataFrame) -> DataFrame:
    """The same tracts without the columns that give the label away."""
    return drop_columns(tracts, LEAKS)
