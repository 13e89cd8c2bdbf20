"""Small census tables with the cases results depend on."""

from __future__ import annotations

from tractwise.columns import (
    FEATURES, INDUSTRY_COLUMNS, LEAKS, MINORS, NUMERIC_FEATURES, SENIORS,
)

PARTS = ["unemployed_pop", "not_in_labor_force", "group_quarters", "in_school", *MINORS, *SENIORS]
MEASURES = list(dict.fromkeys([
    *PARTS, "total_pop", *[c for c in LEAKS if c != "do_date"],
    *[c for c in NUMERIC_FEATURES if c != "median_income_diff"],
]))

STATE_CODES = "state,postal_code,fips\nAlabama,AL,01\nAlaska,AK,02\nArizona,AZ,04\nArkansas,AR,05\n"


def tract(geo_id: str, unemployed: float | None, total: float | None = 1000.0, **other) -> tuple:
    """A tract whose raw measure is ``unemployed``: all its other parts are zero."""
    values = {c: 0.0 for c in MEASURES}
    number = float(int(geo_id[-3:]))
    values.update({c: number % 7 for c in NUMERIC_FEATURES if c in values and c not in PARTS})
    values.update(unemployed_pop=unemployed, total_pop=total, high_school_including_ged=100.0 + number)
    values.update(other)
    return (geo_id, "20170101", 20000.0 + 10 * number, *[values[c] for c in MEASURES])


TRACT_SCHEMA = "geo_id string, do_date string, income_per_capita double, " + ", ".join(
    f"{c} double" for c in MEASURES
)

TRACTS = [
    tract("01000000001", 50.0),
    tract("01000000002", 200.0),
    tract("01000000003", 200.0),                    # tie at the state maximum
    tract("01000000004", 200.0),
    tract("01000000005", -30.0),                    # negative raw measure
    tract("02000000006", 70.0),                     # the only tract of its state
    tract("04000000007", None),                     # state with NULL measures only
    tract("05000000008", 90.0, total=0.0),          # no population: NULL share
    tract("05000000009", 80.0, in_school=20.0, male_under_5=15.0),
    tract("11000000010", 500.0),                    # prefix of no listed state
    tract("01000000011", 900.0),                    # income in one vintage only
    tract("01000000012", 900.0),                    # NULL income in one vintage
    tract("05000000013", 10.0),
    tract("05000000014", 20.0),
]
INCOME_2018 = [(t[0], 100.0 + i) for i, t in enumerate(TRACTS)]
INCOME_2015 = [
    (g, None if g == "01000000012" else 90.0) for g, _ in INCOME_2018 if g != "01000000011"
] + [("99000000000", 1.0)]

ZIP_MEASURES = list(dict.fromkeys([*PARTS, "total_pop", *INDUSTRY_COLUMNS.values()]))
ZIP_SCHEMA = "geo_id string, " + ", ".join(f"{c} double" for c in ZIP_MEASURES)


def zip_area(geo_id: str, **other) -> tuple:
    values = {c: 0.0 for c in ZIP_MEASURES}
    values.update({c: 100.0 for c in INDUSTRY_COLUMNS.values()}, total_pop=100.0, unemployed_pop=5.0)
    values.update(other)
    return (geo_id, *[values[c] for c in ZIP_MEASURES])


ZIPS = [zip_area("00501"), zip_area("00502", employed_information=None), zip_area("00503")]
ZIP_2018 = [("00501", 10.0), ("00502", 20.0), ("00503", 30.0)]
ZIP_2015 = [("00501", 4.0), ("00502", 5.0), ("00503", 6.0)]
SQUARE = [(0.0, 0.0), (0.5, 0.0001), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
BOUNDARIES = [
    ("00501", "New York", SQUARE), ("00502", "New York", SQUARE),
    ("00503", "New York", SQUARE), ("00503", "New Jersey", SQUARE),  # listed twice
]
BOUNDARY_SCHEMA = (
    "zip_code string, state_name string, zip_code_geom array<struct<lon: double, lat: double>>"
)
INDUSTRIES = [(label, 0.5) for label in INDUSTRY_COLUMNS] + [("Fortune Telling", 0.5)]


def tables(spark) -> dict:
    income = "geo_id string, median_income double"
    return {
        "tract_2017": spark.createDataFrame(TRACTS, TRACT_SCHEMA),
        "tract_2018": spark.createDataFrame(INCOME_2018, income),
        "tract_2015": spark.createDataFrame(INCOME_2015, income),
        "zip_2017": spark.createDataFrame(ZIPS, ZIP_SCHEMA),
        "zip_2018": spark.createDataFrame(ZIP_2018, income),
        "zip_2015": spark.createDataFrame(ZIP_2015, income),
        "zip_boundaries": spark.createDataFrame(BOUNDARIES, BOUNDARY_SCHEMA),
        "vulnerable_industries": spark.createDataFrame(
            INDUSTRIES, "occupation string, percent_jobs_vulnerable double"
        ),
    }


assert len(FEATURES) == 72
