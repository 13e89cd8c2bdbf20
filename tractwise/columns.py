"""Column lists, weights and labels the analysis is defined by (data only)."""

from __future__ import annotations

# The model features, in order. The first two are the state code
# and the area id, the last is the income change joined on from two vintages.
FEATURES = [
    "state",
    "geo_id",
    "commuters_by_public_transportation",
    "vacant_housing_units",
    "vacant_housing_units_for_rent",
    "vacant_housing_units_for_sale",
    "percent_income_spent_on_rent",
    "families_with_young_children",
    "commute_10_14_mins",
    "commute_15_19_mins",
    "commute_20_24_mins",
    "commute_25_29_mins",
    "commute_30_34_mins",
    "commute_45_59_mins",
    "renter_occupied_housing_units_paying_cash_median_gross_rent",
    "mobile_homes",
    "housing_built_2005_or_later",
    "commute_5_9_mins",
    "commute_35_39_mins",
    "commute_40_44_mins",
    "commute_60_89_mins",
    "commute_90_more_mins",
    "commuters_by_bus",
    "commuters_by_carpool",
    "commuters_by_subway_or_elevated",
    "commuters_drove_alone",
    "employed_agriculture_forestry_fishing_hunting_mining",
    "employed_arts_entertainment_recreation_accommodation_food",
    "employed_construction",
    "employed_education_health_social",
    "employed_finance_insurance_real_estate",
    "employed_information",
    "employed_manufacturing",
    "employed_other_services_not_public_admin",
    "employed_public_administration",
    "employed_retail_trade",
    "employed_science_management_admin_waste",
    "employed_transportation_warehousing_utilities",
    "employed_wholesale_trade",
    "high_school_including_ged",
    "households_public_asst_or_food_stamps",
    "in_school",
    "in_undergrad_college",
    "male_45_64_associates_degree",
    "male_45_64_bachelors_degree",
    "male_45_64_graduate_degree",
    "male_45_64_less_than_9_grade",
    "male_45_64_grade_9_12",
    "male_45_64_high_school",
    "male_45_64_some_college",
    "management_business_sci_arts_employed",
    "not_us_citizen_pop",
    "occupation_management_arts",
    "occupation_natural_resources_construction_maintenance",
    "occupation_production_transportation_material",
    "occupation_sales_office",
    "occupation_services",
    "pop_determined_poverty_status",
    "poverty",
    "sales_office_employed",
    "walked_to_work",
    "worked_at_home",
    "associates_degree",
    "bachelors_degree",
    "high_school_diploma",
    "less_one_year_college",
    "one_year_more_college",
    "commute_35_44_mins",
    "commute_60_more_mins",
    "commute_less_10_mins",
    "commuters_16_over",
    "median_income_diff",
]

# Columns that give the label away, left out of training data.
LEAKS = [
    "do_date",
    "civilian_labor_force",
    "pop_in_labor_force",
    "pop_16_over",
    "employed_pop",
    "unemployed_pop",
    "pop_25_years_over",
    "population_1_year_and_over",
    "population_3_years_over",
    "total_pop",
    "pop_25_64",
    "workers_16_and_over",
    "not_in_labor_force",
]

# Parts of the prime-age measure. `SENIORS` has no
# `female_85_and_over`; results depend on that.
MINORS = [
    "male_under_5",
    "male_5_to_9",
    "male_10_to_14",
    "male_15_to_17",
    "female_under_5",
    "female_5_to_9",
    "female_10_to_14",
    "female_15_to_17",
]
SENIORS = [
    "male_65_to_66",
    "male_67_to_69",
    "male_70_to_74",
    "male_75_to_79",
    "male_80_to_84",
    "male_85_and_over",
    "female_62_to_64",
    "female_65_to_66",
    "female_67_to_69",
    "female_70_to_74",
    "female_75_to_79",
    "female_80_to_84",
]

# Share of vulnerable jobs per employment column, and the name of
# the resulting column (one output name is misspelt on purpose: it is the
# published column name).
EXPOSURES = [
    ("employed_wholesale_trade", 0.38423645320197042,
     "employed_wholesale_trade_vulnerable"),
    ("occupation_natural_resources_construction_maintenance", 0.48071410777129553,
     "occupation_natural_resources_construction_maintenance_vulnerable"),
    ("employed_arts_entertainment_recreation_accommodation_food", 0.89455676291236841,
     "employed_arts_entertainment_recreation_accommodation_food_vulnerable"),
    ("employed_information", 0.31315240083507306,
     "employed_information_vulernable"),
    ("employed_retail_trade", 0.51,
     "employed_retail_trade_vulnerable"),
    ("employed_public_administration", 0.039299298394228743,
     "employed_public_administration_vulnerable"),
    ("occupation_services", 0.36555534476489654,
     "occupation_services_vulnerable"),
    ("employed_education_health_social", 0.20323178400562944,
     "employed_education_health_social_vulnerable"),
    ("employed_transportation_warehousing_utilities", 0.3680506593618087,
     "employed_transportation_warehousing_utilities_vulnerable"),
    ("employed_manufacturing", 0.40618955512572535,
     "employed_manufacturing_vulnerable"),
]

# The total adds wholesale trade last; the order decides the last digit of the sum.
EXPOSURE_TOTAL = [out for _, _, out in EXPOSURES[1:]] + [EXPOSURES[0][2]]

# Industry label to the employment column it is measured by.
INDUSTRY_COLUMNS = {
    "Retail Trade": "employed_retail_trade",
    "Financial Activities": "employed_finance_insurance_real_estate",
    "Mining, Logging, and Construction": "occupation_natural_resources_construction_maintenance",
    "Manufacturing": "employed_manufacturing",
    "Other Services": "employed_other_services_not_public_admin",
    "Wholesale Trade": "employed_wholesale_trade",
    "Transportation and Utilities": "employed_transportation_warehousing_utilities",
    "Education and Health Services": "employed_education_health_social",
    "Leisure and Hospitality": "employed_arts_entertainment_recreation_accommodation_food",
    "Professional and Business Services": "occupation_services",
    "Government": "employed_public_administration",
    "Information": "employed_information",
}

MEASURE = "prime_age_not_in_labor_force"
SHARE = "percent_not_in_labor_force"
GRADUATES = "high_school_including_ged"

# The area id has one value per row, so it identifies rows and is no predictor.
NUMERIC_FEATURES = [c for c in FEATURES if c not in ("state", "geo_id")]

# Tolerance, in metres, for generalising area boundaries.
BOUNDARY_TOLERANCE_M = 2100.0

# Growth factor and number of steps of the graduate scenarios.
SCENARIO_BASE = 1.5
SCENARIO_STEPS = 6
