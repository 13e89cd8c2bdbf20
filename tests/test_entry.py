"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import database, difference

FOLDER = "/root/testdata/sf0.001"
#: The fits of 72 features need more tracts than the smallest tables have to give all digits compared.
LARGER = dict.fromkeys(
    ("automl_labor_scenarios", "scored_predictions", "importance_report"), "/root/testdata/sf0.01")
#: Nothing is to be found in the smallest tables: their tests plant cases of their own.
MAY_BE_EMPTY = {"op2_secret_scan"}


@pytest.fixture(scope="module")
def bases():
    return {folder: database(folder) for folder in {FOLDER, *LARGER.values()}}


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.columns[:2] == ["state", "geo_id"] and result.count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, bases, name):
    folder = LARGER.get(name, FOLDER)
    result = entry.queries()[name](spark, folder)
    if name in entry.oracle_sql():
        assert difference(result, entry.oracle_sql()[name], bases[folder]) == ""
    else:
        assert result.count() > 0 or name in MAY_BE_EMPTY
