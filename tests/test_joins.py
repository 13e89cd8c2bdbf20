import pytest
from pyspark.sql import functions as F

from checks import census, registry  # noqa: F401
from tractwise.operators import (
    cast_key_join, cross_dimension, period_diff, prefix_join, restrict_to, union_all,
)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_period_diff_needs_both_vintages(spark):
    now = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("c", None)], "k string, m double")
    before = spark.createDataFrame([("a", 2.0), ("c", 1.0), ("d", 1.0)], "k string, m double")
    diff = period_diff(now, before, key="k", measure="m", labels=("2018", "2015"))
    assert diff.columns == ["k", "m_2018", "m_2015", "m_diff"]
    assert rows(diff) == [("a", 5.0, 2.0, 3.0)]


AREAS = ["01001", "01", "0", "", None, "02003", "11001", "x%y"]
PREFIXES = [("01", "AL"), ("0", "short"), ("01001", "exact"), ("", "empty"), (None, "none"), ("x%", "literal")]


def test_general_prefix_join_equals_brute_force(spark):
    df = spark.createDataFrame([(a,) for a in AREAS], "area string")
    prefixes = spark.createDataFrame(PREFIXES, "prefix string, name string")
    joined = prefix_join(df, prefixes, column="area", prefix="prefix", keep=["name"])
    expected = sorted(
        (a, name) for a in AREAS for p, name in PREFIXES
        if a is not None and p is not None and a.startswith(p)
    )
    assert rows(joined) == expected


def test_fixed_length_prefix_join_equals_general(spark, plan_of):
    df = spark.createDataFrame([(a,) for a in AREAS], "area string")
    prefixes = spark.createDataFrame([("01", "AL"), ("02", "AK"), (None, "none")], "prefix string, name string")
    general = prefix_join(df, prefixes, column="area", prefix="prefix", keep=["name"])
    fixed = prefix_join(df, prefixes, column="area", prefix="prefix", keep=["name"], length=2)
    assert rows(fixed) == rows(general) == [("01", "AL"), ("01001", "AL"), ("02003", "AK")]
    for plan in (plan_of(general), plan_of(fixed)):
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_prefix_of_another_length_fails_loudly(spark):
    df = spark.createDataFrame([("01001",)], "area string")
    prefixes = spark.createDataFrame([("01",), ("010",)], "prefix string")
    with pytest.raises(Exception, match="prefix not of length 2"):
        prefix_join(df, prefixes, column="area", prefix="prefix", keep=[], length=2).collect()


def test_cast_key_join_matches_text_and_fans_out(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([("1", "x"), ("1", "y"), ("3", "z")], "key string, w string")
    joined = cast_key_join(left, right, left_key="k", right_key="key", keep=["w"])
    assert rows(joined) == [(1, "a", "x"), (1, "a", "y")]


def test_cast_key_join_broadcasts_no_side_by_a_guess(spark, plan_of):
    # by its one row's guess the generated side is small, whatever the number of rows it makes
    left = spark.range(3).selectExpr("id as k", "id * 2 as v")
    right = spark.range(1).selectExpr("explode(sequence(0, 2)) as key").selectExpr("key", "cast(key as string) as w")
    joined = cast_key_join(left, right, left_key="k", right_key="key", keep=["w"])
    assert "Broadcast" not in plan_of(joined)
    assert rows(joined) == [(0, 0, "0"), (1, 2, "1"), (2, 4, "2")]


@pytest.mark.parametrize(
    "name", ["census_zip_non_labor", "census_zip_vuln_workers", "census_zip_xjoin_industries"])
def test_products_of_zips_bring_no_area_to_the_driver(spark, plan_of, name):
    assert "BroadcastExchange" not in plan_of(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_cross_dimension_both_ways(spark, plan_of):
    df = spark.createDataFrame([(i % 3, str(i)) for i in range(50)] + [(0, "0")] * 20, "k int, v string")
    dim = spark.createDataFrame([("a", 0.5), ("b", None), ("b", None)], "label string, rate double")
    small = cross_dimension(df, dim)
    blocks = cross_dimension(df, dim, max_bytes=0, blocks=4)
    expected = sorted(
        (label, str(rate), k, v) for label, rate in [("a", 0.5), ("b", None), ("b", None)]
        for k, v in [(i % 3, str(i)) for i in range(50)] + [(0, "0")] * 20
    )
    for result in (small, blocks):
        assert result.columns == ["label", "rate", "k", "v"]
        assert sorted((a, str(b), c, d) for a, b, c, d in result.collect()) == expected
        assert "NestedLoop" not in plan_of(result) and "Cartesian" not in plan_of(result)
    assert "Exchange hash" not in plan_of(small)


def test_cross_with_an_empty_dimension_is_empty(spark):
    dim = spark.createDataFrame([], "label string")
    assert cross_dimension(spark.range(3).toDF("k"), dim).count() == 0


def test_restrict_to_semi_and_inner(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    members = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(restrict_to(df, members, "k")) == [(1, "a")]
    assert rows(restrict_to(df, members, "k", how="inner")) == [(1, "a"), (1, "a")]
    with pytest.raises(ValueError):
        restrict_to(df, members, "k", how="left")


def test_union_all_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(union_all(a, a.select("v", "k"), a)) == [(1, "x")] * 3


def test_filters_reach_the_scan(spark, plan_of, tmp_path):
    spark.range(10).select(
        F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("m"), F.lit("z").alias("other")
    ).write.parquet(str(tmp_path / "v"))
    vintage = spark.read.parquet(str(tmp_path / "v"))
    plan = plan_of(period_diff(vintage, vintage, key="k", measure="m", labels=("a", "b")))
    assert "PushedFilters: [IsNotNull(m), IsNotNull(k)]" in plan
    assert "other" not in plan
