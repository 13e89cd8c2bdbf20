import pytest
from pyspark.sql import functions as F

from tractwise.operators import argmax_rows, group_max, top_k_rows

DATA = [
    ("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 9.0), ("a", 4, None), ("b", 5, -1.0),
    ("c", 6, None), (None, 7, 3.0),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, "g string, id int, m double")


def ids(result):
    return sorted(r.id for r in result.collect())


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_argmax_keeps_every_tie_and_drops_null_groups(df, max_bytes, plan_of):
    result = argmax_rows(df, "g", "m", max_bytes=max_bytes)
    assert result.columns == df.columns
    assert ("SortMergeJoin" in plan_of(result)) == (max_bytes == 0)
    assert ids(result) == [2, 3, 5]


def test_argmax_of_a_group_that_is_one_tie(spark):
    hot = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.col("id"), F.when(F.col("id") % 3 > 0, 0.0).otherwise(F.col("id").cast("double")).alias("m"),
    )
    for max_bytes in (0, 1 << 20):
        found = argmax_rows(hot, "g", "m", max_bytes=max_bytes)
        assert found.where("g = 'hot'").count() == hot.where("g = 'hot'").count()
        assert found.where("g <> 'hot'").count() == 50


def test_a_giant_tie_is_dealt_over_tasks(spark):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("g"),
        F.lit(1.0).alias("m"), F.lit("same").alias("text"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = argmax_rows(rows, "g", "m", max_bytes=0, rows_per_task=500)
        assert found.columns == rows.columns
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 60000 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_group_max_by_several_columns(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 1, 3), (1, 2, 1)], "a int, b int, m int")
    assert sorted(map(tuple, group_max(df, ["a", "b"], "m").collect())) == [(1, 1, 3), (1, 2, 1)]


def test_top_k_breaks_ties_and_puts_null_last(df, plan_of):
    result = top_k_rows(df, "g", "m", 2, tie_break="id", rank="place")
    assert sorted((str(r.g), r.id, r.place) for r in result.collect()) == [
        ("None", 7, 1), ("a", 2, 1), ("a", 3, 2), ("b", 5, 1), ("c", 6, 1),
    ]
    assert "WindowGroupLimit" in plan_of(result)


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_top_k_through_a_unique_key_is_the_same(df, max_bytes, plan_of):
    wide = df.withColumn("extra", F.col("id") * 10)
    plain = top_k_rows(wide, "g", "m", 2, tie_break="id", rank="place")
    picked = top_k_rows(wide, "g", "m", 2, tie_break="id", rank="place", unique=True, max_bytes=max_bytes)
    assert picked.columns == plain.columns == [*wide.columns, "place"]
    assert ("BroadcastHashJoin" in plan_of(picked)) == (max_bytes > 0)
    assert sorted(map(str, picked.collect())) == sorted(map(str, plain.collect()))
    unnamed = top_k_rows(wide, "g", "m", 1, tie_break="id", unique=True)
    assert unnamed.columns == wide.columns and ids(unnamed) == [2, 5, 6, 7]


def test_large_k_equals_a_plain_ranking(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 4).alias("g"),
        F.col("id"), (F.xxhash64("id") % 100).alias("m"),
    )
    data = df.collect()
    for k in (1200, 20000):
        expected = set()
        for g in {r.g for r in data}:
            group = sorted((r for r in data if r.g == g), key=lambda r: (-r.m, r.id))
            expected |= {r.id for r in group[:k]}
        assert set(ids(top_k_rows(df, "g", "m", k, tie_break="id"))) == expected
        assert set(ids(top_k_rows(df, "g", "m", k, tie_break="id", unique=True))) == expected


def test_unique_top_rows_stay_k_where_an_id_occurs_twice(spark):
    rows = spark.createDataFrame([("a", "t1", 9), ("a", "t1", 9), ("a", "t2", 5)], "g string, id string, m int")
    for k in (1, 2, 3):
        assert top_k_rows(rows, "g", "m", k, tie_break="id", unique=True).count() == k
