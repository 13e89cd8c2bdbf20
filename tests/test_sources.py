import os

import pytest

from tests.fixtures import STATE_CODES
from tractwise import sources
from tractwise.operators import cast_key_join
from tractwise.session import checkpointed, fits_in_tasks, measured_bytes, scratch_path, shared_dir
from tractwise.streaming import append_scenarios


@pytest.fixture
def codes(tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text(STATE_CODES)
    return str(path)


def test_csv_keeps_leading_zeros(spark, codes):
    df = sources.read_state_codes(spark, codes)
    assert df.count() == 4 and df.first().fips == "01"
    assert [r[0] for r in sources.read_csv_column(spark, codes, "postal_code").collect()] == ["AL", "AK", "AZ", "AR"]
    assert sources.read_csv_column(spark, codes, "fips").first()[0] == "01"


def test_csv_row_that_does_not_fit_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception):
        sources.read_csv(spark, str(tmp_path / "bad.csv"), "a int, b int").collect()


def test_export_has_headers(spark, tmp_path):
    sources.export_csv(spark.range(3).toDF("n").coalesce(1), str(tmp_path / "out"))
    part = next(f for f in os.listdir(tmp_path / "out") if f.endswith(".csv"))
    assert (tmp_path / "out" / part).read_text() == "n\n0\n1\n2\n"


def test_grouped_files_keep_group_type(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("02", 2), ("01", 3)], "code string, v int")
    path = str(tmp_path / "grouped")
    sources.write_grouped(df, path, "code")
    current = sources.current_path(spark, path)
    assert {d for d in os.listdir(current) if d.startswith("code")} == {"code=01", "code=02"}
    back = sources.read_grouped(spark, path, df.schema)
    assert sorted((r.code, r.v) for r in back.collect()) == [("01", 1), ("01", 3), ("02", 2)]
    assert back.where("code = '02'").inputFiles() and back.where("code = '02'").count() == 1


def test_replace_append_count_and_find(spark):
    sources.ensure_schema(spark, "s_tables")
    sources.ensure_schema(spark, "s_tables")
    assert sources.write_counted(spark.range(7).toDF("n"), "s_tables.t") == 7
    assert sources.replace_table(spark.range(2).toDF("m"), "s_tables.t").columns == ["m"]
    sources.append_table(spark.range(2).toDF("m"), "s_tables.t")
    assert sources.append_table(spark.range(1).toDF("m"), "s_tables.t").count() == 5
    sources.replace_table(spark.table("s_tables.t").selectExpr("m + 1 as m"), "s_tables.t")
    assert sorted(r.m for r in spark.table("s_tables.t").collect()) == [1, 1, 1, 2, 2]
    grouped = sources.replace_table(
        spark.createDataFrame([("01", 1)], "g string, v int"), "s_tables.grouped", group="g"
    )
    assert grouped.first().g == "01"
    with pytest.raises(LookupError):
        sources.latest_schema(spark, "nothing_like_this_")
    for name in ("found_1", "found_3", "found_2"):
        sources.ensure_schema(spark, name)
    assert sources.latest_schema(spark, "found_") == "found_3"
    assert sources.preview(spark.range(10)).count() == 5


def test_tables_bucketed_alike_join_without_a_shuffle(spark, plan_of):
    sources.ensure_schema(spark, "s_buckets")
    df = spark.range(100).selectExpr("lpad(cast(id as string), 3, '0') as geo_id", "cast(id as double) as v")
    a = sources.replace_table(df, "s_buckets.a", buckets=(4, "geo_id"))
    b = sources.replace_table(df.withColumnRenamed("v", "w"), "s_buckets.b", buckets=(4, "geo_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = cast_key_join(a, b, left_key="geo_id", right_key="geo_id", keep=["w"])
        assert "Exchange" not in plan_of(joined)
        assert joined.where("v = w").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_parameters_are_not_pasted(spark):
    spark.range(3).selectExpr("id", "'a''b' as s").createOrReplaceTempView("params")
    found = sources.query(spark, "select id from identifier(:t) where s = :s and id < :n", t="params", s="a'b", n=2)
    assert found.count() == 2


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert checkpointed(spark.range(4)).count() == 4


def test_measured_bytes_sees_text_and_nesting(spark):
    small = spark.createDataFrame([(1, "a", [1])], "n int, s string, a array<int>")
    large = spark.createDataFrame([(1, "a" * 5000, [1] * 3000)], "n int, s string, a array<int>")
    assert measured_bytes(small) < 100 and measured_bytes(large) > 10000
    assert measured_bytes(small.limit(0)) == 0
    assert fits_in_tasks(small) and not fits_in_tasks(large, 1000)


def test_appended_scenarios_use_each_file_once(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        rows = spark.readStream.schema("id bigint, v double").parquet(inbox)
        query = append_scenarios(rows, "v", out, str(tmp_path / "state"), step="j")
        query.awaitTermination()
        return spark.read.schema("id bigint, j int, v double").parquet(out)

    spark.range(3).selectExpr("id", "10.0D as v").write.parquet(inbox)
    assert run().count() == 18
    assert run().count() == 18
    spark.range(3, 5).selectExpr("id", "10.0D as v").write.mode("append").parquet(inbox)
    result = run()
    assert result.count() == 30
    assert sorted(r.v for r in result.where("id = 4").collect()) == [10.0 * 1.5 ** j for j in range(6)]


def test_latest_schema_orders_runs_by_number(spark):
    from tractwise.sources.tables import ensure_schema, latest_schema

    for run in (9, 10):
        ensure_schema(spark, f"numbered_run_{run}")
    assert latest_schema(spark, "numbered_run_") == "numbered_run_10"
