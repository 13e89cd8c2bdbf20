"""Replacing in one step and appending once, also when jobs are killed in between."""

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tractwise.operators import fit_linear, load_model, predict, save_model
from tractwise.sources import (
    BatchTable, current_path, publish_folder, publish_table, read_grouped, replace_table, write_grouped,
)


@pytest.fixture(scope="module", autouse=True)
def schema(spark):
    spark.sql("create schema if not exists versions")


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id"), (F.col("id") % 3).alias("g"))


class Killed(Exception):
    pass


def killed(df, name):
    df.write.saveAsTable(name)
    raise Killed


def test_a_job_killed_before_the_swap_leaves_the_old_table(spark):
    publish_table(numbers(spark, 10), "versions.t")
    with pytest.raises(Killed):
        publish_table(numbers(spark, 99), "versions.t", killed)
    assert spark.table("versions.t").count() == 10
    publish_table(numbers(spark, 20), "versions.t")
    publish_table(numbers(spark, 30), "versions.t")
    assert spark.table("versions.t").count() == 30
    left = [t.name for t in spark.catalog.listTables("versions", "t__*")]
    assert len(left) == 2  # the current version and the one before; what the killed job left is gone


def test_a_reader_in_the_middle_reads_the_old_version(spark):
    old = publish_table(numbers(spark, 100).repartition(4), "versions.reader")
    rows = old.toLocalIterator()
    first = next(rows)
    replace_table(numbers(spark, 5), "versions.reader")
    assert len([first, *rows]) == 100 and old.count() == 100
    assert spark.table("versions.reader").count() == 5


def test_a_table_can_be_replaced_from_itself(spark):
    replace_table(numbers(spark, 10), "versions.own", group="g")
    grown = spark.table("versions.own")
    replace_table(grown.unionByName(grown), "versions.own", buckets=(2, "id"))
    assert spark.table("versions.own").count() == 20


def test_a_table_stored_by_other_means_is_taken_over(spark):
    numbers(spark, 3).write.saveAsTable("versions.plain")
    replace_table(numbers(spark, 4), "versions.plain")
    assert spark.table("versions.plain").count() == 4


def test_folders_and_models(spark, tmp_path):
    root = str(tmp_path / "grouped")
    write_grouped(numbers(spark, 9), root, "g")
    with pytest.raises(Killed):
        publish_folder(spark, root, lambda path: killed_folder(numbers(spark, 50), path))
    kinds = "id bigint, g bigint"
    assert read_grouped(spark, root, kinds).count() == 9
    write_grouped(numbers(spark, 12), root, "g")
    write_grouped(numbers(spark, 15), f"file:{root}", "g")
    assert read_grouped(spark, root, kinds).count() == 15
    assert len([p for p in (tmp_path / "grouped").iterdir() if p.name[0].isdigit()]) == 2
    assert current_path(spark, str(tmp_path / "none")) == str(tmp_path / "none")
    df = numbers(spark, 20).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"))
    model = fit_linear(df, label="y", numeric=["x"])
    save_model(model, str(tmp_path), "m")
    assert predict(df, load_model(str(tmp_path), "m")).where("abs(predicted_label - y) > 1e-6").count() == 0


def killed_folder(df, path):
    df.write.parquet(path)
    raise Killed


def test_a_batch_counts_once(spark, tmp_path):
    table, kinds = BatchTable(spark, str(tmp_path / "log")), "id bigint, g bigint"
    assert table.read(kinds).count() == 0 and table.batches() == []
    assert table.append(numbers(spark, 10), "2024-01") and not table.append(numbers(spark, 10), "2024-01")
    assert table.append(numbers(spark, 5, 10), "2024-02")
    assert table.read(kinds).count() == 15 and table.batches() == ["2024-01", "2024-02"]
    # an attempt that was lost before its entry was written
    numbers(spark, 7, 100).write.parquet(f"{table.root}/data/2024-03-lost")
    assert table.read(kinds).count() == 15
    assert table.append(numbers(spark, 7, 100), "2024-03") and table.read(kinds).count() == 22
    # two attempts at a time: the other one's entry is there when this one has written its rows
    lazy = numbers(spark, 3, 500)
    other = table.files.claim
    table.files.claim = lambda entry, folder: table.files.write(entry, "x") or other(entry, folder)
    assert not table.append(lazy, "2024-04")
    with pytest.raises(ValueError, match="batch id"):
        table.append(lazy, "a/b")
