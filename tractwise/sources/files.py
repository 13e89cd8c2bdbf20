"""CSV files and files laid out by group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tractwise.sources.versions import current_path, publish_folder

#: Codes have leading zeros, so they are declared and never inferred.
STATE_CODES = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("fips", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with one header row and a declared schema; a row that does not fit
    the schema fails the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_state_codes(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STATE_CODES)


def read_csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One column of a CSV as text, by its name in the header."""
    return spark.read.option("header", True).csv(path).select(column)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header each, one per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_grouped(df: DataFrame, path: str, group: str) -> None:
    """One folder per group value, all groups in one job.

    The rebalance hint gathers a group's rows into few files, and lets AQE split
    a group that outgrows a partition over several tasks. What ``read_grouped`` read
    before stays whole until all groups are written.
    """
    publish_folder(df.sparkSession, path, lambda version: (
        df.hint("rebalance", group).write.partitionBy(group).parquet(version)))


def read_grouped(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read what ``write_grouped`` wrote. ``schema`` is needed because types of
    folder values are otherwise guessed (``01`` would become a number)."""
    return spark.read.schema(schema).parquet(current_path(spark, path))
