"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tractwise.sources.versions import current_table, publish_table


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def query(spark: SparkSession, text: str, **values: object) -> DataFrame:
    """SQL with named parameters, ``:name`` for values and ``IDENTIFIER(:name)``
    for tables; nothing is pasted into the text."""
    return spark.sql(text, args=values)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a namespace unless it exists. Other errors are not swallowed."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{where}")


def latest_schema(spark: SparkSession, prefix: str) -> str:
    """The namespace whose name starts with ``prefix`` and whose rest is the last: the
    largest number if all are numbers (run 10 is after run 9), else the last in order."""
    names = [d.name for d in spark.catalog.listDatabases(f"{prefix}*")]
    if not names:
        raise LookupError(f"no schema starts with {prefix!r}")
    rests = {name: name[len(prefix):] for name in names}
    if all(r.isdigit() for r in rests.values()):
        return max(names, key=lambda name: int(rests[name]))
    return max(names)


def replace_table(
    df: DataFrame, name: str, *, group: str | None = None, buckets: tuple[int, str] | None = None
) -> DataFrame:
    """Write ``df`` as table ``name``, replacing it in one step, and return the stored table.
    Readers see the old table or the new one, whole; see ``publish_table``.

    With ``group`` there is one folder per group value, written in one job (see
    ``write_grouped``). With ``buckets`` (number, key) rows are stored by hash of the
    key: tables bucketed alike join on it without a shuffle. ``df`` may read ``name``.
    """
    def write(rows: DataFrame, version: str) -> None:
        if group is not None:
            writer = rows.hint("rebalance", group).write.partitionBy(group)
        elif buckets is not None:
            count, key = buckets
            writer = rows.repartition(count, key).write.bucketBy(count, key).sortBy(key)
        else:
            writer = rows.write
        writer.saveAsTable(version)

    return publish_table(df, name, write)


def replace_view(spark: SparkSession, name: str, text: str) -> DataFrame:
    """A stored query under a table name, for results that only drop columns."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    return spark.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """Add the rows of ``df`` to table ``name``, creating it if needed. A second
    run adds them again; ``BatchTable`` takes each batch once."""
    df.write.mode("append").saveAsTable(current_table(df.sparkSession, name))
    return df.sparkSession.table(name)


def write_counted(df: DataFrame, name: str) -> int:
    """``replace_table`` that reports the rows written, counted during the write."""
    seen = Observation("rows_written")
    replace_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return seen.get["rows"]


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
