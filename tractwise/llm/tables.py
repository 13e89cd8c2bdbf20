"""Tables written to the shared folder between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tractwise.session import scratch_path


class Stored:
    """Writes results that are read more than once, so no step is computed twice and
    none depends on an executor's memory. ``drop`` removes those no longer needed."""

    def __init__(self, spark):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "table")
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
