"""Scenario rows appended as their inputs arrive.

The scenario table is built by appending, and a second batch run would append
every row again. As a stream with a checkpoint each input file is used once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tractwise.operators.columns import scenario_grid


def append_scenarios(
    rows: DataFrame, column: str, path: str, checkpoint: str, **grid: object
) -> StreamingQuery:
    """Append the scenarios of all new rows of the stream ``rows`` to ``path``, then stop."""
    return (
        scenario_grid(rows, column, **grid)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
