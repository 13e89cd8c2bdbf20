"""Session helpers: the shared folder, and measuring a side before broadcasting it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: A side is replicated to every task only when it is measured at or below this.
REPLICATE_BYTES = 8 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tractwise-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one written table under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tractwise/{uuid.uuid4().hex}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``: 16 bytes a field plus the text it holds."""
    size = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            length = F.octet_length(F.col(f"`{field.name}`"))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            length = F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`"))))
        else:
            continue
        size = size + F.coalesce(length, F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def fits_in_tasks(df: DataFrame, max_bytes: int = REPLICATE_BYTES) -> bool:
    """Whether ``df`` was measured small enough to replicate to every task."""
    return measured_bytes(df) <= max_bytes


def replicated_if_small(df: DataFrame, max_bytes: int = REPLICATE_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it was measured small enough, else as it is.

    For sides joined on a key of few values: by shuffle, one value could bring a
    large part of the other side to one task.
    """
    return F.broadcast(df) if fits_in_tasks(df, max_bytes) else df
