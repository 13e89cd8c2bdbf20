"""Replacing and appending so that readers, and jobs that are killed, never see half of it."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: The file of a versioned folder that names its current version.
POINTER = "_current"
#: The property of a view that names the table of its current version.
VERSION = "tractwise.version"


def new_version() -> str:
    """A name that sorts after those given before."""
    return f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


class _Files:
    """The few file operations that a commit needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def system(self, text: str):
        return self.path(text).getFileSystem(self.conf)

    def exists(self, text: str) -> bool:
        return self.system(text).exists(self.path(text))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self.system(folder).listStatus(self.path(folder)))

    def read(self, text: str) -> str:
        stream = self.system(text).open(self.path(text))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str, content: str) -> None:
        stream = self.system(text).create(self.path(text), False)
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()

    def replace(self, text: str, content: str) -> None:
        """A file is there with its old or its new content at any time: written aside, then renamed over it."""
        aside = f"{text}.{uuid.uuid4().hex}"
        self.write(aside, content)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(text).toUri(), self.conf) if (
            self.path(text).toUri().getScheme()) else self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.conf)
        context.rename(self.path(aside), self.path(text), options)

    def claim(self, text: str, content: str) -> bool:
        """Creates a file with its whole content unless there is one; whether this call did."""
        if self.exists(text):
            return False
        aside = f"{text}.{uuid.uuid4().hex}"
        self.write(aside, content)
        system = self.system(text)
        if self.exists(text) or not system.rename(self.path(aside), self.path(text)):
            system.delete(self.path(aside), False)
            return False
        return True

    def remove(self, text: str) -> None:
        self.system(text).delete(self.path(text), True)


def current_path(spark: SparkSession, root: str) -> str:
    """The folder of the current version of ``root``; ``root`` itself where it has none."""
    files, root = _Files(spark), root.rstrip("/")
    pointer = f"{root}/{POINTER}"
    return f"{root}/{files.read(pointer).strip()}" if files.exists(pointer) else root


def publish_folder(spark: SparkSession, root: str, write: Callable[[str], None], *, keep: int = 1) -> str:
    """Lets ``write`` fill a new version of the folder ``root``, then makes it the current one.

    Until the one small pointer file is replaced, readers and later jobs see the version
    before, whole, however the job ends. ``keep`` versions before the current one stay for
    readers that are still at them; older ones, and what killed jobs left, are removed.
    """
    files, root, version = _Files(spark), root.rstrip("/"), new_version()
    path = f"{root}/{version}"
    write(path)
    files.replace(f"{root}/{POINTER}", version)
    versions = [n for n in files.names(root) if n[:1].isdigit() and n < version]
    for name in versions[: len(versions) - keep]:
        files.remove(f"{root}/{name}")
    return path


def current_table(spark: SparkSession, name: str) -> str:
    """The table that holds the current version of ``name``; ``name`` itself where it is no published view."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return name
    return next((r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r.key == VERSION), name)


def publish_table(
    df: DataFrame, name: str, write: Callable[[DataFrame, str], None] | None = None, *, keep: int = 1
) -> DataFrame:
    """Stores ``df`` as a new version of table ``name`` and swaps to it in one step of the catalog.

    ``name`` is a view of its current version, a table beside it; replacing the view's text is
    the swap. ``df`` may read ``name`` itself. ``keep`` versions before it stay, as queries
    already planned read them. A table of that name, stored by other means, is replaced by
    the view once its successor is written.
    """
    spark = df.sparkSession
    schema, _, short = name.rpartition(".")
    prefix = f"{schema}." if schema else ""
    version = f"{short}__{new_version()}"
    if write is None:
        df.write.saveAsTable(prefix + version)
    else:
        write(df, prefix + version)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{prefix}{version}') "
              f"AS SELECT * FROM {prefix}{version}")
    older = sorted(t.name for t in spark.catalog.listTables(schema or None, f"{short}__*")
                   if t.name.startswith(f"{short}__") and t.name[len(short) + 2:][:20].isdigit() and t.name < version)
    for gone in older[: len(older) - keep]:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{gone}")
    return spark.table(name)


class BatchTable:
    """Rows appended in batches with an id each: a batch that is repeated adds nothing.

    A batch is written to a folder of its own and counts once the ledger has an entry for
    its id, a small file that names the folder. An attempt that is lost before that leaves
    a folder no reader looks at, and the next attempt writes anew; one that is lost after
    it finds the entry. Of two attempts at a time the first entry wins.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), _Files(spark)

    def batches(self) -> list[str]:
        """Ids of the batches that count."""
        return [n.removeprefix("batch-") for n in self.files.names(f"{self.root}/ledger") if n.startswith("batch-") and "." not in n]

    def append(self, df: DataFrame, batch: str) -> bool:
        """Adds the rows of ``df`` as ``batch``; whether they were added now."""
        if not batch or not all(c.isalnum() or c in "-_" for c in batch):
            raise ValueError(f"a batch id is made of letters, digits, - and _: {batch!r}")
        entry = f"{self.root}/ledger/batch-{batch}"
        if self.files.exists(entry):
            return False
        folder = f"{batch}-{new_version()}"
        df.write.parquet(f"{self.root}/data/{folder}")
        if self.files.claim(entry, folder):
            return True
        self.files.remove(f"{self.root}/data/{folder}")
        return False

    def read(self, schema: StructType | str) -> DataFrame:
        """The rows of all batches that count."""
        folders = [f"{self.root}/data/{self.files.read(f'{self.root}/ledger/batch-{b}').strip()}" for b in self.batches()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)
