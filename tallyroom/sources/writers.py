"""Batch sinks and the shared-storage table that cuts a plan in two."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyroom.sources.readers import align_to_table, read_table, table_exists
from tallyroom.sources.versions import Versions


def write_entity(
    df: DataFrame,
    path: str,
    mode: str = "append",
    files: int | None = None,
    partition_by: tuple[str, ...] = (),
    max_records_per_file: int | None = None,
) -> None:
    """Write snappy Parquet.

    The number of files follows the plan's partitions; ``files`` narrows it for
    small outputs only, since ``coalesce`` also narrows the stage before it.
    """
    if files is not None:
        df = df.coalesce(files)
    writer = df.write.mode(mode).option("compression", "snappy")
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_table(df: DataFrame, name: str, mode: str, fmt: str | None = None, **options: str) -> None:
    """Append to or overwrite a warehouse table, matching columns by name.

    Without ``fmt`` the table lives in the session catalog, where an overwrite is
    all or nothing; with it, the write goes through that connector, which may
    place columns by position, so they are brought in the table's order.  A write
    to a stored table fails if the frame has a column that the table lacks; a
    column that only the table has becomes a typed NULL.  An overwrite in the
    catalog may change the layout.
    """
    spark = df.sparkSession
    if fmt is not None:
        if table_exists(spark, name, fmt, **options):
            df = align_to_table(df, read_table(spark, name, (), fmt, **options), name)
        df.write.format(fmt).options(**options).option("dbtable", name).mode(mode).save()
    elif mode == "overwrite":
        Versions(spark, name).replace(df)
    else:
        if spark.catalog.tableExists(name):
            df = align_to_table(df, spark.read.table(name), name)
        df.write.mode(mode).format("parquet").saveAsTable(name)


def write_if_any(df: DataFrame, write: Callable[[DataFrame], None]) -> bool:
    """Write only a frame that has rows; tells whether it wrote.

    The test reads one row, but it starts the plan a second time: hand in a
    scan or a step of a workspace, not a plan with a shuffle under it.
    """
    if df.isEmpty():
        return False
    write(df)
    return True


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a session on one machine that names none (a local test) gets a
    temporary folder; elsewhere a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _LOCAL.setdefault(
            spark.sparkContext.applicationId, ""
        ) or tempfile.mkdtemp(prefix="tallyroom-")
        _LOCAL[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tallyroom/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own making, in whatever store it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that feeds several outputs once, and read it back.

    The result survives lost executors, is pruned by column, and carries its
    size, so Spark itself decides whether a join side is small enough to
    broadcast.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Tables that a job writes to the shared folder on its way to a result.

    On leaving the block all are removed but those that ``keep`` has written.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.base = fresh_path(spark, label)
        self.made = 0

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error) -> None:
        remove_path(self.spark, f"{self.base}/steps")

    def _write(self, df: DataFrame, folder: str) -> DataFrame:
        self.made += 1
        path = f"{self.base}/{folder}/{self.made}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def step(self, df: DataFrame) -> DataFrame:
        return self._write(df, "steps")

    def keep(self, df: DataFrame) -> DataFrame:
        return self._write(df, "kept")
