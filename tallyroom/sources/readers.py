"""Sources: files, catalog or connector tables, message streams."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.schemas import STAMP

INGESTION_DATE = "IngestionDate"


def read_entity(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Scan Parquet, newline-delimited JSON or CSV, with a declared schema if given.

    Reader options pass through: ``mode="PERMISSIVE"`` for JSON,
    ``header="true", nullValue="N/A"`` for the CSV export.
    """
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def stored_files(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """A stored Parquet folder, or None where nothing has been written yet."""
    try:
        return read_entity(spark, path, schema=schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_stream(
    spark: SparkSession,
    fmt: str,
    schema: T.StructType | str | None = None,
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Open a streaming source; a Kafka topic and a file folder differ by options only.

    For Kafka give ``subscribe``, ``startingOffsets="latest"``,
    ``failOnDataLoss="false"`` and a ``maxOffsetsPerTrigger`` that bounds what a
    single hot key can bring into one micro-batch.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_table(
    spark: SparkSession,
    name: str,
    columns: Iterable[str] = (),
    fmt: str | None = None,
    **options: str,
) -> DataFrame:
    """Scan a warehouse table: from the catalog, or through a connector format.

    Connector options may hold credentials and are never logged.
    """
    if fmt is None:
        table = spark.read.table(name)
    else:
        table = spark.read.format(fmt).options(**options).option("dbtable", name).load()
    wanted = list(columns)
    return table.select(*wanted) if wanted else table


def table_exists(spark: SparkSession, name: str, fmt: str | None = None, **options: str) -> bool:
    """Whether a warehouse table can be read; behind a connector its schema is asked for.

    A connector tells a missing table by an error of its own, so any error whose
    text says so counts as missing, and others are raised.
    """
    if fmt is None:
        return spark.catalog.tableExists(name)
    try:
        read_table(spark, name, (), fmt, **options).schema  # noqa: B018
    except Exception as error:
        if any(said in str(error).lower() for said in _MISSING):
            return False
        raise
    return True


# How connectors say that a table is missing.
_MISSING = ("not exist", "not found", "no such table", "unknown table", "invalid object name")


def align_to_table(df: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """The frame in the table's columns, by name and regardless of case."""
    have = {c.lower(): c for c in df.columns}
    foreign = [c for c in df.columns if c.lower() not in {t.lower() for t in table.columns}]
    if foreign:
        raise ValueError(f"{name} has no column {', '.join(foreign)}")
    return df.select(
        *[
            F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name)
            if f.name.lower() in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in table.schema
        ]
    )


def read_staged_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    since: str | None = None,
) -> DataFrame:
    """Scan what a streaming sink wrote under ``path``.

    Partition discovery stays on (a recursive lookup would turn it off and the
    partition column would read as NULL); the exact stamp is an ordinary data
    column.  ``since`` prunes whole ``IngestionDate`` partitions.
    """
    reader = spark.read.option("basePath", path).option("ignoreMissingFiles", "true")
    if schema is not None:
        full = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(T.StructType([*full.fields, T.StructField(INGESTION_DATE, T.DateType())]))
    staged = reader.parquet(path)
    if since is not None:
        staged = staged.filter(F.col(INGESTION_DATE) >= F.lit(since).cast("date"))
    return staged


def stamp(df: DataFrame, column: str = STAMP) -> DataFrame:
    """Add the ingestion time of this run or micro-batch."""
    return df.withColumn(column, F.current_timestamp())


def conform_schema(
    df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Bring a frame to canonical names and types, matching columns by name.

    A schema column the frame lacks becomes a typed NULL; extra columns go.
    """
    canonical = {(rename or {}).get(name, name): name for name in df.columns}

    def column(field: T.StructField) -> Column:
        if field.name in canonical:
            return F.col(f"`{canonical[field.name]}`").cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema])


def align_for_union(
    df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename and widen the columns a frame has, so it can be unioned by name."""
    target = {f.name: f.dataType for f in schema}
    renames = rename or {}
    picked = []
    for name in df.columns:
        new = renames.get(name, name)
        source = F.col(f"`{name}`")
        picked.append((source.cast(target[new]) if new in target else source).alias(new))
    return df.select(*picked)


def union_aligned(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one frame is NULL for its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
