"""What the operators share: folds, bounded samples, batch maps and stored steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroom.sources.writers import Workspace

__all__ = [
    "Workspace", "ascii_lower", "fold", "map_batches", "map_parts", "one_each", "parts_of", "sampled", "scores_frame", "shard", "table", "values",
]

#: Resolution of hash-threshold samples.
_SLICES = 1 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a NULL key falls in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds, F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sampled(rows: DataFrame, key: str, bound: int, total: int | None = None) -> DataFrame:
    """Rows of about ``bound`` keys at most, picked by a hash of the key alone.

    The same rows are picked whatever the partitioning.  Rows without a key
    are never picked.  Where keys repeat, ``one_each`` bounds the rows as well.
    """
    total = rows.count() if total is None else total
    rows = rows.where(F.col(key).isNotNull())
    if total <= bound:
        return rows
    limit = int(_SLICES * bound / total)
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(_SLICES)) < limit)


def one_each(rows: DataFrame, key: str) -> DataFrame:
    """One row of each key, the first by all its columns; each task sends one at most."""
    order = [F.col(c).asc_nulls_first() for c in rows.columns if c != key]
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def shard(key: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(shards)).cast("int")


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


#: Bytes of a batch that a task turns into Python objects at a time, about.
PART_BYTES = 4 << 20


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in smaller ones."""
    for batch in batches:
        step = max(1, batch.num_rows * PART_BYTES // max(PART_BYTES, batch.nbytes))
        for begin in range(0, batch.num_rows, step):
            yield batch.slice(begin, step)


def map_parts(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``run`` over the rows of each task in small batches; memory goes back when it ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(parts_of(batches))
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(task, schema)


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema
) -> DataFrame:
    """One output batch per small input batch, inside the tasks."""
    return map_parts(df, lambda batches: map(work, batches), schema)


def scores_frame(ids: Iterable, name: str, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", name]
    )
