"""Deterministic deduplication and duplicate census.

Ties are broken by all remaining columns, so the surviving row does not depend
on partitioning.  A single key may own a large share of the rows; no operator
here brings a whole key to one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.schemas import STAMP


def newest_first(df: DataFrame, keys: Iterable[str], stamp: str = STAMP) -> list[Column]:
    """Total order inside a key: newest stamp, then every other column."""
    fixed = {*keys, stamp}
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in fixed]
    return [F.col(stamp).desc_nulls_last(), *rest]


def latest_by_key(df: DataFrame, keys: Iterable[str], stamp: str = STAMP) -> DataFrame:
    """The newest row of every key.

    Ranking with a bound of one lets Spark rank inside each map task first, so
    a key crosses the shuffle with at most one row per task, however hot it is.
    """
    keys = list(keys)
    ranked = Window.partitionBy(*keys).orderBy(*newest_first(df, keys, stamp))
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


#: Keys that ``latest_by_key_apart`` takes apart; their hashes are small enough to be broadcast.
MAX_REPEATED = 1 << 20


def repeated_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Hashes of the keys that occur more than once, as column ``_hash``.

    Two keys may share a hash, so some of them may occur once; none is missing.
    """
    counted = df.select(F.xxhash64(*keys).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter(F.col("_rows") > 1).select("_hash")


def latest_by_key_apart(df: DataFrame, keys: Iterable[str], repeated: DataFrame) -> DataFrame:
    """The same rows as ``latest_by_key``, of which only those of ``repeated`` keys are ranked.

    A row whose key has no other row is the newest one as it is: it needs neither a
    sort nor a shuffle.  ``repeated`` comes from ``repeated_keys`` of the same rows.
    """
    keys = list(keys)
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    alone = hashed.join(repeated, "_hash", "left_anti").select(*df.columns)
    several = hashed.join(repeated, "_hash", "left_semi").select(*df.columns)
    return alone.unionByName(latest_by_key(several, keys))


def superseded(df: DataFrame, keys: Iterable[str], stamp: str = STAMP) -> DataFrame:
    """Every row that ``latest_by_key`` leaves out, copies included, with the reason.

    The losers of a hot key are many, so the key is ranked in two steps.  Rows
    are first ranked against rows of the same key and input partition, a group
    bounded by the partition.  Only each group's best row then meets the best
    rows of the other partitions; the rest have already lost and stay spread.
    """
    keys = list(keys)
    order = newest_first(df, keys, stamp)
    nearby = Window.partitionBy(*keys, "_slice").orderBy(*order)
    finals = Window.partitionBy(*keys, "_round").orderBy(*order)
    return (
        df.withColumn("_slice", F.spark_partition_id())
        .withColumn("_near", F.row_number().over(nearby))
        .withColumn("_round", F.when(F.col("_near") > 1, F.col("_slice")).otherwise(F.lit(-1)))
        .withColumn("_final", F.row_number().over(finals))
        .filter((F.col("_near") > 1) | (F.col("_final") > 1))
        .drop("_slice", "_near", "_round", "_final")
        .withColumn("Reason", F.lit("Duplicate row (not most recent)"))
    )


def dedup_exact(df: DataFrame, keys: Iterable[str], stamp: str = STAMP) -> DataFrame:
    """One row per key combination, chosen deterministically."""
    return latest_by_key(df, keys, stamp)


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key combinations that occur more than once, with their counts."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Copies"))
    return counted.filter(F.col("Copies") > 1)


def duplicate_census(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """One row: number of duplicated keys and of rows beyond the first of each."""
    return duplicate_keys(df, keys).agg(
        F.count(F.lit(1)).alias("DuplicateKeys"),
        F.coalesce(F.sum(F.col("Copies") - 1), F.lit(0)).alias("SurplusRows"),
    )


def top_duplicates(df: DataFrame, keys: Iterable[str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent key combinations, ties in key order."""
    keys = list(keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Copies"))
    return counted.orderBy(F.col("Copies").desc(), *keys).limit(n)


def stamp_census(df: DataFrame, stamp: str = STAMP) -> DataFrame:
    """Rows of every distinct ingestion stamp."""
    return df.groupBy(stamp).agg(F.count(F.lit(1)).alias("TotalRows"))
