"""Dimension lookups and the anti-joins that make loads repeatable.

No side is broadcast by hint: Spark broadcasts a side whose known size is below
its threshold and sort-merges beyond it, where the adaptive skew rule splits a
hot key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.sources.index import digest_of
from tallyroom.sources.marks import MAX_MARKS, PLACE, marked, marks_of, with_places


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    surrogate: str,
    out: str | None = None,
) -> DataFrame:
    """Natural key to surrogate key by inner join.

    Fact rows without a member, NULL keys included, are dropped.  Keys compare
    as text (``UserID`` is a number in facts and text in its dimension).  A
    dimension that holds several rows for one member does not multiply facts.
    """
    members = dim.select(
        F.col(dim_key).cast("string").alias("_member"),
        F.col(surrogate).alias(out or surrogate),
    ).distinct()
    return fact.join(members, F.col(fact_key).cast("string") == F.col("_member")).drop("_member")


def missing_members(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Members of ``new`` that the stored dimension does not have yet."""
    return new.join(existing.select(key), key, "left_anti")


def anti_ingest(new: DataFrame, existing: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose business key has not been ingested before.

    A row with a NULL key part matches nothing and is kept, for the cleaning
    step to reject with a reason.  Stored keys are made distinct on a grouping
    of their own (keys plus their hash), so both join sides still arrive
    through a plain exchange and a key that is hot among the new rows can be
    split by the adaptive skew rule.
    """
    keys = list(keys)
    known = existing.select(*keys, F.xxhash64(*keys).alias("_hash")).distinct().drop("_hash")
    return new.join(known, keys, "left_anti")


def anti_ingest_stored(new: DataFrame, existing: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``anti_ingest`` where ``new`` is a scan of stored files, whose rows stay where they are.

    Only keys and places (file and number of the row) meet the stored keys.  What is left
    of them is written once as marks, a bit for every row of a file, and the rows of
    ``new`` are then picked by their own bit.  With more than ``MAX_MARKS`` entries of
    marks the whole rows meet the stored keys.
    """
    keys = list(keys)
    placed = with_places(new)
    marks = marks_of(anti_ingest(placed.select(*keys, *PLACE), existing, keys).select(*PLACE), MAX_MARKS)
    if marks is None:
        return anti_ingest(new, existing, keys)
    return marked(placed, marks).select(*keys, *[c for c in new.columns if c not in keys])


def anti_content(new: DataFrame, existing: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows whose content was not ingested before: an exact repeat goes, a change stays.

    Rows meet by a hash of ``columns`` and are equal if a SHA-256 over all of them is,
    NULLs included: no stored content crosses a shuffle, and of a new row only the
    columns that are asked for later.  Stored contents are made distinct, so a content
    that is hot among the new rows meets one row, and its side can be split by the skew rule.
    """
    columns = list(columns)
    hashes = {"_hash": F.xxhash64(*columns)}
    known = existing.withColumns(hashes | {"_digest": _digest(existing, columns)}).select("_hash", "_digest")
    known = known.distinct()
    hashed = new.withColumns(hashes | {"_digest": _digest(new, columns)})
    # As one key, the join's sides differ from the grouping above and stay plain exchanges.
    same = F.struct(hashed["_hash"], hashed["_digest"]) == F.struct(known["_hash"], known["_digest"])
    return hashed.join(known, same, "left_anti").drop("_hash", "_digest")


def _digest(df: DataFrame, columns: list[str]) -> Column:
    """Digest of a row's content; the two zeros of floating point are one value."""
    floats = {c for c, kind in df.select(*columns).dtypes if kind in ("float", "double")}
    return digest_of(F.col(c) + F.lit(0) if c in floats else F.col(c) for c in columns)


def anti_append(fact: DataFrame, existing: DataFrame, key: str = "InteractionID") -> DataFrame:
    """Fact rows that are not stored yet, so that loading twice adds nothing."""
    return fact.join(existing.select(key), key, "left_anti")


def within_range(
    stored: DataFrame, column: str, batch: DataFrame, batch_column: str | None = None
) -> DataFrame:
    """Stored rows whose ``column`` lies in the range a batch covers, or is NULL.

    A row id that contains the stamp can only repeat under the same stamp, so
    an incremental load needs to compare with this range alone.  The ends are a
    scalar subquery, which the scan of ``stored`` can use to skip files.
    """
    value = F.col(batch_column or column)
    ends = batch.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("r"))
    low, high = (ends.scalar().getField(end) for end in ("low", "high"))
    return stored.filter(F.col(column).isNull() | F.col(column).between(low, high))
