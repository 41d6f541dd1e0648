"""Derived columns: buckets, hours, days and md5 identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroom import rules


def age_group(age: Column) -> Column:
    case = F
    for low, high, label in rules.AGE_BANDS:
        case = case.when(age.between(low, high), F.lit(label))
    return case.otherwise(F.lit(rules.AGE_BAND_OTHER))


def time_spent_category(seconds: Column) -> Column:
    """Short / Medium / Long; a missing value counts as Long."""
    return (
        F.when(seconds < rules.SHORT_BELOW, F.lit("Short"))
        .when(seconds <= rules.MEDIUM_UPTO, F.lit("Medium"))
        .otherwise(F.lit("Long"))
    )


def hour_of(clock: Column) -> Column:
    """Hour of an ``HH:mm:ss`` text as a long, NULL where it is not a time."""
    return F.hour(F.try_to_timestamp(clock, F.lit("HH:mm:ss"))).cast("bigint")


def surrogate(natural_key: Column) -> Column:
    """Surrogate key of a dimension member: md5 of its natural key as text."""
    return F.md5(natural_key.cast("string"))


def interaction_id(*parts: Column) -> Column:
    """md5 over the ``_``-joined parts; NULL parts are skipped."""
    return F.md5(F.concat_ws("_", *[p.cast("string") for p in parts]))


def activity_date(stamp: Column) -> Column:
    return F.date_trunc("day", stamp).cast("date")
