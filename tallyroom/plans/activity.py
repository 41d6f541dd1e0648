"""Daily user activity across the three facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import activity_date, interaction_id
from tallyroom.schemas import NO_STAMP, STAMP
from tallyroom.sources import union_aligned

UNKNOWN = "UNKNOWN"
GROUP = ("UserID_Surrogate", "PlatformID", "TimeID", "ActivityDate")
GROUPED = "_group"


def _unified(
    fact: DataFrame, engagement: str, time_spent: Column, sessions: Column, time_id: Column
) -> DataFrame:
    return fact.select(
        F.coalesce("UserID_Surrogate", F.lit(UNKNOWN)).alias("UserID_Surrogate"),
        F.coalesce("PlatformID", F.lit(UNKNOWN)).alias("PlatformID"),
        time_id.cast("string").alias("TimeID"),
        F.coalesce(F.col(engagement), F.lit(0)).cast("float").alias("Engagement"),
        time_spent.cast("float").alias("TotalTimeSpent"),
        sessions.cast("bigint").alias("NumberOfSessions"),
        F.coalesce(F.col(STAMP), F.lit(NO_STAMP).cast("timestamp")).alias(STAMP),
    )


def unify_activity(community: DataFrame, live: DataFrame, video: DataFrame) -> DataFrame:
    """The three facts under one schema; measures a fact lacks are zero."""
    none, zero = F.lit(None), F.lit(0)
    spent = F.coalesce(F.col("TotalTimeSpent"), zero)
    sessions = F.coalesce(F.col("NumberOfSessions"), zero)
    return union_aligned([
        _unified(community, "CommunityEngagement", spent, zero, none),
        _unified(live, "LiveEngagement", zero, zero, F.col("TimeID")),
        _unified(video, "Engagement", spent, sessions, F.col("TimeID")),
    ])


def activity_sums(unified: DataFrame) -> DataFrame:
    """Sums per user, platform, time slot and day, which are one column (``GROUPED``).

    A missing time slot is a group of its own.  Rows are summed before the
    shuffle, so a hot user costs one row per map task.  As one column the group
    can be joined on, missing time slots included, without another shuffle.
    """
    return (
        unified.withColumn("ActivityDate", activity_date(F.col(STAMP)))
        .groupBy(F.struct(*GROUP).alias(GROUPED))
        .agg(
            F.sum("Engagement").cast("float").alias("TotalEngagement"),
            F.sum("TotalTimeSpent").cast("float").alias("TotalTimeSpent"),
            F.sum("NumberOfSessions").alias("SessionCount"),
            F.count(F.lit(1)).alias("InteractionCount"),
        )
    )


def with_row_ids(sums: DataFrame) -> DataFrame:
    """``activity_sums`` as stored: the group's columns, and a row id built from them,
    so a repeated load finds its own rows."""
    grouped = sums.select(f"{GROUPED}.*", *[c for c in sums.columns if c != GROUPED])
    parts = [F.col(c) for c in GROUP]
    parts[2] = F.coalesce(parts[2], F.lit(""))
    return grouped.select(interaction_id(*parts).alias("InteractionID"), *grouped.columns)


def user_activity(unified: DataFrame) -> DataFrame:
    """Activity per user, platform, time slot and day."""
    return with_row_ids(activity_sums(unified))


def replace_days(
    stored: DataFrame, fresh: DataFrame, day: str = "ActivityDate", days: DataFrame | None = None
) -> DataFrame:
    """Stored rows in which the days of ``fresh`` are replaced.

    ``days`` has these days, distinct, where they are known without computing
    ``fresh``.  They are as many as the calendar has, so they are sent to all tasks
    and no stored row is shuffled for them.
    """
    days = fresh.select(day).distinct() if days is None else days
    kept = stored.join(F.broadcast(days), day, "left_anti").select(*fresh.columns)
    return kept.unionByName(fresh)
