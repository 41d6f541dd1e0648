"""Six summary tables over facts and dimensions.

Each fact is first summed by its own foreign key; only those sums meet the
dimension.  The join input is then at most one row per member, so neither a
hot member nor a large fact reaches the join.

A mart takes a fact, or the fact's sums and counts by day and foreign keys
(``day_parts``), which add up to the same.  So stored parts of which only the days
with new rows are computed again serve all marts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.plans.star import STAMP_DAY, stamp_day
from tallyroom.schemas import STAMP
from tallyroom.sources import union_aligned


# Of each fact, the foreign keys that marts group by and the measures they add up.
PARTS = {
    "community": (("PlatformID", "CommunityID_Surrogate"), ("CommunityEngagement", "TotalTimeSpent")),
    "live": (("PlatformID", "EventID_Surrogate", "DeviceTypeID"), ("LiveEngagement", "ViewerCount")),
    "video": (
        ("PlatformID", "WatchReasonID", "TimeID", "UserID_Surrogate"),
        ("Engagement", "ProductivityLoss", "Satisfaction", "TotalTimeSpent", "NumberOfSessions"),
    ),
}


def day_parts(fact: DataFrame, entity: str) -> DataFrame:
    """Sums, non-NULL counts and rows of a fact by the day of its stamp and its foreign keys."""
    keys, measures = PARTS[entity]
    return (
        fact.withColumn(STAMP_DAY, stamp_day(F.col(STAMP)))
        .groupBy(STAMP_DAY, *keys)
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            *[F.count(m).alias(f"_n_{m}") for m in measures],
            F.count(F.lit(1)).alias("_rows"),
        )
    )


def _row_count(fact: DataFrame) -> Column:
    return F.sum("_rows") if "_rows" in fact.columns else F.count(F.lit(1))


def _value_count(fact: DataFrame, measure: str) -> Column:
    return F.sum(f"_n_{measure}") if f"_n_{measure}" in fact.columns else F.count(measure)


def _sums(fact: DataFrame, by: list[str], *measures: str) -> DataFrame:
    sums = [F.sum(m).alias(m) for m in measures]
    return fact.groupBy(*by).agg(*sums, _row_count(fact).alias("_rows"))


def _attributes(df: DataFrame, dim: DataFrame, key: str, surrogate: str, *columns: str) -> DataFrame:
    """Sums with their member's attributes; a member that is stored twice does not double them."""
    kept = F.max(F.struct(*columns)).alias("_kept")
    named = dim.select(F.col(surrogate).alias(key), *columns).groupBy(key).agg(kept)
    return df.join(named, key).select("*", "_kept.*").drop("_kept")


def _mean(measure: str) -> Column:
    return (F.sum(measure) / F.sum(f"_n_{measure}")).alias(measure)


def _parts(fact: DataFrame, by: str, total: str, *means: str) -> DataFrame:
    """Partial sums of ``total`` and, for each mean, its sum and non-NULL count."""
    return fact.groupBy(by).agg(
        F.sum(total).alias(total),
        *[F.sum(m).alias(m) for m in means],
        *[_value_count(fact, m).alias(f"_n_{m}") for m in means],
    )


def engagement_overview(
    community: DataFrame, live: DataFrame, video: DataFrame, dim_platform: DataFrame
) -> DataFrame:
    """Engagement of the three facts per platform; zero where a fact lacks it."""
    measures = ["Engagement", "CommunityEngagement", "LiveEngagement"]
    parts = [
        _sums(fact, ["PlatformID"], m).drop("_rows")
        for fact, m in zip((video, community, live), measures)
    ]
    named = _attributes(union_aligned(parts), dim_platform, "PlatformID", "PlatformID", "Platform")
    return named.groupBy("Platform").agg(
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures]
    )


def community_trends(community: DataFrame, dim_community: DataFrame) -> DataFrame:
    key = "CommunityID_Surrogate"
    measures = ["CommunityEngagement", "TotalTimeSpent"]
    sums = _sums(community, [key], *measures)
    named = _attributes(sums, dim_community, key, "Community_S_ID", "CommunityName")
    return named.groupBy("CommunityName").agg(*[F.sum(m).alias(m) for m in measures])


def live_streaming(live: DataFrame, dim_event: DataFrame, dim_device: DataFrame) -> DataFrame:
    """Live measures per device; an event's duration counts once per interaction."""
    key = "EventID_Surrogate"
    sums = _sums(live, [key, "DeviceTypeID"], "LiveEngagement", "ViewerCount")
    timed = _attributes(sums, dim_event, key, "Event_S_ID", "StreamDuration")
    per_device = timed.groupBy("DeviceTypeID").agg(
        F.sum("LiveEngagement").alias("LiveEngagement"),
        F.sum(F.col("StreamDuration") * F.col("_rows")).alias("StreamDuration"),
        F.sum("ViewerCount").alias("ViewerCount"),
    )
    named = _attributes(per_device, dim_device, "DeviceTypeID", "DeviceTypeID", "DeviceType")
    return named.select("DeviceType", "LiveEngagement", "StreamDuration", "ViewerCount")


def video_interactions(video: DataFrame, dim_reason: DataFrame) -> DataFrame:
    parts = _parts(video, "WatchReasonID", "Engagement", "ProductivityLoss", "Satisfaction")
    named = _attributes(parts, dim_reason, "WatchReasonID", "WatchReasonID", "WatchReason")
    return named.groupBy("WatchReason").agg(
        F.sum("Engagement").alias("Engagement"), _mean("ProductivityLoss"), _mean("Satisfaction")
    )


def time_trends(video: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Video measures per hour of day; unreadable times form the NULL hour."""
    measures = ["Engagement", "TotalTimeSpent", "NumberOfSessions"]
    sums = _sums(video, ["TimeID"], *measures)
    named = _attributes(sums, dim_time, "TimeID", "TimeID", "Hour")
    return named.groupBy("Hour").agg(*[F.sum(m).alias(m) for m in measures])


def demographics(video: DataFrame, dim_user: DataFrame) -> DataFrame:
    parts = _parts(video, "UserID_Surrogate", "Engagement", "ProductivityLoss")
    named = _attributes(parts, dim_user, "UserID_Surrogate", "User_S_ID", "AgeGroup", "Gender")
    return named.groupBy("AgeGroup", "Gender").agg(
        F.sum("Engagement").alias("Engagement"), _mean("ProductivityLoss")
    )
