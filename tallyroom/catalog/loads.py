"""What the load jobs leave behind, as queries over whole tables.

Each entry runs the operators of a job on an earlier and a later part of the
given tables, or on batch and stream, and returns the stored result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom import operators as op
from tallyroom import schemas as S
from tallyroom.plans import activity, jobs, marts, star
from tallyroom.plans.layers import raw_layer, staging_layer
from tallyroom.sources import ContentIndex, Workspace, union_aligned, write_entity

Query = Callable[[SparkSession, str], DataFrame]
ENTITIES = ("community", "live", "video")
PROFILES = (*ENTITIES, "live_stream", "video_stream")

# Rows stamped before these days are stored already, unless they come late.
LOADED_BEFORE = {"community": "1998-01-01", "live": "2024-01-16", "video": "1998-01-01"}
# One measure per entity that changes for some stored rows between two loads.
CHANGED = {
    "community": ("CommunityEngagement", "UserID"),
    "live": ("LiveEngagement", "EventID"),
    "video": ("Engagement", "UserID"),
}


def _fact(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    return star.build_fact_complete(staging_layer(spark, sf_dir, profile), star.STAR_FACTS[profile])


def _streamed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging_layer(spark, sf_dir, "video_stream")
    staged = staged.withColumn("EngagementScore", F.col("Engagement"))
    return star.stream_video_layout(star.build_fact_complete(staged, star.FACT_VIDEO_STREAM))


def _ingest_changed(entity: str) -> Query:
    """A second delivery of all rows, some with a new measure: repeats go, changes stay."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_layer(spark, sf_dir, entity)
        before = F.col(S.STAMP) < F.lit(LOADED_BEFORE[entity]).cast("timestamp")
        measure, key = CHANGED[entity]
        changed = F.when(F.col(key) % 7 == 0, F.col(measure) + 1).otherwise(F.col(measure))
        columns = [c for c in raw.columns if c != S.STAMP]
        return op.anti_content(raw.withColumn(measure, changed), raw.filter(before), columns)

    return query


def _ingest_indexed(entity: str) -> Query:
    """The same second delivery against a digest index of what is stored."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_layer(spark, sf_dir, entity)
        before = F.col(S.STAMP) < F.lit(LOADED_BEFORE[entity]).cast("timestamp")
        measure, key = CHANGED[entity]
        changed = F.when(F.col(key) % 7 == 0, F.col(measure) + 1).otherwise(F.col(measure))
        schema = T.StructType([f for f in raw.schema if f.name != S.STAMP])
        with Workspace(spark, f"indexed-{entity}") as space:
            path = f"{space.base}/steps/raw"
            write_entity(raw.filter(before), path)
            index = ContentIndex(spark, path, schema)
            index.catch_up()
            return space.keep(index.unknown_stored(raw.withColumn(measure, changed)))

    return query


def _members_of_all(dim: star.Dim) -> Query:
    """A dimension filled from every staging table that has its key."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = [staging_layer(spark, sf_dir, p) for p in PROFILES]
        keys = [s.select(dim.key) for s in staged if dim.key in s.columns]
        return star.build_dim(union_aligned(keys), dim)

    return query


def dim_user_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live, community, then video loads into one user table."""
    stored = star.build_dim(staging_layer(spark, sf_dir, "live"), star.DIM_USER_LIVE)
    for entity, dim in (("community", star.DIM_USER_COMMUNITY), ("video", star.DIM_USER_VIDEO)):
        stored = star.merged_members(staging_layer(spark, sf_dir, entity), dim, stored)
    return stored


def dim_user_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A video load, then refreshing community and live loads."""
    stored = star.build_dim(staging_layer(spark, sf_dir, "video"), star.DIM_USER_VIDEO)
    for entity, dim in (("community", star.DIM_USER_COMMUNITY), ("live", star.DIM_USER_LIVE)):
        stored = star.merged_members(staging_layer(spark, sf_dir, entity), dim, stored, refresh=True)
    return stored


def dim_video_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream load, then the batch load, into one video table."""
    stored = star.build_dim(staging_layer(spark, sf_dir, "video_stream"), star.DIM_VIDEO_STREAM)
    return star.merged_members(staging_layer(spark, sf_dir, "video"), star.DIM_VIDEO, stored)


def fact_live_batch_after_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch load beside streamed rows: same ids are replaced, the others stay."""
    batch, streamed = _fact(spark, sf_dir, "live"), _fact(spark, sf_dir, "live_stream")
    return op.anti_append(streamed, batch).unionByName(batch)


def user_activity_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity stored without every fifth user's rows, brought up to date when those arrive."""
    facts = [_fact(spark, sf_dir, e) for e in ENTITIES]
    late = F.crc32(F.col("InteractionID")) % 5 == 0
    stored = activity.user_activity(activity.unify_activity(*[f.where(~late) for f in facts]))
    fresh = activity.user_activity(activity.unify_activity(*facts))
    return activity.replace_days(stored, fresh)


@contextmanager
def _warehouse(spark: SparkSession, label: str) -> Iterator[tuple[jobs.Warehouse, Workspace]]:
    """Star tables of a query's own, gone with its steps."""
    with Workspace(spark, label) as space:
        name = f"tallyroom_{uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{space.base}/steps/warehouse'")
        try:
            yield jobs.Warehouse(spark, name), space
        finally:
            spark.sql(f"DROP DATABASE {name} CASCADE")


def _upsert(warehouse: jobs.Warehouse, fact: DataFrame, entity: str) -> None:
    dated = fact.withColumn(star.STAMP_DAY, star.stamp_day(F.col(S.STAMP)))
    warehouse.upsert(dated, star.STAR_FACTS[entity].table, "InteractionID", S.STAMP)


def _fact_upsert(entity: str) -> Query:
    """Earlier facts, then a delivery of rows from the first days of all months with a new measure."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact, measure = _fact(spark, sf_dir, entity), CHANGED[entity][0]
        earlier = F.col(S.STAMP) < F.lit(LOADED_BEFORE[entity]).cast("timestamp")
        again = (F.dayofmonth(S.STAMP) <= 10) & (F.col(measure) % 2 == 0)
        with _warehouse(spark, f"upsert-{entity}") as (warehouse, space):
            _upsert(warehouse, fact.where(earlier), entity)
            _upsert(warehouse, fact.where(again).withColumn(measure, (F.col(measure) + 1).cast("float")), entity)
            return space.keep(warehouse.read(star.STAR_FACTS[entity].table))

    return query


def user_activity_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored activity after a load without some recent rows, and after these arrived late."""
    facts = {e: _fact(spark, sf_dir, e) for e in ENTITIES}
    with _warehouse(spark, "activity-ledger") as (warehouse, space):
        for late in (False, True):
            for entity, fact in facts.items():
                recent = F.col(S.STAMP) >= F.lit(LOADED_BEFORE[entity]).cast("timestamp")
                comes_late = recent & (F.crc32(F.col("InteractionID")) % 5 == 0)
                # Late rows are asked for their days and their ids, too, so they are made once.
                rows = space.step(fact.where(comes_late)) if late else fact.where(~comes_late)
                _upsert(warehouse, rows, entity)
            jobs.load_activity(warehouse)
        stored = warehouse.read(jobs.FACT_USER_ACTIVITY)
        return space.keep(stored.drop(S.STAMP, "LoadTimestamp"))


def _with_streamed(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    community, live, video = (_fact(spark, sf_dir, e) for e in ENTITIES)
    return [community, live, star.all_video(video, _streamed_fact(spark, sf_dir))]


def activity_with_streamed_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.user_activity(activity.unify_activity(*_with_streamed(spark, sf_dir)))


def mart_engagement_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engagement mart with streamed video, over platforms of all sources."""
    platforms = _members_of_all(star.DIM_PLATFORM)(spark, sf_dir)
    return marts.engagement_overview(*_with_streamed(spark, sf_dir), platforms)


def mart_demographics_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics over the user table that all three loads have filled."""
    return marts.demographics(_fact(spark, sf_dir, "video"), dim_user_merged(spark, sf_dir))


def _mart_by_days(mart: Callable[..., DataFrame], *dims: tuple[str, star.Dim]) -> Query:
    """A mart over stored sums by day, of which the days of late rows were computed again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        entities = ENTITIES if mart is marts.engagement_overview else (dims[0][0],)
        parts = []
        for entity in entities:
            fact = _fact(spark, sf_dir, entity)
            late = (F.col(S.STAMP) >= F.lit(LOADED_BEFORE[entity]).cast("timestamp")) & (
                F.crc32(F.col("InteractionID")) % 5 == 0
            )
            dated = fact.withColumn(star.STAMP_DAY, star.stamp_day(F.col(S.STAMP)))
            days = dated.where(late).select(star.STAMP_DAY).distinct()
            touched = dated.join(F.broadcast(days), star.STAMP_DAY, "left_semi")  # as many as the calendar has
            stored, fresh = marts.day_parts(fact.where(~late), entity), marts.day_parts(touched, entity)
            parts.append(activity.replace_days(stored, fresh, star.STAMP_DAY, days))
        members = [star.build_dim(staging_layer(spark, sf_dir, e), d) for e, d in dims]
        if mart is marts.engagement_overview:
            platforms = [staging_layer(spark, sf_dir, e).select("Platform") for e in ENTITIES]
            members = [star.build_dim(union_aligned(platforms), star.DIM_PLATFORM)]
        return mart(*parts, *members)

    return query


def _stamp_census(profile: str) -> Query:
    return lambda spark, sf_dir: op.stamp_census(staging_layer(spark, sf_dir, profile))


LOAD_QUERIES: dict[str, Query] = {
    "ingest_changed_rows": _ingest_changed("live"),
    "ingest_changed_rows_community": _ingest_changed("community"),
    "ingest_changed_rows_video": _ingest_changed("video"),
    "ingest_indexed_rows": _ingest_indexed("live"),
    "ingest_indexed_rows_community": _ingest_indexed("community"),
    "ingest_indexed_rows_video": _ingest_indexed("video"),
    "dim_platform_all": _members_of_all(star.DIM_PLATFORM),
    "dim_device_type_all": _members_of_all(star.DIM_DEVICE_TYPE),
    "dim_time_all": _members_of_all(star.DIM_TIME),
    "dim_user_merged": dim_user_merged,
    "dim_user_refreshed": dim_user_refreshed,
    "dim_video_merged": dim_video_merged,
    "fact_live_batch_after_stream": fact_live_batch_after_stream,
    "fact_community_upsert": _fact_upsert("community"),
    "fact_live_upsert": _fact_upsert("live"),
    "fact_video_upsert": _fact_upsert("video"),
    "user_activity_ledger": user_activity_ledger,
    "user_activity_late_rows": user_activity_late_rows,
    "activity_with_streamed_video": activity_with_streamed_video,
    "mart_engagement_streamed": mart_engagement_streamed,
    "mart_demographics_merged": mart_demographics_merged,
    "mart_engagement_by_days": _mart_by_days(marts.engagement_overview),
    "mart_community_by_days": _mart_by_days(marts.community_trends, ("community", star.DIM_COMMUNITY)),
    "mart_live_by_days": _mart_by_days(
        marts.live_streaming, ("live", star.DIM_EVENT), ("live", star.DIM_DEVICE_TYPE)
    ),
    "mart_video_by_days": _mart_by_days(marts.video_interactions, ("video", star.DIM_WATCH_REASON)),
    "mart_time_by_days": _mart_by_days(marts.time_trends, ("video", star.DIM_TIME)),
    "mart_demographics_by_days": _mart_by_days(marts.demographics, ("video", star.DIM_USER_VIDEO)),
    "stream_stamp_census": _stamp_census("live_stream"),
    "stream_stamp_census_video": _stamp_census("video_stream"),
}
