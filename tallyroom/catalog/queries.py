"""Every operator as a query over the given tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Load timestamps
are left out, since they differ from run to run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom import operators as op
from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom.catalog.events import EVENT_QUERIES
from tallyroom.catalog.loads import LOAD_QUERIES
from tallyroom.functions import (
    age_group,
    apply_map,
    hour_of,
    interaction_id,
    time_spent_category,
    valid_time_or_default,
)
from tallyroom.plans import activity, marts, star
from tallyroom.plans.clean import staging
from tallyroom.plans.layers import cleaning, raw_layer, staging_layer
from tallyroom.session import tune
from tallyroom.sources import adapters, conform_schema, materialise, union_aligned
from tallyroom.sources.readers import align_for_union, read_staged_stream
from tallyroom.sources.writers import fresh_path
from tallyroom.streaming.clean import clean_stream
from tallyroom.streaming.decode import decode_json
from tallyroom.streaming.jobs import run_entity_stream, staged_schema

Query = Callable[[SparkSession, str], DataFrame]
ENTITIES = ("community", "live", "video")

# Rows stamped before these days count as already loaded in incremental queries.
LOADED_BEFORE = {"community": "1998-01-01", "live": "2024-01-16", "video": "1998-01-01"}


def _fact(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    return star.build_fact_complete(staging_layer(spark, sf_dir, profile), star.STAR_FACTS[profile])


def _dim(spark: SparkSession, sf_dir: str, profile: str, dim: star.Dim) -> DataFrame:
    return star.build_dim(staging_layer(spark, sf_dir, profile), dim)


def _loaded(df: DataFrame, entity: str) -> DataFrame:
    return df.filter(F.col(S.STAMP) < F.lit(LOADED_BEFORE[entity]).cast("timestamp"))


# --- per-entity stages ------------------------------------------------------


def _stage(profile: str, attribute: str) -> Query:
    return lambda spark, sf_dir: getattr(cleaning(spark, sf_dir, profile), attribute)


def _on_valid(profile: str, operator: Callable[[DataFrame, tuple[str, ...]], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stages = cleaning(spark, sf_dir, profile)
        return operator(stages.valid, stages.rules.keys)

    return query


def _conform(profile: str) -> Query:
    return lambda spark, sf_dir: staging(
        cleaning(spark, sf_dir, profile).clean, R.PROFILES[profile]
    )


def _interaction_id(profile: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = cleaning(spark, sf_dir, profile).non_null
        parts = star.STAR_FACTS[profile].id_parts
        row_id = interaction_id(*[F.col(c) for c in parts]).alias("InteractionID")
        return raw.select(row_id, *parts)

    return query


def _fact_quality(profile: str) -> Query:
    return lambda spark, sf_dir: op.quality_gate(
        _fact(spark, sf_dir, profile), star.STAR_FACTS[profile].critical
    )


def _fact_lookup(entity: str) -> Query:
    """Fact rows against dimensions loaded earlier: unknown members drop the row."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = staging_layer(spark, sf_dir, entity)
        earlier = _loaded(staged, entity)
        dims = {
            d.table: materialise(star.build_dim(earlier, d), d.table.lower())
            for d in star.STAR_DIMS[entity]
        }
        return star.build_fact_stored(staged, star.STAR_FACTS[entity], dims)

    return query


def _entity_queries(entity: str) -> dict[str, Query]:
    critical = R.INGEST_CRITICAL[entity]
    return {
        f"{entity}_null_profile": lambda s, d: op.null_profile(raw_layer(s, d, entity)),
        f"{entity}_ingest_gate": lambda s, d: op.quality_gate(raw_layer(s, d, entity), critical),
        f"{entity}_critical_nulls": _stage(entity, "critical_nulls"),
        f"{entity}_dropna": _stage(entity, "non_null"),
        f"{entity}_median": _stage(entity, "medians"),
        f"{entity}_filled": _stage(entity, "filled"),
        f"{entity}_fill_audit": _stage(entity, "fill_audit"),
        f"{entity}_valid": _stage(entity, "valid"),
        f"{entity}_reject_reasons": _stage(entity, "rejects"),
        f"{entity}_change_audit": _stage(entity, "change_audit"),
        f"{entity}_latest": _stage(entity, "latest"),
        f"{entity}_superseded": _stage(entity, "superseded"),
        f"{entity}_clean": _stage(entity, "clean"),
        f"{entity}_funnel": _stage(entity, "funnel"),
        f"{entity}_duplicate_keys": _on_valid(entity, op.duplicate_keys),
        f"{entity}_duplicate_census": _on_valid(entity, op.duplicate_census),
        f"{entity}_top_duplicates": _on_valid(entity, op.top_duplicates),
        f"{entity}_dedup_exact": _on_valid(
            entity, lambda df, keys: op.dedup_exact(df, [*keys, S.STAMP])
        ),
        f"conform_{entity}": _conform(entity),
        f"{entity}_quality_gate": _stage(entity, "quality"),
        f"interaction_id_{entity}": _interaction_id(entity),
        f"fact_{entity}": lambda s, d: _fact(s, d, entity),
        f"fact_{entity}_lookup": _fact_lookup(entity),
        f"fact_{entity}_quality": _fact_quality(entity),
    }


# --- standardisation over whole tables --------------------------------------


def _values(entities: str, column: str, new: Callable) -> Query:
    """Old value, standard value and number of rows for one column, over the given entities."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = [raw_layer(spark, sf_dir, e).select(column) for e in entities.split()]
        counted = union_aligned(raw).groupBy(F.col(column).alias("OldValue"))
        return counted.agg(F.count(F.lit(1)).alias("TotalRows")).select(
            "OldValue", new(F.col("OldValue")).alias("NewValue"), "TotalRows"
        )

    return query


def _vocabulary(entities: str, column: str, rule: R.ValueMap) -> Query:
    return _values(entities, column, lambda value: apply_map(value, rule))


def _formats(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = R.PROFILES[entity]
        texts = sorted({*rules.trim, *rules.lower})
        return op.format_text(raw_layer(spark, sf_dir, entity), rules).select(*rules.keys, *texts)

    return query


STANDARD_QUERIES: dict[str, Query] = {
    "std_gender": _vocabulary("community video", "Gender", R.GENDER),
    "std_platform": _vocabulary("community live video", "Platform", R.PLATFORM),
    "std_device": _vocabulary("live video", "DeviceType", R.BATCH_DEVICE),
    "std_event_type": _vocabulary("live", "EventType", R.BATCH_EVENT_TYPE),
    "std_os": _vocabulary("video", "OS", R.OS),
    "std_connection": _vocabulary("video", "ConnectionType", R.BATCH_CONNECTION),
    "std_membership": _vocabulary("community", "MembershipStatus", R.MEMBERSHIP),
    "std_watchtime": _values("live video", "WatchTime", valid_time_or_default),
    "std_stream_device": _vocabulary("live video", "DeviceType", R.STREAM_DEVICE),
    "std_stream_event_type": _vocabulary("live", "EventType", R.STREAM_EVENT_TYPE),
    "std_stream_connection": _vocabulary("video", "ConnectionType", R.STREAM_CONNECTION),
    "std_stream_category": _vocabulary("video", "VideoCategory", R.STREAM_VIDEO_CATEGORY),
    "std_stream_reason": _vocabulary("video", "WatchReason", R.STREAM_WATCH_REASON),
    "fmt_community": _formats("community"),
    "fmt_live": _formats("live"),
    "fmt_video": _formats("video"),
    "fmt_live_stream": lambda s, d: op.format_text(raw_layer(s, d, "live"), R.LIVE_STREAM).select(
        "EventID", "UserID", *R.LIVE_STREAM.trim
    ),
    "fmt_video_stream": lambda s, d: op.format_text(raw_layer(s, d, "video"), R.VIDEO_STREAM).select(
        "UserID", "VideoID", *R.VIDEO_STREAM.lower
    ),
    "age_group": lambda s, d: union_aligned(
        [raw_layer(s, d, e).select("Age") for e in ("community", "video")]
    ).groupBy("Age").agg(F.count(F.lit(1)).alias("TotalRows")).select("Age", age_group(F.col("Age")).alias("AgeGroup"), "TotalRows"),
    "time_spent_category": lambda s, d: raw_layer(s, d, "video").groupBy(
        time_spent_category(F.col("TotalTimeSpent")).alias("TimeSpentCategory")
    ).agg(
        F.count(F.lit(1)).alias("TotalRows"),
        F.min("TotalTimeSpent").alias("Least"),
        F.max("TotalTimeSpent").alias("Most"),
    ),
    "hour_of_watchtime": _values("live video", "WatchTime", hour_of),
}


# --- ingest -----------------------------------------------------------------


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON property text of events as typed columns."""
    events = adapters.table(spark, sf_dir, "events")
    payload = T.StructType([T.StructField("k", T.LongType())])
    return decode_json(events, "props", payload, keep=("event_id",))


def json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live interactions sent as JSON message bytes and decoded again."""
    sent = adapters.as_messages(raw_layer(spark, sf_dir, "live"), S.LIVE_DDL)
    return decode_json(sent, "value", S.message_schema(S.LIVE_DDL))


def _as_file(df: DataFrame, narrow_ints: bool) -> DataFrame:
    """A canonical frame in the layout of a source file: its names and widths."""
    schema = S.file_schema(S.VIDEO_DDL, S.VIDEO_FILE_NAMES, narrow_ints)
    pairs = zip(S.message_schema(S.VIDEO_DDL), schema)
    return df.select(*[F.col(c.name).cast(f.dataType).alias(f.name) for c, f in pairs])


def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video rows in the CSV layout, brought back to the canonical schema by name."""
    narrow = _as_file(raw_layer(spark, sf_dir, "video"), narrow_ints=True)
    return conform_schema(narrow, S.message_schema(S.VIDEO_DDL), S.VIDEO_FILE_NAMES)


def ingest_align_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older narrow CSV export without OS, and a newer JSON one, as one frame."""
    video = raw_layer(spark, sf_dir, "video")
    before = F.col(S.STAMP) < F.lit(LOADED_BEFORE["video"]).cast("timestamp")
    csv = _as_file(video.filter(before), narrow_ints=True).drop("OS")
    json = _as_file(video.filter(~before), narrow_ints=False)
    schema = S.message_schema(S.VIDEO_DDL)
    return union_aligned(
        [align_for_union(f, schema, S.VIDEO_FILE_NAMES) for f in (json, csv)]
    )


def _ingest_anti(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_layer(spark, sf_dir, entity)
        return op.anti_ingest_stored(raw, _loaded(raw, entity), R.PROFILES[entity].keys)

    return query


INGEST_QUERIES: dict[str, Query] = {
    "json_decode": json_decode,
    "json_messages": json_messages,
    "schema_conform": schema_conform,
    "ingest_align_union": ingest_align_union,
    "ingest_anti": _ingest_anti("live"),
    "ingest_anti_community": _ingest_anti("community"),
    "ingest_anti_video": _ingest_anti("video"),
}


# --- stream profiles on the whole table -------------------------------------


def _stream_ingest(profile: str) -> Query:
    """Keys of the rows that a real streaming run leaves in staging, if the rows are right.

    The table is read as a message stream, decoded, stamped, cleaned,
    deduplicated under the watermark and written with a checkpoint.  Which copy
    of a key arrives first is open, so each staged row is held, in all columns
    but the stamp, against the cleaned rows of the table; a row that is none of
    them loses its key here.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = R.PROFILES[profile]
        path = fresh_path(spark, f"streamed-{profile}")
        checkpoint = fresh_path(spark, f"checkpoint-{profile}")
        messages = adapters.MESSAGES[profile](spark, sf_dir)
        run_entity_stream(messages, rules, path, checkpoint, trigger=None).awaitTermination()
        staged = read_staged_stream(spark, path, staged_schema(rules))
        cleaned = clean_stream(raw_layer(spark, sf_dir, profile.removesuffix("_stream")), rules)
        columns = [c for c in staged_schema(rules).names if c != S.STAMP]
        wrong = op.anti_content(staged, cleaned, columns).select(*rules.keys)
        return staged.select(*rules.keys).exceptAll(wrong)

    return query


STREAM_QUERIES: dict[str, Query] = {
    "live_stream_ingest": _stream_ingest("live_stream"),
    "video_stream_ingest": _stream_ingest("video_stream"),
    "live_stream_valid": _stage("live_stream", "valid"),
    "video_stream_valid": _stage("video_stream", "valid"),
    "live_stream_clean": _stage("live_stream", "clean"),
    "video_stream_clean": _stage("video_stream", "clean"),
    "conform_live_stream": _conform("live_stream"),
    "conform_video_stream": _conform("video_stream"),
    "interaction_id_video_stream": _interaction_id("video_stream"),
}


# --- star, activity, marts --------------------------------------------------


def _dim_query(profile: str, dim: star.Dim) -> Query:
    return lambda spark, sf_dir: _dim(spark, sf_dir, profile, dim)


def _dim_incremental(entity: str, dim: star.Dim, part: str = "true") -> Query:
    """Members of the whole staging frame that an earlier load, perhaps of a part only, did not have."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = staging_layer(spark, sf_dir, entity)
        existing = star.build_dim(_loaded(staged, entity).where(part), dim)
        return star.new_members(staged, dim, existing)

    return query


def _dim_refresh(entity: str, dim: star.Dim) -> Query:
    """A dimension of earlier rows, refreshed from the later rows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = staging_layer(spark, sf_dir, entity)
        earlier = F.col(S.STAMP) < F.lit(LOADED_BEFORE[entity]).cast("timestamp")
        existing = star.build_dim(staged.filter(earlier), dim)
        return star.merged_members(staged.filter(~earlier), dim, existing, refresh=True)

    return query


def stream_staged_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staging_layer(spark, sf_dir, "video_stream")
    return staged.withColumn("EngagementScore", F.col("Engagement"))


def fact_video_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stream_staged_video(spark, sf_dir)
    return star.stream_video_layout(star.build_fact_complete(staged, star.FACT_VIDEO_STREAM))


def fact_live_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the streamed live rows that an earlier load did not store."""
    staged = staging_layer(spark, sf_dir, "live_stream")
    stored = star.build_fact_complete(_loaded(staged, "live"), star.FACT_LIVE)
    return op.anti_append(star.build_fact_complete(staged, star.FACT_LIVE), stored)


def fact_video_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stream_staged_video(spark, sf_dir)
    stored = star.build_fact_complete(_loaded(staged, "video"), star.FACT_VIDEO_STREAM)
    fresh = op.anti_append(star.build_fact_complete(staged, star.FACT_VIDEO_STREAM), stored)
    return star.stream_video_layout(fresh)


def activity_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.unify_activity(*[_fact(spark, sf_dir, e) for e in ENTITIES])


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.user_activity(activity_unified(spark, sf_dir))


def user_activity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    critical = ("InteractionID", "UserID_Surrogate", "ActivityDate")
    return op.quality_gate(user_activity(spark, sf_dir), critical)


def user_activity_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity rows beyond those an earlier load of the live fact stored."""
    facts = {e: _fact(spark, sf_dir, e) for e in ENTITIES}
    whole = activity.activity_sums(activity.unify_activity(*facts.values()))
    earlier = [_loaded(facts[e], e) for e in ENTITIES]
    stored = activity.activity_sums(activity.unify_activity(*earlier))
    # Rows of the same group have the same row id; the groups are where the sums left them.
    return activity.with_row_ids(op.anti_append(whole, stored, activity.GROUPED))


def mart_engagement_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = {e: staging_layer(spark, sf_dir, e) for e in ENTITIES}
    facts = [star.build_fact_complete(staged[e], star.STAR_FACTS[e]) for e in ENTITIES]
    platforms = union_aligned([s.select("Platform") for s in staged.values()])
    return marts.engagement_overview(*facts, star.build_dim(platforms, star.DIM_PLATFORM))


def _mart(entity: str, mart: Callable[..., DataFrame], *dims: star.Dim) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = staging_layer(spark, sf_dir, entity)
        fact = star.build_fact_complete(staged, star.STAR_FACTS[entity])
        return mart(fact, *[star.build_dim(staged, d) for d in dims])

    return query


STAR_QUERIES: dict[str, Query] = {
    "dim_user_community": _dim_query("community", star.DIM_USER_COMMUNITY),
    "dim_user_live": _dim_query("live", star.DIM_USER_LIVE),
    "dim_user_video": _dim_query("video", star.DIM_USER_VIDEO),
    "dim_community": _dim_query("community", star.DIM_COMMUNITY),
    "dim_event": _dim_query("live", star.DIM_EVENT),
    "dim_video": _dim_query("video", star.DIM_VIDEO),
    "dim_video_stream": _dim_query("video_stream", star.DIM_VIDEO_STREAM),
    "dim_platform": _dim_query("live", star.DIM_PLATFORM),
    "dim_membership_status": _dim_query("community", star.DIM_MEMBERSHIP_STATUS),
    "dim_device_type": _dim_query("video", star.DIM_DEVICE_TYPE),
    "dim_os": _dim_query("video", star.DIM_OS),
    "dim_connection_type": _dim_query("video", star.DIM_CONNECTION_TYPE),
    "dim_watch_reason": _dim_query("video", star.DIM_WATCH_REASON),
    "dim_time": _dim_query("live", star.DIM_TIME),
    "dim_user_incremental": _dim_incremental("community", star.DIM_USER_COMMUNITY),
    "dim_platform_incremental": _dim_incremental("live", star.DIM_PLATFORM, "Platform < 'i'"),
    "dim_event_refresh": _dim_refresh("live", star.DIM_EVENT),
    "fact_video_stream": fact_video_stream,
    "fact_live_incremental": fact_live_incremental,
    "fact_video_incremental": fact_video_incremental,
    "activity_unified": activity_unified,
    "user_activity": user_activity,
    "user_activity_quality": user_activity_quality,
    "user_activity_incremental": user_activity_incremental,
    "mart_engagement_overview": mart_engagement_overview,
    "mart_community_trends": _mart("community", marts.community_trends, star.DIM_COMMUNITY),
    "mart_live_streaming": _mart(
        "live", marts.live_streaming, star.DIM_EVENT, star.DIM_DEVICE_TYPE
    ),
    "mart_video_interactions": _mart("video", marts.video_interactions, star.DIM_WATCH_REASON),
    "mart_time_trends": _mart("video", marts.time_trends, star.DIM_TIME),
    "mart_demographics": _mart("video", marts.demographics, star.DIM_USER_VIDEO),
}


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {}
    for entity in ENTITIES:
        registered |= _entity_queries(entity)
    registered |= STANDARD_QUERIES | INGEST_QUERIES | STREAM_QUERIES | EVENT_QUERIES | STAR_QUERIES | LOAD_QUERIES
    return {name: _tuned(query) for name, query in registered.items()}
