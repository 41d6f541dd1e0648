"""Star schema: dimensions and facts described as data, built by two functions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom import operators as op
from tallyroom.functions import hour_of, interaction_id, surrogate, time_spent_category
from tallyroom.rules import MIDNIGHT
from tallyroom.schemas import NO_STAMP, STAMP
from tallyroom.sources.marks import PLACE, marked, marks_of, with_places

# Tables of the star, their columns and types.
USER_ATTRIBUTES = {
    "Age": "bigint",
    "Gender": "string",
    "Location": "string",
    "Income": "bigint",
    "Debt": "boolean",
    "OwnsProperty": "boolean",
    "Profession": "string",
    "Demographics": "string",
    "CurrentActivity": "string",
    "AgeGroup": "string",
}


@dataclass(frozen=True)
class Dim:
    """A dimension: natural key, surrogate, attributes taken from staging.

    ``attributes`` maps output columns to types; one that is not in ``known``
    becomes a typed NULL.  ``default`` replaces a missing natural key.
    """

    table: str
    key: str
    surrogate: str
    key_type: str = "string"
    attributes: Mapping[str, str] = field(default_factory=dict)
    known: tuple[str, ...] = ()
    default: str | None = None


DIM_USER_COMMUNITY = Dim(
    "DIM_USER", "UserID", "User_S_ID",
    attributes=USER_ATTRIBUTES, known=("Age", "Gender", "AgeGroup"),
)
DIM_USER_LIVE = Dim("DIM_USER", "UserID", "User_S_ID", attributes=USER_ATTRIBUTES)
DIM_USER_VIDEO = Dim(
    "DIM_USER", "UserID", "User_S_ID",
    attributes=USER_ATTRIBUTES, known=tuple(USER_ATTRIBUTES),
)
DIM_COMMUNITY = Dim(
    "DIM_COMMUNITY", "CommunityID", "Community_S_ID", "bigint",
    {"CommunityName": "string"}, ("CommunityName",),
)
DIM_EVENT = Dim(
    "DIM_EVENT", "EventID", "Event_S_ID", "bigint",
    {"EventType": "string", "StreamDuration": "bigint"}, ("EventType", "StreamDuration"),
)
DIM_VIDEO = Dim(
    "DIM_VIDEO", "VideoID", "Video_S_ID", "bigint",
    {"VideoCategory": "string", "VideoLength": "bigint", "TimeSpentCategory": "string"},
    ("VideoCategory", "VideoLength", "TimeSpentCategory"),
)
DIM_VIDEO_STREAM = Dim(  # the table's one layout; streams know the category alone
    "DIM_VIDEO", "VideoID", "Video_S_ID", "bigint", DIM_VIDEO.attributes, ("VideoCategory",),
)
DIM_PLATFORM = Dim("DIM_PLATFORM", "Platform", "PlatformID")
DIM_MEMBERSHIP_STATUS = Dim("DIM_MEMBERSHIP_STATUS", "MembershipStatus", "MembershipStatusID")
DIM_DEVICE_TYPE = Dim("DIM_DEVICE_TYPE", "DeviceType", "DeviceTypeID")
DIM_OS = Dim("DIM_OS", "OS", "OS_ID")
DIM_CONNECTION_TYPE = Dim("DIM_CONNECTION_TYPE", "ConnectionType", "ConnectionTypeID")
DIM_WATCH_REASON = Dim("DIM_WATCH_REASON", "WatchReason", "WatchReasonID")
DIM_TIME = Dim(
    "DIM_TIME", "WatchTime", "TimeID",
    attributes={"Hour": "bigint"}, known=("Hour",), default=MIDNIGHT,
)

# Attributes computed from other staging columns.
DERIVED = {
    "TimeSpentCategory": ("TotalTimeSpent", time_spent_category),
    "Hour": ("WatchTime", hour_of),
}


@dataclass(frozen=True)
class Fact:
    """A fact: row id, dimension links (dimension, output name), measures with types."""

    table: str
    id_parts: tuple[str, ...]
    links: tuple[tuple[Dim, str], ...]
    measures: Mapping[str, str]
    critical: tuple[str, ...]


FACT_COMMUNITY = Fact(
    "FACT_COMMUNITY_INTERACTIONS",
    ("CommunityID", "UserID", STAMP),
    (
        (DIM_USER_COMMUNITY, "UserID_Surrogate"),
        (DIM_COMMUNITY, "CommunityID_Surrogate"),
        (DIM_PLATFORM, "PlatformID"),
        (DIM_MEMBERSHIP_STATUS, "MembershipStatusID"),
    ),
    {"CommunityEngagement": "float", "TotalTimeSpent": "float", STAMP: "timestamp"},
    ("InteractionID", "UserID_Surrogate", "CommunityID_Surrogate", "TotalTimeSpent"),
)
FACT_LIVE = Fact(
    "FACT_LIVE_STREAMING_INTERACTIONS",
    ("EventID", "UserID", STAMP),
    (
        (DIM_USER_LIVE, "UserID_Surrogate"),
        (DIM_EVENT, "EventID_Surrogate"),
        (DIM_PLATFORM, "PlatformID"),
        (DIM_DEVICE_TYPE, "DeviceTypeID"),
        (DIM_TIME, "TimeID"),
    ),
    {
        "LiveEngagement": "float", "ViewerCount": "float", "AddictionLevel": "float",
        STAMP: "timestamp",
    },
    ("InteractionID", "UserID_Surrogate", "EventID_Surrogate", "LiveEngagement"),
)
FACT_VIDEO = Fact(
    "FACT_VIDEO_INTERACTIONS",
    ("UserID", "VideoID", STAMP),
    (
        (DIM_USER_VIDEO, "UserID_Surrogate"),
        (DIM_VIDEO, "VideoID_Surrogate"),
        (DIM_PLATFORM, "PlatformID"),
        (DIM_DEVICE_TYPE, "DeviceTypeID"),
        (DIM_OS, "OS_ID"),
        (DIM_CONNECTION_TYPE, "ConnectionTypeID"),
        (DIM_TIME, "TimeID"),
        (DIM_WATCH_REASON, "WatchReasonID"),
    ),
    {
        "TimeSpentOnVideo": "bigint", "TotalTimeSpent": "bigint", "Engagement": "float",
        "NumberOfSessions": "bigint", "NumberOfVideosWatched": "bigint",
        "ScrollRate": "float", "ImportanceScore": "float", "ProductivityLoss": "float",
        "Satisfaction": "float", "SelfControl": "float", "AddictionLevel": "float",
        STAMP: "timestamp",
    },
    ("InteractionID", "UserID_Surrogate", "VideoID_Surrogate", "TimeSpentOnVideo", "TotalTimeSpent"),
)
FACT_VIDEO_STREAM = Fact(
    "FACT_VIDEO_INTERACTIONS_STREAM",
    ("VideoID", "UserID", STAMP),
    (
        (DIM_USER_LIVE, "UserID_Surrogate"),
        (DIM_VIDEO_STREAM, "VideoID_Surrogate"),
        (DIM_PLATFORM, "PlatformID"),
        (DIM_DEVICE_TYPE, "DeviceTypeID"),
        (DIM_TIME, "TimeID"),
    ),
    {"EngagementScore": "float", STAMP: "timestamp"},
    ("INTERACTIONID", "USERID_SURROGATE", "VIDEOID_SURROGATE", "ENGAGEMENTSCORE"),
)
# Placeholders of the stream layout of the video fact.
STREAM_LAYOUT_NULLS = {
    "AGE": "string",
    "GENDER": "string",
    "LOCATION": "string",
    "INCOME": "float",
    "DEBT": "boolean",
    "OWNSPROPERTY": "boolean",
    "PROFESSION": "string",
    "DEMOGRAPHICS": "string",
    "CURRENT_ACTIVITY": "string",
    "AGEGROUP": "string",
    "WATCH_DURATION": "float",
    "VIDEO_CATEGORY": "string",
}

STAR_DIMS = {
    "community": (DIM_USER_COMMUNITY, DIM_COMMUNITY, DIM_PLATFORM, DIM_MEMBERSHIP_STATUS),
    "live": (DIM_USER_LIVE, DIM_EVENT, DIM_PLATFORM, DIM_DEVICE_TYPE, DIM_TIME),
    "video": (
        DIM_USER_VIDEO, DIM_VIDEO, DIM_PLATFORM, DIM_DEVICE_TYPE, DIM_OS,
        DIM_CONNECTION_TYPE, DIM_TIME, DIM_WATCH_REASON,
    ),
    "live_stream": (DIM_USER_LIVE, DIM_EVENT, DIM_PLATFORM, DIM_DEVICE_TYPE, DIM_TIME),
    "video_stream": (DIM_USER_LIVE, DIM_VIDEO_STREAM, DIM_PLATFORM, DIM_DEVICE_TYPE, DIM_TIME),
}
STAR_FACTS = {
    "community": FACT_COMMUNITY,
    "live": FACT_LIVE,
    "video": FACT_VIDEO,
    "live_stream": FACT_LIVE,
    "video_stream": FACT_VIDEO_STREAM,
}


#: Partition of stored facts: the day of the stamp.
STAMP_DAY = "StampDay"


def stamp_day(stamped: Column) -> Column:
    """The day of a row's stamp; rows without one share a fixed day."""
    return F.coalesce(F.to_date(stamped), F.lit(NO_STAMP).cast("date"))


def natural_key(dim: Dim):
    key = F.col(dim.key)
    return F.coalesce(key, F.lit(dim.default)) if dim.default is not None else key


def build_dim(staged: DataFrame, dim: Dim) -> DataFrame:
    """One row per member; attributes come from the member's newest staging row.

    A dimension without varying attributes needs no order at all and is a
    plain distinct, which Spark reduces before the shuffle.
    """
    key = natural_key(dim).cast(dim.key_type).alias(dim.key)
    varying = [a for a in dim.known if a != "Hour"]
    if varying:
        picked = []
        for name in varying:
            source, derive = DERIVED.get(name, (name, None))
            value = derive(F.col(source)) if derive else F.col(source)
            picked.append(value.cast(dim.attributes[name]).alias(name))
        members = staged.select(key, STAMP, *picked).filter(F.col(dim.key).isNotNull())
        members = op.latest_by_key(members, [dim.key])
    else:
        members = staged.select(key).filter(F.col(dim.key).isNotNull()).distinct()
    attributes = []
    for name, dtype in dim.attributes.items():
        if name in varying:
            attributes.append(F.col(name))
        elif name in dim.known:
            source, derive = DERIVED[name]
            attributes.append(derive(F.col(source)).cast(dtype).alias(name))
        else:
            attributes.append(F.lit(None).cast(dtype).alias(name))
    return members.select(
        surrogate(F.col(dim.key)).alias(dim.surrogate), dim.key, *attributes
    )


def _finish_fact(linked: DataFrame, fact: Fact) -> DataFrame:
    return linked.select(
        interaction_id(*[F.col(c) for c in fact.id_parts]).alias("InteractionID"),
        *[out for _, out in fact.links],
        *[F.col(c).cast(t).alias(c) for c, t in fact.measures.items()],
    )


def build_fact(staged: DataFrame, fact: Fact, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows by one lookup per dimension; rows without a member are dropped.

    ``staged`` holds one row per id (see ``plans.clean.staging``) and a lookup
    never multiplies rows, so the result needs no further deduplication.
    """
    return _finish_fact(_linked(staged, fact, dims), fact)


def _linked(staged: DataFrame, fact: Fact, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Staging rows with the surrogates of the fact's dimensions; those without a member go."""

    def link(df: DataFrame, spec: tuple[Dim, str]) -> DataFrame:
        dim, out = spec
        df = df.withColumn("_key", natural_key(dim))
        return op.lookup(df, dims[dim.table], "_key", dim.key, dim.surrogate, f"_{out}")

    linked = reduce(link, fact.links, staged)
    for _, out in fact.links:
        linked = linked.withColumnRenamed(f"_{out}", out)
    return linked


#: Members from which on a dimension's keys are looked up apart from the rows.
MANY_MEMBERS = 10_000


def build_fact_stored(staged: DataFrame, fact: Fact, dims: Mapping[str, DataFrame]) -> DataFrame:
    """``build_fact`` where ``staged`` is a scan of stored files, whose rows stay where they are.

    A large dimension meets the rows' keys and places alone (see ``sources.marks``): if all its
    surrogates are the md5 of their keys, which is looked at first, a member tells a row no more
    than that it is there.  Any other dimension is looked up as in ``build_fact``.
    """
    placed, apart = with_places(staged), {}
    for dim, out in fact.links:
        members, key = dims[dim.table], natural_key(dim).cast("string")
        odd = ~F.col(dim.surrogate).eqNullSafe(surrogate(F.col(dim.key)))
        known = members.agg(F.count(F.lit(1)).alias("all"), F.count_if(odd).alias("odd")).first()
        if known["odd"] or known["all"] < MANY_MEMBERS:
            continue
        keyed = placed.select(key.alias("_key"), *PLACE)
        named = members.select(F.col(dim.key).cast("string").alias("_key"))
        marks = marks_of(keyed.join(named, "_key", "left_semi").select(*PLACE))
        if marks is not None:
            placed, apart[out] = marked(placed, marks), surrogate(key)

    rest = replace(fact, links=tuple(link for link in fact.links if link[1] not in apart))
    linked = _linked(placed.select(*staged.columns), rest, dims)
    return _finish_fact(linked.withColumns(apart), fact)


def build_fact_complete(staged: DataFrame, fact: Fact) -> DataFrame:
    """The same fact where the dimensions were loaded from this very staging frame.

    Every non-NULL natural key then has its member, and a surrogate is the md5
    of the natural key, so each inner lookup is a NOT NULL filter and an
    expression: the fact needs no join and no shuffle of its own.
    """
    present = reduce(and_, [natural_key(d).isNotNull() for d, _ in fact.links])
    linked = staged.filter(present).withColumns(
        {out: surrogate(natural_key(d)) for d, out in fact.links}
    )
    return _finish_fact(linked, fact)


def stream_video_layout(fact: DataFrame) -> DataFrame:
    """Upper-case names and typed placeholders of the stream-loaded video fact."""
    upper = fact.select(*[F.col(c).alias(c.upper()) for c in fact.columns])
    return op.add_typed_nulls(upper, STREAM_LAYOUT_NULLS)


def new_members(staged: DataFrame, dim: Dim, existing: DataFrame | None) -> DataFrame:
    """Members to append to a stored dimension."""
    built = build_dim(staged, dim)
    return built if existing is None else op.missing_members(built, existing, dim.key)


def merged_members(
    staged: DataFrame, dim: Dim, existing: DataFrame, refresh: bool = False
) -> DataFrame:
    """Stored and new members in the stored layout; no member and no value is lost.

    An attribute that this source knows fills a stored NULL; with ``refresh`` the
    source's value replaces the stored one.  Attributes that it does not know
    stay as stored.
    """
    built = build_dim(staged, dim)
    joined = existing.alias("old").join(built.alias("new"), dim.key, "full_outer")
    out = []
    for name in existing.columns:
        old = F.col(f"old.{name}") if name != dim.key else F.col(name)
        if name == dim.key or name not in built.columns:
            out.append(old)
            continue
        new = F.col(f"new.{name}")
        known = name in dim.known or name == dim.surrogate
        first, second = (new, old) if refresh and name in dim.known else (old, new)
        out.append(F.coalesce(first, second).alias(name) if known else old.alias(name))
    return joined.select(*out)


def fillable(staged: DataFrame, dim: Dim, existing: DataFrame) -> DataFrame:
    """Stored members with a NULL that this source can fill."""
    known = [a for a in dim.known if a in existing.columns and a != "Hour"]
    if not known:
        return existing.limit(0)
    gaps = existing.where(op.any_null(known)).select(dim.key, *[F.col(a).alias(f"_{a}") for a in known])
    built = build_dim(staged, dim)
    gains = reduce(or_, [F.col(f"_{a}").isNull() & F.col(a).isNotNull() for a in known])
    return gaps.join(built, dim.key).where(gains)


def streamed_video(fact: DataFrame) -> DataFrame:
    """The stream-loaded video fact in the columns of the batch one.

    Its engagement is the score; measures that a stream does not carry are NULL.
    """
    have = {c.upper(): c for c in fact.columns}
    columns = {
        "InteractionID": "string",
        **{out: "string" for _, out in FACT_VIDEO.links},
        **FACT_VIDEO.measures,
    }

    def column(name: str, kind: str):
        source = "ENGAGEMENTSCORE" if name == "Engagement" else name.upper()
        value = F.col(have[source]) if source in have else F.lit(None)
        return value.cast(kind).alias(name)

    return fact.select(*[column(n, k) for n, k in columns.items()])


def all_video(batch: DataFrame, streamed: DataFrame | None) -> DataFrame:
    """Batch and streamed video facts under the layout of the batch one."""
    if streamed is None:
        return batch
    return batch.unionByName(streamed_video(streamed).select(*batch.columns))
