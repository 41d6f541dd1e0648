"""Declared schemas of the entities, their source files and the star tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical columns and types of each entity, in table order.
COMMUNITY_DDL = """
    CommunityID BIGINT, CommunityName STRING, UserID BIGINT, Platform STRING,
    Age BIGINT, Gender STRING, CommunityEngagement BIGINT,
    MembershipStatus STRING, TotalTimeSpent BIGINT
"""
LIVE_DDL = """
    EventID BIGINT, EventType STRING, UserID BIGINT, Platform STRING,
    LiveEngagement BIGINT, ViewerCount BIGINT, StreamDuration BIGINT,
    DeviceType STRING, WatchTime STRING, AddictionLevel BIGINT
"""
VIDEO_DDL = """
    UserID BIGINT, Age BIGINT, Gender STRING, Location STRING, Income BIGINT,
    Debt BOOLEAN, OwnsProperty BOOLEAN, Profession STRING, Demographics STRING,
    Platform STRING, TotalTimeSpent BIGINT, NumberOfSessions BIGINT,
    VideoID BIGINT, VideoCategory STRING, VideoLength BIGINT, Engagement BIGINT,
    ImportanceScore BIGINT, TimeSpentOnVideo BIGINT,
    NumberOfVideosWatched BIGINT, ScrollRate BIGINT, Frequency STRING,
    ProductivityLoss BIGINT, Satisfaction BIGINT, WatchReason STRING,
    DeviceType STRING, OS STRING, WatchTime STRING, SelfControl BIGINT,
    AddictionLevel BIGINT, CurrentActivity STRING, ConnectionType STRING
"""

# Column names as they appear in the source files -> canonical.
COMMUNITY_FILE_NAMES = {"Total Time Spent": "TotalTimeSpent"}
LIVE_FILE_NAMES = {"Watch Time": "WatchTime", "Addiction Level": "AddictionLevel"}
VIDEO_FILE_NAMES = {
    "Owns Property": "OwnsProperty",
    "Total Time Spent": "TotalTimeSpent",
    "Number of Sessions": "NumberOfSessions",
    "Video ID": "VideoID",
    "Video Category": "VideoCategory",
    "Video Length": "VideoLength",
    "Importance Score": "ImportanceScore",
    "Time Spent On Video": "TimeSpentOnVideo",
    "Number of Videos Watched": "NumberOfVideosWatched",
    "Scroll Rate": "ScrollRate",
    "Productivity Loss": "ProductivityLoss",
    "Watch Reason": "WatchReason",
    "Watch Time": "WatchTime",
    "Self Control": "SelfControl",
    "Addiction Level": "AddictionLevel",
}

STAMP = "IngestionTimestamp"
#: Rows without a stamp count for this time, so they stay in one day however often they are loaded.
NO_STAMP = "1970-01-01 00:00:00"


_TYPES = {"BIGINT": T.LongType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType()}


def message_schema(ddl: str) -> T.StructType:
    """Schema of one JSON message: the entity without its ingestion stamp.

    Built here rather than by Spark, so rules can be declared without a session.
    """
    columns = [column.split() for column in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[dtype], True) for name, dtype in columns])


def entity_schema(ddl: str) -> T.StructType:
    """Schema of a stored entity: the message plus the ingestion stamp."""
    return message_schema(ddl).add(STAMP, T.TimestampType(), True)


def file_schema(
    ddl: str, file_names: dict[str, str], narrow_ints: bool = False
) -> T.StructType:
    """Schema of a source file: canonical types under the file's own names.

    ``narrow_ints`` gives the 32-bit layout of the CSV export, which also
    writes ``ProductivityLoss`` without a space.
    """
    to_file = {canonical: name for name, canonical in file_names.items()}
    if narrow_ints:
        to_file.pop("ProductivityLoss", None)
    fields = []
    for field in message_schema(ddl):
        narrow = narrow_ints and isinstance(field.dataType, T.LongType)
        fields.append(
            T.StructField(
                to_file.get(field.name, field.name),
                T.IntegerType() if narrow else field.dataType,
                True,
            )
        )
    return T.StructType(fields)
