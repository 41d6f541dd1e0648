"""Cleaning rules as data: one ``RuleSet`` per entity and mode.

Batch and stream disagree on purpose in a few places (device and connection
vocabularies, the upper bound of addiction levels, which column is critical),
so each mode is its own declared profile and neither is derived from the other.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tallyroom import schemas as S


@dataclass(frozen=True)
class Check:
    """One validity rule; ``high=None`` leaves the range open above."""

    column: str
    low: int
    high: int | None = None
    reason: str = ""


def positive(column: str) -> Check:
    return Check(column, 1, None, f"Invalid {column}")


def non_negative(column: str) -> Check:
    return Check(column, 0, None, f"Negative {column}")


def within(column: str, low: int, high: int) -> Check:
    return Check(column, low, high, f"Invalid {column}")


@dataclass(frozen=True)
class ValueMap:
    """Closed vocabulary: fold ``aliases``, keep ``allowed``, else ``default``."""

    allowed: tuple[str, ...] = ()
    aliases: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    default: str = "Unknown"


@dataclass(frozen=True)
class RuleSet:
    name: str
    ddl: str
    keys: tuple[str, ...]
    critical: tuple[str, ...]
    fills: Mapping[str, str | int | bool]
    checks: tuple[Check, ...]
    maps: Mapping[str, ValueMap]
    trim: tuple[str, ...]
    title: tuple[str, ...]
    conform: tuple[str, ...]
    medians: Mapping[str, int] = field(default_factory=dict)
    lower: tuple[str, ...] = ()
    clock: tuple[str, ...] = ()
    age_group: bool = False

    def __post_init__(self) -> None:
        columns = set(S.message_schema(self.ddl).names)
        named = {
            *self.keys, *self.critical, *self.fills, *self.medians, *self.maps,
            *self.trim, *self.lower, *self.title, *self.conform, *self.clock,
            *(c.column for c in self.checks),
        }
        if unknown := named - columns:
            raise ValueError(f"{self.name}: rules name unknown columns {sorted(unknown)}")
        if empty := [c for c, v in {**self.fills, **self.medians}.items() if v is None]:
            raise ValueError(f"{self.name}: fill value missing for {empty}")


# --- Fixed values -----------------------------------------------------------
# Vocabularies, fill values, validity bounds and column lists below have to
# equal the published behaviour for results to agree.

GENDER = ValueMap(
    aliases={
        "Male": ("Male", "M", "male"),
        "Female": ("Female", "F", "female"),
        "Other": ("Other", "Non-binary", "non-binary"),
    }
)
PLATFORM = ValueMap(("Instagram", "YouTube", "Facebook", "TikTok", "Unknown"))
MEMBERSHIP = ValueMap(("Member", "Admin"), default="Member")
OS = ValueMap(("Android", "iOS", "Windows", "MacOS", "Unknown"))

BATCH_DEVICE = ValueMap(
    ("Smartphone", "Tablet", "Desktop", "Unknown"),
    {"Desktop": ("Computer", "PC", "Laptop")},
)
BATCH_EVENT_TYPE = ValueMap(
    ("LiveStream", "Broadcast", "Unknown"),
    {"LiveStream": ("Sports", "Concert", "Gaming", "Q&A")},
)
BATCH_CONNECTION = ValueMap(
    ("Wi-Fi", "Cellular", "Unknown"),
    {"Cellular": ("Mobile Data", "4G", "5G")},
)

STREAM_DEVICE = ValueMap(("Mobile", "Desktop", "Tablet", "Unknown"))
STREAM_EVENT_TYPE = ValueMap(("LiveStream", "Broadcast", "Unknown"))
STREAM_CONNECTION = ValueMap(("WiFi", "Cellular", "Unknown"))
STREAM_VIDEO_CATEGORY = ValueMap(("Entertainment", "Education", "Gaming", "Vlog", "Unknown"))
STREAM_WATCH_REASON = ValueMap(("Entertainment", "Education", "Relaxation", "Unknown"))

MIDNIGHT = "00:00:00"

COMMUNITY = RuleSet(
    name="community",
    ddl=S.COMMUNITY_DDL,
    keys=("CommunityID", "UserID"),
    critical=("CommunityID", "UserID", "TotalTimeSpent"),
    fills={
        "CommunityName": "Unknown",
        "Platform": "Unknown",
        "Gender": "Unknown",
        "CommunityEngagement": 0,
        "MembershipStatus": "Member",
    },
    medians={"Age": 30},
    checks=(
        positive("CommunityID"),
        positive("UserID"),
        within("Age", 13, 100),
        non_negative("TotalTimeSpent"),
        non_negative("CommunityEngagement"),
    ),
    maps={"Gender": GENDER, "Platform": PLATFORM, "MembershipStatus": MEMBERSHIP},
    trim=("CommunityName", "Platform", "Gender", "MembershipStatus"),
    title=("CommunityName", "Platform"),
    conform=("Platform", "MembershipStatus", "Gender", "CommunityName"),
    age_group=True,
)

LIVE = RuleSet(
    name="live",
    ddl=S.LIVE_DDL,
    keys=("EventID", "UserID"),
    critical=("EventID", "UserID", "LiveEngagement"),
    fills={
        "EventType": "Unknown",
        "Platform": "Unknown",
        "ViewerCount": 0,
        "StreamDuration": 0,
        "DeviceType": "Unknown",
        "WatchTime": "Unknown",
    },
    medians={"AddictionLevel": 0},
    checks=(
        positive("EventID"),
        positive("UserID"),
        non_negative("LiveEngagement"),
        non_negative("ViewerCount"),
        non_negative("StreamDuration"),
        within("AddictionLevel", 0, 10),
    ),
    maps={"Platform": PLATFORM, "DeviceType": BATCH_DEVICE, "EventType": BATCH_EVENT_TYPE},
    trim=("EventType", "Platform", "DeviceType", "WatchTime"),
    title=("EventType", "Platform", "DeviceType"),
    conform=("Platform", "DeviceType", "EventType", "WatchTime"),
)

LIVE_STREAM = RuleSet(
    name="live_stream",
    ddl=S.LIVE_DDL,
    keys=("EventID", "UserID"),
    critical=("EventID", "UserID", "LiveEngagement"),
    fills={
        "EventType": "Unknown",
        "Platform": "Unknown",
        "ViewerCount": 0,
        "StreamDuration": 0,
        "DeviceType": "Unknown",
        "WatchTime": MIDNIGHT,
        "AddictionLevel": 0,
    },
    checks=(
        positive("EventID"),
        positive("UserID"),
        non_negative("LiveEngagement"),
        non_negative("ViewerCount"),
        non_negative("StreamDuration"),
        non_negative("AddictionLevel"),
    ),
    maps={
        "EventType": STREAM_EVENT_TYPE,
        "Platform": PLATFORM,
        "DeviceType": STREAM_DEVICE,
    },
    clock=("WatchTime",),
    trim=("EventType", "Platform", "DeviceType", "WatchTime"),
    title=("EventType", "Platform", "DeviceType"),
    conform=("Platform", "DeviceType", "EventType", "WatchTime"),
)

VIDEO = RuleSet(
    name="video",
    ddl=S.VIDEO_DDL,
    keys=("UserID", "VideoID"),
    critical=("UserID", "VideoID", "TotalTimeSpent"),
    fills={
        "Gender": "Unknown",
        "Location": "Unknown",
        "Debt": False,
        "OwnsProperty": False,
        "Profession": "Unknown",
        "Demographics": "Unknown",
        "Platform": "Unknown",
        "NumberOfSessions": 0,
        "VideoCategory": "Unknown",
        "VideoLength": 0,
        "Engagement": 0,
        "ImportanceScore": 0,
        "TimeSpentOnVideo": 0,
        "NumberOfVideosWatched": 0,
        "ScrollRate": 0,
        "Frequency": "Unknown",
        "ProductivityLoss": 0,
        "Satisfaction": 0,
        "WatchReason": "Unknown",
        "DeviceType": "Unknown",
        "OS": "Unknown",
        "WatchTime": "Unknown",
        "SelfControl": 0,
        "CurrentActivity": "Unknown",
        "ConnectionType": "Unknown",
    },
    medians={"Age": 30, "Income": 50000, "AddictionLevel": 0},
    checks=(
        positive("UserID"),
        positive("VideoID"),
        within("Age", 13, 100),
        non_negative("TotalTimeSpent"),
        non_negative("NumberOfSessions"),
        non_negative("VideoLength"),
        non_negative("Engagement"),
        non_negative("ImportanceScore"),
        non_negative("TimeSpentOnVideo"),
        non_negative("NumberOfVideosWatched"),
        non_negative("ScrollRate"),
        non_negative("ProductivityLoss"),
        within("Satisfaction", 0, 10),
        within("SelfControl", 0, 10),
        within("AddictionLevel", 0, 10),
    ),
    maps={
        "Gender": GENDER,
        "Platform": PLATFORM,
        "DeviceType": BATCH_DEVICE,
        "OS": OS,
        "ConnectionType": BATCH_CONNECTION,
    },
    trim=(
        "Gender", "Location", "Profession", "Demographics", "Platform",
        "VideoCategory", "Frequency", "WatchReason", "DeviceType", "OS",
        "WatchTime", "CurrentActivity", "ConnectionType",
    ),
    title=(
        "Location", "Profession", "Platform", "VideoCategory", "DeviceType",
        "OS", "CurrentActivity",
    ),
    conform=("Platform", "DeviceType", "OS", "ConnectionType", "WatchReason", "WatchTime"),
    age_group=True,
)

VIDEO_STREAM = RuleSet(
    name="video_stream",
    ddl=S.VIDEO_DDL,
    keys=("UserID", "VideoID"),
    critical=("UserID", "VideoID", "TimeSpentOnVideo"),
    fills={
        "Age": 30,
        "Gender": "Unknown",
        "Location": "Unknown",
        "Income": 0,
        "Debt": False,
        "OwnsProperty": False,
        "Profession": "Unknown",
        "Demographics": "Unknown",
        "Platform": "Unknown",
        "TotalTimeSpent": 0,
        "NumberOfSessions": 0,
        "VideoCategory": "Unknown",
        "VideoLength": 0,
        "Engagement": 0,
        "ImportanceScore": 0,
        "NumberOfVideosWatched": 0,
        "ScrollRate": 0,
        "Frequency": "Unknown",
        "ProductivityLoss": 0,
        "Satisfaction": 0,
        "WatchReason": "Unknown",
        "DeviceType": "Unknown",
        "OS": "Unknown",
        "WatchTime": MIDNIGHT,
        "SelfControl": 0,
        "AddictionLevel": 0,
        "CurrentActivity": "Unknown",
        "ConnectionType": "Unknown",
    },
    checks=(
        positive("UserID"),
        positive("VideoID"),
        within("Age", 13, 100),
        non_negative("TotalTimeSpent"),
        non_negative("NumberOfSessions"),
        non_negative("VideoLength"),
        non_negative("Engagement"),
        non_negative("ImportanceScore"),
        non_negative("TimeSpentOnVideo"),
        non_negative("NumberOfVideosWatched"),
        non_negative("ScrollRate"),
        non_negative("ProductivityLoss"),
        non_negative("Satisfaction"),
        non_negative("SelfControl"),
        non_negative("AddictionLevel"),
    ),
    maps={
        "Gender": GENDER,
        "Platform": PLATFORM,
        "DeviceType": STREAM_DEVICE,
        "OS": OS,
        "ConnectionType": STREAM_CONNECTION,
        "VideoCategory": STREAM_VIDEO_CATEGORY,
        "WatchReason": STREAM_WATCH_REASON,
    },
    clock=("WatchTime",),
    lower=(
        "Gender", "Location", "Profession", "Demographics", "Platform",
        "VideoCategory", "Frequency", "WatchReason", "DeviceType", "OS",
        "CurrentActivity", "ConnectionType",
    ),
    trim=(),
    title=(
        "Location", "Profession", "Platform", "VideoCategory", "DeviceType",
        "OS", "CurrentActivity",
    ),
    conform=("Platform", "DeviceType", "VideoCategory", "WatchTime"),
    age_group=True,
)

# Columns whose nulls are reported when a file is ingested (nothing is dropped).
INGEST_CRITICAL = {
    "community": ("CommunityID", "UserID", "TotalTimeSpent"),
    "live": ("EventID", "UserID", "WatchTime"),
    "video": ("UserID", "VideoID", "WatchTime", "TotalTimeSpent"),
}

# Age bands: inclusive upper bound -> label; ages outside every band are 65+.
AGE_BANDS = (
    (13, 17, "13-17"),
    (18, 24, "18-24"),
    (25, 34, "25-34"),
    (35, 44, "35-44"),
    (45, 54, "45-54"),
    (55, 64, "55-64"),
)
AGE_BAND_OTHER = "65+"
# Seconds spent: below 300 is short, up to and including 1800 medium.
SHORT_BELOW = 300
MEDIUM_UPTO = 1800
# ----------------------------------------------------------------------------

PROFILES = {r.name: r for r in (COMMUNITY, LIVE, VIDEO, LIVE_STREAM, VIDEO_STREAM)}
