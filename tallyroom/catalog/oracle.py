"""The SQL counterpart of every registered query, over the same tables.

Written out from the rules rather than generated from ``tallyroom.rules``, so a
wrong rule shows as a difference.  Each entity has one chain of common table
expressions with a stage per name; a query selects from the stage it checks.
"""

from __future__ import annotations


def _title(text: str) -> str:
    """Title case by blank-separated words, in SQL."""
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


_GENDER_OF = """CASE {0} % 8 WHEN 0 THEN 'Male' WHEN 1 THEN 'M' WHEN 2 THEN 'male'
    WHEN 3 THEN 'F' WHEN 4 THEN 'female' WHEN 5 THEN 'Non-binary' WHEN 6 THEN 'x' END"""
_TIME_OF = """CASE {0} % 5 WHEN 0 THEN 'Morning' WHEN 1 THEN '14:30:00'
    WHEN 2 THEN ' Evening ' WHEN 3 THEN '09:05:59' END"""

_STD_GENDER = """CASE WHEN {0} IN ('Male', 'M', 'male') THEN 'Male'
    WHEN {0} IN ('Female', 'F', 'female') THEN 'Female'
    WHEN {0} IN ('Other', 'Non-binary', 'non-binary') THEN 'Other' ELSE 'Unknown' END"""
_STD_PLATFORM = """CASE WHEN {0} IN ('Instagram', 'YouTube', 'Facebook', 'TikTok')
    THEN {0} ELSE 'Unknown' END"""
_STD_MEMBERSHIP = "CASE WHEN {0} = 'Admin' THEN 'Admin' ELSE 'Member' END"
_STD_OS = "CASE WHEN {0} IN ('Android', 'iOS', 'Windows', 'MacOS') THEN {0} ELSE 'Unknown' END"
_STD_DEVICE = """CASE WHEN {0} IN ('Computer', 'PC', 'Laptop', 'Desktop') THEN 'Desktop'
    WHEN {0} IN ('Smartphone', 'Tablet') THEN {0} ELSE 'Unknown' END"""
_STD_EVENT = """CASE WHEN {0} IN ('Sports', 'Concert', 'Gaming', 'Q&A', 'LiveStream') THEN 'LiveStream'
    WHEN {0} = 'Broadcast' THEN {0} ELSE 'Unknown' END"""
_STD_CONNECTION = """CASE WHEN {0} IN ('Mobile Data', '4G', '5G', 'Cellular') THEN 'Cellular'
    WHEN {0} = 'Wi-Fi' THEN {0} ELSE 'Unknown' END"""
_STD_STREAM_DEVICE = "CASE WHEN {0} IN ('Mobile', 'Desktop', 'Tablet') THEN {0} ELSE 'Unknown' END"
_STD_STREAM_EVENT = "CASE WHEN {0} IN ('LiveStream', 'Broadcast') THEN {0} ELSE 'Unknown' END"
_STD_STREAM_CONNECTION = "CASE WHEN {0} IN ('WiFi', 'Cellular') THEN {0} ELSE 'Unknown' END"
_STD_STREAM_CATEGORY = """CASE WHEN {0} IN ('Entertainment', 'Education', 'Gaming', 'Vlog')
    THEN {0} ELSE 'Unknown' END"""
_STD_STREAM_REASON = """CASE WHEN {0} IN ('Entertainment', 'Education', 'Relaxation')
    THEN {0} ELSE 'Unknown' END"""
_STD_CLOCK = "CASE WHEN try_cast({0} AS TIME) IS NOT NULL THEN {0} ELSE '00:00:00' END"
_HOUR = "CAST(extract(hour FROM try_strptime({0}, '%H:%M:%S')) AS BIGINT)"
_AGE_GROUP = """CASE WHEN Age BETWEEN 13 AND 17 THEN '13-17' WHEN Age BETWEEN 18 AND 24 THEN '18-24'
    WHEN Age BETWEEN 25 AND 34 THEN '25-34' WHEN Age BETWEEN 35 AND 44 THEN '35-44'
    WHEN Age BETWEEN 45 AND 54 THEN '45-54' WHEN Age BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END"""
_SPENT = """CASE WHEN TotalTimeSpent < 300 THEN 'Short' WHEN TotalTimeSpent <= 1800 THEN 'Medium'
    ELSE 'Long' END"""

# --- raw entities -----------------------------------------------------------

RAW = {
    "live": f"""
SELECT k AS EventID,
  CASE event_type WHEN 'view' THEN 'LiveStream' WHEN 'click' THEN 'Gaming'
    WHEN 'signup' THEN ' Broadcast' WHEN 'purchase' THEN 'Podcast' END AS EventType,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS UserID,
  CASE event_id % 7 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'TikTok' WHEN 2 THEN 'Instagram'
    WHEN 3 THEN 'Facebook' WHEN 4 THEN 'Twitch' WHEN 5 THEN 'youtube' END AS Platform,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) - 2 END AS LiveEngagement,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_id % 5000 - 25 END AS ViewerCount,
  CASE WHEN event_id % 83 = 0 THEN NULL ELSE k * 150 - 300 END AS StreamDuration,
  CASE event_id % 6 WHEN 0 THEN 'Smartphone' WHEN 1 THEN 'Desktop' WHEN 2 THEN 'Tablet'
    WHEN 3 THEN 'Laptop' WHEN 4 THEN 'Mobile' END AS DeviceType,
  {_TIME_OF.format('event_id')} AS WatchTime,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 13 - 1 END AS AddictionLevel,
  CAST(ts AS TIMESTAMP) AS IngestionTimestamp
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e""",
    "community": f"""
SELECT CAST(n_nationkey AS BIGINT) AS CommunityID,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE concat('  ', lower(n_name), ' fans ') END AS CommunityName,
  CAST(c_custkey AS BIGINT) AS UserID,
  CASE c_custkey % 6 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'TikTok' WHEN 2 THEN 'Instagram'
    WHEN 3 THEN 'Facebook' WHEN 4 THEN 'Reddit' END AS Platform,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 8 + c_custkey % 97 END AS Age,
  {_GENDER_OF.format('c_custkey')} AS Gender,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(floor(c_acctbal) AS BIGINT) END AS CommunityEngagement,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Admin' WHEN '2-HIGH' THEN 'Moderator'
    WHEN '3-MEDIUM' THEN 'Member' END AS MembershipStatus,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 100) AS BIGINT) END AS TotalTimeSpent,
  CAST(o_orderdate AS TIMESTAMP) AS IngestionTimestamp
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "video": f"""
SELECT CASE WHEN r % 101 = 0 THEN NULL ELSE o_custkey END AS UserID,
  CASE WHEN r % 37 = 0 THEN NULL ELSE 8 + o_custkey % 97 END AS Age,
  {_GENDER_OF.format('o_custkey')} AS Gender,
  CASE WHEN r % 41 = 0 THEN NULL ELSE concat(' ', lower(n_name)) END AS Location,
  CASE WHEN r % 43 = 0 THEN NULL ELSE CAST(floor(c_acctbal * 10) AS BIGINT) END AS Income,
  CASE o_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS Debt,
  CASE o_custkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS OwnsProperty,
  lower(c_mktsegment) AS Profession,
  CASE o_custkey % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Rural' END AS Demographics,
  CASE l_partkey % 6 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'TikTok' WHEN 2 THEN 'Instagram'
    WHEN 3 THEN 'Facebook' WHEN 4 THEN 'Vimeo' END AS Platform,
  CASE WHEN r % 53 = 0 THEN NULL ELSE CAST(floor(l_extendedprice / 20) AS BIGINT) END AS TotalTimeSpent,
  CAST(l_linenumber AS BIGINT) AS NumberOfSessions,
  CAST(l_partkey AS BIGINT) AS VideoID,
  CASE p_type WHEN 'ECONOMY' THEN 'Entertainment' WHEN 'STANDARD' THEN 'education'
    WHEN 'PROMO' THEN 'Gaming' ELSE NULL END AS VideoCategory,
  CAST(p_size AS BIGINT) * 60 AS VideoLength,
  CAST(floor(l_quantity) AS BIGINT) - 1 AS Engagement,
  r % 12 - 1 AS ImportanceScore,
  CAST(floor(l_extendedprice / 40) AS BIGINT) AS TimeSpentOnVideo,
  r % 20 AS NumberOfVideosWatched,
  r % 50 AS ScrollRate,
  CASE r % 4 WHEN 0 THEN 'Daily' WHEN 1 THEN 'Weekly' WHEN 2 THEN 'Monthly' END AS Frequency,
  r % 6 AS ProductivityLoss,
  CASE WHEN r % 59 = 0 THEN NULL ELSE r % 13 - 1 END AS Satisfaction,
  CASE l_returnflag WHEN 'A' THEN 'Entertainment' WHEN 'N' THEN 'Habit' ELSE NULL END AS WatchReason,
  CASE r % 7 WHEN 0 THEN 'Smartphone' WHEN 1 THEN 'Desktop' WHEN 2 THEN 'Tablet' WHEN 3 THEN 'Laptop'
    WHEN 4 THEN 'Mobile' WHEN 5 THEN 'Computer' END AS DeviceType,
  CASE r % 6 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' WHEN 3 THEN 'MacOS'
    WHEN 4 THEN 'Linux' END AS OS,
  {_TIME_OF.format('r')} AS WatchTime,
  r % 11 AS SelfControl,
  CASE WHEN r % 61 = 0 THEN NULL ELSE r % 12 - 1 END AS AddictionLevel,
  CASE r % 3 WHEN 0 THEN 'at work' WHEN 1 THEN 'At home' END AS CurrentActivity,
  CASE r % 6 WHEN 0 THEN 'Wi-Fi' WHEN 1 THEN 'Mobile Data' WHEN 2 THEN '4G' WHEN 3 THEN 'WiFi'
    WHEN 4 THEN 'Cellular' END AS ConnectionType,
  CAST(l_shipdate AS TIMESTAMP) AS IngestionTimestamp
FROM (SELECT *, l_orderkey * 7 + l_linenumber AS r FROM lineitem) l
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
}

COLUMNS = {
    "community": """CommunityID CommunityName UserID Platform Age Gender CommunityEngagement
        MembershipStatus TotalTimeSpent IngestionTimestamp""".split(),
    "live": """EventID EventType UserID Platform LiveEngagement ViewerCount StreamDuration
        DeviceType WatchTime AddictionLevel IngestionTimestamp""".split(),
    "video": """UserID Age Gender Location Income Debt OwnsProperty Profession Demographics Platform
        TotalTimeSpent NumberOfSessions VideoID VideoCategory VideoLength Engagement ImportanceScore
        TimeSpentOnVideo NumberOfVideosWatched ScrollRate Frequency ProductivityLoss Satisfaction
        WatchReason DeviceType OS WatchTime SelfControl AddictionLevel CurrentActivity
        ConnectionType IngestionTimestamp""".split(),
}
KEYS = {
    "community": ("CommunityID", "UserID"),
    "live": ("EventID", "UserID"),
    "video": ("UserID", "VideoID"),
}
CRITICAL = {
    "community": ("CommunityID", "UserID", "TotalTimeSpent"),
    "live": ("EventID", "UserID", "LiveEngagement"),
    "video": ("UserID", "VideoID", "TotalTimeSpent"),
    "live_stream": ("EventID", "UserID", "LiveEngagement"),
    "video_stream": ("UserID", "VideoID", "TimeSpentOnVideo"),
}
INGEST_CRITICAL = {
    "community": ("CommunityID", "UserID", "TotalTimeSpent"),
    "live": ("EventID", "UserID", "WatchTime"),
    "video": ("UserID", "VideoID", "WatchTime", "TotalTimeSpent"),
}
MEDIAN = {
    "community": {"Age": 30},
    "live": {"AddictionLevel": 0},
    "video": {"Age": 30, "Income": 50000, "AddictionLevel": 0},
    "live_stream": {},
    "video_stream": {},
}
# Replacement of NULL per column, as SQL text.
_VIDEO_TEXT = """Gender Location Profession Demographics Platform VideoCategory Frequency
    WatchReason DeviceType OS CurrentActivity ConnectionType""".split()
_VIDEO_ZERO = """NumberOfSessions VideoLength Engagement ImportanceScore NumberOfVideosWatched
    ScrollRate ProductivityLoss Satisfaction SelfControl""".split()
FILL = {
    "community": {
        "CommunityName": "'Unknown'", "Platform": "'Unknown'", "Gender": "'Unknown'",
        "CommunityEngagement": "0", "MembershipStatus": "'Member'",
    },
    "live": {
        "EventType": "'Unknown'", "Platform": "'Unknown'", "ViewerCount": "0",
        "StreamDuration": "0", "DeviceType": "'Unknown'", "WatchTime": "'Unknown'",
    },
    "video": {c: "'Unknown'" for c in _VIDEO_TEXT}
    | {c: "0" for c in _VIDEO_ZERO}
    | {"TimeSpentOnVideo": "0", "WatchTime": "'Unknown'", "Debt": "false", "OwnsProperty": "false"},
    "live_stream": {
        "EventType": "'Unknown'", "Platform": "'Unknown'", "ViewerCount": "0",
        "StreamDuration": "0", "DeviceType": "'Unknown'", "WatchTime": "'00:00:00'",
        "AddictionLevel": "0",
    },
    "video_stream": {c: "'Unknown'" for c in _VIDEO_TEXT}
    | {c: "0" for c in _VIDEO_ZERO}
    | {
        "Age": "30", "Income": "0", "TotalTimeSpent": "0", "AddictionLevel": "0",
        "WatchTime": "'00:00:00'", "Debt": "false", "OwnsProperty": "false",
    },
}
_LONG = "TotalTimeSpent NumberOfSessions VideoLength Engagement ImportanceScore TimeSpentOnVideo NumberOfVideosWatched ScrollRate ProductivityLoss".split()
# Reject reason of the first broken rule, NULL for a valid row.
REASON = {
    "community": """CASE WHEN CommunityID <= 0 THEN 'Invalid CommunityID'
        WHEN UserID <= 0 THEN 'Invalid UserID' WHEN Age NOT BETWEEN 13 AND 100 THEN 'Invalid Age'
        WHEN TotalTimeSpent < 0 THEN 'Negative TotalTimeSpent'
        WHEN CommunityEngagement < 0 THEN 'Negative CommunityEngagement' END""",
    "live": """CASE WHEN EventID <= 0 THEN 'Invalid EventID' WHEN UserID <= 0 THEN 'Invalid UserID'
        WHEN LiveEngagement < 0 THEN 'Negative LiveEngagement'
        WHEN ViewerCount < 0 THEN 'Negative ViewerCount'
        WHEN StreamDuration < 0 THEN 'Negative StreamDuration'
        WHEN AddictionLevel NOT BETWEEN 0 AND 10 THEN 'Invalid AddictionLevel' END""",
    "video": "CASE WHEN UserID <= 0 THEN 'Invalid UserID' WHEN VideoID <= 0 THEN 'Invalid VideoID'"
    " WHEN Age NOT BETWEEN 13 AND 100 THEN 'Invalid Age' "
    + " ".join(f"WHEN {c} < 0 THEN 'Negative {c}'" for c in _LONG)
    + " WHEN Satisfaction NOT BETWEEN 0 AND 10 THEN 'Invalid Satisfaction'"
    " WHEN SelfControl NOT BETWEEN 0 AND 10 THEN 'Invalid SelfControl'"
    " WHEN AddictionLevel NOT BETWEEN 0 AND 10 THEN 'Invalid AddictionLevel' END",
    "live_stream": """CASE WHEN EventID <= 0 THEN 'Invalid EventID' WHEN UserID <= 0 THEN 'Invalid UserID'
        WHEN LiveEngagement < 0 OR ViewerCount < 0 OR StreamDuration < 0 OR AddictionLevel < 0
        THEN 'Negative' END""",
    "video_stream": "CASE WHEN UserID <= 0 OR VideoID <= 0 OR Age NOT BETWEEN 13 AND 100 THEN 'Invalid' "
    + " ".join(f"WHEN {c} < 0 THEN 'Negative'" for c in [*_LONG, "Satisfaction", "SelfControl", "AddictionLevel"])
    + " END",
}
STANDARD = {
    "community": {"Gender": _STD_GENDER, "Platform": _STD_PLATFORM, "MembershipStatus": _STD_MEMBERSHIP},
    "live": {"Platform": _STD_PLATFORM, "DeviceType": _STD_DEVICE, "EventType": _STD_EVENT},
    "video": {
        "Gender": _STD_GENDER, "Platform": _STD_PLATFORM, "DeviceType": _STD_DEVICE,
        "OS": _STD_OS, "ConnectionType": _STD_CONNECTION,
    },
    "live_stream": {
        "EventType": _STD_STREAM_EVENT, "Platform": _STD_PLATFORM,
        "DeviceType": _STD_STREAM_DEVICE, "WatchTime": _STD_CLOCK,
    },
    "video_stream": {
        "Gender": _STD_GENDER, "Platform": _STD_PLATFORM, "DeviceType": _STD_STREAM_DEVICE,
        "OS": _STD_OS, "ConnectionType": _STD_STREAM_CONNECTION,
        "VideoCategory": _STD_STREAM_CATEGORY, "WatchReason": _STD_STREAM_REASON,
        "WatchTime": _STD_CLOCK,
    },
}
_VIDEO_TITLE = ("Location", "Profession", "Platform", "VideoCategory", "DeviceType", "OS", "CurrentActivity")
_VIDEO_PLAIN = ("Gender", "Demographics", "Frequency", "WatchReason", "ConnectionType")


def _formats(trimmed: tuple[str, ...], titled: tuple[str, ...], lowered: tuple[str, ...] = ()) -> dict[str, str]:
    return (
        {c: f"trim({c})" for c in trimmed}
        | {c: f"trim(lower({c}))" for c in lowered}
        | {c: _title(f"trim({c})") for c in titled}
    )


FORMAT = {
    "community": _formats(("Gender", "MembershipStatus"), ("CommunityName", "Platform")),
    "live": _formats(("WatchTime",), ("EventType", "Platform", "DeviceType")),
    "video": _formats((*_VIDEO_PLAIN, "WatchTime"), _VIDEO_TITLE),
    "live_stream": _formats(("WatchTime",), ("EventType", "Platform", "DeviceType")),
    "video_stream": _formats((), _VIDEO_TITLE, _VIDEO_PLAIN),
}
CONFORM = {
    "community": ("Platform", "MembershipStatus", "Gender", "CommunityName"),
    "live": ("Platform", "DeviceType", "EventType", "WatchTime"),
    "video": ("Platform", "DeviceType", "OS", "ConnectionType", "WatchReason", "WatchTime"),
    "live_stream": ("Platform", "DeviceType", "EventType", "WatchTime"),
    "video_stream": ("Platform", "DeviceType", "VideoCategory", "WatchTime"),
}
PROFILES = ("community", "live", "video", "live_stream", "video_stream")


def _entity(profile: str) -> str:
    return profile.removesuffix("_stream")


def _replace(expressions: dict[str, str]) -> str:
    if not expressions:
        return "*"
    return "* REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in expressions.items()) + ")"


def _order(profile: str, keys: tuple[str, ...]) -> str:
    rest = [c for c in COLUMNS[_entity(profile)] if c not in (*keys, "IngestionTimestamp")]
    return ", ".join(
        ["IngestionTimestamp DESC NULLS LAST", *[f"{c} ASC NULLS FIRST" for c in rest]]
    )


def _null(columns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"


def _chain(profile: str, prefix: str = "") -> str:
    """Common table expressions of all cleaning stages, without the leading WITH."""
    entity, p = _entity(profile), prefix
    keys = ", ".join(KEYS[entity])
    medians = ", ".join(
        f"coalesce(nullif(quantile_disc({c}, 0.5), 0), {d}) AS {c}"
        for c, d in MEDIAN[profile].items()
    ) or "1 AS one"
    filled = {c: f"coalesce({c}, {v})" for c, v in FILL[profile].items()} | {
        c: f"coalesce({c}, (SELECT m.{c} FROM {p}med m))" for c in MEDIAN[profile]
    }
    standard = {c: e.format(c) for c, e in STANDARD[profile].items()}
    age = f", {_AGE_GROUP} AS AgeGroup" if entity != "live" else ""
    conform = {c: f"lower(trim({c}))" for c in CONFORM[profile]}
    return f"""{p}raw AS ({RAW[entity]}),
{p}nonnull AS (SELECT * FROM {p}raw WHERE NOT {_null(CRITICAL[profile])}),
{p}med AS (SELECT {medians} FROM {p}nonnull),
{p}filled AS (SELECT {_replace(filled)} FROM {p}nonnull),
{p}judged AS (SELECT *, {REASON[profile]} AS Reason FROM {p}filled),
{p}valid AS (SELECT * EXCLUDE (Reason) FROM {p}judged WHERE Reason IS NULL),
{p}standard AS (SELECT {_replace(standard)} FROM {p}valid),
{p}ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {_order(profile, KEYS[entity])}) AS rn
  FROM {p}standard),
{p}latest AS (SELECT * EXCLUDE (rn) FROM {p}ranked WHERE rn = 1),
{p}clean AS (SELECT {_replace(FORMAT[profile])}{age} FROM {p}latest),
{p}staged AS (SELECT {_replace(conform)} FROM {p}clean)"""


def _select(profile: str, query: str) -> str:
    return f"WITH {_chain(profile)}\n{query}"


def _gate(columns: tuple[str, ...], source: str) -> str:
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS Null{c}" for c in columns)
    bad = f"count(*) FILTER (WHERE {_null(columns)})"
    return f"SELECT count(*) AS TotalRows, {nulls}, {bad} AS CriticalNullRows, {bad} = 0 AS Passed FROM {source}"


# --- star tables ------------------------------------------------------------

_USER_TYPES = {
    "Age": "BIGINT", "Gender": "VARCHAR", "Location": "VARCHAR", "Income": "BIGINT",
    "Debt": "BOOLEAN", "OwnsProperty": "BOOLEAN", "Profession": "VARCHAR",
    "Demographics": "VARCHAR", "CurrentActivity": "VARCHAR", "AgeGroup": "VARCHAR",
}


def _newest(source: str, key: str, attributes: dict[str, str]) -> str:
    """One row per key: newest stamp, then the attributes themselves."""
    picked = ", ".join(f"{e} AS {c}" for c, e in attributes.items())
    order = ", ".join(["IngestionTimestamp DESC NULLS LAST", *[f"{c} ASC NULLS FIRST" for c in attributes]])
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
  FROM (SELECT {key}, IngestionTimestamp, {picked} FROM {source}) a) b WHERE rn = 1"""


def _dim_user(source: str, known: tuple[str, ...]) -> str:
    attributes = ", ".join(
        c if c in known else f"CAST(NULL AS {t}) AS {c}" for c, t in _USER_TYPES.items()
    )
    members = _newest(source, "UserID", {c: c for c in known}) if known else f"SELECT DISTINCT UserID FROM {source}"
    return f"""SELECT md5(CAST(UserID AS VARCHAR)) AS User_S_ID, CAST(UserID AS VARCHAR) AS UserID, {attributes}
FROM ({members}) m"""


def _dim(source: str, key: str, surrogate: str, attributes: dict[str, str]) -> str:
    names = "".join(f", {c}" for c in attributes)
    return f"SELECT md5(CAST({key} AS VARCHAR)) AS {surrogate}, {key}{names} FROM ({_newest(source, key, attributes)}) m"


def _dim_plain(source: str, key: str, surrogate: str) -> str:
    return f"SELECT DISTINCT md5({key}) AS {surrogate}, {key} FROM {source}"


def _dim_time(source: str) -> str:
    return f"""SELECT md5(WatchTime) AS TimeID, WatchTime, {_HOUR.format('WatchTime')} AS Hour
FROM (SELECT DISTINCT coalesce(WatchTime, '00:00:00') AS WatchTime FROM {source}) t"""


_USER_COMMUNITY = ("Age", "Gender", "AgeGroup")
_EVENT = {"EventType": "EventType", "StreamDuration": "StreamDuration"}
_VIDEO_ATTRIBUTES = {"VideoCategory": "VideoCategory", "VideoLength": "VideoLength", "TimeSpentCategory": _SPENT}


def _star(profile: str, source: str) -> dict[str, str]:
    """Dimension name -> SQL over one staging relation."""
    plain = {
        "platform": ("Platform", "PlatformID"),
        "membership": ("MembershipStatus", "MembershipStatusID"),
        "device": ("DeviceType", "DeviceTypeID"),
        "os": ("OS", "OS_ID"),
        "connection": ("ConnectionType", "ConnectionTypeID"),
        "reason": ("WatchReason", "WatchReasonID"),
    }
    named = {n: _dim_plain(source, k, s) for n, (k, s) in plain.items()}
    named |= {
        "time": _dim_time(source),
        "community": _dim(source, "CommunityID", "Community_S_ID", {"CommunityName": "CommunityName"}),
        "event": _dim(source, "EventID", "Event_S_ID", _EVENT),
        "video": _dim(source, "VideoID", "Video_S_ID", _VIDEO_ATTRIBUTES),
        "video_stream": f"""SELECT *, CAST(NULL AS BIGINT) AS VideoLength, CAST(NULL AS VARCHAR) AS TimeSpentCategory
FROM ({_dim(source, 'VideoID', 'Video_S_ID', {'VideoCategory': 'VideoCategory'})}) s""",
    }
    users = {"community": _USER_COMMUNITY, "video": tuple(_USER_TYPES)}
    named["user"] = _dim_user(source, users.get(profile, ()))
    wanted = {
        "community": ("user", "community", "platform", "membership"),
        "live": ("user", "event", "platform", "device", "time"),
        "video": ("user", "video", "platform", "device", "os", "connection", "time", "reason"),
        "live_stream": ("user", "event", "platform", "device", "time"),
        "video_stream": ("user", "video_stream", "platform", "device", "time"),
    }
    return {n: named[n] for n in wanted[profile]}


_FACT_SELECT = {
    "community": """SELECT md5(concat_ws('_', f.CommunityID, f.UserID, f.IngestionTimestamp)) AS InteractionID,
  u.User_S_ID AS UserID_Surrogate, c.Community_S_ID AS CommunityID_Surrogate, p.PlatformID, s.MembershipStatusID,
  CAST(CommunityEngagement AS FLOAT) AS CommunityEngagement, CAST(TotalTimeSpent AS FLOAT) AS TotalTimeSpent,
  f.IngestionTimestamp
FROM {0} f JOIN {1}user u ON CAST(f.UserID AS VARCHAR) = u.UserID JOIN {1}community c ON f.CommunityID = c.CommunityID
JOIN {1}platform p ON f.Platform = p.Platform JOIN {1}membership s ON f.MembershipStatus = s.MembershipStatus""",
    "live": """SELECT md5(concat_ws('_', f.EventID, f.UserID, f.IngestionTimestamp)) AS InteractionID,
  u.User_S_ID AS UserID_Surrogate, e.Event_S_ID AS EventID_Surrogate, p.PlatformID, d.DeviceTypeID, t.TimeID,
  CAST(LiveEngagement AS FLOAT) AS LiveEngagement, CAST(ViewerCount AS FLOAT) AS ViewerCount,
  CAST(AddictionLevel AS FLOAT) AS AddictionLevel, f.IngestionTimestamp
FROM {0} f JOIN {1}user u ON CAST(f.UserID AS VARCHAR) = u.UserID JOIN {1}event e ON f.EventID = e.EventID
JOIN {1}platform p ON f.Platform = p.Platform JOIN {1}device d ON f.DeviceType = d.DeviceType
JOIN {1}time t ON coalesce(f.WatchTime, '00:00:00') = t.WatchTime""",
    "video": """SELECT md5(concat_ws('_', f.UserID, f.VideoID, f.IngestionTimestamp)) AS InteractionID,
  u.User_S_ID AS UserID_Surrogate, v.Video_S_ID AS VideoID_Surrogate, p.PlatformID, d.DeviceTypeID, o.OS_ID,
  n.ConnectionTypeID, t.TimeID, w.WatchReasonID, f.TimeSpentOnVideo, f.TotalTimeSpent,
  CAST(f.Engagement AS FLOAT) AS Engagement, f.NumberOfSessions, f.NumberOfVideosWatched,
  CAST(f.ScrollRate AS FLOAT) AS ScrollRate, CAST(f.ImportanceScore AS FLOAT) AS ImportanceScore,
  CAST(f.ProductivityLoss AS FLOAT) AS ProductivityLoss, CAST(f.Satisfaction AS FLOAT) AS Satisfaction,
  CAST(f.SelfControl AS FLOAT) AS SelfControl, CAST(f.AddictionLevel AS FLOAT) AS AddictionLevel,
  f.IngestionTimestamp
FROM {0} f JOIN {1}user u ON CAST(f.UserID AS VARCHAR) = u.UserID JOIN {1}video v ON f.VideoID = v.VideoID
JOIN {1}platform p ON f.Platform = p.Platform JOIN {1}device d ON f.DeviceType = d.DeviceType
JOIN {1}os o ON f.OS = o.OS JOIN {1}connection n ON f.ConnectionType = n.ConnectionType
JOIN {1}time t ON coalesce(f.WatchTime, '00:00:00') = t.WatchTime JOIN {1}reason w ON f.WatchReason = w.WatchReason""",
    "video_stream": """SELECT md5(concat_ws('_', f.VideoID, f.UserID, f.IngestionTimestamp)) AS INTERACTIONID,
  u.User_S_ID AS USERID_SURROGATE, v.Video_S_ID AS VIDEOID_SURROGATE, p.PlatformID AS PLATFORMID,
  d.DeviceTypeID AS DEVICETYPEID, t.TimeID AS TIMEID, CAST(f.Engagement AS FLOAT) AS ENGAGEMENTSCORE,
  f.IngestionTimestamp AS INGESTIONTIMESTAMP, CAST(NULL AS VARCHAR) AS AGE, CAST(NULL AS VARCHAR) AS GENDER,
  CAST(NULL AS VARCHAR) AS LOCATION, CAST(NULL AS FLOAT) AS INCOME, CAST(NULL AS BOOLEAN) AS DEBT,
  CAST(NULL AS BOOLEAN) AS OWNSPROPERTY, CAST(NULL AS VARCHAR) AS PROFESSION,
  CAST(NULL AS VARCHAR) AS DEMOGRAPHICS, CAST(NULL AS VARCHAR) AS CURRENT_ACTIVITY,
  CAST(NULL AS VARCHAR) AS AGEGROUP, CAST(NULL AS FLOAT) AS WATCH_DURATION, CAST(NULL AS VARCHAR) AS VIDEO_CATEGORY
FROM {0} f JOIN {1}user u ON CAST(f.UserID AS VARCHAR) = u.UserID JOIN {1}video_stream v ON f.VideoID = v.VideoID
JOIN {1}platform p ON f.Platform = p.Platform JOIN {1}device d ON f.DeviceType = d.DeviceType
JOIN {1}time t ON coalesce(f.WatchTime, '00:00:00') = t.WatchTime""",
}
_FACT_SELECT["live_stream"] = _FACT_SELECT["live"]
FACT_CRITICAL = {
    "community": ("InteractionID", "UserID_Surrogate", "CommunityID_Surrogate", "TotalTimeSpent"),
    "live": ("InteractionID", "UserID_Surrogate", "EventID_Surrogate", "LiveEngagement"),
    "video": ("InteractionID", "UserID_Surrogate", "VideoID_Surrogate", "TimeSpentOnVideo", "TotalTimeSpent"),
}
LOADED_BEFORE = {"community": "1998-01-01", "live": "2024-01-16", "video": "1998-01-01"}


def _earlier(entity: str) -> str:
    return f"IngestionTimestamp < TIMESTAMP '{LOADED_BEFORE[entity]} 00:00:00'"


def _star_chain(profile: str, source: str, prefix: str) -> str:
    return ",\n".join(f"{prefix}{n} AS ({q})" for n, q in _star(profile, source).items())


def _fact_chain(profile: str, prefix: str = "") -> str:
    p = prefix
    return (
        f"{_chain(profile, p)},\n{_star_chain(profile, f'{p}staged', f'{p}dim_')},\n"
        f"{p}fact AS ({_FACT_SELECT[profile].format(f'{p}staged', f'{p}dim_')})"
    )


def _star_select(profile: str, query: str) -> str:
    return f"WITH {_fact_chain(profile)}\n{query}"


def _all_facts(query: str) -> str:
    chains = ",\n".join(_fact_chain(e, f"{e[0]}_") for e in ("community", "live", "video"))
    return f"WITH {chains}\n{query}"


def _unified(where: dict[str, str] | None = None) -> str:
    w = {e: f" WHERE {c}" for e, c in (where or {}).items()}
    return f"""SELECT UserID_Surrogate, PlatformID, CAST(NULL AS VARCHAR) AS TimeID, CommunityEngagement AS Engagement,
  TotalTimeSpent, CAST(0 AS BIGINT) AS NumberOfSessions, IngestionTimestamp FROM c_fact{w.get('community', '')}
UNION ALL SELECT UserID_Surrogate, PlatformID, TimeID, LiveEngagement, CAST(0 AS FLOAT), CAST(0 AS BIGINT),
  IngestionTimestamp FROM l_fact{w.get('live', '')}
UNION ALL SELECT UserID_Surrogate, PlatformID, TimeID, Engagement, CAST(TotalTimeSpent AS FLOAT), NumberOfSessions,
  IngestionTimestamp FROM v_fact{w.get('video', '')}"""


def _activity(unified: str) -> str:
    return f"""SELECT md5(concat_ws('_', UserID_Surrogate, PlatformID, coalesce(TimeID, ''), ActivityDate)) AS InteractionID, *
FROM (SELECT UserID_Surrogate, PlatformID, TimeID, CAST(date_trunc('day', IngestionTimestamp) AS DATE) AS ActivityDate,
    CAST(sum(CAST(Engagement AS DOUBLE)) AS FLOAT) AS TotalEngagement,
    CAST(sum(CAST(TotalTimeSpent AS DOUBLE)) AS FLOAT) AS TotalTimeSpent,
    CAST(sum(NumberOfSessions) AS BIGINT) AS SessionCount, count(*) AS InteractionCount
  FROM ({unified}) a GROUP BY 1, 2, 3, 4) g"""


# --- per-entity queries -----------------------------------------------------


def _fill_audit(entity: str) -> str:
    keys = ", ".join(KEYS[entity])
    values = {c: f"CAST({v} AS VARCHAR)" for c, v in FILL[entity].items()} | {
        c: f"(SELECT CAST(m.{c} AS VARCHAR) FROM med m)" for c in MEDIAN[entity]
    }
    return "\nUNION ALL ".join(
        f"SELECT {keys}, '{c}' AS Field, CAST(NULL AS VARCHAR) AS OldValue, {v} AS NewValue, "
        f"'Filled null in {c}' AS Reason FROM nonnull WHERE {c} IS NULL"
        for c, v in values.items()
    )


def _change_audit(entity: str) -> str:
    keys = ", ".join(KEYS[entity])

    def branch(source: str, column: str, new: str, reason: str) -> str:
        return (
            f"SELECT {keys}, '{column}' AS Field, {column} AS OldValue, {new} AS NewValue, "
            f"'{reason} {column}' AS Reason FROM {source} WHERE {column} <> {new}"
        )

    branches = [branch("valid", c, e.format(c), "Standardized") for c, e in STANDARD[entity].items()]
    branches += [branch("latest", c, e, "Trimmed and formatted") for c, e in FORMAT[entity].items()]
    return "\nUNION ALL ".join(branches)


def _dedup(profile: str, source: str, columns: str) -> str:
    keys = (*KEYS[_entity(profile)], "IngestionTimestamp")
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)}
  ORDER BY {_order(profile, keys)}) AS rn FROM {source}) d WHERE rn = 1"""


def _entity_sql(entity: str) -> dict[str, str]:
    keys = ", ".join(KEYS[entity])
    counts = f"SELECT {keys}, count(*) AS Copies FROM valid GROUP BY {keys}"
    profile = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in COLUMNS[entity])
    critical = CRITICAL[entity]
    id_parts = f"{', '.join(KEYS[entity])}, IngestionTimestamp"
    stages = {
        "null_profile": f"SELECT {profile} FROM raw",
        "ingest_gate": _gate(INGEST_CRITICAL[entity], "raw"),
        "critical_nulls": f"SELECT *, 'Null in critical columns: {', '.join(critical)}' AS Reason FROM raw WHERE {_null(critical)}",
        "dropna": "SELECT * FROM nonnull",
        "median": "SELECT * FROM med",
        "filled": "SELECT * FROM filled",
        "fill_audit": _fill_audit(entity),
        "valid": "SELECT * FROM valid",
        "reject_reasons": "SELECT * FROM judged WHERE Reason IS NOT NULL",
        "change_audit": _change_audit(entity),
        "latest": "SELECT * FROM latest",
        "superseded": "SELECT * EXCLUDE (rn), 'Duplicate row (not most recent)' AS Reason FROM ranked WHERE rn > 1",
        "clean": "SELECT * FROM clean",
        "funnel": """SELECT (SELECT count(*) FROM raw) AS RawRows, (SELECT count(*) FROM nonnull) AS NonNullRows,
  (SELECT count(*) FROM valid) AS ValidRows, (SELECT count(*) FROM latest) AS LatestRows""",
        "duplicate_keys": f"SELECT * FROM ({counts}) c WHERE Copies > 1",
        "duplicate_census": f"""SELECT count(*) AS DuplicateKeys, CAST(coalesce(sum(Copies - 1), 0) AS BIGINT) AS SurplusRows
FROM ({counts}) c WHERE Copies > 1""",
        "top_duplicates": f"SELECT * FROM ({counts}) c ORDER BY Copies DESC, {keys} LIMIT 10",
        "dedup_exact": _dedup(entity, "valid", "* EXCLUDE (rn)"),
        "quality_gate": _gate(critical, "clean"),
    }
    sql = {f"{entity}_{name}": _select(entity, query) for name, query in stages.items()}
    sql[f"conform_{entity}"] = _select(entity, "SELECT * FROM staged")
    sql[f"interaction_id_{entity}"] = _select(
        entity, f"SELECT md5(concat_ws('_', {id_parts})) AS InteractionID, {id_parts} FROM nonnull"
    )
    sql[f"fact_{entity}"] = _star_select(entity, "SELECT * FROM fact")
    sql[f"fact_{entity}_quality"] = _star_select(entity, _gate(FACT_CRITICAL[entity], "fact"))
    earlier = f"(SELECT * FROM staged WHERE {_earlier(entity)})"
    sql[f"fact_{entity}_lookup"] = (
        f"WITH {_chain(entity)},\n{_star_chain(entity, earlier + ' y', 'dim_')}\n"
        + _FACT_SELECT[entity].format("staged", "dim_")
    )
    return sql


# --- the other queries ------------------------------------------------------


def _both(entities: str, column: str) -> str:
    return " UNION ALL ".join(f"SELECT {column} FROM ({RAW[e]}) {e}" for e in entities.split())


def _values(entities: str, column: str, new: str) -> str:
    return f"""SELECT {column} AS OldValue, {new.format(column)} AS NewValue, count(*) AS TotalRows
FROM ({_both(entities, column)}) r GROUP BY 1, 2"""


def _format_sql(profile: str) -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in FORMAT[profile].items())
    return f"SELECT {', '.join(KEYS[_entity(profile)])}, {columns} FROM ({RAW[_entity(profile)]}) r"


def _anti_sql(entity: str) -> str:
    match = " AND ".join(f"e.{k} = r.{k}" for k in KEYS[entity])
    return f"""WITH raw AS ({RAW[entity]})
SELECT * FROM raw r WHERE NOT EXISTS (SELECT 1 FROM raw e WHERE {match} AND e.{_earlier(entity)})"""


def _align_sql() -> str:
    columns = ", ".join(
        f"CASE WHEN {_earlier('video')} THEN NULL ELSE OS END AS OS" if c == "OS" else c
        for c in COLUMNS["video"] if c != "IngestionTimestamp"
    )
    return f"SELECT {columns} FROM ({RAW['video']}) r"


def _incremental(profile: str, key: str) -> str:
    """Facts of all staged rows without those of earlier rows."""
    earlier = f"(SELECT * FROM staged WHERE {_earlier(_entity(profile))}) y"
    stored = _star_chain(profile, earlier, "old_")
    old_fact = _FACT_SELECT[profile].format(f"(SELECT * FROM staged WHERE {_earlier(_entity(profile))})", "old_")
    return (
        f"WITH {_fact_chain(profile)},\n{stored},\nstored AS ({old_fact})\n"
        f"SELECT * FROM fact WHERE {key} NOT IN (SELECT {key} FROM stored)"
    )


CHANGED = {
    "community": ("CommunityEngagement", "UserID"),
    "live": ("LiveEngagement", "EventID"),
    "video": ("Engagement", "UserID"),
}


def _changed_sql(entity: str) -> str:
    measure, key = CHANGED[entity]
    same = " AND ".join(
        f"e.{c} IS NOT DISTINCT FROM r.{c}" for c in COLUMNS[entity] if c != "IngestionTimestamp"
    )
    return f"""WITH raw AS ({RAW[entity]}), again AS (
  SELECT * REPLACE (CASE WHEN {key} % 7 = 0 THEN {measure} + 1 ELSE {measure} END AS {measure}) FROM raw)
SELECT * FROM again r WHERE NOT EXISTS (SELECT 1 FROM raw e WHERE {same} AND e.{_earlier(entity)})"""


def _upsert_sql(entity: str) -> str:
    measure = CHANGED[entity][0]
    again = f"(day(IngestionTimestamp) <= 10 AND {measure} % 2 = 0)"
    return _star_select(entity, f"""SELECT * REPLACE (CAST(CASE WHEN {again} THEN {measure} + 1 ELSE {measure} END AS FLOAT) AS {measure})
FROM fact WHERE {_earlier(entity)} OR {again}""")


_ALL_PROFILES = ("community", "live", "video", "live_stream", "video_stream")


def _staged_all(profiles: tuple[str, ...], column: str, query: str) -> str:
    chains = ",\n".join(_chain(p, f"{p}_") for p in profiles)
    union = " UNION ALL ".join(f"SELECT {column} FROM {p}_staged" for p in profiles)
    return f"WITH {chains}, every AS ({union})\n{query}"


def _merged_user(order: tuple[str, ...], refresh: bool) -> str:
    """The user table after loads in this order."""
    known = {"community": _USER_COMMUNITY, "video": tuple(_USER_TYPES), "live": ()}

    def value(column: str) -> str:
        sources = [p for p in order if column in known[p]]
        if refresh:
            sources = sources[::-1]
        parts = ", ".join(f"{p}_user.{column}" for p in sources)
        return f"coalesce({parts}) AS {column}" if len(sources) > 1 else f"{parts} AS {column}"

    chains = ",\n".join(
        f"{_chain(p, f'{p}_')},\n{p}_user AS ({_star(p, f'{p}_staged')['user']})" for p in order
    )
    ids = " UNION ".join(f"SELECT UserID FROM {p}_user" for p in order)
    joins = " ".join(f"LEFT JOIN {p}_user ON {p}_user.UserID = i.UserID" for p in order)
    columns = ", ".join(value(c) for c in _USER_TYPES)
    return f"""{chains},
merged AS (SELECT md5(i.UserID) AS User_S_ID, i.UserID, {columns} FROM ({ids}) i {joins})"""


_STREAMED_VIDEO = """SELECT USERID_SURROGATE, PLATFORMID, TIMEID, ENGAGEMENTSCORE, CAST(0 AS FLOAT), CAST(0 AS BIGINT),
  INGESTIONTIMESTAMP FROM s_fact"""


def _with_streamed(query: str) -> str:
    chains = ",\n".join(
        _fact_chain(p, x) for p, x in (("community", "c_"), ("live", "l_"), ("video", "v_"), ("video_stream", "s_"))
    )
    return f"WITH {chains}\n{query}"


def _load_sql() -> dict[str, str]:
    video = _chain("video", "b_")
    stream = _chain("video_stream", "s_")
    return {
        "ingest_changed_rows": _changed_sql("live"),
        "ingest_changed_rows_community": _changed_sql("community"),
        "ingest_changed_rows_video": _changed_sql("video"),
        "ingest_indexed_rows": _changed_sql("live"),
        "ingest_indexed_rows_community": _changed_sql("community"),
        "ingest_indexed_rows_video": _changed_sql("video"),
        "dim_platform_all": _staged_all(
            _ALL_PROFILES, "Platform", _dim_plain("every", "Platform", "PlatformID") + " WHERE Platform IS NOT NULL"
        ),
        "dim_device_type_all": _staged_all(
            _ALL_PROFILES[1:], "DeviceType",
            _dim_plain("every", "DeviceType", "DeviceTypeID") + " WHERE DeviceType IS NOT NULL",
        ),
        "dim_time_all": _staged_all(_ALL_PROFILES[1:], "WatchTime", _dim_time("every")),
        "dim_user_merged": f"WITH {_merged_user(('live', 'community', 'video'), False)} SELECT * FROM merged",
        "dim_user_refreshed": f"WITH {_merged_user(('video', 'community', 'live'), True)} SELECT * FROM merged",
        "dim_video_merged": f"""WITH {video},
{stream},
b AS ({_star('video', 'b_staged')['video']}),
s AS ({_star('video_stream', 's_staged')['video_stream']})
SELECT coalesce(s.Video_S_ID, b.Video_S_ID) AS Video_S_ID, VideoID,
  coalesce(s.VideoCategory, b.VideoCategory) AS VideoCategory, b.VideoLength, b.TimeSpentCategory
FROM s FULL JOIN b USING (VideoID)""",
        "fact_live_batch_after_stream": f"""WITH {_fact_chain('live', 'b_')},
{_fact_chain('live_stream', 's_')}
SELECT * FROM b_fact UNION ALL
SELECT * FROM s_fact WHERE InteractionID NOT IN (SELECT InteractionID FROM b_fact)""",
        "fact_community_upsert": _upsert_sql("community"),
        "fact_live_upsert": _upsert_sql("live"),
        "fact_video_upsert": _upsert_sql("video"),
        "user_activity_ledger": _all_facts(_activity(_unified())),
        "user_activity_late_rows": _all_facts(_activity(_unified())),
        "activity_with_streamed_video": _with_streamed(
            _activity(f"{_unified()}\nUNION ALL {_STREAMED_VIDEO}")
        ),
        "mart_engagement_streamed": _with_streamed("""SELECT Platform, coalesce(sum(v), 0.0) AS Engagement,
  coalesce(sum(c), 0.0) AS CommunityEngagement, coalesce(sum(l), 0.0) AS LiveEngagement
FROM (SELECT Platform, CAST(Engagement AS DOUBLE) AS v, NULL::DOUBLE AS c, NULL::DOUBLE AS l
    FROM v_fact JOIN v_dim_platform USING (PlatformID)
  UNION ALL SELECT Platform, CAST(ENGAGEMENTSCORE AS DOUBLE), NULL, NULL
    FROM s_fact JOIN s_dim_platform ON s_fact.PLATFORMID = s_dim_platform.PlatformID
  UNION ALL SELECT Platform, NULL, CAST(CommunityEngagement AS DOUBLE), NULL
    FROM c_fact JOIN c_dim_platform USING (PlatformID)
  UNION ALL SELECT Platform, NULL, NULL, CAST(LiveEngagement AS DOUBLE)
    FROM l_fact JOIN l_dim_platform USING (PlatformID)) a GROUP BY Platform"""),
        "mart_demographics_merged": f"""WITH {_fact_chain('video', 'f_')},
{_merged_user(('live', 'community', 'video'), False)}
SELECT AgeGroup, Gender, sum(CAST(Engagement AS DOUBLE)) AS Engagement,
  avg(CAST(ProductivityLoss AS DOUBLE)) AS ProductivityLoss
FROM f_fact JOIN merged ON UserID_Surrogate = User_S_ID GROUP BY 1, 2""",
        "stream_stamp_census": _select(
            "live_stream", "SELECT IngestionTimestamp, count(*) AS TotalRows FROM staged GROUP BY 1"
        ),
        "stream_stamp_census_video": _select(
            "video_stream", "SELECT IngestionTimestamp, count(*) AS TotalRows FROM staged GROUP BY 1"
        ),
    }


# --- streams on event time --------------------------------------------------

_WINDOW = "epoch_us(IngestionTimestamp) // 600000000"


def _event_rows(profile: str) -> str:
    """Cleaned messages with their delivery, their window, and whether they came late."""
    entity = _entity(profile)
    age = f", {_AGE_GROUP} AS AgeGroup" if entity != "live" else ""
    return f"""WITH {_chain(profile)},
finished AS (SELECT {_replace(FORMAT[profile])}{age} FROM standard),
dealt AS (SELECT *, {_WINDOW} AS w, CAST(CASE WHEN UserID % 5 = 0 THEN 2
  WHEN {_earlier(entity)} THEN 0 ELSE 1 END AS BIGINT) AS BatchID FROM finished),
reach AS (SELECT BatchID, max(IngestionTimestamp) AS reached FROM dealt GROUP BY 1),
marks AS (SELECT BatchID, max(reached) OVER (ORDER BY BatchID) AS HighWater, max(reached) OVER (
  ORDER BY BatchID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM reach),
held AS (SELECT d.*, coalesce(IngestionTimestamp < mark - INTERVAL 10 MINUTES, FALSE) AS is_late
  FROM dealt d JOIN marks m ON d.BatchID = m.BatchID)"""


def _event_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for profile in ("live_stream", "video_stream"):
        entity, rows = _entity(profile), _event_rows(profile)
        keys = ", ".join(KEYS[entity])
        order = _order(profile, KEYS[entity]).replace("IngestionTimestamp DESC NULLS LAST", "IngestionTimestamp")
        first = f"""{rows}
SELECT * EXCLUDE (w, BatchID, is_late, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys}, w ORDER BY {order}) AS rn FROM held WHERE {{}}) r WHERE rn = 1"""
        sql[f"{profile}_settled"] = first.format("IngestionTimestamp IS NOT NULL")
        sql[f"{profile}_closed"] = first.format(
            "NOT is_late AND w < (SELECT max(epoch_us(HighWater)) // 600000000 - 1 FROM marks)"
        )
        sql[f"{profile}_late"] = f"{rows}\nSELECT * EXCLUDE (w, is_late) FROM held WHERE is_late"
        sql[f"{profile}_batches"] = f"""{rows}
SELECT h.BatchID, any_value(m.HighWater) AS HighWater, count(*) AS TotalRows,
  count(*) FILTER (WHERE is_late) AS LateRows,
  count(*) FILTER (WHERE IngestionTimestamp IS NULL) AS UntimedRows,
  count(DISTINCT ({keys}, w)) FILTER (WHERE NOT is_late) AS StagedRows
FROM held h JOIN marks m ON h.BatchID = m.BatchID GROUP BY h.BatchID"""
    del sql["video_stream_closed"], sql["video_stream_late"]  # the same code as for live
    return sql


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for entity in ("community", "live", "video"):
        sql |= _entity_sql(entity)

    sql |= {
        "std_gender": _values("community video", "Gender", _STD_GENDER),
        "std_platform": _values("community live video", "Platform", _STD_PLATFORM),
        "std_device": _values("live video", "DeviceType", _STD_DEVICE),
        "std_event_type": _values("live", "EventType", _STD_EVENT),
        "std_os": _values("video", "OS", _STD_OS),
        "std_connection": _values("video", "ConnectionType", _STD_CONNECTION),
        "std_membership": _values("community", "MembershipStatus", _STD_MEMBERSHIP),
        "std_watchtime": _values("live video", "WatchTime", _STD_CLOCK),
        "std_stream_device": _values("live video", "DeviceType", _STD_STREAM_DEVICE),
        "std_stream_event_type": _values("live", "EventType", _STD_STREAM_EVENT),
        "std_stream_connection": _values("video", "ConnectionType", _STD_STREAM_CONNECTION),
        "std_stream_category": _values("video", "VideoCategory", _STD_STREAM_CATEGORY),
        "std_stream_reason": _values("video", "WatchReason", _STD_STREAM_REASON),
        "hour_of_watchtime": _values("live video", "WatchTime", _HOUR),
        "age_group": f"""SELECT Age, {_AGE_GROUP} AS AgeGroup, count(*) AS TotalRows
FROM ({_both('community video', 'Age')}) r GROUP BY 1, 2""",
        "time_spent_category": f"""SELECT {_SPENT} AS TimeSpentCategory, count(*) AS TotalRows,
  min(TotalTimeSpent) AS Least, max(TotalTimeSpent) AS Most FROM ({RAW['video']}) r GROUP BY 1""",
    }
    for profile in PROFILES:
        sql[f"fmt_{profile}"] = _format_sql(profile)

    messages = ", ".join(c for c in COLUMNS["live"] if c != "IngestionTimestamp")
    canonical = ", ".join(c for c in COLUMNS["video"] if c != "IngestionTimestamp")
    sql |= {
        "json_decode": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "json_messages": f"SELECT {messages} FROM ({RAW['live']}) r",
        "schema_conform": f"SELECT {canonical} FROM ({RAW['video']}) r",
        "ingest_align_union": _align_sql(),
        "ingest_anti": _anti_sql("live"),
        "ingest_anti_community": _anti_sql("community"),
        "ingest_anti_video": _anti_sql("video"),
    }

    for profile in ("live_stream", "video_stream"):
        sql[f"{profile}_valid"] = _select(profile, "SELECT * FROM valid")
        sql[f"{profile}_clean"] = _select(profile, "SELECT * FROM clean")
        sql[f"conform_{profile}"] = _select(profile, "SELECT * FROM staged")
        keys = ", ".join(KEYS[_entity(profile)])
        sql[f"{profile}_ingest"] = _select(profile, f"SELECT DISTINCT {keys} FROM valid")
    sql["interaction_id_video_stream"] = _select(
        "video_stream",
        "SELECT md5(concat_ws('_', VideoID, UserID, IngestionTimestamp)) AS InteractionID, "
        "VideoID, UserID, IngestionTimestamp FROM nonnull",
    )

    def dim(profile: str, name: str) -> str:
        return _select(profile, _star(profile, "staged")[name])

    before = f"(SELECT * FROM staged WHERE {_earlier('live')}) y"
    after = f"(SELECT * FROM staged WHERE NOT ({_earlier('live')})) z"
    community_before = f"(SELECT * FROM staged WHERE {_earlier('community')}) y"
    sql |= {
        "dim_user_community": dim("community", "user"),
        "dim_user_live": dim("live", "user"),
        "dim_user_video": dim("video", "user"),
        "dim_community": dim("community", "community"),
        "dim_event": dim("live", "event"),
        "dim_video": dim("video", "video"),
        "dim_video_stream": dim("video_stream", "video_stream"),
        "dim_platform": dim("live", "platform"),
        "dim_membership_status": dim("community", "membership"),
        "dim_device_type": dim("video", "device"),
        "dim_os": dim("video", "os"),
        "dim_connection_type": dim("video", "connection"),
        "dim_watch_reason": dim("video", "reason"),
        "dim_time": dim("live", "time"),
        "dim_user_incremental": _select(
            "community",
            f"SELECT * FROM ({_star('community', 'staged')['user']}) n WHERE UserID NOT IN "
            f"(SELECT CAST(UserID AS VARCHAR) FROM {community_before})",
        ),
        "dim_platform_incremental": _select(
            "live",
            f"SELECT * FROM ({_star('live', 'staged')['platform']}) n WHERE Platform NOT IN "
            f"(SELECT Platform FROM {before} WHERE Platform < 'i')",
        ),
        "dim_event_refresh": _select(
            "live",
            f"{_star('live', after)['event']}\nUNION ALL SELECT * FROM ({_star('live', before)['event']}) o "
            f"WHERE EventID NOT IN (SELECT EventID FROM {after})",
        ),
        "fact_video_stream": _star_select("video_stream", "SELECT * FROM fact"),
        "fact_live_incremental": _incremental("live_stream", "InteractionID"),
        "fact_video_incremental": _incremental("video_stream", "INTERACTIONID"),
        "activity_unified": _all_facts(_unified()),
        "user_activity": _all_facts(_activity(_unified())),
        "user_activity_quality": _all_facts(
            _gate(("InteractionID", "UserID_Surrogate", "ActivityDate"), f"({_activity(_unified())}) x")
        ),
        "user_activity_incremental": _all_facts(
            f"SELECT * FROM ({_activity(_unified())}) x WHERE InteractionID NOT IN (SELECT InteractionID FROM "
            f"({_activity(_unified({e: _earlier(e) for e in ('community', 'live', 'video')}))}) y)"
        ),
        "mart_engagement_overview": _all_facts("""SELECT Platform, coalesce(sum(v), 0.0) AS Engagement,
  coalesce(sum(c), 0.0) AS CommunityEngagement, coalesce(sum(l), 0.0) AS LiveEngagement
FROM (SELECT Platform, CAST(Engagement AS DOUBLE) AS v, NULL::DOUBLE AS c, NULL::DOUBLE AS l
    FROM v_fact JOIN v_dim_platform USING (PlatformID)
  UNION ALL SELECT Platform, NULL, CAST(CommunityEngagement AS DOUBLE), NULL
    FROM c_fact JOIN c_dim_platform USING (PlatformID)
  UNION ALL SELECT Platform, NULL, NULL, CAST(LiveEngagement AS DOUBLE)
    FROM l_fact JOIN l_dim_platform USING (PlatformID)) a GROUP BY Platform"""),
        "mart_community_trends": _star_select("community", """SELECT CommunityName,
  sum(CAST(CommunityEngagement AS DOUBLE)) AS CommunityEngagement, sum(CAST(TotalTimeSpent AS DOUBLE)) AS TotalTimeSpent
FROM fact JOIN dim_community ON CommunityID_Surrogate = Community_S_ID GROUP BY 1"""),
        "mart_live_streaming": _star_select("live", """SELECT DeviceType,
  sum(CAST(LiveEngagement AS DOUBLE)) AS LiveEngagement, CAST(sum(StreamDuration) AS BIGINT) AS StreamDuration,
  sum(CAST(ViewerCount AS DOUBLE)) AS ViewerCount
FROM fact JOIN dim_event ON EventID_Surrogate = Event_S_ID JOIN dim_device USING (DeviceTypeID) GROUP BY 1"""),
        "mart_video_interactions": _star_select("video", """SELECT WatchReason,
  sum(CAST(Engagement AS DOUBLE)) AS Engagement, avg(CAST(ProductivityLoss AS DOUBLE)) AS ProductivityLoss,
  avg(CAST(Satisfaction AS DOUBLE)) AS Satisfaction
FROM fact JOIN dim_reason USING (WatchReasonID) GROUP BY 1"""),
        "mart_time_trends": _star_select("video", """SELECT Hour, sum(CAST(Engagement AS DOUBLE)) AS Engagement,
  CAST(sum(TotalTimeSpent) AS BIGINT) AS TotalTimeSpent, CAST(sum(NumberOfSessions) AS BIGINT) AS NumberOfSessions
FROM fact JOIN dim_time USING (TimeID) GROUP BY 1"""),
        "mart_demographics": _star_select("video", """SELECT AgeGroup, Gender,
  sum(CAST(Engagement AS DOUBLE)) AS Engagement, avg(CAST(ProductivityLoss AS DOUBLE)) AS ProductivityLoss
FROM fact JOIN dim_user ON UserID_Surrogate = User_S_ID GROUP BY 1, 2"""),
    }
    by_days = {
        "engagement": "engagement_overview", "community": "community_trends", "live": "live_streaming",
        "video": "video_interactions", "time": "time_trends", "demographics": "demographics",
    }
    sql |= {f"mart_{short}_by_days": sql[f"mart_{name}"] for short, name in by_days.items()}
    return sql | _load_sql() | _event_sql()
