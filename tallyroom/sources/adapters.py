"""Shape the given relational tables as raw interaction entities.

Deterministic dirt (missing keys, negative measures, padded or unknown text)
is derived from row values, so any SQL engine computes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyroom.schemas import COMMUNITY_DDL, LIVE_DDL, STAMP, VIDEO_DDL, message_schema


_FOOTERS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a given table; its footer is read once, later scans declare the schema."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _FOOTERS:
        _FOOTERS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_FOOTERS[path]).parquet(path)


def _shape(df: DataFrame, ddl: str, columns: dict[str, str]) -> DataFrame:
    names = [*message_schema(ddl).names, STAMP]
    return df.select(*[F.expr(columns[name]).alias(name) for name in names])


# The cases that turn numeric and text codes into dirty categories.
_GENDER = """CASE {0} % 8 WHEN 0 THEN 'Male' WHEN 1 THEN 'M' WHEN 2 THEN 'male'
    WHEN 3 THEN 'F' WHEN 4 THEN 'female' WHEN 5 THEN 'Non-binary' WHEN 6 THEN 'x' END"""
_WATCH_TIME = """CASE {0} % 5 WHEN 0 THEN 'Morning' WHEN 1 THEN '14:30:00'
    WHEN 2 THEN ' Evening ' WHEN 3 THEN '09:05:59' END"""

_LIVE = {
    "EventID": "k",
    "EventType": """CASE event_type WHEN 'view' THEN 'LiveStream' WHEN 'click' THEN 'Gaming'
        WHEN 'signup' THEN ' Broadcast' WHEN 'purchase' THEN 'Podcast' END""",
    "UserID": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END",
    "Platform": """CASE event_id % 7 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'TikTok'
        WHEN 2 THEN 'Instagram' WHEN 3 THEN 'Facebook' WHEN 4 THEN 'Twitch'
        WHEN 5 THEN 'youtube' END""",
    "LiveEngagement": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) - 2 END",
    "ViewerCount": "CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_id % 5000 - 25 END",
    "StreamDuration": "CASE WHEN event_id % 83 = 0 THEN NULL ELSE k * 150 - 300 END",
    "DeviceType": """CASE event_id % 6 WHEN 0 THEN 'Smartphone' WHEN 1 THEN 'Desktop'
        WHEN 2 THEN 'Tablet' WHEN 3 THEN 'Laptop' WHEN 4 THEN 'Mobile' END""",
    "WatchTime": _WATCH_TIME.format("event_id"),
    "AddictionLevel": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 13 - 1 END",
    STAMP: "CAST(ts AS TIMESTAMP)",
}

_COMMUNITY = {
    "CommunityID": "CAST(n_nationkey AS BIGINT)",
    "CommunityName": "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE concat('  ', lower(n_name), ' fans ') END",
    "UserID": "CAST(c_custkey AS BIGINT)",
    "Platform": """CASE c_custkey % 6 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'TikTok'
        WHEN 2 THEN 'Instagram' WHEN 3 THEN 'Facebook' WHEN 4 THEN 'Reddit' END""",
    "Age": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 8 + c_custkey % 97 END",
    "Gender": _GENDER.format("c_custkey"),
    "CommunityEngagement": "CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(floor(c_acctbal) AS BIGINT) END",
    "MembershipStatus": """CASE o_orderpriority WHEN '1-URGENT' THEN 'Admin'
        WHEN '2-HIGH' THEN 'Moderator' WHEN '3-MEDIUM' THEN 'Member' END""",
    "TotalTimeSpent": "CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 100) AS BIGINT) END",
    STAMP: "CAST(o_orderdate AS TIMESTAMP)",
}

_VIDEO = {
    "UserID": "CASE WHEN r % 101 = 0 THEN NULL ELSE o_custkey END",
    "Age": "CASE WHEN r % 37 = 0 THEN NULL ELSE 8 + o_custkey % 97 END",
    "Gender": _GENDER.format("o_custkey"),
    "Location": "CASE WHEN r % 41 = 0 THEN NULL ELSE concat(' ', lower(n_name)) END",
    "Income": "CASE WHEN r % 43 = 0 THEN NULL ELSE CAST(floor(c_acctbal * 10) AS BIGINT) END",
    "Debt": "CASE o_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END",
    "OwnsProperty": "CASE o_custkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END",
    "Profession": "lower(c_mktsegment)",
    "Demographics": "CASE o_custkey % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Rural' END",
    "Platform": """CASE l_partkey % 6 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'TikTok'
        WHEN 2 THEN 'Instagram' WHEN 3 THEN 'Facebook' WHEN 4 THEN 'Vimeo' END""",
    "TotalTimeSpent": "CASE WHEN r % 53 = 0 THEN NULL ELSE CAST(floor(l_extendedprice / 20) AS BIGINT) END",
    "NumberOfSessions": "CAST(l_linenumber AS BIGINT)",
    "VideoID": "CAST(l_partkey AS BIGINT)",
    "VideoCategory": """CASE p_type WHEN 'ECONOMY' THEN 'Entertainment'
        WHEN 'STANDARD' THEN 'education' WHEN 'PROMO' THEN 'Gaming' END""",
    "VideoLength": "CAST(p_size AS BIGINT) * 60",
    "Engagement": "CAST(floor(l_quantity) AS BIGINT) - 1",
    "ImportanceScore": "r % 12 - 1",
    "TimeSpentOnVideo": "CAST(floor(l_extendedprice / 40) AS BIGINT)",
    "NumberOfVideosWatched": "r % 20",
    "ScrollRate": "r % 50",
    "Frequency": "CASE r % 4 WHEN 0 THEN 'Daily' WHEN 1 THEN 'Weekly' WHEN 2 THEN 'Monthly' END",
    "ProductivityLoss": "r % 6",
    "Satisfaction": "CASE WHEN r % 59 = 0 THEN NULL ELSE r % 13 - 1 END",
    "WatchReason": "CASE l_returnflag WHEN 'A' THEN 'Entertainment' WHEN 'N' THEN 'Habit' END",
    "DeviceType": """CASE r % 7 WHEN 0 THEN 'Smartphone' WHEN 1 THEN 'Desktop'
        WHEN 2 THEN 'Tablet' WHEN 3 THEN 'Laptop' WHEN 4 THEN 'Mobile'
        WHEN 5 THEN 'Computer' END""",
    "OS": """CASE r % 6 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows'
        WHEN 3 THEN 'MacOS' WHEN 4 THEN 'Linux' END""",
    "WatchTime": _WATCH_TIME.format("r"),
    "SelfControl": "r % 11",
    "AddictionLevel": "CASE WHEN r % 61 = 0 THEN NULL ELSE r % 12 - 1 END",
    "CurrentActivity": "CASE r % 3 WHEN 0 THEN 'at work' WHEN 1 THEN 'At home' END",
    "ConnectionType": """CASE r % 6 WHEN 0 THEN 'Wi-Fi' WHEN 1 THEN 'Mobile Data'
        WHEN 2 THEN '4G' WHEN 3 THEN 'WiFi' WHEN 4 THEN 'Cellular' END""",
    STAMP: "CAST(l_shipdate AS TIMESTAMP)",
}


def shape_live(events: DataFrame) -> DataFrame:
    """Live-streaming interactions from (batch or streaming) event rows."""
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    return _shape(keyed, LIVE_DDL, _LIVE)


def live_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_live(table(spark, sf_dir, "events"))


def community_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, F.expr("o_custkey = c_custkey")).join(
        nation, F.expr("c_nationkey = n_nationkey")
    )
    return _shape(joined, COMMUNITY_DDL, _COMMUNITY)


def shape_video(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, part: DataFrame
) -> DataFrame:
    """Video interactions; ``lineitem`` may be a stream, the others are tables.

    The tables meet each other first, since orders are fewer than line items and a line
    item that crosses a shuffle has few columns then.  The few nations come after the
    customers: Spark takes a join for as large as the product of its sides, and would
    no longer see that the customers are small.
    """
    ordered = orders.join(customer, F.expr("o_custkey = c_custkey")).join(
        nation, F.expr("c_nationkey = n_nationkey")
    )
    joined = (
        lineitem.join(part, F.expr("l_partkey = p_partkey"))
        .join(ordered, F.expr("l_orderkey = o_orderkey"))
        .withColumn("r", F.expr("l_orderkey * 7 + l_linenumber"))
    )
    return _shape(joined, VIDEO_DDL, _VIDEO)


def video_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, *others = (
        table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "part")
    )
    return shape_video(lineitem, *others)


def live_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table read as a stream of JSON message bytes."""
    return as_messages(shape_live(table_stream(spark, sf_dir, "events")), LIVE_DDL)


def video_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items read as a stream, joined with tables, as JSON message bytes."""
    others = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "part"))
    return as_messages(shape_video(table_stream(spark, sf_dir, "lineitem"), *others), VIDEO_DDL)


#: Files of a table that one micro-batch takes at most, and bytes, about: what a batch
#: shuffles goes when it ends, so the bytes bound the disk that a stream takes.
FILES_PER_BATCH, BYTES_PER_BATCH = 32, 512 << 20


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream; by glob, so it may be one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path)
    files = found.getFileCount() * BYTES_PER_BATCH // max(1, found.getLength())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, min(files, FILES_PER_BATCH)))
    return reader.parquet(f"{sf_dir}/{{{name}}}.parquet")


def as_messages(rows: DataFrame, ddl: str) -> DataFrame:
    """Rows as a message source delivers them: one JSON document in bytes."""
    fields = F.struct(*message_schema(ddl).names)
    return rows.select(F.to_json(fields).cast("binary").alias("value"))


def as_timed_messages(rows: DataFrame, ddl: str) -> DataFrame:
    """The same with the time that each message carries beside its payload."""
    fields = F.struct(*message_schema(ddl).names)
    return rows.select(F.to_json(fields).cast("binary").alias("value"), F.col(STAMP).alias("timestamp"))


RAW = {"community": community_raw, "live": live_raw, "video": video_raw}
MESSAGES = {"live_stream": live_messages, "video_stream": video_messages}
