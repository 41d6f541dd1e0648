"""Loads that lose nothing: changed rows, late rows, one layout per table, merged attributes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_star import live_rows, warehouse

from tallyroom import operators as op
from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom import sources as io
from tallyroom.functions import interaction_id
from tallyroom.plans import jobs, star
from tallyroom.plans.layers import raw_layer
from tallyroom.session import tune
from tallyroom.sources import read_entity, writers


def live_messages(spark, data):
    """Raw live rows from (EventID, UserID, LiveEngagement)."""
    rows = [(e, "LiveStream", u, "YouTube", n, 10, 60, "Desktop", "14:30:00", 3) for e, u, n in data]
    return spark.createDataFrame(rows, S.message_schema(S.LIVE_DDL))


def video_rows(spark, data, **values):
    """Staged video rows from (UserID, VideoID, day); other columns by name."""
    schema = S.entity_schema(S.VIDEO_DDL).add("AgeGroup", "string")
    full = []
    for user, video, day in data:
        row = dict.fromkeys(schema.names) | values
        row |= {"UserID": user, "VideoID": video, S.STAMP: dt.datetime(2024, 1, day)}
        row |= {c: row[c] or "x" for c in ("Platform", "DeviceType", "OS", "ConnectionType", "WatchReason")}
        full.append(tuple(row[c] for c in schema.names))
    return spark.createDataFrame(full, schema)


PERSON = {"Age": 25, "Gender": "female", "AgeGroup": "25-34", "Location": "rome", "Income": 9}


def member(wh, user="1"):
    return wh.read("DIM_USER").where(F.col("UserID") == user).first().asDict()


def test_ingest_keeps_changes_and_drops_repeats(spark, tmp_path):
    path = str(tmp_path / "raw")
    jobs.ingest([live_messages(spark, [(1, 7, 5), (2, 7, 6)])], path, R.LIVE)
    jobs.ingest([live_messages(spark, [(1, 7, 999), (2, 7, 6), (3, None, 1)])], path, R.LIVE)
    jobs.ingest([live_messages(spark, [(3, None, 1)])], path, R.LIVE)
    stored = read_entity(spark, path).select("EventID", "UserID", "LiveEngagement").collect()
    assert sorted(map(str, map(tuple, stored))) == ["(1, 7, 5)", "(1, 7, 999)", "(2, 7, 6)", "(3, None, 1)"]


def test_ingest_of_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert jobs.ingest([live_messages(spark, [])], path, R.LIVE).first()["EventID"] == 0
    assert not os.path.exists(path)
    jobs.ingest([live_messages(spark, [(1, 7, 5)])], path, R.LIVE)
    files = sorted(os.listdir(path))
    jobs.ingest([live_messages(spark, [(1, 7, 5)])], path, R.LIVE)
    assert sorted(os.listdir(path)) == files


def test_ingest_gate_counts_critical_nulls(spark, tmp_path):
    path = str(tmp_path / "raw")
    jobs.ingest([live_messages(spark, [(1, 7, 5), (None, 7, 5)])], path, R.LIVE)
    gate = jobs.ingest_gate(read_entity(spark, path), "live").first()
    assert (gate.TotalRows, gate.CriticalNullRows, gate.Passed) == (2, 1, False)


@pytest.mark.parametrize("live_first", [True, False])
def test_users_are_complete_in_either_order(spark, live_first):
    wh = warehouse(spark, f"merged_{live_first}".lower())
    loads = [(live_rows(spark, [(1, 1, 100, 1)]), "live"), (video_rows(spark, [(1, 5, 1)], **PERSON), "video")]
    for staged, profile in loads if live_first else loads[::-1]:
        jobs.load_star(wh, staged, profile)
    assert PERSON.items() <= member(wh).items()
    assert wh.read("DIM_USER").count() == 1


def test_refresh_replaces_known_values_only(spark):
    wh = warehouse(spark, "refresh_known")
    jobs.load_star(wh, video_rows(spark, [(1, 5, 1)], **PERSON), "video")
    jobs.load_star(wh, live_rows(spark, [(1, 1, 100, 1)]), "live", refresh=True)
    assert PERSON.items() <= member(wh).items()
    jobs.load_star(wh, video_rows(spark, [(1, 5, 2)], **(PERSON | {"Age": 40})), "video", refresh=True)
    assert (member(wh)["Age"], member(wh)["Location"]) == (40, "rome")
    jobs.load_star(wh, video_rows(spark, [(1, 5, 3)], **(PERSON | {"Age": 50})), "video")
    assert member(wh)["Age"] == 40


@pytest.mark.parametrize("stream_first", [True, False])
def test_video_table_has_one_layout(spark, stream_first):
    wh = warehouse(spark, f"videos_{stream_first}".lower())
    batch = video_rows(spark, [(1, 5, 1)], VideoCategory="gaming", VideoLength=60, TotalTimeSpent=10)
    streamed = video_rows(spark, [(2, 6, 2), (2, 5, 2)], VideoCategory="vlog", Engagement=3)
    streamed = streamed.withColumn("EngagementScore", F.col("Engagement"))
    loads = [(streamed, "video_stream"), (batch, "video")]
    for staged, profile in loads if stream_first else loads[::-1]:
        jobs.load_star(wh, staged, profile, incremental=profile == "video_stream")
    rows = {r.VideoID: r for r in wh.read("DIM_VIDEO").collect()}
    assert (rows[5].VideoLength, rows[5].TimeSpentCategory, rows[6].VideoLength) == (60, "Short", None)
    assert rows[6].VideoCategory == "vlog"


def test_batch_load_keeps_streamed_facts(spark):
    wh = warehouse(spark, "kept_facts")
    jobs.load_star(wh, live_rows(spark, [(1, 7, 1, 1), (2, 7, 1, 1)]), "live_stream", incremental=True)
    gate = jobs.load_star(wh, live_rows(spark, [(2, 7, 1, 1), (3, 7, 1, 1)]), "live").first()
    assert wh.read(star.FACT_LIVE.table).count() == 3
    assert (gate.TotalRows, gate.Passed, gate.DuplicateKeys) == (2, True, 0)


def test_activity_counts_late_rows_and_streamed_video(spark):
    wh = warehouse(spark, "late")
    community = spark.createDataFrame(
        [(1, "a", 7, "youtube", 20, "male", 4, "admin", 30, dt.datetime(2024, 1, 1), "18-24")],
        S.entity_schema(S.COMMUNITY_DDL).add("AgeGroup", "string"),
    )
    jobs.load_star(wh, community, "community")
    jobs.load_star(wh, live_rows(spark, [(1, 7, 1, 1), (1, 7, 1, 2)]), "live")
    jobs.load_star(wh, video_rows(spark, [(7, 5, 1)], Engagement=2, TotalTimeSpent=3, NumberOfSessions=1), "video")
    jobs.load_activity(wh)

    def day(number):
        spark.catalog.refreshTable(f"late.{jobs.FACT_USER_ACTIVITY}")
        rows = wh.read(jobs.FACT_USER_ACTIVITY).where(F.dayofmonth("ActivityDate") == number)
        return rows.agg(F.sum("TotalEngagement"), F.sum("InteractionCount")).first()[:]

    before = day(1), day(2)
    jobs.load_star(wh, live_rows(spark, [(2, 7, 1, 1)]), "live_stream", incremental=True)  # engagement 5
    streamed = video_rows(spark, [(7, 6, 1)], Engagement=100).withColumn("EngagementScore", F.lit(100))
    jobs.load_star(wh, streamed, "video_stream", incremental=True)
    assert jobs.load_activity(wh, since="2024-01-02").first().Passed
    assert (day(1), day(2)) == before
    jobs.load_activity(wh)
    assert day(1) == (before[0][0] + 105, before[0][1] + 2) and day(2) == before[1]
    jobs.load_activity(wh)
    assert day(1) == (before[0][0] + 105, before[0][1] + 2)
    jobs.load_marts(wh)
    assert wh.read("MART_ENGAGEMENT_OVERVIEW").agg(F.sum("Engagement")).first()[0] == 102


def test_a_column_without_a_place_is_an_error(spark):
    warehouse(spark, "places")
    io.write_table(spark.sql("SELECT 1 AS a, 'x' AS b"), "places.t", "overwrite")
    with pytest.raises(ValueError, match="no column c"):
        io.write_table(spark.sql("SELECT 2 AS a, 3 AS c"), "places.t", "append")
    io.write_table(spark.sql("SELECT 2 AS A"), "places.t", "append")
    assert sorted(map(tuple, spark.read.table("places.t").collect())) == [(1, "x"), (2, None)]


def test_a_load_leaves_no_steps(spark):
    wh = warehouse(spark, "leftovers")

    def folders():
        base = f"{writers.shared_folder(spark)}/tallyroom"
        return {d for d in os.listdir(base) if os.path.exists(f"{base}/{d}/steps")}

    before = folders()
    for day in (1, 2):
        jobs.load_star(wh, live_rows(spark, [(1, 7, 1, day)]), "live")
    assert folders() == before


def test_a_cluster_has_to_name_its_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "local-cluster[2,1,1024]", "a"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        writers.shared_folder(Session)
    Context.master = "local[2]"
    assert writers.shared_folder(Session) == writers.shared_folder(Session)
    assert Session.conf == {}


def test_row_ids_do_not_depend_on_the_zone(spark):
    rows = spark.sql("SELECT 1 AS a, TIMESTAMP '2024-01-01 23:30:00' AS s")
    ids = rows.select(interaction_id(F.col("a"), F.col("s")))
    expected = ids.first()[0]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    tune(spark)
    assert rows.select(interaction_id(F.col("a"), F.col("s"))).first()[0] == expected


def test_median_of_any_long_range(spark):
    ends = [-(1 << 63), (1 << 63) - 1]
    wide = spark.range(20_001).select(F.xxhash64("id").alias("a"), (F.col("id") * 1_000_003).alias("b"))
    wide = wide.unionByName(spark.createDataFrame([(e, e) for e in ends], "a bigint, b bigint"))
    rows = wide.collect()

    def middle(c):
        values = sorted(r[c] for r in rows)
        return values[(len(values) + 1) // 2 - 1]

    assert op.medians(wide, {"a": 0, "b": 0}).first().asDict() == {"a": middle("a"), "b": middle("b")}


def test_stamp_census(spark):
    rows = live_rows(spark, [(1, 1, 1, 1), (2, 1, 1, 1), (3, 1, 1, 2)])
    assert sorted(r.TotalRows for r in op.stamp_census(rows).collect()) == [1, 2]


def test_layers_follow_their_input(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for name in ("nation", "customer", "part", "orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(1).write.parquet(f"{tmp_path}/{name}.parquet")
    events.limit(10).write.parquet(f"{tmp_path}/events.parquet")
    assert raw_layer(spark, str(tmp_path), "live").count() == 10
    events.limit(30).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert raw_layer(spark, str(tmp_path), "live").count() == 30
