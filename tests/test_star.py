"""Dimensions, facts, incremental loads, and the batch jobs end to end."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom.plans import activity, jobs, star
from tallyroom.plans.layers import raw_layer, staging_layer
from tallyroom.sources import adapters, read_entity

ENTITIES = ("community", "live", "video")


def live_rows(spark, data):
    """Staged live rows from (EventID, UserID, StreamDuration, day)."""
    full = [
        (e, "livestream", u, "youtube", 5, 10, d, "desktop", "14:30:00", 3, dt.datetime(2024, 1, day))
        for e, u, d, day in data
    ]
    return spark.createDataFrame(full, S.entity_schema(S.LIVE_DDL))


def warehouse(spark, name):
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    return jobs.Warehouse(spark, name)


def table_rows(wh, table):
    return sorted(map(str, wh.read(table).collect()))


def test_one_member_per_key_with_newest_attributes(spark):
    staged = live_rows(spark, [(1, 7, 100, 1), (1, 8, 200, 2), (2, 7, 50, 1)])
    dim = star.build_dim(staged, star.DIM_EVENT)
    assert {(r.EventID, r.StreamDuration) for r in dim.collect()} == {(1, 200), (2, 50)}
    users = star.build_dim(staged, star.DIM_USER_LIVE)
    assert sorted(r.UserID for r in users.collect()) == ["7", "8"]
    assert users.columns == ["User_S_ID", "UserID", *star.USER_ATTRIBUTES]
    assert [t for _, t in users.dtypes[2:]] == list(star.USER_ATTRIBUTES.values())


def test_user_with_two_ages_is_one_member(spark):
    data = [("1", 20, "male", "18-24", dt.datetime(2024, 1, 1)), ("1", 21, "male", "18-24", dt.datetime(2024, 1, 2))]
    staged = spark.createDataFrame(data, "UserID string, Age bigint, Gender string, AgeGroup string, IngestionTimestamp timestamp")
    assert [r.Age for r in star.build_dim(staged, star.DIM_USER_COMMUNITY).collect()] == [21]


@pytest.mark.parametrize("profile", [*ENTITIES, "live_stream", "video_stream"])
def test_both_ways_to_a_fact_agree_and_keys_resolve(spark, sf_dir, profile):
    staged = staging_layer(spark, sf_dir, profile)
    if profile == "video_stream":
        staged = staged.withColumn("EngagementScore", F.col("Engagement"))
    spec = star.STAR_FACTS[profile]
    dims = {d.table: star.build_dim(staged, d) for d in star.STAR_DIMS[profile]}
    joined = star.build_fact(staged, spec, dims)
    direct = star.build_fact_complete(staged, spec)
    assert joined.schema.simpleString() == direct.schema.simpleString()
    assert joined.exceptAll(direct).isEmpty() and direct.exceptAll(joined).isEmpty()
    assert direct.select("InteractionID").distinct().count() == direct.count()
    for dim, out in spec.links:
        members = dims[dim.table].select(F.col(dim.surrogate).alias(out))
        orphans = direct.join(members, out, "left_anti")
        assert orphans.isEmpty()


def test_loading_twice_adds_nothing_and_later_rows_add_only_themselves(spark):
    wh = warehouse(spark, "star_incremental")
    a = [(1, 7, 100, 1), (2, 8, 200, 1)]
    jobs.load_star(wh, live_rows(spark, a), "live_stream", incremental=True)
    tables = ("DIM_USER", "DIM_EVENT", "DIM_PLATFORM", "DIM_TIME", star.FACT_LIVE.table)
    first = {t: table_rows(wh, t) for t in tables}
    jobs.load_star(wh, live_rows(spark, a), "live_stream", incremental=True)
    assert {t: table_rows(wh, t) for t in tables} == first
    jobs.load_star(wh, live_rows(spark, [*a, (3, 7, 300, 2)]), "live_stream", incremental=True)
    assert len(table_rows(wh, star.FACT_LIVE.table)) == 3
    assert len(table_rows(wh, "DIM_EVENT")) == 3
    assert len(table_rows(wh, "DIM_USER")) == 2
    assert set(first[star.FACT_LIVE.table]) < set(table_rows(wh, star.FACT_LIVE.table))


def test_refresh_updates_attributes_and_keeps_members(spark):
    wh = warehouse(spark, "star_refresh")
    jobs.load_star(wh, live_rows(spark, [(1, 7, 100, 1), (2, 8, 200, 1)]), "live")
    jobs.load_star(wh, live_rows(spark, [(1, 7, 999, 2)]), "live", refresh=True)
    events = {r.EventID: r.StreamDuration for r in wh.read("DIM_EVENT").collect()}
    assert events == {1: 999, 2: 200}
    assert len(table_rows(wh, star.FACT_LIVE.table)) == 3


def test_activity_groups_missing_time_and_is_repeatable(spark):
    day = dt.datetime(2024, 1, 1, 23, 59)
    community = spark.createDataFrame(
        [("u", "p", 2.0, 3.0, day), ("u", "p", 1.0, None, day)],
        "UserID_Surrogate string, PlatformID string, CommunityEngagement float, TotalTimeSpent float, IngestionTimestamp timestamp",
    )
    live = spark.createDataFrame(
        [(None, "p", "t", None, day)],
        "UserID_Surrogate string, PlatformID string, TimeID string, LiveEngagement float, IngestionTimestamp timestamp",
    )
    video = spark.createDataFrame(
        [("u", None, "t", 4.0, 5, 2, day)],
        "UserID_Surrogate string, PlatformID string, TimeID string, Engagement float, TotalTimeSpent bigint, NumberOfSessions bigint, IngestionTimestamp timestamp",
    )
    result = activity.user_activity(activity.unify_activity(community, live, video))
    got = {(r.UserID_Surrogate, r.PlatformID, r.TimeID): tuple(r)[5:] for r in result.collect()}
    assert got == {
        ("u", "p", None): (3.0, 3.0, 0, 2),
        ("UNKNOWN", "p", "t"): (0.0, 0.0, 0, 1),
        ("u", "UNKNOWN", "t"): (4.0, 5.0, 2, 1),
    }
    again = activity.user_activity(activity.unify_activity(community, live, video))
    assert result.exceptAll(again).isEmpty()


def test_ingest_is_repeatable(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    source = raw_layer(spark, sf_dir, "live").drop(S.STAMP).filter("EventID IS NOT NULL AND UserID IS NOT NULL")
    before = source.filter("EventID < 50")
    jobs.ingest([before], path, R.LIVE)
    count = read_entity(spark, path).count()
    assert count == before.count()
    profile = jobs.ingest([before], path, R.LIVE).first()
    assert read_entity(spark, path).count() == count
    assert profile.EventID == 0 and profile.IngestionTimestamp == 0
    jobs.ingest([source], path, R.LIVE)
    assert read_entity(spark, path).count() == source.count()


def test_ingest_unions_file_layouts(spark, tmp_path):
    path = str(tmp_path / "raw")
    csv = spark.sql("SELECT 1 AS UserID, 10 AS `Video ID`, 2 AS ProductivityLoss")
    js = spark.sql("SELECT 2L AS UserID, 11L AS `Video ID`, 4L AS `Productivity Loss`, 'iOS' AS OS")
    profile = jobs.ingest([csv, js], path, R.VIDEO, S.VIDEO_FILE_NAMES).first()
    assert (profile.UserID, profile.OS, profile.ProductivityLoss) == (0, 1, 0)


def test_batch_jobs_end_to_end(spark, sf_dir, tmp_path):
    wh = warehouse(spark, "end_to_end")
    for entity in ENTITIES:
        rules = R.PROFILES[entity]
        path, audits = str(tmp_path / entity), str(tmp_path / f"{entity}_audit")
        gate = jobs.clean_to_staging(adapters.RAW[entity](spark, sf_dir), rules, path, audits)
        assert gate.first().Passed is True
        from tallyroom.plans.clean import staging

        jobs.load_star(wh, staging(read_entity(spark, path), rules), entity)
        fact = wh.read(star.STAR_FACTS[entity].table)
        expected = star.build_fact_complete(staging_layer(spark, sf_dir, entity), star.STAR_FACTS[entity])
        assert fact.exceptAll(expected).isEmpty() and expected.exceptAll(fact).isEmpty()
        for name in ("critical_nulls", "rejects", "superseded", "fill_audit", "change_audit"):
            assert read_entity(spark, f"{audits}/{name}").columns
    # every user is one member, whichever entity brought them first
    users = wh.read("DIM_USER")
    assert users.count() == users.select("UserID").distinct().count()

    assert jobs.load_activity(wh).first().Passed is True
    loaded = wh.read(jobs.FACT_USER_ACTIVITY)
    size = loaded.count()
    total = sum(wh.read(star.STAR_FACTS[e].table).count() for e in ENTITIES)
    assert loaded.agg(F.sum("InteractionCount")).first()[0] == total
    assert {"IngestionTimestamp", "LoadTimestamp"} <= set(loaded.columns)
    jobs.load_activity(wh)
    spark.catalog.refreshTable(f"end_to_end.{jobs.FACT_USER_ACTIVITY}")
    assert wh.read(jobs.FACT_USER_ACTIVITY).count() == size

    jobs.load_marts(wh)
    overview = wh.read("MART_ENGAGEMENT_OVERVIEW").agg(F.sum("LiveEngagement")).first()[0]
    live = wh.read(star.FACT_LIVE.table).agg(F.sum("LiveEngagement")).first()[0]
    assert overview == live
    for mart in ("COMMUNITY_TRENDS", "LIVE_STREAMING", "VIDEO_INTERACTIONS", "TIME_TRENDS", "DEMOGRAPHICS"):
        assert not wh.read(f"MART_{mart}").isEmpty()


def test_options_stay_out_of_text(spark):
    secret = jobs.Warehouse(spark, "s", "connector", {"password": "hidden"})
    assert "hidden" not in repr(secret)
