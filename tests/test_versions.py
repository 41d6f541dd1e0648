"""Overwrites that are all or nothing, days of facts, the ledger, and tables behind a connector."""

import datetime as dt
import threading
from types import SimpleNamespace

import fake_connector
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_loads import video_rows
from test_star import live_rows, warehouse

from tallyroom.plans import jobs, marts, star
from tallyroom.sources import Versions, write_table
from tallyroom.sources.versions import Store


class Killed(Exception):
    pass


def rows(spark, name):
    spark.catalog.refreshTable(name)
    return sorted(map(tuple, spark.read.table(name).collect()), key=str)


def frame(spark, *data):
    return spark.createDataFrame([(a, dt.date(2024, 1, d)) for a, d in data], "a int, d date")


def folders(versions):
    return [f.rpartition("/")[2] for f in versions._folders()]


# Where a load can be killed: (class, method, call before it or after it)
STEPS = [
    (Versions, "_write", "before"), (Versions, "_write", "after"),
    (Store, "write", "before"), (Store, "write", "after"),
    (Versions, "_point", "before"), (Versions, "_point", "after"),
    (Versions, "_note", "before"), (Versions, "_note", "after"),
    (Store, "rename", "before"),
]


def kill(monkeypatch, owner, name, when):
    real = getattr(owner, name)

    def step(*args, **options):
        if when == "before":
            raise Killed
        real(*args, **options)
        raise Killed

    monkeypatch.setattr(owner, name, step)


@pytest.mark.parametrize("step", range(len(STEPS)))
def test_days_killed_at_any_step(spark, monkeypatch, step):
    warehouse(spark, "killed")
    versions = Versions(spark, "killed.days")
    versions.replace_days(frame(spark, (1, 1), (2, 2)), "d", load="first")
    versions.recover()
    before = rows(spark, "killed.days")
    with monkeypatch.context() as patch:
        kill(patch, *STEPS[step])
        with pytest.raises(Killed):
            versions.replace_days(frame(spark, (20, 2), (3, 3)), "d", load="second")
    after = [(1, dt.date(2024, 1, 1)), (20, dt.date(2024, 1, 2)), (3, dt.date(2024, 1, 3))]
    assert rows(spark, "killed.days") in (before, after)  # nothing is missing or there twice
    versions.recover()
    whole = rows(spark, "killed.days")
    assert whole in (before, after)
    listed = {(r.LoadID, r.LoadedDay.day) for r in spark.read.table("killed.LOAD_LEDGER").collect()}
    assert listed == {("first", 1), ("first", 2)} | ({("second", 2), ("second", 3)} if whole == after else set())
    # The next load works, and nothing that no row is in stays behind.
    versions.replace_days(frame(spark, (30, 3)), "d", load="third")
    versions.recover()
    assert (30, dt.date(2024, 1, 3)) in rows(spark, "killed.days") and len(folders(versions)) <= 3


@pytest.mark.parametrize("step", [0, 1, 2, 3, 8])
@pytest.mark.parametrize("other", ["SELECT 2 AS a", "SELECT 2 AS a, 'x' AS b"])
def test_tables_killed_at_any_step(spark, monkeypatch, step, other):
    warehouse(spark, "killed")
    write_table(spark.sql("SELECT 1 AS a"), "killed.t", "overwrite")
    versions = Versions(spark, "killed.t")
    with monkeypatch.context() as patch:
        kill(patch, *STEPS[step])
        with pytest.raises(Killed):
            write_table(spark.sql(other), "killed.t", "overwrite")
    versions.recover()
    assert rows(spark, "killed.t") in ([(1,)], [tuple(spark.sql(other).first())])
    write_table(spark.sql("SELECT 3 AS a"), "killed.t", "overwrite")
    assert rows(spark, "killed.t") == [(3,)]
    versions.recover()
    assert len(folders(versions)) == 1


def test_a_table_that_spark_made_can_be_replaced(spark):
    warehouse(spark, "managed")
    spark.sql("SELECT 1 AS a").write.saveAsTable("managed.t")
    for value in (2, 3):
        write_table(spark.sql(f"SELECT {value} AS a"), "managed.t", "overwrite")
        assert rows(spark, "managed.t") == [(value,)]
    with pytest.raises(ValueError, match="without d"):
        Versions(spark, "managed.d").replace(spark.sql("SELECT 1 AS a, CAST(NULL AS DATE) AS d"), "d")


def failing(df):
    return df.withColumn("LiveEngagement", F.raise_error(F.lit("lost")).cast("bigint"))


@pytest.mark.parametrize("incremental", [False, True])
def test_a_failed_load_leaves_the_fact(spark, incremental):
    wh = warehouse(spark, "failed_load")
    data = [(1, 7, 1, 1), (2, 7, 1, 2), (3, 7, 1, 3)]
    jobs.load_star(wh, live_rows(spark, data), "live")
    before = rows(spark, "failed_load.FACT_LIVE_STREAMING_INTERACTIONS")
    members = rows(spark, "failed_load.DIM_EVENT")
    with pytest.raises(Exception, match="lost"):
        jobs.load_star(wh, failing(live_rows(spark, [(1, 7, 5, 1)])), "live", incremental, refresh=True)
    assert rows(spark, "failed_load.FACT_LIVE_STREAMING_INTERACTIONS") == before
    assert rows(spark, "failed_load.DIM_EVENT") == members


def test_a_failed_write_of_the_fact_leaves_it(spark, monkeypatch):
    wh = warehouse(spark, "failed_write")
    jobs.load_star(wh, live_rows(spark, [(n, 7, 1, n) for n in range(1, 6)]), "live")
    table = f"failed_write.{star.FACT_LIVE.table}"
    before = rows(spark, table)
    with monkeypatch.context() as patch:
        kill(patch, Versions, "_write", "after")
        with pytest.raises(Killed):
            jobs.load_star(wh, live_rows(spark, [(1, 7, 9, 1)]), "live")
    assert rows(spark, table) == before
    jobs.load_star(wh, live_rows(spark, [(1, 7, 9, 1), (9, 9, 9, 9)]), "live")
    assert len(rows(spark, table)) == 6


def test_an_upsert_reads_only_its_days(spark):
    wh = warehouse(spark, "pruned")
    jobs.load_star(wh, live_rows(spark, [(n, 7, 1, n) for n in range(1, 21)]), "live")
    days = [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    stored = wh.by_day(star.FACT_LIVE.table, "IngestionTimestamp", days)
    files = stored.inputFiles()
    assert len({f.split("StampDay=")[1][:10] for f in files}) == 2
    assert "PartitionFilters: [isnotnull(StampDay" in stored._jdf.queryExecution().toString() or len(files) <= 4
    untouched = {f for f in wh.by_day(star.FACT_LIVE.table, "", None).inputFiles() if "01-03" not in f}
    jobs.load_star(wh, live_rows(spark, [(3, 8, 1, 3)]), "live")
    later = set(wh.by_day(star.FACT_LIVE.table, "", None).inputFiles())
    assert untouched <= later and wh.read(star.FACT_LIVE.table).count() == 21


def test_facts_stored_before_they_had_days(spark):
    wh = warehouse(spark, "older")
    whole = star.build_fact_complete(live_rows(spark, [(1, 7, 1, 1), (2, 7, 1, 2)]), star.FACT_LIVE)
    whole.write.saveAsTable(f"older.{star.FACT_LIVE.table}")
    jobs.load_star(wh, live_rows(spark, [(5, 7, 1, 1)]), "live_stream", incremental=True)
    assert wh.read(star.FACT_LIVE.table).count() == 3
    jobs.load_star(wh, live_rows(spark, [(2, 7, 1, 2), (3, 7, 1, 2)]), "live")
    assert wh.read(star.FACT_LIVE.table).count() == 4
    assert wh.versions(star.FACT_LIVE.table).partitioned_by(star.STAMP_DAY)


def loaded(spark, name, data):
    wh = warehouse(spark, name)
    jobs.load_star(wh, live_rows(spark, data), "live")
    jobs.load_star(wh, video_rows(spark, [(7, 5, 1)], Engagement=2), "video")
    community = star.build_fact_complete(
        spark.createDataFrame(
            [], "CommunityID long, UserID long, Platform string, MembershipStatus string, "
            "CommunityEngagement long, TotalTimeSpent long, IngestionTimestamp timestamp"
        ), star.FACT_COMMUNITY,
    )
    community.write.saveAsTable(f"{name}.{star.FACT_COMMUNITY.table}")
    return wh


def per_day(wh):
    wh.spark.catalog.refreshTable(f"{wh.schema}.{jobs.FACT_USER_ACTIVITY}")
    found = wh.read(jobs.FACT_USER_ACTIVITY).groupBy("ActivityDate").agg(F.sum("InteractionCount").alias("n"))
    return {r.ActivityDate.day if r.ActivityDate.year > 1970 else 0: r.n for r in found.collect()}


def test_activity_takes_in_what_the_ledger_lists(spark):
    wh = loaded(spark, "ledgers", [(1, 7, 1, 1), (1, 7, 1, 2), (1, 7, 1, 9)])
    jobs.load_activity(wh)
    assert per_day(wh) == {1: 2, 2: 1, 9: 1}
    jobs.load_star(wh, live_rows(spark, [(2, 7, 1, 1)]), "live")  # a late day
    jobs.load_star(wh, live_rows(spark, [(3, 7, 1, 2)]), "live_stream", incremental=True)
    untouched = {f for f in wh.read(jobs.FACT_USER_ACTIVITY).inputFiles() if "01-09" in f}
    jobs.load_activity(wh)
    assert per_day(wh) == {1: 3, 2: 2, 9: 1}
    assert untouched <= set(wh.read(jobs.FACT_USER_ACTIVITY).inputFiles())
    files = set(wh.read(jobs.FACT_USER_ACTIVITY).inputFiles())
    jobs.load_activity(wh)  # nothing is pending
    assert set(wh.read(jobs.FACT_USER_ACTIVITY).inputFiles()) == files


def test_activity_killed_after_its_write_is_done_again(spark, monkeypatch):
    wh = loaded(spark, "activity_killed", [(1, 7, 1, 1)])
    jobs.load_activity(wh)
    jobs.load_star(wh, live_rows(spark, [(2, 7, 1, 1)]), "live")
    with monkeypatch.context() as patch:
        kill(patch, jobs.Warehouse, "taken_in", "before")
        with pytest.raises(Killed):
            jobs.load_activity(wh)
    jobs.load_activity(wh)
    assert per_day(wh) == {1: 3}


def test_since_means_whole_days(spark):
    wh = loaded(spark, "since_days", [(1, 7, 1, 1), (1, 7, 1, 2)])
    jobs.load_activity(wh)
    before = per_day(wh)
    jobs.load_activity(wh, since="2024-01-01 12:00:00")
    assert per_day(wh) == before
    with pytest.raises(ValueError):
        jobs.load_activity(wh, since="yesterday")


def test_rows_without_a_stamp_have_one_day(spark):
    wh = loaded(spark, "no_stamps", [(1, 7, 1, 1)])
    unstamped = live_rows(spark, [(2, 7, 1, 2)]).withColumn("IngestionTimestamp", F.lit(None).cast("timestamp"))
    unstamped = unstamped.withColumn("EventID", F.lit(2).cast("bigint"))
    for _ in range(2):
        jobs.load_star(wh, unstamped, "live")
        jobs.load_activity(wh)
    assert per_day(wh) == {0: 1, 1: 2}


def mart_tables(wh):
    names = ("ENGAGEMENT_OVERVIEW", "LIVE_STREAMING", "VIDEO_INTERACTIONS", "TIME_TRENDS", "DEMOGRAPHICS", "COMMUNITY_TRENDS")
    return {n: rows(wh.spark, f"{wh.schema}.MART_{n}") for n in names}


def test_marts_after_three_loads_are_a_full_rebuild(spark, monkeypatch):
    wh = loaded(spark, "mart_days", [(1, 7, 1, 1), (2, 8, 1, 2), (2, 7, 3, 9)])
    empty = star.build_dim(spark.createDataFrame(
        [], "CommunityID long, CommunityName string, IngestionTimestamp timestamp"), star.DIM_COMMUNITY)
    empty.write.saveAsTable("mart_days.DIM_COMMUNITY")
    jobs.load_marts(wh)
    parts = "PART_LIVE_BY_DAY"
    untouched = {f for f in wh.read(parts).inputFiles() if "01-09" in f}
    jobs.load_star(wh, live_rows(spark, [(2, 8, 1, 2), (4, 9, 1, 2)]), "live")
    streamed = video_rows(spark, [(7, 6, 2)], Engagement=100).withColumn("EngagementScore", F.lit(100))
    jobs.load_star(wh, streamed, "video_stream", incremental=True)
    asked = []
    real = jobs.Warehouse.by_day

    def seen(self, table, stamped, days, since=None):
        asked.append(days)
        return real(self, table, stamped, days, since)

    with monkeypatch.context() as patch:
        patch.setattr(jobs.Warehouse, "by_day", seen)
        jobs.load_marts(wh)
    assert asked and all(d == [dt.date(2024, 1, 2)] for d in asked)  # no other day of a fact is read
    assert untouched and untouched <= set(wh.read(parts).inputFiles())
    found = mart_tables(wh)
    facts = jobs._activity_facts(wh)
    jobs._write_marts(wh, *facts)
    assert mart_tables(wh) == found and found["LIVE_STREAMING"] and found["VIDEO_INTERACTIONS"]
    jobs.load_marts(wh)  # nothing is pending
    assert mart_tables(wh) == found


def test_a_member_stored_twice_does_not_double_sums(spark):
    fact = spark.sql("SELECT 'p' AS WatchReasonID, 1.0D AS Engagement, 1.0D AS ProductivityLoss, 1.0D AS Satisfaction")
    dim = spark.sql("SELECT 'p' AS WatchReasonID, 'habit' AS WatchReason").crossJoin(spark.range(2)).drop("id")
    assert [tuple(r) for r in marts.video_interactions(fact, dim).collect()] == [("habit", 1.0, 1.0, 1.0)]


@pytest.fixture
def behind(spark, tmp_path):
    cloudpickle.register_pickle_by_value(fake_connector)  # Spark's workers do not see this folder
    spark.dataSource.register(fake_connector.FakeWarehouse)
    return jobs.Warehouse(spark, "far", "fakehouse", {"base": str(tmp_path)})


def test_columns_go_by_name_behind_a_connector(spark, behind):
    assert not behind.exists("t")
    behind.write(spark.sql("SELECT 1 AS a, 'x' AS b, 2.0D AS c"), "t", "overwrite")
    behind.write(spark.sql("SELECT 'y' AS B, 2 AS A"), "t", "append")
    assert sorted(map(tuple, behind.read("t").collect())) == [(1, "x", 2.0), (2, "y", None)]
    behind.write(spark.sql("SELECT 5.0D AS c, 'z' AS b, 3 AS a"), "t", "overwrite")
    assert [tuple(r) for r in behind.read("t").collect()] == [(3, "z", 5.0)]
    with pytest.raises(ValueError, match="no column d"):
        behind.write(spark.sql("SELECT 1 AS d"), "t", "append")


def test_star_and_activity_behind_a_connector(spark, behind):
    jobs.load_star(behind, live_rows(spark, [(1, 7, 1, 1), (1, 7, 1, 2)]), "live")
    jobs.load_star(behind, live_rows(spark, [(1, 7, 1, 1), (4, 7, 1, 1)]), "live")
    jobs.load_star(behind, video_rows(spark, [(7, 5, 1)], Engagement=2, TotalTimeSpent=1, NumberOfSessions=1), "video")
    community = spark.createDataFrame(
        [(1, 7, "youtube", "admin", 3, 4, dt.datetime(2024, 1, 1))],
        "CommunityID long, UserID long, Platform string, MembershipStatus string, "
        "CommunityEngagement long, TotalTimeSpent long, IngestionTimestamp timestamp",
    )
    behind.write(star.build_fact_complete(community, star.FACT_COMMUNITY), star.FACT_COMMUNITY.table, "overwrite")
    streamed = video_rows(spark, [(7, 6, 2)], Engagement=100).withColumn("EngagementScore", F.lit(100))
    jobs.load_star(behind, streamed, "video_stream", incremental=True)

    def counts():
        rows = behind.read(jobs.FACT_USER_ACTIVITY).groupBy("ActivityDate").agg(
            F.sum("InteractionCount").alias("n"), F.sum("TotalEngagement").alias("e")
        )
        return {r.ActivityDate.day: (r.n, r.e) for r in rows.collect()}

    jobs.load_activity(behind)
    expected = {1: (4, 15.0), 2: (2, 105.0)}  # the streamed video counts
    assert counts() == expected
    jobs.load_activity(behind, since="2024-01-02 23:00:00")
    assert counts() == expected


def test_days_are_moved_side_by_side():
    """Moving a day waits for the catalog, so days do not wait for each other; each is moved once."""
    days, asked, together = [f"2024-01-{d:02d}" for d in range(1, 9)], [], threading.Barrier(2, timeout=20)

    class Catalog:
        def sql(self, text):
            if text.startswith("SHOW"):
                return SimpleNamespace(collect=lambda: [(f"Day={d}",) for d in days])
            together.wait()
            asked.append(text)

    versions = object.__new__(Versions)
    versions.spark, versions.name = Catalog(), "s.t"
    versions._point("Day", days, "/new")
    assert sorted(asked) == [
        f"ALTER TABLE s.t PARTITION (`Day` = DATE '{d}') SET LOCATION '/new/Day={d}'" for d in days
    ]


def test_a_day_that_cannot_be_moved_is_an_error():
    class Catalog:
        def sql(self, text):
            if text.startswith("SHOW"):
                return SimpleNamespace(collect=lambda: [("Day=2024-01-01",), ("Day=2024-01-02",)])
            if "2024-01-02" in text:
                raise OSError("no catalog")

    versions = object.__new__(Versions)
    versions.spark, versions.name = Catalog(), "s.t"
    with pytest.raises(OSError, match="no catalog"):
        versions._point("Day", ["2024-01-01", "2024-01-02"], "/new")


def test_an_upsert_shuffles_stored_ids_and_no_stored_row(spark, monkeypatch):
    wh = warehouse(spark, "upsert_narrow")
    jobs.load_star(wh, live_rows(spark, [(1, 7, 100, 1), (2, 8, 200, 1), (3, 9, 300, 2)]), "live")
    name, plans = star.FACT_LIVE.table, []
    day, spec = star.STAMP_DAY, wh._name(star.FACT_LIVE.table)
    monkeypatch.setattr(
        Versions, "replace_days",
        lambda self, df, *a, real=Versions.replace_days, **b: plans.append(
            df._jdf.queryExecution().executedPlan().toString()
        ) or real(self, df, *a, **b),
    )
    stored = spark.read.table(spec)
    again = stored.where(F.col(day) == stored.agg(F.min(day)).first()[0]).limit(1)
    again = spark.createDataFrame(again.withColumn("LiveEngagement", F.lit(99.0).cast("float")).collect(), stored.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh.upsert(again, name, "InteractionID", "IngestionTimestamp")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The one shuffle is that which deals rows out to their days.
    assert plans[0].count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plans[0]
    after = rows(spark, spec)
    assert len(after) == 3 and sum(99.0 in r for r in after) == 1


def test_versions_are_packed(spark):
    warehouse(spark, "packed")
    versions = Versions(spark, "packed.T")
    versions.replace(frame(spark, (1, 1)), "d")
    assert all(f.endswith(".zstd.parquet") for f in spark.read.table("packed.T").inputFiles())
