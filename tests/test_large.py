"""Plans that stay narrow on large tables, and their rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyroom import operators as op
from tallyroom.catalog import queries
from tallyroom.plans import activity
from tallyroom.schemas import STAMP


@pytest.fixture
def nothing_small(spark):
    """No table counts as small enough to be broadcast by its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> int:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition")


def rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def test_new_activity_is_told_without_another_shuffle(spark, sf_dir, nothing_small):
    """Two sums, one shuffle each."""
    assert exchanges(queries()["user_activity_incremental"](spark, sf_dir)) == 2


def test_new_activity_knows_missing_time_slots(spark, nothing_small):
    ddl = f"UserID_Surrogate string, PlatformID string, TimeID string, Engagement float, TotalTimeSpent float, NumberOfSessions bigint, {STAMP} timestamp"
    data = [("u", "p", t, 1.0, 1.0, 1, None) for t in (None, None, "t", "s")]
    frame = spark.createDataFrame(data, ddl).withColumn(STAMP, F.lit("2024-01-01 05:00:00").cast("timestamp"))
    whole, stored = activity.activity_sums(frame), activity.activity_sums(frame.where("TimeID IS NULL OR TimeID = 's'"))
    fresh = activity.with_row_ids(op.anti_append(whole, stored, activity.GROUPED))
    assert [(r.TimeID, r.InteractionCount) for r in fresh.collect()] == [("t", 1)]
    named = activity.user_activity(frame)
    assert fresh.columns == named.columns and sorted(r.InteractionCount for r in named.collect()) == [1, 1, 2]


def test_stored_days_are_replaced_where_they_are(spark, tmp_path, nothing_small):
    spark.sql("SELECT id AS v, date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS d FROM range(9)").write.parquet(
        str(tmp_path / "stored")
    )
    stored = spark.read.parquet(str(tmp_path / "stored"))
    fresh = spark.sql("SELECT 99L AS v, DATE '2024-01-02' AS d")
    for days in (None, fresh.select("d").distinct()):
        after = activity.replace_days(stored, fresh, "d", days)
        assert sorted(r.v for r in after.collect()) == [0, 2, 3, 5, 6, 8, 99]
        assert "SortMergeJoin" not in after._jdf.queryExecution().executedPlan().toString()


def test_a_mart_by_days_joins_no_facts_by_shuffle(spark, sf_dir, nothing_small):
    """The one sorted join is that of the sums by user with the users."""
    plan = queries()["mart_demographics_by_days"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("SortMergeJoin") == 1


def stored_rows(spark, tmp_path):
    """Two files of more rows than an entry of marks stands for, with NULL and repeated keys."""
    frame = spark.range(0, 150_000, numPartitions=2).selectExpr(
        "CAST(id AS STRING) AS payload", "CASE WHEN id % 1000 = 0 THEN NULL ELSE id % 70000 END AS a", "id % 2 AS b"
    )
    frame.write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def test_stored_rows_are_told_apart_by_marks(spark, tmp_path, nothing_small, monkeypatch):
    new = stored_rows(spark, tmp_path)
    known = new.where("a % 3 = 0 OR a IS NULL").select("a", "b")
    expected = op.anti_ingest(new, known, ["b", "a"])
    found = op.anti_ingest_stored(new, known, ["b", "a"])
    assert found.columns == expected.columns == ["b", "a", "payload"]
    assert rows(found) == rows(expected) and found.where("a IS NULL").count() == 150
    assert exchanges(found) == 0  # of whole rows
    assert op.anti_ingest_stored(new, new, ["b", "a"]).where("a IS NOT NULL").isEmpty()
    monkeypatch.setattr("tallyroom.operators.joins.MAX_MARKS", 1)
    assert rows(op.anti_ingest_stored(new, known, ["b", "a"])) == rows(expected)


def test_ingest_query_shuffles_no_whole_row(spark, sf_dir, nothing_small):
    assert exchanges(queries()["ingest_anti_video"](spark, sf_dir)) == 0


def test_only_repeated_windows_are_ranked(spark, tmp_path, monkeypatch):
    from tallyroom.sources import materialise
    from tallyroom.streaming import events

    frame = spark.range(2000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE id % 1900 END AS a", "id AS payload",
        f"CASE WHEN id % 70 = 0 THEN NULL ELSE timestamp_seconds(id % 300 * 5) END AS {STAMP}",
    )
    stored = materialise(frame, "windows")
    expected = rows(events.first_by_window(stored, ["a"]))
    found = events.first_by_window_stored(stored, ["a"])
    assert found.columns == stored.columns and rows(found) == expected
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "LeftAnti" in plan and "LeftSemi" in plan
    monkeypatch.setattr(op, "MAX_REPEATED", 0)
    assert rows(events.first_by_window_stored(stored, ["a"])) == expected


def test_a_message_is_parsed_once(spark):
    from tallyroom import rules as R
    from tallyroom.schemas import message_schema
    from tallyroom.streaming.clean import clean_stream
    from tallyroom.streaming.decode import decode_json

    sent = spark.createDataFrame([('{"UserID": 1}',), ("no json",), ("",), (None,)], "value string")
    decoded = decode_json(sent, "value", message_schema(R.VIDEO_STREAM.ddl))
    assert Counter(r.UserID for r in decoded.collect()) == Counter([1, None])
    clean = clean_stream(decoded.withColumn(STAMP, F.lit(None).cast("timestamp")), R.VIDEO_STREAM)
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_unknown_contents_of_stored_rows_are_told_by_places(spark, tmp_path, nothing_small, monkeypatch):
    from tallyroom.sources import ContentIndex, index as index_module

    spark.range(0, 80_000, numPartitions=2).selectExpr(
        "CASE WHEN id % 100 = 0 THEN NULL ELSE CAST(id % 30000 AS STRING) END AS a", "id % 7 AS b"
    ).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    raw.where("b < 4").write.parquet(str(tmp_path / "stored"))
    index = ContentIndex(spark, str(tmp_path / "stored"), raw.schema)
    assert index.unknown_stored(raw) is raw
    index.catch_up()
    raw.where("b = 1").write.mode("append").parquet(str(tmp_path / "stored"))
    index.catch_up()  # what is indexed twice is still known
    changed = raw.withColumn("b", F.when(F.col("b") == 2, 9).otherwise(F.col("b"))).withColumn("beside", F.lit(1))
    found, expected = index.unknown_stored(changed), index.unknown(changed)
    assert exchanges(found) == 0 and found.columns == expected.columns
    assert rows(found) == rows(expected)
    assert {r.b for r in found.select("b").distinct().collect()} == {4, 5, 6, 9}
    monkeypatch.setattr(index_module, "marks_of", lambda places: None)
    assert rows(index.unknown_stored(changed)) == rows(expected)


def test_indexed_query_shuffles_no_whole_row(spark, sf_dir, nothing_small, monkeypatch):
    from tallyroom.sources import Workspace

    kept = []
    real = Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df: kept.append(exchanges(df)) or real(self, df))
    queries()["ingest_indexed_rows_video"](spark, sf_dir)
    assert kept == [0]


def test_members_of_large_dimensions_are_told_by_places(spark, sf_dir, nothing_small, monkeypatch):
    from tallyroom.plans import star
    from tallyroom.plans.layers import staging_layer

    staged, spec = staging_layer(spark, sf_dir, "video"), star.FACT_VIDEO
    earlier = staged.where(F.col("VideoID") % 5 > 0).where("UserID % 7 > 0 AND DeviceType <> 'Tablet'")
    dims = {d.table: star.build_dim(earlier, d) for d in star.STAR_DIMS["video"]}
    dims["DIM_USER"] = dims["DIM_USER"].unionByName(dims["DIM_USER"].limit(3))  # members stored twice
    expected = star.build_fact(staged, spec, dims)
    monkeypatch.setattr(star, "MANY_MEMBERS", 0)
    found = star.build_fact_stored(staged, spec, dims)
    assert found.schema == expected.schema
    assert exchanges(found) == 0 < exchanges(expected)
    assert rows(found) == rows(expected) and 0 < found.count() < staged.count()
    # A surrogate of another making is looked up and not computed.
    dims["DIM_VIDEO"] = dims["DIM_VIDEO"].withColumn("Video_S_ID", F.concat(F.lit("v"), "VideoID"))
    found = star.build_fact_stored(staged, spec, dims)
    assert rows(found) == rows(star.build_fact(staged, spec, dims))
    assert found.where("VideoID_Surrogate LIKE 'v%'").count() == found.count() > 0
    monkeypatch.setattr(star, "marks_of", lambda places: None)
    assert rows(star.build_fact_stored(staged, spec, dims)) == rows(found)


def test_shuffled_files_go_with_their_action(spark, sf_dir):
    """Registered queries leave no shuffle behind, and a frame can still be asked twice."""
    import glob
    import time

    queries()["json_decode"](spark, sf_dir)  # tunes the session
    where = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    before = {f for d in where for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    summed = spark.range(10_000).groupBy((F.col("id") % 10).alias("k")).count()
    first = rows(summed)
    for _ in range(50):
        after = {f for d in where for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
        if after <= before:
            break
        time.sleep(0.1)
    assert after <= before
    assert rows(summed) == first
