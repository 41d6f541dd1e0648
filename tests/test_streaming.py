"""Structured Streaming over ordered files, one file per micro-batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom.plans import star
from tallyroom.plans.clean import Cleaning
from tallyroom.plans.jobs import Warehouse
from tallyroom.plans.layers import raw_layer
from tallyroom.sources import adapters, read_entity, read_staged_stream, read_stream
from tallyroom.streaming import (
    clean_live_stream,
    clean_stream,
    clean_video_stream,
    decode_json,
    dedup_stream,
    load_micro_batch,
    load_streamed,
    run_entity_stream,
    start_sink,
)

PAYLOAD = S.message_schema("a BIGINT, b STRING")


def message(event, user, **changes):
    base = {
        "EventID": event, "EventType": "LiveStream", "UserID": user, "Platform": "YouTube",
        "LiveEngagement": 5, "ViewerCount": 10, "StreamDuration": 60, "DeviceType": "Mobile",
        "WatchTime": "14:30:00", "AddictionLevel": 3,
    }
    return json.dumps({**base, **changes})


def put(folder, name, lines, at):
    """One input file; its age decides which micro-batch reads it."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))


def text_stream(spark, folder):
    return read_stream(spark, "text", path=str(folder), maxFilesPerTrigger="1")


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_decode_batch(spark):
    data = [('{"a": 1, "b": "x"}',), ("not json",), ('{"a": "wrong", "b": "y"}',), (None,)]
    df = spark.createDataFrame(data, "value string").select(F.col("value").cast("binary"))
    got = {tuple(r) for r in decode_json(df, "value", PAYLOAD).collect()}
    assert got == {(1, "x"), (None, "y"), (None, None)}


def timed(folder):
    """Keys and event times: late copy inside the delay, copy after expiry."""
    put(folder, "f0.json", ['{"k": 1, "t": "2024-01-01 00:00:00"}'], 0)
    put(folder, "f1.json", ['{"k": 2, "t": "2024-01-01 01:00:00"}'], 1)
    put(folder, "f2.json", ['{"k": 2, "t": "2024-01-01 01:05:00"}'], 2)
    put(folder, "f3.json", ['{"k": 3, "t": "2024-01-01 03:00:00"}'], 3)
    put(folder, "f4.json", ['{"k": 4, "t": "2024-01-01 03:01:00"}'], 4)
    put(folder, "f5.json", ['{"k": 2, "t": "2024-01-01 03:02:00"}'], 5)


@pytest.mark.parametrize("salts", [1, 8])
def test_duplicate_inside_delay_goes_and_after_expiry_returns(spark, tmp_path, salts):
    timed(tmp_path / "in")
    source = read_stream(
        spark, "json", "k bigint, t timestamp", str(tmp_path / "in"), maxFilesPerTrigger="1"
    ).withColumnRenamed("t", S.STAMP)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    drain(start_sink(dedup_stream(source, ["k"], salts=salts), out, mark, trigger=None))
    got = sorted((r.k, str(r[S.STAMP])) for r in read_entity(spark, out).select("k", S.STAMP).collect())
    assert got == [
        (1, "2024-01-01 00:00:00"), (2, "2024-01-01 01:00:00"), (2, "2024-01-01 03:02:00"),
        (3, "2024-01-01 03:00:00"), (4, "2024-01-01 03:01:00"),
    ]


def test_live_stream_cleans_restarts_and_loads(spark, tmp_path):
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    put(folder, "f0", [
        message(1, 7), message(1, 7, ViewerCount=99), message(2, 8, DeviceType="Smartphone"),
        message(3, 9, LiveEngagement=None), message(4, 9, StreamDuration=-1), "not json",
        message(0, 9), message(5, 9, AddictionLevel=11, WatchTime="evening", Platform=None),
    ], 0)
    put(folder, "f1", [message(1, 7), message(6, 7, EventType="Gaming")], 1)
    run = lambda: run_entity_stream(text_stream(spark, folder), R.LIVE_STREAM, out, mark, trigger=None)
    query = run()
    drain(query)

    staged = read_staged_stream(spark, out, S.entity_schema(S.LIVE_DDL))
    by_key = {(r.EventID, r.UserID): r for r in staged.collect()}
    assert sorted(by_key) == [(1, 7), (2, 8), (5, 9), (6, 7)]
    assert by_key[2, 8].DeviceType == "Unknown"
    assert by_key[5, 9].WatchTime == "00:00:00" and by_key[5, 9].Platform == "Unknown"
    assert by_key[6, 7].EventType == "Unknown" and by_key[1, 7].EventType == "Livestream"
    assert by_key[1, 7][S.STAMP] is not None

    seen = [p["observedMetrics"]["live_stream_nulls"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["TotalRows"] for m in seen) == 10
    assert sum(m["CriticalNullRows"] for m in seen) == 2

    drain(run())  # restart from the checkpoint: nothing new
    assert read_staged_stream(spark, out, S.entity_schema(S.LIVE_DDL)).count() == 4

    put(folder, "f2", [message(10, 7)], 2)
    drain(run())
    assert read_staged_stream(spark, out, S.entity_schema(S.LIVE_DDL)).count() == 5

    spark.sql("DROP DATABASE IF EXISTS streamed CASCADE")
    spark.sql("CREATE DATABASE streamed")
    warehouse = Warehouse(spark, "streamed")
    load_streamed(spark, out, warehouse, R.LIVE_STREAM)
    fact = star.FACT_LIVE.table
    assert warehouse.read(fact).count() == 5
    assert warehouse.read(fact).filter("IngestionTimestamp IS NULL").isEmpty()
    load_streamed(spark, out, warehouse, R.LIVE_STREAM)
    assert warehouse.read(fact).count() == 5


def test_video_stream_loads_per_micro_batch(spark, sf_dir, tmp_path):
    """foreachBatch into the star; a replayed batch adds nothing."""
    spark.sql("DROP DATABASE IF EXISTS streamed_video CASCADE")
    spark.sql("CREATE DATABASE streamed_video")
    warehouse = Warehouse(spark, "streamed_video")
    path = str(tmp_path / "in")
    raw_layer(spark, sf_dir, "video").write.parquet(path)
    source = read_stream(spark, "parquet", S.entity_schema(S.VIDEO_DDL), path)
    unique = dedup_stream(clean_video_stream(source), R.VIDEO_STREAM.keys)
    load = load_micro_batch(warehouse, R.VIDEO_STREAM)
    query = (
        unique.writeStream.foreachBatch(load)
        .option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
    )
    drain(query)
    fact = warehouse.read(star.FACT_VIDEO_STREAM.table)
    assert len(fact.columns) == 21 and fact.columns[0] == "INTERACTIONID"
    stages = Cleaning(raw_layer(spark, sf_dir, "video"), R.VIDEO_STREAM)
    assert fact.count() == stages.valid.select(*R.VIDEO_STREAM.keys).distinct().count()
    assert fact.filter("ENGAGEMENTSCORE IS NULL").isEmpty()
    load(stages.clean, 1)
    stored = warehouse.read(star.FACT_VIDEO_STREAM.table).count()
    load(stages.clean, 1)
    again = warehouse.read(star.FACT_VIDEO_STREAM.table)
    assert again.count() == stored == again.select("INTERACTIONID").distinct().count()


def test_stream_stages_equal_batch_run_of_the_same_function(spark, sf_dir, tmp_path):
    path = str(tmp_path / "in")
    raw = raw_layer(spark, sf_dir, "live")
    raw.write.parquet(path)
    out = str(tmp_path / "out")
    source = read_stream(spark, "parquet", S.entity_schema(S.LIVE_DDL), path, maxFilesPerTrigger="3")
    drain(start_sink(clean_live_stream(source), out, str(tmp_path / "mark"), trigger=None))
    streamed = read_entity(spark, out).select(*S.entity_schema(S.LIVE_DDL).names)
    batch = clean_live_stream(raw).select(*streamed.columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_profiles_with_medians_do_not_stream(spark, sf_dir):
    with pytest.raises(ValueError, match="median"):
        clean_stream(raw_layer(spark, sf_dir, "live"), R.LIVE)


def test_processing_time_trigger(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "f0", [message(1, 7)], 0)
    query = run_entity_stream(
        text_stream(spark, folder), R.LIVE_STREAM, str(tmp_path / "out"), str(tmp_path / "mark"),
        trigger="1 second",
    )
    try:
        query.processAllAvailable()
        assert read_entity(spark, str(tmp_path / "out")).count() == 1
        assert query.isActive
    finally:
        query.stop()


def test_kafka_options_are_passed(spark):
    """The connector jar is not here; opening the source names it and its absence."""
    with pytest.raises(Exception, match="kafka"):
        read_stream(
            spark, "kafka", subscribe="live_streaming", startingOffsets="latest",
            failOnDataLoss="false", **{"kafka.bootstrap.servers": "none:9092"},
        )


def test_time_is_stamped_per_micro_batch(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "f0", [message(1, 7)], 0)
    out = str(tmp_path / "out")
    start = dt.datetime.now() - dt.timedelta(minutes=1)
    drain(run_entity_stream(text_stream(spark, folder), R.LIVE_STREAM, out, str(tmp_path / "m"), trigger=None))
    assert read_entity(spark, out).first()[S.STAMP] > start


def test_a_batch_takes_files_up_to_its_bytes(spark, sf_dir, tmp_path, monkeypatch):
    """A table of many bytes is read in more batches, whole all the same."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "events.parquet").glob("*.parquet"))

    def batches() -> list[int]:
        seen = []
        stream = adapters.table_stream(spark, str(tmp_path), "events").writeStream
        stream = stream.foreachBatch(lambda df, _: seen.append(df.count())).trigger(availableNow=True)
        stream.option("checkpointLocation", str(tmp_path / f"checkpoint-{adapters.BYTES_PER_BATCH}")).start().awaitTermination()
        assert sum(seen) == events.count()
        return seen

    assert len(batches()) == 1
    monkeypatch.setattr(adapters, "BYTES_PER_BATCH", size * 3 // 4)
    assert len(batches()) == 2
    monkeypatch.setattr(adapters, "BYTES_PER_BATCH", 1)
    assert len(batches()) == 4
    whole = adapters.table_stream(spark, sf_dir, "events").writeStream.format("memory").queryName("one_file")
    whole.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("one_file").count() == events.count()
