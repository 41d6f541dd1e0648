"""Streams on event time: the same rows however the messages were cut into batches."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_streaming import drain, message

from tallyroom import rules as R
from tallyroom.schemas import LIVE_DDL, STAMP, message_schema
from tallyroom.streaming import EventStream, clean_live_stream, first_by_window
from tallyroom.streaming.events import HIGH_WATER

START = dt.datetime(2024, 1, 1, 12)
FILES = 50


def deliver(folder, lines, at):
    """One file of (payload, seconds after the start) pairs; no seconds: a message without a time."""
    folder.mkdir(exist_ok=True)
    rows = [
        json.dumps({"value": value, "timestamp": None if s is None else str(START + dt.timedelta(seconds=s))})
        for value, s in lines
    ]
    path = folder / f"f{at:03d}.json"
    path.write_text("\n".join(rows) + "\n")
    os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))


def run(spark, folder, base, files=1):
    source = (
        spark.readStream.schema("value string, timestamp timestamp")
        .option("maxFilesPerTrigger", files).json(str(folder))
    )
    stream = EventStream(spark, str(base), R.LIVE_STREAM)
    drain(stream.start(source, trigger=None))
    return stream


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def arrivals(tmp_path_factory):
    """Messages out of order, some very late, some repeated, some without a time, one key hot."""
    chance, folder = random.Random(5), tmp_path_factory.mktemp("arrivals") / "in"
    for at in range(FILES):
        lines = []
        for _ in range(12):
            late = chance.choice([0, 0, 0, 300, 4000])
            seconds = None if chance.random() < 0.05 else at * 120 + chance.randrange(120) - late
            event = 1 if chance.random() < 0.33 else chance.randrange(2, 6)
            body = message(event, 7, ViewerCount=chance.randrange(3), LiveEngagement=chance.choice([None, 5, 5, 6]))
            lines.append((body, seconds))
        lines.append(lines[0])
        deliver(folder, lines, at)
    return folder


@pytest.mark.parametrize("batches", [1, 3, 50])
def test_same_rows_for_any_cut_into_batches(spark, tmp_path, arrivals, batches):
    stream = run(spark, arrivals, tmp_path / "base", -(-FILES // batches))
    ledger = stream.ledger().collect()
    assert len(ledger) == batches
    source = spark.read.schema("value string, timestamp timestamp").json(str(arrivals))
    parsed = F.from_json("value", message_schema(LIVE_DDL)).alias("d")
    cleaned = clean_live_stream(source.select(parsed, F.col("timestamp").alias(STAMP)).select("d.*", STAMP))

    # Brute force: whole rows, the least of a key and ten minutes.
    best = {}
    for r in cleaned.where(F.col(STAMP).isNotNull()).collect():
        key = (r.EventID, r.UserID, int((r[STAMP] - START).total_seconds() // 600))
        order = (r[STAMP], r.ViewerCount, r.LiveEngagement)
        if key not in best or order < best[key][0]:
            best[key] = (order, r)
    expected = spark.createDataFrame([r for _, r in best.values()], cleaned.schema)
    assert rows(stream.settled()) == rows(expected)

    # Every cleaned row is in the ledger once, and each late one is in the side table whole.
    total = cleaned.count()
    assert sum(r.TotalRows for r in ledger) == total
    late = stream.late()
    assert late.count() == sum(r.LateRows + r.UntimedRows for r in ledger)
    assert late.where(F.col(STAMP).isNull()).count() == cleaned.where(F.col(STAMP).isNull()).count()
    assert late.drop("BatchID").exceptAll(cleaned.select(*late.drop("BatchID").columns)).isEmpty()
    assert batches == 1 or sum(r.LateRows for r in ledger) > 0


def test_closed_rows_never_change_and_batches_replay(spark, tmp_path):
    folder, base = tmp_path / "in", tmp_path / "base"
    deliver(folder, [(message(1, 7), 0), (message(2, 7), 2400)], 0)
    stream = run(spark, folder, base)
    assert [r.EventID for r in stream.closed().collect()] == [1]
    # An earlier copy of a closed window is late, one of an open window is on time.
    deliver(folder, [(message(1, 7), -5), (message(2, 7), 2399), (message(3, 7), 9000)], 1)
    stream = run(spark, folder, base)
    assert {(r.EventID, str(r[STAMP])) for r in stream.closed().collect()} == {
        (1, "2024-01-01 12:00:00"), (2, "2024-01-01 12:40:00"), (2, "2024-01-01 12:39:59"),
    }
    assert [(r.BatchID, r.EventID) for r in stream.late().collect()] == [(1, 1)]
    assert stream.settled("2024-01-01").count() == 5 and stream.settled("2024-01-02").count() == 0

    before, counts = rows(stream.settled()), rows(stream.ledger())
    again = stream.late().drop("BatchID")
    stream.commit(again, 1)  # stored already: nothing happens
    assert rows(stream.settled()) == before and rows(stream.ledger()) == counts


def test_a_batch_without_ledger_row_does_not_exist_and_is_written_again(spark, tmp_path, monkeypatch):
    folder, base = tmp_path / "in", tmp_path / "base"
    deliver(folder, [(message(1, 7), 0)], 0)
    run(spark, folder, base)
    deliver(folder, [(message(2, 7), 60), (message(3, 7), -4000)], 1)
    whole = EventStream._folder

    def dies(self, kind, batch_id):
        if kind == "ledger" and batch_id == 1 and dies.armed:
            dies.asked += 1
            if dies.asked > 1:  # the first call asks whether the batch is stored
                raise OSError("lost")
        return whole(self, kind, batch_id)

    dies.armed, dies.asked = True, 0
    monkeypatch.setattr(EventStream, "_folder", dies)
    with pytest.raises(Exception, match="lost"):
        run(spark, folder, base)
    dies.armed = False
    stream = EventStream(spark, str(base), R.LIVE_STREAM)
    assert [r.EventID for r in stream.settled().collect()] == [1] and stream.late().isEmpty()
    stream = run(spark, folder, base)
    assert sorted(r.EventID for r in stream.settled().collect()) == [1, 2, 3]
    assert [r.EventID for r in stream.late().collect()] == [3]


def test_commands_stream_and_load_closed_windows(spark, tmp_path):
    from tallyroom.__main__ import main

    folder, base = tmp_path / "in", str(tmp_path / "base")
    sent = [(message(1, 7), 0), (message(1, 7), 5), (message(2, 8), 9000)]
    typed = [(value, START + dt.timedelta(seconds=s)) for value, s in sent]
    spark.createDataFrame(typed, "value string, timestamp timestamp").write.parquet(str(folder))
    spark.sql("DROP DATABASE IF EXISTS closed_windows CASCADE")
    spark.sql("CREATE DATABASE closed_windows")
    spark.conf.set("spark.sql.streaming.schemaInference", "true")
    main(["stream", "live_stream", "--format", "parquet", "--path", str(folder), "--staging", base,
          "--event-time", "timestamp", "--once"], spark)
    spark.conf.unset("spark.sql.streaming.schemaInference")
    for _ in range(2):
        main(["stream-star", "live_stream", "--staging", base, "--closed", "--schema", "closed_windows"], spark)
    stored = spark.read.table("closed_windows.FACT_LIVE_STREAMING_INTERACTIONS")
    assert [str(r[STAMP]) for r in stored.collect()] == ["2024-01-01 12:00:00"]


def test_empty_batch_and_no_time_at_all(spark, tmp_path):
    folder, base = tmp_path / "in", tmp_path / "base"
    deliver(folder, [("not json", 0)], 0)
    deliver(folder, [(message(1, 7), None)], 1)
    stream = run(spark, folder, base)
    assert [r[HIGH_WATER] for r in stream.ledger().collect()] == [None, None]
    assert stream.settled().isEmpty() and stream.closed().isEmpty() and stream.late().count() == 1


def test_hot_keys_are_cut_down_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("1 AS EventID", "7 AS UserID", f"timestamp_seconds(id) AS {STAMP}")
    plan = first_by_window(df, ["EventID", "UserID"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
