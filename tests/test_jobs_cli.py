"""The jobs as commands, from source files to marts."""

import json
import os
import signal
import threading

import pytest
from pyspark.sql import functions as F
from test_streaming import message, put, text_stream

from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom.__main__ import FILE_NAMES, main
from tallyroom.plans.layers import raw_layer
from tallyroom.sources import read_entity
from tallyroom.streaming import run_entity_stream, run_until_stopped


def as_file(df, entity, narrow=False):
    ddl = R.PROFILES[entity].ddl
    schema = S.file_schema(ddl, FILE_NAMES[entity], narrow)
    pairs = zip(S.message_schema(ddl), schema)
    return df.select(*[F.col(c.name).cast(f.dataType).alias(f.name) for c, f in pairs])


def test_from_files_to_marts(spark, sf_dir, tmp_path, capsys):
    def path(name):
        return str(tmp_path / name)

    def run(*args):
        capsys.readouterr()
        main(list(args), spark)
        out = capsys.readouterr().out
        return json.loads(out) if out else None

    as_file(raw_layer(spark, sf_dir, "community"), "community").write.parquet(path("c.parquet"))
    as_file(raw_layer(spark, sf_dir, "live"), "live").write.json(path("l.json"))
    video = raw_layer(spark, sf_dir, "video")
    csv = as_file(video.filter("Income < 0"), "video", narrow=True)
    # the CSV writer trims text unless told not to; the padding is part of the data
    csv.write.options(
        header="true", nullValue="N/A", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path("v.csv"))
    as_file(video.filter("Income >= 0 OR Income IS NULL"), "video").write.json(path("v.json"))
    files = {
        "community": [f"parquet:{path('c.parquet')}"],
        "live": [f"json:{path('l.json')}"],
        "video": [f"csv:{path('v.csv')}", f"json:{path('v.json')}"],
    }
    spark.sql("CREATE DATABASE IF NOT EXISTS cli")
    for entity, sources in files.items():
        given = [arg for s in sources for arg in ("--file", s)]
        nulls = run("ingest", entity, *given, "--raw", path(f"raw_{entity}"))
        assert nulls["IngestionTimestamp"] == 0
        raw = read_entity(spark, path(f"raw_{entity}")).drop(S.STAMP)
        expected = raw_layer(spark, sf_dir, entity).drop(S.STAMP)
        assert raw.exceptAll(expected).isEmpty() and expected.exceptAll(raw).isEmpty()
        gate = run(
            "clean", entity, "--raw", path(f"raw_{entity}"), "--staging", path(f"staging_{entity}"),
            "--audit", path(f"audit_{entity}"),
        )
        assert gate["Passed"] is True and gate["TotalRows"] > 0
        run("star", entity, "--staging", path(f"staging_{entity}"), "--schema", "cli")
    assert run("activity", "--schema", "cli")["Passed"] is True
    run("marts", "--schema", "cli")
    assert spark.read.table("cli.MART_DEMOGRAPHICS").count() > 0


def test_stream_commands(spark, tmp_path):
    put(tmp_path / "in", "f0", [message(1, 7), message(2, 7)], 0)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    main([
        "stream", "live_stream", "--format", "text", "--path", str(tmp_path / "in"),
        "--staging", out, "--checkpoint", mark, "--once", "--option", "maxFilesPerTrigger=1",
    ], spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_stream")
    main(["stream-star", "live_stream", "--staging", out, "--schema", "cli_stream"], spark)
    assert spark.read.table("cli_stream.FACT_LIVE_STREAMING_INTERACTIONS").count() == 2
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_micro")
    for _ in range(2):
        main([
            "stream-load", "live_stream", "--staging", out, "--schema", "cli_micro",
            "--checkpoint", str(tmp_path / "loaded"), "--once",
        ], spark)
        assert spark.read.table("cli_micro.FACT_LIVE_STREAMING_INTERACTIONS").count() == 2


@pytest.mark.parametrize("number", [signal.SIGTERM, signal.SIGINT])
def test_signal_stops_a_query(spark, tmp_path, number):
    put(tmp_path / "in", "f0", [message(1, 7)], 0)
    query = run_entity_stream(
        text_stream(spark, tmp_path / "in"), R.LIVE_STREAM, str(tmp_path / "out"),
        str(tmp_path / "mark"), trigger="1 second",
    )
    query.processAllAvailable()
    threading.Timer(1.0, os.kill, (os.getpid(), number)).start()
    run_until_stopped(query)
    assert not query.isActive and query.exception() is None
