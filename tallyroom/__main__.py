"""Run one job: ``python -m tallyroom <job> ...`` or through ``spark-submit``.

Storage credentials and connector packages belong to the session's own
configuration (``spark-defaults.conf`` or ``--conf``); nothing is logged here.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom.plans import jobs
from tallyroom.plans.clean import staging
from tallyroom.session import tune
from tallyroom.sources import conform_schema, read_entity, read_stream
from tallyroom.streaming import (
    EventStream,
    load_closed,
    load_micro_batch,
    load_streamed,
    run_entity_stream,
    run_until_stopped,
)
from tallyroom.streaming.jobs import staged_schema

FILE_NAMES = {
    "community": S.COMMUNITY_FILE_NAMES,
    "live": S.LIVE_FILE_NAMES,
    "video": S.VIDEO_FILE_NAMES,
}
READ_OPTIONS = {
    "parquet": {},
    "json": {"mode": "PERMISSIVE"},
    "csv": {"header": "true", "nullValue": "N/A"},
}
BATCH = ("community", "live", "video")
STREAM = ("live_stream", "video_stream")


def _source(spark: SparkSession, entity: str, spec: str) -> DataFrame:
    """One source file given as ``format:path``."""
    fmt, path = spec.split(":", 1)
    ddl, names = R.PROFILES[entity].ddl, FILE_NAMES[entity]
    schema = S.file_schema(ddl, names, narrow_ints=fmt == "csv")
    return read_entity(spark, path, fmt, schema, **READ_OPTIONS[fmt])


def _warehouse(spark: SparkSession, args: argparse.Namespace) -> jobs.Warehouse:
    return jobs.Warehouse(spark, args.schema, args.connector, dict(args.option))


def _ingest(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    files = [_source(spark, args.entity, f) for f in args.file]
    return jobs.ingest(files, args.raw, R.PROFILES[args.entity], FILE_NAMES[args.entity])


def _clean(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    rules = R.PROFILES[args.entity]
    raw = conform_schema(
        read_entity(spark, args.raw), S.entity_schema(rules.ddl), FILE_NAMES[args.entity]
    )
    return jobs.clean_to_staging(raw, rules, args.staging, args.audit)


def _star(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    staged = staging(read_entity(spark, args.staging), R.PROFILES[args.entity])
    return jobs.load_star(_warehouse(spark, args), staged, args.entity, refresh=args.refresh)


def _activity(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return jobs.load_activity(_warehouse(spark, args), args.since)


def _marts(spark: SparkSession, args: argparse.Namespace) -> None:
    jobs.load_marts(_warehouse(spark, args))


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = read_stream(spark, args.format, path=args.path, **dict(args.option))
    trigger = None if args.once else args.trigger
    rules = R.PROFILES[args.profile]
    if args.event_time:
        query = EventStream(spark, args.staging, rules).start(messages, args.event_time, trigger=trigger)
    elif args.checkpoint:
        query = run_entity_stream(messages, rules, args.staging, args.checkpoint, trigger=trigger)
    else:
        raise SystemExit("stream: give --checkpoint, or --event-time, which keeps its own")
    run_until_stopped(query)


def _stream_load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Staged stream files into the star, micro-batch by micro-batch."""
    rules = R.PROFILES[args.profile]
    staged = spark.readStream.schema(staged_schema(rules)).parquet(args.staging)
    writer = staged.writeStream.foreachBatch(load_micro_batch(_warehouse(spark, args), rules))
    writer = writer.option("checkpointLocation", args.checkpoint)
    if args.once:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=args.trigger)
    run_until_stopped(writer.start())


def _stream_star(spark: SparkSession, args: argparse.Namespace) -> None:
    rules = R.PROFILES[args.profile]
    load = load_closed if args.closed else load_streamed
    load(spark, args.staging, _warehouse(spark, args), rules, args.since)


def parser() -> argparse.ArgumentParser:
    def option(text: str) -> tuple[str, str]:
        key, value = text.split("=", 1)
        return key, value

    def day(text: str) -> str:
        return dt.date.fromisoformat(text[:10]).isoformat()

    root = argparse.ArgumentParser(prog="tallyroom")
    job = root.add_subparsers(dest="job", required=True)

    def add(name: str, run) -> argparse.ArgumentParser:
        sub = job.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--option", type=option, action="append", default=[], metavar="KEY=VALUE")
        return sub

    def add_warehouse(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--schema", default="default")
        sub.add_argument("--connector", help="connector format; the session catalog if absent")

    sub = add("ingest", _ingest)
    sub.add_argument("entity", choices=BATCH)
    sub.add_argument("--file", action="append", required=True, metavar="FORMAT:PATH")
    sub.add_argument("--raw", required=True)

    sub = add("clean", _clean)
    sub.add_argument("entity", choices=BATCH)
    sub.add_argument("--raw", required=True)
    sub.add_argument("--staging", required=True)
    sub.add_argument("--audit")

    sub = add("star", _star)
    sub.add_argument("entity", choices=BATCH)
    sub.add_argument("--staging", required=True)
    sub.add_argument("--refresh", action="store_true")
    add_warehouse(sub)

    sub = add("activity", _activity)
    sub.add_argument(
        "--since", type=day, help="first day to compute again; the days of new loads if absent"
    )
    add_warehouse(sub)
    add_warehouse(add("marts", _marts))

    sub = add("stream", _stream)
    sub.add_argument("profile", choices=STREAM)
    sub.add_argument("--format", default="kafka")
    sub.add_argument("--path")
    sub.add_argument("--staging", required=True)
    sub.add_argument("--checkpoint")
    sub.add_argument("--event-time", metavar="COLUMN", help="the messages' own time, as timestamp of a Kafka source")
    sub.add_argument("--trigger", default="10 seconds")
    sub.add_argument("--once", action="store_true", help="drain what is available and stop")

    sub = add("stream-load", _stream_load)
    sub.add_argument("profile", choices=STREAM)
    sub.add_argument("--staging", required=True)
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--trigger", default="10 seconds")
    sub.add_argument("--once", action="store_true", help="load what is staged and stop")
    add_warehouse(sub)

    sub = add("stream-star", _stream_star)
    sub.add_argument("profile", choices=STREAM)
    sub.add_argument("--staging", required=True)
    sub.add_argument("--since", help="first ingestion day to load")
    sub.add_argument("--closed", action="store_true", help="closed windows of a stream on event time")
    add_warehouse(sub)
    return root


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName(f"tallyroom {args.job}").getOrCreate()
    report = args.run(tune(session), args)
    if report is not None:
        print(json.dumps(report.first().asDict(), default=str))
    if spark is None:
        session.stop()


if __name__ == "__main__":
    main()
