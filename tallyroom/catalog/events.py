"""Streams on event time over whole tables, as queries.

The messages of a table come in three deliveries, each taken by a restarted run:
older rows, newer rows, and at last the rows of every fifth user, most of them
from before the watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom.catalog.loads import LOADED_BEFORE
from tallyroom.plans.layers import raw_layer
from tallyroom.sources import Workspace, adapters, write_entity
from tallyroom.streaming.events import HIGH_WATER, EventStream

Query = Callable[[SparkSession, str], DataFrame]


def delivered(raw: DataFrame, entity: str) -> list[DataFrame]:
    """The deliveries, each as messages with their own time."""
    older = F.col(S.STAMP) < F.lit(LOADED_BEFORE[entity]).cast("timestamp")
    number = F.when(F.col("UserID") % 5 == 0, 2).when(older, 0).otherwise(1)
    dealt = raw.withColumn("_delivery", number)
    messages = [dealt.where(F.col("_delivery") == n).drop("_delivery") for n in range(3)]
    return [adapters.as_timed_messages(m, R.PROFILES[f"{entity}_stream"].ddl) for m in messages]


def _run(profile: str, result: Callable[[EventStream], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        entity = profile.removesuffix("_stream")
        raw = raw_layer(spark, sf_dir, entity)
        with Workspace(spark, f"events-{profile}") as space:
            topic = f"{space.base}/steps/topic"
            stream = EventStream(spark, f"{space.base}/steps/events", R.PROFILES[profile])
            for messages in delivered(raw, entity):
                write_entity(messages, topic, "append")
                source = spark.readStream.schema(messages.schema).parquet(topic)
                stream.start(source, trigger=None).awaitTermination()
            return space.keep(result(stream))

    return query


def _counts(stream: EventStream) -> DataFrame:
    return stream.ledger().withColumn(HIGH_WATER, F.timestamp_micros(HIGH_WATER))


EVENT_QUERIES: dict[str, Query] = {
    "live_stream_settled": _run("live_stream", EventStream.settled),
    "live_stream_closed": _run("live_stream", EventStream.closed),
    "live_stream_late": _run("live_stream", EventStream.late),
    "live_stream_batches": _run("live_stream", _counts),
    "video_stream_settled": _run("video_stream", EventStream.settled),
    "video_stream_batches": _run("video_stream", _counts),
}
