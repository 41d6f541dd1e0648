"""Streaming Parquet sink."""

from __future__ import annotations

import signal
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyroom.schemas import STAMP
from tallyroom.sources.readers import INGESTION_DATE

TRIGGER = "10 seconds"


def start_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Append to snappy Parquet, partitioned by ingestion day.

    ``trigger=None`` drains what is available and stops.  Checkpoint and output
    belong together: removing one without the other breaks a restart.
    """
    dated = rows.withColumn(INGESTION_DATE, F.to_date(STAMP))
    writer = (
        dated.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .partitionBy(INGESTION_DATE)
    )
    if name:
        writer = writer.queryName(name)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for a query; on an interrupt or termination signal stop it cleanly.

    A signal only raises a flag, which is looked at once a second, so the call
    into the JVM is never cut off.  The batch in flight is not committed then,
    and a restart from the checkpoint processes it again.
    """
    asked = threading.Event()
    signals = (signal.SIGINT, signal.SIGTERM)
    previous = [signal.signal(s, lambda *_: asked.set()) for s in signals]
    try:
        while not asked.is_set() and not query.awaitTermination(1):
            pass
    finally:
        query.stop()
        for number, handler in zip(signals, previous):
            signal.signal(number, handler)
