"""Streams on the messages' own time, committed batch by batch.

The stamp of a row is the time its message carries, not the time it is read, so
what a stream makes of its messages does not depend on when they arrive.  Each
micro-batch leaves three folders, named by its id:

    staged/BatchID=n   its rows on time, the earliest of a key and window
    late/BatchID=n     its rows from before the watermark, and rows without a time
    ledger/BatchID=n   one row: how many of each, and how far the time has come

The watermark of a batch is the latest time of all batches before it, less the
delay.  The ledger row is written last and is what readers go by: rows of a batch
without one do not exist yet.  A batch that is replayed after its ledger row does
nothing, one that died before it is written again.  A batch reads the ledger row
of the one before it and nothing else that is stored.

Of a key the earliest row of each window of event time counts, windows being as
long as the delay; ties go by all columns.  That choice can be made in parts and
in any order, so ``settled`` is the same however messages were cut into batches.
``closed`` leaves out windows that rows on time can still reach; it only grows.

Defined results: a message without a time is in ``late`` alone and in no window;
an empty batch leaves a ledger row of zeros.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyroom import operators as op
from tallyroom import rules as R
from tallyroom.schemas import STAMP, entity_schema, message_schema
from tallyroom.sources import Workspace, materialise
from tallyroom.sources.versions import Store
from tallyroom.streaming.clean import clean_stream, observe_nulls
from tallyroom.streaming.decode import decode_json
from tallyroom.streaming.sink import TRIGGER

DELAY_SECONDS = 600
BATCH = "BatchID"
#: Micros since the epoch: exact in any session zone.
HIGH_WATER = "HighWater"
LEDGER_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in (HIGH_WATER, "TotalRows", "LateRows", "UntimedRows", "StagedRows")]
)


def window_of(stamp: Column, seconds: int) -> Column:
    """Number of the window of event time, counted from the epoch."""
    return F.floor(F.unix_micros(stamp) / F.lit(seconds * 1_000_000))


def first_by_window(rows: DataFrame, keys: Iterable[str], seconds: int = DELAY_SECONDS) -> DataFrame:
    """The earliest row of every key in every window; rows without a time go.

    The rank has a bound of one, so each map task keeps one row of a key and
    window before the shuffle.  Applied to parts and then to what is left of
    them it gives the same rows.
    """
    keys = list(keys)
    rest = [F.col(c).asc_nulls_first() for c in rows.columns if c not in {*keys, STAMP}]
    order = Window.partitionBy(*keys, "_window").orderBy(F.col(STAMP).asc(), *rest)
    return (
        rows.where(F.col(STAMP).isNotNull())
        .withColumn("_window", window_of(F.col(STAMP), seconds))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_window", "_rank")
    )


def first_by_window_stored(rows: DataFrame, keys: Iterable[str], seconds: int = DELAY_SECONDS) -> DataFrame:
    """``first_by_window`` of stored rows, of which only those of keys and windows with several are ranked.

    Which these are is told by a pass over the keys, run once; all other rows stay
    where they are.  With more than ``MAX_REPEATED`` of them all rows are ranked.
    """
    keys = list(keys)
    timed = rows.where(F.col(STAMP).isNotNull()).withColumn("_window", window_of(F.col(STAMP), seconds))
    repeated = materialise(op.repeated_keys(timed, [*keys, "_window"]), "repeated-window")
    if repeated.count() > op.MAX_REPEATED:
        return first_by_window(rows, keys, seconds)
    hashed = timed.withColumn("_hash", F.xxhash64(*keys, "_window"))
    alone = hashed.join(repeated, "_hash", "left_anti").select(*rows.columns)
    several = hashed.join(repeated, "_hash", "left_semi").select(*rows.columns)
    return alone.unionByName(first_by_window(several, keys, seconds))


@dataclass(frozen=True)
class EventStream:
    """Where a stream on event time keeps its rows, its ledger and its checkpoint.

    All are in one folder, because none is of use without the others.
    """

    spark: SparkSession
    base: str
    rules: R.RuleSet
    delay: int = DELAY_SECONDS

    # --- writing ---

    def start(
        self, messages: DataFrame, event_time: str = "timestamp", payload: str = "value",
        trigger: str | None = TRIGGER,
    ) -> StreamingQuery:
        """JSON messages with a time column to committed batches; ``trigger=None`` drains and stops."""
        decoded = decode_json(messages, payload, message_schema(self.rules.ddl), keep=(event_time,))
        stamped = decoded.withColumn(STAMP, F.col(event_time).cast("timestamp")).drop(event_time)
        counted = observe_nulls(stamped, f"{self.rules.name}_nulls", self.rules.critical)
        writer = (
            clean_stream(counted, self.rules).writeStream.foreachBatch(self.commit)
            .option("checkpointLocation", f"{self.base}/checkpoint")
        )
        if trigger is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=trigger).start()

    def commit(self, batch: DataFrame, batch_id: int) -> None:
        """Store one batch of cleaned rows; nothing happens if it is stored already."""
        if self._committed(batch_id):
            return
        before = self._high_water(batch_id - 1) if batch_id else None
        time = F.unix_micros(F.col(STAMP))
        passed = F.lit(False) if before is None else time < F.lit(before - self.delay * 1_000_000)
        late = time.isNull() | passed
        with Workspace(self.spark, f"{self.rules.name}-batch") as space:
            rows = space.step(batch)  # the source is read once
            staged = first_by_window_stored(rows.where(~late), self.rules.keys, self.delay)
            staged.write.mode("overwrite").parquet(self._folder("staged", batch_id))
            rows.where(late).write.mode("overwrite").parquet(self._folder("late", batch_id))
            kept = self.spark.read.schema(staged.schema).parquet(self._folder("staged", batch_id))
            census = rows.agg(
                F.greatest(F.max(time), F.lit(before).cast("bigint")).alias(HIGH_WATER),
                F.count(F.lit(1)).alias("TotalRows"),
                F.count_if(passed).alias("LateRows"),
                F.count_if(time.isNull()).alias("UntimedRows"),
            )
            row = {**census.first().asDict(), "StagedRows": kept.count()}
        ledger = self.spark.range(1).select(
            *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA]
        )
        ledger.write.mode("overwrite").parquet(self._folder("ledger", batch_id))

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.base}/{kind}/{BATCH}={batch_id}"

    def _committed(self, batch_id: int) -> bool:
        return Store(self.spark).exists(f"{self._folder('ledger', batch_id)}/_SUCCESS")

    def _high_water(self, batch_id: int) -> int | None:
        stored = self.spark.read.schema(LEDGER_SCHEMA).parquet(self._folder("ledger", batch_id))
        return stored.first()[HIGH_WATER]

    # --- reading ---

    def ledger(self) -> DataFrame:
        """One row a committed batch."""
        read = self.spark.read.schema(T.StructType([*LEDGER_SCHEMA, T.StructField(BATCH, T.LongType())]))
        return read.parquet(f"{self.base}/ledger")

    def late(self) -> DataFrame:
        """Committed rows that came after the watermark had passed them, or without a time."""
        return self._committed_rows("late")

    def staged(self, since: str | None = None) -> DataFrame:
        """Committed rows on time; a key and window has one row of each batch that saw it."""
        return _from(self._committed_rows("staged"), since)

    def settled(self, since: str | None = None) -> DataFrame:
        """The earliest row of every key and window, late rows included."""
        rows = self.staged(since).unionByName(_from(self.late(), since)).drop(BATCH)
        return first_by_window_stored(rows, self.rules.keys, self.delay)

    def closed(self, since: str | None = None) -> DataFrame:
        """Rows on time of windows that only late rows can still reach.

        A row is never taken back or changed by a later batch, so a load that
        only adds may take from here; what came late is in ``late``.
        """
        limit = self.ledger().agg(F.max(HIGH_WATER)).first()[0]
        rows = self.staged(since).drop(BATCH)
        if limit is None:
            return rows.limit(0)
        open_from = limit // 1_000_000 // self.delay - 1  # ends after the watermark
        window = window_of(F.col(STAMP), self.delay)
        return first_by_window_stored(rows.where(window < F.lit(open_from)), self.rules.keys, self.delay)

    def _schema(self) -> T.StructType:
        schema = entity_schema(self.rules.ddl)
        return schema.add("AgeGroup", "string", True) if self.rules.age_group else schema

    def _committed_rows(self, kind: str) -> DataFrame:
        schema = self._schema().add(BATCH, T.LongType())
        rows = self.spark.read.schema(schema).parquet(f"{self.base}/{kind}")
        return rows.join(self.ledger().select(BATCH), BATCH, "left_semi")


def _from(rows: DataFrame, since: str | None) -> DataFrame:
    """Rows from a day on, which the statistics of the files can tell apart."""
    return rows if since is None else rows.where(F.col(STAMP) >= F.lit(since).cast("timestamp"))
