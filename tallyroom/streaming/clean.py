"""The stream profiles: the batch stages, with constants in place of medians."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom import rules as R
from tallyroom.operators import any_null
from tallyroom.plans.clean import Cleaning
from tallyroom.schemas import STAMP

DELAY = "10 minutes"


def clean_stream(messages: DataFrame, rules: R.RuleSet) -> DataFrame:
    """Critical NULLs, fills, validity, vocabularies, clocks and formats.

    All of it is stateless, so the same frame serves a stream and a batch.
    """
    if rules.medians:
        raise ValueError(f"{rules.name}: a median needs the whole table, not a stream")
    stages = Cleaning(messages, rules)
    return stages.finish(stages.standard)


def clean_live_stream(messages: DataFrame) -> DataFrame:
    return clean_stream(messages, R.LIVE_STREAM)


def clean_video_stream(messages: DataFrame) -> DataFrame:
    return clean_stream(messages, R.VIDEO_STREAM)


def dedup_stream(
    rows: DataFrame,
    keys: Iterable[str],
    stamp: str = STAMP,
    delay: str = DELAY,
    salts: int = 8,
) -> DataFrame:
    """First row of a key within the delay; its state goes once the delay has passed.

    A key is first deduplicated in up to ``salts`` shares, one per group of
    input partitions, and the few survivors again as a whole: a key that makes
    up much of a batch is worked off by several tasks.  ``salts=1`` keeps one
    step and one state.  Eviction trails the watermark by one batch, so a key
    is re-admitted only in a batch after the one that moved the watermark past
    it.
    """
    keys = list(keys)
    rows = rows.withWatermark(stamp, delay)
    if salts > 1:
        rows = (
            rows.withColumn("_salt", F.spark_partition_id() % salts)
            .dropDuplicatesWithinWatermark([*keys, "_salt"])
            .drop("_salt")
        )
    return rows.dropDuplicatesWithinWatermark(keys)


def observe_nulls(rows: DataFrame, name: str, critical: Iterable[str]) -> DataFrame:
    """Attach null counts to every micro-batch; they arrive in the query's progress."""
    critical = list(critical)
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("TotalRows"),
        *[F.count_if(F.col(c).isNull()).alias(f"Null{c}") for c in critical],
        F.count_if(any_null(critical)).alias("CriticalNullRows"),
    )
