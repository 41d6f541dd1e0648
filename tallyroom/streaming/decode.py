"""JSON message payloads to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_json(
    df: DataFrame, payload: str, schema: T.StructType, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Decode a text or binary JSON column; works on batch and streaming frames.

    A missing payload gives no row.  A payload that is not JSON gives a row of
    NULLs, which the critical-column rule removes and reports; a field of the
    wrong type is NULL and the rest of its row is kept.
    """
    # Out of an array of one, the parsed row is no expression that later filters on its
    # fields are moved below; they would parse the payload again, each for itself.
    parsed = F.explode(F.array(F.from_json(F.col(payload).cast("string"), schema))).alias("data")
    rows = df.select(*keep, parsed).filter(F.col("data").isNotNull())
    return rows.select(*keep, "data.*")
