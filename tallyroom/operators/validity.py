"""Validity rules: what passes, what is rejected, and why."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.rules import Check


def passes(check: Check) -> Column:
    value = F.col(check.column)
    if check.high is None:
        return value >= check.low
    return value.between(check.low, check.high)


def is_valid(checks: Sequence[Check]) -> Column:
    return reduce(and_, [passes(c) for c in checks])


def filter_valid(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows that meet every rule; a missing value meets none."""
    return df.filter(is_valid(checks))


def reject_reason(checks: Sequence[Check]) -> Column:
    """Reason of the first rule a row breaks, NULL for a valid row."""
    return F.coalesce(
        *[F.when(~F.coalesce(passes(c), F.lit(False)), F.lit(c.reason)) for c in checks]
    )


def rejects(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The exact complement of ``filter_valid``, with ``Reason``."""
    return df.withColumn("Reason", reject_reason(checks)).filter(F.col("Reason").isNotNull())
