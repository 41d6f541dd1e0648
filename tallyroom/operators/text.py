"""Value standardisation, text formats, and the audit of what they changed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions.standardise import apply_map, lower_trim, title, valid_time_or_default
from tallyroom.rules import RuleSet


def standardised(rules: RuleSet) -> dict[str, Column]:
    """New value of every column with a vocabulary or a clock format."""
    mapped = {c: apply_map(F.col(c), rule) for c, rule in rules.maps.items()}
    return mapped | {c: valid_time_or_default(F.col(c)) for c in rules.clock}


def formatted(rules: RuleSet) -> dict[str, Column]:
    """New value of every text column: trimmed, perhaps lowered, perhaps in title case."""
    texts = {c: F.trim(F.col(c)) for c in rules.trim}
    texts |= {c: lower_trim(F.col(c)) for c in rules.lower}
    return {c: title(e) if c in rules.title else e for c, e in texts.items()}


def standardise(df: DataFrame, rules: RuleSet) -> DataFrame:
    return df.withColumns(standardised(rules))


def format_text(df: DataFrame, rules: RuleSet) -> DataFrame:
    return df.withColumns(formatted(rules))


def conform_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Lower-case and trim join columns so members compare equal across sources."""
    return df.withColumns({c: lower_trim(F.col(c)) for c in columns})


def audit_changes(
    df: DataFrame, keys: Iterable[str], changes: Mapping[str, Column], reason: str
) -> DataFrame:
    """One row per changed cell: keys, field, old, new, reason.

    Old and new value sit in the same input row, so no self-join is needed and
    duplicate keys cannot be paired with each other.  ``reason`` is completed
    with the column name.
    """
    keys = list(keys)
    cells = [
        F.when(
            F.col(c) != F.col(f"{c}__new"),
            F.struct(
                F.lit(c).alias("Field"),
                F.col(c).alias("OldValue"),
                F.col(f"{c}__new").alias("NewValue"),
                F.lit(f"{reason} {c}").alias("Reason"),
            ),
        )
        for c in changes
    ]
    both = df.select(*keys, *changes, *[e.alias(f"{c}__new") for c, e in changes.items()])
    return both.select(*keys, F.inline(F.array(*cells))).filter(F.col("Field").isNotNull())
