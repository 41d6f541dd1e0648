"""The cleaning stages of one entity as lazy frames.

Stage order is part of the semantics: NULLs, fills, validity, vocabularies,
newest row per key, text formats, age bands.  Vocabularies come before
trimming, so a padded value is not in its vocabulary.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom import operators as op
from tallyroom.functions import age_group
from tallyroom.operators.text import formatted, standardised
from tallyroom.rules import RuleSet
from tallyroom.schemas import STAMP
from tallyroom.sources.writers import materialise


class Cleaning:
    """Stages, rejects and audits of one raw frame under one rule set."""

    def __init__(self, raw: DataFrame, rules: RuleSet) -> None:
        self.raw = raw
        self.rules = rules

    # --- stages ---

    @cached_property
    def non_null(self) -> DataFrame:
        return op.drop_null_critical(self.raw, self.rules.critical)

    @cached_property
    def median_values(self) -> dict[str, Column]:
        """Counted once for all stages and audits, over the rows before any fill."""
        return op.nulls.median_values(self.non_null, self.rules.medians)

    @cached_property
    def filled(self) -> DataFrame:
        filled = op.fill(self.non_null, self.rules.fills)
        return op.fill_median(filled, self.rules.medians, self.median_values)

    @cached_property
    def valid(self) -> DataFrame:
        return op.filter_valid(self.filled, self.rules.checks)

    @cached_property
    def standard(self) -> DataFrame:
        return op.standardise(self.valid, self.rules)

    @cached_property
    def latest(self) -> DataFrame:
        """The newest row of every key; keys with several rows are looked for first.

        That is a pass over the keys alone, run once.  If few keys repeat, all other rows
        stay where they are; if many do, all rows are ranked.
        """
        keys = self.rules.keys
        repeated = materialise(op.repeated_keys(self.standard, keys), f"repeated-{self.rules.name}")
        if repeated.count() > op.MAX_REPEATED:
            return op.latest_by_key(self.standard, keys)
        return op.latest_by_key_apart(self.standard, keys, repeated)

    @cached_property
    def clean(self) -> DataFrame:
        return self.finish(self.latest)

    def finish(self, df: DataFrame) -> DataFrame:
        """Text formats and the age band: stateless, valid on streams too."""
        df = op.format_text(df, self.rules)
        return df.withColumn("AgeGroup", age_group(F.col("Age"))) if self.rules.age_group else df

    # --- side outputs: complete tables, a reader may limit them ---

    @cached_property
    def critical_nulls(self) -> DataFrame:
        return op.critical_nulls(self.raw, self.rules.critical)

    @cached_property
    def medians(self) -> DataFrame:
        row = [v.alias(c) for c, v in self.median_values.items()]
        return self.raw.sparkSession.range(1).select(*row)

    @cached_property
    def fill_audit(self) -> DataFrame:
        r = self.rules
        return op.audit_fill(self.non_null, r.keys, r.fills, r.medians, self.median_values)

    @cached_property
    def rejects(self) -> DataFrame:
        return op.rejects(self.filled, self.rules.checks)

    @cached_property
    def superseded(self) -> DataFrame:
        return op.superseded(self.standard, self.rules.keys)

    @cached_property
    def change_audit(self) -> DataFrame:
        """Cells changed by vocabularies (before) and by formats (after deduplication)."""
        r = self.rules
        vocabulary = op.audit_changes(self.valid, r.keys, standardised(r), "Standardized")
        latest = op.latest_by_key(self.standard, r.keys)
        formats = op.audit_changes(latest, r.keys, formatted(r), "Trimmed and formatted")
        return vocabulary.unionByName(formats)

    @cached_property
    def funnel(self) -> DataFrame:
        """Rows left after each stage: one aggregation over per-row stage flags.

        Critical NULLs and validity are flags on the unfiltered rows; the last
        stage counts distinct keys of the valid rows.
        """
        r = self.rules
        kept = ~op.any_null(r.critical)
        raw = self.raw.withColumn("_kept", kept)
        values = self.median_values
        filled = op.fill(raw, r.fills)
        if values:
            filled = filled.withColumns({c: F.coalesce(F.col(c), v) for c, v in values.items()})
        valid = F.col("_kept") & F.coalesce(op.is_valid(r.checks), F.lit(False))
        flags = filled.select(
            "_kept", valid.alias("_valid"), F.when(valid, F.struct(*r.keys)).alias("_key")
        )
        return flags.agg(
            F.count(F.lit(1)).alias("RawRows"),
            F.count_if("_kept").alias("NonNullRows"),
            F.count_if("_valid").alias("ValidRows"),
            F.count_distinct("_key").alias("LatestRows"),
        )

    @cached_property
    def quality(self) -> DataFrame:
        return op.quality_gate(self.clean, self.rules.critical)


def staging(clean: DataFrame, rules: RuleSet, unique: bool = False) -> DataFrame:
    """Cleaned rows as the star load wants them: conformed text, one row per key and stamp.

    ``unique`` says the frame comes straight from ``Cleaning`` and already holds
    one row per business key; a stored or streamed staging table may not.
    """
    conformed = op.conform_text(clean, rules.conform)
    return conformed if unique else op.dedup_exact(conformed, [*rules.keys, STAMP])
