"""Rule-driven DataFrame operators."""

from tallyroom.operators.dedupe import (
    MAX_REPEATED,
    dedup_exact,
    duplicate_census,
    duplicate_keys,
    latest_by_key,
    latest_by_key_apart,
    repeated_keys,
    stamp_census,
    superseded,
    top_duplicates,
)
from tallyroom.operators.joins import (
    anti_append,
    anti_content,
    anti_ingest,
    anti_ingest_stored,
    lookup,
    missing_members,
    within_range,
)
from tallyroom.operators.nulls import (
    add_typed_nulls,
    any_null,
    audit_fill,
    coalesce_default,
    critical_nulls,
    drop_null_critical,
    fill,
    fill_median,
    medians,
    null_profile,
    quality_gate,
)
from tallyroom.operators.text import audit_changes, conform_text, format_text, standardise
from tallyroom.operators.validity import filter_valid, is_valid, reject_reason, rejects

__all__ = [
    "MAX_REPEATED", "add_typed_nulls", "anti_append", "anti_content", "anti_ingest", "anti_ingest_stored", "any_null", "audit_changes",
    "audit_fill", "coalesce_default", "conform_text", "critical_nulls",
    "dedup_exact", "drop_null_critical", "duplicate_census", "duplicate_keys",
    "fill", "fill_median", "filter_valid", "format_text", "is_valid",
    "latest_by_key", "latest_by_key_apart", "lookup", "medians", "missing_members", "null_profile",
    "quality_gate", "reject_reason", "rejects", "repeated_keys", "stamp_census", "standardise", "superseded",
    "top_duplicates", "within_range",
]
