"""Column expressions: standardisation, buckets and identifiers."""

from tallyroom.functions.derive import (
    activity_date,
    age_group,
    hour_of,
    interaction_id,
    surrogate,
    time_spent_category,
)
from tallyroom.functions.standardise import (
    alias_whitelist,
    apply_map,
    lower_trim,
    map_values,
    title,
    valid_time_or_default,
    whitelist,
)

__all__ = [
    "activity_date", "age_group", "alias_whitelist", "apply_map", "hour_of",
    "interaction_id", "lower_trim", "map_values", "surrogate",
    "time_spent_category", "title", "valid_time_or_default", "whitelist",
]
