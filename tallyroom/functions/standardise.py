"""Expressions that bring free text to a closed vocabulary or a fixed format."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroom.rules import MIDNIGHT, ValueMap


def apply_map(value: Column, rule: ValueMap) -> Column:
    """Fold aliases, keep allowed values, send the rest (NULL too) to the default.

    One flat CASE: aliases are tested before the allowed list.
    """
    branches = [(value.isin(*members), F.lit(target)) for target, members in rule.aliases.items()]
    if rule.allowed:
        branches.append((value.isin(*rule.allowed), value))
    case = F
    for condition, result in branches:
        case = case.when(condition, result)
    return case.otherwise(F.lit(rule.default)) if branches else F.lit(rule.default)


def map_values(value: Column, synonyms: Mapping[str, Iterable[str]], default: str) -> Column:
    """Replace every synonym by its standard form, anything else by ``default``."""
    return apply_map(value, ValueMap((), {k: tuple(v) for k, v in synonyms.items()}, default))


def whitelist(value: Column, allowed: Iterable[str], default: str = "Unknown") -> Column:
    """Keep values of a closed list, case-sensitively; anything else is ``default``."""
    return apply_map(value, ValueMap(tuple(allowed), {}, default))


def alias_whitelist(
    value: Column,
    aliases: Mapping[str, Iterable[str]],
    allowed: Iterable[str],
    default: str = "Unknown",
) -> Column:
    """Fold aliases first, then apply the closed list."""
    folded = {k: tuple(v) for k, v in aliases.items()}
    return apply_map(value, ValueMap(tuple(allowed), folded, default))


def valid_time_or_default(value: Column, default: str = MIDNIGHT) -> Column:
    """Keep text that reads as a time or timestamp, else ``default``.

    ``try_cast`` gives NULL for unreadable text also under ANSI mode.
    """
    return F.when(value.try_cast("timestamp").isNotNull(), value).otherwise(F.lit(default))


def lower_trim(value: Column) -> Column:
    return F.trim(F.lower(value))


def title(value: Column) -> Column:
    """Capitalise each blank-separated word and lower-case the rest."""
    return F.initcap(value)
