"""Null profiling, null rejects, constant and median fills, quality gates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: Iterable[str]) -> Column:
    """True where at least one of the columns is NULL."""
    return reduce(or_, [F.col(c).isNull() for c in columns])


def null_profile(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs of every column, in a single pass."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def critical_nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Every row that misses a critical column, with the reason."""
    columns = list(columns)
    reason = f"Null in critical columns: {', '.join(columns)}"
    return df.filter(any_null(columns)).withColumn("Reason", F.lit(reason))


def drop_null_critical(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows that have every critical column; written as IS NOT NULL, which a scan can apply."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def add_typed_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Placeholders for attributes a source does not have."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})


def coalesce_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def fill(df: DataFrame, values: Mapping[str, str | int | bool]) -> DataFrame:
    """Constant per column in place of NULL."""
    return df.na.fill(dict(values))


#: Bins of one counting pass; a pass narrows a median to one of them.
MEDIAN_BINS = 4096


def median_numbers(df: DataFrame, defaults: Mapping[str, int]) -> dict[str, int]:
    """Lower median of each integer column; a NULL or zero median gives the default.

    Exact, by counting: the range of a column is cut into equal bins, rows are
    counted per bin (combined before the shuffle), and the bin in which the count
    reaches half of the rows is cut again until it is one value wide.  A 64-bit
    range takes six passes at most, a usual one two, all columns together; no
    task and not the driver ever holds more than ``MEDIAN_BINS`` counts a column.
    """
    ends = df.agg(
        *[
            f(c).alias(f"{i}_{n}")
            for i, c in enumerate(defaults)
            for n, f in (("low", F.min), ("high", F.max), ("rows", F.count))
        ]
    ).first()
    names = list(defaults)
    bounds = {
        i: (ends[f"{i}_low"], ends[f"{i}_high"], (ends[f"{i}_rows"] + 1) // 2)
        for i in range(len(names))
        if ends[f"{i}_rows"]
    }
    found: dict[str, int] = {}
    while bounds:
        cells = []
        for i, (low, high, _) in bounds.items():
            width = (high - low) // MEDIAN_BINS + 1
            kind = "decimal(38,0)" if high - low >= 1 << 62 else "bigint"  # of differences
            place = F.expr(
                f"(CAST(`{names[i]}` AS {kind}) - CAST('{low}' AS {kind})) div CAST('{width}' AS {kind})"
            )
            inside = F.col(names[i]).between(low, high)
            cells.append(F.struct(F.lit(i).alias("i"), F.when(inside, place).alias("bin")))
        counted = (
            df.select(F.inline(F.array(*cells)))
            .where("bin IS NOT NULL")
            .groupBy("i", "bin")
            .count()
            .collect()
        )
        narrowed = {}
        for i, (low, high, half) in bounds.items():
            width = (high - low) // MEDIAN_BINS + 1
            for place, rows in sorted((r["bin"], r["count"]) for r in counted if r["i"] == i):
                if rows >= half:
                    first = low + place * width
                    if width == 1:
                        found[names[i]] = first
                    else:
                        narrowed[i] = (first, min(high, first + width - 1), half)
                    break
                half -= rows
        bounds = narrowed
    return {c: found.get(c) or default for c, default in defaults.items()}


def medians(df: DataFrame, defaults: Mapping[str, int]) -> DataFrame:
    """One row with the medians."""
    numbers = median_numbers(df, defaults)
    values = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in numbers.items()]
    return df.sparkSession.range(1).select(*values)


def median_values(df: DataFrame, defaults: Mapping[str, int]) -> dict[str, Column]:
    """The medians as constants for plans on the same frame."""
    if not defaults:
        return {}
    numbers = median_numbers(df, defaults)
    return {c: F.lit(v).cast(df.schema[c].dataType) for c, v in numbers.items()}


def fill_median(
    df: DataFrame, defaults: Mapping[str, int], values: Mapping[str, Column] | None = None
) -> DataFrame:
    """Median of the non-NULL values in place of NULL; ``values`` if they are known."""
    if not defaults:
        return df
    values = median_values(df, defaults) if values is None else values
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in values.items()})


def audit_fill(
    df: DataFrame,
    keys: Iterable[str],
    fills: Mapping[str, str | int | bool],
    median_defaults: Mapping[str, int] | None = None,
    medians_known: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per filled cell: keys, field, old value (NULL), new value, reason.

    All columns are looked at in one narrow pass over the unfilled frame.  A
    cell that needs no fill is a NULL struct, which unfolds to a row without
    ``Field`` inside the same fused stage and is dropped there.
    """
    new_values = {c: F.lit(v) for c, v in fills.items()}
    known = median_values(df, median_defaults or {}) if medians_known is None else medians_known
    new_values.update(known)
    cells = [
        F.when(
            F.col(c).isNull(),
            F.struct(
                F.lit(c).alias("Field"),
                F.lit(None).cast("string").alias("OldValue"),
                value.cast("string").alias("NewValue"),
                F.lit(f"Filled null in {c}").alias("Reason"),
            ),
        )
        for c, value in new_values.items()
    ]
    keys = list(keys)
    return df.select(*keys, F.inline(F.array(*cells))).filter(F.col("Field").isNotNull())


def quality_gate(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: rows seen, NULLs per critical column, rows with any, verdict."""
    columns = list(columns)
    bad = F.count_if(any_null(columns))
    return df.agg(
        F.count(F.lit(1)).alias("TotalRows"),
        *[F.count_if(F.col(c).isNull()).alias(f"Null{c}") for c in columns],
        bad.alias("CriticalNullRows"),
        (bad == 0).alias("Passed"),
    )
