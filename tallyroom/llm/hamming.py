"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension: is the value above zero; a code of more
than 64 bits is several numbers.  Codes are cut into m segments somewhat narrower than log2(number of codes) bits, so a segment
value has a few codes.  Round r looks up, for every segment of every open query code,
the values that differ in exactly r bits; a candidate's whole distance is taken
at once.  Two codes within distance d agree up to d // m bits in some segment, so
after round r all codes within m * (r + 1) - 1 are verified, and a query whose
k-th distance is within that is closed.

A candidate is kept only by the first of the segments in which it differs least,
so each pair is seen once over all segments and rounds.  Equal codes form one
entry with its k + 1 smallest ids, which is all that a top-k list can use of
them (one more for the query itself), and equal queries are searched once: a code
shared by a third of all rows is one entry and one query.

Defined results: neighbours are ordered by distance, then id; a query is not its
own neighbour; a query gets fewer than k neighbours only if there are fewer.  NULL
vectors and NULL ids are left out; missing, NULL and NaN values give a zero bit;
a vector longer than the codes is an error, none is cut; rows that repeat an id count once, with the
smallest of their codes.  Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroom.llm.common import Workspace

#: By so many bits a segment is narrower than log2 of the number of codes: a probe then
#: meets about six codes, and the probes are fewer by more than that.
SPARE_BITS = 2.5


def codes_of(rows: DataFrame, vector: str, bits: int) -> DataFrame:
    """id and code, one row per id; a code is a number of 64 bits or a struct of them."""
    bit = f"get({vector}, i)"
    words = [
        F.expr(
            f"aggregate(sequence({first}, {min(first + 64, bits) - 1}), 0L, (a, i) -> a | "
            f"if(coalesce({bit} > 0 AND NOT isnan({bit}), false), shiftleft(1L, i - {first}), 0L))"
        )
        for first in range(0, bits, 64)
    ]
    code = words[0] if len(words) == 1 else F.struct(*[w.alias(f"w{i}") for i, w in enumerate(words)])
    return (
        rows.where(F.col(vector).isNotNull() & F.col("id").isNotNull())
        .select("id", code.alias("code"))
        .groupBy("id")
        .agg(F.min("code").alias("code"))
    )


def segments_for(bits: int, n_codes: int) -> list[tuple[int, int]]:
    """(offset, width) of segments somewhat narrower than log2(n_codes) bits, at most 24.

    None crosses from one number of a code into the next.
    """
    width = min(24.0, max(4.0, math.log2(max(2, n_codes)) - SPARE_BITS))
    found = []
    for first in range(0, bits, 64):
        here = min(64, bits - first)
        m = max(1, round(here / width))
        edges = [first + i * here // m for i in range(m + 1)]
        found += [(a, b - a) for a, b in zip(edges, edges[1:])]
    return found


def _words(code: str, bits: int) -> list[Column]:
    if bits <= 64:
        return [F.col(code)]
    return [F.col(f"{code}.w{i}") for i in range(-(-bits // 64))]


def _segment(words: list[Column], offset: int, width: int) -> Column:
    return F.shiftrightunsigned(words[offset // 64], offset % 64).bitwiseAND(F.lit((1 << width) - 1))


def _masks(width: int, radius: int) -> Column:
    """All ``width``-bit numbers with ``radius`` bits set, as one constant array."""
    numbers = (sum(1 << b for b in bits) for bits in combinations(range(width), radius))
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def _pieces(codes: DataFrame, bits: int, segments: list[tuple[int, int]], radius: int = 0) -> DataFrame:
    """Codes with each segment's number and the values at ``radius`` from its own."""
    parts = []
    for number, (offset, width) in enumerate(segments):
        if radius <= width:
            value = _segment(_words("code", bits), offset, width).bitwiseXOR(F.col("mask"))
            parts.append(
                codes.select("code", F.explode(_masks(width, radius)).alias("mask")).select(
                    "code", F.lit(number).alias("segment"), value.alias("value")
                )
            )
    made = parts[0]
    for part in parts[1:]:
        made = made.unionAll(part)
    return made


def _first_least(xor: list[Column], segments: list[tuple[int, int]], radius: int) -> Column:
    """Whether the matched segment is the first of those that differ in fewest bits."""
    kept = F.lit(True)
    for number, (offset, width) in enumerate(segments):
        differ = F.bit_count(_segment(xor, offset, width))
        least = F.when(F.col("segment") > number, differ > radius).otherwise(differ >= radius)
        kept = kept & least
    return kept


def _top(rows: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def search(
    rows: DataFrame,
    queries: Column,
    k: int,
    space: Workspace,
    id: str = "vec_id",
    vector: str = "embedding",
    bits: int | None = None,
) -> DataFrame:
    """query_id, rank, neighbour_id and distance of the k nearest rows of each query row.

    ``queries`` is a condition on ``id``.  Codes have as many bits as the longest
    vector has values, or ``bits``, if that is no fewer.
    """
    longest = rows.agg(F.coalesce(F.max(F.size(vector)), F.lit(1))).first()[0]
    bits = max(1, longest) if bits is None else bits
    if bits < longest:
        raise ValueError(f"vectors have up to {longest} values, codes {bits} bits")
    codes = space.step(codes_of(rows.select(F.col(id).cast("long").alias("id"), vector), vector, bits))
    members = space.step(
        _top(codes, ["code"], ["id"], k + 1)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 at most
    )
    asked = codes.select(F.col("id").alias(id), "code").where(queries)
    n_codes = members.count()
    segments = segments_for(bits, n_codes)
    index = space.step(_pieces(members.select("code"), bits, segments))
    open_codes = space.step(asked.select("code").distinct())
    best: DataFrame | None = None
    done: list[DataFrame] = []
    for radius in range(max(w for _, w in segments) + 1):
        probes = _pieces(open_codes, bits, segments, radius)
        xor = [a.bitwiseXOR(c) for a, c in zip(_words("asked", bits), _words("code", bits))]
        distance = reduce(add, [F.bit_count(x) for x in xor])
        # Few stored codes make many probes: Spark must not take them for a small side.
        found = (
            probes.withColumnRenamed("code", "asked")
            .hint("merge")
            .join(index, ["segment", "value"])
            .where(_first_least(xor, segments, radius))
            .select("asked", "code", distance.cast("long").alias("distance"))
        )
        # With a distance, codes by their smallest id: k + 1 codes hold k + 1 nearest ids.
        found = found.hint("merge").join(
            members.select("code", F.col("ids")[0].alias("least")), "code"
        )
        if best is not None:
            found = found.unionByName(best.join(open_codes.withColumnRenamed("code", "asked"), "asked", "left_semi"))
        best = space.step(
            _top(found, ["asked"], ["distance", "least"], k + 1).select(
                "asked", "code", "distance", "least"
            )
        )
        done.append(best.withColumn("round", F.lit(radius)))
        reach = len(segments) * (radius + 1) - 1
        # How many neighbours, self left out, lie within reach of what was searched.
        state = (
            best.join(members.select("code", F.size("ids").alias("n")), "code")
            .where(F.col("distance") <= reach)
            .groupBy("asked")
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") > k)
        )
        open_codes = space.step(
            open_codes.join(state.select(F.col("asked").alias("code")), "code", "left_anti")
        )
        if open_codes.isEmpty():
            break
    last = done[0]
    for more in done[1:]:
        last = last.unionByName(more)
    newest = last.groupBy("asked").agg(F.max("round").alias("round"))
    lists = (
        last.join(newest, ["asked", "round"])
        .join(members, "code")
        .select("asked", "distance", F.explode("ids").alias("neighbour_id"))
    )
    lists = _top(lists, ["asked"], ["distance", "neighbour_id"], k + 1).drop("rank")
    pairs = (
        asked.select(F.col(id).alias("query_id"), F.col("code").alias("asked"))
        .join(lists, "asked")
        .where(F.col("query_id") != F.col("neighbour_id"))
    )
    return space.keep(
        _top(pairs, ["query_id"], ["distance", "neighbour_id"], k).select(
            "query_id", "rank", "neighbour_id", "distance"
        )
    )
