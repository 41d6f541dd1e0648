"""Connected components of a table of links, by large-star and small-star rounds.

Each round rewires links towards the smallest neighbour (Kiveris et al. 2014);
the rounds end when every node hangs on the smallest of its component.  A node
with very many links has one aggregated row on the other side of each join, and
every round is a stored table, so its links are split by the adaptive skew rule
and lost executors recompute one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import Workspace


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(links: DataFrame, space: Workspace) -> DataFrame:
    """node and label, the smallest node of its component, for every node that is not a label.

    ``links`` has columns u and v; direction, repetition and loops do not matter.
    """
    links = space.step(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _state(links)
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = space.step(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = space.step(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = space.step(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u")
        links = space.step(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = _state(links)
        if after == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = after
