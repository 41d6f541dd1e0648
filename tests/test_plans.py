"""Physical plans: what is pushed down, how often rows are shuffled, how skew is met."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyroom import operators as op
from tallyroom import rules as R
from tallyroom.catalog import queries
from tallyroom.plans import activity, star
from tallyroom.plans.clean import Cleaning
from tallyroom.plans.layers import cleaning, staging_layer
from tallyroom.sources import adapters


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Plan as adaptive execution left it; the plan has to be run for that."""
    df._jdf.queryExecution().executedPlan().executeCollect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def exchanges(df):
    return len(re.findall(r"\bExchange hashpartitioning", plan(df)))


ENTITIES = ("community", "live", "video")


def without_medians(stages):
    """The same cleaning with constants for medians, whose subquery has shuffles of its own."""
    rules = stages.rules
    constants = replace(rules, medians={}, fills={**rules.fills, **rules.medians})
    return Cleaning(stages.raw, constants)


@pytest.mark.parametrize("entity", ENTITIES)
def test_cleaning_shuffles_once_and_ranks_before_it(spark, sf_dir, entity):
    clean = without_medians(cleaning(spark, sf_dir, entity)).clean
    text = plan(clean)
    assert exchanges(clean) == 1
    partial, final = text.rfind("WindowGroupLimit"), text.find("WindowGroupLimit")
    assert final < text.find("Exchange hashpartitioning") < partial
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("entity", ENTITIES)
def test_rows_of_single_keys_are_not_shuffled(spark, sf_dir, entity, monkeypatch):
    stages = without_medians(cleaning(spark, sf_dir, entity))
    apart = stages.clean
    alone = plan(apart).split("WindowGroupLimit")[0]
    assert "LeftAnti" in alone and "LeftSemi" in plan(apart)
    monkeypatch.setattr(op, "MAX_REPEATED", 0)
    ranked = without_medians(stages).clean
    assert "LeftAnti" not in plan(ranked)
    assert apart.exceptAll(ranked).isEmpty() and ranked.exceptAll(apart).isEmpty()


def test_line_items_do_not_meet_customers_one_by_one(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(adapters.video_raw(spark, sf_dir)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    below = lines[at + 1 :]
    ends = next((i for i, li in enumerate(below) if len(li) - len(li.lstrip(" :+-")) <= depth), len(below))
    assert "l_orderkey" not in "".join(below[:ends]).replace("o_orderkey", "")


@pytest.mark.parametrize("entity", ENTITIES)
def test_key_rules_reach_the_scan(spark, sf_dir, entity):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    stages = cleaning(spark, sf_dir, entity)
    text = plan(stages.valid)
    for key in stages.rules.keys:
        assert f"IsNotNull({key})" in text and f"GreaterThanOrEqual({key},1)" in text
    for column in stages.rules.critical:
        assert f"IsNotNull({column})" in plan(stages.non_null)


def test_profile_of_two_columns_reads_two_columns(spark, sf_dir):
    df = cleaning(spark, sf_dir, "video").raw.select("UserID", "VideoID")
    assert "ReadSchema: struct<UserID:bigint,VideoID:bigint>" in plan(op.null_profile(df))


def test_audits_and_rejects_do_not_shuffle(spark, sf_dir):
    stages = without_medians(cleaning(spark, sf_dir, "video"))
    for frame in (stages.critical_nulls, stages.rejects, stages.fill_audit):
        assert "Exchange" not in plan(frame)


def test_medians_reach_plans_as_constants(spark, sf_dir):
    stages = cleaning(spark, sf_dir, "video")
    for frame in (stages.filled, stages.fill_audit, stages.change_audit):
        text = plan(frame)
        assert "Subquery" not in text and "Join" not in text and "SinglePartition" not in text
    assert plan(stages.filled).count("Scan parquet") <= 2  # the node and its details


@pytest.mark.parametrize("profile", ["community", "live", "video"])
def test_fact_of_complete_dimensions_needs_no_shuffle(spark, sf_dir, profile):
    fact = star.build_fact_complete(staging_layer(spark, sf_dir, profile), star.STAR_FACTS[profile])
    assert exchanges(fact) == 0 and "Join" not in plan(fact)


def test_activity_shuffles_once_after_partial_sums(spark, sf_dir):
    facts = [
        star.build_fact_complete(staging_layer(spark, sf_dir, e), star.STAR_FACTS[e])
        for e in ENTITIES
    ]
    result = activity.user_activity(activity.unify_activity(*facts))
    assert exchanges(result) == 1
    assert "partial_sum" in plan(result).split("Exchange hashpartitioning")[1]


def test_marts_sum_before_they_join(spark, sf_dir):
    text = plan(queries()["mart_demographics"](spark, sf_dir))
    join = text.find("Join")
    assert 0 < join < text.rfind("partial_sum(Engagement")


def test_small_tables_are_broadcast_by_size_large_ones_are_not(spark):
    fact = spark.range(1000).select(F.col("id").alias("UserID"))
    dim = spark.range(100).select(F.col("id").cast("string").alias("UserID"), F.md5(F.col("id").cast("string")).alias("S"))
    from tallyroom.sources import materialise

    dim = materialise(dim, "dim")
    joined = op.lookup(fact, dim, "UserID", "UserID", "S")
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(op.lookup(fact, dim, "UserID", "UserID", "S"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def tiny_skew(spark):
    """Thresholds at which a few thousand rows count as large and skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def hot(spark, column):
    """A third of the rows under one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 512).alias("payload")
    return spark.range(60000, numPartitions=16).select(key.alias(column), F.lit(1).alias("b"), text)


def test_hot_key_is_split_in_lookup(spark, tiny_skew):
    from tallyroom.sources import materialise

    dim = spark.range(60000).select(F.col("id").cast("string").alias("UserID"), F.md5(F.col("id").cast("string")).alias("S"))
    dim = materialise(dim, "dim")
    joined = op.lookup(hot(spark, "UserID"), dim, "UserID", "UserID", "S")
    assert joined.count() == 60000
    assert "skew=true" in final_plan(joined)


def test_hot_key_is_split_in_ingest(spark, tiny_skew):
    new = hot(spark, "a")
    existing = hot(spark, "a").filter("a <> 7 AND a % 2 = 0").drop("payload")
    fresh = op.anti_ingest(new, existing, ["a", "b"])
    assert "skew=true" in final_plan(fresh)
    assert fresh.count() == new.filter("a = 7 OR a % 2 = 1").count()


def test_superseded_ranks_a_hot_key_in_shares(spark):
    df = hot(spark, "a").withColumn("IngestionTimestamp", F.timestamp_seconds(F.lit(0)))
    text = plan(op.superseded(df, ["a", "b"]))
    assert "hashpartitioning(a" in text and "_slice" in text and "_round" in text
    assert op.superseded(df, ["a", "b"]).count() == 60000 - df.select("a", "b").distinct().count()
