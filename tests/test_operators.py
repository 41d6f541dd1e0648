"""Operators on small frames, and invariants on the given tables."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyroom import operators as op
from tallyroom import rules as R
from tallyroom.plans.layers import cleaning, raw_layer
from tallyroom.sources import adapters

ENTITIES = ("community", "live", "video")


def stamp(text):
    return dt.datetime.fromisoformat(text)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# --- nulls ---


def test_null_profile_of_empty_frame_is_zero(spark):
    df = spark.createDataFrame([], "a int, `b c` string")
    assert tuple(op.null_profile(df).first()) == (0, 0)


def test_critical_nulls_and_drop_are_complements(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert rows(op.critical_nulls(df, ["a", "b"]).drop("Reason")) == Counter({(1, None): 1, (None, 2): 1})
    assert rows(op.drop_null_critical(df, ["a", "b"])) == Counter({(3, 4): 1})
    assert op.critical_nulls(df, ["a", "b"]).first()["Reason"] == "Null in critical columns: a, b"


@pytest.mark.parametrize(
    ("values", "expected"),
    [([None, None], 30), ([0, 0, None], 30), ([10, 20, 30], 20), ([5, None, 9, 7, 8], 7)],
)
def test_median_default(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "Age bigint")
    assert op.medians(df, {"Age": 30}).first()["Age"] == expected
    filled = op.fill_median(df, {"Age": 30})
    assert rows(filled) == Counter((expected,) if v is None else (v,) for v in values)


@pytest.mark.parametrize("partitions", [1, 7, 23])
def test_median_is_exact_however_rows_are_spread(spark, partitions):
    """A border case: half of the rows minus one lie below the median."""
    wide = (F.hash("id") % 1_000_003).cast("bigint")
    df = spark.range(60001).select(
        F.when(F.col("id") < 30000, F.lit(4)).otherwise(F.lit(5)).cast("bigint").alias("a"),
        wide.alias("b"),
        F.when(F.col("id") % 2 == 0, wide).alias("c"),
    )
    values = df.collect()

    def lower_median(column):
        known = sorted(r[column] for r in values if r[column] is not None)
        return known[(len(known) + 1) // 2 - 1]

    found = op.medians(df.repartition(partitions), {"a": 1, "b": 1, "c": 1}).first()
    assert found.asDict() == {c: lower_median(c) for c in "abc"}


def test_fill_audit_reports_every_cell(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", 4)], "k int, s string, Age bigint")
    audit = op.audit_fill(df, ["k"], {"s": "Unknown"}, {"Age": 30})
    assert rows(audit) == Counter({
        (1, "s", None, "Unknown", "Filled null in s"): 1,
        (1, "Age", None, "4", "Filled null in Age"): 1,
    })


def test_quality_gate(spark):
    df = spark.createDataFrame([(1, None), (2, 2)], "a int, b int")
    gate = op.quality_gate(df, ["a", "b"]).first()
    assert (gate.TotalRows, gate.Nulla, gate.Nullb, gate.CriticalNullRows, gate.Passed) == (2, 0, 1, 1, False)
    assert op.quality_gate(df, ["a"]).first().Passed is True


def test_typed_nulls_and_defaults(spark):
    df = op.add_typed_nulls(spark.range(1), {"x": "float", "y": "boolean"})
    assert df.dtypes[1:] == [("x", "float"), ("y", "boolean")]
    assert op.coalesce_default(df, {"x": 2.0}).first()["x"] == 2.0


# --- validity ---


def test_first_broken_rule_is_the_reason(spark):
    checks = (R.positive("a"), R.within("b", 0, 10), R.non_negative("c"))
    data = [(0, 11, -1), (1, 11, -1), (1, 10, -1), (1, 0, 0), (None, 5, 5)]
    df = spark.createDataFrame(data, "a int, b int, c int")
    assert rows(op.rejects(df, checks)) == Counter({
        (0, 11, -1, "Invalid a"): 1, (1, 11, -1, "Invalid b"): 1,
        (1, 10, -1, "Negative c"): 1, (None, 5, 5, "Invalid a"): 1,
    })
    assert rows(op.filter_valid(df, checks)) == Counter({(1, 0, 0): 1})


# --- text ---


def test_change_audit_does_not_pair_duplicates(spark):
    df = spark.createDataFrame([(1, "M"), (1, "F"), (2, "Male")], "k int, Gender string")
    from tallyroom.functions import apply_map

    audit = op.audit_changes(df, ["k"], {"Gender": apply_map(F.col("Gender"), R.GENDER)}, "Standardized")
    assert rows(audit) == Counter({
        (1, "Gender", "M", "Male", "Standardized Gender"): 1,
        (1, "Gender", "F", "Female", "Standardized Gender"): 1,
    })


# --- deduplication ---

VERSIONS = [
    (1, 1, "a", stamp("2024-01-01")), (1, 1, "b", stamp("2024-01-03")),
    (1, 1, "c", stamp("2024-01-03")), (1, 1, None, None),
    (2, 1, "d", stamp("2024-01-01")), (2, 1, "d", stamp("2024-01-01")),
]
SCHEMA = "k1 int, k2 int, v string, IngestionTimestamp timestamp"


def test_latest_breaks_ties_by_all_columns(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    kept = op.latest_by_key(df, ["k1", "k2"])
    assert rows(kept) == Counter({VERSIONS[1]: 1, VERSIONS[4]: 1})


def test_superseded_is_the_rest_including_copies(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA).repartition(3)
    lost = op.superseded(df, ["k1", "k2"])
    assert rows(lost.drop("Reason")) == Counter({
        VERSIONS[0]: 1, VERSIONS[2]: 1, VERSIONS[3]: 1, VERSIONS[4]: 1,
    })


def test_hot_key_with_many_copies(spark):
    """A third of the rows share a key and half of those are equal copies."""
    df = spark.range(30000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k1"),
        F.lit(1).alias("k2"),
        F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("v"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("IngestionTimestamp"),
    )
    kept = op.latest_by_key(df, ["k1", "k2"])
    lost = op.superseded(df, ["k1", "k2"])
    assert kept.count() == 20001
    assert lost.count() == 9999
    assert rows(kept.unionByName(lost.drop("Reason"))) == rows(df)


def test_latest_ranks_only_keys_with_several_rows(spark):
    df = spark.createDataFrame([*VERSIONS, (3, 1, "e", None), (None, 3, "f", None), (3, None, "g", None)], SCHEMA)
    keys = ["k1", "k2"]
    repeated = op.repeated_keys(df, keys).localCheckpoint()
    assert repeated.count() == 3  # (NULL, 3) and (3, NULL) share a hash, which only costs a rank
    kept = op.latest_by_key_apart(df, keys, repeated)
    assert rows(kept) == rows(op.latest_by_key(df, keys)) and kept.count() == 5


def test_content_is_compared_by_digest(spark):
    schema = "k int, a string, b string, f double"
    old = spark.createDataFrame([(1, "x", None, 0.0), (2, None, "y", float("nan")), (2, None, "y", float("nan"))], schema)
    new = spark.createDataFrame(
        [(1, "x", None, -0.0), (1, None, "x", 0.0), (2, None, "y", float("nan")), (3, "x", "", None), (3, "x", "", None)],
        schema,
    )
    fresh = op.anti_content(new, old, ["k", "a", "b", "f"])
    assert fresh.columns == new.columns
    assert rows(fresh) == Counter({(1, None, "x", 0.0): 1, (3, "x", "", None): 2})
    text = fresh.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "keys=[_hash" in text and "_content" not in text


def test_duplicate_census(spark):
    df = spark.createDataFrame(VERSIONS, SCHEMA)
    keys = ["k1", "k2"]
    assert rows(op.duplicate_keys(df, keys)) == Counter({(1, 1, 4): 1, (2, 1, 2): 1})
    assert tuple(op.duplicate_census(df, keys).first()) == (2, 4)
    assert [r["Copies"] for r in op.top_duplicates(df, keys, 1).collect()] == [4]
    assert tuple(op.duplicate_census(df.limit(0), keys).first()) == (0, 0)


# --- joins ---


def test_lookup_drops_unknown_and_null_and_never_multiplies(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "UserID bigint, v string")
    dim = spark.createDataFrame([("1", "s1"), ("1", "s1"), ("9", "s9")], "UserID string, User_S_ID string")
    linked = op.lookup(fact, dim, "UserID", "UserID", "User_S_ID", "Link")
    assert rows(linked) == Counter({(1, "x", "s1"): 1})


def test_anti_joins(spark):
    new = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "a int, b int")
    old = spark.createDataFrame([(1, 1), (1, 1), (None, 3)], "a int, b int")
    assert rows(op.anti_ingest(new, old, ["a", "b"])) == Counter({(1, 2): 1, (None, 3): 1})
    facts = spark.createDataFrame([("i1",), ("i2",)], "InteractionID string")
    assert rows(op.anti_append(facts, facts.limit(0))) == rows(facts)
    assert op.anti_append(facts, facts).isEmpty()


def test_range_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.sql("SELECT id AS t FROM range(100) UNION ALL SELECT NULL").write.parquet(path)
    stored = spark.read.parquet(path)
    batch = spark.createDataFrame([(40,), (42,)], "s bigint")
    assert rows(op.within_range(stored, "t", batch, "s")) == Counter({(None,): 1, (40,): 1, (41,): 1, (42,): 1})
    assert rows(op.within_range(stored, "t", batch.limit(0), "s")) == Counter({(None,): 1})


# --- invariants on the given tables ---


@pytest.mark.parametrize("entity", ENTITIES)
def test_stage_invariants(spark, sf_dir, entity):
    stages = cleaning(spark, sf_dir, entity)
    rules = stages.rules
    raw, nonnull = stages.raw.count(), stages.non_null.count()
    assert raw == nonnull + stages.critical_nulls.count()
    assert nonnull == stages.valid.count() + stages.rejects.count()
    assert stages.valid.count() == stages.latest.count() + stages.superseded.count()
    clean = stages.clean
    assert clean.select(*rules.keys).distinct().count() == clean.count()
    assert stages.quality.first().Passed is True
    assert tuple(stages.funnel.first()) == (raw, nonnull, stages.valid.count(), stages.latest.count())
    for column, rule in rules.maps.items():
        domain = {*rule.allowed, *rule.aliases, rule.default}
        found = {r[0] for r in stages.latest.select(column).distinct().collect()}
        assert found <= domain


@pytest.mark.parametrize(
    ("entity", "raw", "nonnull", "valid", "latest"),
    [
        ("live", 1000, 980, 731, 577),
        ("community", 1500, 1471, 1232, 128),
        ("video", 6000, 5820, 4202, 3857),
    ],
)
def test_golden_counts(spark, sf_dir, entity, raw, nonnull, valid, latest):
    assert tuple(cleaning(spark, sf_dir, entity).funnel.first()) == (raw, nonnull, valid, latest)


def test_raw_layer_equals_the_adapter(spark, sf_dir):
    for entity in ENTITIES:
        assert rows(raw_layer(spark, sf_dir, entity)) == rows(adapters.RAW[entity](spark, sf_dir))
