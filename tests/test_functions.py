"""Column expressions on hand-written values, boundaries and NULL included."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallyroom import functions as fn
from tallyroom import rules as R


def apply(spark, values, dtype, expression):
    """Value -> result, evaluated by Spark over one column ``v``."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def test_age_group(spark):
    bands = {
        12: "65+", 13: "13-17", 17: "13-17", 18: "18-24", 24: "18-24", 25: "25-34",
        34: "25-34", 35: "35-44", 44: "35-44", 45: "45-54", 54: "45-54", 55: "55-64",
        64: "55-64", 65: "65+", 100: "65+", 101: "65+", None: "65+",
    }
    assert apply(spark, list(bands), "bigint", fn.age_group) == list(bands.values())


def test_time_spent_category(spark):
    spent = {0: "Short", 299: "Short", 300: "Medium", 1800: "Medium", 1801: "Long", None: "Long"}
    assert apply(spark, list(spent), "bigint", fn.time_spent_category) == list(spent.values())


def test_hour_of(spark):
    clocks = {"14:30:00": 14, "00:00:00": 0, "9:00 pm": None, "morning": None, None: None, "25:00:00": None}
    assert apply(spark, list(clocks), "string", fn.hour_of) == list(clocks.values())


def test_valid_time_or_default(spark):
    clocks = ["14:30:00", "morning", None, "25:00:00", "2024-01-01 10:00:00"]
    expected = ["14:30:00", "00:00:00", "00:00:00", "00:00:00", "2024-01-01 10:00:00"]
    assert apply(spark, clocks, "string", fn.valid_time_or_default) == expected


def test_title(spark):
    titles = {
        "YouTube": "Youtube", "iOS": "Ios", "Wi-Fi": "Wi-fi", "new york": "New York",
        "Q&A": "Q&a", "LiveStream": "Livestream", None: None,
    }
    assert apply(spark, list(titles), "string", fn.title) == list(titles.values())


def test_synonyms(spark):
    values = ["M", "male", "Female", "F", "Non-binary", "x", " Male", None]
    expected = ["Male", "Male", "Female", "Female", "Other", "Unknown", "Unknown", "Unknown"]
    out = apply(spark, values, "string", lambda c: fn.map_values(c, R.GENDER.aliases, "Unknown"))
    assert out == expected


def test_whitelist_is_case_sensitive(spark):
    values = ["YouTube", "youtube", " YouTube", "Unknown", None]
    out = apply(spark, values, "string", lambda c: fn.whitelist(c, R.PLATFORM.allowed))
    assert out == ["YouTube", "Unknown", "Unknown", "Unknown", "Unknown"]


@pytest.mark.parametrize(
    ("rule", "value", "expected"),
    [
        (R.BATCH_DEVICE, "Smartphone", "Smartphone"),
        (R.STREAM_DEVICE, "Smartphone", "Unknown"),
        (R.BATCH_DEVICE, "Laptop", "Desktop"),
        (R.STREAM_DEVICE, "Laptop", "Unknown"),
        (R.BATCH_EVENT_TYPE, "Q&A", "LiveStream"),
        (R.STREAM_EVENT_TYPE, "Q&A", "Unknown"),
        (R.BATCH_EVENT_TYPE, " Broadcast", "Unknown"),
        (R.BATCH_CONNECTION, "Wi-Fi", "Wi-Fi"),
        (R.STREAM_CONNECTION, "Wi-Fi", "Unknown"),
        (R.STREAM_CONNECTION, "WiFi", "WiFi"),
        (R.MEMBERSHIP, "Moderator", "Member"),
        (R.MEMBERSHIP, None, "Member"),
    ],
)
def test_vocabularies(spark, rule, value, expected):
    out = apply(
        spark, [value], "string",
        lambda c: fn.alias_whitelist(c, rule.aliases, rule.allowed, rule.default),
    )
    assert out == [expected]


def test_identifiers(spark):
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert apply(spark, [7, None], "bigint", fn.surrogate) == [digest("7"), None]
    df = spark.sql("SELECT 7L a, CAST(NULL AS BIGINT) b, TIMESTAMP '2024-01-02 03:04:05.5' t")
    row = df.select(
        fn.interaction_id(F.col("a"), F.col("b"), F.col("t")).alias("id"),
        fn.activity_date(F.col("t")).cast("string").alias("day"),
    ).first()
    assert row["id"] == digest("7_2024-01-02 03:04:05.5")
    assert row["day"] == "2024-01-02"


def test_rules_reject_missing_fill_values():
    with pytest.raises(ValueError, match="fill value missing"):
        R.RuleSet(
            "x", "A BIGINT", ("A",), ("A",), {"A": None}, (), {}, (), (), ()
        )


def test_rules_reject_unknown_columns():
    with pytest.raises(ValueError, match="unknown columns"):
        R.RuleSet("x", "A BIGINT", ("A",), ("B",), {}, (), {}, (), (), ())
