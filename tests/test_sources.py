"""Readers and writers on small files."""

import json

import pytest

from tallyroom import rules as R
from tallyroom import schemas as S
from tallyroom import sources as io
from tallyroom.sources.writers import shared_folder

VIDEO_FILE = S.file_schema(S.VIDEO_DDL, S.VIDEO_FILE_NAMES)
VIDEO_CSV = S.file_schema(S.VIDEO_DDL, S.VIDEO_FILE_NAMES, narrow_ints=True)


def test_parquet_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.sql("SELECT 1L AS a, 'x' AS b").write.parquet(path)
    assert io.read_entity(spark, path).columns == ["a", "b"]
    assert io.read_entity(spark, path, schema="b string, c int").first().asDict() == {"b": "x", "c": None}


def test_csv_options(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("id,flag,name\n1,true,a\nN/A,N/A,N/A\nabc,false,b\n")
    df = io.read_entity(spark, str(path), "csv", "id int, flag boolean, name string", header="true", nullValue="N/A")
    assert sorted(map(tuple, df.collect()), key=str) == [(1, True, "a"), (None, False, "b"), (None, None, None)]


def test_csv_layout_of_the_video_export():
    names = VIDEO_CSV.names
    assert "ProductivityLoss" in names and "Productivity Loss" in VIDEO_FILE.names
    assert {f.dataType.simpleString() for f in VIDEO_CSV} == {"int", "string", "boolean"}


@pytest.mark.parametrize("options", [{}, {"mode": "PERMISSIVE"}])
def test_ndjson_permissive(spark, tmp_path, options):
    path = tmp_path / "v.json"
    path.write_text('{"a": 1, "b": "x"}\nnot json\n{"a": "wrong", "b": "y"}\n')
    df = io.read_entity(spark, str(path), "json", "a bigint, b string", **options)
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "x"), (None, "y"), (None, None)]


def test_conform_schema_matches_by_name(spark):
    df = spark.sql("SELECT 'n' AS extra, 5 AS `Total Time Spent`, 'c' AS CommunityName")
    schema = S.message_schema(S.COMMUNITY_DDL)
    row = io.conform_schema(df, schema, S.COMMUNITY_FILE_NAMES).first()
    assert row.TotalTimeSpent == 5 and row.CommunityName == "c" and row.UserID is None
    conformed = io.conform_schema(df, schema, S.COMMUNITY_FILE_NAMES).schema
    assert conformed.simpleString() == schema.simpleString()


def test_union_alignment(spark):
    csv = spark.sql("SELECT 1 AS UserID, 2 AS ProductivityLoss")
    js = spark.sql("SELECT 3L AS UserID, 4L AS `Productivity Loss`, 'x' AS OS")
    schema = S.message_schema(S.VIDEO_DDL)
    union = io.union_aligned([io.align_for_union(f, schema, S.VIDEO_FILE_NAMES) for f in (csv, js)])
    assert dict(union.dtypes) == {"UserID": "bigint", "ProductivityLoss": "bigint", "OS": "string"}
    assert sorted(map(tuple, union.collect())) == [(1, 2, None), (3, 4, "x")]


def test_write_modes_and_files(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(10)
    io.write_entity(df, path)
    io.write_entity(df, path)
    assert io.read_entity(spark, path).count() == 20
    io.write_entity(df, path, "overwrite", files=1)
    assert io.read_entity(spark, path).count() == 10
    assert len(list((tmp_path / "out").glob("*.snappy.parquet"))) == 1
    io.write_entity(df, path, "overwrite", files=1, max_records_per_file=4)
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 3


def test_write_if_any(spark):
    written = []
    assert io.write_if_any(spark.range(1), written.append) is True
    assert io.write_if_any(spark.range(0), written.append) is False
    assert len(written) == 1


def test_warehouse_tables_align_by_name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS io_test")
    io.write_table(spark.sql("SELECT 1 AS a, 'x' AS b"), "io_test.t", "overwrite")
    io.write_table(spark.sql("SELECT 'y' AS b, 2 AS a"), "io_test.t", "append")
    got = io.read_table(spark, "io_test.t", ["b", "a"])
    assert sorted(map(tuple, got.collect())) == [("x", 1), ("y", 2)]


def test_connector_format(spark, tmp_path):
    """A connector differs by format and options only; Parquet stands in for one here."""
    path = str(tmp_path / "c")
    io.write_table(spark.range(3), "T", "overwrite", "parquet", path=path)
    assert io.read_table(spark, "T", ["id"], "parquet", path=path).count() == 3


def test_staged_stream_keeps_the_stamp_and_prunes_days(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.sql(
        "SELECT 1L AS EventID, TIMESTAMP '2024-01-01 10:00:00' AS IngestionTimestamp, DATE '2024-01-01' AS IngestionDate"
        " UNION ALL SELECT 2L, TIMESTAMP '2024-01-02 11:00:00', DATE '2024-01-02'"
    )
    df.write.partitionBy("IngestionDate").parquet(path)
    staged = io.read_staged_stream(spark, path, "EventID bigint, IngestionTimestamp timestamp")
    assert staged.filter("IngestionTimestamp IS NULL").isEmpty()
    recent = io.read_staged_stream(spark, path, "EventID bigint, IngestionTimestamp timestamp", since="2024-01-02")
    assert [r.EventID for r in recent.collect()] == [2]
    assert "PartitionFilters: [isnotnull(IngestionDate" in recent._jdf.queryExecution().toString()
    # distinct ingestion stamps of the staging folder
    assert staged.select(staged.IngestionTimestamp.cast("string")).distinct().count() == 2


def test_materialise_writes_to_the_shared_folder(spark):
    df = io.materialise(spark.range(5), "check")
    assert df.count() == 5
    assert shared_folder(spark) in df.inputFiles()[0]
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == shared_folder(spark)


def test_message_schemas_have_no_stamp():
    for rules in R.PROFILES.values():
        assert S.STAMP not in S.message_schema(rules.ddl).names
        assert S.entity_schema(rules.ddl).names[-1] == S.STAMP


def test_ndjson_file_layout(spark, tmp_path):
    """A file with spaced names ends up canonical, wide integers included."""
    path = tmp_path / "live.ndjson"
    path.write_text(json.dumps({"EventID": 2**40, "Watch Time": "14:30:00", "Addiction Level": 3}))
    schema = S.file_schema(S.LIVE_DDL, S.LIVE_FILE_NAMES)
    row = io.conform_schema(
        io.read_entity(spark, str(path), "json", schema), S.message_schema(S.LIVE_DDL), S.LIVE_FILE_NAMES
    ).first()
    assert (row.EventID, row.WatchTime, row.AddictionLevel) == (2**40, "14:30:00", 3)
