"""The registered queries against their SQL, whole results, and their shape on empty tables."""

import pytest
from conftest import SF_DIR
from oracle_compare import connect, differences

from tallyroom.llm import catalog


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert differences(catalog.queries()[name](spark, SF_DIR), con, catalog.oracle_sql()[name]) == []


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "pages", "benchmark", "conversations", "embeddings"):
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        table.limit(0).write.parquet(f"{base}/{name}.parquet")
    return str(base)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_empty_tables(spark, empty_dir, name):
    rows = catalog.queries()[name](spark, empty_dir).count()
    assert rows == (1 if name == "op8_chat" else 0)  # the conversation that the query adds
