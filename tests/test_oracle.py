"""Every registered query against its SQL, whole results, on the given tables."""

import pytest
from conftest import SF_DIR
from oracle_compare import connect, differences

from tallyroom.catalog import oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry_without_a_module_of_the_optional_package(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    for name in [m for m in sys.modules if m.startswith(("tallyroom.llm", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(SQL)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
