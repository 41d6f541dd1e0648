"""Run a registered query and its SQL on the same tables and compare whole results."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents
    embeddings pages benchmark labels conversations""".split()

# Spark type -> SQL type names that count as the same.
SAME_TYPE = {
    "bigint": {"BIGINT"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}, "float": {"FLOAT"},
    "double": {"DOUBLE"}, "timestamp": {"TIMESTAMP"}, "date": {"DATE"}, "int": {"INTEGER"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return str(value) if isinstance(value, dt.date) else value


def differences(df, con, sql: str) -> list[str]:
    """Empty when schema, row count and all rows (in any order) agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, [str(d[1]) for d in result.description]))
    theirs = result.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema:
        ours = field.dataType.simpleString()
        if types[field.name] not in SAME_TYPE.get(ours, {ours}):
            found.append(f"{field.name}: {ours} != {types[field.name]}")
    order = sorted(names)
    mine = Counter(tuple(_cell(row[c]) for c in order) for row in df.collect())
    position = [names.index(c) for c in order]
    other = Counter(tuple(_cell(row[i]) for i in position) for row in theirs)
    if mine != other:
        found.append(
            f"rows {sum(mine.values())} vs {sum(other.values())}; "
            f"only Spark {list((mine - other).items())[:2]}; only SQL {list((other - mine).items())[:2]}"
        )
    return found
