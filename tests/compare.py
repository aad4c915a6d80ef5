"""Compare a Spark result with the SQL result on the same parquet tables."""

from __future__ import annotations

import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SQL_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs in schema or rows; empty when both agree exactly."""
    found = []
    result = con.sql(sql)
    mine = {f.name: SQL_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = dict(zip(result.columns, map(str, result.types)))
    if mine != theirs:
        found.append(f"schema {set(mine.items()) ^ set(theirs.items())}")
    if set(mine) != set(theirs):
        return found
    names = sorted(mine)
    left = Counter(tuple(row[n] for n in names) for row in df.collect())
    order = [result.columns.index(n) for n in names]
    right = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert not any(isinstance(v, decimal.Decimal) for row in left for v in row)
    if left != right:
        found.append(
            f"rows {sum(left.values())} / {sum(right.values())}; "
            f"only Spark {list((left - right).items())[:2]}; only SQL {list((right - left).items())[:2]}"
        )
    return found
