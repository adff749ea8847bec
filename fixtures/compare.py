"""Compare a Spark result with a DuckDB statement on the same tables."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; empty when both give the same rows."""
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(result.columns):
        return [f"columns: spark only {set(result.columns) - set(names)},"
                f" oracle only {set(names) - set(result.columns)}"]
    theirs = _rows(names, cursor.fetchall())
    ours = _rows(result.columns, result.collect())
    if ours == theirs:
        return []
    found = [f"rows: spark {sum(ours.values())}, oracle {sum(theirs.values())}"]
    for label, some in (("spark only", ours - theirs), ("oracle only", theirs - ours)):
        found += [f"{label} {sum(some.values())}"] + [str(row) for row in list(some)[:2]]
    return found
