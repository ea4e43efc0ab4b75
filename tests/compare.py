"""Compare a Spark result with DuckDB's on the same tables, as multisets of rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(repr(v) for v in row) for row in df.select(*names).collect())


def rows_of_duckdb(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return [columns[i] for i in order], Counter(tuple(repr(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    names, found = rows_of_spark(df)
    wanted_names, wanted = rows_of_duckdb(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if found == wanted:
        return None
    extra, missing = found - wanted, wanted - found
    return (
        f"{sum(found.values())} rows, wanted {sum(wanted.values())}\n"
        f"  only Spark : {list(extra)[:2]}\n  only DuckDB: {list(missing)[:2]}"
    )
