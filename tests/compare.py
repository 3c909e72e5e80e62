"""Run one registered query and its oracle and compare rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r))
    )


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())
