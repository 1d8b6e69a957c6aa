"""Side-by-side comparison of a Spark result and DuckDB's, ignoring row order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(sf_dir) / name}.parquet')")
    return con


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(v)
        return None if v is None else f"{type(v).__name__}:{v}"

    return sorted(columns), sorted(
        (tuple(value(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((x is not None, x or "") for x in r),
    )


def spark_rows(df):
    return normalized(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return normalized([c[0] for c in cur.description], cur.fetchall())
