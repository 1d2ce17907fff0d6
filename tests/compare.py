"""Results of Spark and of DuckDB as comparable rows."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return bytes(v) if isinstance(v, bytearray) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(sql, sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    got = con.execute(sql)
    return rows_of([c[0] for c in got.description], got.fetchall())
