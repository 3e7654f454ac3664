"""Comparison of query results with SQL run by DuckDB."""

from __future__ import annotations

import decimal
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value


def database(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def same(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    answer = con.sql(sql)
    names = list(answer.columns)
    assert sorted(names) == columns
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in answer.fetchall())
    assert got == want
