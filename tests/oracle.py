"""Compares a query's rows with DuckDB's for its SQL, whatever their order."""

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def counted(rows, columns, at=lambda r, i, c: r[i]):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(repr([plain(at(r, i, columns[i])) for i in order]) for r in rows)


def assert_same(df, sql, sf_dir=None, views=None):
    con = duckdb.connect()
    for t in TABLES:
        if sf_dir and os.path.exists(p := f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    for name, table in (views or {}).items():
        con.register(name, table)
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    got, expected = counted(df.collect(), df.columns), counted(want.fetchall(), want.columns)
    assert got == expected, (list((got - expected))[:3], list((expected - got))[:3])
