"""Comparison of a Spark result with DuckDB's on the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return v


def rows(columns, found):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r))


def same(spark, sf, f, sql):
    df = f(spark, sf)
    cursor = connect(sf).execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())
