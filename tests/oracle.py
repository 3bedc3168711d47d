"""Holds a query's rows against its SQL in DuckDB."""

import os

import duckdb

SF = "/root/testdata/sf0.001"


def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def same(spark, query, sql):
    df = query(spark, SF)
    found = duck().execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([r[names.index(c)] for c in df.columns]) for r in found.fetchall())
    got = sorted(repr(list(r)) for r in df.collect())
    assert got == want
