"""Comparing a query with its DuckDB equivalent."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def same(df, sql, sf_dir):
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    rel = duck(sf_dir).sql(sql)
    assert sorted(rel.columns) == columns
    want = sorted(map(repr, rel.project(", ".join(f'"{c}"' for c in columns)).fetchall()))
    assert got == want
