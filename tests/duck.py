"""Comparing a query with its DuckDB equivalent."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(df, sql, sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    columns = sorted(df.columns)
    rows = df.collect()
    rel = con.sql(sql)
    assert sorted(rel.columns) == columns

    def plain(x):
        return tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in x)

    got = sorted((plain(r[c] for c in columns) for r in rows), key=repr)
    want = sorted((plain(r) for r in rel.project(", ".join(f'"{c}"' for c in columns)).fetchall()), key=repr)
    assert len(got) == len(want)
    different = [(a, b) for a, b in zip(got, want) if a != b]
    assert not different, different[:3]
    assert got
