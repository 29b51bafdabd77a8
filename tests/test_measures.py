"""Lines are measured once where they are equal, and by more than one task."""

import duckdb

from waymark.plans import places


def test_equal_lines_are_measured_once(spark, tmp_path):
    # the customers of sf0.01 and three copies whose lines are the same
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (c_custkey + i * 25200 AS c_custkey) FROM '/root/testdata/sf0.01/customer.parquet', range(4) r(i)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    got = places.measures(spark, str(tmp_path))
    assert got.count() == 6000 and got.select("id").distinct().count() == 6000
    told = spark.read.parquet(f"{tmp_path}/customer.parquet")
    rows = {r.id: tuple(r)[1:] for r in got.collect()}
    assert all(rows[r.c_custkey] == rows[r.c_custkey % 25200] for r in told.select("c_custkey").collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Distinct" in plan or "Aggregate" in plan
    assert "Repartition" in plan
