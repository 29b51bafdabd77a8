import random

from pyspark.sql import functions as F

from waymark.operators import intervals
from waymark.plans import network, references


def test_equal_intervals_meet_once(spark):
    left = spark.range(300).select(F.col("id"), F.lit("a").alias("route"), F.lit(0.0).alias("from_mp"), F.lit(70.0).alias("to_mp"))
    right = spark.range(300).select(F.lit("a").alias("route"), F.lit(1.0).alias("from_mp"), F.lit(66.0).alias("to_mp"), (F.col("id") + 5).alias("v"))
    r = right.select(F.col("route").alias("_key"), F.col("from_mp").alias("_begin"), F.col("to_mp").alias("_end"), F.struct("v").alias("_take"))
    assert intervals._pairs(left, r, "route", "from_mp", "to_mp", 32.0, ["_key", "_begin", "_end"], F.col("_take")).count() == 1
    rows = intervals.best_overlap(left, right, "route", ["v"]).collect()
    assert len(rows) == 300 and {(r.v, r.overlap) for r in rows} == {(5, 65.0)}


def test_left_columns_do_not_pass_the_join(spark):
    left = spark.range(50).select("id", F.lit("a").alias("route"), F.col("id").cast("double").alias("from_mp"), (F.col("id") + 1).cast("double").alias("to_mp"), F.col("id").cast("string").alias("never_read"))
    right = left.select("route", "from_mp", "to_mp", F.col("id").alias("v"))
    plan = intervals.best_overlap(left, right, "route", ["v"]).select("id", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "never_read" not in plan


def test_rows_without_bounds_or_partners_stay(spark):
    rows = [(1, "a", 0.0, 10.0), (2, "a", None, 4.0), (3, None, 0.0, 1.0), (4, "b", 0.0, 1.0), (5, "a", 90.0, 91.0)]
    left = spark.createDataFrame(rows, "id int, route string, from_mp double, to_mp double")
    right = spark.createDataFrame([("a", 2.0, 40.0, 7), ("a", 1.0, 3.0, 8)], "route string, from_mp double, to_mp double, v int")
    got = {r.id: (r.v, r.overlap) for r in intervals.best_overlap(left, right, "route", ["v"]).collect()}
    assert got == {1: (7, 8.0), 2: (8, None), 3: (None, None), 4: (None, None), 5: (None, None)}


def test_yearly_values_of_segments_that_share_an_id(spark):
    segments = spark.createDataFrame([("x", "a", 0.0, 5.0), ("x", "a", 5.0, 9.0), ("y", "a", None, 3.0)], "id string, route string, from_mp double, to_mp double")
    history = spark.createDataFrame([("a", 0.0, 5.0, 2020, 1), ("a", 5.0, 9.0, 2020, 2), ("a", 4.0, 9.0, 2022, 3)], "route string, from_mp double, to_mp double, year int, v int")
    got = sorted(((r.id, r.from_mp, r.AADT_2020_HPMS, r.AADT_2022_HPMS) for r in intervals.yearly_values(segments, history, "route", "id", "v", [2020, 2022]).collect()), key=repr)
    assert got == [("x", 0.0, 1, 3), ("x", 5.0, 2, 3), ("y", None, None, None)]


def _dealt_sides(spark, routes, n, seed):
    draw = random.Random(seed)

    def bound(a):
        return None if draw.random() < 0.05 else a

    def row(i):
        a = draw.randrange(0, 80) / 2
        return i, None if draw.random() < 0.05 else f"r{draw.randrange(routes)}", bound(a), bound(a + draw.randrange(0, 80) / 2)

    left = spark.createDataFrame([row(i) for i in range(n)], "id int, route string, from_mp double, to_mp double")
    right = spark.createDataFrame([(*row(i)[1:], draw.choice([None, i % 5]), 2020 + i % 3) for i in range(n)], "route string, from_mp double, to_mp double, v int, year int")
    return left.repartition(5, "route"), right.repartition(5, "route")


def test_rows_compared_with_the_list_of_their_route(spark, monkeypatch):
    left, right = _dealt_sides(spark, 9, 400, 7)
    for few in (256, 40):  # some routes are longer than 40 rows, so the second time they meet by bins
        monkeypatch.setattr(intervals, "FEW", few)
        for strict in (True, False):
            apart, together = (intervals.best_overlap(left, right, "route", ["v", "year"], min_overlap=2.0, strict=strict, together=x) for x in (False, True))
            assert apart.columns == together.columns and sorted(map(repr, apart.collect())) == sorted(map(repr, together.collect()))
        apart, together = (intervals.yearly_values(left, right, "route", "id", "v", [2020, 2022], together=x) for x in (False, True))
        assert apart.columns == together.columns and sorted(map(repr, apart.collect())) == sorted(map(repr, together.collect()))
        apart, together = (intervals.fill_from_overlap(left.withColumn("a", F.lit(None).cast("int")), right, "route", {"a": "v"}, together=x) for x in (False, True))
        assert sorted(map(repr, apart.collect())) == sorted(map(repr, together.collect()))


def test_routes_that_are_dealt_are_not_shuffled_again(spark):
    """One shuffle of the table for the segments, and two (alike, so one is read twice) for the records; nothing else."""
    d = "/root/testdata/sf0.001"
    plan = references.history(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_COL") == 3
    plan = network._compared(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_COL") == 2
