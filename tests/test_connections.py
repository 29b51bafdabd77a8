"""Names and objects near lines: compared with all pairs, and without them where places repeat."""

import random
import time

from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.operators import spatial


def _line(*points):
    return F.array(*[G.point(x, y) for x, y in points])


def _rows(spark, rows, schema):
    return spark.createDataFrame([(*r[:-1], [{"x": float(x), "y": float(y)} for x, y in r[-1]]) for r in rows], schema + ", line array<struct<x:double,y:double>>")


def test_counts_equal_those_of_all_pairs(spark):
    draw = random.Random(3)

    def path(n, step):
        x, y = draw.uniform(-4000, 4000), draw.uniform(-4000, 4000)
        points = [(x, y)]
        for _ in range(n - 1):
            x, y = x + draw.uniform(-step, step), y + draw.uniform(-step, step)
            points.append((x, y))
        return points

    lines = _rows(spark, [(i, f"N{i % 11}" if i % 7 else None, path(1 + i % 4, 900)) for i in range(60)], "id int, name string")
    objects = [("port" if i % 3 else "mill", i, path(1 + i % 3, (5, 3000)[i % 2])) for i in range(90)]
    # an object may have several rows, or repeat one
    objects = _rows(spark, objects + objects[:9] + [("port", 1, path(1, 0)), ("mill", 3, path(2, 10))], "layer string, object_id int")
    near = lines.alias("a").crossJoin(objects.select("layer", "object_id", F.col("line").alias("other"))).where(G.line_distance(F.col("line"), F.col("other")) <= 1500).select("id", "layer", "object_id").distinct()
    want = {(r.id, r.layer): r["count"] for r in near.groupBy("id", "layer").count().collect()}
    got = spatial.buffer_counts(lines, "id", objects, 1500.0, ["port", "mill"]).collect()
    assert len(got) == 60 and {(r.id, n): r[n] for r in got for n in ("port", "mill") if r[n]} == want
    assert all(r.total == r.port + r.mill for r in got)
    pairs = lines.crossJoin(lines.select(F.col("name").alias("n"), F.col("line").alias("other"))).where((F.col("n") != F.col("name")) & (G.line_distance(F.col("line"), F.col("other")) <= 700))
    want = {r.id: r.c for r in pairs.groupBy("id").agg(F.count_distinct("n").alias("c")).collect()}
    got = spatial.degrees_of_connection(lines, "id", "name", 700.0).collect()
    assert len(got) == 60 and {r.id: r.connections for r in got if r.connections} == want


def test_repeated_places_are_counted_without_their_pairs(spark):
    n = 30_000
    lines = spark.range(n).select("id", F.concat(F.lit("N"), (F.col("id") % 5).cast("string")).alias("name"), _line((F.col("id") % 10, 0.5), (F.col("id") % 10 + 300, 0.5)).alias("line"))
    objects = spark.range(n).select(F.lit("port").alias("layer"), F.col("id").alias("object_id"), _line((F.col("id") % 10, 8.5)).alias("line"))
    began = time.time()
    assert spatial.buffer_counts(lines, "id", objects, 8000.0, ["port"]).groupBy("total").count().collect() == [(n, n)]
    assert spatial.degrees_of_connection(lines, "id", "name").groupBy("connections").count().collect() == [(4, n)]
    assert time.time() - began < 90  # 9e8 pairs each take far longer


def test_lines_are_never_broadcast(spark):
    """The planner takes an exploded row for one, and would send the cells of all lines to the driver."""
    lines = spark.range(2000).select("id", _line((F.col("id"), 0.5), (F.col("id") + 300, 0.5)).alias("line"))
    sites = spark.range(4000).select(F.col("id").alias("site"), F.lit("x").alias("more"), _line((F.col("id"), 8.5)).alias("line")).where("site % 1000 = 3")
    near = spatial.within_distance(lines, "id", sites, "site", 100.0)
    assert "BuildLeft" not in near._jdf.queryExecution().executedPlan().toString()
    assert near.groupBy("site").count().count() == 3
    counted = spatial.buffer_counts(lines, "id", sites.select(F.lit("port").alias("layer"), F.col("site").alias("object_id"), "line"), 100.0, ["port"])
    assert "BuildLeft" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.agg(F.sum("port")).first()[0] == near.count()


def test_names_of_sites_at_the_same_place(spark):
    lines = _rows(spark, [(1, "SR", [(0, 0), (9, 0)]), (2, "CR", [(0, 0), (9, 0)]), (3, None, [(500, 0), (509, 0)])], "id int, ROUTE_TYPE_GDOT string")
    sites = _rows(spark, [("b", [(4, 5)]), ("a", [(4, 5)]), ("b", [(4, 5)]), ("c", [(6, 5)]), ("a", [(6, 5)])], "plant string")
    got = {r.id: (r.IS_NUCLEAR_EPZ_ROUTE, r.NUCLEAR_EPZ_PLANT) for r in spatial.zone_flag(lines, "id", sites, "plant", 6.0).collect()}
    assert got == {1: (True, "a; b; c"), 2: (False, None), 3: (False, None)}
