"""Queries on slanted lines, polygons with holes and bent corridors.

Polygons are squares that stand on a corner, with a hole of the same kind: SQL clips a
line by their half-planes. Corridors have two legs: SQL solves where a line enters and
leaves the band and the end discs of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.scalars import round_even
from waymark.operators import corridors, spatial
from waymark.plans.adapters import made
from waymark.plans.places import _line

SLANTED = "SELECT c_custkey AS id, CAST((c_custkey * 7919) % 50000 AS DOUBLE) + 0.5 AS x0, CAST((c_custkey * 104729) % 50000 AS DOUBLE) + 0.5 AS y0, CAST(200 + (c_custkey % 9) * 130 AS DOUBLE) * CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE 1 END AS dx, CAST(150 + (c_custkey % 7) * 140 AS DOUBLE) * CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END AS dy FROM customer"
DIAMONDS = "SELECT n_nationkey AS k, CAST(n_nationkey % 5 AS DOUBLE) * 10000 + 4000.25 AS cx, CAST(floor(n_nationkey / 5) AS DOUBLE) * 10000 + 5000.25 AS cy, CAST(5200 + n_nationkey % 3 * 700 AS DOUBLE) AS r, CAST(1500 + n_nationkey % 4 * 300 AS DOUBLE) AS h FROM nation"
BENT = "SELECT n_nationkey AS k, CAST(n_nationkey AS DOUBLE) * 2100 + 130.0 AS y FROM nation"
REACH = 60.0


def _segments(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return made(spark, d, SLANTED).withColumn("line", _line((c("x0"), c("y0")), (c("x0") + c("dx"), c("y0") + c("dy"))))


def _diamonds(spark: SparkSession, d: str) -> DataFrame:
    c = F.col

    def ring(r: str):
        return _line((c("cx") + c(r), c("cy")), (c("cx"), c("cy") + c(r)), (c("cx") - c(r), c("cy")), (c("cx"), c("cy") - c(r)), (c("cx") + c(r), c("cy")))

    return made(spark, d, DIAMONDS).withColumn("rings", F.array(ring("r"), ring("h")))


def overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Lengths within polygons, polygons of midpoints, areas, shared areas, and lengths within reach of corridors."""
    c = F.col
    s, p = _segments(spark, d), _diamonds(spark, d)
    held = spatial.inside_lengths(s, "id", p, "k", 900.0).where("inside > 1e-3")
    stamped = spatial.stamp(s, "id", {"stamp": (p, "k", 900.0)}).where("stamp is not null")
    areas = spatial.polygon_areas(p, "k", 900.0)
    shared = spatial.shared_areas(p, "k", p.select(c("k").alias("l"), "rings"), "l", 900.0).where("k <= l and area > 1")
    lanes = made(spark, d, BENT).select(c("k").alias("corridor"), _line((0.0, c("y")), (25_000.0, c("y") + 770), (50_000.0, c("y") - 530)).alias("line"))
    near = corridors.length_within(s, "id", lanes, REACH).where("overlap_m > 1e-3")
    none = F.lit(0).cast("bigint")
    told = held.select(F.lit("inside").alias("kind"), c("id").cast("bigint").alias("id"), c("k").cast("bigint").alias("k"), round_even("inside", 3).alias("value"))
    told = told.unionByName(stamped.select(F.lit("stamp").alias("kind"), c("id").cast("bigint").alias("id"), c("stamp").cast("bigint").alias("k"), F.lit(0.0).alias("value")))
    told = told.unionByName(areas.select(F.lit("area").alias("kind"), c("k").cast("bigint").alias("id"), none.alias("k"), round_even("area", 3).alias("value")))
    told = told.unionByName(shared.where("k = l").select(F.lit("same").alias("kind"), c("k").cast("bigint").alias("id"), c("l").cast("bigint").alias("k"), round_even("area", 3).alias("value")))
    return told.unionByName(near.select(F.lit("corridor").alias("kind"), c("id").cast("bigint").alias("id"), c("corridor").cast("bigint").alias("k"), round_even("overlap_m", 3).alias("value")))


_SIGNS = "(VALUES (1, 1), (1, -1), (-1, 1), (-1, -1)) g(sx, sy)"


def _clipped(radius: str) -> str:
    """Length of a line within a square on its corner, by its four half-planes."""
    return f"""(SELECT id, k, greatest(0, least(1, min(CASE WHEN b > 0 THEN -a / b END)) - greatest(0, max(CASE WHEN b < 0 THEN -a / b END))) * any_value(n) AS m FROM
  (SELECT s.id, p.k, sqrt(dx * dx + dy * dy) AS n, sx * (x0 - cx) + sy * (y0 - cy) - {radius} AS a, sx * dx + sy * dy AS b FROM s CROSS JOIN p CROSS JOIN {_SIGNS}) GROUP BY id, k HAVING count(*) FILTER (b = 0 AND a > 0) = 0)"""


#: where a line enters and leaves the two discs and the band of a leg
_LEG = f"""SELECT id, k, leg, n, unnest([CASE WHEN r1 >= 0 THEN {{'a': (-b1 - sqrt(r1)) / q, 'b': (-b1 + sqrt(r1)) / q}} END, CASE WHEN r2 >= 0 THEN {{'a': (-b2 - sqrt(r2)) / q, 'b': (-b2 + sqrt(r2)) / q}} END,
  {{'a': greatest(least((-{REACH} - d0) / d1, ({REACH} - d0) / d1), least(-s0 / s1, (1 - s0) / s1)), 'b': least(greatest((-{REACH} - d0) / d1, ({REACH} - d0) / d1), greatest(-s0 / s1, (1 - s0) / s1))}}]) AS x FROM (
  SELECT id, k, leg, sqrt(q) AS n, q, b1, b1 * b1 - q * (wx * wx + wy * wy - {REACH} ** 2) AS r1, b2, b2 * b2 - q * (zx * zx + zy * zy - {REACH} ** 2) AS r2, (wx * vy - wy * vx) / m AS d0, (dx * vy - dy * vx) / m AS d1, (wx * vx + wy * vy) / m ** 2 AS s0, (dx * vx + dy * vy) / m ** 2 AS s1 FROM (
  SELECT s.id, l.k, leg, dx, dy, dx * dx + dy * dy AS q, x0 - px AS wx, y0 - py AS wy, x0 - qx AS zx, y0 - qy AS zy, (x0 - px) * dx + (y0 - py) * dy AS b1, (x0 - qx) * dx + (y0 - qy) * dy AS b2, qx - px AS vx, qy - py AS vy, sqrt((qx - px) ** 2 + (qy - py) ** 2) AS m
  FROM s JOIN (SELECT k, 1 AS leg, 0.0 AS px, y AS py, 25000.0 AS qx, y + 770 AS qy FROM c UNION ALL SELECT k, 2, 25000.0, y + 770, 50000.0, y - 530 FROM c) l ON abs(s.y0 - l.py) < 4000))"""
OVERLAPS_SQL = f"""WITH s AS ({SLANTED}), p AS ({DIAMONDS}), c AS ({BENT}), h AS (SELECT o.id, o.k, o.m - coalesce(i.m, 0) AS m FROM {_clipped("r")} o LEFT JOIN {_clipped("h")} i USING (id, k)),
t AS (SELECT s.id, min(p.k) AS k FROM s JOIN p ON abs(x0 + dx / 2 - cx) + abs(y0 + dy / 2 - cy) BETWEEN h AND r GROUP BY 1),
e AS (SELECT id, k, leg, any_value(n) AS n, min(greatest(0, x.a)) AS a, max(least(1, x.b)) AS b FROM ({_LEG}) WHERE x IS NOT NULL AND least(1, x.b) > greatest(0, x.a) GROUP BY 1, 2, 3),
f AS (SELECT id, k, any_value(n) AS n, min(a) AS lo, max(b) AS hi, max(a) AS second, min(b) AS first_end, count(*) AS legs FROM e GROUP BY 1, 2), g AS (SELECT id, k, n * (hi - lo - CASE WHEN legs = 2 AND (second - first_end) * n > 0.5 THEN second - first_end ELSE 0 END) AS m FROM f)
SELECT 'inside' AS kind, id, k, round_even(m, 3) AS value FROM h WHERE m > 1e-3 UNION ALL SELECT 'stamp', id, k, 0.0 FROM t UNION ALL SELECT 'area', k, 0, round_even(2 * r * r - 2 * h * h, 3) FROM p UNION ALL SELECT 'same', k, k, round_even(2 * r * r - 2 * h * h, 3) FROM p
UNION ALL SELECT 'corridor', id, k, round_even(m, 3) FROM g WHERE m > 1e-3"""

QUERIES = {"slanted_overlaps": (overlaps, OVERLAPS_SQL)}
