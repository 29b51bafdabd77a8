"""Queries on geometry, polygons, corridors, the road graph, service outputs and checks.

Lines run along the axes, polygons are boxes, so that SQL can state what is right in
closed form; slanted lines and other polygons are compared by brute force in the tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.functions import scalars as P
from waymark.functions.classify import FAMILIES
from waymark.functions.scalars import round_even
from waymark.operators import checks, corridors, graph, intervals, reports, service, spatial
from waymark.plans.adapters import SEGMENTS_SQL, made, segments
from waymark.plans.rules import _pick
from waymark.sources import tables

#: segments along an axis: a customer each
SEGMENTS = f"""SELECT c_custkey AS id, CAST((c_custkey * 7919) % 50000 AS DOUBLE) + 0.5 AS x0, CAST((c_custkey * 104729) % 50000 AS DOUBLE) + 0.5 AS y0, CASE WHEN c_custkey % 2 = 0 THEN CAST(300 + (c_custkey % 9) * 150 AS DOUBLE) ELSE 0.0 END AS dx, CASE WHEN c_custkey % 2 = 0 THEN 0.0 ELSE CAST(300 + (c_custkey % 7) * 130 AS DOUBLE) END AS dy,
  {_pick(["SR-1", "US-27", "CS-4", "SR-3", "RAMP", "CR-12", "I-16", None, "SR-9"], "c_custkey")} AS name, {_pick(["SR", "US", "CS", "SR", "RP", "CR", "I", "OT", "SR"], "c_custkey")} AS kind, {_pick(["State Route", "U.S. Route", "Local/Other", "State Route", "State Route", "Local/Other", "Interstate", None, "State Route"], "c_custkey")} AS family, {_pick(["1", "27", "4", "3", "0", "12", "16", "0", "9"], "c_custkey")} AS number FROM customer"""
#: overlapping boxes, one per nation
BOXES = "SELECT n_nationkey AS k, CAST(n_nationkey % 5 AS DOUBLE) * 10000 + 0.25 AS a, CAST(floor(n_nationkey / 5) AS DOUBLE) * 10000 + 0.25 AS c, CAST(n_nationkey % 5 AS DOUBLE) * 10000 + 9000.25 + CAST(n_nationkey % 3 AS DOUBLE) * 1500 AS b, CAST(floor(n_nationkey / 5) AS DOUBLE) * 10000 + 9500.25 + CAST(n_nationkey % 2 AS DOUBLE) * 800 AS d, 'Box ' || CAST(n_nationkey AS VARCHAR(9)) AS label, n_nationkey % 4 AS district FROM nation"
#: corridors across the whole extent, every 2,500 m
ROADS = f"""SELECT n_nationkey AS id, CAST(n_nationkey AS DOUBLE) * 2100 + 130.0 AS y, {_pick(["SR 1", "SR 3/US 27", None, "I 16", "Coast Way", "CR 12"], "n_nationkey")} AS name, {_pick(["Critical", "High", "Medium", "Low"], "n_nationkey")} AS tier FROM nation"""


def _line(*points: tuple[Column | float, Column | float]) -> Column:
    return F.array(*[G.point(x, y) for x, y in points])


def _segments(spark: SparkSession, d: str) -> DataFrame:
    s = made(spark, d, SEGMENTS)
    return s.withColumn("line", _line((F.col("x0"), F.col("y0")), (F.col("x0") + F.col("dx"), F.col("y0") + F.col("dy"))))


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    ring = _line((c("a"), c("c")), (c("b"), c("c")), (c("b"), c("d")), (c("a"), c("d")), (c("a"), c("c")))
    return made(spark, d, BOXES).withColumn("rings", F.array(ring))


def _roads(spark: SparkSession, d: str) -> DataFrame:
    return made(spark, d, ROADS).withColumn("line", _line((-5000.0, F.col("y")), (30000.0, F.col("y")), (60000.0, F.col("y"))))


BASE = f"WITH seg AS ({SEGMENTS}), box AS ({BOXES}), road AS ({ROADS})"
_HELD = """held AS (SELECT s.id, b.k, b.label, b.district, s.dx + s.dy AS n, CASE WHEN s.dx > 0 THEN CASE WHEN s.y0 BETWEEN b.c AND b.d THEN greatest(0, least(s.x0 + s.dx, b.b) - greatest(s.x0, b.a)) ELSE 0 END ELSE CASE WHEN s.x0 BETWEEN b.a AND b.b THEN greatest(0, least(s.y0 + s.dy, b.d) - greatest(s.y0, b.c)) ELSE 0 END END AS inside FROM seg s CROSS JOIN box b),
win AS (SELECT id, k, inside, inside / sum(inside) OVER (PARTITION BY id) AS share, inside >= 0.5 * n AS half FROM held WHERE inside > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY inside DESC, k) = 1)"""


def admin_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Midpoint stamp, winner with length and share, a city layer, the list of boxes, and where the outline is met."""
    s, b = _segments(spark, d), _boxes(spark, d)
    stamped = spatial.stamp(s, "id", {"stamp": (b, "k", 900.0)}).select("id", "stamp")
    won = spatial.overlay_winner(s, "id", b, "k", 900.0).select("id", F.col("k").alias("winner"), round_even("inside", 3).alias("inside"), round_even("share", 6).alias("share"))
    told = spatial.admin_overlay(s, "id", {"house": (b, "k", 900.0), "city": (b.where("k % 2 = 0"), "k", 900.0)}, "city").select("id", "house", "house_borderline", "city")
    listed = spatial.overlap_list(s.withColumn("major", F.when(F.col("id") % 5 == 0, "box 3")), "id", b, "k", "label", 900.0, "major")
    met = spatial.boundary_crossings(s.withColumns({"from_mp": F.lit(0.0), "to_mp": F.lit(10.0)}), "id", b, 900.0).groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("mp")), ",").alias("crossings"))
    return stamped.join(won, "id").join(told, "id").join(listed, "id").join(met, "id", "left")


ADMIN_SQL = f"""{BASE}, {_HELD}, mid AS (SELECT s.id, min(b.k) AS stamp FROM seg s JOIN box b ON s.x0 + s.dx / 2 BETWEEN b.a AND b.b AND s.y0 + s.dy / 2 BETWEEN b.c AND b.d GROUP BY 1),
cw AS (SELECT id, k, inside >= 0.5 * n AS half FROM held WHERE inside > 0 AND k % 2 = 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY inside DESC, k) = 1),
nm AS (SELECT id, string_agg(label, ', ' ORDER BY inside DESC, k) AS names FROM held WHERE inside >= 0.01 * n AND inside > 1e-4 AND NOT (id % 5 = 0 AND lower(label) = 'box 3') GROUP BY 1),
cr AS (SELECT s.id, CASE WHEN s.dx > 0 THEN (v - s.x0) / s.dx ELSE (v - s.y0) / s.dy END AS t FROM seg s JOIN (SELECT a, b, c, d, unnest([a, b]) AS v FROM box) b ON s.dx > 0 AND v BETWEEN s.x0 AND s.x0 + s.dx AND s.y0 BETWEEN b.c AND b.d
  UNION SELECT s.id, (v - s.y0) / s.dy FROM seg s JOIN (SELECT a, b, c, d, unnest([c, d]) AS v FROM box) b ON s.dy > 0 AND v BETWEEN s.y0 AND s.y0 + s.dy AND s.x0 BETWEEN b.a AND b.b),
cx AS (SELECT id, list_sort(list(DISTINCT round_even(10 * t, 4))) AS l FROM cr GROUP BY 1)
SELECT s.id, mid.stamp, win.k AS winner, round_even(win.inside, 3) AS inside, round_even(win.share, 6) AS share, win.k AS house, win.k IS NOT NULL AND win.share <= 0.51 AS house_borderline, CASE WHEN cw.half THEN cw.k END AS city,
  CASE WHEN s.id % 5 = 0 THEN concat_ws(', ', 'box 3', nm.names) ELSE nm.names END AS names, array_to_string(cx.l, ',') AS crossings
FROM seg s LEFT JOIN mid USING (id) LEFT JOIN win USING (id) LEFT JOIN cw USING (id) LEFT JOIN nm USING (id) LEFT JOIN cx USING (id)"""


def backfill(spark: SparkSession, d: str) -> DataFrame:
    s = _segments(spark, d).select("id", "line", F.when(F.col("id") % 4 == 0, "000").when(F.col("id") % 4 == 1, "7").alias("COUNTY_CODE"), F.when(F.col("id") % 3 == 0, 9).alias("DISTRICT"))
    counties = _boxes(spark, d).where("k % 3 <> 1").select(F.col("k").cast("string").alias("code"), F.col("district").cast("int").alias("district"), "rings")
    return spatial.county_backfill(s, "id", counties, 900.0).drop("line")


BACKFILL_SQL = f"""{BASE}, {_HELD}, h AS (SELECT id, CAST(k AS VARCHAR) AS code, district, inside FROM held WHERE k % 3 <> 1 AND inside > 0), m AS (SELECT id, code FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY inside DESC, code) = 1),
md AS (SELECT id, district FROM h GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY id ORDER BY sum(inside) DESC, district) = 1),
p AS (SELECT s.id, CAST(b.k AS VARCHAR) AS code, b.district, s.x0 + s.dx / 2 BETWEEN b.a AND b.b AND s.y0 + s.dy / 2 BETWEEN b.c AND b.d AS within_it, sqrt(greatest(b.a - (s.x0 + s.dx / 2), 0, s.x0 + s.dx / 2 - b.b) ** 2 + greatest(b.c - (s.y0 + s.dy / 2), 0, s.y0 + s.dy / 2 - b.d) ** 2) AS gap FROM seg s CROSS JOIN box b WHERE b.k % 3 <> 1),
n AS (SELECT id, code, district FROM p QUALIFY row_number() OVER (PARTITION BY id ORDER BY within_it DESC, gap, code) = 1),
g AS (SELECT id, CASE WHEN id % 4 = 0 THEN '000' WHEN id % 4 = 1 THEN '7' END AS cc, CASE WHEN id % 3 = 0 THEN 9 END AS dd FROM seg)
SELECT g.id, CASE WHEN cc = '000' THEN coalesce(m.code, '000') ELSE coalesce(cc, n.code) END AS "COUNTY_CODE", CASE WHEN cc = '000' THEN coalesce(dd, md.district) ELSE coalesce(dd, n.district) END AS "DISTRICT" FROM g LEFT JOIN m USING (id) LEFT JOIN md USING (id) LEFT JOIN n USING (id)"""

_GAP = "sqrt(greatest({0}.x0 - ({1}.x0 + {1}.dx), {1}.x0 - ({0}.x0 + {0}.dx), 0) ** 2 + greatest({0}.y0 - ({1}.y0 + {1}.dy), {1}.y0 - ({0}.y0 + {0}.dy), 0) ** 2)"


def distances(spark: SparkSession, d: str) -> DataFrame:
    """Other names, objects and priority lines near each segment, their score, and zones and corridors by distance."""
    s = _segments(spark, d)
    objects = s.where("id % 10 = 3").select(F.when(F.col("id") % 20 == 3, "port").otherwise("mill").alias("layer"), F.col("id").alias("object_id"), _line((F.col("x0"), F.col("y0"))).alias("line"))
    priority = _roads(spark, d).where("id % 6 = 0")
    told = spatial.connectivity_metrics(s.select("id", "name", "line"), "id", "name", objects, ["port", "mill"], priority, "id")
    flags = spatial.zone_flag(s.select("id", F.col("kind").alias("ROUTE_TYPE_GDOT"), "line"), "id", objects.where("object_id % 100 = 3").select(F.concat(F.lit("P"), F.col("object_id").cast("string")).alias("plant"), "line"), "plant", 4000.0)
    flags = spatial.corridor_near_flag(flags, "id", priority.withColumnRenamed("id", "road"), "road")
    return told.join(flags.select("id", "IS_NUCLEAR_EPZ_ROUTE", "NUCLEAR_EPZ_PLANT", "IS_GRIP_CORRIDOR"), "id").withColumn("per_sq_mi", round_even("per_sq_mi", 6))


DISTANCES_SQL = f"""{BASE}, c AS (SELECT a.id, count(DISTINCT b.name) AS connections FROM seg a JOIN seg b ON b.name <> a.name AND {_GAP.format("a", "b")} <= 1609.34 GROUP BY 1),
o AS (SELECT id, x0, y0, 0.0 AS dx, 0.0 AS dy FROM seg WHERE id % 10 = 3), g AS (SELECT a.id, count(*) AS n FROM seg a JOIN o ON {_GAP.format("a", "o")} <= 8046.7 GROUP BY 1),
r AS (SELECT y FROM road WHERE id % 6 = 0), near AS (SELECT s.id, min(greatest(r.y - (s.y0 + s.dy), s.y0 - r.y, 0)) AS gap FROM seg s CROSS JOIN r GROUP BY 1),
z AS (SELECT a.id, string_agg('P' || CAST(o.id AS VARCHAR), '; ' ORDER BY 'P' || CAST(o.id AS VARCHAR)) AS plants FROM seg a JOIN o ON o.id % 100 = 3 AND {_GAP.format("a", "o")} <= 4000 WHERE a.kind NOT IN ('CR', 'CS') GROUP BY 1),
m AS (SELECT s.id, s.kind, coalesce(c.connections, 0) AS connections, coalesce(g.n, 0) AS generators, coalesce(g.n, 0) / ((2 * 8046.7 * (s.dx + s.dy) + pi() * 8046.7 ** 2) / 1609.34 ** 2) AS per, near.gap <= 150 AS near_priority, near.gap, z.plants FROM seg s LEFT JOIN c USING (id) LEFT JOIN g USING (id) JOIN near USING (id) LEFT JOIN z USING (id)),
b AS (SELECT min(connections) AS a1, max(connections) AS b1, min(generators) AS a2, max(generators) AS b2 FROM m)
SELECT id, connections, generators, round_even(per, 6) AS per_sq_mi, near_priority, round_even(0.25 * (connections - a1) / (b1 - a1) + 0.25 * (generators - a2) / (b2 - a2) + 0.5 * CAST(near_priority AS INTEGER), 4) AS score, plants IS NOT NULL AS "IS_NUCLEAR_EPZ_ROUTE", plants AS "NUCLEAR_EPZ_PLANT", gap <= 50 AND kind NOT IN ('CR', 'CS') AS "IS_GRIP_CORRIDOR" FROM m, b"""


def official_tiers(spark: SparkSession, d: str) -> DataFrame:
    s = corridors.official_tier(_segments(spark, d), "id", _roads(spark, d), ["Critical", "High", "Medium", "Low"])
    return s.select("id", "official_tier")


def _near(r: float) -> str:
    """Length of a segment within ``r`` of a corridor; corridors reach beyond all segments."""
    return f"CASE WHEN s.dx > 0 THEN CASE WHEN abs(s.y0 - r.y) <= {r} THEN s.dx ELSE 0 END ELSE greatest(0, least(s.y0 + s.dy, r.y + {r}) - greatest(s.y0, r.y - {r})) END"


TIERS_SQL = f"""{BASE}, o AS (SELECT s.id, r.tier FROM seg s CROSS JOIN road r WHERE {_near(50)} >= 0.3 * (s.dx + s.dy))
SELECT s.id, coalesce((SELECT arg_min(tier, CASE tier WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END) FROM o WHERE o.id = s.id), 'Unclassified') AS official_tier FROM seg s"""


def corridor_matches(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate with the rule that rejects it, and, by corridor, what is left."""
    s, c = _segments(spark, d), corridors.build_corridors(_roads(spark, d), "id", "name")
    found = corridors.corridor_candidates(s, "id", c)
    prefixes = corridors.discover_prefixes(found, s, "id", "name", c)
    matches = corridors.corridor_match(found, s, "id", "name", "family", prefixes)
    rows = matches.select(F.lit("pair").alias("kind"), F.col("id").cast("string").alias("id"), "corridor", F.coalesce("reason", F.lit("-")).alias("told"), round_even("share", 6).alias("value"))
    qc = corridors.corridor_qc(matches, c).select(F.lit("corridor").alias("kind"), F.lit("").alias("id"), "corridor", F.when(F.col("none"), "none").when(F.col("few"), "few").otherwise("-").alias("told"), F.col("segments").cast("double").alias("value"))
    whole = corridors.collapse_matches(matches, "id", s, c).select(F.lit("match").alias("kind"), F.col("id").cast("string").alias("id"), F.array_join("corridors", "; ").alias("corridor"), round_even("portion", 4).cast("string").alias("told"), round_even("overlap_m", 3).alias("value"))
    return rows.unionByName(qc).unionByName(whole)


_CORRIDORS = f"""k AS (SELECT id AS rid, y, coalesce(name, '__UNNAMED__#' || CAST(id AS VARCHAR)) AS corridor FROM road), m0 AS (SELECT s.id, r.corridor, r.y, s.dx + s.dy AS n, {_near(50)} AS o, {_near(20)} AS t, s.name, s.family, s.dx FROM seg s CROSS JOIN k r),
m1 AS (SELECT id, corridor, n, sum(o) AS o, sum(t) AS t, any_value(upper(name)) AS name, coalesce(any_value(family) IN ('Interstate', 'U.S. Route', 'State Route'), false) AS state, any_value(dx) AS dx FROM m0 GROUP BY 1, 2, 3 HAVING sum(o) > 0),
px AS (SELECT corridor, name FROM m1 WHERE n >= 300 AND (t / n >= 0.7 OR (t >= 500 AND t / n >= 0.2)) AND name <> 'RAMP' UNION SELECT * FROM (VALUES ('SR 1', 'SR-1'), ('SR 3/US 27', 'SR-3'), ('SR 3/US 27', 'US-27'), ('I 16', 'I-16'), ('CR 12', 'CR-12'))),
m2 AS (SELECT m.*, EXISTS (SELECT 1 FROM px WHERE px.corridor = m.corridor) AS has, EXISTS (SELECT 1 FROM px WHERE px.corridor = m.corridor AND px.name = m.name) AS fits FROM m1 m),
m3 AS (SELECT *, CASE WHEN name = 'RAMP' THEN 'ramp' WHEN o / n < 0.2 THEN 'share' WHEN NOT state AND NOT ((n >= 200 AND o / n >= 0.8) OR (n >= 80 AND t / n >= 0.6 AND coalesce(name NOT LIKE 'CR-%', true))) THEN 'local' WHEN state AND has AND NOT fits THEN 'name' WHEN state AND n < 400 AND o / n < 0.7 THEN 'short'
  WHEN corridor LIKE '@_@_UNNAMED%' ESCAPE '@' AND t < 30 THEN 'unnamed' WHEN n > 10000 AND o / n < 0.5 THEN 'long' WHEN n >= 400 AND NOT (o / n > 0.5 OR o > 2000) AND dx = 0 THEN 'angle' ELSE '-' END AS reason FROM m2)"""
MATCH_SQL = f"""{BASE}, {_CORRIDORS}, c AS (SELECT corridor, count(*) FILTER (reason = '-') AS n FROM (SELECT DISTINCT corridor FROM k) LEFT JOIN m3 USING (corridor) GROUP BY 1),
w AS (SELECT id, string_agg(corridor, '; ' ORDER BY corridor) FILTER (corridor NOT LIKE '@_@_UNNAMED%' ESCAPE '@') AS names, max(o) AS o, any_value(n) AS n, sum(o) AS held FROM m3 WHERE reason = '-' GROUP BY 1)
SELECT 'pair' AS kind, CAST(id AS VARCHAR) AS id, corridor, reason AS told, round_even(o / n, 6) AS value FROM m3 UNION ALL SELECT 'corridor', '', corridor, CASE WHEN n = 0 THEN 'none' WHEN n < 3 THEN 'few' ELSE '-' END, CAST(n AS DOUBLE) FROM c
UNION ALL SELECT 'match', CAST(id AS VARCHAR), coalesce(names, ''), CAST(CASE WHEN held >= 30 AND held / n < 0.9 THEN round_even(held / n, 4) ELSE 1.0 END AS VARCHAR), round_even(o, 3) FROM w"""


def overlays(spark: SparkSession, d: str) -> DataFrame:
    """Contraflow, plain and hybrid overlays of the same lines."""
    s = _segments(spark, d).select("id", F.col("name").alias("HWY_NAME"), F.col("kind").alias("ROUTE_TYPE_GDOT"), F.col("family").alias("ROUTE_FAMILY"), F.col("number").cast("int").alias("BASE_ROUTE_NUMBER"), "line")
    r = _roads(spark, d).select(F.col("id").alias("road"), F.col("name").alias("title"), "line")
    a = corridors.contraflow_match(s, "id", r, "road", "title").select(F.lit("contraflow").alias("kind"), "id", F.array_join("names", "; ").alias("names"), round_even("overlap_m", 3).alias("overlap_m"), F.lit("").alias("method"))
    b = corridors.threshold_overlay(s, "id", r, "road", "title", by_family=True).select(F.lit("plain").alias("kind"), "id", F.array_join("names", "; ").alias("names"), round_even("overlap_m", 3).alias("overlap_m"), F.lit("").alias("method"))
    e = corridors.hybrid_overlay(s, "id", r, "road", "title").select(F.lit("hybrid").alias("kind"), "id", F.array_join("names", "; ").alias("names"), round_even("overlap_m", 3).alias("overlap_m"), "method")
    return a.unionByName(b).unionByName(e)


_NAMED = "string_agg(DISTINCT title, '; ' ORDER BY title)"
OVERLAYS_SQL = f"""{BASE}, p AS (SELECT s.*, r.name AS title, s.dx + s.dy AS n, {_near(30)} AS o, {_near(15)} AS q, coalesce(s.family IN ('Interstate', 'U.S. Route', 'State Route'), false) AS state FROM seg s CROSS JOIN road r),
f AS (SELECT *, CASE WHEN n < 400 THEN o / n >= 0.4 ELSE o >= 150 AND o / n >= 0.2 AND dx > 0 END AS fits FROM p WHERE o > 0),
h AS (SELECT *, (name = 'I-16' AND kind = 'I') OR (kind = 'SR' AND number IN ('1', '3')) OR (kind = 'US' AND number = '27') OR (kind = 'CR' AND number = '12') AS own, coalesce(title NOT IN ('Coast Way'), false) AS stated FROM f WHERE fits)
SELECT 'contraflow' AS kind, id, coalesce({_NAMED}, '') AS names, round_even(max(q), 3) AS overlap_m, '' AS method FROM p WHERE family = 'Interstate' AND q > 0 AND CASE WHEN n < 400 THEN q / n >= 0.6 ELSE q >= 200 AND q / n >= 0.3 AND dx > 0 END GROUP BY id
UNION ALL SELECT 'plain', id, coalesce({_NAMED}, ''), round_even(max(o), 3), '' FROM f WHERE fits AND (state OR NOT coalesce(title IN ('SR 1', 'SR 3/US 27', 'I 16'), false)) GROUP BY id
UNION ALL SELECT 'hybrid', id, coalesce({_NAMED}, ''), round_even(max(o), 3), CASE WHEN bool_or(stated AND own) THEN 'attribute+spatial' ELSE 'spatial_only' END FROM h WHERE NOT stated OR kind NOT IN ('CR', 'CS') OR (kind = 'CR' AND number = '12') GROUP BY id"""


def flagged_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Segments cut at flagged stretches; no piece is short enough to be absorbed."""
    s = _segments(spark, d).withColumns({"from_mp": F.lit(0.0), "to_mp": F.lit(10.0)})
    ranges = s.where("id % 3 <> 0").select("id", F.lit(60.0).alias("from_m"), (60.0 + (F.col("id") % 5) * 40).alias("to_m")).where("to_m > from_m")
    return corridors.split_flagged(s.select("id", "from_mp", "to_mp", "line"), "id", ranges).select("id", "piece", "from_mp", "to_mp", "flagged", round_even(G.line_length(F.col("line")), 3).alias("metres"))


PIECES_SQL = f"""{BASE}, s AS (SELECT id, dx + dy AS n, CASE WHEN id % 3 <> 0 AND id % 5 > 0 THEN 60.0 + (id % 5) * 40 END AS e FROM seg), p AS (SELECT id, n, unnest(CASE WHEN e IS NULL THEN [{{'i': 0, 'a': 0.0, 'b': n, 'f': false}}] ELSE [{{'i': 0, 'a': 0.0, 'b': 60.0, 'f': false}}, {{'i': 1, 'a': 60.0, 'b': e, 'f': true}}, {{'i': 2, 'a': e, 'b': n, 'f': false}}] END) AS x FROM s)
SELECT id, x.i AS piece, CASE WHEN x.a = 0 THEN 0.0 ELSE round_even(10 * x.a / n, 4) END AS from_mp, CASE WHEN x.b = n THEN 10.0 ELSE round_even(10 * x.b / n, 4) END AS to_mp, x.f AS flagged, round_even(x.b - x.a, 3) AS metres FROM p"""


#: segments close to the corridors, so that many have siblings, with a county each
NEAR = f"""SELECT c_custkey AS id, CAST((c_custkey * 7919) % 3000 AS DOUBLE) + 0.5 AS x0, CAST(c_custkey % 25 AS DOUBLE) * 2100 + 130.0 + CAST(floor(c_custkey / 25) % 11 - 5 AS DOUBLE) * 11.3 AS y0, CASE WHEN c_custkey % 6 <> 0 THEN CAST(60 + (c_custkey % 9) * 150 AS DOUBLE) ELSE 0.0 END AS dx, CASE WHEN c_custkey % 6 <> 0 THEN 0.0 ELSE CAST(20 + (c_custkey % 7) * 30 AS DOUBLE) END AS dy,
  {_pick(["SR-1", "US-27", "CS-4", "SR-3", "RAMP", "CR-12", "I-16", None, "SR-9", "CR-785"], "c_custkey")} AS name, {_pick(["SR", "US", "CS", "SR", "RP", "CR", "I", "OT", "SR", "CR"], "c_custkey")} AS kind, {_pick(["State Route", "U.S. Route", "Local/Other", "State Route", "State Route", "Local/Other", "Interstate", None, "State Route", "Local/Other"], "c_custkey")} AS family, 'C' || CAST(c_custkey % 3 AS VARCHAR(9)) AS county FROM customer"""
FORCED = [("SR 1", "CS-4", "C1"), ("SR 3/US 27", "CR-12", "C2"), ("Coast Way", "SR-9", "C2"), ("I 16", "CS-4", "C0")]


def corridor_filters(spark: SparkSession, d: str) -> DataFrame:
    """What of the matches has a sibling, follows its corridor or is exempt; what the cap on samples leaves; what rules add."""
    c = F.col
    s = made(spark, d, NEAR).withColumn("line", _line((c("x0"), c("y0")), (c("x0") + c("dx"), c("y0") + c("dy"))))
    lanes = corridors.build_corridors(_roads(spark, d), "id", "name")
    found = corridors.corridor_candidates(s, "id", lanes)
    matches = corridors.corridor_match(found, s, "id", "name", "family", corridors.discover_prefixes(found, s, "id", "name", lanes))
    kept = corridors.sibling_filter(matches, s, "id", "name", lanes)
    whole = corridors.collapse_matches(kept, "id")
    capped = corridors.hard_cap(whole, s, "id", lanes, 40.0)
    rules = spark.createDataFrame(FORCED, "corridor string, HWY_NAME string, COUNTY_NAME string")
    forced = corridors.forced_flags(capped, s.select("id", c("name").alias("HWY_NAME"), c("county").alias("COUNTY_NAME"), "line"), "id", lanes, rules, 40.0)
    told = kept.select(F.lit("kept").alias("kind"), "id", c("corridor").alias("told"), round_even("share", 6).alias("value"))
    told = told.unionByName(capped.select(F.lit("capped").alias("kind"), "id", F.array_join("corridors", "; ").alias("told"), round_even("overlap_m", 3).alias("value")))
    return told.unionByName(forced.select(F.lit("forced").alias("kind"), "id", F.concat_ws("/", F.array_join("corridors", "; "), "method").alias("told"), round_even("overlap_m", 3).alias("value")))


_SAMPLED = "unnest(range(11)) AS i"
FILTERS_SQL = f"""WITH seg AS ({NEAR}), road AS ({ROADS}), {_CORRIDORS}, k2 AS (SELECT m3.*, s.x0, s.y0, s.dx AS sx, s.dy AS sy FROM m3 JOIN seg s USING (id) WHERE reason = '-'),
loc AS (SELECT * FROM k2 WHERE NOT state AND corridor NOT LIKE '@_@_UNNAMED%' ESCAPE '@'), smp AS (SELECT id, corridor, name, n, sx, x0 + i * sx / 10 AS px, y0 + i * sy / 10 AS py, i FROM (SELECT *, {_SAMPLED} FROM loc)),
bes AS (SELECT id FROM smp p WHERE EXISTS (SELECT 1 FROM k2 s WHERE s.state AND s.corridor = p.corridor AND greatest(s.x0 - px, px - s.x0 - s.sx, 0) ** 2 + greatest(s.y0 - py, py - s.y0 - s.sy, 0) ** 2 <= 625) GROUP BY id, corridor HAVING count(*) / 11 >= 0.8),
fol AS (SELECT id FROM smp p WHERE coalesce(name NOT LIKE 'CR-%', true) AND n >= 80 AND sx > 0 AND EXISTS (SELECT 1 FROM k WHERE k.corridor = p.corridor AND abs(k.y - py) <= 20) GROUP BY id, corridor HAVING count(*) / 11 >= 0.6),
fine AS (SELECT id FROM bes UNION SELECT id FROM fol UNION SELECT id FROM loc WHERE name = 'CR-785'), kept AS (SELECT * FROM k2 WHERE id NOT IN (SELECT id FROM loc) OR id IN (SELECT id FROM fine)),
w AS (SELECT id, any_value(x0) AS x0, any_value(y0) AS y0, any_value(sy) AS sy, max(o) AS o, list_sort(list(corridor) FILTER (corridor NOT LIKE '@_@_UNNAMED%' ESCAPE '@')) AS names FROM kept GROUP BY 1),
cap AS (SELECT * FROM w WHERE EXISTS (SELECT 1 FROM k WHERE (names IS NULL OR list_contains(names, k.corridor)) AND greatest(abs(y0 - k.y), abs(y0 + sy - k.y)) <= 40)),
rul AS (SELECT * FROM (VALUES {", ".join(map(str, FORCED))}) v(corridor, name, county)), fs AS (SELECT s.id, r.corridor, y0 + i * s.dy / 10 AS py FROM (SELECT *, {_SAMPLED} FROM seg) s JOIN rul r USING (name, county)),
fn AS (SELECT id, corridor FROM fs WHERE EXISTS (SELECT 1 FROM k WHERE k.corridor = fs.corridor AND abs(k.y - py) <= 40) GROUP BY 1, 2 HAVING count(*) / 11 >= 0.7), ad AS (SELECT id, list(corridor) AS more FROM fn GROUP BY 1)
SELECT 'kept' AS kind, id, corridor AS told, round_even(o / n, 6) AS value FROM kept UNION ALL SELECT 'capped', id, coalesce(array_to_string(names, '; '), ''), round_even(o, 3) FROM cap
UNION ALL SELECT 'forced', coalesce(cap.id, ad.id), array_to_string(list_sort(list_distinct(list_concat(coalesce(names, []), coalesce(more, [])))), '; ') || '/' || CASE WHEN cap.id IS NOT NULL THEN 'spatial' ELSE 'concurrent_forced' END, coalesce(round_even(o, 3), 0) FROM cap FULL JOIN ad ON cap.id = ad.id"""


#: as above, but upright segments begin 49 m below a corridor and end 81 or 89 m above it, so that the part in reach is known
EVACUATED = NEAR.replace("130.0 + CAST(floor(c_custkey / 25) % 11 - 5 AS DOUBLE) * 11.3", "130.0 + CASE WHEN c_custkey % 6 = 0 THEN -49.0 ELSE CAST(floor(c_custkey / 25) % 11 - 5 AS DOUBLE) * 11.3 END").replace("CAST(20 + (c_custkey % 7) * 30 AS DOUBLE)", "CAST(130 + c_custkey % 4 * 4 AS DOUBLE)")


def evacuation(spark: SparkSession, d: str) -> DataFrame:
    """The whole evacuation path: matches, siblings, contraflow, cuts, DEC twins and new ids."""
    c = F.col
    s = made(spark, d, EVACUATED).withColumn("line", _line((c("x0"), c("y0")), (c("x0") + c("dx"), c("y0") + c("dy"))))
    s = s.select(c("id").cast("string").alias("unique_id"), F.concat(F.lit("R"), F.floor(c("id") / 2).cast("string"), F.when(c("id") % 2 == 0, "INC").otherwise("DEC")).alias("ROUTE_ID"), F.lit(0.0).alias("from_mp"), F.lit(1.0).alias("to_mp"), c("name").alias("HWY_NAME"), c("family").alias("ROUTE_FAMILY"), "line")
    r = _roads(spark, d)
    told = corridors.apply_evacuation(s, r.select("id", c("name").alias("ROUTE_NAME"), "line"), r.where("name = 'I 16'").select("id", c("name").alias("TITLE"), "line"))
    return told.drop("line", "HWY_NAME", "ROUTE_FAMILY").withColumns({x: round_even(x, 6) for x in ("SEC_EVAC_OVERLAP_M", "SEC_EVAC_OVERLAP_RATIO", "SEC_EVAC_MATCH_PORTION")})


EVACUATION_SQL = f"""{FILTERS_SQL[: FILTERS_SQL.index("w AS (SELECT id, any_value(x0)")].replace(NEAR, EVACUATED)}ev AS (SELECT id, list_sort(list(DISTINCT corridor) FILTER (corridor NOT LIKE '@_@_UNNAMED%' ESCAPE '@')) AS names, max(o) AS o, max(o / n) AS share, CASE WHEN max(o) >= 30 AND max(o / n) < 0.9 THEN max(o / n) ELSE 1.0 END AS portion FROM kept GROUP BY 1),
co AS (SELECT id, dx AS o FROM seg s WHERE family = 'Interstate' AND dx > 0 AND EXISTS (SELECT 1 FROM road r WHERE r.name = 'I 16' AND abs(r.y - s.y0) <= 15)),
al AS (SELECT s.id, 'R' || CAST(s.id // 2 AS VARCHAR) AS base, s.id % 2 = 0 AS inc, ev.id IS NOT NULL AS on_, co.id IS NOT NULL AS counter, ev.portion, s.dx + s.dy AS n, greatest(coalesce(ev.o, 0), coalesce(co.o, 0)) AS m, greatest(coalesce(ev.share, 0), CASE WHEN co.id IS NOT NULL THEN 1 ELSE 0 END) AS ratio,
  nullif(array_to_string(list_sort(list_distinct(list_concat(coalesce(ev.names, []), CASE WHEN co.id IS NOT NULL THEN ['I 16'] ELSE [] END))), '; '), '') AS title FROM seg s LEFT JOIN ev USING (id) LEFT JOIN co USING (id)),
pc AS (SELECT *, 0.0 AS f, CASE WHEN portion < 1 THEN round_even(portion, 4) ELSE 1.0 END AS t, on_ OR counter AS held FROM al UNION ALL SELECT *, round_even(portion, 4), 1.0, false FROM al WHERE portion < 1),
nw AS (SELECT id, base, inc, f, t, held AS "SEC_EVAC", held AND counter AS "SEC_EVAC_CONTRAFLOW", CASE WHEN held THEN title END AS "SEC_EVAC_ROUTE_NAME", CASE WHEN held THEN CASE WHEN on_ THEN 'gdot_eoc_hurricane_evacuation' ELSE 'gdot_eoc_contraflow' END END AS "SEC_EVAC_SOURCE", CASE WHEN held AND on_ THEN 'spatial' END AS "SEC_EVAC_MATCH_METHOD",
  CASE WHEN held THEN m ELSE 0.0 END AS "SEC_EVAC_OVERLAP_M", CASE WHEN held THEN ratio ELSE 0.0 END AS "SEC_EVAC_OVERLAP_RATIO", CASE WHEN held THEN portion END AS "SEC_EVAC_MATCH_PORTION" FROM pc),
mi AS (SELECT d.id, d.f, g AS giver FROM nw d JOIN nw g ON g.base = d.base AND g.inc AND NOT d.inc AND g."SEC_EVAC" AND NOT d."SEC_EVAC" AND least(d.t, g.t) - greatest(d.f, g.f) >= 0.01 QUALIFY row_number() OVER (PARTITION BY d.id, d.f ORDER BY least(d.t, g.t) - greatest(d.f, g.f) DESC, g.f) = 1)
SELECT nw.base || CASE WHEN nw.inc THEN 'INC' ELSE 'DEC' END AS "ROUTE_ID", nw.f AS from_mp, nw.t AS to_mp, nw.base || CASE WHEN nw.inc THEN 'INC' ELSE 'DEC' END || printf('_%.4f_%.4f', nw.f, nw.t) AS unique_id,
  {", ".join(f'CASE WHEN giver IS NOT NULL THEN giver."{x}" ELSE nw."{x}" END AS "{x}"' if "OVERLAP" not in x and "PORTION" not in x else f'round_even(CASE WHEN giver IS NOT NULL THEN giver."{x}" ELSE nw."{x}" END, 6) AS "{x}"' for x in corridors.EVACUATION)} FROM nw LEFT JOIN mi ON mi.id = nw.id AND mi.f = nw.f"""


STREETS = "SELECT c_custkey AS id, CAST(c_custkey % 20 AS DOUBLE) * 400 AS x0, CAST(floor(c_custkey / 20) AS DOUBLE) * 400 + CAST(c_custkey % 3 AS DOUBLE) AS y0, CASE c_custkey % 4 WHEN 0 THEN 400.0 WHEN 1 THEN 0.0 WHEN 2 THEN 20.0 ELSE 400.0 END AS dx, CASE c_custkey % 4 WHEN 1 THEN 400.0 WHEN 3 THEN 400.0 ELSE 0.0 END AS dy FROM customer"


def _streets(spark: SparkSession, d: str) -> DataFrame:
    return made(spark, d, STREETS).select("id", _line((F.col("x0"), F.col("y0")), (F.col("x0") + F.col("dx"), F.col("y0") + F.col("dy"))).alias("line"))


def road_graph(spark: SparkSession, d: str) -> DataFrame:
    edges = graph.road_edges(_streets(spark, d), "id")
    return edges.select("ax", "ay", "bx", "by", F.array_join(F.transform("segments", lambda x: x.cast("string")), ",").alias("segments"))


GRAPH_SQL = f"""WITH s AS ({STREETS}), e AS (SELECT id, round_even(x0 / 50, 0) * 50 AS x, round_even(y0 / 50, 0) * 50 AS y, round_even((x0 + dx) / 50, 0) * 50 AS u, round_even((y0 + dy) / 50, 0) * 50 AS v FROM s)
SELECT CASE WHEN (x, y) < (u, v) THEN x ELSE u END AS ax, CASE WHEN (x, y) < (u, v) THEN y ELSE v END AS ay, CASE WHEN (x, y) < (u, v) THEN u ELSE x END AS bx, CASE WHEN (x, y) < (u, v) THEN v ELSE y END AS "by", array_to_string(list_sort(list(id)), ',') AS segments FROM e WHERE (x, y) <> (u, v) GROUP BY 1, 2, 3, 4"""


#: a net of streets of which two fifths are missing, so that it has circles, bridges and leaves
NET = """SELECT c_custkey * 2 AS id, CAST(c_custkey % 30 AS DOUBLE) * 400 AS x0, CAST(floor(c_custkey / 30) AS DOUBLE) * 400 AS y0, 400.0 AS dx, 0.0 AS dy FROM customer WHERE (c_custkey * 7919 + floor(c_custkey / 30) * 31) % 10 < 6
  UNION ALL SELECT c_custkey * 2 + 1, CAST(c_custkey % 30 AS DOUBLE) * 400, CAST(floor(c_custkey / 30) AS DOUBLE) * 400, 0.0, 400.0 FROM customer WHERE (c_custkey * 104729 + floor(c_custkey / 30) * 17) % 10 < 6"""
#: seats in the net, between nodes, and beyond it, two of them too far from any node
SEATS = "SELECT 'Seat ' || lpad(CAST(n_nationkey AS VARCHAR(9)), 2, '0') AS seat, CASE WHEN n_nationkey = 23 THEN -9000.0 ELSE CAST(n_nationkey % 5 AS DOUBLE) * 3000 - 700 + CAST(n_nationkey AS DOUBLE) * 7 END AS x, CASE WHEN n_nationkey = 24 THEN -2900.0 ELSE CAST(floor(n_nationkey / 5) AS DOUBLE) * 4700 + 130 END AS y FROM nation"


def sole_connections(spark: SparkSession, d: str) -> DataFrame:
    """Bridges of the street net near seats, in circles of 3 km."""
    net = made(spark, d, NET).select("id", _line((F.col("x0"), F.col("y0")), (F.col("x0") + F.col("dx"), F.col("y0") + F.col("dy"))).alias("line"))
    return graph.sole_connections(graph.road_edges(net, "id"), made(spark, d, SEATS), 3_000.0, 1_300.0)


SOLE_SQL = f"""WITH RECURSIVE e AS (SELECT id AS eid, x0 AS ax, y0 AS ay, x0 + dx AS bx, y0 + dy AS "by" FROM ({NET})), s AS ({SEATS}), n AS (SELECT ax AS x, ay AS y FROM e UNION SELECT bx, "by" FROM e),
c AS (SELECT s.seat, n.x, n.y, (n.x - s.x) ** 2 + (n.y - s.y) ** 2 AS d FROM s CROSS JOIN n QUALIFY row_number() OVER (PARTITION BY s.seat ORDER BY (n.x - s.x) ** 2 + (n.y - s.y) ** 2, n.x, n.y) = 1),
g AS (SELECT c.seat, e.*, least((ax - c.x) ** 2 + (ay - c.y) ** 2, (bx - c.x) ** 2 + ("by" - c.y) ** 2) < 1300 ** 2 AS near FROM c JOIN e ON c.d <= 3000 ** 2 AND (ax - c.x) ** 2 + (ay - c.y) ** 2 <= 3000 ** 2 AND (bx - c.x) ** 2 + ("by" - c.y) ** 2 <= 3000 ** 2),
t AS (SELECT * FROM g WHERE near AND seat IN (SELECT seat FROM g GROUP BY 1 HAVING count(*) >= 3)),
way AS (SELECT seat, eid, ax AS x, ay AS y, bx AS u, "by" AS v FROM g UNION ALL SELECT seat, eid, bx, "by", ax, ay FROM g),
reach AS (SELECT seat, eid, ax AS x, ay AS y FROM t UNION SELECT r.seat, r.eid, w.u, w.v FROM reach r JOIN way w ON w.seat = r.seat AND w.x = r.x AND w.y = r.y AND w.eid <> r.eid)
SELECT CAST(t.eid AS VARCHAR) AS segment, string_agg(t.seat, '; ' ORDER BY t.seat) AS seats FROM t WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.seat = t.seat AND r.eid = t.eid AND r.x = t.bx AND r.y = t."by") GROUP BY t.eid"""


BENT = "SELECT c_custkey AS id, CAST(c_custkey % 700 AS DOUBLE) * 10 AS x, CAST(c_custkey % 900 AS DOUBLE) * 7 AS y, CAST(100 + c_custkey % 400 AS DOUBLE) AS u, CAST(50 + c_custkey % 300 AS DOUBLE) AS v FROM customer"


def measures(spark: SparkSession, d: str) -> DataFrame:
    """Lines of two legs, the second at a right angle to the first, measured; equal lines once, and dealt out, as measuring takes far longer than reading."""
    c, shape = F.col, ["x", "y", "u", "v"]
    rows = made(spark, d, BENT)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    s = rows.select(*shape).distinct().repartition(tasks).withColumn("line", _line((c("x"), c("y")), (c("x") + c("u"), c("y")), (c("x") + c("u"), c("y") + c("v"))))
    line, p = c("line"), G.point(c("x") + c("u") + 30, c("y") + c("v") / 2)
    at, part = G.line_interpolate(line, 0.75), G.line_substring(line, c("u") / 2, c("u") + c("v") / 2)
    merged = G.merge_parts(F.array(_line((c("x"), c("y")), (c("x") + c("u"), c("y"))), _line((c("x") + c("u"), c("y")), (c("x") + c("u"), c("y") + c("v"))), _line((0.0, 0.0), (1.0, 1.0))))
    lonlat = G.utm17_to_lonlat(G.point(500_000 + c("x"), 3_700_000 + c("y")))
    back = G.lonlat_to_utm17(lonlat["x"], lonlat["y"])
    thin = G.simplify(_line((c("x"), c("y")), (c("x") + c("u") / 2, c("y") + 0.5), (c("x") + c("u"), c("y")), (c("x") + c("u"), c("y") + c("v"))), 1.0)
    told = s.select(
        *shape, round_even(G.line_length(line), 6).alias("metres"), round_even(G.line_miles(line), 9).alias("miles"), round_even(at["x"], 6).alias("at_x"), round_even(at["y"], 6).alias("at_y"), F.size(part).alias("part_points"), round_even(G.line_length(part), 6).alias("part_metres"),
        round_even(G.line_project(line, p), 6).alias("along"), round_even(G.point_line_distance(line, p), 6).alias("gap"), round_even(G.line_distance(line, _line((c("x"), c("y") - 25))), 6).alias("apart"), round_even(G.azimuth(line), 9).alias("azimuth"), round_even(G.alignment_angle(G.azimuth(line), F.lit(200.0)), 9).alias("angle"),
        F.size(merged).alias("parts"), round_even(G.line_length(G.longest_part(merged)), 6).alias("longest"), F.size(thin).alias("kept_points"), round_even(G.snap(c("x"), 25.0), 6).alias("snapped"), F.size(G.line_cells(line, 100.0)).alias("cells"),
        (F.hypot(back["x"] - 500_000 - c("x"), back["y"] - 3_700_000 - c("y")) < 1e-2).alias("round_trip"),
        # metres per degree from the ellipsoid's radii at the place, against the projection's own, the scale there divided out
        (F.abs(F.radians(lonlat["x"] + 81) * F.cos(F.radians(lonlat["y"])) * (6378137.0 / F.sqrt(1 - 0.0066943799901413165 * F.pow(F.sin(F.radians(lonlat["y"])), 2))) * 0.9996 - c("x")) < 0.05).alias("in_scale"),
    )
    return rows.join(told, shape).drop(*shape)


MEASURES_SQL = f"""WITH s AS ({BENT}) SELECT id, u + v AS metres, round_even((u + v) / 1609.344, 9) AS miles, round_even(x + least(u, 0.75 * (u + v)), 6) AS at_x, round_even(y + greatest(0, 0.75 * (u + v) - u), 6) AS at_y, 3 AS part_points, round_even(u / 2 + v / 2, 6) AS part_metres, round_even(u + v / 2, 6) AS along, CAST(30.0 AS DOUBLE) AS gap, CAST(25.0 AS DOUBLE) AS apart,
  round_even(degrees(atan2(u, v)), 9) AS azimuth, round_even(abs(degrees(atan2(u, v)) - 20), 9) AS angle, 2 AS parts, u + v AS longest, 3 AS kept_points, round_even(x / 25, 0) * 25 AS snapped,
  CAST(floor((x + u) / 100) - floor(x / 100) + 1 + floor((y + v) / 100) - floor(y / 100) AS INTEGER) AS cells, true AS round_trip, true AS in_scale FROM s"""

def segment_lines(spark: SparkSession, d: str) -> DataFrame:
    """Routes of two legs cut at interval ends and crossings, with their part of the line and the record that covers it."""
    c = F.col
    r = made(spark, d, BENT).select("id", F.lit(0.0).alias("from_mp"), F.lit(10.0).alias("to_mp"), _line((c("x"), c("y")), (c("x") + c("u"), c("y")), (c("x") + c("u"), c("y") + c("v"))).alias("line"))
    cut = (3 + c("id") % 6).cast("double")
    rows = r.select("id", F.inline(F.array(F.struct(F.lit(0.0).alias("from_mp"), F.lit(2.5).alias("to_mp"), F.lit("a").alias("told")), F.struct(F.lit(2.5).alias("from_mp"), cut.alias("to_mp"), F.lit("b").alias("told")))))
    crossings = r.where("id % 3 = 0").select("id", F.lit(5.0).alias("mp"))
    told = intervals.segment_lines(r, rows, ["told"], crossings, "id")
    first, last = F.element_at("line", 1), F.element_at("line", -1)
    return told.select("id", "piece", "from_mp", "to_mp", "told", F.size("line").alias("points"), round_even(G.line_length(c("line")), 6).alias("metres"), *[round_even(p[k], 6).alias(f"{n}_{k}") for n, p in (("first", first), ("last", last)) for k in "xy"])


LINES_SQL = f"""WITH s AS ({BENT}), c AS (SELECT *, list_sort(list_distinct([0.0, 2.5, 3.0 + id % 6, CASE WHEN id % 3 = 0 THEN 5.0 ELSE 10.0 END, 10.0]::DOUBLE[])) AS m FROM s),
p AS (SELECT *, i - 1 AS piece, m[i] AS from_mp, m[i + 1] AS to_mp, m[i] / 10 * (u + v) AS d, m[i + 1] / 10 * (u + v) AS e FROM (SELECT *, unnest(range(1, len(m))) AS i FROM c))
SELECT id, piece, from_mp, to_mp, CASE WHEN to_mp <= 2.5 THEN 'a' WHEN from_mp >= 2.5 AND to_mp <= 3 + id % 6 THEN 'b' END AS told, CASE WHEN d < u AND e > u THEN 3 ELSE 2 END AS points, round_even(e - d, 6) AS metres,
  round_even(x + least(d, u), 6) AS first_x, round_even(y + greatest(d - u, 0), 6) AS first_y, round_even(x + least(e, u), 6) AS last_x, round_even(y + greatest(e - u, 0), 6) AS last_y FROM p"""

PLOTS = "SELECT s_suppkey AS id, CAST((s_suppkey * 719) % 9000 AS DOUBLE) + 7.0 AS x0, CAST((s_suppkey * 331) % 9000 AS DOUBLE) + 7.0 AS y0, CAST(200 + s_suppkey % 300 AS DOUBLE) AS dx, 0.0 AS dy FROM supplier"
GROUPS = "SELECT lpad(CAST(n_nationkey AS VARCHAR(9)), 12, '0') AS geoid, CAST(n_nationkey % 6 AS VARCHAR(9)) AS county, CAST(n_nationkey % 5 AS DOUBLE) * 2000 + 3.0 AS a, CAST(floor(n_nationkey / 5) AS DOUBLE) * 2000 + 3.0 AS c, CAST(n_nationkey * 100 AS DOUBLE) AS population FROM nation"
BLOCKS = "SELECT lpad(CAST(c_custkey % 25 AS VARCHAR(9)), 12, '0') || '001' AS w_geocode, CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE CAST(c_custkey % 50 AS VARCHAR(9)) END AS jobs FROM customer"


def densities(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    s = made(spark, d, PLOTS).withColumn("line", _line((c("x0"), c("y0")), (c("x0") + c("dx"), c("y0"))))
    jobs = spatial.jobs_by_block_group(made(spark, d, BLOCKS), jobs="jobs")
    ring = _line((c("a"), c("c")), (c("a") + 2000, c("c")), (c("a") + 2000, c("c") + 2000), (c("a"), c("c") + 2000), (c("a"), c("c")))
    groups = made(spark, d, GROUPS).withColumn("rings", F.array(ring)).join(jobs, "geoid", "left")
    projections = made(spark, d, "SELECT CAST(r_regionkey AS VARCHAR(9)) AS county, CAST(100 + r_regionkey AS VARCHAR(9)) AS p2020, CAST(150 + r_regionkey * 7 AS VARCHAR(9)) AS p2050 FROM region WHERE r_regionkey < 4").toDF("county", "2020", "2050")
    factors, other = spatial.growth_factors(projections)
    told = spatial.density_metrics(s.select("id", "line"), "id", groups.select("geoid", "county", "population", "jobs", "rings"), factors, other, radius=800.0)
    return told.drop("line")


#: what a box takes of a strip between two chords' heights: an antiderivative of clamp(z, a, b) over z
_CLAMPED = "CASE WHEN {z} < a THEN a * {z} WHEN {z} <= b THEN ({z} * {z} + a * a) / 2 ELSE b * {z} + (a * a - b * b) / 2 END"


def _mean(u: str, v: str) -> str:
    """Mean of clamp over z from ``u`` to ``v``, times the strip's height."""
    return f"(y2 - y1) * CASE WHEN abs({u} - {v}) < 1e-9 THEN greatest(a, least(b, {u})) ELSE (({_CLAMPED.format(z=v)}) - ({_CLAMPED.format(z=u)})) / ({v} - {u}) END"


#: a buffer of a level line is strips between the heights of its chords' ends; in each both sides are straight
DENSITIES_SQL = f"""WITH s AS ({PLOTS}), g AS ({GROUPS}), j AS (SELECT left(w_geocode, 12) AS geoid, sum(coalesce(TRY_CAST(jobs AS DOUBLE), 0)) AS jobs FROM ({BLOCKS}) GROUP BY 1),
h AS (SELECT i, 800 * sin(pi() * (i / 32 - 0.5)) AS u1, 800 * sin(pi() * ((i + 1) / 32 - 0.5)) AS u2, 800 * cos(pi() * (i / 32 - 0.5)) AS w1, 800 * cos(pi() * ((i + 1) / 32 - 0.5)) AS w2 FROM generate_series(0, 31) t(i)),
p AS (SELECT s.id, g.geoid, g.county, g.population, g.a, g.a + 2000 AS b, s.x0, s.x0 + s.dx AS x1, u1, u2, w1, w2, greatest(g.c, s.y0 + u1) - s.y0 AS y1, least(g.c + 2000, s.y0 + u2) - s.y0 AS y2 FROM s CROSS JOIN g CROSS JOIN h WHERE greatest(g.c, s.y0 + u1) < least(g.c + 2000, s.y0 + u2)),
q AS (SELECT *, w1 + (y1 - u1) / (u2 - u1) * (w2 - w1) AS v1, w1 + (y2 - u1) / (u2 - u1) * (w2 - w1) AS v2 FROM p), e AS (SELECT *, x1 + v1 AS r1, x1 + v2 AS r2, x0 - v1 AS l1, x0 - v2 AS l2 FROM q),
m AS (SELECT id, geoid, any_value(county) AS county, any_value(population) AS p, sum({_mean("r1", "r2")} - {_mean("l1", "l2")}) / 4e6 AS w FROM e GROUP BY 1, 2),
f AS (SELECT CAST(r_regionkey AS VARCHAR) AS county, (150 + r_regionkey * 7) / (100 + r_regionkey) AS f FROM region WHERE r_regionkey < 4),
t AS (SELECT m.id, sum(w * m.p) AS p, sum(w * coalesce(j.jobs, 0)) AS e, sum(w * m.p * coalesce(f.f, 1.15)) AS later FROM m LEFT JOIN j USING (geoid) LEFT JOIN f USING (county) WHERE w > 0 GROUP BY 1), area AS (SELECT id, (1600 * dx + 32 * 640000 * sin(pi() / 32)) / 1609.344 ** 2 AS a FROM s)
SELECT s.id, coalesce(round_even(t.p / a, 2), 0) AS population_density, coalesce(round_even(t.e / a, 2), 0) AS employment_density, coalesce(round_even(t.later / a, 2), 0) AS population_density_2050, coalesce(round_even(t.e * 1.10 / a, 2), 0) AS employment_density_2050 FROM s LEFT JOIN t USING (id) LEFT JOIN area USING (id)"""

QUERIES = {
    "admin_overlay": (admin_overlay, ADMIN_SQL),
    "county_backfill": (backfill, BACKFILL_SQL),
    "connectivity_metrics": (distances, DISTANCES_SQL),
    "official_tier": (official_tiers, TIERS_SQL),
    "corridor_match": (corridor_matches, MATCH_SQL),
    "corridor_overlays": (overlays, OVERLAYS_SQL),
    "corridor_filters": (corridor_filters, FILTERS_SQL),
    "split_flagged": (flagged_pieces, PIECES_SQL),
    "apply_evacuation": (evacuation, EVACUATION_SQL),
    "road_graph": (road_graph, GRAPH_SQL),
    "sole_connections": (sole_connections, SOLE_SQL),
    "geometry_measures": (measures, MEASURES_SQL),
    "segment_lines": (segment_lines, LINES_SQL),
    "density_metrics": (densities, DENSITIES_SQL),
}
