import math

from pyspark.sql import functions as F

from waymark.functions import geometry as G

BOX = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]


def line(*points):
    return F.array(*[G.point(x, y) for x, y in points])


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_lines(spark):
    bent = line((0, 0), (3, 0), (3, 4))
    got = value(spark, F.struct(G.line_length(bent).alias("n"), G.line_interpolate(bent, 0.5).alias("m"), G.line_substring(bent, F.lit(1.0), F.lit(5.0)).alias("s"), G.line_project(bent, G.point(4, 2)).alias("p"), G.point_line_distance(bent, G.point(4, 2)).alias("d"), G.azimuth(line((0, 0), (1, 1))).alias("z"), G.alignment_angle(F.lit(350.0), F.lit(10.0)).alias("a")))
    assert (got.n, tuple(got.m), got.p, got.d) == (7.0, (3.0, 0.5), 5.0, 1.0)
    assert [tuple(p) for p in got.s] == [(1.0, 0.0), (3.0, 0.0), (3.0, 2.0)]
    assert math.isclose(got.z, 45.0) and math.isclose(got.a, 20.0)


def test_parts_and_simplify(spark):
    parts = F.array(line((0, 0), (1, 0)), line((1, 0), (2, 0)), line((5, 5), (9, 5)))
    got = value(spark, F.struct(G.merge_parts(parts).alias("m"), G.longest_part(parts).alias("l"), G.simplify(line((0, 0), (1, 0.01), (2, 1), (3, 0)), 0.5).alias("s")))
    assert [len(p) for p in got.m] == [3, 2] and tuple(got.l[1]) == (9.0, 5.0)
    assert [tuple(p) for p in got.s] == [(0.0, 0.0), (2.0, 1.0), (3.0, 0.0)]


def test_polygon_with_hole(spark):
    rings = F.array(*[line(*r) for r in BOX])
    for p, inside in (((3, 3), True), ((1.5, 1.5), False), ((4, 2), True), ((1, 1.5), True), ((5, 1), False), ((0, 0), True)):
        assert value(spark, G.in_rings(G.point(*p), rings)) == inside


def test_crossings_and_cells(spark):
    a, b = line((0, 0), (4, 0)), line((1, -1), (1, 1))
    assert value(spark, G.edge_crossings(F.get(G.edges(a), 0), F.get(G.edges(b), 0))) == 0.25
    assert value(spark, G.edge_crossings(F.get(G.edges(a), 0), F.get(G.edges(a), 0))) is None
    assert {tuple(c) for c in value(spark, G.line_cells(a, 2.0))} == {(0, 0), (1, 0), (2, 0)}


def test_projection_round_trip(spark):
    # the central meridian at the equator's northing of zero, and a known arc of the meridian
    p = value(spark, G.lonlat_to_utm17(F.lit(-81.0), F.lit(0.0)))
    assert abs(p.x - 500000) < 1e-6 and abs(p.y) < 1e-6
    quarter = value(spark, G.lonlat_to_utm17(F.lit(-81.0), F.lit(90.0 - 1e-9)))
    assert abs(quarter.y / 0.9996 - 10001965.729) < 0.01
    for lon, lat in ((-84.39, 33.75), (-81.1, 32.08), (-85.6, 34.98), (-80.84, 30.36)):
        q = value(spark, G.utm17_to_lonlat(G.lonlat_to_utm17(F.lit(lon), F.lit(lat))))
        assert abs(q.x - lon) < 1e-8 and abs(q.y - lat) < 1e-8


def test_crossings_at_half_a_decimal(spark):
    from waymark.operators import spatial

    def line(*at):
        return [{"x": float(x), "y": float(y)} for x, y in at]

    def box(x):
        return [line((x, -9000.75), (x + 9000, -9000.75), (x + 9000, 9000.25), (x, 9000.25), (x, -9000.75))]

    shape = "array<struct<x:double,y:double>>"
    # 10 * (39.75 / 1200) and 10 * (909.75 / 1200): the products lie beside the tie or on it
    for at in (39.75, 109.75, 879.75, 909.75, 1029.75):
        route = spark.createDataFrame([(1, 0.0, 10.0, line((0.5, 0.5), (1200.5, 0.5)))], f"k int, from_mp double, to_mp double, line {shape}")
        boxes = spark.createDataFrame([(box(at + 0.5),)], f"rings array<{shape}>")
        assert [r.mp for r in spatial.boundary_crossings(route, "k", boxes, 900.0).collect()] == [round(at / 1200 * 10 * 1e4) / 1e4]
