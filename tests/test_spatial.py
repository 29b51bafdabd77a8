import math
import random

from pyspark.sql import functions as F

from waymark.operators import graph, spatial
from waymark.sources import tables

LINE = "array<struct<x:double,y:double>>"


def box(x0, y0, x1, y1):
    return [[(float(a), float(b)) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]


def test_polygons(spark):
    polygons = spark.createDataFrame([("a", box(0, 0, 1, 1)), ("b", box(1, 0, 2, 1))], f"poly string, rings array<{LINE}>")
    lines = spark.createDataFrame([(1, [(0.5, 0.5), (1.5, 0.5)], 0.0, 1.0), (2, [(0.8, 0.5), (1.8, 0.5)], 0.0, 1.0), (3, [(5.0, 5.0), (6.0, 5.0)], 0.0, 1.0)], f"id int, line {LINE}, from_mp double, to_mp double")
    got = {r.id: (r.poly, None if r.share is None else round(r.share, 6)) for r in spatial.overlay_winner(lines, "id", polygons, "poly", 0.7).collect()}
    assert got == {1: ("a", 0.5), 2: ("b", 0.8), 3: (None, None)}
    named = polygons.withColumn("name", F.upper("poly"))
    listed = {r.id: r.names for r in spatial.overlap_list(lines.withColumn("major", F.when(F.col("id") == 2, " a ")), "id", named, "poly", "name", 0.7, "major").collect()}
    assert listed == {1: "A, B", 2: "a, B", 3: None}
    assert {(r.id, r.mp) for r in spatial.boundary_crossings(lines, "id", polygons, 0.7).collect()} == {(1, 0.5), (2, 0.2)}
    points = lines.select("id", F.element_at("line", 1).alias("p"))
    assert {r.id: r.poly for r in spatial.point_in_polygon(points, "id", polygons, "poly", 0.7).collect()} == {1: "a", 2: "a", 3: None}


def test_border_stretch_gives_both_ends(spark):
    polygons = spark.createDataFrame([("a", box(0, 0, 2, 1))], f"poly string, rings array<{LINE}>")
    route = spark.createDataFrame([(1, [(-1.0, 1.0), (3.0, 1.0)], 0.0, 4.0)], f"id int, line {LINE}, from_mp double, to_mp double")
    assert {r.mp for r in spatial.boundary_crossings(route, "id", polygons, 0.7).collect()} == {1.0, 3.0}


def test_membership_by_brute_force(spark):
    """Random polygons, with a hole, against even-odd counts; lengths against fine samples; nearest outlines."""
    r = random.Random(5)

    def star(x, y, n, size):
        turns = sorted(r.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(x + math.cos(t) * size * r.uniform(0.4, 1), y + math.sin(t) * size * r.uniform(0.4, 1)) for t in turns]
        return [*ring, ring[0]]

    polygons = {f"p{i}": [star(r.uniform(0, 30), r.uniform(0, 30), 9, r.uniform(2, 9))] for i in range(6)}
    polygons["p0"].append([(p[0] * 0.1 + 13, p[1] * 0.1 + 13) for p in polygons["p0"][0]])

    def inside(x, y, rings):
        odd = False
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                    odd = not odd
        return odd

    df = spark.createDataFrame([(k, v) for k, v in polygons.items()], f"poly string, rings array<{LINE}>")
    points = [(i, (r.uniform(-5, 35), r.uniform(-5, 35))) for i in range(400)]
    pdf = spark.createDataFrame(points, "id int, p struct<x:double,y:double>")
    got = {x.id: x.poly for x in spatial.point_in_polygon(pdf, "id", df, "poly", 1.7).collect()}
    assert got == {i: min((k for k, v in polygons.items() if inside(*p, v)), default=None) for i, p in points}
    lines = [(i, [(r.uniform(0, 30), r.uniform(0, 30)) for _ in range(3)]) for i in range(12)]
    ldf = spark.createDataFrame(lines, f"id int, line {LINE}")
    found = {(x.id, x.poly): x.inside for x in spatial.inside_lengths(ldf, "id", df, "poly", 1.7).collect()}
    for i, line in lines:
        for k, rings in polygons.items():
            want = 0.0
            for (ax, ay), (bx, by) in zip(line, line[1:]):
                n = 4000
                want += math.hypot(bx - ax, by - ay) * sum(inside(ax + (j + 0.5) / n * (bx - ax), ay + (j + 0.5) / n * (by - ay), rings) for j in range(n)) / n
            assert abs(found.get((i, k), 0.0) - want) < 0.05
    far = spark.createDataFrame([(1, (500.0, 10.0)), (2, (-40.0, -3.0))], "id int, p struct<x:double,y:double>")

    def gap(p, rings):
        out = []
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                t = max(0, min(1, ((p[0] - ax) * (bx - ax) + (p[1] - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
                out.append(math.hypot(ax + t * (bx - ax) - p[0], ay + t * (by - ay) - p[1]))
        return min(out)

    near = {x.id: x.poly for x in spatial.nearest_polygon(far, "id", df, "poly", 1.7).collect()}
    assert near == {i: min(polygons, key=lambda k: gap(p, polygons[k])) for i, p in ((1, (500.0, 10.0)), (2, (-40.0, -3.0)))}


def test_distances(spark):
    lines = spark.createDataFrame([(1, "A", [(0.0, 0.0), (10.0, 0.0)]), (2, "B", [(0.0, 3.0), (10.0, 3.0)]), (3, "C", [(0.0, 50.0), (1.0, 50.0)])], f"id int, name string, line {LINE}")
    assert {(r.id, r.connections) for r in spatial.degrees_of_connection(lines, "id", "name", 5.0).collect()} == {(1, 1), (2, 1), (3, 0)}
    objects = spark.createDataFrame([("x", 1, [(5.0, 4.0)]), ("y", 2, [(5.0, 48.0)])], f"layer string, object_id int, line {LINE}")
    got = {r.id: (r.x, r.y, r.total) for r in spatial.buffer_counts(lines, "id", objects, 5.0, ["x", "y"]).collect()}
    assert got == {1: (1, 0, 1), 2: (1, 0, 1), 3: (0, 1, 1)}


def test_sole_connections(spark):
    # a triangle with a tail: only the tail is a bridge
    p = [(0.0, 0.0), (1000.0, 0.0), (0.0, 1000.0), (3000.0, 0.0)]
    rows = [("s1", [p[0], p[1]]), ("s2", [p[1], p[2]]), ("s3", [p[2], p[0]]), ("s4", [p[1], p[3]]), ("s5", [p[3], p[1]]), ("s6", [p[0], p[0]])]
    edges = graph.road_edges(spark.createDataFrame(rows, f"id string, line {LINE}"), "id")
    assert edges.count() == 4
    seats = spark.createDataFrame([("Seat", 2900.0, 10.0)], "seat string, x double, y double")
    assert {(r.segment, r.seats) for r in graph.sole_connections(edges, seats).collect()} == {("s4", "Seat"), ("s5", "Seat")}


def test_sole_connections_at_the_edges_of_the_rule(spark):
    """The circle lies around the nearest node, 20 km from the seat; an end 45 km from the seat counts, one beyond the circle doesn't."""
    node, far = (20_000.0, 0.0), (45_000.0, 0.0)
    rows = [("a", [node, far]), ("b", [node, (20_000.0, 4_000.0)]), ("c", [(20_000.0, 4_000.0), (26_000.0, 4_000.0)]), ("d", [node, (20_000.0, 30_050.0)])]
    edges = graph.road_edges(spark.createDataFrame(rows, f"id string, line {LINE}"), "id")
    seats = [("Near", 0.0, 0.0), ("Far", -10_050.0, 0.0), ("None", None, 1.0), ("Nan", float("nan"), 0.0)]
    sdf = spark.createDataFrame(seats, "seat string, x double, y double")
    assert {(r.segment, r.seats) for r in graph.sole_connections(edges, sdf).collect()} == {("a", "Near"), ("b", "Near"), ("c", "Near")}
    # two edges are too few
    assert graph.sole_connections(edges.where("bx <> 26000"), sdf).collect() == []
    assert graph.sole_connections(edges.limit(0), sdf).collect() == []


def test_leaves_are_taken_off_before_a_task_sees_them(spark):
    ring = [(0.0, 0.0), (500.0, 0.0), (500.0, 500.0), (0.0, 500.0), (0.0, 0.0)]
    rows = [(f"r{i}", [a, b]) for i, (a, b) in enumerate(zip(ring, ring[1:]))] + [(f"t{i}", [(500.0 + 500 * i, 0.0), (1_000.0 + 500 * i, 0.0)]) for i in range(4)]
    edges = graph.road_edges(spark.createDataFrame(rows, f"id string, line {LINE}"), "id")
    leaves, core = graph._peeled(edges.select(F.lit("s").alias("seat"), "ax", "ay", "bx", "by"))
    assert core.count() == 4 and leaves.count() == 4
    seats = spark.createDataFrame([("S", 0.0, 0.0), ("T", 2_400.0, 0.0)], "seat string, x double, y double")
    got = {r.segment: r.seats for r in graph.sole_connections(edges, seats, close=1_600.0).collect()}
    assert got == {"t0": "S; T", "t1": "S; T", "t2": "S; T", "t3": "T"}


def _even_odd(x, y, rings):
    return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for ring in rings for (ax, ay), (bx, by) in zip(ring, ring[1:])) % 2 == 1


def test_dissolve_by_brute_force(spark):
    """Overlapping, touching, equal and holed polygons: inside the union where any holds the place; closed rings."""
    r = random.Random(11)
    rows = [("a", box(0, 0, 4, 4)), ("a", box(3, 1, 7, 3)), ("a", box(7, 1, 9, 3)), ("a", box(0, 0, 4, 4)), ("a", box(20, 20, 30, 30) + box(22, 22, 28, 28)), ("a", box(24, 21, 26, 29)), (None, box(1, 1, 2, 2)), ("empty", [])]
    for _ in range(9):
        x, y, turn = r.uniform(0, 30), r.uniform(0, 30), r.uniform(0, 3)
        ring = [(x + 6 * math.cos(turn + i * 1.1) * r.uniform(0.5, 1), y + 6 * math.sin(turn + i * 1.1) * r.uniform(0.5, 1)) for i in range(6)]
        rows.append(("b", [[*ring, ring[0]]]))
    found = {x.k: [[(p.x, p.y) for p in ring] for ring in x.rings] for x in spatial.dissolve(spark.createDataFrame(rows, f"k string, rings array<{LINE}>"), "k").collect()}
    assert set(found) == {"a", "b", None, "empty"} and found["empty"] == []
    for rings in found.values():
        assert all(ring[0] == ring[-1] and len(ring) > 3 for ring in rings)
    for k, rings in found.items():
        for _ in range(3000):
            x, y = r.uniform(-3, 36), r.uniform(-3, 36)
            assert _even_odd(x, y, rings) == any(_even_odd(x, y, p) for key, p in rows if key == k)
    df = spark.createDataFrame([(1, (3.5, 2.0)), (2, (7.0, 2.0)), (3, (23.0, 25.0))], "id int, p struct<x:double,y:double>")
    merged = spatial.dissolve(spark.createDataFrame(rows, f"k string, rings array<{LINE}>"), "k")
    assert {x.id: x.k for x in spatial.point_in_polygon(df, "id", merged.where("k = 'a'"), "k", 1.3).collect()} == {1: "a", 2: "a", 3: None}


def test_polygons_that_meet(spark):
    state = [[(10.0, 10.0), (20.0, 12.0), (18.0, 20.0), (9.0, 19.0), (10.0, 10.0)]]
    rows = [("covers", box(0, 0, 40, 40)), ("crosses", box(0, 14, 40, 15)), ("within", box(13, 13, 14, 14)), ("corner", box(15, 5, 19.5, 11.95)), ("apart", box(30, 0, 31, 40)), ("around", box(0, 0, 40, 40) + box(5, 5, 35, 35)), ("touches", box(20, 12, 25, 13))]
    layer = spark.createDataFrame(rows, f"k string, rings array<{LINE}>")
    outline = spark.createDataFrame([(state,)], f"rings array<{LINE}>")
    assert {r.k for r in tables.within_state(layer, "k", outline, 3.0).collect()} == {"covers", "crosses", "within", "corner", "touches"}


def test_places_without_coordinates_end_the_search(spark):
    polygons = spark.createDataFrame([("a", box(0, 0, 1, 1))], f"poly string, rings array<{LINE}>")
    points = spark.createDataFrame([(1, (float("nan"), 0.0)), (2, (float("inf"), 0.0)), (3, (900.0, 5.0)), (4, None)], "id int, p struct<x:double,y:double>")
    assert {r.id: r.poly for r in spatial.nearest_polygon(points, "id", polygons, "poly", 2.0).collect()} == {3: "a"}


def test_outlines_through_the_turn_of_the_way(spark):
    """An outline may pass below a point where its cell's lower side does; a line of the findings, and points and corners on a lattice by brute force."""
    diamond = [[(19200.25, 15000.25), (14000.25, 20200.25), (8800.25, 15000.25), (14000.25, 9800.25), (19200.25, 15000.25)]]
    line = [(17242.5, 12822.5), (16652.5, 12672.5)]
    df = spark.createDataFrame([("a", diamond)], f"poly string, rings array<{LINE}>")
    (got,) = spatial.inside_lengths(spark.createDataFrame([(1, line)], f"id int, line {LINE}"), "id", df, "poly", 900.0).collect()
    assert abs(got.inside - 0.5 * math.hypot(590, 150)) < 1e-9

    r = random.Random(11)
    polygons = {}
    for i in range(12):
        ring = [(float(r.randrange(0, 13)), float(r.randrange(0, 13))) for _ in range(r.randrange(3, 8))]
        polygons[i] = [[*ring, ring[0]]]

    def held(x, y, ring):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            odd ^= (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
        return odd

    points = [(float(x), y / 2) for x in range(-1, 14) for y in range(-2, 27)]
    pdf = spark.createDataFrame([(f"{k}_{i}", p) for k in polygons for i, p in enumerate(points)], "id string, p struct<x:double,y:double>")
    every = spark.createDataFrame([(k, v) for k, v in polygons.items()], f"poly int, rings array<{LINE}>")
    near = pdf.withColumn("_cell", spatial._cell_of(F.col("p"), 4.0)).join(spatial.polygon_cells(every, "poly", 4.0), "_cell").where(F.substring_index("id", "_", 1) == F.col("poly").cast("string"))
    got = {x.id for x in near.where(spatial._inside(F.col("p.x"), F.col("p.y"), 4.0)).collect()}
    assert got == {f"{k}_{i}" for k, (ring,) in polygons.items() for i, p in enumerate(points) if held(*p, ring)}
