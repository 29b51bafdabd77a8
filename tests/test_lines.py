import math
import random
import time

from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.operators import intervals, lines, spatial

LINE = "array<struct<x:double,y:double>>"


def at(line, d):
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        n = math.hypot(bx - ax, by - ay)
        if d <= n:
            t = max(0.0, d / n) if n else 0.0
            return ax + t * (bx - ax), ay + t * (by - ay)
        d -= n
    return line[-1]


def part(line, b, e):
    far, inner = 0.0, []
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        if b < far < e:
            inner.append((ax, ay))
        far += math.hypot(bx - ax, by - ay)
    return [at(line, b), *inner, at(line, e)]


def close(a, b):
    return len(a) == len(b) and all(math.hypot(p[0] - q[0], p[1] - q[1]) < 1e-6 for p, q in zip(a, b))


def test_folds_along_a_line(spark):
    r = random.Random(2)
    rows = [(i, [(r.uniform(0, 9), r.uniform(0, 9)) for _ in range(r.randint(2, 7))], r.uniform(-1, 30), r.uniform(0, 30)) for i in range(80)]
    rows.append((80, [(0.0, 0.0), (0.0, 0.0), (2.0, 0.0), (2.0, 0.0), (4.0, 0.0)], 2.0, 4.0))
    df = spark.createDataFrame(rows, f"id int, line {LINE}, b double, e double")
    got = df.select("id", G.line_at(F.col("line"), F.col("b")).alias("p"), G.line_substring(F.col("line"), F.col("b"), F.col("e")).alias("s"), G.line_project(F.col("line"), F.struct(F.lit(4.0).alias("x"), F.lit(5.0).alias("y"))).alias("d")).collect()
    for x in got:
        _, line, b, e = rows[x.id]
        assert close([(x.p.x, x.p.y)], [at(line, b)]) and close([(p.x, p.y) for p in x.s], part(line, b, e))
        far = [math.hypot(*(u - v for u, v in zip(at(line, d / 200 * 60), (4.0, 5.0)))) for d in range(201)]
        assert math.hypot(*(u - v for u, v in zip(at(line, x.d), (4.0, 5.0)))) <= min(far) + 1e-9


def test_parts_are_joined(spark):
    a, b, c, d = [(0.0, 0.0), (1.0, 0.0)], [(1.0, 0.0), (2.0, 0.0), (3.0, 0.0)], [(3.0, 0.0), (4.0, 0.0)], [(9.0, 9.0), (8.0, 8.0)]
    df = spark.createDataFrame([(1, [a, b, c, d]), (2, [d, a]), (3, []), (4, [a])], f"id int, parts array<{LINE}>")
    got = {x.id: [[(p.x, p.y) for p in q] for q in x.m] for x in df.select("id", G.merge_parts(F.col("parts")).alias("m")).collect()}
    assert got == {1: [[(0, 0), (1, 0), (2, 0), (3, 0), (4, 0)], d], 2: [d, a], 3: [], 4: [a]}


def test_pieces_of_lines(spark):
    """Pieces that tile, overlap, end at vertices, have no length, and routes without span."""
    r = random.Random(8)
    routes = [(f"r{i}", 2.0, 12.0, [(r.uniform(0, 99), r.uniform(0, 99)) for _ in range(r.randint(2, 30))]) for i in range(12)]
    routes += [("even", 0.0, 4.0, [(float(i), 0.0) for i in range(5)]), ("twice", 0.0, 2.0, [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (2.0, 0.0)]), ("none", 3.0, 3.0, [(0.0, 0.0), (1.0, 1.0), (5.0, 1.0)]), ("dot", 0.0, 1.0, [(0.0, 0.0), (0.0, 0.0)])]
    pieces = [(k, i, *sorted(r.uniform(1, 13) for _ in range(2))) for k, *_ in routes[:12] for i in range(6)]
    pieces += [("even", 0, 0.0, 1.0), ("even", 1, 1.0, 3.0), ("even", 2, 0.0, 4.0), ("even", 3, 2.0, 2.0), ("even", 4, 0.5, 3.5), ("twice", 0, 0.0, 1.0), ("twice", 1, 1.0, 2.0), ("none", 0, 3.0, 3.0), ("dot", 0, 0.0, 1.0), ("gone", 0, 0.0, 1.0)]
    rdf = spark.createDataFrame(routes, f"ROUTE_ID string, from_mp double, to_mp double, line {LINE}")
    got = {(x.ROUTE_ID, x.piece): x.line and [(p.x, p.y) for p in x.line] for x in lines.slice_lines(spark.createDataFrame(pieces, "ROUTE_ID string, piece int, from_mp double, to_mp double"), rdf).collect()}
    by = {k: (f, t, line) for k, f, t, line in routes}
    assert len(got) == len(pieces)
    for k, i, f, t in pieces:
        if k in ("gone", "dot"):
            assert got[k, i] is None
            continue
        begin, end, line = by[k]
        n = sum(math.hypot(b[0] - a[0], b[1] - a[1]) for a, b in zip(line, line[1:]))
        b, e = (0.0, n) if k == "none" else (max(0.0, min(n, n * (m - begin) / (end - begin))) for m in (f, t))
        if e - b <= 0:
            assert got[k, i] is None
        else:
            want = part(line, b, e)
            # of vertices at one place both stay or one, as the ends are cut
            assert close(got[k, i], want) or (k == "twice" and close(list(dict.fromkeys(got[k, i])), list(dict.fromkeys(want))))


def test_a_line_of_100000_vertices_costs_what_its_vertices_do(spark):
    def seconds(n):
        df = spark.createDataFrame([("r", 0.0, float(n), [(float(i), float(i % 2)) for i in range(n + 1)])], f"ROUTE_ID string, from_mp double, to_mp double, line {LINE}")
        pieces = spark.range(n // 100).select(F.lit("r").alias("ROUTE_ID"), F.col("id").cast("int").alias("piece"), (F.col("id") * 100.0).alias("from_mp"), (F.col("id") * 100.0 + 100).alias("to_mp"))
        began = time.time()
        told = lines.slice_lines(pieces, df).select(F.size("line").alias("n"), G.line_length(F.col("line")).alias("m")).agg(F.count("n"), F.min("n"), F.max("n"), F.sum("m")).first()
        assert told[0] == n // 100 and told[1] == 101 and told[2] == 101 and abs(told[3] - n * math.sqrt(2)) < 1e-3
        one = df.select(G.line_at(F.col("line"), F.lit(n * 0.7)).alias("p"), G.line_project(F.col("line"), F.struct(F.lit(n / 2).alias("x"), F.lit(0.5).alias("y"))).alias("d")).first()
        assert abs(one.p.x - n * 0.7 / math.sqrt(2)) < 1e-6 and abs(one.d - n / math.sqrt(2)) < 1
        return time.time() - began

    seconds(1_000)
    few, many = seconds(10_000), seconds(100_000)
    assert many < 20 * max(few, 1.0)


def test_crossings_of_a_long_line(spark):
    n = 20_000
    route = spark.createDataFrame([("r", 0.0, 1.0, [(float(i), 0.0) for i in range(n + 1)])], f"k string, from_mp double, to_mp double, line {LINE}")
    ring = [[(5_000.5, -1.0), (15_000.5, -1.0), (15_000.5, 1.0), (5_000.5, 1.0), (5_000.5, -1.0)]]
    polygons = spark.createDataFrame([("p", ring)], f"poly string, rings array<{LINE}>")
    assert {x.mp for x in spatial.boundary_crossings(route, "k", polygons, 500.0).collect()} == {0.25, 0.75}


def overlap_brute(left, right):
    out = {}
    for i, k, b, e in left:
        rows = [(min(e, y) - max(b, x), x, v) for key, x, y, v in right if key == k and x is not None and y is not None] if b is not None and e is not None else []
        rows = sorted((-s, x, v) for s, x, v in rows if s > 1e-4)
        first = sorted((x, v) for key, x, y, v in right if key == k and x is not None)
        out[i] = rows[0][2] if rows else (first[0][1] if (b is None or e is None) and first else None)
    return out


def test_binned_joins_by_brute_force(spark):
    """Intervals within a bin, across many, below zero, without length or bounds; each left row once."""
    r = random.Random(6)

    def some(n):
        begin = [r.uniform(-40, 200) for _ in range(n)]
        return [(r.choice("ab"), b, b + r.choice([0.0, 0.3, 5.0, 60.0, 150.0]) * r.random()) for b in begin]

    left = [(i, *x) for i, x in enumerate(some(150))] + [(900, "a", None, 3.0), (901, "b", 3.0, None), (902, "c", 0.0, 1.0), (903, "c", None, None), (904, "a", 32.0, 64.0)]
    right = [(*x, i) for i, x in enumerate(some(200))] + [("a", None, 5.0, 999), ("a", 32.0, 64.0, 998)]
    ldf, rdf = spark.createDataFrame(left, "id int, k string, from_mp double, to_mp double"), spark.createDataFrame(right, "k string, from_mp double, to_mp double, v int")
    rdf = rdf.where("from_mp is not null")
    right = [x for x in right if x[1] is not None]
    rows = intervals.best_overlap(ldf, rdf, "k", ["v"]).collect()
    assert len(rows) == len(left) and {x.id: x.v for x in rows} == overlap_brute(left, right)
    rows = intervals.first_covering(ldf, rdf, "k", ["v"]).collect()
    want = {i: min(((x, y, v) for key, x, y, v in right if key == k and b is not None and e is not None and x <= b + 1e-4 and y >= e - 1e-4), default=(0, 0, None))[2] for i, k, b, e in left}
    assert len(rows) == len(left) and {x.id: x.v for x in rows} == want


def test_one_route_with_all_rows(spark):
    """200,000 intervals on one route: all pairs would be 4e10."""
    n = 200_000
    rows = spark.range(n).select(F.lit("r").alias("k"), F.col("id"), (F.col("id") / 10).alias("from_mp"), (F.col("id") / 10 + 0.1).alias("to_mp"))
    began = time.time()
    found = intervals.best_overlap(rows, rows.select("k", "from_mp", "to_mp", F.col("id").alias("v")), "k", ["v"]).agg(F.count("*"), F.count_if(F.col("id") == F.col("v"))).first()
    assert tuple(found) == (n, n) and time.time() - began < 90
