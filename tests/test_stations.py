import math
import random

from waymark.operators import stations as S


def brute(points, stations, k):
    out = {}
    for (i, year), (x, y) in points.items():
        near = sorted((((x - sx) ** 2 + (y - sy) ** 2) ** 0.5, s) for (s, yr), (sx, sy) in stations.items() if yr == year) if x is not None else []
        for rank in range(1, k + 1):
            d, s = near[rank - 1] if rank <= len(near) else (None, None)
            out[i, year, rank] = (s, None if d is None else round(d, 6))
    return out


def test_knn_keeps_groups_apart(spark):
    """Points of several years, years of few and of many stations, of one place, of one line, and without any."""
    r = random.Random(3)
    stations = {(f"s{i}", 2020): (r.uniform(0, 1e5), r.uniform(0, 1e5)) for i in range(150)}
    stations |= {(f"s{i}", 2021): (r.uniform(4e4, 4.1e4), r.uniform(0, 1e3)) for i in range(40)}
    stations |= {("a", 2022): (5.0, 5.0), ("b", 2022): (5.0, 5.0), ("c", 2023): (1e6, 0.0), ("d", 2023): (-1e6, 0.0), ("e", 2023): (0.0, 0.0)}
    points = {(i, year): (r.uniform(-2e4, 1.2e5), r.uniform(-2e4, 1.2e5)) for i in range(60) for year in range(2020, 2025)}
    points |= {(99, year): (None, None) for year in range(2020, 2025)}
    nan = float("nan")
    pdf = spark.createDataFrame([(i, y, nan if i == 99 else x, z) for (i, y), (x, z) in points.items()], "id int, year int, x double, y double")
    sdf = spark.createDataFrame([(s, y, x, z) for (s, y), (x, z) in stations.items()] + [("bad", 2022, nan, 1.0), ("worse", 2022, float("inf"), 1.0), ("gone", 2022, None, 1.0)], "tc string, year int, x double, y double")
    got = {(x.id, x.year, x.k_rank): (x.tc, None if x.distance is None else round(x.distance, 6)) for x in S.knn(pdf, sdf, "id", "tc", 3, ["year"]).collect()}
    assert got == brute(points, stations, 3)


def test_knn_of_one_point_in_two_years(spark):
    p = spark.createDataFrame([("p", 2020, 0.0, 0.0), ("p", 2021, 0.0, 0.0)], "id string, year int, x double, y double")
    s = spark.createDataFrame([("a", 2020, 1.0, 0.0), ("b", 2020, 9.0, 0.0), ("c", 2021, 5.0, 0.0), ("d", 2021, 7.0, 0.0)], "tc string, year int, x double, y double")
    assert {(r.year, r.k_rank, r.tc) for r in S.knn(p, s, "id", "tc", 2, ["year"]).collect()} == {(2020, 1, "a"), (2020, 2, "b"), (2021, 1, "c"), (2021, 2, "d")}
    assert [r.tc for r in S.knn(p.where("year = 2020"), s.limit(0), "id", "tc", 1).collect()] == [None]


def test_anchors_and_targets_without_a_place(spark):
    schema = "year int, tc_number string, latitude double, longitude double, aadt double, functional_class int"
    nan = float("nan")
    rows = [(2024, "a", 33.0, -84.0, 10.0, 1), (2024, "b", nan, -84.0, 10.0, 1), (2020, "a", 33.0, -84.0, 10.0, 1), (2020, "x", nan, -84.0, 10.0, 1), (2020, "y", 33.0, float("inf"), 10.0, 1), (2020, "z", 40.0, -84.0, 10.0, 1)]
    got = {(r.year, r.tc_number): r.resolver_method for r in S.run_resolver(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(2024, "a"): "anchor", (2024, "b"): "anchor", (2020, "a"): "tc_number", (2020, "x"): "unresolved", (2020, "y"): "unresolved", (2020, "z"): "unresolved"}


def test_crowded_cells_are_several_lists(spark):
    r = random.Random(3)
    stations = [(i, 100.0 + r.randrange(3), 100.0 + r.randrange(3)) for i in range(1500)] + [(5000 + i, r.uniform(0, 4000), r.uniform(0, 4000)) for i in range(60)]
    points = [(i, r.uniform(0, 300), r.uniform(0, 300)) for i in range(40)] + [(100, None, 2.0), (101, 9e5, -9e5)]
    got = S.knn(spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(stations, "s int, x double, y double"), "id", "s", 4, cell=500.0)
    found = sorted((x.id, x.k_rank, x.s) for x in got.collect())
    want = []
    for i, x, y in points:
        best = [s for _, s in sorted((math.sqrt((x - a) ** 2 + (y - b) ** 2), s) for s, a, b in stations)[:4]] if x is not None else [None] * 4
        want += [(i, n + 1, s) for n, s in enumerate(best)]
    assert found == sorted(want, key=lambda t: t[:2])
