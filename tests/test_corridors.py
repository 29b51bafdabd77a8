import time

from pyspark.sql import functions as F

from waymark.operators import corridors as C

LINE = "array<struct<x:double,y:double>>"


def lines(spark, rows):
    return spark.createDataFrame(rows, f"id string, name string, kind string, from_mp double, to_mp double, line {LINE}")


def test_length_within_a_capsule(spark):
    s = lines(spark, [("s", "SR-1", "SR", 0.0, 1.0, [(0.0, 10.0), (1000.0, 10.0)])])
    c = spark.createDataFrame([("c", [(200.0, 0.0), (500.0, 0.0)])], f"corridor string, line {LINE}")
    got = C.length_within(s, "id", c, 20.0).first().overlap_m
    assert abs(got - (300 + 2 * (20**2 - 10**2) ** 0.5)) < 1e-6


def test_match_rules(spark):
    s = lines(spark, [("on", "SR-1", "State Route", 0.0, 1.0, [(0.0, 5.0), (1000.0, 5.0)]), ("cross", "SR-1", "State Route", 0.0, 1.0, [(500.0, -100.0), (500.0, 100.0)]), ("other", "SR-9", "State Route", 0.0, 1.0, [(0.0, 40.0), (1000.0, 40.0)]), ("local", "CR-2", "Local/Other", 0.0, 1.0, [(0.0, 45.0), (150.0, 45.0)])])
    named = C.build_corridors(spark.createDataFrame([(1, "Main", [(0.0, 0.0), (1000.0, 0.0)])], f"id int, name string, line {LINE}"), "id", "name")
    found = C.corridor_candidates(s, "id", named)
    prefixes = C.discover_prefixes(found, s, "id", "name")
    assert prefixes.first().names == ["SR-1"]
    matches = C.corridor_match(found, s, "id", "name", "kind", prefixes)
    assert {r.id: r.reason for r in matches.collect()} == {"on": None, "cross": "short", "other": "name", "local": "local"}
    assert [(r.id, r.corridors) for r in C.collapse_matches(matches, "id").collect()] == [("on", ["Main"])]
    assert [(r.segments, r.few) for r in C.corridor_qc(matches, named).collect()] == [(1, True)]


def test_split_keeps_length(spark):
    s = lines(spark, [("a", "n", "SR", 0.0, 10.0, [(0.0, 0.0), (1000.0, 0.0)]), ("b", "n", "SR", 0.0, 1.0, [(0.0, 0.0), (1000.0, 0.0)]), ("c", "n", "SR", 0.0, 1.0, [(0.0, 0.0), (100.0, 0.0)])])
    ranges = spark.createDataFrame([("a", 200.0, 500.0), ("a", 500.2, 600.0), ("a", 900.0, 990.0), ("b", 0.0, 950.0)], "id string, from_m double, to_m double")
    got = sorted((r.id, r.piece, r.from_mp, r.to_mp, r.flagged) for r in C.split_flagged(s, "id", ranges).collect())
    assert got == [("a", 0, 0.0, 2.0, False), ("a", 1, 2.0, 6.0, True), ("a", 2, 6.0, 9.0, False), ("a", 3, 9.0, 10.0, True), ("b", 0, 0.0, 1.0, True), ("c", 0, 0.0, 1.0, False)]


def test_slivers_join_the_longer_neighbour(spark):
    s = lines(spark, [("a", "n", "SR", 0.0, 1.0, [(0.0, 0.0), (1000.0, 0.0)])])
    ranges = spark.createDataFrame([("a", 100.0, 300.0), ("a", 320.0, 700.0), ("a", 980.0, 1000.0)], "id string, from_m double, to_m double")
    got = [(r.from_mp, r.to_mp, r.flagged) for r in C.split_flagged(s, "id", ranges).orderBy("piece").collect()]
    # the gap of 20 m joins the 380 m behind it, the last 20 m the 280 m before them
    assert got == [(0.0, 0.1, False), (0.1, 0.3, True), (0.3, 0.7, True), (0.7, 1.0, False)]


def road(spark, rows):
    return spark.createDataFrame(rows, f"unique_id string, ROUTE_ID string, from_mp double, to_mp double, HWY_NAME string, ROUTE_FAMILY string, line {LINE}")


def test_evacuation(spark):
    """Along, partly along, across, local beside a sibling, interstate in contraflow, and a DEC twin."""
    s = road(
        spark,
        [
            ("1", "A1INC", 0.0, 1.0, "SR-26", "State Route", [(0.0, 5.0), (2000.0, 5.0)]),
            ("2", "A2INC", 0.0, 2.0, "SR-26", "State Route", [(2000.0, 5.0), (3000.0, 5.0), (4000.0, 300.0)]),
            ("3", "A3INC", 0.0, 1.0, "SR-26", "State Route", [(500.0, -300.0), (500.0, 300.0)]),
            ("4", "A4INC", 0.0, 1.0, "CS-1", "Local/Other", [(0.0, 15.0), (600.0, 15.0)]),
            ("5", "A5INC", 0.0, 1.0, "CR-9", "Local/Other", [(0.0, -45.0), (600.0, -45.0)]),
            ("6", "A6INC", 0.0, 1.0, "I-16", "Interstate", [(0.0, 9005.0), (1000.0, 9005.0)]),
            ("7", "A1DEC", 0.1, 0.9, "SR-26", "State Route", [(0.0, 500.0), (2000.0, 500.0)]),
        ],
    )
    routes = spark.createDataFrame([(1, "SR 26", [(0.0, 0.0), (3000.0, 0.0)])], f"id int, ROUTE_NAME string, line {LINE}")
    contra = spark.createDataFrame([(1, "Mary", [(0.0, 9000.0), (3000.0, 9000.0)])], f"id int, TITLE string, line {LINE}")
    got = {(r.ROUTE_ID, r.from_mp, r.to_mp): (r.SEC_EVAC, r.SEC_EVAC_CONTRAFLOW, r.SEC_EVAC_ROUTE_NAME, r.SEC_EVAC_SOURCE, r.unique_id) for r in C.apply_evacuation(s, routes, contra).collect()}
    evac, source = "SR 26", "gdot_eoc_hurricane_evacuation"
    assert got[("A1INC", 0.0, 1.0)] == (True, False, evac, source, "A1INC_0.0000_1.0000")
    inside, outside = sorted(k for k in got if k[0] == "A2INC")
    assert got[inside][:2] == (True, False) and got[outside] == (False, False, None, None, f"A2INC_{outside[1]:.4f}_2.0000")
    assert abs(inside[2] - 2 * (1000 + 45) / 2042.6) < 0.02
    assert got[("A3INC", 0.0, 1.0)][0] is False
    assert got[("A4INC", 0.0, 1.0)][0] is True and got[("A5INC", 0.0, 1.0)][0] is False
    assert got[("A6INC", 0.0, 1.0)] == (True, True, "Mary", "gdot_eoc_contraflow", "A6INC_0.0000_1.0000")
    assert got[("A1DEC", 0.1, 0.9)][:4] == (True, False, evac, source)


def test_filters_after_the_match(spark):
    s = spark.createDataFrame([("a", "SR-1", "X", [(0.0, 10.0), (100.0, 10.0)]), ("b", "SR-1", "X", [(0.0, 10.0), (100.0, 200.0)]), ("c", "SR-2", "Y", [(0.0, 70.0), (100.0, 70.0)])], f"id string, HWY_NAME string, COUNTY_NAME string, line {LINE}")
    c = spark.createDataFrame([("Main", [(0.0, 0.0), (100.0, 0.0)])], f"corridor string, line {LINE}")
    m = spark.createDataFrame([("a", ["Main"], 1.0, 1.0), ("b", ["Main"], 1.0, 1.0)], "id string, corridors array<string>, overlap_m double, share double")
    assert {r.id for r in C.hard_cap(m, s, "id", c).collect()} == {"a"}
    rules = spark.createDataFrame([("Main", "SR-2", "Y"), ("Main", "SR-1", "X")], "corridor string, HWY_NAME string, COUNTY_NAME string")
    got = {r.id: (r.corridors, r.method) for r in C.forced_flags(m.where("id = 'a'"), s, "id", c, rules).collect()}
    assert got == {"a": (["Main"], "spatial"), "c": (["Main"], "concurrent_forced")}


def test_samples_among_many_lines(spark):
    """Samples in a cell that a line passes are near without a comparison, and those beside such cells are compared."""
    line = "array<struct<x:double,y:double>>"
    rows = [(i, "a", [(i % 90 * 10.0, i % 7 * 30.0), (i % 90 * 10.0 + 50, i % 7 * 30.0 + i % 3 * 20)]) for i in range(400)]
    others = [("a" if i % 5 else "b", [(i * 37.0 % 700, i * 11.0 % 160), (i * 37.0 % 700 + i % 4 * 25, i * 11.0 % 160 + i % 2 * 9)]) for i in range(60)]
    s, o = spark.createDataFrame(rows, f"id int, corridor string, line {line}"), spark.createDataFrame(others, f"corridor string, line {line}")
    plain, dense = ({(r.id, r.near) for r in C.near_share(s, ["id", "corridor"], o, ["corridor"], 25.0, dense=d).collect()} for d in (False, True))
    assert plain == dense and 0 < len(plain) < 400
    # side by side, 40,000 lines are passed cells; each with each would be billions of pairs
    many = spark.range(40_000).select(F.col("id"), F.lit("a").alias("corridor"), F.expr("array(struct(double(id % 50) as x, double(id % 11) as y), struct(double(id % 50 + 60) as x, double(id % 11) as y))").alias("line"))
    began = time.time()
    assert {r.near for r in C.near_share(many, ["id", "corridor"], many.select("corridor", "line"), ["corridor"], 25.0, dense=True).collect()} == {1.0}
    assert time.time() - began < 60
