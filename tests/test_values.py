"""Values worked out by hand from the rules, and cases that the star-schema tables don't hold."""

from pyspark.sql import functions as F

from waymark.functions import classify as R
from waymark.functions import scalars as P
from waymark.operators import intervals, stations


def test_reference_keys_and_designations(spark):
    rows = [("1121100040300INC", "I 75 North"), ("2121200040312DEC", "Old SR 26"), ("short", "SR 1/US 27"), (None, None), ("1000100000700INC", "Liberty Expy")]
    df = spark.createDataFrame(rows, "r string, n string")
    got = df.select(P.rclink_candidates(F.col("r")).alias("k"), P.corridor_prefixes(F.col("n")).alias("p")).collect()
    assert [x.k for x in got] == [["1211040300", "0001040300"], ["1212040312"], [], [], ["0001000700"]]
    assert [x.p for x in got] == [["I-75"], ["SR-26"], ["SR-1", "US-27"], [], []]


def test_agreement_divides_by_the_state(spark):
    df = spark.createDataFrame([(10000.0, 11700.0), (10000.0, 11500.0), (0.0, 500.0), (100.0, 290.0), (None, None)], "a double, b double")
    assert [x.g for x in df.select(R.source_agreement(F.col("a"), F.col("b")).alias("g")).collect()] == ["both_disagree", "both_agree", "both_disagree", "both_agree", "missing"]


def test_gaps_need_not_touch(spark):
    rows = [("r", 0.0, 1.0, 100), ("r", 1.5, 2.0, None), ("r", 2.5, 3.0, 300), ("s", 0.0, 1.0, None), ("s", 1.0, 2.0, 5)]
    df = spark.createDataFrame(rows, "ROUTE_ID string, from_mp double, to_mp double, v long")
    got = {(x.ROUTE_ID, x.from_mp): (x.v, x.interpolated) for x in intervals.interpolate_gaps(df, "v", F.lit(True)).collect()}
    assert got == {("r", 0.0): (100, False), ("r", 1.5): (200, True), ("r", 2.5): (300, False), ("s", 0.0): (None, False), ("s", 1.0): (5, False)}


def test_far_points_and_stations_in_a_row(spark):
    points = spark.createDataFrame([(1, 1.4e9, 3.0), (2, -5.0, 10.0), (3, None, 1.0)], "id int, x double, y double")
    s = spark.createDataFrame([(i, float(i * 100), 7.0) for i in range(10)], "tc int, x double, y double")
    got = {}
    for x in stations.knn(points, s, "id", "tc", 3).collect():
        got.setdefault(x.id, []).append((x.k_rank, x.tc))
    assert {k: [t for _, t in sorted(v)] for k, v in got.items()} == {1: [9, 8, 7], 2: [0, 1, 2], 3: [None, None, None]}


def test_first_in_rank_beyond_the_cutoff(spark):
    links = spark.createDataFrame([("a", 2020, 1, "x", 300.0, 1), ("a", 2020, 2, "y", 700.0, 0), ("b", 2020, 1, "x", 3000.0, 1), ("c", 2020, 1, "z", 100.0, 1), ("c", 2020, 2, "y", 900.0, 0)], "unique_id string, year int, k_rank int, nearest_tc_number string, station_distance_m double, same_route_flag int")
    s = spark.createDataFrame([(2020, "x", 1000), (2020, "y", 2000), (2020, "z", None)], "year int, tc_number string, aadt long")
    got = {x.unique_id: (x.predicted, x.confidence, x.n_used) for x in stations.idw_predict(links, s).collect()}
    assert got == {"a": (1300, "high", 2), "b": (None, "none", 0), "c": (2000, "high", 1)}
