import random
import statistics

from pyspark.sql import functions as F

from waymark.operators import stations as S
from waymark.operators.quantiles import exact_quantiles


def quantile(values, q):
    values = sorted(values)
    p = q * (len(values) - 1)
    low, high = int(p), -int(-p // 1)
    return values[low] if low == high or values[low] == values[high] else (high - p) * values[low] + (p - low) * values[high]


def test_selection_gives_what_sorting_does(spark):
    """Skewed, equal, tiny, huge and few values, nulls, and a null key."""
    r = random.Random(1)
    groups = {"wide": [r.lognormvariate(0, 40) for _ in range(3000)], "same": [7.0] * 900, "two": [1.0] * 500 + [2.0] * 500, "few": [3.0, 1.0], "one": [-5.5], None: [r.gauss(0, 1) for _ in range(501)], "mixed": [-1e300, 1e300, 0.0, -0.5, 1e-300]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("few", None), ("none", None), ("few", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = {"median": 0.5, "p95": 0.95, "least": 0.0, "most": 1.0}
    for small in (0, 10**6):
        got = {x.k: x for x in exact_quantiles(df, ["k"], {"v": F.col("v"), "w": -F.col("v")}, shares, small).collect()}
        assert set(got) == {*groups, "none"} and got["none"].v_median is None
        for k, vs in groups.items():
            for name, q in shares.items():
                assert got[k][f"v_{name}"] == quantile(vs, q) and got[k][f"w_{name}"] == quantile([-v for v in vs], q)
    (whole,) = exact_quantiles(df, [], {"v": F.col("v")}, {"median": 0.5}, 0).collect()
    assert whole.v_median == statistics.median(v for vs in groups.values() for v in vs)


def test_large_groups_are_not_gathered(spark):
    """The plan of a round holds partial counts of buckets, no list of values."""
    df = spark.range(300_000).select(F.lit("k").alias("k"), F.xxhash64("id").cast("double").alias("v"))
    got = exact_quantiles(df, ["k"], {"v": F.col("v")}, {"m": 0.5}, 1000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
    assert got.first().v_m == df.agg(F.percentile("v", 0.5)).first()[0]


def test_cohorts_and_fallbacks_by_either_way(spark):
    r = random.Random(3)
    rows = [(f"s{i}", r.choice([1, 2, 3, None]), r.choice([None, 99999, 5]), r.choice([1, 2, None]), *[r.choice([None, r.uniform(0, 900)]) for _ in range(4)]) for i in range(900)]
    df = spark.createDataFrame(rows, "unique_id string, FUNCTIONAL_CLASS int, URBAN_CODE int, DISTRICT int, AADT_2020_HPMS double, AADT_2022_HPMS double, AADT_2023_HPMS double, AADT_2024_HPMS double")
    keys = ["FUNCTIONAL_CLASS", "URBAN_CODE", "DISTRICT"]
    ratios = {"r": F.col("AADT_2022_HPMS") / F.col("AADT_2020_HPMS")}
    either = [sorted(map(repr, S._cohorts(df, [], keys, F.count("*"), F.col("AADT_2020_HPMS"), ratios, 60, small).collect())) for small in (0, 10**6)]
    assert either[0] == either[1] and len(either[0]) > 20
    either = [sorted(map(repr, S.median_with_fallback(df, "AADT_2020_HPMS", [["FUNCTIONAL_CLASS", "DISTRICT"], ["DISTRICT"]], small).collect())) for small in (0, 10**6)]
    assert either[0] == either[1] and len(either[0]) == 900
