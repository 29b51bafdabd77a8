from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.operators import spatial


def test_equal_lines_are_buffered_once(spark, monkeypatch):
    drawn = []

    def counted(lines, *rest):
        drawn.append(lines.count())
        return before(lines, *rest)

    before = spatial.buffers
    monkeypatch.setattr(spatial, "buffers", counted)
    line = F.array(G.point(100.0, 100.0), G.point(F.lit(100.0) + F.col("id") % 2 * 50, 100.0 + F.lit(30.0)))
    segments = spark.range(6).select(F.col("id"), F.when(F.col("id") < 5, line).alias("line"))
    ring = F.array(*[G.point(x, y) for x, y in ((0.0, 0.0), (1000.0, 0.0), (1000.0, 1000.0), (0.0, 1000.0), (0.0, 0.0))])
    groups = spark.range(1).select(F.lit("g").alias("geoid"), F.lit("c").alias("county"), F.lit(1000.0).alias("population"), F.lit(10.0).alias("jobs"), F.array(ring).alias("rings"))
    factors = spark.createDataFrame([("c", 2.0)], "county string, factor double")
    got = {r.id: (r.population_density, r.population_density_2050) for r in spatial.density_metrics(segments, "id", groups, factors, F.lit(1.0), radius=40.0).collect()}
    assert drawn == [3]  # two different lines and none at all
    assert got[0] == got[2] == got[4] and got[1] == got[3] and got[5] == (0.0, 0.0)
    assert got[0][0] > 0 and abs(got[0][1] - 2 * got[0][0]) < 0.02
