"""Queries on stations, predictions and cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import scalars as P
from waymark.functions.classify import source_agreement
from waymark.functions.scalars import round_even
from waymark.operators import reports
from waymark.operators import stations as S
from waymark.plans.adapters import POINTS_SQL, SEGMENTS_SQL, points, read, segments, stations

PTS = f"WITH {POINTS_SQL}"
_KNN = """pairs AS (SELECT p.unique_id, p.year, s.tc_number, sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) AS distance FROM pts p JOIN sta s USING (year) WHERE p.x IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY unique_id, year ORDER BY distance, tc_number) AS k_rank FROM pairs QUALIFY k_rank <= 5),
link AS (SELECT p.unique_id, p.year, CAST(k AS INTEGER) AS k_rank, r.tc_number, r.distance FROM pts p CROSS JOIN generate_series(1, 5) g(k) LEFT JOIN ranked r ON r.unique_id = p.unique_id AND r.year = p.year AND r.k_rank = k)"""


def _links(spark: SparkSession, d: str) -> DataFrame:
    return S.knn(points(spark, d), stations(spark, d), "unique_id", "tc_number", 5, ["year"])


def knn(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d).select("unique_id", "year", "k_rank", "tc_number", round_even("distance", 3).alias("distance"))


def idw(spark: SparkSession, d: str) -> DataFrame:
    link = _links(spark, d).select("unique_id", "year", "k_rank", F.col("tc_number").alias("nearest_tc_number"), F.col("distance").alias("station_distance_m"), (F.col("tc_number") % 2).alias("same_route_flag"))
    return S.idw_predict(link, stations(spark, d))


IDW_SQL = f"""{PTS}, {_KNN}, met AS (SELECT l.*, CASE WHEN l.distance <= 2000 THEN CAST(s.aadt AS DOUBLE) END AS v FROM link l LEFT JOIN sta s ON l.year = s.year AND l.tc_number = s.tc_number),
g AS (SELECT unique_id, year, round_even(sum(v / greatest(distance, 1)) / sum(CASE WHEN v IS NOT NULL THEN 1 / greatest(distance, 1) END), 0) AS p, min(v) AS low, max(v) AS high, count(v) AS n FROM met GROUP BY 1, 2),
f AS (SELECT unique_id, year, distance AS d, tc_number AS tc FROM link WHERE k_rank = 1),
t AS (SELECT g.*, f.d, f.tc, n > 0 AND coalesce(f.d <= 2000, false) AS ok FROM g JOIN f USING (unique_id, year))
SELECT unique_id, year, CASE WHEN ok THEN CAST(p AS BIGINT) END AS predicted, CASE WHEN ok THEN CAST(least(low, p) AS BIGINT) END AS lower, CASE WHEN ok THEN CAST(greatest(high, p) AS BIGINT) END AS upper,
  CASE WHEN NOT ok THEN 'none' WHEN d <= 500 AND tc % 2 = 1 THEN 'high' ELSE 'medium' END AS confidence, CASE WHEN ok THEN n ELSE 0 END AS n_used, round_even(d, 1) AS nearest_distance_m, tc AS nearest_tc_number FROM t"""


def folds(spark: SparkSession, d: str) -> DataFrame:
    return S.assign_folds(read(spark, d, "customer"), "c_custkey")


FOLDS_SQL = "SELECT c_custkey, CAST((row_number() OVER (ORDER BY md5('42' || c_custkey), c_custkey) - 1) % 5 AS INTEGER) AS fold FROM customer"


def wide(spark: SparkSession, d: str) -> DataFrame:
    """Values and trucks by year of stations with a row of 2022, with that row's attributes."""
    k, year = F.col("tc_number"), F.col("year")
    s = stations(spark, d).where((k + year) % 8 != 0).withColumns({"single": F.when(k % 3 != 0, k % 300), "combo": F.when((k + year) % 4 != 0, k % 200), "statistics_type": F.when(k % 2 == 0, "Actual")})
    s = s.select("year", "tc_number", "aadt", S.truck_aadt(F.col("single"), F.col("combo")).alias("truck_aadt"), F.col("y").alias("latitude"), F.col("x").alias("longitude"), F.col("FUNCTIONAL_CLASS").alias("functional_class"), "statistics_type")
    resolver = s.select("year", "tc_number", F.concat(F.lit("U"), F.floor(k / 2).cast("string")).alias("station_uid"), F.when(k % 9 == 0, "unresolved").otherwise("tc_number").alias("resolver_method"))
    return S.station_wide(s, resolver, [2020, 2021, 2022], ("aadt", "truck_aadt"), 2022)


_WIDE = ", ".join(f"arg_min({v}, tc_number) FILTER (year = {y} AND {v} IS NOT NULL) AS {v}_{y}" for v in ("aadt", "truck_aadt") for y in (2020, 2021, 2022))
WIDE_SQL = f"""{PTS}, u AS (SELECT *, 'U' || CAST(tc_number // 2 AS VARCHAR) AS station_uid, CASE WHEN tc_number % 3 <> 0 OR (tc_number + year) % 4 <> 0 THEN CASE WHEN tc_number % 3 <> 0 THEN tc_number % 300 ELSE 0 END + CASE WHEN (tc_number + year) % 4 <> 0 THEN tc_number % 200 ELSE 0 END END AS truck_aadt FROM sta WHERE tc_number % 9 <> 0 AND (tc_number + year) % 8 <> 0),
w AS (SELECT station_uid, {_WIDE} FROM u GROUP BY 1), f AS (SELECT * FROM u WHERE year = 2022 QUALIFY row_number() OVER (PARTITION BY station_uid ORDER BY tc_number) = 1)
SELECT w.*, CAST((aadt_2020 IS NOT NULL)::INT + (aadt_2021 IS NOT NULL)::INT + (aadt_2022 IS NOT NULL)::INT AS INTEGER) AS years_with_data, f.tc_number AS tc_number_2022, f.y AS latitude, f.x AS longitude, f.FUNCTIONAL_CLASS AS functional_class, CASE WHEN f.tc_number % 2 = 0 THEN 'Actual' END AS statistics_type_2022 FROM w JOIN f USING (station_uid)"""


def trajectory(spark: SparkSession, d: str) -> DataFrame:
    """The prediction of 2021 for segments with 2020, 2022 and a later year; every fifth one widened; later years far from the earlier."""
    years, k = [2020, 2022, 2023, 2024], F.col("c_custkey")
    values = [F.when(k % 6 != i, 1000 + (k * (i + 3)) % 500 + 40 * i + (k % 9) * (100 if i > 1 else 0)).cast("double") for i in range(4)]
    told = read(spark, d, "customer").select("c_custkey", *[v.alias(f"a{y}") for v, y in zip(values, years, strict=True)])
    columns = [F.col(f"a{y}") for y in years]
    fit = S.trajectory(years, columns)
    predicted = S.predict_2021(*columns, widened=k % 5 == 0)
    return told.select("c_custkey", S.eligible_for_fit(*columns).alias("eligible"), round_even(predicted, 3).alias("a2021"), round_even(fit["slope"], 6).alias("slope"))


_X = [-2.25, -0.25, 0.75, 1.75]
_S = [" + ".join(f"CASE WHEN v{i} IS NOT NULL THEN {x**p} ELSE 0 END" for i, x in enumerate(_X)) for p in range(5)]
_B = [" + ".join(f"coalesce({x**p} * ln(v{i}), 0)" for i, x in enumerate(_X)) for p in range(3)]
TRAJECTORY_SQL = f"""WITH v AS (SELECT c_custkey, {", ".join(f"CASE WHEN c_custkey % 6 <> {i} THEN CAST(1000 + (c_custkey * {i + 3}) % 500 + {40 * i}{' + (c_custkey % 9) * 100' if i > 1 else ''} AS DOUBLE) END AS v{i}" for i in range(4))} FROM customer),
s AS (SELECT *, {", ".join(f"{e} AS s{p}" for p, e in enumerate(_S))}, {", ".join(f"{e} AS b{p}" for p, e in enumerate(_B))} FROM v),
f AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS d,
  b0 * (s2 * s4 - s3 * s3) - s1 * (b1 * s4 - s3 * b2) + s2 * (b1 * s3 - s2 * b2) AS d0, s0 * (b1 * s4 - s3 * b2) - b0 * (s1 * s4 - s3 * s2) + s2 * (s1 * b2 - b1 * s2) AS d1,
  s0 * (s2 * b2 - b1 * s3) - s1 * (s1 * b2 - b1 * s2) + b0 * (s1 * s3 - s2 * s2) AS d2, v0 IS NOT NULL AND v1 IS NOT NULL AND (v2 IS NOT NULL OR v3 IS NOT NULL) AS ok FROM s),
r AS (SELECT *, exp(d0 / d + d1 / d * (-1.25) + d2 / d * 1.5625) AS raw, greatest(least(v0, v1) * CASE WHEN c_custkey % 5 = 0 THEN 0.5 ELSE 0.8 END, v1 * 0.5) AS low, greatest(v0, v1) * 1.2 AS high FROM f)
SELECT c_custkey, ok AS eligible, CASE WHEN ok THEN round_even(CASE WHEN raw < low THEN low WHEN raw > high THEN high ELSE raw END, 3) END AS a2021, round_even(d1 / d, 6) AS slope FROM r"""


def holdout(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).withColumn("fc_bin", P.fc_bin(F.col("FUNCTIONAL_CLASS")))
    m = S.holdout_metrics(s.withColumn("guess", F.col("AADT") + F.col("HPMS_AADT") % 9000), "guess", "AADT", ["fc_bin"])
    return m.select("fc_bin", "n", *[round_even(c, 6).alias(c) for c in ("mape", "median_ape", "p95_ape", "within_10_pct")])


HOLDOUT_SQL = f"""WITH {SEGMENTS_SQL}, e AS (SELECT CASE WHEN FUNCTIONAL_CLASS <= 2 THEN '1-2' WHEN FUNCTIONAL_CLASS <= 4 THEN '3-4' WHEN FUNCTIONAL_CLASS <= 6 THEN '5-6' ELSE '7' END AS fc_bin, abs(100.0 * (HPMS_AADT % 9000) / AADT) AS e FROM seg WHERE AADT > 0)
SELECT fc_bin, count(*) AS n, round_even(avg(e), 6) AS mape, round_even(median(e), 6) AS median_ape, round_even(quantile_cont(e, 0.95), 6) AS p95_ape, round_even(100.0 * count(*) FILTER (e <= 10) / count(*), 6) AS within_10_pct FROM e GROUP BY 1"""

TIERS = ["Critical", "High", "Medium", "Low"]


def _tiers(spark: SparkSession, d: str) -> DataFrame:
    k, tiers = F.col("o_orderkey"), F.array(*map(F.lit, TIERS))
    return read(spark, d, "orders").select(F.element_at(tiers, (k % 4 + 1).cast("int")).alias("derived"), F.when(k % 10 != 0, F.element_at(tiers, (F.floor(F.col("o_totalprice")) % 4 + 1).cast("int"))).alias("official"))


_TIERS_SQL = "t AS (SELECT o_orderkey % 4 + 1 AS a, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 4 + 1 END AS b FROM orders)"


def confusion(spark: SparkSession, d: str) -> DataFrame:
    return reports.confusion_matrix(_tiers(spark, d), "derived", "official", TIERS)


CONFUSION_SQL = f"""WITH {_TIERS_SQL} SELECT ['Critical', 'High', 'Medium', 'Low'][b] AS official, {", ".join(f'count(*) FILTER (a = {i + 1}) AS "{x}"' for i, x in enumerate(TIERS))} FROM t GROUP BY 1"""


def agreement(spark: SparkSession, d: str) -> DataFrame:
    m = reports.tier_agreement(_tiers(spark, d), "derived", "official", TIERS)
    return m.withColumns({c: round_even(c, 6) for c in ("exact_pct", "within_one_pct")})


AGREEMENT_SQL = f"""WITH {_TIERS_SQL} SELECT count(*) AS n, round_even(100.0 * count(*) FILTER (a = b) / count(*), 6) AS exact_pct, round_even(100.0 * count(*) FILTER (abs(a - b) <= 1) / count(*), 6) AS within_one_pct,
  count(*) FILTER (a < b) AS promotions, count(*) FILTER (a > b) AS demotions FROM t WHERE b IS NOT NULL"""


def differences(spark: SparkSession, d: str) -> DataFrame:
    """The largest of the rows that disagree; the rest, however far apart, don't count."""
    told = source_agreement(F.col("AADT"), F.col("HPMS_AADT"))
    return reports.largest_differences(segments(spark, d).where("AADT > 20000 or HPMS_AADT > 100"), "AADT", "HPMS_AADT", "miles", "unique_id", agreement=told).select("unique_id", "impact")


DIFFERENCES_SQL = f"WITH {SEGMENTS_SQL} SELECT unique_id, abs(AADT - HPMS_AADT) * miles AS impact FROM seg WHERE (AADT > 20000 OR HPMS_AADT > 100) AND abs(AADT - HPMS_AADT) > 200 AND (AADT = 0 OR abs(AADT - HPMS_AADT) * 100 > 15 * abs(AADT)) ORDER BY 2 DESC, 1 LIMIT 20"


def column_coverage(spark: SparkSession, d: str) -> DataFrame:
    return reports.column_coverage(segments(spark, d), ["AADT", "HPMS_AADT", "miles"]).withColumn("filled_pct", round_even("filled_pct", 6))


COLUMNS_SQL = f"""WITH {SEGMENTS_SQL}, n AS (SELECT count(*) AS rows, count(AADT) AS a, count(HPMS_AADT) AS h, count(miles) AS m FROM seg)
SELECT rows, column_name, filled, round_even(100.0 * filled / rows, 6) AS filled_pct FROM (SELECT rows, 'AADT' AS column_name, a AS filled FROM n UNION ALL SELECT rows, 'HPMS_AADT', h FROM n UNION ALL SELECT rows, 'miles', m FROM n)"""

QUERIES = {
    "knn_per_segment": (knn, f"{PTS}, {_KNN} SELECT unique_id, year, k_rank, tc_number, round_even(distance, 3) AS distance FROM link"),
    "idw_predict": (idw, IDW_SQL),
    "assign_folds": (folds, FOLDS_SQL),
    "station_wide": (wide, WIDE_SQL),
    "trajectory_fit": (trajectory, TRAJECTORY_SQL),
    "holdout_metrics": (holdout, HOLDOUT_SQL),
    "confusion_matrix": (confusion, CONFUSION_SQL),
    "tier_agreement": (agreement, AGREEMENT_SQL),
    "largest_differences": (differences, DIFFERENCES_SQL),
    "column_coverage": (column_coverage, COLUMNS_SQL),
}
