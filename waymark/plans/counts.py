"""Queries on station identities, cohorts, yearly predictions and training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import scalars as P
from waymark.functions.scalars import round_even
from waymark.operators import reports
from waymark.operators import stations as S
from waymark.plans.adapters import made
from waymark.plans.rules import _pick

STATIONS = f"""SELECT CAST(s_suppkey AS VARCHAR(9)) AS tc_number, CAST(2020 + n_nationkey AS INTEGER) AS year, CASE WHEN s_suppkey % 17 <> 0 THEN 33.0 + CAST(s_suppkey % 12 AS DOUBLE) * 0.0031 + CAST(n_nationkey AS DOUBLE) * 0.0007 + CASE WHEN s_suppkey % 10 = 0 AND n_nationkey = 1 THEN 0.4 ELSE 0.0 END END AS latitude,
  CASE WHEN s_suppkey % 19 <> 0 OR n_nationkey = 2 THEN -84.0 + CAST(s_suppkey % 13 AS DOUBLE) * 0.0029 - CAST(n_nationkey % 3 AS DOUBLE) * 0.0011 END AS longitude, CASE WHEN (s_suppkey + n_nationkey) % 11 <> 0 THEN (s_suppkey * 37 + n_nationkey * 101) % 5000 END AS aadt,
  CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 7 + 1 AS INTEGER) END AS functional_class, {_pick(["Actual", "Estimated", "Actual", None], "(s_suppkey + n_nationkey)")} AS statistics_type, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey % 300 END AS single_unit_aadt, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 200 END AS combo_unit_aadt,
  CAST(s_suppkey % 15 AS DOUBLE) AS k_factor, CAST(s_suppkey % 25 AS DOUBLE) AS d_factor, CAST((s_suppkey * 3571 + n_nationkey % 3 * 100) % 50000 AS DOUBLE) AS x, CAST((s_suppkey * 15485) % 50000 AS DOUBLE) AS y FROM supplier CROSS JOIN nation WHERE n_nationkey < 5 AND (n_nationkey < 4 OR s_suppkey % 4 <> 3)"""
POINTS = """SELECT CAST(c_custkey AS VARCHAR(9)) AS unique_id, 'R' || CAST(c_custkey % 60 AS VARCHAR(9)) AS route_id, CAST((c_custkey * 7919) % 50000 AS DOUBLE) AS x, CAST((c_custkey * 104729) % 50000 AS DOUBLE) AS y, CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 7 + 1 AS INTEGER) END AS functional_class, CASE c_custkey % 4 WHEN 0 THEN 99999 WHEN 1 THEN NULL ELSE 60 END AS urban_code,
  CAST(c_custkey % 3 AS INTEGER) AS district, CASE WHEN c_custkey % 6 <> 0 THEN CAST(1000 + (c_custkey * 3) % 500 AS DOUBLE) END AS a2020, CASE WHEN c_custkey % 7 <> 1 THEN CAST(1040 + (c_custkey * 5) % 600 AS DOUBLE) END AS a2022, CASE WHEN c_custkey % 8 <> 2 THEN CAST(1100 + (c_custkey * 7) % 700 AS DOUBLE) END AS a2023, CASE WHEN c_custkey % 9 <> 3 THEN CAST(1150 + (c_custkey * 11) % 800 AS DOUBLE) END AS a2024, CASE WHEN c_custkey % 10 < 3 THEN 1 ELSE 0 END AS synthetic FROM customer"""
_YEARS = (2020, 2022, 2023, 2024)


def _stations(spark: SparkSession, d: str) -> DataFrame:
    return made(spark, d, STATIONS)


def _segments(spark: SparkSession, d: str) -> DataFrame:
    names = {"route_id": "ROUTE_ID", "functional_class": "FUNCTIONAL_CLASS", "urban_code": "URBAN_CODE", "district": "DISTRICT"} | {f"a{y}": f"AADT_{y}_HPMS" for y in _YEARS}
    return made(spark, d, POINTS).withColumnsRenamed(names)


def _links(spark: SparkSession, d: str, k: int = 5) -> DataFrame:
    """k-NN links of all segments and years."""
    years = F.explode(F.array(*[F.lit(y) for y in range(2020, 2025)])).alias("year")
    found = S.knn(_segments(spark, d).select("unique_id", years, "x", "y"), _stations(spark, d), "unique_id", "tc_number", k, ["year"])
    return found.select("unique_id", "year", "k_rank", F.col("tc_number").alias("nearest_tc_number"), F.col("distance").alias("station_distance_m"), (F.col("tc_number").cast("int") % 2).alias("same_route_flag"))


_LINK = """pairs AS (SELECT p.unique_id, s.year, s.tc_number, sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) AS d FROM seg p CROSS JOIN sta s),
link AS (SELECT * FROM (SELECT unique_id, year, CAST(row_number() OVER (PARTITION BY unique_id, year ORDER BY d, tc_number) AS INTEGER) AS k_rank, tc_number AS tc, d, CAST(tc_number AS INTEGER) % 2 AS same FROM pairs) WHERE k_rank <= 5)"""
BASE = f"WITH sta AS ({STATIONS}), seg AS ({POINTS})"
_HAV = "12742000.0 * asin(least(1.0, sqrt(sin(radians(a.latitude - t.latitude) / 2) ** 2 + cos(radians(t.latitude)) * cos(radians(a.latitude)) * sin(radians(a.longitude - t.longitude) / 2) ** 2)))"
_RESOLVED = f"""anc AS (SELECT * FROM sta WHERE year = 2024), ok AS (SELECT * FROM anc WHERE latitude IS NOT NULL AND longitude IS NOT NULL), tar AS (SELECT * FROM sta WHERE year <> 2024),
pr AS (SELECT t.year, t.tc_number, a.tc_number AS a_tc, {_HAV} AS d, t.aadt AS ta, a.aadt AS aa, t.functional_class AS tf, a.functional_class AS af FROM tar t JOIN ok a ON t.latitude IS NOT NULL AND t.longitude IS NOT NULL),
sc AS (SELECT *, 0.30 * d / 500 + 0.35 * coalesce(CASE WHEN ta > 0 AND aa > 0 THEN least(2.0, abs(ln(aa / ta))) / 2 END, 0.5) + 0.35 * coalesce(CAST(tf <> af AS DOUBLE), 0.5) AS score FROM pr),
n AS (SELECT year, tc_number, count(*) FILTER (d <= 500) AS n, min(d) AS far, min(CASE WHEN a_tc = tc_number AND d <= 500 THEN d END) AS own, bool_or(a_tc = tc_number) AS has FROM sc GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER w AS r, lead(score) OVER w - score AS margin FROM sc WHERE d <= 500 WINDOW w AS (PARTITION BY year, tc_number ORDER BY score, a_tc)),
res AS (SELECT t.year, t.tc_number, CASE WHEN n.own IS NOT NULL THEN 'GA24_' || t.tc_number WHEN n.n >= 1 THEN 'GA24_' || rk.a_tc ELSE 'GA' || CAST(t.year % 100 AS VARCHAR) || '_' || t.tc_number END AS station_uid,
    CASE WHEN n.n IS NULL THEN 'unresolved' WHEN n.own IS NOT NULL THEN 'tc_number' WHEN n.n = 1 THEN 'spatial' WHEN n.n > 1 THEN 'scored' WHEN n.has THEN 'tc_conflict' ELSE 'unresolved' END AS resolver_method, CASE WHEN n.own IS NOT NULL THEN n.own WHEN n.n >= 1 THEN rk.d ELSE n.far END AS delta,
    CASE WHEN n.own IS NULL AND n.n > 1 AND rk.margin > 0.10 THEN 'high' WHEN n.own IS NULL AND n.n > 1 AND rk.margin > 0.05 THEN 'medium' ELSE 'low' END AS resolver_confidence
  FROM tar t LEFT JOIN n USING (year, tc_number) LEFT JOIN rk ON rk.year = t.year AND rk.tc_number = t.tc_number AND rk.r = 1
  UNION ALL SELECT year, tc_number, 'GA24_' || tc_number, 'anchor', CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 0.0 END, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 'high' ELSE 'low' END FROM anc)"""


def resolver(spark: SparkSession, d: str) -> DataFrame:
    return S.run_resolver(_stations(spark, d)).withColumn("resolver_delta_m", round_even("resolver_delta_m", 3))


RESOLVER_SQL = f"{BASE}, {_RESOLVED} SELECT year, tc_number, station_uid, resolver_method, round_even(delta, 3) AS resolver_delta_m, resolver_confidence FROM res"


def resolver_report(spark: SparkSession, d: str) -> DataFrame:
    told = S.resolver_report(S.run_resolver(_stations(spark, d)))
    return told.withColumns({c: round_even(c, 3) for c in ("resolved_pct", "median_m", "p95_m", "max_m")})


_MOVED = "CASE WHEN resolver_method <> 'anchor' THEN delta END"
REPORT_SQL = f"""{BASE}, {_RESOLVED} SELECT year, count(*) AS rows, {", ".join(f"count(*) FILTER (resolver_method = '{m}') AS {m}" for m in ("anchor", "tc_number", "spatial", "scored", "tc_conflict", "unresolved"))}, {", ".join(f"count(*) FILTER (resolver_confidence = '{c}') AS {c}" for c in ("high", "medium", "low"))},
  round_even(100.0 * count(*) FILTER (resolver_method <> 'unresolved') / count(*), 3) AS resolved_pct, round_even(quantile_cont({_MOVED}, 0.5), 3) AS median_m, round_even(quantile_cont({_MOVED}, 0.95), 3) AS p95_m, round_even(max({_MOVED}), 3) AS max_m FROM res GROUP BY year"""


def station_routes(spark: SparkSession, d: str) -> DataFrame:
    """Stations of one year with their inferred route and the value of the nearest segment that has one, and links of segments with the route flag."""
    s = _stations(spark, d).where("year = 2022")
    seg = _segments(spark, d)
    routes = S.station_routes(seg, s)
    valued = S.attach_nearest_value(s.select("tc_number", "x", "y"), seg, "AADT_2022_HPMS", "future", station="tc_number")
    link = S.nearest_station(seg, s, "unique_id", "tc_number")
    flagged = S.same_route_flag(link, seg, routes)
    a = routes.join(valued, "tc_number").select(F.lit("station").alias("kind"), F.col("tc_number").alias("id"), F.col("inferred_route").alias("name"), F.col("future").alias("value"), F.lit(None).cast("int").alias("flag"))
    return a.unionByName(flagged.select(F.lit("segment").alias("kind"), F.col("unique_id").alias("id"), F.col("tc_number").alias("name"), round_even("distance", 3).alias("value"), F.col("same_route_flag").alias("flag")))


ROUTES_SQL = f"""{BASE}, s AS (SELECT * FROM sta WHERE year = 2022), p AS (SELECT s.tc_number, g.unique_id, g.route_id, g.a2022, sqrt(pow(g.x - s.x, 2) + pow(g.y - s.y, 2)) AS d FROM s CROSS JOIN seg g),
r AS (SELECT tc_number, route_id FROM p QUALIFY row_number() OVER (PARTITION BY tc_number ORDER BY d, unique_id) = 1), v AS (SELECT tc_number, a2022 FROM p WHERE a2022 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tc_number ORDER BY d, unique_id) = 1),
k AS (SELECT unique_id, route_id, tc_number, d FROM p QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY d, tc_number) = 1)
SELECT 'station' AS kind, tc_number AS id, route_id AS name, a2022 AS value, CAST(NULL AS INTEGER) AS flag FROM r JOIN v USING (tc_number) UNION ALL SELECT 'segment', k.unique_id, k.tc_number, round_even(k.d, 3), CAST(k.route_id = r.route_id AS INTEGER) FROM k JOIN r USING (tc_number)"""


def _station_cohorts(spark: SparkSession, d: str) -> DataFrame:
    s = _stations(spark, d)
    actual = s.where("statistics_type = 'Actual'").select("year", "tc_number", "aadt")
    return S.station_segment_attributes(actual, S.run_resolver(s), _links(spark, d), _segments(spark, d))


def station_cohorts(spark: SparkSession, d: str) -> DataFrame:
    found = S.station_cohort_ratios(_station_cohorts(spark, d), min_size=5)
    return found.withColumns({c: round_even(c, 6) for c in ("median_value", "ratio_2022", "ratio_2024")})


_BIN = "CASE WHEN g.functional_class <= 2 THEN '1-2' WHEN g.functional_class <= 4 THEN '3-4' WHEN g.functional_class <= 6 THEN '5-6' WHEN g.functional_class = 7 THEN '7' END"
_AREA = "CASE WHEN g.urban_code = 99999 THEN 'rural' WHEN g.urban_code IS NOT NULL THEN 'urban' END"
_FIRST = """f1 AS (SELECT year, tc, unique_id FROM link WHERE k_rank = 1 QUALIFY row_number() OVER (PARTITION BY year, tc ORDER BY d, unique_id) = 1)"""


def _cohort_sql(rows: str, version: str, size: str, least: int) -> str:
    """Cohorts at both levels of ``rows`` (version, fc_bin, urban_rural, district, v20, v22, v24)."""
    v = f"{version}, " if version else ""
    stats = f"{size} AS n, median(v20) AS m, median(CASE WHEN v20 > 0 THEN v22 / v20 END) AS r22, median(CASE WHEN v20 > 0 THEN v24 / v20 END) AS r24"
    same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM q.{c}" for c in ([version] if version else []) + ["fc_bin", "urban_rural"])
    taken = ", ".join(f"CASE WHEN o.n < {least} THEN q.{a} ELSE o.{a} END AS {b}" for a, b in (("n", "n"), ("m", "median_value"), ("r22", "ratio_2022"), ("r24", "ratio_2024")))
    return f"""o AS (SELECT {v}fc_bin, urban_rural, district, {stats} FROM {rows} GROUP BY {v}fc_bin, urban_rural, district), q AS (SELECT {v}fc_bin, urban_rural, {stats} FROM {rows} GROUP BY {v}fc_bin, urban_rural),
coh AS (SELECT {f'o.{version}, ' if version else ''}o.fc_bin, o.urban_rural, o.district, {taken}, CAST(o.n < {least} AS INTEGER) AS fallback_used FROM o JOIN q ON {same})"""


_FOLDED = """fo AS (SELECT station_uid, CAST((row_number() OVER (ORDER BY md5('42' || station_uid), station_uid) - 1) % 5 AS INTEGER) AS fold FROM (SELECT DISTINCT station_uid FROM acts))"""
STATION_COHORTS_SQL = f"""{BASE}, {_LINK}, {_RESOLVED}, {_FIRST}, acts AS (SELECT s.year, s.tc_number, s.aadt, res.station_uid, {_BIN} AS fc_bin, {_AREA} AS urban_rural, g.district FROM sta s LEFT JOIN res USING (year, tc_number) LEFT JOIN f1 ON f1.year = s.year AND f1.tc = s.tc_number LEFT JOIN seg g ON g.unique_id = f1.unique_id WHERE s.statistics_type = 'Actual'),
w AS (SELECT station_uid, fc_bin, urban_rural, district, CAST(min(aadt) FILTER (year = 2020) AS DOUBLE) AS v20, CAST(min(aadt) FILTER (year = 2022) AS DOUBLE) AS v22, CAST(min(aadt) FILTER (year = 2024) AS DOUBLE) AS v24 FROM acts WHERE fc_bin IS NOT NULL AND urban_rural IS NOT NULL AND district IS NOT NULL GROUP BY 1, 2, 3, 4), {_FOLDED},
x AS (SELECT w.*, v.version FROM w JOIN fo USING (station_uid) JOIN (SELECT 'full' AS version, -1 AS gone UNION ALL SELECT 'fold_' || CAST(i AS VARCHAR), i FROM generate_series(0, 4) t(i)) v ON fo.fold <> v.gone), {_cohort_sql("x", "version", "count(DISTINCT station_uid)", 5)}
SELECT version, fc_bin, urban_rural, district, n, round_even(median_value, 6) AS median_value, round_even(ratio_2022, 6) AS ratio_2022, round_even(ratio_2024, 6) AS ratio_2024, fallback_used FROM coh"""


def segment_cohorts(spark: SparkSession, d: str) -> DataFrame:
    return S.cohort_ratios(_segments(spark, d), 40).withColumns({c: round_even(c, 6) for c in ("median_value", "ratio_2022", "ratio_2024")})


_SEG_ROWS = f"x AS (SELECT {_BIN} AS fc_bin, {_AREA} AS urban_rural, district, a2020 AS v20, a2022 AS v22, a2024 AS v24 FROM seg g)"
SEGMENT_COHORTS_SQL = f"""{BASE}, {_SEG_ROWS}, {_cohort_sql("x", "", "count(*)", 40)}
SELECT v AS version, fc_bin, urban_rural, district, n, CASE WHEN v <> 'exclude_2020' THEN round_even(median_value, 6) END AS median_value, CASE WHEN v NOT IN ('exclude_2020', 'exclude_2022') THEN round_even(ratio_2022, 6) END AS ratio_2022, CASE WHEN v NOT IN ('exclude_2020', 'exclude_2024') THEN round_even(ratio_2024, 6) END AS ratio_2024, fallback_used
FROM coh CROSS JOIN (SELECT unnest(['full', 'exclude_2020', 'exclude_2022', 'exclude_2023', 'exclude_2024']) AS v)"""


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Predictions of two years with trucks, and fills of null local classes (2022) and flagged segments (2020)."""
    link, s, seg = _links(spark, d), _stations(spark, d), _segments(spark, d)
    told = S.idw_all_years(link, s, [2020, 2022]).select("unique_id", "AADT_2020_MODELED", "AADT_2022_NEIGHBOR_MAX", "AADT_2022_CONFIDENCE", "AADT_2020_N_STATIONS_USED", "TRUCK_AADT_2022_MODELED")
    fills = S.idw_fill(seg, F.col("FUNCTIONAL_CLASS").isin(6, 7) & F.col("AADT_2022_HPMS").isNull(), link, s, 2022)
    fills = S.idw_fill(fills, F.col("synthetic") == 1, link, s, 2020)
    return told.join(fills.select("unique_id", "AADT_2022_LOCAL_FILL", "AADT_2022_LOCAL_FILL_CONFIDENCE", "AADT_2020_LOCAL_FILL"), "unique_id")


def _idw(name: str, value: str) -> str:
    return f"""{name} AS (SELECT l.unique_id, l.year, round_even(sum(v / greatest(l.d, 1)) / sum(CASE WHEN v IS NOT NULL THEN 1 / greatest(l.d, 1) END), 0) AS p, max(v) AS high, count(v) AS n, min(l.d) AS d1, arg_min(l.same, l.k_rank) AS s1 FROM (SELECT l.*, CASE WHEN l.d <= 2000 THEN CAST({value} AS DOUBLE) END AS v FROM link l LEFT JOIN sta s ON s.year = l.year AND s.tc_number = l.tc) l GROUP BY 1, 2)"""


_TRUCK = "CASE WHEN s.single_unit_aadt IS NOT NULL OR s.combo_unit_aadt IS NOT NULL THEN coalesce(s.single_unit_aadt, 0) + coalesce(s.combo_unit_aadt, 0) END"
_CONF = "CASE WHEN {0}.n = 0 THEN 'none' WHEN {0}.d1 <= 500 AND {0}.s1 = 1 THEN 'high' ELSE 'medium' END"
PREDICTIONS_SQL = f"""{BASE}, {_LINK}, {_idw("t", "s.aadt")}, {_idw("h", _TRUCK)}
SELECT g.unique_id, CAST(a.p AS BIGINT) AS "AADT_2020_MODELED", CAST(greatest(b.high, b.p) AS BIGINT) AS "AADT_2022_NEIGHBOR_MAX", {_CONF.format("b")} AS "AADT_2022_CONFIDENCE", a.n AS "AADT_2020_N_STATIONS_USED", CAST(c.p AS BIGINT) AS "TRUCK_AADT_2022_MODELED",
  CASE WHEN g.functional_class IN (6, 7) AND g.a2022 IS NULL THEN CAST(b.p AS BIGINT) END AS "AADT_2022_LOCAL_FILL", CASE WHEN g.functional_class IN (6, 7) AND g.a2022 IS NULL AND b.p IS NOT NULL THEN {_CONF.format("b")} END AS "AADT_2022_LOCAL_FILL_CONFIDENCE", CASE WHEN g.synthetic = 1 THEN CAST(a.p AS BIGINT) END AS "AADT_2020_LOCAL_FILL"
FROM seg g JOIN t a ON a.unique_id = g.unique_id AND a.year = 2020 JOIN t b ON b.unique_id = g.unique_id AND b.year = 2022 JOIN h c ON c.unique_id = g.unique_id AND c.year = 2022"""


def training(spark: SparkSession, d: str) -> DataFrame:
    s, seg, link = _stations(spark, d), _segments(spark, d), _links(spark, d)
    rows = S.training_rows(s, S.run_resolver(s), link, seg, S.cohort_ratios(seg, 40))
    return rows.select(
        "station_uid", "year", "tc_number", "fold", "nearest_segment_uid", "fc_bin", "urban_rural", "district", "cohort_size", round_even("ratio_2022", 6).alias("ratio_2022"), "years_since_2020", "covid_phase_weight", round_even("target", 6).alias("target"), "sample_weight",
        round_even("knn_distance_1", 3).alias("knn_distance_1"), "knn_aadt_1", "knn_is_actual_2", "knn_fc_3", "knn_same_route_1", "num_neighbors_within_1km", "num_neighbors_within_5km",
    )


_RANKED = "max(CASE WHEN r = {0} THEN {1} END)"
TRAINING_SQL = f"""{BASE}, {_LINK}, {_RESOLVED}, {_FIRST}, tr AS (SELECT res.station_uid, s.year, s.tc_number, s.aadt FROM sta s JOIN res USING (year, tc_number) WHERE s.statistics_type = 'Actual' AND s.year IN (2020, 2022, 2023, 2024) QUALIFY row_number() OVER (PARTITION BY res.station_uid, s.year ORDER BY s.tc_number, s.aadt) = 1),
acts AS (SELECT * FROM tr), {_FOLDED}, b AS (SELECT tr.*, fo.fold, f1.unique_id AS near, g.functional_class, {_BIN} AS fc_bin, {_AREA} AS urban_rural, g.district FROM tr JOIN fo USING (station_uid) LEFT JOIN f1 ON f1.year = tr.year AND f1.tc = tr.tc_number LEFT JOIN seg g ON g.unique_id = f1.unique_id),
m AS (SELECT b.station_uid, b.year, l.tc, l.d, l.same, row_number() OVER (PARTITION BY b.station_uid, b.year ORDER BY l.d, l.tc) AS r FROM b JOIN link l ON l.unique_id = b.near AND l.year = b.year AND l.tc <> b.tc_number),
k AS (SELECT m.station_uid, m.year, {_RANKED.format(1, "m.d")} AS d1, {_RANKED.format(1, "s.aadt")} AS a1, {_RANKED.format(2, "CAST(coalesce(s.statistics_type = 'Actual', false) AS INTEGER)")} AS k2, bool_or(r = 2 AND s.aadt IS NULL AND s.statistics_type IS NULL) AS none2, {_RANKED.format(3, "s.functional_class")} AS f3, {_RANKED.format(1, "m.same")} AS s1, count(*) FILTER (d <= 1000) AS n1, count(*) FILTER (d <= 5000) AS n5 FROM m LEFT JOIN sta s ON s.year = m.year AND s.tc_number = m.tc WHERE r <= 5 GROUP BY 1, 2),
{_SEG_ROWS}, {_cohort_sql("x", "", "count(*)", 40)}
SELECT b.station_uid, b.year, b.tc_number, b.fold, b.near AS nearest_segment_uid, b.fc_bin, b.urban_rural, b.district, coh.n AS cohort_size, round_even(coh.ratio_2022, 6) AS ratio_2022, b.year - 2020 AS years_since_2020, CAST(CASE b.year WHEN 2020 THEN 1.0 WHEN 2022 THEN 0.15 WHEN 2023 THEN 0.05 ELSE 0.0 END AS DOUBLE) AS covid_phase_weight, round_even(ln(greatest(b.aadt, 1)), 6) AS target,
  CAST(CASE WHEN b.year = 2020 AND b.urban_rural = 'urban' AND b.functional_class IN (1, 2, 3) THEN 0.5 ELSE 1.0 END AS DOUBLE) AS sample_weight, round_even(k.d1, 3) AS knn_distance_1, k.a1 AS knn_aadt_1, CASE WHEN NOT k.none2 THEN k.k2 END AS knn_is_actual_2, k.f3 AS knn_fc_3, k.s1 AS knn_same_route_1, k.n1 AS num_neighbors_within_1km, k.n5 AS num_neighbors_within_5km
FROM b LEFT JOIN k USING (station_uid, year) LEFT JOIN coh ON coh.fc_bin = b.fc_bin AND coh.urban_rural = b.urban_rural AND coh.district = b.district"""


def hidden_years(spark: SparkSession, d: str) -> DataFrame:
    """Predictions of hidden 2022 and 2023, judged by class bin, with the gates."""
    seg = _segments(spark, d).withColumns({"fc_bin": P.fc_bin(F.col("FUNCTIONAL_CLASS")), "area": P.urban_rural(F.col("URBAN_CODE"))})
    values = {y: F.col(f"AADT_{y}_HPMS") for y in _YEARS}
    seg = seg.where(S.eligible_for_fit(*values.values()))
    wide = S.covid_widened(F.col("FUNCTIONAL_CLASS"), F.col("area"))
    parts = [S.validation_gates(S.holdout_metrics(seg.withColumn("guess", S.predict_held_out(y, values, wide)), "guess", f"AADT_{y}_HPMS", ["fc_bin"])).withColumn("year", F.lit(y)) for y in (2022, 2023)]
    return parts[0].unionByName(parts[1]).select("year", "fc_bin", "n", *[round_even(c, 6).alias(c) for c in ("mape", "median_ape", "p95_ape", "within_10_pct")], "passes", "stops")


def _fit(year: int) -> str:
    rest = [y for y in _YEARS if y != year]
    c = sum(rest) / 3
    t = [y - c for y in rest]
    # the parabola through three points, in Lagrange's form
    x = year - c
    terms = [f"ln(a{rest[i]}) * {((x - t[(i + 1) % 3]) * (x - t[(i + 2) % 3])) / ((t[i] - t[(i + 1) % 3]) * (t[i] - t[(i + 2) % 3]))!r}" for i in range(3)]
    later = "coalesce(a2023, a2024, a2020)" if year == 2022 else "a2022"
    low = f"greatest(least(a2020, {later}) * CASE WHEN urban_code <> 99999 AND functional_class IN (1, 2, 3) THEN 0.5 ELSE 0.8 END, {later} * 0.5)"
    return f"SELECT {year} AS year, {_BIN.replace('g.', '')} AS fc_bin, a{year} AS truth, least(greatest(a2020, {later}) * 1.2, greatest({low}, exp({' + '.join(terms)}))) AS guess FROM seg WHERE a2020 IS NOT NULL AND a2022 IS NOT NULL AND (a2023 IS NOT NULL OR a2024 IS NOT NULL) AND a{year} IS NOT NULL AND {' AND '.join(f'a{y} IS NOT NULL' for y in rest)}"


HIDDEN_SQL = f"""{BASE}, e AS (SELECT year, fc_bin, abs(100.0 * (guess - truth) / truth) AS e FROM ({_fit(2022)} UNION ALL {_fit(2023)})),
m AS (SELECT year, fc_bin, count(*) AS n, avg(e) AS a, median(e) AS b, quantile_cont(e, 0.95) AS c, 100.0 * count(*) FILTER (e <= 10) / count(*) AS w FROM e GROUP BY 1, 2)
SELECT year, fc_bin, n, round_even(a, 6) AS mape, round_even(b, 6) AS median_ape, round_even(c, 6) AS p95_ape, round_even(w, 6) AS within_10_pct, w >= 80 AND b <= 8 AS passes, a > 25 AS stops FROM m"""


def flagged_actuals(spark: SparkSession, d: str) -> DataFrame:
    """Stations of type Actual on flagged segments with their value, and a report of the flags: rates by class, and a sample by hash."""
    link, s = _links(spark, d, 1), _stations(spark, d)
    seg = _segments(spark, d).join(link.where("year = 2022").join(s.where("year = 2022").select(F.col("tc_number").alias("nearest_tc_number"), "aadt"), "nearest_tc_number").select("unique_id", F.when(F.col("unique_id").cast("int") % 2 == 0, F.col("aadt")).otherwise(F.col("aadt") + 5).alias("value")), "unique_id", "left")
    met = S.actual_on_flagged(link.where("year = 2022"), s.where("year = 2022"), seg, "synthetic", "value")
    a = met.select(F.lit("actual").alias("kind"), "unique_id", F.col("tc_number").alias("name"), F.col("value").cast("double").alias("value"))
    report, sample = reports.flag_rates(seg, "synthetic", ["FUNCTIONAL_CLASS"]), reports.sample_by_hash(seg.where("synthetic = 1"), "unique_id", ["FUNCTIONAL_CLASS"], 3)
    b = report.select(F.lit("rate").alias("kind"), F.col("FUNCTIONAL_CLASS").cast("string").alias("unique_id"), F.concat_ws("/", "flagged", "rows").alias("name"), round_even("flagged_pct", 6).alias("value"))
    c = sample.select(F.lit("sample").alias("kind"), "unique_id", F.col("FUNCTIONAL_CLASS").cast("string").alias("name"), F.lit(None).cast("double").alias("value"))
    return a.unionByName(b).unionByName(c)


ACTUALS_SQL = f"""{BASE}, {_LINK}, k AS (SELECT l.unique_id, l.tc, s.aadt, s.statistics_type, CASE WHEN CAST(l.unique_id AS INTEGER) % 2 = 0 THEN s.aadt ELSE s.aadt + 5 END AS value FROM link l JOIN sta s ON s.year = 2022 AND s.tc_number = l.tc WHERE l.year = 2022 AND l.k_rank = 1)
SELECT 'actual' AS kind, k.unique_id, k.tc AS name, CAST(k.value AS DOUBLE) AS value FROM k JOIN seg g USING (unique_id) WHERE g.synthetic = 1 AND k.statistics_type = 'Actual' AND abs(k.aadt - k.value) < 1
UNION ALL SELECT 'rate', CAST(functional_class AS VARCHAR), count(*) FILTER (synthetic = 1) || '/' || count(*), round_even(100.0 * count(*) FILTER (synthetic = 1) / count(*), 6) FROM seg GROUP BY functional_class
UNION ALL SELECT 'sample', unique_id, CAST(functional_class AS VARCHAR), NULL FROM (SELECT * FROM seg WHERE synthetic = 1 QUALIFY row_number() OVER (PARTITION BY functional_class ORDER BY md5(unique_id), unique_id) <= 3)"""

QUERIES = {
    "run_resolver": (resolver, RESOLVER_SQL),
    "resolver_report": (resolver_report, REPORT_SQL),
    "station_routes": (station_routes, ROUTES_SQL),
    "station_cohort_ratios": (station_cohorts, STATION_COHORTS_SQL),
    "cohort_ratios": (segment_cohorts, SEGMENT_COHORTS_SQL),
    "idw_all_years": (predictions, PREDICTIONS_SQL),
    "training_rows": (training, TRAINING_SQL),
    "holdout_predict": (hidden_years, HIDDEN_SQL),
    "actual_on_flagged": (flagged_actuals, ACTUALS_SQL),
}
