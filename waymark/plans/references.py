"""Queries on speed zones, signed-route references, yearly values and other joins by route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.scalars import round_even
from waymark.operators import intervals, verification as V
from waymark.plans.adapters import REFERENCE_SQL, SEGMENTS_SQL, made, reference, segments
from waymark.plans.rules import _pick
from waymark.sources import tables

SEG = f"WITH {SEGMENTS_SQL}"

ROADS = f"""SELECT o_orderkey AS unique_id, '1' || lpad(CAST(o_orderkey % 90 AS VARCHAR(9)), 3, '0') || {_pick(["1", "1", "2"], "o_orderkey")} || lpad(CAST(o_orderkey % 40 AS VARCHAR(9)), 6, '0') || '00INC' AS route_id, {_pick(["1", "1", "2"], "o_orderkey")} AS system_code,
  CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 17 AS DOUBLE) END AS from_mp, CAST(o_orderkey % 17 + 1 + o_orderkey % 3 AS DOUBLE) AS to_mp, {_pick(["Interstate", "U.S. Route", "State Route", "Local/Other", None], "o_orderkey")} AS route_family, {_pick(["high", "low", "medium", None], "o_orderkey")} AS family_confidence,
  {_pick(["Oak Street", "Elm Rd.", " Main ", None, "Pine Ave (School Zone)"], "o_orderkey")} AS road, CAST(o_orderkey % 120 AS VARCHAR(9)) AS county FROM orders"""
ZONES = f"""SELECT p_partkey AS n, ' 1' || lpad(CAST(p_partkey % 90 AS VARCHAR(9)), 3, '0') || '1' || lpad(CAST(p_partkey % 40 AS VARCHAR(9)), 6, '0') || '00x' AS route_id, CAST(p_partkey % 13 AS DOUBLE) AS from_milepoint, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_partkey % 13 + 2 AS DOUBLE) + CAST(p_partkey % 5 AS DOUBLE) / 4 END AS to_milepoint,
  {_pick(["25", " 35 ", "45", None, "x"], "p_partkey")} AS speed_limit_cd, {_pick(["Y", "N", None], "p_partkey")} AS is_school_zone_cd, {_pick(["ACTV", "actv ", "OLD"], "CAST(floor(p_partkey / 2) AS BIGINT)")} AS record_status_cd, {_pick(["OAK ST", "Elm Road", "main", "PINE AVENUE"], "p_partkey")} AS road_name, CAST(p_partkey % 120 AS VARCHAR(9)) AS county_fips_cd FROM part"""


def _roads(spark: SparkSession, d: str) -> DataFrame:
    names = {"route_id": "ROUTE_ID", "system_code": "SYSTEM_CODE", "route_family": "ROUTE_FAMILY", "family_confidence": "ROUTE_FAMILY_CONFIDENCE", "road": "HPMS_ROUTE_NAME", "county": "COUNTY_CODE"}
    return made(spark, d, ROADS).withColumnsRenamed(names)


def speed_zones(spark: SparkSession, d: str) -> DataFrame:
    zones = made(spark, d, ZONES)
    on = V.speed_zones_on_system(_roads(spark, d), V.normalize_speed_zones(zones.drop("n")))
    off = V.speed_zones_off_system(on, zones)
    return off.select("unique_id", F.col("SPEED_LIMIT").alias("speed"), F.col("IS_SCHOOL_ZONE").alias("school"), F.col("SPEED_LIMIT_SOURCE").alias("source"))


SPEED_SQL = f"""WITH s AS ({ROADS}), z0 AS ({ZONES}), z AS (SELECT left(upper(trim(route_id)), 13) AS base, from_milepoint AS f, to_milepoint AS t, CAST(TRY_CAST(trim(speed_limit_cd) AS DOUBLE) AS BIGINT) AS v, coalesce(is_school_zone_cd = 'Y', false) AS school, road_name, lpad(county_fips_cd, 3, '0') AS county FROM z0 WHERE upper(trim(record_status_cd)) = 'ACTV' AND TRY_CAST(trim(speed_limit_cd) AS DOUBLE) IS NOT NULL),
o AS (SELECT s.unique_id, z.v, z.school FROM s JOIN z ON s.system_code = '1' AND left(s.route_id, 13) = z.base AND least(s.to_mp, z.t) - greatest(s.from_mp, z.f) > 1e-4 AND s.from_mp IS NOT NULL AND z.t IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY s.unique_id ORDER BY least(s.to_mp, z.t) - greatest(s.from_mp, z.f) DESC, z.f, z.v, z.school) = 1),
n AS (SELECT CASE road_name WHEN 'OAK ST' THEN 'Oak Street' WHEN 'Elm Road' THEN 'Elm Rd.' WHEN 'main' THEN ' Main ' ELSE 'Pine Ave (School Zone)' END AS road, county, min(v) AS v, bool_or(school) AS school FROM z GROUP BY 1, 2 HAVING min(v) = max(v))
SELECT s.unique_id, coalesce(o.v, n.v) AS speed, CASE WHEN o.v IS NOT NULL THEN o.school ELSE coalesce(n.school, false) END AS school, CASE WHEN o.v IS NOT NULL THEN 'gdot_speed_zone_on_system' WHEN n.v IS NOT NULL THEN 'gdot_speed_zone_off_system' END AS source
FROM s LEFT JOIN o USING (unique_id) LEFT JOIN n ON s.road = n.road AND lpad(s.county, 3, '0') = n.county"""

LINKS = """SELECT p_partkey AS n, lpad(CAST(p_partkey % 90 AS VARCHAR(9)), 3, '0') || '1' || lpad(CAST(p_partkey % 40 AS VARCHAR(9)), 4, '0') || '00' AS link, '1' || lpad(CAST(p_partkey % 90 AS VARCHAR(9)), 3, '0') || '1' || lpad(CAST(p_partkey % 40 AS VARCHAR(9)), 6, '0') || '00INC' AS whole, '0001' || lpad(CAST(p_partkey % 40 AS VARCHAR(9)), 4, '0') || '00' AS state_link,
  CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_partkey % 15 AS DOUBLE) END AS f, CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_partkey % 15 + 1 AS DOUBLE) END AS t, 'L' || CAST(p_partkey % 9 AS VARCHAR(9)) AS lab, CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE CAST(p_partkey % 5 AS VARCHAR(9)) END AS lab2 FROM part"""


def verification(spark: SparkSession, d: str) -> DataFrame:
    s, r = _roads(spark, d), made(spark, d, LINKS)
    layers = {
        "interstates": V.normalize_reference_layer(r.where("n % 5 = 0").select(F.col("whole").alias("route_id"), F.col("f").alias("FROM_MILEPOINT"), F.col("t").alias("TO_MILEPOINT"), F.col("lab").alias("interstate_name"), F.col("lab2").alias("route_number")), "interstates", by_route_id=True),
        "us_highway": V.normalize_reference_layer(r.where("n % 5 = 1").select(F.col("link").alias("RC_LINK"), F.col("f").alias("BEGINNING_MP"), F.col("t").alias("ENDING_MP"), F.col("lab").alias("US_ROUTE_NUM")), "us_highway"),
        "state_routes": V.normalize_reference_layer(r.where("n % 5 = 2").select(F.col("state_link").alias("rclink"), F.col("f").alias("BEGINNING_MILEPOINT"), F.col("t").alias("ENDING_MILEPOINT"), F.col("lab").alias("ROUTE_NUMBER"), F.col("lab2").alias("ROUTE_SUFFIX")), "state_routes"),
    }
    told = V.verify_signed_routes(s, layers)
    return told.select(
        "unique_id", F.col("SIGNED_ROUTE_FAMILY_PRIMARY").alias("first_family"), F.col("SECONDARY_SIGNED_ROUTE_FAMILY").alias("second_family"), F.col("TERTIARY_SIGNED_ROUTE_FAMILY").alias("third_family"), F.col("SIGNED_ROUTE_VERIFY_SOURCE").alias("source"),
        F.col("SIGNED_ROUTE_VERIFY_METHOD").alias("method"), F.col("SIGNED_ROUTE_VERIFY_CONFIDENCE").alias("confidence"), F.col("SIGNED_ROUTE_VERIFY_SCORE").alias("score"), F.col("SIGNED_ROUTE_VERIFY_NOTES").alias("notes"), F.col("SIGNED_US_ROUTE_FLAG").alias("on_us"),
    )


def _layer(name: str, rest: int, key: str, lab2: bool) -> str:
    return f"{name} AS (SELECT left({key}, 13) AS k, f, t, lab, {'trim(lab2)' if lab2 else 'NULL'} AS lab2 FROM r WHERE n % 5 = {rest})"


def _match(name: str, layer: str) -> str:
    return f"""{name} AS (SELECT c.unique_id, l.lab, nullif(l.lab2, '') AS lab2, l.f IS NOT NULL AND l.t IS NOT NULL AS iv FROM cand c JOIN {layer} l ON c.k = l.k WHERE c.from_mp IS NULL OR l.f IS NULL OR l.t IS NULL OR least(c.to_mp, l.t) - greatest(c.from_mp, l.f) > 1e-4
  QUALIFY row_number() OVER (PARTITION BY c.unique_id ORDER BY c.pos, l.f NULLS LAST, l.t NULLS LAST, l.lab, l.lab2 NULLS FIRST) = 1)"""


_R = "CASE {0} WHEN 'Interstate' THEN 1 WHEN 'U.S. Route' THEN 2 WHEN 'State Route' THEN 3 ELSE 9 END"


def _step(name: str, before: str, match: str, kind: str, family: str, rank: int) -> str:
    p = f"(m.unique_id IS NOT NULL AND {rank} <= {_R.format('b.fam')})"
    return f"""{name} AS (SELECT b.unique_id, CASE WHEN {p} THEN '{family}' ELSE b.fam END AS fam, CASE WHEN m.unique_id IS NOT NULL THEN list_distinct(list_concat(b.fams, ['{family}'])) ELSE b.fams END AS fams, CASE WHEN {p} THEN 'gdot_{kind}' ELSE b.source END AS source,
  CASE WHEN {p} THEN CASE WHEN m.iv THEN 'derived_rclink_interval' ELSE 'derived_rclink_exact' END ELSE b.method END AS method, CASE WHEN {p} THEN 'high' ELSE b.confidence END AS confidence, CASE WHEN {p} THEN CAST(0.95 AS DOUBLE) ELSE b.score END AS score,
  CASE WHEN m.unique_id IS NOT NULL THEN concat_ws('; ', b.notes, 'official_{kind}_match', 'label=' || m.lab, 'state_label=' || m.lab2) ELSE b.notes END AS notes, b.hit OR m.unique_id IS NOT NULL AS hit FROM {before} b LEFT JOIN {match} m USING (unique_id))"""


VERIFY_SQL = f"""WITH s AS ({ROADS}), r AS ({LINKS}), {_layer("l1", 0, "whole", True)}, {_layer("l2", 1, "link", False)}, {_layer("l3", 2, "state_link", True)},
cand AS (SELECT unique_id, from_mp, to_mp, 0 AS pos, left(route_id, 13) AS k FROM s WHERE system_code = '1' UNION ALL SELECT unique_id, from_mp, to_mp, 1, route_id[2:4] || route_id[5:5] || right(route_id[6:11], 4) || route_id[12:13] FROM s WHERE system_code = '1'
  UNION ALL SELECT unique_id, from_mp, to_mp, 2, '0001' || right(route_id[6:11], 4) || route_id[12:13] FROM s WHERE system_code = '1' AND route_id[5:5] = '1' AND route_id[2:4] <> '000'),
{_match("m1", "l1")}, {_match("m2", "l2")}, {_match("m3", "l3")},
b0 AS (SELECT unique_id, route_family AS fam, CASE WHEN route_family IN ('Interstate', 'U.S. Route', 'State Route') THEN [route_family] ELSE [] END AS fams, 'route_id_crosswalk' AS source, 'route_id_crosswalk' AS method, family_confidence AS confidence, CASE family_confidence WHEN 'high' THEN CAST(0.95 AS DOUBLE) WHEN 'medium' THEN 0.6 ELSE 0.3 END AS score, CAST(NULL AS VARCHAR) AS notes, false AS hit FROM s),
{_step("b1", "b0", "m1", "interstates", "Interstate", 1)}, {_step("b2", "b1", "m2", "us_highway", "U.S. Route", 2)}, {_step("b3", "b2", "m3", "state_routes", "State Route", 3)},
o AS (SELECT *, list_filter(['Interstate', 'U.S. Route', 'State Route'], lambda f: list_contains(fams, f) AND f <> fam) AS rest FROM b3)
SELECT unique_id, fam AS first_family, CASE WHEN hit THEN rest[1] END AS second_family, CASE WHEN hit THEN rest[2] END AS third_family, source, method, confidence, score, notes, CASE WHEN hit THEN list_contains(fams, 'U.S. Route') ELSE coalesce(fam = 'U.S. Route', false) END AS on_us FROM o"""


def history(spark: SparkSession, d: str) -> DataFrame:
    """Values of three years, and two null columns filled, by overlap."""
    s, r = segments(spark, d), reference(spark, d)
    years = r.withColumn("year", F.explode(F.array(*map(F.lit, (2020, 2022, 2030))))).where("(ref_seq + year) % 3 <> 0").withColumn("v", F.col("ref_aadt") + F.col("year"))
    told = intervals.yearly_values(s, years, "ROUTE_ID", "unique_id", "v", [2020, 2022], together=True)
    told = intervals.fill_from_overlap(told.withColumns({"a": F.when(F.col("seq") % 2 == 0, F.col("AADT")), "b": F.lit(None).cast("bigint")}), r, "ROUTE_ID", {"a": "ref_aadt", "b": "ref_seq"}, together=True)
    return told.select("unique_id", "AADT_2020_HPMS", "AADT_2022_HPMS", "a", "b")


def _best_of(where: str, name: str) -> str:
    return f"""{name} AS (SELECT s.unique_id, r.ref_aadt, r.ref_seq FROM seg s JOIN ref r ON s.ROUTE_ID = r.ROUTE_ID AND least(s.to_mp, r.to_mp) - greatest(s.from_mp, r.from_mp) > 1e-4 {where}
  QUALIFY row_number() OVER (PARTITION BY s.unique_id ORDER BY least(s.to_mp, r.to_mp) - greatest(s.from_mp, r.from_mp) DESC, r.from_mp, r.ref_aadt, r.ref_seq) = 1)"""


HISTORY_SQL = f"""{SEG}, {REFERENCE_SQL}, {_best_of("AND (r.ref_seq + 2020) % 3 <> 0", "x")}, {_best_of("AND (r.ref_seq + 2022) % 3 <> 0", "y")}, {_best_of("", "z")}
SELECT s.unique_id, x.ref_aadt + 2020 AS "AADT_2020_HPMS", y.ref_aadt + 2022 AS "AADT_2022_HPMS", coalesce(CASE WHEN s.seq % 2 = 0 THEN s.AADT END, z.ref_aadt) AS a, z.ref_seq AS b FROM seg s LEFT JOIN x USING (unique_id) LEFT JOIN y USING (unique_id) LEFT JOIN z USING (unique_id)"""


def mirrored_and_parts(spark: SparkSession, d: str) -> DataFrame:
    """Intervals of DEC routes that have none, ranges of parts by length, and repeated intervals dropped, in one table by kind."""
    s = segments(spark, d)
    some = s.where("ROUTE_ID like '%INC' or COUNTY % 3 = 0").select("ROUTE_ID", "from_mp", "to_mp", "STATUS")
    mirrored = intervals.mirror_intervals(some, s.select("ROUTE_ID").distinct())
    parts = s.select("ROUTE_ID", F.col("seq").alias("part"), F.col("miles").alias("length"), F.lit(10.0).alias("route_from"), F.lit(30.0).alias("route_to"))
    ranges = intervals.component_ranges(parts).select("ROUTE_ID", round_even("from_mp", 6).alias("from_mp"), round_even("to_mp", 6).alias("to_mp"), F.lit(None).cast("string").alias("STATUS"))
    twice = s.select(F.lit("x").alias("ROUTE_ID"), F.floor("from_mp").cast("double").alias("from_mp"), F.floor("to_mp").cast("double").alias("to_mp"), "STATUS", "unique_id")
    once = intervals.dedupe_intervals(twice, ["ROUTE_ID", "from_mp", "to_mp"], ["unique_id"]).drop("unique_id")
    kinds = {"mirrored": mirrored, "ranges": ranges, "once": once}
    frames = [df.select(F.lit(k).alias("kind"), "ROUTE_ID", "from_mp", "to_mp", "STATUS") for k, df in kinds.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


MIRRORED_SQL = f"""{SEG}, own AS (SELECT ROUTE_ID, from_mp, to_mp, STATUS FROM seg WHERE ROUTE_ID LIKE '%INC' OR COUNTY % 3 = 0), bare AS (SELECT DISTINCT ROUTE_ID FROM seg WHERE ROUTE_ID LIKE '%DEC' AND ROUTE_ID NOT IN (SELECT ROUTE_ID FROM own)),
t AS (SELECT ROUTE_ID, sum(miles) OVER (PARTITION BY ROUTE_ID ORDER BY seq) AS z, miles, sum(miles) OVER (PARTITION BY ROUTE_ID) AS n FROM seg)
SELECT 'mirrored' AS kind, ROUTE_ID, from_mp, to_mp, STATUS FROM own UNION ALL SELECT 'mirrored', b.ROUTE_ID, s.from_mp, s.to_mp, NULL FROM bare b JOIN own s ON s.ROUTE_ID = left(b.ROUTE_ID, length(b.ROUTE_ID) - 3) || 'INC'
UNION ALL SELECT 'ranges', ROUTE_ID, round_even(10 + 20 * (z - miles) / n, 6), round_even(10 + 20 * z / n, 6), NULL FROM t
UNION ALL SELECT 'once', 'x', floor(from_mp), floor(to_mp), arg_min(STATUS, unique_id) FROM seg GROUP BY 3, 4"""


def attributes(spark: SparkSession, d: str) -> DataFrame:
    """Exact joins of two layers with their coverage, the inventory's own filter, and the code list of a layer, by kind."""
    s = segments(spark, d)
    routes = s.select("ROUTE_ID", F.col("from_mp").alias("BeginPoint"), F.col("to_mp").alias("EndPoint"), "unique_id")
    a = s.where("COUNTY % 2 = 0").select("ROUTE_ID", F.col("from_mp").alias("BeginPoint"), F.col("to_mp").alias("EndPoint"), F.col("AADT").alias("lanes"))
    b = s.where("seq % 3 = 0").select("ROUTE_ID", F.col("from_mp").alias("BeginPoint"), (F.col("to_mp") + F.col("seq") % 2).alias("EndPoint"), F.col("STATUS").alias("owner"))
    joined = tables.join_static_attributes(routes, {"a": a.unionByName(a.withColumn("lanes", F.col("lanes") + 5)), "b": b})
    cover = tables.attribute_coverage(joined, {"a": ["lanes"], "b": ["owner"]}).select(F.lit("coverage").alias("kind"), F.col("layer").alias("id"), F.concat_ws("/", "matched", "rows").alias("detail"))
    given = s.withColumns({"SYSTEM_CODE": F.when(F.col("seq") % 4 == 0, "1").otherwise("2"), "SEC_EVAC": F.when(F.col("COUNTY") % 5 == 0, True)})
    kept = tables.load_roadway_inventory(given, 3, ["unique_id"]).select(F.lit("inventory").alias("kind"), F.col("unique_id").alias("id"), F.lit("").alias("detail"))
    codes = tables.code_snapshot(s.select(F.when(F.col("COUNTY") > 30, F.lit(" ")).otherwise(F.col("COUNTY").cast("string")).alias("c"), F.concat(F.lit(" n"), "DISTRICT").alias("n")), "c", "n").select(F.lit("codes").alias("kind"), "id", F.col("name").alias("detail"))
    rows = joined.where("lanes is not null or owner is not null").select(F.lit("joined").alias("kind"), F.col("unique_id").alias("id"), F.concat_ws(":", F.coalesce(F.col("lanes").cast("string"), F.lit("-")), F.coalesce("owner", F.lit("-"))).alias("detail"))
    return cover.unionByName(kept).unionByName(codes).unionByName(rows)


ATTRIBUTES_SQL = f"""{SEG}, j AS (SELECT s.unique_id, CASE WHEN s.COUNTY % 2 = 0 THEN s.AADT END AS lanes, CASE WHEN s.seq % 3 = 0 AND s.seq % 2 = 0 THEN s.STATUS END AS owner FROM seg s)
SELECT 'coverage' AS kind, 'a' AS id, count(lanes) || '/' || count(*) AS detail FROM j UNION ALL SELECT 'coverage', 'b', count(owner) || '/' || count(*) FROM j UNION ALL SELECT 'inventory', unique_id, '' FROM seg WHERE (seq % 4 = 0 OR COUNTY % 5 = 0) AND DISTRICT = 3
UNION ALL SELECT DISTINCT 'codes', CAST(COUNTY AS VARCHAR), 'n' || CAST(DISTRICT AS VARCHAR) FROM seg WHERE COUNTY <= 30 UNION ALL SELECT 'joined', unique_id, coalesce(CAST(lanes AS VARCHAR), '-') || ':' || coalesce(owner, '-') FROM j WHERE lanes IS NOT NULL OR owner IS NOT NULL"""

YEARS = f"""SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR(9)) || '.0' AS tc, {_pick(["33.5, -84.2", "0.1, 0.2", "bad", "34.0, -83.0"], "s_suppkey")} AS place, CAST(30 + s_suppkey % 5 AS VARCHAR(9)) AS lat, CAST(-80 - s_suppkey % 6 AS VARCHAR(9)) AS lon, CASE WHEN s_suppkey % 9 = 0 THEN '12,345' WHEN s_suppkey % 9 = 1 THEN 'x' ELSE CAST(s_suppkey % 4000 AS VARCHAR(9)) END AS n, {_pick(["3U : Major", "7R", None], "s_suppkey")} AS fc, {_pick(["A", "E", " Calculated "], "s_suppkey")} AS st FROM supplier"""


def station_years(spark: SparkSession, d: str) -> DataFrame:
    """Three layouts of yearly files in one table, with counts by year."""
    c, y = F.col, made(spark, d, YEARS)
    a = tables.load_station_year(y.select(c("tc").alias("Station ID"), c("place").alias("Coordinate"), c("n").alias("aadt"), c("n").alias("k30")), 2015, "2015", "a")
    b = tables.load_station_year(y.select(c("tc").alias("TC_NUMBER"), c("lat").alias("Lat"), c("lon").alias("Long"), c("n").alias("AADT"), c("n").alias("AADT_SINGL")), 2016, "2016", "b")
    e = tables.load_station_year(y.select(c("tc").alias(" Station ID "), c("lat").alias("Latitude"), c("lon").alias("Longitude"), c("n").alias("AADT"), c("fc").alias("Functional Class"), c("st").alias("Statistics type")), 2022, "2022_2023", "c")
    every = tables.union_station_years([a, b, e])
    counts = tables.station_year_counts(every).select("year", F.lit("rows").alias("tc_number"), F.col("rows").cast("double").alias("latitude"), *[F.lit(None).cast(t).alias(n) for n, t in (("longitude", "double"), ("aadt", "bigint"), ("single_unit_aadt", "bigint"), ("k_factor", "double"), ("functional_class", "int"), ("statistics_type", "string"), ("source", "string"))])
    return every.select(*counts.columns).unionByName(counts)


YEARS_SQL = f"""WITH s AS ({YEARS}), v AS (SELECT *, CAST(k AS VARCHAR) AS id, TRY_CAST(replace(n, ',', '') AS DOUBLE) AS x FROM s),
r AS (SELECT 2015 AS year, id AS tc_number, CASE place WHEN '33.5, -84.2' THEN 33.5 WHEN '34.0, -83.0' THEN 34.0 END AS latitude, CASE place WHEN '33.5, -84.2' THEN -84.2 WHEN '34.0, -83.0' THEN -83.0 END AS longitude, CAST(x AS BIGINT) AS aadt, CAST(NULL AS BIGINT) AS single_unit_aadt, x AS k_factor, CAST(NULL AS INTEGER) AS functional_class, CAST(NULL AS VARCHAR) AS statistics_type, 'a' AS source FROM v
  UNION ALL SELECT 2016, id, CAST(lat AS DOUBLE), CAST(lon AS DOUBLE), CAST(x AS BIGINT), CAST(x AS BIGINT), NULL, NULL, NULL, 'b' FROM v
  UNION ALL SELECT 2022, id, CAST(lat AS DOUBLE), CAST(lon AS DOUBLE), CAST(x AS BIGINT), NULL, NULL, CASE left(fc, 1) WHEN '3' THEN 3 WHEN '7' THEN 7 END, CASE st WHEN 'A' THEN 'Actual' WHEN 'E' THEN 'Estimated' ELSE 'Calculated' END, 'c' FROM v)
SELECT * FROM r UNION ALL SELECT year, 'rows', CAST(count(*) AS DOUBLE), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM r GROUP BY year"""

QUERIES = {
    "speed_zones": (speed_zones, SPEED_SQL),
    "signed_route_verification": (verification, VERIFY_SQL),
    "yearly_values": (history, HISTORY_SQL),
    "mirrored_and_parts": (mirrored_and_parts, MIRRORED_SQL),
    "static_attributes": (attributes, ATTRIBUTES_SQL),
    "station_years": (station_years, YEARS_SQL),
}
