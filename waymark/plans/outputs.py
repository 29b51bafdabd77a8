"""Queries on service outputs, boundary layers, summaries and data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.classify import FAMILIES
from waymark.operators import checks, corridors, reports, service, spatial
from waymark.plans.adapters import REFERENCE_SQL, SEGMENTS_SQL, made, reference, segments
from waymark.plans.places import BOXES, SEGMENTS, _boxes, _line, _segments
from waymark.plans.rules import _pick
from waymark.sources import tables

SEG = f"WITH {SEGMENTS_SQL}"
BASE = f"WITH seg AS ({SEGMENTS}), box AS ({BOXES})"


def _told(kind: str, df: DataFrame, name: Column | str, value: Column) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), (F.col(name) if isinstance(name, str) else name).cast("string").alias("name"), value.cast("string").alias("value"))


def _all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def service_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Filters of a request, themes, legends, manifests with bounds, a page of features, one row and boundary layers."""
    s = segments(spark, d).withColumns({"county_all": F.concat(F.lit("County "), F.col("COUNTY").cast("string"), F.lit(", county "), (F.col("COUNTY") + 1).cast("string")), "ROUTE_FAMILY": F.when(F.col("seq") % 2 == 0, "Interstate").otherwise("State Route"), "CITY_ID": F.when(F.col("seq") % 3 != 0, F.col("COUNTY").cast("string"))})
    wanted = service.resolve_filters({"counties": ["7", " County 9 ", None], "families": ["interstate"], "cities": ["8.0", "9"], "include_unincorporated": True, "DISTRICT": ["1.0", "3", ""]}, {"7": "COUNTY 7"})
    passing = _told("filter", s.where(wanted.predicate()), "unique_id", F.col("ROUTE_FAMILY"))
    theme = service.theme_filter(F.col("AADT"), low=20_000, off_bins=[(30_000, 40_000)], no_data=False)
    themed = _told("theme", s.where(theme), "unique_id", F.col("AADT"))
    bins = spark.createDataFrame([("small", 0.0, 20_000.0), ("middle", 20_000.0, 50_000.0), ("large", 50_000.0, 1e9)], "label string, min_value double, max_value double")
    legend = service.legend_presence(s, "AADT", bins, theme)
    legends = _all(_told("legend", legend, "label", F.concat_ws("/", "rows", "passing")), _told("totals", service.legend_totals(s, "AADT", theme), F.lit("AADT"), F.concat_ws("/", "total", "with_data", "has_no_data", "passing")))
    catalog = service.theme_catalog(s, {"volume": ("AADT", 500.0), "class": ("FUNCTIONAL_CLASS", None)})
    themes = _told("catalog", catalog, "theme", F.concat_ws("/", F.col("numeric").cast("string"), F.col("min_value").cast("bigint").cast("string"), F.col("max_value").cast("bigint").cast("string"), F.col("step").cast("bigint").cast("string")))
    lines, few = _segments(spark, d), service.Filters({"kind": ("SR", "US")})
    listed = service.manifest(lines, few, 100, "line")
    around = service.bounds(lines, few, "line")
    shape = F.concat_ws("/", *[F.col(c).cast("bigint").cast("string") for c in ("min_x", "min_y", "max_x", "max_y")])
    manifests = _all(_told("manifest", listed, F.concat_ws("/", "total", "chunks"), shape), _told("bounds", around, F.lit("lines"), shape))
    page = service.features(lines.select("id", "name", "kind", F.transform("line", lambda p: F.struct((p["x"] + 480_000).alias("x"), (p["y"] + 3_600_000).alias("y"))).alias("line")), few, 40, 10, "id")
    lon, lat = (F.get_json_object("feature", f"$.geometry.coordinates[0][{i}]").cast("double") for i in (0, 1))
    features = _told("feature", page, "id", F.concat_ws("/", F.coalesce(F.get_json_object("feature", "$.properties.name"), F.lit("-")), F.get_json_object("feature", "$.geometry.type"), (lon.between(-81.3, -80.6) & lat.between(32.5, 33.1)).cast("string")))
    one = _told("detail", service.detail(s, "0000000001INC_1"), "unique_id", F.col("AADT"))
    b = _boxes(spark, d).select(F.col("k").alias("COUNTYFP"), F.col("district").alias("GDOT_DISTRICT"))
    layers = _all(*[_told("boundary", service.boundary_filter(b, n, {"district": (1, 2), "counties": (1, 2, 5, 6), "mpos": (9,)}), F.concat(F.lit(f"{n}:"), F.col("COUNTYFP").cast("string")), F.col("GDOT_DISTRICT")) for n in ("county_boundaries", "district_boundaries", "unknown")])
    return _all(passing, themed, legends, themes, manifests, features, one, layers)


_PASS = "(AADT IS NOT NULL AND AADT >= 20000 AND NOT (AADT BETWEEN 30000 AND 40000))"
SERVICE_SQL = f"""{SEG}, sg AS ({SEGMENTS}), box AS ({BOXES}), f AS (SELECT * FROM sg WHERE kind IN ('SR', 'US')), m AS (SELECT count(*) AS n, min(x0) AS a, min(y0) AS b, max(x0 + dx) AS c, max(y0 + dy) AS d FROM f),
sh AS (SELECT *, CAST(CAST(floor(a) AS BIGINT) AS VARCHAR) || '/' || CAST(CAST(floor(b) AS BIGINT) AS VARCHAR) || '/' || CAST(CAST(floor(c) AS BIGINT) AS VARCHAR) || '/' || CAST(CAST(floor(d) AS BIGINT) AS VARCHAR) AS s FROM m)
SELECT 'filter' AS kind, unique_id AS name, 'Interstate' AS value FROM seg WHERE seq % 2 = 0 AND DISTRICT IN (1, 3) AND (COUNTY IN (7, 9) OR COUNTY + 1 IN (7, 9)) AND (seq % 3 = 0 OR COUNTY IN (8, 9))
UNION ALL SELECT 'theme', unique_id, CAST(AADT AS VARCHAR) FROM seg WHERE {_PASS}
UNION ALL SELECT 'legend', CASE WHEN AADT IS NULL THEN 'no data' WHEN AADT >= 50000 THEN 'large' WHEN AADT >= 20000 THEN 'middle' ELSE 'small' END, count(*) || '/' || count(*) FILTER {_PASS} FROM seg GROUP BY 2
UNION ALL SELECT 'totals', 'AADT', count(*) || '/' || count(AADT) || '/' || CAST(count(*) > count(AADT) AS VARCHAR) || '/' || count(*) FILTER {_PASS} FROM seg
UNION ALL SELECT 'catalog', 'volume', 'true/' || min(AADT) || '/' || max(AADT) || '/500' FROM seg UNION ALL SELECT 'catalog', 'class', 'false'
UNION ALL SELECT 'manifest', n || '/' || CAST(ceil(n / 100) AS BIGINT), s FROM sh UNION ALL SELECT 'bounds', 'lines', s FROM sh
UNION ALL SELECT 'feature', CAST(id AS VARCHAR), coalesce(name, '-') || '/LineString/true' FROM (SELECT id, name FROM f ORDER BY id LIMIT 40 OFFSET 10)
UNION ALL SELECT 'detail', unique_id, CAST(AADT AS VARCHAR) FROM seg WHERE unique_id = '0000000001INC_1'
UNION ALL SELECT 'boundary', 'county_boundaries:' || k, CAST(district AS VARCHAR) FROM box WHERE district IN (1, 2) AND k IN (1, 2, 5, 6) UNION ALL SELECT 'boundary', 'district_boundaries:' || k, CAST(district AS VARCHAR) FROM box WHERE district IN (1, 2)"""


def layers_and_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Boundary layers made plain, those in a state, merged ones; projections by county; match, load and family summaries."""
    b = _boxes(spark, d)
    raw = b.select(F.concat(F.lit(" "), F.col("k").cast("string"), F.lit(".0")).alias("SLDUST"), F.when(F.col("k") % 4 == 0, "x").otherwise((F.col("k") % 7).cast("string")).alias("GDOT_DISTRICT"), F.concat(F.lit(" "), "label").alias("NAME"), "rings")
    senate = tables.normalize_boundary_layer(raw, ("SLDUST20", "SLDUST"), "STATE_SENATE_DISTRICT", "label")
    district = tables.normalize_boundary_layer(raw, ("GDOT_DISTRICT",), "GDOT_DISTRICT", "label", names={1: "One", 2: "Two"})
    county = tables.normalize_boundary_layer(raw, ("SLDUST",), "COUNTYFP", pad=3)
    plain = _all(_told("senate", senate, "STATE_SENATE_DISTRICT", F.col("label")), _told("district", district, "GDOT_DISTRICT", F.col("label")), _told("county", county, "COUNTYFP", F.lit("")))
    state = spark.createDataFrame([(1,)], "i int").select(F.array(_line((5000.0, 5000.0), (32000.0, 5000.0), (32000.0, 27000.0), (5000.0, 27000.0), (5000.0, 5000.0))).alias("rings"))
    spot = spark.createDataFrame([(1,)], "i int").select(F.array(_line((12_000.0, 12_000.0), (14_000.0, 12_500.0), (12_000.0, 13_000.0), (12_000.0, 12_000.0))).alias("rings"))
    inside = _all(_told("in_state", tables.within_state(b, "k", state, 900.0), "k", F.lit("")), _told("around_spot", tables.within_state(b, "k", spot, 900.0), "k", F.lit("")))
    merged = spatial.dissolve(b, "district")
    points = made(spark, d, SEGMENTS).select("id", F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")).alias("p"))
    held = spatial.point_in_polygon(points, "id", merged.where("district = 1"), "district", 900.0).where("district is not null")
    sheet = made(spark, d, "SELECT r_regionkey + 3 AS n, 'Region ' || CAST(r_regionkey AS VARCHAR(9)) AS c0, CAST(100 + r_regionkey AS VARCHAR(9)) AS c1, CASE WHEN r_regionkey = 2 THEN 'n/a' ELSE CAST(200 + r_regionkey AS VARCHAR(9)) END AS c2 FROM region")
    top = spark.createDataFrame([(1, "A title", None, None), (2, " COUNTY ", "2020.0", "2050"), (90, "Georgia", "1", "2"), (91, "Source: x", None, None), (92, None, None, None)], "n int, c0 string, c1 string, c2 string")
    names = made(spark, d, "SELECT 'REGION-' || CAST(r_regionkey AS VARCHAR(9)) AS name, '13' || lpad(CAST(r_regionkey AS VARCHAR(9)), 3, '0') AS fips FROM region")
    projected = tables.county_projections(top.unionByName(sheet), names, 5)
    s = segments(spark, d)
    match = reports.match_summary(s, F.col("AADT") > 30_000, "ROUTE_ID", "miles")
    load = reports.load_summary(s.select("AADT", "STATUS"), "STATUS")
    nulls = F.concat_ws("/", F.col("rows").cast("string"), F.col("columns").cast("string"), F.get_json_object("nulls", "$.AADT"), F.get_json_object("distribution", "$.F"))
    families = reports.family_counts(s.withColumn("ROUTE_FAMILY", F.when(F.col("seq") % 3 == 1, "Interstate").when(F.col("seq") % 3 == 2, "State Route")))
    return _all(
        plain, inside, _told("merged", held, "id", F.lit("")), _told("projection", projected, F.concat_ws(":", "COUNTY_FIPS", F.col("year").cast("string")), F.col("value").cast("bigint")),
        _told("match", match, F.lit("busy"), F.concat_ws("/", F.col("rows").cast("string"), F.col("matched").cast("string"), F.col("routes").cast("string"), F.col("miles").cast("bigint").cast("string"))),
        _told("load", load, F.lit("segments"), nulls), _told("family", families, "family", F.col("rows")),
    )


LAYERS_SQL = f"""{BASE}, {SEGMENTS_SQL.replace("seg0 AS", "lin0 AS").replace("seg AS (", "lin AS (").replace("FROM seg0", "FROM lin0")}
SELECT 'senate' AS kind, CAST(k AS VARCHAR) AS name, label AS value FROM box UNION ALL SELECT 'district', CAST(k % 7 AS VARCHAR), CASE k % 7 WHEN 1 THEN 'One' WHEN 2 THEN 'Two' ELSE label END FROM box WHERE k % 4 <> 0 UNION ALL SELECT 'county', lpad(CAST(k AS VARCHAR), 3, '0'), '' FROM box
UNION ALL SELECT 'in_state', CAST(k AS VARCHAR), '' FROM box WHERE a <= 32000 AND b >= 5000 AND c <= 27000 AND d >= 5000
UNION ALL SELECT 'around_spot', CAST(k AS VARCHAR), '' FROM box WHERE a <= 14000 AND b >= 12000 AND c <= 13000 AND d >= 12000
UNION ALL SELECT 'merged', CAST(s.id AS VARCHAR), '' FROM seg s JOIN box b ON b.district = 1 AND s.x0 BETWEEN b.a AND b.b AND s.y0 BETWEEN b.c AND b.d GROUP BY s.id HAVING count(*) > 0
UNION ALL SELECT 'projection', '13' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') || ':2020', CAST(100 + r_regionkey AS VARCHAR) FROM region UNION ALL SELECT 'projection', '13' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') || ':2050', CASE WHEN r_regionkey <> 2 THEN CAST(200 + r_regionkey AS VARCHAR) END FROM region
UNION ALL SELECT 'match', 'busy', count(*) || '/' || count(*) FILTER (AADT > 30000) || '/' || count(DISTINCT ROUTE_ID) FILTER (AADT > 30000) || '/' || CAST(sum(miles) FILTER (AADT > 30000) AS BIGINT) FROM lin
UNION ALL SELECT 'load', 'segments', count(*) || '/2/' || (count(*) - count(AADT)) || '/' || count(*) FILTER (STATUS = 'F') FROM lin
UNION ALL SELECT 'family', CASE seq % 3 WHEN 1 THEN 'Interstate' WHEN 2 THEN 'State Route' ELSE 'Unknown' END, CAST(count(*) AS VARCHAR) FROM lin GROUP BY 2"""

SLOTS = f"""SELECT p_partkey AS id, {_pick(['["Interstate","State Route"]', '["State Route"]', "[]", None, '["Local/Other","U.S. Route"]', "no list", " "], "p_partkey")} AS listed, {_pick(["Interstate", "State Route", "Local/Other", None, "U.S. Route", None, "U.S. Route"], "p_partkey")} AS a, {_pick(["State Route", None, None, None, None, None, None], "p_partkey")} AS b,
  {_pick(["Adams, Bacon", "bacon", "Adams,  adams", "Clay, , Adams", "Zed", None], "p_partkey")} AS counties, {_pick(["Adams", "Bacon", "Adams", "Adams", "Zed", None], "p_partkey")} AS county, p_partkey % 12 AS lane, 'R' || CAST(p_partkey % 5 AS VARCHAR(9)) || {_pick(["INC", "DEC"], "p_partkey")} AS route FROM part"""
OFFICES = "SELECT n_nationkey AS county, n_nationkey % 8 AS district, n_nationkey % 5 AS area_id, CASE n_nationkey % 6 WHEN 0 THEN 'remainder' WHEN 1 THEN 'Town' END AS piece FROM nation WHERE n_nationkey <> 7 UNION ALL SELECT 30, 1, 1, NULL FROM region UNION ALL SELECT 6, 2, 2, 'remainder' FROM region WHERE r_regionkey = 0"


def more_checks(spark: SparkSession, d: str) -> DataFrame:
    """Required fields, labels, county lists, column groups, family slots, geometry, totals, offices, loads, spots, cases and counts."""
    c = F.col
    s, q = segments(spark, d), made(spark, d, SLOTS)
    slots = q.select(c("listed").alias("SIGNED_ROUTE_FAMILY_ALL"), c("a").alias("SIGNED_ROUTE_FAMILY_PRIMARY"), c("b").alias("SECONDARY_SIGNED_ROUTE_FAMILY"), F.lit(None).cast("string").alias("TERTIARY_SIGNED_ROUTE_FAMILY"))
    lines = made(spark, d, SEGMENTS).select(F.when(c("id") % 9 == 0, F.array(F.struct(c("x0").alias("x"), c("y0").alias("y")))).when(c("id") % 7 == 0, _line((c("x0"), c("y0")), (c("x0"), c("y0")))).otherwise(_line((c("x0"), c("y0")), (c("x0") + c("dx"), c("y0") + c("dy")))).alias("line"))
    offices, known = made(spark, d, OFFICES).withColumnRenamed("piece", "part"), made(spark, d, "SELECT n_nationkey AS county FROM nation")
    areas = made(spark, d, "SELECT n_nationkey AS county, CAST(100 AS DOUBLE) AS whole_m2, CAST(100 + n_nationkey % 2 AS DOUBLE) AS covered_m2 FROM nation")
    roads = q.select(c("counties").alias("HWY_NAME"), c("county").alias("COUNTY_NAME"), c("route").alias("ROUTE_ID"), (c("lane") == 3).alias("flag"))
    cases = spark.createDataFrame([(1, "Adams, Bacon", "Adams", None, True), (2, "Zed", "Zed", "DEC", True), (3, "Zed", "Zed", "INC", True), (4, "None", "Adams", None, False)], "case_id int, HWY_NAME string, COUNTY_NAME string, route_suffix string, expected boolean")
    labels = q.select(c("lane").alias("k"), F.concat(F.lit("L"), F.when(c("lane") < 11, c("lane")).otherwise(0).cast("string")).alias("label"))
    boundaries = made(spark, d, "SELECT n_nationkey AS k, ' L' || CAST(n_nationkey AS VARCHAR(9)) AS told FROM nation")
    return checks.all_checks(
        checks.required_when(s, "federal", c("STATUS") == "F", ["AADT", "miles"], 0.5), checks.labels_match(labels, "decoded", "label", F.when(c("k") < 5, F.concat(F.lit("L"), c("k").cast("string")))), checks.county_list(q.where("counties is not null"), "counties", ["Adams", "Bacon", "Clay"], "county"),
        checks.columns_present(s, {"base": ["ROUTE_ID", "AADT"], "more": ["AADT", "GONE"]}), checks.family_slots(slots, FAMILIES), checks.geometry_checks(lines), checks.total_within(s, "miles_total", "miles", 1_500_000.0, 0.5),
        checks.area_office_table(offices, known, areas, 21), checks.loader_checks(s, s.where("DISTRICT = 2"), 2), checks.regression_cases(roads, cases, "flag"), checks.labels_equal(labels, boundaries, "boundary_labels", "k", "label", "told"),
        checks.count_bounds(roads.where("flag"), "COUNTY_NAME", {"Adams": (1, 10_000), "Zed": (1, 5)}), corridors.baseline_checks(roads.select(c("flag")), {"flag": 150.0}), spatial.spot_checks({"nation": made(spark, d, "SELECT n_name AS n FROM nation"), "part": made(spark, d, "SELECT p_name AS n FROM part")}, {"nation": "france", "part": "no such words"}),
    )


def _row(name: str, passed: str, detail: str, source: str) -> str:
    return f"SELECT '{name}' AS name, coalesce({passed}, false) AS passed, CAST({detail} AS VARCHAR) AS detail FROM {source}"


_CHECKED = [
    _row("federal_AADT", "a >= 0.5 * f", "f - a", "ck"), _row("federal_miles", "m >= 0.5 * f", "f - m", "ck"), _row("decoded", "count(*) = 0", "count(*)", "q WHERE lane < 5 AND lane <> CASE WHEN lane < 11 THEN lane ELSE 0 END"),
    *[_row(f"county_list_{n}", "count(*) = 0", "count(*)", f"q WHERE counties IN ({v})") for n, v in (("blank", "'Clay, , Adams'"), ("repeated", "'Adams,  adams'"), ("unknown", "'Zed'"), ("leading", "'Clay, , Adams'"))],
    _row("columns_base", "true", "''", "region WHERE r_regionkey = 0"), _row("columns_more", "false", "'GONE'", "region WHERE r_regionkey = 0"),
    _row("family_list", "count(*) = 0", "count(*)", "q WHERE listed LIKE '%Local%'"), _row("family_slots", "count(*) = 0", "count(*)", "q WHERE listed = 'no list' OR (trim(listed) = '' AND a = 'U.S. Route')"),
    _row("geometry_empty", "count(*) = 0", "count(*)", "sg WHERE id % 9 = 0"), _row("geometry_degenerate", "count(*) = 0", "count(*)", "sg WHERE id % 9 <> 0 AND id % 7 = 0"), _row("miles_total", "abs(sum(miles) - 1500000) <= 750000", "sum(miles)", "seg"),
    _row("offices_counties", "count(*) = 0", "count(*)", "(SELECT n.county AS known, o.county, count(*) FILTER (o.county IS NOT NULL AND part IS NULL) AS w, count(part) AS s FROM (SELECT n_nationkey AS county FROM nation) n FULL JOIN ofc o USING (county) GROUP BY 1, 2 HAVING known IS NULL OR o.county IS NULL OR w > 1 OR (w > 0 AND s > 0))"),
    _row("offices_remainders", "count(*) = 0", "count(*)", "(SELECT county FROM ofc GROUP BY 1 HAVING count(*) FILTER (part = 'remainder') > 1)"), _row("offices_pairs", "count(*) = 21", "count(*)", "(SELECT DISTINCT district, area_id FROM ofc)"),
    _row("offices_ranges", "count(*) = 0", "count(*)", "ofc WHERE district NOT BETWEEN 1 AND 7 OR area_id < 1"), _row("offices_coverage", "sum(100 + n_nationkey % 2) / sum(100) BETWEEN 0.995 AND 1.005", "round(sum(100 + n_nationkey % 2) / sum(100), 6)", "nation"),
    _row("load_statewide", "count(*) > 0", "count(*)", "seg"), _row("load_district", "count(*) > 0", "count(*) FILTER (DISTRICT <> 2)", "seg WHERE DISTRICT = 2"),
    *[_row(f"case_{i}", f"coalesce(bool_or(lane = 3), false) = {e}", "coalesce(bool_or(lane = 3), false)", f"q WHERE counties = '{h}' AND county = '{c}' AND route LIKE '%{x}'") for i, h, c, x, e in ((1, "Adams, Bacon", "Adams", "", "true"), (2, "Zed", "Zed", "DEC", "true"), (3, "Zed", "Zed", "INC", "true"), (4, "None", "Adams", "", "false"))],
    _row("boundary_labels", "count(*) = 0", "count(*)", "(SELECT DISTINCT lane FROM q WHERE lane = 11)"), _row("count_Adams", "count(*) BETWEEN 1 AND 10000", "count(*)", "q WHERE lane = 3 AND county = 'Adams'"), _row("count_Zed", "count(*) BETWEEN 1 AND 5", "count(*)", "q WHERE lane = 3 AND county = 'Zed'"),
    _row("baseline_flag", "abs(count(*) - 150) <= 45", "count(*)", "q WHERE lane = 3"), _row("layer_nation", "bool_or(lower(n_name) LIKE '%france%')", "count(*)", "nation"), _row("layer_part", "false", "count(*)", "part"),
]
MORE_CHECKS_SQL = f"{SEG}, sg AS ({SEGMENTS}), q AS ({SLOTS}), ofc AS (SELECT county, district, area_id, piece AS part FROM ({OFFICES})), ck AS (SELECT count(*) FILTER (STATUS = 'F') AS f, count(AADT) FILTER (STATUS = 'F') AS a, count(miles) FILTER (STATUS = 'F') AS m FROM seg) " + " UNION ALL ".join(_CHECKED)

QUERIES = {
    "service_outputs": (service_outputs, SERVICE_SQL),
    "layers_and_summaries": (layers_and_summaries, LAYERS_SQL),
    "more_checks": (more_checks, MORE_CHECKS_SQL),
}
