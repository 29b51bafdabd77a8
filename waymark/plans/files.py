"""Queries that write tables and layers, read them back, and tell what came of it; counts by observation; themes of the map."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.functions import scalars as P
from waymark.lineage import checkpointed, shared_folder
from waymark.operators import intervals, reports
from waymark.plans.adapters import SEGMENTS_SQL, made, read, segments
from waymark.plans.rules import _pick
from waymark.sources import tables

SEG = f"WITH {SEGMENTS_SQL}"


def _folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster shares."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


#: an interval table as files hold it: blanks around names and ids, milepoints with more digits or none
RAW = f"""SELECT ' R' || CAST(l_orderkey % 500 AS VARCHAR(9)) || ' ' AS rid, CASE WHEN l_linenumber = 6 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR(9)) || '.00004' END AS f, CASE WHEN l_linenumber = 5 THEN '1' ELSE CAST(l_linenumber + l_orderkey % 3 AS VARCHAR(9)) || '.12346' END AS t, {_pick(["7", "n/a", " 8.5", None], "l_orderkey")} AS v, l_orderkey AS k FROM lineitem"""


def interval_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """An interval table as CSV and as Parquet, read back by the source's rules."""
    rows, at = made(spark, d, RAW).withColumnsRenamed({"rid": " RID ", "f": "from", "t": "to ", "v": "VAL"}), _folder(spark)
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{at}/t.csv")
    rows.write.parquet(f"{at}/t")
    got = [tables.read_interval_table(spark, f"{at}/{n}", "RID", "from", "to", {"VAL": "value"}, ["value"]).select(F.lit(n).alias("file"), "RID", "from_mp", "to_mp", "value", F.col("k").cast("bigint").alias("k")) for n in ("t.csv", "t")]
    return got[0].unionByName(got[1])


INTERVALS_SQL = f"""WITH r AS ({RAW}), p AS (SELECT trim(rid) AS "RID", round_even(TRY_CAST(f AS DOUBLE), 4) AS f, round_even(TRY_CAST(t AS DOUBLE), 4) AS t, TRY_CAST(trim(v) AS DOUBLE) AS value, k FROM r)
SELECT file, "RID", CASE WHEN abs(f) < 1e-4 THEN 0 ELSE f END AS from_mp, t AS to_mp, value, k FROM p CROSS JOIN (SELECT unnest(['t.csv', 't']) AS file) WHERE t > f"""


def segments_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Segments written with and without geometry by district, read back: rows, sums and columns of either table."""
    s, at = segments(spark, d).withColumns({"geometry": F.array(G.point(F.col("from_mp"), 0.0), G.point(F.col("to_mp"), 0.0)), "_inner": F.lit(1)}), _folder(spark)
    tables.write_segments(s, at)
    told = []
    for name in ("attributes", "features"):
        back = spark.read.parquet(f"{at}/{name}")
        metres = F.sum(G.line_length(F.col("geometry"))) if "geometry" in back.columns else F.lit(None).cast("double")
        told.append(back.groupBy("DISTRICT").agg(F.count("*").alias("rows"), F.sum("miles").alias("miles"), F.sum("AADT").alias("aadt"), metres.alias("metres"), F.lit(len(back.columns)).alias("columns")).withColumn("table", F.lit(name)))
    return told[0].unionByName(told[1])


WRITTEN_SQL = f"""{SEG}, n AS (SELECT DISTRICT, count(*) AS rows, sum(miles) AS miles, sum(AADT) AS aadt, sum(to_mp - from_mp) AS metres FROM seg GROUP BY 1), w AS (SELECT count(*) AS c FROM (DESCRIBE {SEG} SELECT * FROM seg))
SELECT DISTRICT, rows, miles, aadt, CAST(NULL AS DOUBLE) AS metres, c AS columns, 'attributes' AS "table" FROM n, w UNION ALL SELECT DISTRICT, rows, miles, aadt, metres, c + 1, 'features' FROM n, w"""


def layers_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Nations as a feature file and as points, lines and polygons of GeoJSON, read back."""
    n, at = read(spark, d, "nation").select(F.col("n_nationkey").alias("Key"), F.col("n_name").alias("N Name"), F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")).alias("Region")), _folder(spark)
    tables.write_feature_json(n, f"{at}/f")
    plain = tables.read_feature_json(spark, f"{at}/f", {"N Name": "n_name", "Key": "key", "Region": "region"})
    told = [plain.select(F.lit("features").alias("file"), F.col("key").cast("bigint").alias("key"), "n_name", F.col("region").cast("bigint").alias("region"), F.lit("").alias("geometry_type"), F.lit("").alias("places"))]
    x, y = F.col("Key").cast("double"), F.col("Key").cast("double") + 0.5
    shapes = {"Point": [(x, y)], "LineString": [(x, y), (x + 1, y), (x + 1, y + 2)], "Polygon": [(x, y), (x + 1, y), (x + 1, y + 1), (x, y)]}
    for kind, places in shapes.items():
        tables.write_geojson(n.withColumn("parts", F.array(F.array(*[G.point(a, b) for a, b in places]))), kind, "parts", f"{at}/{kind}")
        back = tables.read_geojson(spark, f"{at}/{kind}")
        said = F.array_join(F.transform(F.flatten("parts"), lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ",")
        told.append(back.select(F.lit("geojson").alias("file"), F.col("key").cast("bigint").alias("key"), "n_name", F.col("region").cast("bigint").alias("region"), "geometry_type", said.alias("places")))
    whole = told[0]
    for df in told[1:]:
        whole = whole.unionByName(df)
    return whole


def _places(*places: tuple[int, float]) -> str:
    return " || ',' || ".join(f"CAST(CAST(k + {a} AS DOUBLE) AS VARCHAR) || ' ' || CAST(CAST(k + {b} AS DOUBLE) AS VARCHAR)" for a, b in places)


_SHAPES = {"Point": [(0, 0.5)], "LineString": [(0, 0.5), (1, 0.5), (1, 2.5)], "Polygon": [(0, 0.5), (1, 0.5), (1, 1.5), (0, 0.5)]}
LAYERS_SQL = """WITH n AS (SELECT n_nationkey AS k, n_name, CASE WHEN n_regionkey <> 2 THEN n_regionkey END AS region FROM nation) SELECT 'features' AS file, k AS key, n_name, region, '' AS geometry_type, '' AS places FROM n""" + "".join(f" UNION ALL SELECT 'geojson', k, n_name, region, '{kind}', {_places(*p)} FROM n" for kind, p in _SHAPES.items())


def observed_counts(spark: SparkSession, d: str) -> DataFrame:
    """What deduplication and the guard of ids tell as they run: dropped, renamed and left-over rows."""
    s = segments(spark, d)
    first, second = Observation(), Observation()
    # two rows in three share a place, some of them also all their administrative parts
    kept = checkpointed(intervals.dedupe_intervals(s.withColumn("at", F.floor(F.col("from_mp") / 40)), ["ROUTE_ID", "at"], ["from_mp", "to_mp"], first))
    ids = s.withColumn("unique_id", F.concat_ws("_", F.col("COUNTY").cast("string"), F.floor("from_mp").cast("string")))
    guarded = checkpointed(P.unique_id_guard(ids, "unique_id", ("DISTRICT", "STATUS"), second))
    told = [("dedupe_rows", first.get["rows"]), ("dedupe_dropped", first.get["dropped"]), ("guard_marked", second.get["marked"]), ("guard_left", second.get["left"])]
    made_of = spark.createDataFrame(told, "name string, value bigint")
    return made_of.unionByName(kept.agg(F.count("*").alias("value")).select(F.lit("dedupe_kept").alias("name"), "value")).unionByName(guarded.agg(F.count_distinct("unique_id").alias("value")).select(F.lit("guard_ids").alias("name"), "value"))


OBSERVED_SQL = f"""{SEG}, k AS (SELECT count(*) AS n FROM (SELECT DISTINCT ROUTE_ID, floor(from_mp / 40) FROM seg)), g AS (SELECT CAST(COUNTY AS VARCHAR) || '_' || CAST(CAST(floor(from_mp) AS BIGINT) AS VARCHAR) AS u, CAST(DISTRICT AS VARCHAR) || '|' || STATUS AS p FROM seg),
h AS (SELECT u, p, count(*) AS same, sum(count(*)) OVER (PARTITION BY u) AS many FROM g GROUP BY 1, 2), a AS (SELECT count(*) AS n FROM seg)
SELECT 'dedupe_rows' AS name, n AS value FROM a UNION ALL SELECT 'dedupe_dropped', a.n - k.n FROM a, k UNION ALL SELECT 'dedupe_kept', n FROM k UNION ALL SELECT 'guard_marked', CAST(sum(same) FILTER (many > 1) AS BIGINT) FROM h
UNION ALL SELECT 'guard_left', CAST(sum(same) FILTER (same > 1) AS BIGINT) FROM h UNION ALL SELECT 'guard_ids', count(*) FROM h"""


def load_all(spark: SparkSession, d: str) -> DataFrame:
    """The inventory of a district and two categories of metrics on it, each category's rows summed."""
    s = segments(spark, d).withColumns({"SYSTEM_CODE": F.when(F.col("seq") % 3 == 0, "1").otherwise("2"), "SEC_EVAC": F.when(F.col("seq") % 5 != 0, F.col("seq") % 5 == 1)})
    categories = {"volume": lambda r: r.groupBy("FUNCTIONAL_CLASS").agg(F.sum("AADT").alias("n")), "length": lambda r: r.groupBy("COUNTY").agg(F.sum("miles").alias("n"))}
    found = tables.load_all(s, categories, 2, ["FUNCTIONAL_CLASS", "COUNTY", "AADT", "miles"])
    told = [df.agg(F.lit(name).alias("category"), F.count("*").alias("rows"), F.sum("n" if "n" in df.columns else "miles").cast("double").alias("total")) for name, df in found.items()]
    return told[0].unionByName(told[1]).unionByName(told[2])


ALL_SQL = f"""{SEG}, r AS (SELECT * FROM seg WHERE DISTRICT = 2 AND (seq % 3 = 0 OR seq % 5 = 1)) SELECT 'roadways' AS category, count(*) AS rows, sum(miles) AS total FROM r
UNION ALL SELECT 'volume', count(DISTINCT FUNCTIONAL_CLASS), CAST(sum(AADT) AS DOUBLE) FROM r UNION ALL SELECT 'length', count(DISTINCT COUNTY), sum(miles) FROM r"""

THEMED = f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 7 AS INTEGER) END AS "NUM_LANES", CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 4 AS INTEGER) END AS "MEDIAN_TYPE", {_pick(["Interstate", "State Route", None, " Interstate ", "U.S. Route"], "o_orderkey")} AS "ROUTE_FAMILY", CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 6 AS INTEGER) END AS "HPMS_ACCESS_CONTROL",
  {_pick(["SR 1", None, " ", "Main St"], "o_orderkey")} AS "HWY_NAME", {_pick(["R1", "R2", "", None, "  "], "o_orderkey")} AS "ROUTE_ID", CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 900 AS DOUBLE) END AS "AADT", CAST(o_orderkey % 77 AS DOUBLE) AS "SINGLE_UNIT_AADT_2024", CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_orderkey % 31 AS DOUBLE) END AS "COMBO_UNIT_AADT_2024",
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 2 END AS "SEC_EVAC", CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 3 = 0 AS INTEGER) END AS "SEC_EVAC_CONTRAFLOW", CAST(o_orderkey % 55 AS INTEGER) AS "SPEED_LIMIT", '13' || lpad(CAST(o_orderkey % 97 AS VARCHAR(9)), 9, '0') AS tract FROM orders"""


def themes(spark: SparkSession, d: str) -> DataFrame:
    """Thematic properties of rows, with whether their tract lies in the state."""
    s = made(spark, d, THEMED.replace('"', "`")).withColumn("tract", F.when(F.col("id") % 3 == 0, F.expr("concat('01', substring(tract, 3))")).when(F.col("id") % 7 != 0, F.col("tract")))
    told = P.thematic_properties(s, ["id", "tract"])
    return told.withColumn("in_state", P.in_state(F.col("tract"), "13")).select("id", "in_state", "hwy_des", "road_name", "sec_evac", "pct_sadt", "pct_cadt", "aadt", "speed_limit", "vmt")


THEMES_SQL = f"""WITH s AS ({THEMED}) SELECT id, id % 3 <> 0 AND id % 7 <> 0 AS in_state, CASE WHEN "NUM_LANES" > 0 THEN CAST("NUM_LANES" AS VARCHAR) || CASE WHEN coalesce("MEDIAN_TYPE" <> 1, false) OR coalesce(trim("ROUTE_FAMILY") = 'Interstate', false) OR coalesce("HPMS_ACCESS_CONTROL" IN (1, 2, 3) AND "NUM_LANES" >= 4, false) THEN 'D' ELSE 'U' END END AS hwy_des,
  coalesce(CASE WHEN trim("HWY_NAME") <> '' THEN "HWY_NAME" END, CASE WHEN trim("ROUTE_ID") <> '' THEN "ROUTE_ID" END, 'Roadway segment') AS road_name, CASE WHEN "SEC_EVAC_CONTRAFLOW" = 1 THEN 'Contraflow Route' WHEN "SEC_EVAC" = 1 THEN 'Evacuation Route' END AS sec_evac,
  CASE WHEN "AADT" > 0 THEN round("SINGLE_UNIT_AADT_2024" * 100 / "AADT", 1) END AS pct_sadt, CASE WHEN "AADT" > 0 THEN round("COMBO_UNIT_AADT_2024" * 100 / "AADT", 1) END AS pct_cadt, "AADT" AS aadt, "SPEED_LIMIT" AS speed_limit, CAST(NULL AS VARCHAR) AS vmt FROM s"""

ENRICHED = f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(20 + o_orderkey % 5 * 5 AS INTEGER) END AS "SPEED_LIMIT", o_orderkey % 7 = 0 AS "IS_SCHOOL_ZONE", {_pick(["zone", None, "route"], "o_orderkey")} AS "SPEED_LIMIT_SOURCE", CASE WHEN o_orderkey % 11 < 4 THEN 1.5 END AS "HPMS_IRI", CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS "AADT",
  {_pick(["hpms_2024", "official_exact", None, "hpms_2024", "direction_mirror"], "o_orderkey")} AS "AADT_2024_SOURCE", {_pick(["hpms_2024", "layer", None, None], "o_orderkey")} AS "SIGNED_ROUTE_VERIFY_SOURCE", o_orderkey % 13 = 0 AS "SIGNED_INTERSTATE_FLAG", CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 5 = 0 END AS "SIGNED_US_ROUTE_FLAG", {_pick(["Interstate", None, "State Route"], "o_orderkey")} AS "SIGNED_ROUTE_FAMILY_PRIMARY",
  o_orderkey % 6 = 0 AS "SEC_EVAC", o_orderkey % 18 = 0 AS "SEC_EVAC_CONTRAFLOW", {_pick(["SR 1; I 16", "SR 1", None, " ; Coast Way; ", ""], "o_orderkey")} AS "SEC_EVAC_ROUTE_NAME", {_pick(["High", "Low", None, "Medium"], "o_orderkey")} AS "SRP_DERIVED", {_pick(["NHS route | US route", "US route", None], "o_orderkey")} AS "SRP_DERIVED_REASONS", {_pick(["SR", "US", None], "o_orderkey")} AS "ROUTE_TYPE_GDOT", CASE WHEN o_orderkey % 9 = 0 THEN 1 END AS "NHFN", o_orderkey % 10 = 0 AS "IS_GRIP_CORRIDOR" FROM orders"""


def summaries(spark: SparkSession, d: str) -> DataFrame:
    """All six summaries of enriched rows; columns that are not there count as 0."""
    s = made(spark, d, ENRICHED.replace('"', "`"))
    told = [reports.enrichment_summary(s, name, gap_fills=("SPEED_LIMIT",) if name == "hpms" else ()) for name in reports.SUMMARIES]
    whole = told[0]
    for df in told[1:]:
        whole = whole.unionByName(df)
    return whole


def _summaries_sql() -> str:
    out = []

    def one(summary: str, item: str, condition: str) -> None:
        out.append(f"SELECT '{summary}' AS summary, '{item}' AS item, '' AS member, count(*) FILTER ({condition}) AS rows FROM s")

    def each(summary: str, item: str, member: str, source: str = "s") -> None:
        out.append(f"SELECT '{summary}', '{item}', {member}, count(*) FROM {source} GROUP BY 3")

    for summary in ("speed_limits", "hpms", "signed_routes", "evacuation", "priority", "phase_1b"):
        one(summary, "segment_count", "true")
    one("speed_limits", "speed_limit_coverage", "SPEED_LIMIT IS NOT NULL")
    one("speed_limits", "school_zone_segments", "IS_SCHOOL_ZONE")
    each("speed_limits", "speed_limit_source_counts", "coalesce(SPEED_LIMIT_SOURCE, '-')")
    each("speed_limits", "speed_limit_distribution", "CAST(SPEED_LIMIT AS VARCHAR)", "s WHERE SPEED_LIMIT IS NOT NULL")
    for n in ("iri", "psr", "rutting", "cracking", "access_control", "terrain", "nhfn", "strahnet_type", "route_signing"):
        one("hpms", f"hpms_{n}_coverage", "HPMS_IRI IS NOT NULL" if n == "iri" else "false")
    one("hpms", "hpms_gap_fill_speed_limit", "SPEED_LIMIT IS NOT NULL")
    one("hpms", "final_aadt_coverage", "AADT IS NOT NULL")
    one("hpms", "hpms_aadt_filled", "AADT_2024_SOURCE = 'hpms_2024'")
    one("hpms", "hpms_signing_upgrades", "SIGNED_ROUTE_VERIFY_SOURCE = 'hpms_2024'")
    each("hpms", "signed_route_source_counts", "coalesce(SIGNED_ROUTE_VERIFY_SOURCE, '-')")
    each("hpms", "final_aadt_source_counts", "coalesce(AADT_2024_SOURCE, '-')")
    one("signed_routes", "signed_interstate_segments", "SIGNED_INTERSTATE_FLAG")
    one("signed_routes", "signed_us_route_segments", "SIGNED_US_ROUTE_FLAG")
    one("signed_routes", "signed_state_route_segments", "false")
    each("signed_routes", "primary_family_counts", "coalesce(SIGNED_ROUTE_FAMILY_PRIMARY, '-')")
    each("signed_routes", "verification_source_counts", "coalesce(SIGNED_ROUTE_VERIFY_SOURCE, '-')")
    one("evacuation", "evacuation_segments", "SEC_EVAC")
    one("evacuation", "contraflow_segments", "SEC_EVAC_CONTRAFLOW")
    each("evacuation", "evacuation_route_names", "x", "(SELECT trim(unnest(string_split(SEC_EVAC_ROUTE_NAME, '; '))) AS x FROM s) WHERE x <> ''")
    one("priority", "null_srp_count", "SRP_DERIVED IS NULL")
    each("priority", "tier_counts", "SRP_DERIVED", "s WHERE SRP_DERIVED IS NOT NULL")
    each("priority", "reason_counts", "x", "(SELECT trim(unnest(string_split(SRP_DERIVED_REASONS, ' | '))) AS x FROM s) WHERE x <> ''")
    each("priority", "tier_by_route_type", "ROUTE_TYPE_GDOT || '/' || SRP_DERIVED", "s WHERE ROUTE_TYPE_GDOT IS NOT NULL AND SRP_DERIVED IS NOT NULL")
    one("phase_1b", "nhfn_non_null", "NHFN IS NOT NULL")
    one("phase_1b", "strahnet_type_non_null", "false")
    one("phase_1b", "grip_flagged", "IS_GRIP_CORRIDOR")
    one("phase_1b", "epz_flagged", "false")
    one("phase_1b", "sole_connection_flagged", "false")
    one("phase_1b", "srp_null_count", "SRP_DERIVED IS NULL")
    each("phase_1b", "srp_tier_counts", "SRP_DERIVED", "s WHERE SRP_DERIVED IS NOT NULL")
    return f"WITH s AS ({ENRICHED}) " + " UNION ALL ".join(out)


QUERIES = {
    "enrichment_summaries": (summaries, _summaries_sql()),
    "interval_round_trip": (interval_round_trip, INTERVALS_SQL),
    "segments_round_trip": (segments_round_trip, WRITTEN_SQL),
    "layers_round_trip": (layers_round_trip, LAYERS_SQL),
    "observed_counts": (observed_counts, OBSERVED_SQL),
    "load_all": (load_all, ALL_SQL),
    "thematic_properties": (themes, THEMES_SQL),
}
