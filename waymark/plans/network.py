"""Queries on intervals, gaps, coverage, rules and the query service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import classify as R
from waymark.functions import scalars as P
from waymark.functions.scalars import round_even
from waymark.lineage import checkpointed
from waymark.operators import checks, intervals, reports, service
from waymark.operators import stations as S
from waymark.plans.adapters import REFERENCE_SQL, SEGMENTS_SQL, read, reference, segments

SEG = f"WITH {SEGMENTS_SQL}"
BOTH = f"{SEG}, {REFERENCE_SQL}"
_BEST = """best AS (
  SELECT s.*, r.ref_seq, r.ref_aadt, CASE WHEN r.ref_seq IS NOT NULL THEN least(s.to_mp, r.to_mp) - greatest(s.from_mp, r.from_mp) END AS overlap
  FROM seg s LEFT JOIN ref r ON s.ROUTE_ID = r.ROUTE_ID AND least(s.to_mp, r.to_mp) - greatest(s.from_mp, r.from_mp) > 1e-4
  QUALIFY row_number() OVER (PARTITION BY s.unique_id ORDER BY least(s.to_mp, r.to_mp) - greatest(s.from_mp, r.from_mp) DESC, r.from_mp, r.ref_seq, r.ref_aadt) = 1
)"""


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Miles by value source, agreement and confidence tier."""
    s = segments(spark, d).drop("HPMS_AADT")
    s = intervals.enrich(s, reference(spark, d), "ROUTE_ID", {"AADT_HPMS": "ref_aadt"}, {"AADT": "ref_aadt"}, "hpms", order=["ref_seq"])
    direct = F.col("AADT_FILL_METHOD") == "direct"
    s = s.withColumn("agreement", R.source_agreement(F.when(direct, F.col("AADT")), F.col("AADT_HPMS")))
    source = F.coalesce("AADT_SOURCE", F.lit("missing"))
    statistics = F.when(direct, F.when(F.col("FUNCTIONAL_CLASS") % 2 == 0, "Actual").otherwise("Estimated"))
    s = s.withColumn("tier", R.confidence_tier(F.col("agreement"), source, statistics))
    return s.groupBy(F.col("AADT_SOURCE").alias("source"), "agreement", "tier").agg(F.count("*").alias("rows"), F.sum("miles").alias("miles"))


FLAGSHIP_SQL = f"""{BOTH}, {_BEST}, told AS (
  SELECT miles, AADT IS NOT NULL AND FUNCTIONAL_CLASS % 2 = 0 AS actual, CASE WHEN AADT IS NULL AND ref_aadt IS NOT NULL THEN 'hpms' WHEN AADT IS NOT NULL THEN 'official_exact' END AS source,
    CASE WHEN AADT IS NULL AND ref_aadt IS NULL THEN 'missing' WHEN ref_aadt IS NULL THEN 'state_only' WHEN AADT IS NULL THEN 'hpms_only'
      WHEN abs(ref_aadt - AADT) <= 200 THEN 'both_agree' WHEN AADT <> 0 AND abs(ref_aadt - AADT) * 100 <= 15 * abs(AADT) THEN 'both_agree' ELSE 'both_disagree' END AS agreement
  FROM best
) SELECT source, agreement, CASE WHEN source IS NULL THEN 'missing' WHEN agreement = 'both_disagree' THEN 'low' WHEN actual OR agreement = 'both_agree' THEN 'high' ELSE 'medium' END AS tier,
  count(*) AS rows, sum(miles) AS miles FROM told GROUP BY 1, 2, 3"""


def agreement_and_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Agreement and tier of every pair of values near the bounds, with all sources and statistics types."""
    k = F.col("o_orderkey")
    sources = F.array(*[F.lit(x) for x in ("missing", "official_exact", "hpms", *R.DERIVED_SOURCES)], F.lit(None).cast("string"))
    types = F.array(F.lit("Actual"), F.lit(" Estimated "), F.lit("Calculated"), F.lit(None).cast("string"))
    s = read(spark, d, "orders").select(
        k.alias("id"), F.when(k % 9 != 0, (k * 31) % 4000).alias("state"), F.when(k % 7 != 0, (k * 31) % 4000 + (k * 17) % 900 - 450).alias("hpms"),
        F.element_at(sources, (k % 7 + 1).cast("int")).alias("source"), F.element_at(types, (k % 4 + 1).cast("int")).alias("statistics"),
    )
    s = s.withColumn("agreement", R.source_agreement(F.col("state"), F.col("hpms")))
    return s.select("id", "agreement", R.confidence_tier(F.col("agreement"), F.col("source"), F.col("statistics")).alias("tier"))


CONFIDENCE_SQL = """WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 <> 0 THEN (o_orderkey * 31) % 4000 END AS a, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey * 31) % 4000 + (o_orderkey * 17) % 900 - 450 END AS b,
  ['missing', 'official_exact', 'hpms', 'direction_mirror', 'analytical_gap_fill', 'nearest_neighbor', NULL][o_orderkey % 7 + 1] AS source, ['Actual', 'Estimated', 'Calculated', NULL][o_orderkey % 4 + 1] AS kind FROM orders),
g AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN 'missing' WHEN b IS NULL THEN 'state_only' WHEN a IS NULL THEN 'hpms_only' WHEN abs(b - a) <= 200 OR (a <> 0 AND abs(b - a) * 100 <= 15 * abs(a)) THEN 'both_agree' ELSE 'both_disagree' END AS agreement FROM s)
SELECT id, agreement, CASE WHEN source = 'missing' THEN 'missing' WHEN source IN ('direction_mirror', 'analytical_gap_fill', 'nearest_neighbor') OR agreement = 'both_disagree' THEN 'low' WHEN kind = 'Actual' OR agreement = 'both_agree' THEN 'high' ELSE 'medium' END AS tier FROM g"""


def best_overlap(spark: SparkSession, d: str) -> DataFrame:
    found = intervals.best_overlap(segments(spark, d), reference(spark, d), "ROUTE_ID", ["ref_seq", "ref_aadt"])
    return found.select("unique_id", "ref_seq", "ref_aadt", "overlap")


def first_covering(spark: SparkSession, d: str) -> DataFrame:
    wide = reference(spark, d).withColumns({"from_mp": F.col("from_mp") - 2, "to_mp": F.col("to_mp") + F.col("ref_seq") % 4})
    return intervals.first_covering(segments(spark, d), wide, "ROUTE_ID", ["ref_seq"]).select("unique_id", "ref_seq")


COVERING_SQL = f"""{BOTH}, wide AS (SELECT ROUTE_ID, ref_seq, from_mp - 2 AS f, to_mp + ref_seq % 4 AS t FROM ref)
SELECT s.unique_id, w.ref_seq FROM seg s LEFT JOIN wide w ON s.ROUTE_ID = w.ROUTE_ID AND w.f <= s.from_mp + 1e-4 AND w.t >= s.to_mp - 1e-4
QUALIFY row_number() OVER (PARTITION BY s.unique_id ORDER BY w.f, w.t, w.ref_seq) = 1"""


def segmentation(spark: SparkSession, d: str) -> DataFrame:
    """Routes cut at all reference ends."""
    routes = segments(spark, d).groupBy("ROUTE_ID").agg(F.min("from_mp").alias("from_mp"), F.max("to_mp").alias("to_mp"))
    return intervals.segment_routes(routes, reference(spark, d)).select("ROUTE_ID", F.col("piece").cast("bigint").alias("piece"), "from_mp", "to_mp")


SEGMENTATION_SQL = f"""{BOTH}, routes AS (SELECT ROUTE_ID, min(from_mp) AS f, max(to_mp) AS t FROM seg GROUP BY 1),
points AS (SELECT ROUTE_ID, f AS mp FROM routes UNION SELECT ROUTE_ID, t FROM routes UNION
  SELECT ROUTE_ID, mp FROM (SELECT ROUTE_ID, from_mp AS mp FROM ref UNION SELECT ROUTE_ID, to_mp FROM ref) JOIN routes USING (ROUTE_ID) WHERE mp > f + 1e-4 AND mp < t - 1e-4),
cut AS (SELECT ROUTE_ID, mp AS from_mp, lead(mp) OVER w AS to_mp, row_number() OVER w - 1 AS piece FROM points WINDOW w AS (PARTITION BY ROUTE_ID ORDER BY mp))
SELECT ROUTE_ID, piece, from_mp, to_mp FROM cut WHERE to_mp IS NOT NULL"""


def gap_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs with the rows beside them; every fifth route has no value at all."""
    s = segments(spark, d).withColumn("AADT", F.when((F.substring("ROUTE_ID", 1, 10).cast("int") % 5 != 0) & (F.col("seq") % 4 != 2), F.col("AADT")))
    return intervals.gap_runs(s, F.col("AADT").isNotNull(), value="AADT", keep=("COUNTY", "STATUS")).drop("run")


GAP_SQL = f"""{SEG}, s AS (SELECT * REPLACE (CASE WHEN CAST(left(ROUTE_ID, 10) AS INTEGER) % 5 <> 0 AND seq % 4 <> 2 THEN AADT END AS AADT) FROM seg),
t AS (SELECT *, AADT IS NOT NULL AS on_, row_number() OVER w AS n, count(AADT) OVER r AS yes, count(*) OVER r - count(AADT) OVER r AS no FROM s WINDOW w AS (PARTITION BY ROUTE_ID ORDER BY from_mp), r AS (PARTITION BY ROUTE_ID)),
g AS (SELECT *, n - row_number() OVER (PARTITION BY ROUTE_ID, on_ ORDER BY n) AS run FROM t),
k AS (SELECT ROUTE_ID, min(n) AS a, max(n) AS z, min(from_mp) AS from_mp, max(to_mp) AS to_mp, count(*) AS rows, sum(to_mp - from_mp) AS length, any_value(yes) AS route_covered, any_value(no) AS route_uncovered, arg_min(COUNTY, n) AS COUNTY, arg_min(STATUS, n) AS STATUS FROM g WHERE NOT on_ GROUP BY ROUTE_ID, run),
b AS (SELECT k.*, coalesce(p.on_, false) AS has_before, coalesce(q.on_, false) AS has_after, p.to_mp AS before_mp, q.from_mp AS after_mp, p.AADT AS before_value, q.AADT AS after_value FROM k LEFT JOIN t p ON p.ROUTE_ID = k.ROUTE_ID AND p.n = k.a - 1 LEFT JOIN t q ON q.ROUTE_ID = k.ROUTE_ID AND q.n = k.z + 1),
w AS (SELECT * EXCLUDE (a, z), CASE WHEN has_before AND has_after THEN 1 WHEN has_before OR has_after THEN 2 WHEN route_covered > 0 THEN 3 ELSE 4 END AS c FROM b)
SELECT * EXCLUDE (c), ['interpolate_between_adjacent_covered', 'single_side_extension', 'route_has_nonadjacent_covered_only', 'no_current_aadt_on_route'][c] AS strategy, ['high', 'medium', 'low', 'low'][c] AS priority FROM w"""


def interpolation(spark: SparkSession, d: str) -> DataFrame:
    """Gaps on routes with holes between rows; only rows of status F or O with an even number are official."""
    rows = segments(spark, d).where("(seq + COUNTY) % 4 <> 0")
    found = intervals.interpolate_gaps(rows, "AADT", F.col("seq") % 5 != 0, longest=60.0)
    return found.select("unique_id", "AADT", "interpolated")


INTERPOLATION_SQL = f"""{SEG}, h AS (SELECT *, AADT IS NOT NULL AND seq % 5 <> 0 AS on_ FROM seg WHERE (seq + COUNTY) % 4 <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY ROUTE_ID ORDER BY from_mp) AS rn, sum(CASE WHEN on_ THEN 1 ELSE 0 END) OVER (PARTITION BY ROUTE_ID ORDER BY from_mp) AS run FROM h),
g AS (SELECT ROUTE_ID, run, min(rn) AS first_at, max(rn) AS last_at, sum(to_mp - from_mp) AS length FROM o WHERE NOT on_ GROUP BY 1, 2),
n AS (SELECT g.*, p.AADT AS pv, p.to_mp AS pe, q.AADT AS nv, q.from_mp AS nb FROM g LEFT JOIN o p ON p.ROUTE_ID = g.ROUTE_ID AND p.rn = g.first_at - 1 LEFT JOIN o q ON q.ROUTE_ID = g.ROUTE_ID AND q.rn = g.last_at + 1),
f AS (SELECT o.*, n.pv, n.pe, n.nv, n.nb, NOT o.on_ AND n.length <= 60 AND n.pv IS NOT NULL AND n.nv IS NOT NULL AS fills FROM o LEFT JOIN n ON o.ROUTE_ID = n.ROUTE_ID AND o.run = n.run AND NOT o.on_)
SELECT unique_id, CASE WHEN fills THEN CAST(round_even(pv + CASE WHEN nb - pe <= 1e-4 THEN 0.5 ELSE least(1.0, greatest(0.0, ((from_mp + to_mp) / 2 - pe) / (nb - pe))) END * (nv - pv), 0) AS BIGINT) ELSE AADT END AS AADT, coalesce(fills, false) AS interpolated FROM f"""


def direction_mirror(spark: SparkSession, d: str) -> DataFrame:
    return intervals.direction_mirror(segments(spark, d), ["AADT"], F.col("AADT").isNotNull()).select("unique_id", "AADT", "mirrored")


MIRROR_SQL = f"""{SEG}, giver AS (SELECT left(ROUTE_ID, length(ROUTE_ID) - 3) AS base, from_mp, to_mp, AADT FROM seg WHERE ROUTE_ID LIKE '%INC' AND AADT IS NOT NULL),
m AS (SELECT s.unique_id, g.AADT FROM seg s JOIN giver g ON left(s.ROUTE_ID, length(s.ROUTE_ID) - 3) = g.base AND least(s.to_mp, g.to_mp) - greatest(s.from_mp, g.from_mp) >= 1e-4
  WHERE s.ROUTE_ID LIKE '%DEC' AND s.AADT IS NULL
  QUALIFY row_number() OVER (PARTITION BY s.unique_id ORDER BY least(s.to_mp, g.to_mp) - greatest(s.from_mp, g.from_mp) DESC, g.from_mp, g.AADT) = 1)
SELECT s.unique_id, coalesce(s.AADT, m.AADT) AS AADT, m.unique_id IS NOT NULL AS mirrored FROM seg s LEFT JOIN m USING (unique_id)"""


def nearest_on_route(spark: SparkSession, d: str) -> DataFrame:
    return intervals.nearest_on_route(segments(spark, d), "AADT").select("unique_id", "AADT", "nearest_distance")


NEAREST_SQL = f"""{SEG}, c AS (SELECT s.unique_id, n.AADT, abs((s.from_mp + s.to_mp) / 2 - (n.from_mp + n.to_mp) / 2) AS dist
  FROM seg s JOIN seg n ON s.ROUTE_ID = n.ROUTE_ID AND n.AADT IS NOT NULL AND s.AADT IS NULL
  QUALIFY row_number() OVER (PARTITION BY s.unique_id ORDER BY abs((s.from_mp + s.to_mp) / 2 - (n.from_mp + n.to_mp) / 2), n.from_mp) = 1)
SELECT s.unique_id, CASE WHEN s.AADT IS NULL AND dist <= 20 THEN c.AADT ELSE s.AADT END AS AADT, CASE WHEN dist <= 20 THEN dist END AS nearest_distance FROM seg s LEFT JOIN c USING (unique_id)"""


def merged(spark: SparkSession, d: str) -> DataFrame:
    return intervals.merge_intervals(segments(spark, d).where("AADT is not null"), ["ROUTE_ID"], 0.5, "from_mp", "to_mp").select("ROUTE_ID", "from_mp", "to_mp")


MERGED_SQL = f"""{SEG}, t AS (SELECT *, CASE WHEN from_mp > max(to_mp) OVER (PARTITION BY ROUTE_ID ORDER BY from_mp, to_mp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 0.5 THEN 1 ELSE 0 END AS new FROM seg WHERE AADT IS NOT NULL),
i AS (SELECT *, sum(new) OVER (PARTITION BY ROUTE_ID ORDER BY from_mp, to_mp) AS island FROM t)
SELECT ROUTE_ID, min(from_mp) AS from_mp, max(to_mp) AS to_mp FROM i GROUP BY ROUTE_ID, island"""


def coverage(spark: SparkSession, d: str) -> DataFrame:
    return reports.coverage_by(segments(spark, d), ["DISTRICT", "FUNCTIONAL_CLASS"], F.col("AADT").isNotNull(), "miles")


COVERAGE_SQL = f"""{SEG} SELECT DISTRICT, FUNCTIONAL_CLASS, count(*) AS rows, count(AADT) AS covered_rows, count(*) - count(AADT) AS uncovered_rows,
  coalesce(sum(miles) FILTER (AADT IS NOT NULL), 0) AS covered_miles, coalesce(sum(miles) FILTER (AADT IS NULL), 0) AS uncovered_miles, 100.0 * count(AADT) / count(*) AS covered_pct FROM seg GROUP BY 1, 2"""


def coverage_audit(spark: SparkSession, d: str) -> DataFrame:
    return reports.coverage_audit(segments(spark, d), ["DISTRICT", "STATUS", "URBAN_CODE"], F.col("AADT").isNotNull(), "miles")


AUDIT_SQL = f"""{SEG} SELECT CASE WHEN grouping(DISTRICT) = 0 THEN 'DISTRICT' WHEN grouping(STATUS) = 0 THEN 'STATUS' WHEN grouping(URBAN_CODE) = 0 THEN 'URBAN_CODE' ELSE 'total' END AS dimension,
  coalesce(CAST(DISTRICT AS VARCHAR), STATUS, CAST(URBAN_CODE AS VARCHAR)) AS member, count(*) AS rows, count(AADT) AS covered_rows, sum(miles) AS miles, coalesce(sum(miles) FILTER (AADT IS NOT NULL), 0) AS covered_miles
  FROM seg GROUP BY GROUPING SETS ((DISTRICT), (STATUS), (URBAN_CODE), ())"""


def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """The audit's headline, its uncovered rows, and routes that have some, as one long table."""
    s = _compared(spark, d).withColumn("source", F.when(F.col("state").isNotNull(), "official_exact").when(F.col("ref_aadt") > 8000, "analytical_gap_fill"))
    on, sure = F.col("source").isNotNull(), F.col("state").isNotNull()
    # read by three parts and by the samples for their orders, so it is worked off once, in the columns they need
    s = checkpointed(s.select(F.when(~on, F.col("unique_id")).alias("unique_id"), "ROUTE_ID", "COUNTY", "STATUS", "FUNCTIONAL_CLASS", "miles", "source", "state"))
    head = reports.coverage_headline(s, on, sure, "source", "FUNCTIONAL_CLASS", "miles")
    items = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in head.columns]))
    rows = reports.uncovered_rows(s, on, ["unique_id", "miles", "GONE"], ["STATUS", "ROUTE_ID"])
    routes = reports.uncovered_routes(s, ["ROUTE_ID", "COUNTY", "STATUS"], on, "miles")
    told = head.select(F.lit("headline").alias("kind"), items)
    told = told.unionByName(rows.select(F.lit("row").alias("kind"), F.col("unique_id").alias("name"), F.col("miles").alias("value")))
    return told.unionByName(routes.select(F.lit("route").alias("kind"), F.concat_ws("/", "ROUTE_ID", F.col("COUNTY").cast("string"), "STATUS", F.col("covered_rows").cast("string"), F.col("uncovered_rows").cast("string")).alias("name"), F.col("uncovered_miles").cast("double").alias("value")))


def _coverage_sql() -> str:
    n = {"segments": "true", "covered_segments": "on_", "official_segments": "state IS NOT NULL", "gap_fill_segments": "on_ AND state IS NULL", "uncovered_segments": "NOT on_", "state_segments": "FUNCTIONAL_CLASS = 1", "state_uncovered_segments": "FUNCTIONAL_CLASS = 1 AND NOT on_"}
    m = {"miles": "true", "covered_miles": "on_", "official_miles": "state IS NOT NULL", "gap_fill_miles": "on_ AND state IS NULL", "uncovered_miles": "NOT on_"}
    x = [(k, f"CAST(count(*) FILTER ({w}) AS DOUBLE)") for k, w in n.items()] + [(k, f"coalesce(sum(miles) FILTER ({w}), 0)") for k, w in m.items()]
    x += [("covered_pct", "round(100.0 * count(*) FILTER (on_) / count(*), 4)"), ("official_pct", "round(100.0 * count(state) / count(*), 4)"), ("covered_miles_pct", "round(100.0 * sum(miles) FILTER (on_) / sum(miles), 4)"), ("state_covered_pct", "round(100.0 * count(*) FILTER (FUNCTIONAL_CLASS = 1 AND on_) / count(*) FILTER (FUNCTIONAL_CLASS = 1), 4)")]
    return f"""{_COMPARED}, c AS (SELECT *, state IS NOT NULL OR coalesce(ref_aadt > 8000, false) AS on_ FROM t) {" UNION ALL ".join(f"SELECT 'headline' AS kind, '{k}' AS name, {v} AS value FROM c" for k, v in x)}
UNION ALL SELECT 'row', unique_id, miles FROM c WHERE NOT on_ UNION ALL SELECT 'route', concat_ws('/', ROUTE_ID, COUNTY, STATUS, count(*) FILTER (on_), count(*) FILTER (NOT on_)), sum(miles) FILTER (NOT on_) FROM c GROUP BY ROUTE_ID, COUNTY, STATUS HAVING count(*) FILTER (NOT on_) > 0"""


def growth_fallback(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).withColumn("AADT", F.when((F.col("COUNTY") % 3 != 0) & (F.col("DISTRICT") != 2), F.col("AADT")))
    return S.median_with_fallback(s, "AADT", [["COUNTY", "STATUS"], ["DISTRICT", "STATUS"]]).select("unique_id", "AADT_median", "AADT_median_level")


FALLBACK_SQL = f"""{SEG}, s AS (SELECT * REPLACE (CASE WHEN COUNTY % 3 <> 0 AND DISTRICT <> 2 THEN AADT END AS AADT) FROM seg),
a AS (SELECT COUNTY, STATUS, median(AADT) AS m FROM s WHERE AADT IS NOT NULL GROUP BY 1, 2), b AS (SELECT DISTRICT, STATUS, median(AADT) AS m FROM s WHERE AADT IS NOT NULL GROUP BY 1, 2), c AS (SELECT median(AADT) AS m FROM s)
SELECT unique_id, coalesce(a.m, b.m, c.m) AS AADT_median, CASE WHEN a.m IS NOT NULL THEN 'COUNTY+STATUS' WHEN b.m IS NOT NULL THEN 'DISTRICT+STATUS' WHEN c.m IS NOT NULL THEN 'all' END AS AADT_median_level
FROM s LEFT JOIN a USING (COUNTY, STATUS) LEFT JOIN b ON s.DISTRICT = b.DISTRICT AND s.STATUS = b.STATUS CROSS JOIN c"""


def dominant(spark: SparkSession, d: str) -> DataFrame:
    return S.dominant_value(segments(spark, d), "COUNTY", "FUNCTIONAL_CLASS")


DOMINANT_SQL = f"{SEG} SELECT COUNTY, FUNCTIONAL_CLASS FROM seg GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY COUNTY ORDER BY count(*) DESC, FUNCTIONAL_CLASS) = 1"


def repeated_values(spark: SparkSession, d: str) -> DataFrame:
    return R.repeated_value_flag(segments(spark, d), "HPMS_AADT", 4, "flag", (6, 7)).select("unique_id", "flag")


REPEATED_SQL = f"{SEG} SELECT unique_id, CASE WHEN HPMS_AADT IS NOT NULL THEN CAST(count(*) OVER (PARTITION BY FUNCTIONAL_CLASS, HPMS_AADT) >= 4 AND FUNCTIONAL_CLASS IN (6, 7) AS INTEGER) END AS flag FROM seg"


def priority(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    k = F.col("o_orderkey")
    s = o.select(
        k.alias("id"), F.when(k % 8 != 0, 1 + k % 7).alias("FUNCTIONAL_CLASS"), (k % 11 == 0).alias("SIGNED_INTERSTATE_FLAG"), (k % 13 == 0).cast("int").alias("SIGNED_US_ROUTE_FLAG"), F.when(k % 17 == 0, 1 + k % 3).alias("STRAHNET"), F.when(k % 19 == 0, 2).otherwise(0).alias("NHFN"),
        F.when(k % 5 == 0, k % 3).alias("NHS_IND"), F.when(k % 3 == 0, F.floor(F.col("o_totalprice") / 60).cast("bigint")).alias("AADT_2024"), F.when(k % 3 != 1, F.floor(F.col("o_totalprice") / 50).cast("bigint")).alias("AADT_2024_HPMS"), F.when(k % 9 != 1, F.floor(F.col("o_totalprice") / 70).cast("bigint")).alias("AADT"),
        (k % 23 == 0).alias("SEC_EVAC"), (k % 29 == 0).alias("SEC_EVAC_CONTRAFLOW"), (k % 31 == 0).alias("IS_GRIP_CORRIDOR"), (k % 41 == 0).alias("IS_NUCLEAR_EPZ_ROUTE"), (k % 37 == 0).alias("IS_SOLE_COUNTY_SEAT_CONNECTION"),
        F.when(F.col("o_orderstatus") == "P", " US ").otherwise("SR").alias("ROUTE_TYPE_GDOT"), F.when(k % 2 == 0, 2 + k % 5).alias("THROUGH_LANES"), F.when(k % 4 != 0, 20 + k % 30).alias("SPEED_LIMIT"), F.when(k % 6 != 0, (k % 100) / 10).alias("segment_length_mi"),
    )
    return s.withColumn("p", R.priority_tier(s.columns)).select("id", "p.tier", "p.reasons")


PRIORITY_SQL = """WITH s AS (SELECT o_orderkey AS id, o_orderkey AS k, CASE WHEN o_orderkey % 8 <> 0 THEN 1 + o_orderkey % 7 END AS fc, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 3 END AS nhs, CASE WHEN o_orderkey % 17 = 0 THEN 1 + o_orderkey % 3 END AS stra,
  coalesce(CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice / 60) END, CASE WHEN o_orderkey % 3 <> 1 THEN floor(o_totalprice / 50) END, CASE WHEN o_orderkey % 9 <> 1 THEN floor(o_totalprice / 70) END) AS aadt, o_orderstatus = 'P' OR o_orderkey % 13 = 0 AS us,
  CASE WHEN o_orderkey % 2 = 0 THEN 2 + o_orderkey % 5 END AS lanes, CASE WHEN o_orderkey % 4 <> 0 THEN 20 + o_orderkey % 30 END AS speed, CASE WHEN o_orderkey % 6 <> 0 THEN (o_orderkey % 100) / 10 END AS miles FROM orders),
r AS (SELECT id, concat_ws(' | ', CASE WHEN fc = 1 OR k % 11 = 0 THEN 'Interstate' END, CASE WHEN k % 19 = 0 THEN 'National freight corridor (NHFN)' END, CASE WHEN stra IN (1, 2) THEN 'State freight corridor (STRAHNET)' END, CASE WHEN nhs >= 2 AND nhs < 10 THEN 'Intermodal connector (NHS)' END) AS c,
  concat_ws(' | ', CASE WHEN stra IN (1, 2) THEN 'STRAHNET' END, CASE WHEN nhs >= 1 AND aadt > 3000 THEN 'NHS principal arterial (AADT > 3,000)' END, CASE WHEN us THEN 'US route' END, CASE WHEN k % 31 = 0 THEN 'GRIP corridor' END, CASE WHEN k % 41 = 0 THEN 'Nuclear plant EPZ route' END, CASE WHEN k % 23 = 0 THEN 'GEMA evacuation route' END, CASE WHEN k % 37 = 0 THEN 'Sole county-seat connection' END, CASE WHEN aadt > 3000 AND NOT coalesce(nhs >= 1, false) THEN 'AADT > 3,000 (non-NHS)' END) AS h,
  concat_ws(' | ', CASE WHEN k % 23 = 0 OR k % 29 = 0 THEN 'Hurricane evacuation route' END, CASE WHEN nhs >= 1 AND (aadt IS NULL OR aadt <= 3000) THEN 'NHS with AADT <= 3,000' END, CASE WHEN us AND lanes >= 4 THEN 'US highway with 4+ lanes' END) AS m,
  concat_ws(' | ', CASE WHEN aadt < 3000 THEN 'AADT < 3,000' END, CASE WHEN speed < 35 THEN 'Speed limit < 35 mph' END, CASE WHEN miles < 5 THEN 'Segment < 5 mi' END) AS l FROM s)
SELECT id, CASE WHEN c <> '' THEN 'Critical' WHEN h <> '' THEN 'High' WHEN m <> '' THEN 'Medium' ELSE 'Low' END AS tier, CASE WHEN c <> '' THEN c WHEN h <> '' THEN h WHEN m <> '' THEN m WHEN l <> '' THEN l ELSE 'Default (no higher criteria met)' END AS reasons FROM r"""


def class_summary(spark: SparkSession, d: str) -> DataFrame:
    wanted = service.Filters({"DISTRICT": (1, 2, 3)})
    return service.summary_by_class(segments(spark, d), wanted, miles="miles")


SUMMARY_SQL = f"{SEG} SELECT FUNCTIONAL_CLASS, count(*) AS rows, sum(miles) AS miles, grouping(FUNCTIONAL_CLASS) = 1 AS is_total FROM seg WHERE DISTRICT IN (1, 2, 3) GROUP BY ROLLUP (FUNCTIONAL_CLASS)"


def page(spark: SparkSession, d: str) -> DataFrame:
    return service.page(segments(spark, d), service.Filters({"STATUS": ("F",)}), 250, 100).select("unique_id", "AADT", "miles")


PAGE_SQL = f"{SEG} SELECT unique_id, AADT, miles FROM seg WHERE STATUS = 'F' ORDER BY unique_id LIMIT 250 OFFSET 100"


def option_lists(spark: SparkSession, d: str) -> DataFrame:
    return service.options(segments(spark, d), {"district": ("DISTRICT", "DISTRICT"), "county": ("COUNTY", "COUNTY"), "status": ("STATUS", "STATUS")})


OPTIONS_SQL = f"""{SEG} SELECT DISTINCT dimension, id, id AS name FROM (SELECT 'district' AS dimension, CAST(DISTRICT AS VARCHAR) AS id FROM seg UNION ALL SELECT 'county', CAST(COUNTY AS VARCHAR) FROM seg UNION ALL SELECT 'status', STATUS FROM seg) WHERE id IS NOT NULL"""


def cascade(spark: SparkSession, d: str) -> DataFrame:
    return service.city_cascade(segments(spark, d), "COUNTY", "FUNCTIONAL_CLASS", "miles")


CASCADE_SQL = f"{SEG} SELECT COUNTY, FUNCTIONAL_CLASS, sum(miles) AS miles FROM seg GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY COUNTY ORDER BY sum(miles) DESC, FUNCTIONAL_CLASS) = 1"


def county_districts(spark: SparkSession, d: str) -> DataFrame:
    return service.county_options(segments(spark, d), "COUNTY", "URBAN_CODE")


COUNTY_SQL = f"{SEG} SELECT COUNTY, URBAN_CODE, count(*) AS rows FROM seg GROUP BY 1, 2 QUALIFY rank() OVER (PARTITION BY COUNTY ORDER BY count(*) DESC) = 1"


def property_bounds(spark: SparkSession, d: str) -> DataFrame:
    return service.property_bounds(segments(spark, d), ["AADT", "miles", "FUNCTIONAL_CLASS"])


BOUNDS_SQL = f"""{SEG} SELECT 'AADT' AS property, CAST(min(AADT) AS DOUBLE) AS min_value, CAST(max(AADT) AS DOUBLE) AS max_value FROM seg UNION ALL SELECT 'miles', min(miles), max(miles) FROM seg
UNION ALL SELECT 'FUNCTIONAL_CLASS', CAST(min(FUNCTIONAL_CLASS) AS DOUBLE), CAST(max(FUNCTIONAL_CLASS) AS DOUBLE) FROM seg"""


def score(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).withColumn("covered", F.col("AADT").isNotNull())
    return reports.min_max_score(s, {"HPMS_AADT": 0.25, "miles": 0.25, "covered": 0.5}).select("unique_id", "score")


SCORE_SQL = f"""{SEG}, b AS (SELECT CAST(min(HPMS_AADT) AS DOUBLE) AS a, CAST(max(HPMS_AADT) AS DOUBLE) AS z, min(miles) AS ma, max(miles) AS mz FROM seg)
SELECT unique_id, round_even(0.0 + 0.25 * ((HPMS_AADT - a) / (z - a)) + 0.25 * ((miles - ma) / (mz - ma)) + 0.5 * CAST(AADT IS NOT NULL AS INTEGER), 4) AS score FROM seg, b"""


def _compared(spark: SparkSession, d: str) -> DataFrame:
    """Segments with both sources, agreement and tier; every 50th state value is 0."""
    s = segments(spark, d).withColumn("state", F.when(F.col("HPMS_AADT") % 50 == 0, F.lit(0)).otherwise(F.col("AADT"))).drop("HPMS_AADT", "AADT")
    s = intervals.best_overlap(s, reference(spark, d), "ROUTE_ID", ["ref_seq", "ref_aadt"], together=True)
    s = s.withColumns({"agreement": R.source_agreement(F.col("state"), F.col("ref_aadt")), "source": F.when(F.col("state").isNotNull(), "official_exact").when(F.col("ref_aadt").isNotNull(), "hpms"), "statistics": F.when(F.col("state").isNotNull(), F.when(F.col("FUNCTIONAL_CLASS") % 2 == 0, "Actual").otherwise("Estimated"))})
    tier = R.confidence_tier(F.col("agreement"), F.coalesce("source", F.lit("missing")), F.col("statistics"))
    return s.withColumns({"tier": tier, "value": F.coalesce("state", "ref_aadt"), "label": F.when(F.col("FUNCTIONAL_CLASS") != 3, F.concat(F.lit("Class "), F.col("FUNCTIONAL_CLASS").cast("string")))})


_COMPARED = f"""{SEG.replace("AS AADT,", "AS AADT0,")}, {REFERENCE_SQL}, z AS (SELECT *, CASE WHEN HPMS_AADT % 50 = 0 THEN 0 ELSE AADT0 END AS state FROM seg),
best AS (SELECT s.*, r.ref_aadt FROM z s LEFT JOIN ref r ON s.ROUTE_ID = r.ROUTE_ID AND least(s.to_mp, r.to_mp) - greatest(s.from_mp, r.from_mp) > 1e-4
  QUALIFY row_number() OVER (PARTITION BY s.unique_id ORDER BY least(s.to_mp, r.to_mp) - greatest(s.from_mp, r.from_mp) DESC, r.from_mp, r.ref_seq, r.ref_aadt) = 1),
g AS (SELECT *, CASE WHEN state IS NULL AND ref_aadt IS NULL THEN 'missing' WHEN ref_aadt IS NULL THEN 'state_only' WHEN state IS NULL THEN 'hpms_only' WHEN abs(ref_aadt - state) <= 200 OR (state <> 0 AND abs(ref_aadt - state) * 100 <= 15 * abs(state)) THEN 'both_agree' ELSE 'both_disagree' END AS agreement FROM best),
t AS (SELECT *, CASE WHEN state IS NULL AND ref_aadt IS NULL THEN 'missing' WHEN agreement = 'both_disagree' THEN 'low' WHEN (state IS NOT NULL AND FUNCTIONAL_CLASS % 2 = 0) OR agreement = 'both_agree' THEN 'high' ELSE 'medium' END AS tier,
  CASE WHEN agreement = 'both_disagree' AND state <> 0 THEN 100.0 * (abs(ref_aadt - state) / abs(state)) END AS rel, CASE WHEN agreement = 'both_disagree' THEN CAST(abs(ref_aadt - state) AS DOUBLE) END AS gap FROM g)"""
_BINS = [(0, 25), (25, 50), (50, 100), (100, 250), (250, 500), (500, 1000), (1000, None)]


def _bin_label(low: int, high: int | None) -> str:
    return f"{low}-{high}%" if high else f"≥{low}%"


def histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.difference_histogram(_compared(spark, d), "state", "ref_aadt", "agreement")


HISTOGRAM_SQL = f"{_COMPARED} " + " UNION ALL ".join(f"SELECT '{_bin_label(a, b)}' AS bin, count(*) AS rows FROM t WHERE rel >= {a}{f' AND rel < {b}' if b else ''}" for a, b in _BINS)


def agreement_report(spark: SparkSession, d: str) -> DataFrame:
    """All sections of the report on two sources."""
    names = reports.ReportColumns("state", "ref_aadt", "agreement", "tier", "statistics", "source", "value", "FUNCTIONAL_CLASS", "label", "STATUS", "miles")
    return reports.agreement_report(_compared(spark, d), names).withColumn("value", round_even("value", 6))


def _counts(section: str, member: str, group: str, *items: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {member} AS member, '{n}' AS item, CAST({v} AS DOUBLE) AS value FROM t {group}" for n, v in items)


_ALL, _SHARE = "(SELECT count(*) FROM t)", "100.0 * count(*) / (SELECT count(*) FROM t)"
_TIER_ITEMS = [("total", "count(*)"), *[(x, f"count(*) FILTER (tier = '{x}')") for x in ("high", "medium", "low", "missing")]]
_REPORT = [
    *[_counts("agreement", f"'{x}'", f"WHERE agreement = '{x}'", ("rows", "count(*)"), ("pct", _SHARE), ("miles", "coalesce(sum(miles), 0)")) for x in ("state_only", "hpms_only", "both_agree", "both_disagree", "missing")],
    *[_counts("confidence", f"'{x}'", f"WHERE tier = '{x}'", ("rows", "count(*)"), ("pct", _SHARE), ("miles", "coalesce(sum(miles), 0)")) for x in ("high", "medium", "low", "missing")],
    *[_counts("histogram", f"'{_bin_label(a, b)}'", f"WHERE rel >= {a}{f' AND rel < {b}' if b else ''}", ("rows", "count(*)")) for a, b in _BINS],
    _counts("by_class", "CAST(FUNCTIONAL_CLASS AS VARCHAR) || CASE WHEN FUNCTIONAL_CLASS = 3 THEN ' -' ELSE ' Class ' || FUNCTIONAL_CLASS END", "GROUP BY FUNCTIONAL_CLASS", *_TIER_ITEMS), _counts("by_system", "STATUS", "GROUP BY STATUS", *_TIER_ITEMS),
    _counts("statistics", "CASE WHEN state IS NULL THEN '-' WHEN FUNCTIONAL_CLASS % 2 = 0 THEN 'Actual' ELSE 'Estimated' END", "GROUP BY 2", ("rows", "count(*)")),
    _counts("source", "CASE WHEN state IS NOT NULL THEN 'official_exact' WHEN ref_aadt IS NOT NULL THEN 'hpms' ELSE '-' END", "GROUP BY 2", ("rows", "count(*)"), ("pct", _SHARE)),
    *[_counts("uplift", f"'{m}'", f"WHERE {w}", ("rows", "count(*)"), ("pct", _SHARE)) for m, w in (("all", "true"), ("state", "state IS NOT NULL"), ("other", "ref_aadt IS NOT NULL"), ("either", "coalesce(state, ref_aadt) IS NOT NULL"), ("value", "coalesce(state, ref_aadt) IS NOT NULL"))],
    _counts("disagreement", "'both_disagree'", "WHERE agreement = 'both_disagree'", ("rows", "count(*)"), ("pct_of_overlap", "100.0 * count(*) / (SELECT count(*) FROM t WHERE agreement IN ('both_agree', 'both_disagree'))"), ("pct_of_all", _SHARE), ("median_rel_pct", "median(rel)"), ("mean_rel_pct", "avg(rel)"), ("median_abs", "median(gap)"), ("mean_abs", "avg(gap)")),
]
REPORT_SQL = f"""{_COMPARED}, top AS (SELECT unique_id, gap * miles AS impact FROM t WHERE gap IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 20)
SELECT section, member, item, round_even(value, 6) AS value FROM ({" UNION ALL ".join(_REPORT)} UNION ALL SELECT 'top', unique_id, 'impact', impact FROM top)"""


def quality_checks(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d)
    told = checks.table_checks(s, 1000, 10, {"AADT": 0.3, "miles": 0.01}, {"FUNCTIONAL_CLASS": (1, 7)}, "unique_id")
    return checks.all_checks(told, checks.implies(s, "aadt_has_status", "AADT", "STATUS"), checks.same_keys(s, reference(spark, d), "routes", "ROUTE_ID"))


CHECKS_SQL = f"""{BOTH}, n AS (SELECT count(*) AS n, count(AADT) AS a, count(miles) AS m, count(DISTINCT unique_id) AS u, count(*) FILTER (NOT FUNCTIONAL_CLASS BETWEEN 1 AND 7) AS bad, count(*) FILTER (AADT IS NOT NULL AND STATUS IS NULL) AS bare FROM seg),
w AS (SELECT count(*) AS cols FROM (DESCRIBE {SEG} SELECT * FROM seg)),
x AS (SELECT count(*) AS l FROM (SELECT ROUTE_ID FROM seg EXCEPT SELECT ROUTE_ID FROM ref)), y AS (SELECT count(*) AS r FROM (SELECT ROUTE_ID FROM ref EXCEPT SELECT ROUTE_ID FROM seg)), t AS (SELECT * FROM n, w, x, y)
SELECT 'row_count' AS name, n >= 1000 AS passed, CAST(n AS VARCHAR) AS detail FROM t UNION ALL SELECT 'column_count', cols >= 10, CAST(cols AS VARCHAR) FROM t
UNION ALL SELECT 'nulls_AADT', (n - a) / n < 0.3, CAST(round((n - a) / n, 6) AS VARCHAR) FROM t UNION ALL SELECT 'nulls_miles', (n - m) / n < 0.01, CAST(round((n - m) / n, 6) AS VARCHAR) FROM t
UNION ALL SELECT 'range_FUNCTIONAL_CLASS', bad = 0, CAST(bad AS VARCHAR) FROM t UNION ALL SELECT 'unique_unique_id', n = u, CAST(n - u AS VARCHAR) FROM t UNION ALL SELECT 'aadt_has_status', bare = 0, CAST(bare AS VARCHAR) FROM t UNION ALL SELECT 'routes', l + r = 0, CAST(l AS VARCHAR) || '/' || CAST(r AS VARCHAR) FROM t"""


def route_families(spark: SparkSession, d: str) -> DataFrame:
    """Families of ids made from parts."""
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, "1257")), (k % 4 + 1).cast("int"))
    suffix = F.element_at(F.array(*map(F.lit, ["00", "BU", "SP", "12"])), (F.floor(k / 4) % 4 + 1).cast("int"))
    made = F.concat(kind, F.lpad((k % 159).cast("string"), 3, "0"), (1 + k % 4).cast("string"), F.lpad((k % 450).cast("string"), 6, "0"), suffix, F.lit("INC"))
    rows = read(spark, d, "part").select(made.alias("route_id")).withColumn("f", R.route_family(F.col("route_id")))
    return rows.groupBy(F.col("f.family").alias("family"), F.col("f.detail").alias("detail"), F.col("f.confidence").alias("confidence"), F.col("f.source").alias("source")).agg(F.count("*").alias("rows"), F.sum("f.base_number").alias("base_sum"))


FAMILIES_SQL = f"""WITH p AS (SELECT p_partkey AS k, ['1', '2', '5', '7'][p_partkey % 4 + 1] AS kind, ['00', 'BU', 'SP', '12'][(p_partkey // 4) % 4 + 1] AS suffix, 1 + p_partkey % 4 AS sys, p_partkey % 450 AS num FROM part),
b AS (SELECT *, CASE WHEN kind = '2' THEN num % 1000 ELSE num END AS base, CASE suffix WHEN 'BU' THEN 'Business' WHEN 'SP' THEN 'Spur' END AS label, CASE kind WHEN '2' THEN 'Ramp' WHEN '5' THEN 'Frontage Road' WHEN '7' THEN 'Separate Managed Facility' END AS what FROM p),
f AS (SELECT *, CASE WHEN sys <> 1 THEN 'Local/Other' WHEN base IN ({", ".join(map(str, R.INTERSTATE_NUMBERS))}) THEN 'Interstate' WHEN base IN ({", ".join(map(str, R.US_NUMBERS))}) THEN 'U.S. Route' ELSE 'State Route' END AS family FROM b)
SELECT family,
  CASE WHEN sys = 1 THEN concat_ws(' ', family, CASE WHEN kind = '7' AND label IS NOT NULL THEN label ELSE coalesce(what, label) END)
    WHEN sys = 3 THEN concat_ws(' ', 'Private Road', what) WHEN sys = 4 THEN concat_ws(' ', 'Federal Route', what) WHEN what IS NOT NULL THEN 'Public Road ' || what
    WHEN suffix = '00' THEN 'County Road' WHEN suffix = '12' THEN 'City Street' ELSE 'Public Road' END AS detail,
  CASE WHEN sys = 1 AND family <> 'Interstate' THEN 'medium' ELSE 'high' END AS confidence,
  CASE WHEN sys = 1 THEN CASE family WHEN 'Interstate' THEN 'gdot_appendix_f_interstate' WHEN 'U.S. Route' THEN 'gdot_appendix_g_us_route' ELSE 'system_code_1_state_route_fallback' END
    WHEN what IS NOT NULL THEN 'function_type_' || kind WHEN sys = 3 THEN 'system_code_3_private' WHEN sys = 4 THEN 'system_code_4_federal' WHEN suffix = '00' THEN 'public_road_suffix_00' WHEN suffix = '12' THEN 'public_road_numeric_suffix' ELSE 'public_road_fallback' END AS source,
  count(*) AS rows, sum(base) AS base_sum FROM f GROUP BY 1, 2, 3, 4"""


def id_guard(spark: SparkSession, d: str) -> DataFrame:
    s = segments(spark, d).withColumn("unique_id", F.concat_ws("_", F.col("COUNTY").cast("string"), F.floor("from_mp").cast("string")))
    return P.unique_id_guard(s, "unique_id", ("DISTRICT", "STATUS")).groupBy("unique_id").agg(F.count("*").alias("rows"))


GUARD_SQL = f"""{SEG}, s AS (SELECT CAST(COUNTY AS VARCHAR) || '_' || CAST(CAST(floor(from_mp) AS BIGINT) AS VARCHAR) AS u, CAST(DISTRICT AS VARCHAR) || '|' || STATUS AS p FROM seg),
g AS (SELECT CASE WHEN count(*) OVER (PARTITION BY u) > 1 THEN u || '_' || left(md5(p), 6) ELSE u END AS unique_id FROM s) SELECT unique_id, count(*) AS rows FROM g GROUP BY 1"""


#: made when all texts above are known
COVERAGE_REPORT_SQL = _coverage_sql()
QUERIES = {
    "flagship": (flagship, FLAGSHIP_SQL),
    "agreement_and_confidence": (agreement_and_confidence, CONFIDENCE_SQL),
    "interval_best_overlap": (best_overlap, f"{BOTH}, {_BEST} SELECT unique_id, ref_seq, ref_aadt, overlap FROM best"),
    "interval_first_covering": (first_covering, COVERING_SQL),
    "segment_routes": (segmentation, SEGMENTATION_SQL),
    "gap_runs": (gap_runs, GAP_SQL),
    "gap_interpolation": (interpolation, INTERPOLATION_SQL),
    "direction_mirror": (direction_mirror, MIRROR_SQL),
    "nearest_on_route": (nearest_on_route, NEAREST_SQL),
    "merge_intervals": (merged, MERGED_SQL),
    "coverage_by": (coverage, COVERAGE_SQL),
    "coverage_audit": (coverage_audit, AUDIT_SQL),
    "coverage_report": (coverage_report, COVERAGE_REPORT_SQL),
    "median_with_fallback": (growth_fallback, FALLBACK_SQL),
    "dominant_value": (dominant, DOMINANT_SQL),
    "repeated_value_flag": (repeated_values, REPEATED_SQL),
    "priority_tier": (priority, PRIORITY_SQL),
    "summary_by_class": (class_summary, SUMMARY_SQL),
    "page": (page, PAGE_SQL),
    "filter_options": (option_lists, OPTIONS_SQL),
    "city_cascade": (cascade, CASCADE_SQL),
    "county_options": (county_districts, COUNTY_SQL),
    "property_bounds": (property_bounds, BOUNDS_SQL),
    "min_max_score": (score, SCORE_SQL),
    "difference_histogram": (histogram, HISTOGRAM_SQL),
    "agreement_report": (agreement_report, REPORT_SQL),
    "quality_checks": (quality_checks, CHECKS_SQL),
    "route_families": (route_families, FAMILIES_SQL),
    "unique_id_guard": (id_guard, GUARD_SQL),
}
