"""Queries on parsing, keys and classification rules; inputs are made by SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import classify as R
from waymark.functions import scalars as P
from waymark.functions.scalars import round_even
from waymark.plans.adapters import made


def _pick(values: list[str | None], by: str) -> str:
    """CASE that picks one of the texts by a whole number."""
    said = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return "CASE " + by + " % " + str(len(values)) + " " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(said)) + " END"


NAMES = [" Main  Street ", "I 75 North", "Old SR 26", "US 27 Business/SR 1", "Interstate 16 Spur", "  ", None, "CR 780 connector / I-20", "state route 9", "Liberty Expy", "Oak Road (School Zone)**", "N.W. Elm-Avenue, East;", "SR1/US 027 Alternate", "SCHOOL  ZONE Pine Parkway/Old Hwy", "us highway 41;", "129BU"]
NAMED = f"SELECT p_partkey AS id, {_pick(NAMES, 'p_partkey')} AS name FROM part"


def road_names(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("name")
    return made(spark, d, NAMED).select("id", P.clean_text(n).alias("clean"), P.normalize_road_name(n).alias("road"), P.route_number_of_name(n).alias("number"), P.expected_family(n).alias("family"))


_WORDS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in P.ROAD_WORDS.items()) + "}"
ROADS_SQL = rf"""WITH s AS ({NAMED}), u AS (SELECT *, rtrim(upper(trim(coalesce(name, ''))), ';') AS t FROM s),
v AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\*+', '', 'g'), 'SCHOOL\s*ZONE', '', 'g'), '\(.*?\)', '', 'g'), '/.*$', ''), '[.\-,''"]', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM u),
n AS (SELECT *, coalesce(nullif(regexp_extract(name, '(?i)\bI[- ]?(\d{{1,4}})(\b|;)', 1), ''), nullif(regexp_extract(name, '(?i)\bINTERSTATE\s+(\d{{1,4}})(\b|;)', 1), ''), nullif(regexp_extract(name, '(?i)\bUS(\s+HIGHWAY)?\s*(\d{{1,4}})(\b|;)', 2), ''),
  nullif(regexp_extract(name, '(?i)\b(\d{{1,4}})(AL|BU|BY|CO|SP|LO|WE|EA|SO|NO|SE|SB|AS|CW|EC)(\b|;)', 1), ''), nullif(regexp_extract(name, '(?i)\bSR[- ]?(\d{{1,4}})(\b|;)', 1), ''), nullif(regexp_extract(name, '(?i)\bSTATE\s+ROUTE\s+(\d{{1,4}})(\b|;)', 1), '')) AS digits FROM v)
SELECT id, nullif(trim(name), '') AS clean, array_to_string([coalesce({_WORDS}[w], w) FOR w IN string_split(plain, ' ')], ' ') AS road, CAST(digits AS INTEGER) AS number,
  CASE WHEN regexp_matches(upper(name), '\b(I[- ]?\d|INTERSTATE)') THEN 'Interstate' WHEN regexp_matches(upper(name), '\bUS[- ]?(HIGHWAY)?\s*\d') THEN 'U.S. Route' WHEN regexp_matches(upper(name), '\b(SR[- ]?\d|STATE ROUTE)') THEN 'State Route' END AS family FROM n"""


def designations(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("name")
    told = F.array_join(F.transform(P.route_designations(n), lambda s: F.concat_ws(":", s["type"], s["number"].cast("string"), F.coalesce(s["suffix"], F.lit("-")))), ",")
    return made(spark, d, NAMED).select("id", told.alias("designations"), F.array_join(P.corridor_prefixes(n), ",").alias("prefixes"))


_SHORT = "MAP {'Spur': 'SPUR', 'Business': 'BUS', 'Connector': 'CONN', 'Bypass': 'BYP', 'Loop': 'LOOP', 'Alternate': 'ALT'}"
_RE = r"(?i)(I|Interstate|US|SR|CR)\s*-?\s*(\d+)(?:\s+(North|South|East|West|Spur|Business|Connector|Bypass|Loop|Alternate))?"
DESIGNATIONS_SQL = rf"""WITH s AS ({NAMED}), p AS (SELECT id, unnest(string_split(trim(regexp_replace(name, '\s+', ' ', 'g')), '/')) AS part, generate_subscripts(string_split(trim(regexp_replace(name, '\s+', ' ', 'g')), '/'), 1) AS n FROM s),
m AS (SELECT id, n, upper(regexp_extract(part, '{_RE}', 1)) AS k, regexp_extract(part, '{_RE}', 2) AS num, lower(regexp_extract(part, '{_RE}', 3)) AS sfx FROM p),
f AS (SELECT id, n, CASE k WHEN 'INTERSTATE' THEN 'I' ELSE k END AS k, num, CASE WHEN sfx IN ('spur', 'business', 'connector', 'bypass', 'loop', 'alternate') THEN upper(sfx[1]) || sfx[2:] END AS sfx FROM m WHERE num <> ''),
g AS (SELECT id, string_agg(k || ':' || CAST(CAST(num AS INTEGER) AS VARCHAR) || ':' || coalesce(sfx, '-'), ',' ORDER BY n) AS d, string_agg(concat_ws(' ', k || '-' || num, {_SHORT}[sfx]), ',' ORDER BY n) AS p FROM f GROUP BY id)
SELECT id, coalesce(d, '') AS designations, coalesce(p, '') AS prefixes FROM s LEFT JOIN g USING (id)"""

ROUTES = f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 31 = 0 THEN '1121' WHEN o_orderkey % 37 = 0 THEN NULL ELSE {_pick(["1", "2", "3", "4", "5", "9", "R"], "o_orderkey")} || lpad(CAST(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 160 END AS VARCHAR(9)), 3, '0') || {_pick(["1", "1", "2", "3"], "o_orderkey")}
  || CASE WHEN o_orderkey % 41 = 0 THEN 'ABCDEF' ELSE lpad(CAST(o_orderkey % 1999 AS VARCHAR(9)), 6, '0') END || {_pick(["00", "BU", "sp", "12"], "o_orderkey")} || {_pick(["INC", "DEC"], "o_orderkey")} END AS route_id,
  CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderkey % 997 AS DOUBLE) / 7 - 0.00003 END AS b, CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_orderkey % 997 AS DOUBLE) / 7 + CAST(o_orderkey % 13 AS DOUBLE) END AS e FROM orders"""


def route_keys(spark: SparkSession, d: str) -> DataFrame:
    s = made(spark, d, ROUTES)
    r, b, e = F.col("route_id"), P.round_milepoint(F.col("b")), P.round_milepoint(F.col("e"))
    fields = P.parse_route_id(r)
    return s.select(
        "id", P.unique_id(r, b, e).alias("unique_id"), F.array_join(P.rclink_candidates(r), ",").alias("rclinks"), F.array_join(P.rclink_candidates(r, F.lit("2"), F.lit(" 1 ")), ",").alias("told_rclinks"),
        *[fields[f].alias(f) for f in ("function_type", "county", "system_code", "route_number", "suffix", "direction")],
    )


def _rclinks(kind: str, system: str) -> str:
    number = f"lpad(CASE WHEN {kind} IN ('2', '3', '4') THEN right(digits, 3) ELSE right(digits, 4) END, 4, '0')"
    rest = f"upper({system} || {number} || r[12:13])"
    return f"CASE WHEN length(r) < 13 OR digits = '' THEN '' ELSE r[2:4] || {rest} || CASE WHEN {system} = '1' AND r[2:4] <> '000' THEN ',000' || {rest} ELSE '' END END"


_MP = "CASE WHEN {0} IS NULL THEN 'NA' ELSE printf('%.4f', CASE WHEN abs(round_even({0}, 4)) < 1e-4 THEN 0.0 ELSE round_even({0}, 4) END) END"
KEYS_SQL = f"""WITH s AS ({ROUTES}), t AS (SELECT *, upper(trim(coalesce(route_id, ''))) AS r, coalesce(route_id, '') AS x FROM s), u AS (SELECT *, regexp_replace(r[6:11], '[^0-9]', '', 'g') AS digits FROM t)
SELECT id, x || '_' || {_MP.format('b')} || '_' || {_MP.format('e')} AS unique_id, {_rclinks('r[1]', 'r[5]')} AS rclinks, {_rclinks("'2'", "'1'")} AS told_rclinks,
  x[1:1] AS function_type, x[2:4] AS county, x[5:5] AS system_code, x[6:11] AS route_number, x[12:13] AS suffix, x[14:] AS direction FROM u"""

STATION_FIELDS = f"""SELECT c_custkey AS id, {_pick(["33.5, -84.4", "33.5,-84.4 ", "0.5, 0.2", "33.5", "a, b", "33.5, -84.4, 1", None, " 31.25 , -82.5"], "c_custkey")} AS place, {_pick(["3U : Principal", " 7R", "U3", None, "12x", ""], "c_custkey")} AS fc,
  {_pick(["A", "E", "Actual_Est", " Other ", None], "c_custkey")} AS kind, {_pick(["121-0001.0", " 77 ", "5.05", "", None, "12.0.0"], "c_custkey")} AS tc, CAST(c_custkey % 11 AS DOUBLE) AS share, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 5 AS DOUBLE) END AS whole, c_custkey % 10 AS n FROM customer"""


def station_fields(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    place = P.parse_lat_long(c("place"))
    good = P.null_bad_coordinates(place["lat"], place["lon"])
    return made(spark, d, STATION_FIELDS).select(
        "id", good["lat"].alias("lat"), good["lon"].alias("lon"), P.parse_functional_class(c("fc")).alias("fc"), P.recode_statistics_type(c("kind")).alias("kind"), P.without_decimal(c("tc")).alias("tc"),
        round_even(P.haversine_m(good["lat"], good["lon"], F.lit(33.0) + c("n") / 10, F.lit(-84.0)), 3).alias("metres"), round_even(P.acs_rate(c("share"), c("whole")), 6).alias("rate"),
        round_even(P.percent(c("share"), c("whole")), 6).alias("pct"), P.percent(c("share"), c("whole"), 1).alias("pct1"), P.fc_bin(c("n")).alias("bin"), P.urban_rural(F.when(c("n") == 0, 99999).when(c("n") < 8, c("n"))).alias("area"),
        P.functional_class_label(F.when(c("n") > 0, c("n"))).alias("label"), R.resolver_confidence(F.when(c("n") < 9, c("n") / 50)).alias("confidence"),
    )


STATION_SQL = r"""WITH s AS (""" + STATION_FIELDS + r"""), t AS (SELECT *, string_split(place, ',') AS p FROM s), u AS (SELECT *, CASE WHEN len(p) = 2 THEN TRY_CAST(trim(p[1]) AS DOUBLE) END AS y0, CASE WHEN len(p) = 2 THEN TRY_CAST(trim(p[2]) AS DOUBLE) END AS x0 FROM t),
v AS (SELECT *, CASE WHEN y0 IS NOT NULL AND x0 IS NOT NULL AND NOT (abs(y0) < 1 AND abs(x0) < 1) THEN y0 END AS lat, CASE WHEN y0 IS NOT NULL AND x0 IS NOT NULL AND NOT (abs(y0) < 1 AND abs(x0) < 1) THEN x0 END AS lon FROM u)
SELECT id, lat, lon, CAST(nullif(regexp_extract(fc, '^\s*(\d+)', 1), '') AS INTEGER) AS fc, CASE trim(kind) WHEN 'A' THEN 'Actual' WHEN 'E' THEN 'Estimated' WHEN 'Actual_Est' THEN 'Estimated' ELSE trim(kind) END AS kind,
  nullif(regexp_replace(trim(tc), '\.0$', ''), '') AS tc,
  round_even(12742000.0 * asin(least(1.0, sqrt(sin(radians(33.0 + n / 10 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(33.0 + n / 10)) * sin(radians(-84.0 - lon) / 2) ** 2))), 3) AS metres,
  round_even(CASE WHEN whole <> 0 THEN share / whole ELSE 0.0 END, 6) AS rate, round_even(CASE WHEN whole > 0 THEN 100 * share / whole END, 6) AS pct, round_even(CASE WHEN whole > 0 THEN 100 * share / whole END, 1) AS pct1,
  CASE WHEN n IN (1, 2) THEN '1-2' WHEN n IN (3, 4) THEN '3-4' WHEN n IN (5, 6) THEN '5-6' WHEN n = 7 THEN '7' WHEN n IN (8, 9) THEN '8-9' END AS bin, CASE WHEN n = 0 THEN 'rural' WHEN n < 8 THEN 'urban' END AS area,
  CASE WHEN n > 7 THEN 'Class ' || CAST(n AS VARCHAR) WHEN n > 0 THEN ['Interstate', 'Principal Arterial - Freeway', 'Principal Arterial - Other', 'Minor Arterial', 'Major Collector', 'Minor Collector', 'Local'][n] END AS label,
  CASE WHEN n < 9 AND n / 50 > 0.10 THEN 'high' WHEN n < 9 AND n / 50 > 0.05 THEN 'medium' ELSE 'low' END AS confidence FROM v"""

DECODED = f"""SELECT o_orderkey AS id, {_pick(["1", "01", "1.0", "a", "A", " b ", "zz", None, "007"], "o_orderkey")} AS code, {_pick(["Label One", None, "other"], "o_orderkey")} AS existing, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 END AS alias_value, o_orderkey % 70 AS value,
  o_orderkey % 6 AS lanes, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 4 END AS median_type, CAST(o_orderkey % 90 AS DOUBLE) AS single, CAST(o_orderkey % 40 AS DOUBLE) AS combo, CAST(o_orderkey % 77 AS DOUBLE) AS aadt, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 9 AS DOUBLE) END AS ds, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 8 AS DOUBLE) END AS dc FROM orders"""
_LABELS = {"01": "Label One", "A": "Label A", "b": "Label B", "07": "Label Seven"}


def labels_and_alignment(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    s = made(spark, d, DECODED)
    s = P.sync_aliases(s, {"alias_value": "value"})
    names = {"single": "SINGLE_UNIT_AADT", "combo": "COMBO_UNIT_AADT", "aadt": "AADT", "lanes": "THROUGH_LANES", "median_type": "MEDIAN_TYPE", "ds": "HPMS_PCT_DH_SINGLE", "dc": "HPMS_PCT_DH_COMBINATION"}
    s = P.alignment_columns(s.withColumnsRenamed(names).withColumn("TRUCK_PCT", c("value").cast("double")))
    decoded = P.decode_label(c("code"), _LABELS, 2)
    s = s.withColumn("label", P.geometry_wins_label(c("existing"), decoded)["label"]).withColumn("diverges", P.geometry_wins_label(c("existing"), decoded)["diverges"])
    return P.move_column_after(s.select("id", decoded.alias("decoded"), "label", "diverges", "alias_value", "PCT_SADT", "PCT_CADT", "HWY_DES", "TRK_DHV_PCT"), "id", "label")


_D = "CASE WHEN trim(code) = '01' THEN 'Label One' WHEN trim(code) = 'b' THEN 'Label B' WHEN upper(trim(code)) = 'A' THEN 'Label A' WHEN TRY_CAST(trim(code) AS DOUBLE) = 1 THEN 'Label One' WHEN TRY_CAST(trim(code) AS DOUBLE) = 7 THEN 'Label Seven' END"
LABELS_SQL = f"""WITH s AS ({DECODED}), t AS (SELECT *, {_D} AS decoded FROM s) SELECT id, decoded, coalesce(existing, decoded) AS label, existing IS NOT NULL AND decoded IS NOT NULL AND existing <> decoded AS diverges, coalesce(alias_value, value) AS alias_value,
  CASE WHEN aadt > 0 THEN round_even(100 * single / aadt, 1) END AS "PCT_SADT", CASE WHEN aadt > 0 THEN round_even(100 * combo / aadt, 1) END AS "PCT_CADT", CASE WHEN lanes > 0 THEN CAST(lanes AS VARCHAR) || CASE WHEN median_type >= 2 THEN 'D' ELSE 'U' END END AS "HWY_DES", coalesce(ds + dc, value) AS "TRK_DHV_PCT" FROM t"""

_FAM = ["Interstate", "U.S. Route", "State Route", "Local/Other", None]
SIGNED = f"""SELECT p_partkey AS id, {_pick(_FAM, "p_partkey")} AS current, {_pick(_FAM, "CAST(floor(p_partkey / 5) AS BIGINT)")} AS other, CASE WHEN p_partkey % 9 <> 0 THEN p_partkey % 11 END AS signing, {_pick(_FAM, "CAST(floor(p_partkey / 3) AS BIGINT)")} AS reference FROM part"""


def signed_families(spark: SparkSession, d: str) -> DataFrame:
    s = made(spark, d, SIGNED)
    families = F.array_compact(F.array("other", "current"))
    slots, told = R.signed_family_slots(families), R.promote_family(F.col("current"), F.col("reference"))
    return s.select(
        "id", F.array_join(slots["families"], ",").alias("ranked"), slots["first"].alias("slot_1"), slots["second"].alias("slot_2"), slots["us_route"].alias("us_route"),
        F.array_join(R.merge_hpms_family(F.col("current"), F.array_compact(F.array("other")), F.col("signing")), ",").alias("merged"), told["family"].alias("promoted"), told["note"].alias("note"),
    )


_RANK = "CASE {0} WHEN 'Interstate' THEN 1 WHEN 'U.S. Route' THEN 2 WHEN 'State Route' THEN 3 END"
SIGNED_SQL = f"""WITH s AS ({SIGNED}), t AS (SELECT *, list_filter(['Interstate', 'U.S. Route', 'State Route'], lambda f: list_contains([other, current], f)) AS fam, CASE WHEN signing IN (2, 5) THEN 'Interstate' WHEN signing = 3 THEN 'U.S. Route' WHEN signing = 4 THEN 'State Route' END AS told,
  {_RANK.format('current')} AS rc, {_RANK.format('reference')} AS rr FROM s), u AS (SELECT *, {_RANK.format('told')} AS rt FROM t)
SELECT id, array_to_string(fam, ',') AS ranked, fam[1] AS slot_1, fam[2] AS slot_2, list_contains(fam, 'U.S. Route') AS us_route,
  array_to_string(CASE WHEN told IS NULL THEN fam WHEN rc < rt THEN list_concat(list_concat([current], list_filter(fam, lambda f: f <> current AND f <> told)), [told]) ELSE list_concat([told], list_filter(fam, lambda f: f <> told)) END, ',') AS merged,
  CASE WHEN rr IS NOT NULL AND (rc IS NULL OR rr < rc) THEN reference ELSE current END AS promoted, CASE WHEN rr IS NOT NULL AND (rc IS NULL OR rr < rc) THEN 'promoted to ' || reference WHEN rr = rc THEN 'confirmed ' || reference END AS note FROM u"""

TYPED = f"""SELECT o_orderkey AS id, 'R' || lpad(CAST(o_orderkey % 400 AS VARCHAR(9)), 6, '0') || {_pick(["INC", "DEC"], "o_orderkey")} AS "ROUTE_ID", {_pick(["1", "1", "1", "2", "1", "7", "1", "8", "9", "6"], "o_orderkey")} AS "FUNCTION_TYPE", {_pick(["1", "2", "3", "4", "2", "1", "1"], "o_orderkey")} AS "SYSTEM_CODE",
  {_pick(["00", "BU", "SP", "12", "XL", "AL", "CO", "05", "SB"], "o_orderkey")} AS "ROUTE_SUFFIX", {_pick(["Interstate", "U.S. Route", "State Route", "Local/Other"], "o_orderkey")} AS "ROUTE_FAMILY", {_pick(["U.S. Route", None, "State Route", "Interstate", "Local/Other"], "o_orderkey")} AS "SIGNED_ROUTE_FAMILY_PRIMARY",
  {_pick(["gdot_us", "hpms_2024", "other", None], "o_orderkey")} AS "SIGNED_ROUTE_VERIFY_SOURCE", CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey % 9 AS VARCHAR(9)) END AS "HPMS_ROUTE_SIGNING", CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 6 AS VARCHAR(9)) END AS "HPMS_ROUTE_NUMBER", {_pick([None, "SR 5", "US 41", "x"], "o_orderkey")} AS "HPMS_ROUTE_NAME", 400 + o_orderkey % 25 AS "BASE_ROUTE_NUMBER" FROM orders"""


def route_types(spark: SparkSession, d: str) -> DataFrame:
    s = made(spark, d, TYPED.replace('"', "`"))
    return R.with_highway_names(s).select("id", "ROUTE_TYPE_GDOT", "HWY_NAME")


_SIGN = "CASE CAST({0} AS INTEGER) WHEN 2 THEN 'Interstate' WHEN 5 THEN 'Interstate' WHEN 3 THEN 'U.S. Route' WHEN 4 THEN 'State Route' WHEN 6 THEN 'County Road' WHEN 7 THEN 'County Road' WHEN 8 THEN 'City Street' END"
_STATE = "{0} IN ('Interstate', 'U.S. Route', 'State Route')"
TYPES_SQL = f"""WITH s AS ({TYPED}), a AS (SELECT *, {_SIGN.format('"HPMS_ROUTE_SIGNING"')} AS told, CASE WHEN {_STATE.format('"SIGNED_ROUTE_FAMILY_PRIMARY"')} THEN "SIGNED_ROUTE_FAMILY_PRIMARY" END AS own FROM s),
b AS (SELECT *, coalesce(CASE WHEN "SIGNED_ROUTE_VERIFY_SOURCE" LIKE 'gdot_%' THEN own WHEN "SIGNED_ROUTE_VERIFY_SOURCE" = 'hpms_2024' AND {_STATE.format('told')} THEN told END, own, CASE WHEN {_STATE.format('"ROUTE_FAMILY"')} THEN "ROUTE_FAMILY" END) AS sg,
  CASE WHEN "SYSTEM_CODE" = '3' OR "FUNCTION_TYPE" = '9' THEN 'Private Road' WHEN "SYSTEM_CODE" = '4' THEN 'Federal Route' WHEN told IN ('County Road', 'City Street') THEN told WHEN "SYSTEM_CODE" = '2' AND "FUNCTION_TYPE" = '1' AND "ROUTE_SUFFIX" = '00' THEN 'County Road' WHEN "SYSTEM_CODE" = '2' AND "FUNCTION_TYPE" = '1' AND regexp_full_match("ROUTE_SUFFIX", '\\d\\d') THEN 'City Street' END AS lo FROM a),
c AS (SELECT *, CASE WHEN "FUNCTION_TYPE" = '2' THEN 'RP' WHEN "FUNCTION_TYPE" = '6' THEN 'ALY' WHEN "FUNCTION_TYPE" = '7' OR "ROUTE_SUFFIX" = 'XL' THEN 'ML' WHEN "FUNCTION_TYPE" = '8' THEN 'YC' WHEN "ROUTE_SUFFIX" IN ('BU', 'SB') THEN CASE sg WHEN 'Interstate' THEN 'BI' WHEN 'U.S. Route' THEN 'BU' ELSE 'BS' END
  WHEN "ROUTE_SUFFIX" = 'SP' THEN 'SP' WHEN "ROUTE_SUFFIX" = 'CO' THEN 'CN' WHEN "ROUTE_SUFFIX" = 'AL' THEN 'AL' WHEN sg = 'Interstate' THEN 'I' WHEN sg = 'U.S. Route' THEN 'US' WHEN sg = 'State Route' THEN 'SR' WHEN lo = 'County Road' THEN 'CR' WHEN lo = 'City Street' THEN 'CS' WHEN lo = 'Private Road' THEN 'PR' WHEN lo = 'Federal Route' THEN 'FED' ELSE 'OT' END AS k FROM b),
e AS (SELECT *, CASE WHEN k IN ('I', 'BI') OR sg = 'Interstate' THEN 'I' WHEN k IN ('US', 'BU') OR sg = 'U.S. Route' THEN 'US' WHEN k IN ('SR', 'BS') OR sg = 'State Route' THEN 'SR' WHEN k = 'CR' OR lo = 'County Road' THEN 'CR' WHEN k = 'CS' OR lo = 'City Street' THEN 'CS' END AS p, left("ROUTE_ID", 7) AS stem,
  coalesce(CAST("HPMS_ROUTE_NUMBER" AS INTEGER), CASE "HPMS_ROUTE_NAME" WHEN 'SR 5' THEN 5 WHEN 'US 41' THEN 41 END) AS num FROM c),
v AS (SELECT stem, p, num, count(*) AS n FROM e WHERE num IS NOT NULL GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY stem, p ORDER BY count(*) DESC, num) = 1),
f AS (SELECT e.*, coalesce(v.num, e.num, CASE WHEN e.p = 'I' THEN CASE "BASE_ROUTE_NUMBER" WHEN 401 THEN 75 WHEN 402 THEN 20 WHEN 403 THEN 85 WHEN 404 THEN 16 WHEN 405 THEN 95 WHEN 406 THEN 59 WHEN 407 THEN 285 WHEN 408 THEN 475 WHEN 409 THEN 24 WHEN 411 THEN 185 WHEN 413 THEN 675 WHEN 415 THEN 520 WHEN 417 THEN 575 WHEN 419 THEN 985 WHEN 421 THEN 516 END WHEN e.p IN ('US', 'SR', 'CR', 'CS') THEN "BASE_ROUTE_NUMBER" END) AS best
  FROM e LEFT JOIN v ON e.stem = v.stem AND e.p IS NOT DISTINCT FROM v.p)
SELECT id, k AS "ROUTE_TYPE_GDOT", CASE k WHEN 'RP' THEN 'RAMP' WHEN 'ALY' THEN 'ALLEY' WHEN 'YC' THEN 'Y-CONNECTOR' WHEN 'PR' THEN 'PRIVATE ROAD' WHEN 'FED' THEN 'FEDERAL ROUTE' ELSE
  CASE WHEN p IS NOT NULL AND best IS NOT NULL THEN concat_ws(' ', p || '-' || CAST(best AS VARCHAR), CASE k WHEN 'BI' THEN 'BUS' WHEN 'BU' THEN 'BUS' WHEN 'BS' THEN 'BUS' WHEN 'SP' THEN 'SPUR' WHEN 'CN' THEN 'CONN' WHEN 'AL' THEN 'ALT' WHEN 'ML' THEN 'EXPRESS' END) WHEN k = 'ML' THEN 'EXPRESS LANE' ELSE 'OTHER ROUTE' END END AS "HWY_NAME" FROM f"""

FLAGGED = f"""SELECT o_orderkey AS id, {_pick(["SR", "US", "SP", "BU", "CR", "CS", "I", None], "o_orderkey")} AS "ROUTE_TYPE_GDOT", o_orderkey % 40 AS "BASE_ROUTE_NUMBER", {_pick(["State Route", "U.S. Route", None], "o_orderkey")} AS "ROUTE_FAMILY", {_pick(["I-16 Spur", "I-75", "SR-26", None, "I-164"], "o_orderkey")} AS "HWY_NAME", 1 + o_orderkey % 7 AS "FUNCTIONAL_CLASS", CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 12 END AS "AADT_2022_HPMS" FROM orders"""
GRIP = "SELECT CASE p_partkey % 4 WHEN 0 THEN 'SR' WHEN 1 THEN 'US' WHEN 2 THEN 'SP' ELSE 'BU' END AS route_type, p_partkey % 30 AS base_number, 'Corridor ' || CAST(p_partkey % 5 AS VARCHAR(9)) AS name FROM part WHERE p_partkey % 3 = 0"
EVAC_NAME = "I 16 Spur/CR 12/SR 26 Business/US 9"


def corridor_rules(spark: SparkSession, d: str) -> DataFrame:
    """Corridor flags by attributes, hard outliers, and the masks of an evacuation name."""
    s = made(spark, d, FLAGGED.replace('"', "`"))
    s = R.corridor_flag(s, made(spark, d, GRIP))
    s = R.hard_outlier_flag(s, 2022)
    named = P.route_designations(F.lit(EVAC_NAME))
    return s.select("id", "GRIP_NAMES", "IS_GRIP_CORRIDOR", F.col("AADT_2022_OUTLIER").alias("outlier"), R.evacuation_prefilter(named, s.columns).alias("allowed"), R.designation_match(named, s.columns).alias("named"))


CORRIDOR_RULES_SQL = f"""WITH s AS ({FLAGGED}), g AS ({GRIP}), w AS (SELECT * FROM g UNION ALL SELECT x, base_number, name FROM g, (SELECT unnest(['SP', 'BU', 'CN', 'BY', 'LP', 'AL']) AS x) WHERE route_type = 'SR'), n AS (SELECT route_type, base_number, string_agg(DISTINCT name, '; ' ORDER BY name) AS names FROM w GROUP BY 1, 2),
m AS (SELECT "FUNCTIONAL_CLASS" AS f, "AADT_2022_HPMS" AS v, count(*) AS c FROM s GROUP BY 1, 2)
SELECT id, n.names AS "GRIP_NAMES", n.names IS NOT NULL AS "IS_GRIP_CORRIDOR", CASE WHEN m.v IS NOT NULL THEN CAST(m.c > 100 AS INTEGER) END AS outlier,
  NOT coalesce("ROUTE_TYPE_GDOT" IN ('CR', 'CS'), false) OR ("ROUTE_TYPE_GDOT" = 'CR' AND "BASE_ROUTE_NUMBER" = 12) AS allowed,
  coalesce("HWY_NAME" LIKE 'I-16%' AND upper("HWY_NAME") LIKE '%SPUR%', false) OR coalesce("ROUTE_TYPE_GDOT" = 'CR' AND "BASE_ROUTE_NUMBER" = 12, false) OR coalesce("ROUTE_TYPE_GDOT" IN ('SR', 'BU') AND "BASE_ROUTE_NUMBER" = 26, false) OR coalesce("ROUTE_TYPE_GDOT" = 'US' AND "BASE_ROUTE_NUMBER" = 9, false) AS named
FROM s LEFT JOIN n ON s."ROUTE_TYPE_GDOT" = n.route_type AND s."BASE_ROUTE_NUMBER" = n.base_number AND (s."ROUTE_TYPE_GDOT" NOT IN ('SP', 'BU') OR coalesce(s."ROUTE_FAMILY", 'State Route') = 'State Route') LEFT JOIN m ON s."FUNCTIONAL_CLASS" = m.f AND s."AADT_2022_HPMS" IS NOT DISTINCT FROM m.v"""

PLACES = f"""SELECT c_custkey AS "OBJECTID", CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE '  City  ' || CAST(c_custkey % 1200 AS VARCHAR(9)) || ' ' END AS "Name", CAST(c_custkey AS VARCHAR(20)) || '.0' AS code, CASE WHEN c_custkey % 2 = 0 THEN 'GA' ELSE ' fl' END AS "STATE" FROM customer"""


def place_ids(spark: SparkSession, d: str) -> DataFrame:
    s = made(spark, d, PLACES.replace('"', "`"))
    s = P.city_ids(s).withColumns({"block": P.geoid(F.col("code"), 15), "tract": P.geoid_parent(P.geoid(F.col("code"), 15), 11), "county": P.geoid(F.col("code"), 5)})
    georgia = P.harmonize(s, ["OBJECTID", "CITY_ID", "block", "tract", "county", "gone"], ("ST", "STATE"), "ga")
    rest = s.where("STATE <> 'GA'").select("OBJECTID", "CITY_ID", "block")
    return P.union_labelled({"georgia": georgia, "rest": rest}, "layer")


PLACES_SQL = rf"""WITH s AS ({PLACES}), t AS (SELECT *, lower(regexp_replace(trim("Name"), '\s+', ' ', 'g')) AS plain, lpad(regexp_replace(code, '\.0$', ''), 15, '0') AS block FROM s),
u AS (SELECT *, CASE WHEN plain IS NOT NULL AND plain <> '' AND count(*) OVER (PARTITION BY plain) = 1 THEN CAST(('0x' || md5(plain)[1:12])::UBIGINT AS BIGINT) ELSE "OBJECTID" + 281474976710656 END AS "CITY_ID" FROM t)
SELECT "OBJECTID", "CITY_ID", block, CASE WHEN "STATE" = 'GA' THEN left(block, 11) END AS tract, CASE WHEN "STATE" = 'GA' THEN lpad(regexp_replace(code, '\.0$', ''), 5, '0') END AS county, CASE WHEN "STATE" = 'GA' THEN 'georgia' ELSE 'rest' END AS layer FROM u"""

QUERIES = {
    "road_names": (road_names, ROADS_SQL),
    "route_designations": (designations, DESIGNATIONS_SQL),
    "route_keys": (route_keys, KEYS_SQL),
    "station_fields": (station_fields, STATION_SQL),
    "labels_and_alignment": (labels_and_alignment, LABELS_SQL),
    "signed_families": (signed_families, SIGNED_SQL),
    "route_types": (route_types, TYPES_SQL),
    "corridor_rules": (corridor_rules, CORRIDOR_RULES_SQL),
    "place_ids": (place_ids, PLACES_SQL),
}
