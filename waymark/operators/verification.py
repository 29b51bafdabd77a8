"""Speed zones and signed-route references joined to segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.classify import FAMILIES, family_rank
from waymark.functions.scalars import as_int, clean_text, normalize_road_name, rclink_candidates, round_milepoint
from waymark.operators.intervals import EPSILON, best_overlap, unambiguous

# Reference layers in the order they are applied, the family each vouches for, and columns tried for ids, milepoints and labels.
REFERENCES = {"interstates": "Interstate", "us_highway": "U.S. Route", "state_routes": "State Route"}
ID_COLUMNS = ("RCLINK", "RC_LINK", "ROUTE_ID")
FROM_COLUMNS = ("BEGINNING_MILEPOINT", "BEGINNING_MP", "FROM_MILEPOINT")
TO_COLUMNS = ("ENDING_MILEPOINT", "ENDING_MP", "TO_MILEPOINT")
LABEL_COLUMNS = {
    "interstates": (("INTERSTATE_NAME", "INTERSTATE_NUMBER", "INTERSTATE_NUM", "INTERSTATE"), ("ROUTE_NUMBER", "STATE_ROUTE_NUMBER")),
    "us_highway": (("US_ROUTE_NUM", "US_ROUTE_NUMBER_ABBREVIATED", "US_ROUTE_NUMBER"), ("STATE_ROUTE_NUMBER_ABBREVIATED", "STATE_ROUTE_NUMBER")),
    "state_routes": (("ROUTE_DESCRIPTION", "ROUTE_NUMBER"), ("ROUTE_SUFFIX",)),
}
VERIFY_SCORES = {"high": 0.95, "medium": 0.6, "low": 0.3}
FLAGS = {"SIGNED_INTERSTATE_FLAG": "Interstate", "SIGNED_US_ROUTE_FLAG": "U.S. Route", "SIGNED_STATE_ROUTE_FLAG": "State Route"}


def _upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().upper() for c in df.columns])


def _first(df: DataFrame, names: tuple[str, ...]) -> Column | None:
    return next((F.col(n) for n in names if n in df.columns), None)


def _or_null(x: Column | None, kind: str) -> Column:
    return F.lit(None).cast(kind) if x is None else x.cast(kind)


def normalize_reference_layer(layer: DataFrame, kind: str, by_route_id: bool = False) -> DataFrame:
    """RCLINK, from_mp, to_mp and the two labels of a reference layer, from the first column of each that it has.

    Keys are in upper case: the first 13 characters of a route id, or links of ten
    characters with zeros in front. A layer without an id column has empty keys.
    """
    df = _upper_names(layer)
    found = _first(df, ID_COLUMNS)
    key = F.upper(F.trim(found.cast("string"))) if found is not None else F.lit("")
    if by_route_id:
        key = F.substring(key, 1, 13)
    elif found is not None:
        key = F.when(F.length(key) < 10, F.lpad(key, 10, "0")).otherwise(key)
    primary, secondary = LABEL_COLUMNS[kind]
    return df.select(
        F.lit(kind).alias("reference"), F.lit(REFERENCES[kind]).alias("family"), key.alias("RCLINK"), round_milepoint(_or_null(_first(df, FROM_COLUMNS), "double")).alias("from_mp"),
        round_milepoint(_or_null(_first(df, TO_COLUMNS), "double")).alias("to_mp"), F.trim(_or_null(_first(df, primary), "string")).alias("label"), F.trim(_or_null(_first(df, secondary), "string")).alias("state_label"),
    )


def initial_verification(segments: DataFrame) -> DataFrame:
    """Verification columns from the route family, where they are missing or null."""
    family, confidence = F.col("ROUTE_FAMILY"), F.col("ROUTE_FAMILY_CONFIDENCE")
    score = F.when(confidence == "high", 0.95).when(confidence == "medium", 0.6).otherwise(0.3)
    start: dict[str, Column] = {name: family.eqNullSafe(F.lit(f)) for name, f in FLAGS.items()}
    start |= {
        "SIGNED_ROUTE_FAMILY_PRIMARY": family, "SECONDARY_SIGNED_ROUTE_FAMILY": F.lit(None).cast("string"), "TERTIARY_SIGNED_ROUTE_FAMILY": F.lit(None).cast("string"),
        "SIGNED_ROUTE_FAMILY_ALL": F.when(family.isin(*FAMILIES), F.to_json(F.array(family))).otherwise("[]"), "SIGNED_ROUTE_VERIFY_SOURCE": F.lit("route_id_crosswalk"),
        "SIGNED_ROUTE_VERIFY_METHOD": F.lit("route_id_crosswalk"), "SIGNED_ROUTE_VERIFY_CONFIDENCE": confidence, "SIGNED_ROUTE_VERIFY_SCORE": score, "SIGNED_ROUTE_VERIFY_NOTES": F.lit(None).cast("string"),
    }
    return segments.withColumns({n: F.coalesce(F.col(n), x) if n in segments.columns else x for n, x in start.items()})


def match_reference(segments: DataFrame, reference: DataFrame, id_: str = "unique_id") -> DataFrame:
    """(id, label, state_label, exact) of the first reference record for each state-system segment.

    Keys are tried in order (13 characters of the route id, then the links derived from
    it), records of a key by milepoints with nulls last. A null bound on either side counts
    as an overlap; else more than epsilon has to be shared.
    """
    route = F.upper(F.trim(F.coalesce("ROUTE_ID", F.lit(""))))
    own = F.when(F.length(route) >= 13, F.array(F.substring(route, 1, 13))).otherwise(F.array().cast("array<string>"))
    asked = segments.where(F.col("SYSTEM_CODE").cast("string") == "1").select(id_, round_milepoint(F.col("from_mp")).alias("_f"), round_milepoint(F.col("to_mp")).alias("_t"), F.posexplode(F.concat(own, rclink_candidates(F.col("ROUTE_ID")))).alias("_pos", "RCLINK"))
    asked = asked.withColumnsRenamed({"RCLINK": "_link"})
    # equal records, and segments that ask the same, meet once
    r = reference.where(F.length("RCLINK") > 0).groupBy("RCLINK", F.col("from_mp").alias("_rf"), F.col("to_mp").alias("_rt")).agg(F.min(F.struct("label", "state_label")).alias("_told"))
    each = asked.select(F.col("_link").alias("RCLINK"), F.col("_f").alias("_af"), F.col("_t").alias("_at")).distinct()
    shared = F.least("_at", "_rt") - F.greatest("_af", "_rf")
    open_bound = F.col("_af").isNull() | F.col("_at").isNull() | F.col("_rf").isNull() | F.col("_rt").isNull()
    met = each.join(r, "RCLINK").where(open_bound | (shared > EPSILON))
    order = F.struct(F.col("_rf").isNull().alias("_no_rf"), "_rf", F.col("_rt").isNull().alias("_no_rt"), "_rt", "_told")
    first = met.groupBy("RCLINK", "_af", "_at").agg(F.min(order).alias("_first"))
    found = asked.join(first, (F.col("_link") == F.col("RCLINK")) & F.col("_f").eqNullSafe(F.col("_af")) & F.col("_t").eqNullSafe(F.col("_at")))
    best = found.groupBy(id_).agg(F.min(F.struct("_pos", "_first")).alias("_b")).select(id_, "_b._first.*")
    return best.select(id_, "_told.label", "_told.state_label", (~F.col("_no_rf") & ~F.col("_no_rt")).alias("interval"))


def apply_reference(segments: DataFrame, matches: DataFrame, kind: str, id_: str = "unique_id") -> DataFrame:
    """Verification columns once a reference layer is taken in.

    Its family becomes the primary one if it ranks as high or higher (or there is none), and
    with it come source, method, confidence and score; otherwise these stay. Notes are
    appended, and the list keeps the primary family first.
    """
    c, family = F.col, F.lit(REFERENCES[kind])
    told = segments.join(matches.withColumn("_hit", F.lit(True)), id_, "left")
    hit, primary = F.coalesce("_hit", F.lit(False)), c("SIGNED_ROUTE_FAMILY_PRIMARY")
    known = primary.isin(*FAMILIES)
    promotes = F.coalesce(~known, F.lit(True)) | (family_rank(family) <= family_rank(primary))
    listed = F.coalesce(F.from_json("SIGNED_ROUTE_FAMILY_ALL", "array<string>"), F.array().cast("array<string>"))
    every = F.concat(listed, F.array_compact(F.array(primary)), F.array(family))
    ranked = F.filter(F.array(*map(F.lit, FAMILIES)), lambda f: F.array_contains(every, f))
    new = F.when(promotes, family).otherwise(primary)
    ordered = F.concat(F.array(c("_new")), F.filter(ranked, lambda f: f != c("_new")))
    told = told.withColumns({"_promotes": hit & promotes, "_new": new}).withColumn("_all", ordered)
    note = F.concat_ws("; ", clean_text(c("SIGNED_ROUTE_VERIFY_NOTES")), F.lit(f"official_{kind}_match"), F.concat(F.lit("label="), clean_text(c("label"))), F.concat(F.lit("state_label="), clean_text(c("state_label"))))
    method = F.when(c("interval"), "derived_rclink_interval").otherwise("derived_rclink_exact")
    changed: dict[str, Column] = {
        "SIGNED_ROUTE_FAMILY_ALL": F.to_json("_all"), "SIGNED_ROUTE_FAMILY_PRIMARY": F.get("_all", 0), "SECONDARY_SIGNED_ROUTE_FAMILY": F.get("_all", 1), "TERTIARY_SIGNED_ROUTE_FAMILY": F.get("_all", 2), "SIGNED_ROUTE_VERIFY_NOTES": note,
    }
    changed |= {name: F.array_contains("_all", f) for name, f in FLAGS.items()}
    changed = {n: F.when(hit, x).otherwise(c(n)) for n, x in changed.items()}
    taken = {"SOURCE": F.lit(f"gdot_{kind}"), "METHOD": method, "CONFIDENCE": F.lit("high"), "SCORE": F.lit(VERIFY_SCORES["high"])}
    changed |= {f"SIGNED_ROUTE_VERIFY_{n}": F.when(c("_promotes"), x).otherwise(c(f"SIGNED_ROUTE_VERIFY_{n}")) for n, x in taken.items()}
    return told.withColumns(changed).select(*segments.columns)


def verify_signed_routes(segments: DataFrame, references: dict[str, DataFrame], id_: str = "unique_id") -> DataFrame:
    """Segments (ROUTE_ID, SYSTEM_CODE, from_mp, to_mp, ROUTE_FAMILY, ROUTE_FAMILY_CONFIDENCE) verified against the layers there are, in their fixed order."""
    told = initial_verification(segments)
    for kind in REFERENCES:
        if kind in references:
            told = apply_reference(told, match_reference(told, references[kind], id_), kind, id_)
    return told


def verification_coverage(segments: DataFrame, matches: DataFrame, kind: str, least: float = 0.8) -> DataFrame:
    """(reference, matched, expected, enough): matches against segments of the layer's family; enough also where none is expected."""
    found = matches.agg(F.count("*").alias("matched"))
    wanted = segments.agg(F.count_if(F.col("ROUTE_FAMILY") == REFERENCES[kind]).alias("expected"))
    enough = (F.col("expected") == 0) | (F.col("matched") >= least * F.col("expected"))
    return found.crossJoin(F.broadcast(wanted)).select(F.lit(kind).alias("reference"), "matched", "expected", enough.alias("enough"))


def normalize_speed_zones(zones: DataFrame, route: str = "ROUTE_ID", begin: str = "FROM_MILEPOINT", end: str = "TO_MILEPOINT") -> DataFrame:
    """Active zones (all, if there is no status): route base of 13 characters, from_mp, to_mp, limit and school flag; rows without limit or base go."""
    df = _upper_names(zones)
    if "RECORD_STATUS_CD" in df.columns:
        df = df.where(F.upper(F.trim("RECORD_STATUS_CD")) == "ACTV")
    school = F.upper(F.trim("IS_SCHOOL_ZONE_CD")).eqNullSafe(F.lit("Y")) if "IS_SCHOOL_ZONE_CD" in df.columns else F.lit(False)
    bound = [round_milepoint(F.col(x.upper()).cast("double")) if x.upper() in df.columns else F.lit(None).cast("double") for x in (begin, end)]
    told = df.select(F.substring(F.upper(F.trim(route.upper())), 1, 13).alias("route_base"), bound[0].alias("from_mp"), bound[1].alias("to_mp"), as_int(F.trim("SPEED_LIMIT_CD")).alias("speed_limit"), school.alias("school"))
    return told.where((F.length("route_base") >= 13) & F.col("speed_limit").isNotNull())


def speed_zones_on_system(segments: DataFrame, zones: DataFrame) -> DataFrame:
    """SPEED_LIMIT, IS_SCHOOL_ZONE and SPEED_LIMIT_SOURCE of state-system segments from the zone (``normalize_speed_zones``) that overlaps most; others get none."""
    base = F.when(F.col("SYSTEM_CODE").cast("string") == "1", F.substring(F.upper(F.trim("ROUTE_ID")), 1, 13))
    usable = F.when(F.length(base) >= 13, base)
    z = zones.where("from_mp is not null and to_mp is not null").withColumnsRenamed({"route_base": "_base", "speed_limit": "_limit", "school": "_school"})
    rest = segments.drop("SPEED_LIMIT", "IS_SCHOOL_ZONE", "SPEED_LIMIT_SOURCE").withColumn("_base", F.when(F.col("from_mp").isNotNull() & F.col("to_mp").isNotNull(), usable))
    found = best_overlap(rest, z, "_base", ["_limit", "_school"])
    hit = F.col("_limit").isNotNull()
    new = {"SPEED_LIMIT": F.col("_limit"), "IS_SCHOOL_ZONE": F.coalesce("_school", F.lit(False)), "SPEED_LIMIT_SOURCE": F.when(hit, "gdot_speed_zone_on_system")}
    return found.withColumns(new).drop("_base", "_limit", "_school", "overlap")


def speed_zones_off_system(segments: DataFrame, zones: DataFrame) -> DataFrame:
    """Limits that are still null from zones by road name and county, where all zones of a name and county agree."""
    df = _upper_names(zones)
    if "RECORD_STATUS_CD" in df.columns:
        df = df.where(F.upper(F.trim("RECORD_STATUS_CD")) == "ACTV")
    school = F.upper(F.trim("IS_SCHOOL_ZONE_CD")).eqNullSafe(F.lit("Y")) if "IS_SCHOOL_ZONE_CD" in df.columns else F.lit(False)

    def county(x: str) -> Column:
        text = F.trim(F.col(x).cast("string"))
        return F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)

    told = df.where("ROAD_NAME is not null and COUNTY_FIPS_CD is not null").select(normalize_road_name(F.col("ROAD_NAME")).alias("_name"), county("COUNTY_FIPS_CD").alias("_county"), as_int(F.trim("SPEED_LIMIT_CD")).alias("_limit"), school.alias("_school"))
    keys = unambiguous(told.where("_limit is not null and _name <> ''"), ["_name", "_county"], "_limit", ["_school"])
    rest = segments.withColumns({"_name": normalize_road_name(F.col("HPMS_ROUTE_NAME")), "_county": county("COUNTY_CODE")})
    found = rest.join(keys, ["_name", "_county"], "left")
    fills = F.col("SPEED_LIMIT").isNull() & F.col("_limit").isNotNull()
    new = {"SPEED_LIMIT": F.coalesce("SPEED_LIMIT", "_limit"), "IS_SCHOOL_ZONE": F.when(fills, F.col("_school")).otherwise(F.col("IS_SCHOOL_ZONE")), "SPEED_LIMIT_SOURCE": F.when(fills, "gdot_speed_zone_off_system").otherwise(F.col("SPEED_LIMIT_SOURCE"))}
    return found.withColumns(new).select(*segments.columns)
