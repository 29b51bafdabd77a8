"""Rule-based classification as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.scalars import as_int, is_true, mapping, parse_route_id, route_number_of_name

# Route numbers of interstates and of U.S. routes, route suffixes and function types.
INTERSTATE_NUMBERS = {401: 75, 402: 20, 403: 85, 404: 16, 405: 95, 406: 59, 407: 285, 408: 475, 409: 24, 411: 185, 413: 675, 415: 520, 417: 575, 419: 985, 421: 516}
US_NUMBERS = [
    1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25,
    26, 27, 28, 29, 30, 31, 32, 33, 35, 38, 39, 41, 42, 43, 44, 45, 46, 47, 49, 50, 52, 53, 54, 56, 58,
    60, 61, 67, 70, 73, 76, 77, 78, 80, 82, 85, 87, 89, 97, 98, 105, 107, 109, 112, 116, 117, 121, 127, 135, 150,
    154, 155, 171, 193, 197, 247, 253, 272, 282, 316, 334, 369, 385, 400, 401, 402, 404, 407, 410, 419, 421, 422, 515, 520, 540,
]
SUFFIX_LABELS = {
    "AL": "Alternate", "BU": "Business", "BY": "Bypass", "CO": "Connector", "EA": "East", "EC": "East Connector", "LO": "Loop", "NO": "North",
    "SB": "South Business", "SE": "Spur East", "SO": "South", "SP": "Spur", "WE": "West", "XE": "Express Lane East of Atlanta", "XL": "Express Lane",
    "XN": "Express Lane North of Atlanta", "XS": "Express Lane South of Atlanta", "XW": "Express Lane West of Atlanta",
}
FUNCTION_TYPES = {
    "2": "Ramp", "3": "Collector Distributor", "4": "Ramp-CD Connector", "5": "Frontage Road", "6": "Alley", "7": "Separate Managed Facility",
    "8": "Y-Connector", "9": "Private", "R": "Roundabout",
}
FAMILIES = ["Interstate", "U.S. Route", "State Route"]
SUFFIX_TYPES = {"SP": "SP", "SE": "SP", "CO": "CN", "EC": "CN", "CW": "CN", "LO": "LP", "AL": "AL", "AS": "AL", "BY": "BY"}
EXPRESS_SUFFIXES = ["XL", "XN", "XS", "XE", "XW"]
AADT_THRESHOLD = 3000


def route_family(route_id: Column) -> Column:
    """Struct base_number, suffix_label, family, detail, confidence, source of a route id."""
    x = F.upper(F.trim(F.coalesce(route_id, F.lit(""))))
    r = parse_route_id(x)
    kind, system, suffix = r["function_type"], r["system_code"], r["suffix"]
    digits = F.when((F.length(x) >= 13) & r["route_number"].rlike(r"^\d{6}$"), r["route_number"])
    base = F.when(kind.isin("2", "3", "4"), F.substring(digits, 4, 3)).otherwise(digits).cast("int")
    label = F.when(F.length(x) >= 13, F.try_element_at(mapping(SUFFIX_LABELS), suffix))
    what = F.try_element_at(mapping(FUNCTION_TYPES), kind)
    state = F.when(base.isin(*INTERSTATE_NUMBERS), "Interstate").when(base.isin(*US_NUMBERS), "U.S. Route").otherwise("State Route")
    family = F.when(system == "1", state).when(x != "", "Local/Other")
    state_detail = F.concat_ws(" ", state, F.when((kind == "7") & label.isNotNull(), label).when(what.isNotNull(), what).otherwise(label))
    typed, by_type = what.isNotNull() & (kind != "9"), F.concat(F.lit("function_type_"), kind)
    local = (
        F.when((system == "3") & typed, F.struct(F.concat(F.lit("Private Road "), what).alias("d"), by_type.alias("s")))
        .when(system == "3", F.struct(F.lit("Private Road").alias("d"), F.lit("system_code_3_private").alias("s")))
        .when((system == "4") & typed, F.struct(F.concat(F.lit("Federal Route "), what).alias("d"), by_type.alias("s")))
        .when(system == "4", F.struct(F.lit("Federal Route").alias("d"), F.lit("system_code_4_federal").alias("s")))
        .when(kind == "9", F.struct(F.lit("Private Road").alias("d"), by_type.alias("s")))
        .when(what.isNotNull(), F.struct(F.concat(F.lit("Public Road "), what).alias("d"), by_type.alias("s")))
        .when(suffix == "00", F.struct(F.lit("County Road").alias("d"), F.lit("public_road_suffix_00").alias("s")))
        .when(suffix.rlike(r"^\d\d$"), F.struct(F.lit("City Street").alias("d"), F.lit("public_road_numeric_suffix").alias("s")))
        .otherwise(F.struct(F.lit("Public Road").alias("d"), F.lit("public_road_fallback").alias("s")))
    )
    known = system.isin("2", "3", "4")
    source = F.when(state == "Interstate", "gdot_appendix_f_interstate").when(state == "U.S. Route", "gdot_appendix_g_us_route").otherwise("system_code_1_state_route_fallback")
    return F.struct(
        base.alias("base_number"),
        label.alias("suffix_label"),
        family.alias("family"),
        F.when(system == "1", state_detail).when(known, local["d"]).when(x != "", "Other").alias("detail"),
        F.when(system == "1", F.when(state == "Interstate", "high").otherwise("medium")).when(known, "high").when(x != "", "low").alias("confidence"),
        F.when(system == "1", source).when(known, local["s"]).when(x != "", "route_id_unparsed").alias("source"),
    )


def signed_family_slots(families: Column) -> Column:
    """Struct of the families in order of rank, the first three of them, and a flag for each."""
    ranked = F.filter(F.array(*map(F.lit, FAMILIES)), lambda f: F.array_contains(F.coalesce(families, F.array().cast("array<string>")), f))
    flags = [F.array_contains(ranked, f).alias(n) for f, n in zip(FAMILIES, ("interstate", "us_route", "state_route"), strict=True)]
    return F.struct(ranked.alias("families"), *[F.get(ranked, i).alias(n) for i, n in enumerate(("first", "second", "third"))], *flags)


def hpms_family(signing: Column) -> Column:
    """Family of a signing code: 2 and 5, 3, 4, then local families."""
    n = as_int(signing)
    return (
        F.when(n.isin(2, 5), "Interstate").when(n == 3, "U.S. Route").when(n == 4, "State Route").when(n.isin(6, 7), "County Road").when(n == 8, "City Street").when(n.isin(9, 10), "Local/Other")
    )


def family_rank(family: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, FAMILIES)), family)


def merge_hpms_family(current: Column, families: Column, signing: Column) -> Column:
    """Families in order once a signing code is taken in: its family leads unless the current primary outranks it."""
    told = hpms_family(signing)
    told = F.when(told.isin(*FAMILIES), told)
    known = F.filter(F.array_distinct(F.concat(F.coalesce(families, F.array().cast("array<string>")), F.array(current))), lambda f: f.isin(*FAMILIES))
    ranked = F.filter(F.array(*map(F.lit, FAMILIES)), lambda f: F.array_contains(known, f) & (f != told))
    above = F.coalesce(family_rank(current), F.lit(0))
    outranked = (above > 0) & (above < family_rank(told))
    rest = F.filter(ranked, lambda f: f != current)
    return F.when(told.isNull(), F.filter(F.array(*map(F.lit, FAMILIES)), lambda f: F.array_contains(known, f))).when(outranked, F.concat(F.array(current), rest, F.array(told))).otherwise(F.concat(F.array(told), ranked))


def promote_family(current: Column, reference: Column) -> Column:
    """Struct family and note: the reference family if it ranks higher, confirmed if equal, never lower."""
    now, new = family_rank(current), family_rank(reference)
    higher = (new > 0) & (F.coalesce(now, F.lit(0)) == 0) | (new > 0) & (new < now)
    return F.struct(
        F.when(higher, reference).otherwise(current).alias("family"),
        F.when(higher, F.concat(F.lit("promoted to "), reference)).when(new == now, F.concat(F.lit("confirmed "), reference)).alias("note"),
    )


def signed_family(route_family: Column, primary: Column, verify_source: Column, signing: Column) -> Column:
    """Signed family for the route type: the verified primary, else the signing code's, else the primary, else the route family."""
    source = F.lower(F.coalesce(F.trim(verify_source), F.lit("")))
    own, told = F.when(primary.isin(*FAMILIES), primary), hpms_family(signing)
    told = F.when(told.isin(*FAMILIES), told)
    first = F.when(source.startswith("gdot_"), own).when(source.isin("hpms_2024", "route_id_crosswalk"), told)
    return F.coalesce(first, own, F.when(route_family.isin(*FAMILIES), route_family))


def local_family(system: Column, function: Column, suffix: Column, signing: Column) -> Column:
    s, f, told, x = as_int(system), as_int(function), hpms_family(signing), F.coalesce(suffix, F.lit(""))
    public = (s == 2) & (f == 1)
    return (
        F.when((s == 3) | (f == 9), "Private Road")
        .when(s == 4, "Federal Route")
        .when(told.isin("County Road", "City Street"), told)
        .when(public & (x == "00"), "County Road")
        .when(public & x.rlike(r"^\d\d$"), "City Street")
    )


# Short types by function, family and local family.
SHORT_FUNCTION_TYPES = {2: "RP", 3: "CD", 4: "RC", 5: "FR", 6: "ALY"}
FAMILY_TYPES = {"Interstate": "I", "U.S. Route": "US", "State Route": "SR"}
LOCAL_TYPES = {"County Road": "CR", "City Street": "CS", "Private Road": "PR", "Federal Route": "FED"}


def route_type(function: Column, suffix: Column, signed: Column, local: Column) -> Column:
    """Short route type of the function type, suffix and families."""
    f, x = as_int(function), F.coalesce(suffix, F.lit(""))
    by_function = F.try_element_at(mapping(SHORT_FUNCTION_TYPES), f.cast("int"))
    business = F.when(signed == "Interstate", "BI").when(signed == "U.S. Route", "BU").otherwise("BS")
    by_family = F.coalesce(F.try_element_at(mapping(FAMILY_TYPES), signed), F.try_element_at(mapping(LOCAL_TYPES), local))
    express = F.coalesce(f == 7, F.lit(False)) | x.isin(*EXPRESS_SUFFIXES)
    return F.coalesce(by_function, F.when(express, "ML"), F.when(f == 8, "YC"), F.when(x.isin("BU", "SB"), business), F.try_element_at(mapping(SUFFIX_TYPES), x), by_family, F.lit("OT"))


def display_prefix(kind: Column, signed: Column, local: Column) -> Column:
    signed, local = F.coalesce(signed, F.lit("")), F.coalesce(local, F.lit(""))
    return (
        F.when(kind.isin("I", "BI") | (signed == "Interstate"), "I")
        .when(kind.isin("US", "BU") | (signed == "U.S. Route"), "US")
        .when(kind.isin("SR", "BS") | (signed == "State Route"), "SR")
        .when((kind == "CR") | (local == "County Road"), "CR")
        .when((kind == "CS") | (local == "City Street"), "CS")
    )


def with_highway_names(segments: DataFrame) -> DataFrame:
    """ROUTE_TYPE_GDOT and HWY_NAME.

    A route's number is the most frequent candidate within (id without its last three
    characters, prefix), the smallest of equals; one aggregate and a null-safe join.
    """
    c = F.col
    suffix = F.upper(F.trim("ROUTE_SUFFIX"))
    signed = signed_family(c("ROUTE_FAMILY"), c("SIGNED_ROUTE_FAMILY_PRIMARY"), c("SIGNED_ROUTE_VERIFY_SOURCE"), c("HPMS_ROUTE_SIGNING"))
    local = local_family(c("SYSTEM_CODE"), c("FUNCTION_TYPE"), suffix, c("HPMS_ROUTE_SIGNING"))
    kind = route_type(c("FUNCTION_TYPE"), suffix, c("_signed"), c("_local"))
    told = segments.withColumns({"_signed": signed, "_local": local}).withColumn("ROUTE_TYPE_GDOT", kind)
    told = told.withColumns(
        {
            "_prefix": display_prefix(c("ROUTE_TYPE_GDOT"), c("_signed"), c("_local")),
            "_stem": F.expr("substring(coalesce(ROUTE_ID, ''), 1, greatest(length(ROUTE_ID) - 3, 0))"),
            "_number": F.coalesce(as_int(c("HPMS_ROUTE_NUMBER")).cast("int"), route_number_of_name(c("HPMS_ROUTE_NAME"))),
        }
    )
    votes = told.where("_number is not null").groupBy("_stem", "_prefix", "_number").count()
    best = votes.groupBy("_stem", "_prefix").agg(F.min_by("_number", F.struct(-c("count"), "_number")).alias("_best"))
    told = told.alias("t").join(best.alias("b"), c("t._stem").eqNullSafe(c("b._stem")) & c("t._prefix").eqNullSafe(c("b._prefix")), "left").select("t.*", "b._best")
    base = as_int(c("BASE_ROUTE_NUMBER")).cast("int")
    prefix = c("_prefix")
    fallback = F.when(prefix == "I", F.try_element_at(mapping(INTERSTATE_NUMBERS), base)).when(prefix.isin("US", "SR", "CR", "CS"), base)
    name = F.concat_ws("-", prefix, F.coalesce("_best", "_number", fallback).cast("string"))
    numbered = prefix.isNotNull() & F.coalesce("_best", "_number", fallback).isNotNull()
    fixed = {"RP": "RAMP", "CD": "COLLECTOR-DISTRIBUTOR", "RC": "RAMP CONNECTOR", "FR": "FRONTAGE RD", "ALY": "ALLEY", "YC": "Y-CONNECTOR", "PR": "PRIVATE ROAD", "FED": "FEDERAL ROUTE"}
    ends = {"BI": "BUS", "BU": "BUS", "BS": "BUS", "SP": "SPUR", "CN": "CONN", "LP": "LOOP", "AL": "ALT", "BY": "BYP", "ML": "EXPRESS"}
    kind = c("ROUTE_TYPE_GDOT")
    highway = F.coalesce(F.try_element_at(mapping(fixed), kind), F.when(numbered, F.concat_ws(" ", name, F.try_element_at(mapping(ends), kind))), F.when(kind == "ML", "EXPRESS LANE"), F.lit("OTHER ROUTE"))
    return told.withColumn("HWY_NAME", highway).drop("_signed", "_local", "_prefix", "_stem", "_number", "_best")


def source_agreement(state: Column, hpms: Column) -> Column:
    """Whether two counts agree: within 200 vehicles or 15 percent of the state's."""
    gap = F.abs(hpms - state)
    agree = F.coalesce((gap <= 200) | (F.try_divide(gap, F.abs(state)) <= 0.15), F.lit(False))
    return F.when(state.isNull() & hpms.isNull(), "missing").when(hpms.isNull(), "state_only").when(state.isNull(), "hpms_only").when(agree, "both_agree").otherwise("both_disagree")


# Sources of values that are derived and not published.
DERIVED_SOURCES = ("direction_mirror", "analytical_gap_fill", "nearest_neighbor")


def confidence_tier(agreement: Column, source: Column, statistics: Column) -> Column:
    """missing by source; then low (derived or disagreeing); then high (Actual or agreeing); then medium, as is all else."""
    return (
        F.when(source == "missing", "missing")
        .when(F.coalesce(source.isin(*DERIVED_SOURCES), F.lit(False)) | F.coalesce(agreement == "both_disagree", F.lit(False)), "low")
        .when(F.coalesce(F.trim(statistics) == "Actual", F.lit(False)) | F.coalesce(agreement == "both_agree", F.lit(False)), "high")
        .otherwise("medium")
    )


def priority_tier(columns: list[str]) -> Column:
    """Struct tier and reasons of a segment: the first of Critical, High and Medium with a reason, else Low with its own.

    ``columns`` are those of the table; rules on others find null there.
    """

    def c(name: str) -> Column:
        return F.col(name) if name in columns else F.lit(None)

    fc, nhs, lanes = as_int(c("FUNCTIONAL_CLASS")), as_int(c("NHS_IND")), as_int(c("THROUGH_LANES"))
    stra, nhfn = as_int(c("STRAHNET")), as_int(c("NHFN"))
    aadt = F.coalesce(*[c(n).cast("double") for n in ("AADT_2024", "AADT_2024_OFFICIAL", "AADT_2024_HPMS", "AADT")])
    busy = F.coalesce(aadt > AADT_THRESHOLD, F.lit(False))
    on_nhs = F.coalesce(nhs >= 1, F.lit(False))
    us = is_true(c("SIGNED_US_ROUTE_FLAG")) | F.coalesce(F.trim(c("ROUTE_TYPE_GDOT").cast("string")) == "US", F.lit(False))
    evacuation = is_true(c("SEC_EVAC"))

    def reasons(*pairs: tuple[Column, str]) -> Column:
        return F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in pairs]))

    # fixed values: the texts of the reasons
    critical = reasons(
        (F.coalesce(fc == 1, F.lit(False)) | is_true(c("SIGNED_INTERSTATE_FLAG")), "Interstate"),
        (nhfn != 0, "National freight corridor (NHFN)"),
        (stra.isin(1, 2), "State freight corridor (STRAHNET)"),
        (nhs.between(2, 9), "Intermodal connector (NHS)"),
    )
    high = reasons(
        (stra.isin(1, 2), "STRAHNET"),
        (on_nhs & busy, "NHS principal arterial (AADT > 3,000)"),
        (us, "US route"),
        (is_true(c("IS_GRIP_CORRIDOR")), "GRIP corridor"),
        (is_true(c("IS_NUCLEAR_EPZ_ROUTE")), "Nuclear plant EPZ route"),
        (evacuation, "GEMA evacuation route"),
        (is_true(c("IS_SOLE_COUNTY_SEAT_CONNECTION")), "Sole county-seat connection"),
        (busy & ~on_nhs, "AADT > 3,000 (non-NHS)"),
    )
    medium = reasons(
        (evacuation | is_true(c("SEC_EVAC_CONTRAFLOW")), "Hurricane evacuation route"),
        (on_nhs & ~busy, "NHS with AADT <= 3,000"),
        (us & (lanes >= 4), "US highway with 4+ lanes"),
    )
    low = reasons(
        (aadt < AADT_THRESHOLD, "AADT < 3,000"),
        (c("SPEED_LIMIT").cast("double") < 35, "Speed limit < 35 mph"),
        (c("segment_length_mi").cast("double") < 5, "Segment < 5 mi"),
    )
    tier = F.lit("Low")
    why = F.when(F.size(low) > 0, F.array_join(low, " | ")).otherwise("Default (no higher criteria met)")
    for found, name in ((medium, "Medium"), (high, "High"), (critical, "Critical")):
        tier = F.when(F.size(found) > 0, name).otherwise(tier)
        why = F.when(F.size(found) > 0, F.array_join(found, " | ")).otherwise(why)
    return F.struct(tier.alias("tier"), why.alias("reasons"))


def corridor_flag(segments: DataFrame, corridors: DataFrame) -> DataFrame:
    """IS_GRIP_CORRIDOR and GRIP_NAMES by (route type, base number) in ``corridors`` (route_type, base_number, name).

    A state route of the list stands for its spurs, business routes and the like as well.
    These count only where the family (signed, if there is such a column) is State Route or
    unknown.
    """
    suffixes = ("SP", "BU", "CN", "BY", "LP", "AL")
    wide = F.when(F.col("route_type") == "SR", F.array(F.lit("SR"), *map(F.lit, suffixes))).otherwise(F.array("route_type"))
    names = corridors.select(F.explode(wide).alias("route_type"), "base_number", "name").groupBy("route_type", "base_number").agg(F.array_join(F.array_sort(F.collect_set("name")), "; ").alias("GRIP_NAMES"))
    kind = F.upper(F.trim("ROUTE_TYPE_GDOT"))
    family = F.trim("SIGNED_ROUTE_FAMILY_PRIMARY" if "SIGNED_ROUTE_FAMILY_PRIMARY" in segments.columns else "ROUTE_FAMILY")
    able = ~F.coalesce(kind.isin(*suffixes), F.lit(False)) | F.coalesce(family == "State Route", F.lit(True))
    on = able & (kind == F.col("route_type")) & (as_int(F.col("BASE_ROUTE_NUMBER")) == F.col("base_number"))
    return segments.join(names, on, "left").drop("route_type", "base_number").withColumn("IS_GRIP_CORRIDOR", F.col("GRIP_NAMES").isNotNull())


def repeated_value_flag(df: DataFrame, value: str, least: int, flag: str, classes: tuple[int, ...] | None = None, fc: str = "FUNCTIONAL_CLASS") -> DataFrame:
    """1 where a value occurs ``least`` times or more within its functional class (of ``classes``, if given), else 0; null without a value.

    With least 500 and classes (6, 7) the flag of synthetic defaults, with 101 that of hard
    outliers. Values are counted with partial sums and joined back, so a value that a third
    of all rows have doesn't meet in one task: the frequent (class, value) pairs are few
    (rows / ``least`` at most), and adaptive execution broadcasts or splits that join.
    """
    many = df.where(F.col(value).isNotNull()).groupBy(F.col(fc).alias("_fc"), F.col(value).alias("_value")).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    told = df.join(many.drop("_n").withColumn("_many", F.lit(True)), F.col(fc).eqNullSafe(F.col("_fc")) & (F.col(value) == F.col("_value")), "left")
    inside = F.coalesce(F.col(fc).isin(*classes), F.lit(False)) if classes else F.lit(True)
    new = F.when(F.col(value).isNotNull(), (F.coalesce("_many", F.lit(False)) & inside).cast("int"))
    return told.withColumn(flag, new).drop("_fc", "_value", "_many")


def hard_outlier_flag(df: DataFrame, year: int) -> DataFrame:
    """Values that occur more than 100 times within their functional class; the years 2022 and 2023 only."""
    if year not in (2022, 2023):
        raise ValueError(f"hard outliers are defined for 2022 and 2023, not {year}")
    return repeated_value_flag(df, f"AADT_{year}_HPMS", 101, f"AADT_{year}_OUTLIER")


def resolver_confidence(margin: Column) -> Column:
    return F.when(margin > 0.10, "high").when(margin > 0.05, "medium").otherwise("low")


def _any_designation(designations: Column, test) -> Column:
    return F.coalesce(F.exists(designations, lambda s: F.coalesce(test(s), F.lit(False))), F.lit(False))


def evacuation_prefilter(designations: Column, columns: list[str]) -> Column:
    """Whether a segment may match a corridor of these designations: county roads and city streets only if they are named themselves."""
    if "ROUTE_TYPE_GDOT" not in columns:
        return F.lit(True)
    kind = F.col("ROUTE_TYPE_GDOT")
    local = F.coalesce(kind.isin("CR", "CS"), F.lit(False))
    if "BASE_ROUTE_NUMBER" not in columns:
        return ~local
    named = _any_designation(designations, lambda s: s["type"].isin("CR", "CS") & (kind == s["type"]) & (F.col("BASE_ROUTE_NUMBER") == s["number"]))
    return ~local | named


def designation_match(designations: Column, columns: list[str]) -> Column:
    """Whether a segment is one of the designated routes: interstates by highway name, others by type (or that of the suffix) and number."""
    short = mapping({"Spur": "SP", "Business": "BU", "Connector": "CN", "Bypass": "BY", "Loop": "LP", "Alternate": "AL"})
    found = F.lit(False)
    if "HWY_NAME" in columns:
        name = F.col("HWY_NAME")
        found = found | _any_designation(
            designations,
            lambda s: (s["type"] == "I") & F.startswith(name, F.concat(F.lit("I-"), s["number"].cast("string"))) & (s["suffix"].isNull() | F.contains(F.upper(name), F.upper(s["suffix"]))),
        )
    if "ROUTE_TYPE_GDOT" in columns and "BASE_ROUTE_NUMBER" in columns:
        kind = F.col("ROUTE_TYPE_GDOT")
        found = found | _any_designation(
            designations, lambda s: (s["type"] != "I") & ((kind == s["type"]) | F.coalesce(kind == F.try_element_at(short, s["suffix"]), F.lit(False))) & (F.col("BASE_ROUTE_NUMBER") == s["number"])
        )
    return found
