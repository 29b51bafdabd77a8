"""Parsing and scalar column expressions. All take and return columns; null in gives null out unless said."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
METRES_PER_MILE = 1609.344

# Road-type and direction words and their short forms.
ROAD_WORDS = {
    "STREET": "ST", "DRIVE": "DR", "ROAD": "RD", "AVENUE": "AVE", "BOULEVARD": "BLVD", "LANE": "LN", "COURT": "CT", "CIRCLE": "CIR",
    "PLACE": "PL", "TRAIL": "TRL", "WAY": "WAY", "PARKWAY": "PKWY", "TERRACE": "TER", "HIGHWAY": "HWY", "EXTENSION": "EXT", "CROSSING": "XING",
    "POINT": "PT", "LOOP": "LP", "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W", "NORTHEAST": "NE", "NORTHWEST": "NW",
    "SOUTHEAST": "SE", "SOUTHWEST": "SW",
}


def mapping(values: dict) -> Column:
    """A literal map."""
    return F.create_map(*map(F.lit, chain(*values.items())))


def clean_text(x: Column) -> Column:
    """Trimmed; blank becomes null."""
    return F.nullif(F.trim(x), F.lit(""))


def as_int(x: Column) -> Column:
    """Whole part of a number or of a numeric text; null if it is neither."""
    return x.cast("string").try_cast("double").try_cast("bigint")


def is_true(x: Column) -> Column:
    """True for true, 1 and their texts; false for null and all else."""
    return F.coalesce(F.lower(x.cast("string")).isin("true", "1", "1.0"), F.lit(False))


def parse_route_id(x: Column) -> Column:
    """Struct of the six fixed-width fields of a route id; null gives empty texts."""
    x = F.coalesce(x, F.lit(""))
    cuts = {"function_type": (1, 1), "county": (2, 3), "system_code": (5, 1), "route_number": (6, 6), "suffix": (12, 2), "direction": (14, 100)}
    return F.struct(*[F.substring(x, a, n).alias(k) for k, (a, n) in cuts.items()])


def round_even(x: Column | str, digits: int) -> Column:
    """A double to some decimals, half to even as binary arithmetic sees it (``bround`` goes by the shortest decimal text)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.rint(x * 10.0**digits) / 10.0**digits + 0.0


def round_milepoint(x: Column) -> Column:
    """Four decimals, half to even; smaller than 1e-4 is zero."""
    r = round_even(x, 4)
    return F.when(F.abs(r) < 1e-4, F.lit(0.0)).otherwise(r)


def unique_id(route: Column, begin: Column, end: Column) -> Column:
    """``route_begin_end`` with four decimals, NA for null milepoints."""
    return F.concat_ws("_", F.coalesce(route, F.lit("")), *[F.when(m.isNull(), "NA").otherwise(F.format_string("%.4f", m)) for m in (begin, end)])


def unique_id_guard(segments: DataFrame, key: str = "unique_id", parts: tuple[str, ...] = ("DISTRICT", "COUNTY_CODE", "AREA_OFFICE_ID", "MPO_ID", "RC_ID"), told: Observation | None = None) -> DataFrame:
    """Ids that occur more than once get ``_`` and six hex digits of the md5 of their administrative parts.

    ``told`` learns, as the result is read, how many rows were renamed and how many still
    share their new id (``marked``, ``left``): rows of one old id and one mark share their new
    id, so the same partitions tell both, without another pass.
    """
    (old, mark, same, left) = (free_name(segments, c) for c in ("_old", "_mark", "_same", "_left"))
    digits = F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts])), 1, 6)
    rows = segments.withColumns({old: F.col(key), mark: digits}).withColumn(same, F.count("*").over(Window.partitionBy(old)))
    rows = rows.withColumn(left, F.count("*").over(Window.partitionBy(old, mark)))
    many = F.col(same) > 1
    if told is not None:
        rows = rows.observe(told, F.count_if(many).alias("marked"), F.count_if(many & (F.col(left) > 1)).alias("left"))
    return rows.withColumn(key, F.when(many, F.concat_ws("_", key, mark)).otherwise(F.col(key))).select(*segments.columns)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    while name in df.columns:
        name = f"_{name}"
    return name


def decode_label(code: Column, labels: dict[str, str], pad: int = 0) -> Column:
    """Label of a code: as it is, then in upper case, then as a whole number padded with zeros."""
    table, text = mapping(labels), F.trim(code.cast("string"))
    number = as_int(code).cast("string")
    number = F.when(F.length(number) < pad, F.lpad(number, pad, "0")).otherwise(number) if pad else number
    return F.coalesce(*[F.try_element_at(table, k) for k in (text, F.upper(text), number)])


def geometry_wins_label(existing: Column, decoded: Column) -> Column:
    """Struct label and diverges: the label by geometry, else the decoded one; whether both are there and differ."""
    return F.struct(F.coalesce(existing, decoded).alias("label"), F.coalesce(existing != decoded, F.lit(False)).alias("diverges"))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 part / whole; null unless whole is positive."""
    x = F.when(whole > 0, 100.0 * part / whole)
    return x if digits is None else round_even(x, digits)


def highway_design(lanes: Column, median: Column) -> Column:
    """Lanes and D or U, such as 4D; a median of 2 or more is divided."""
    return F.when(lanes > 0, F.concat(lanes.cast("bigint").cast("string"), F.when(median >= 2, "D").otherwise("U")))


def alignment_columns(segments: DataFrame) -> DataFrame:
    """PCT_SADT, PCT_CADT, HWY_DES and TRK_DHV_PCT (single plus combination share, else the truck share)."""
    c = F.col
    return segments.withColumns(
        {
            "PCT_SADT": percent(c("SINGLE_UNIT_AADT"), c("AADT"), 1),
            "PCT_CADT": percent(c("COMBO_UNIT_AADT"), c("AADT"), 1),
            "HWY_DES": highway_design(c("THROUGH_LANES"), c("MEDIAN_TYPE")),
            "TRK_DHV_PCT": F.coalesce(c("HPMS_PCT_DH_SINGLE") + c("HPMS_PCT_DH_COMBINATION"), c("TRUCK_PCT")),
        }
    )


def parse_lat_long(x: Column) -> Column:
    """Struct lat, lon of ``"lat, lon"``; both null if either is no number or there aren't two."""
    parts = F.split(x, ",")
    lat, lon = (F.trim(F.get(parts, i)).try_cast("double") for i in (0, 1))
    ok = (F.size(parts) == 2) & lat.isNotNull() & lon.isNotNull()
    return F.struct(F.when(ok, lat).alias("lat"), F.when(ok, lon).alias("lon"))


def parse_functional_class(x: Column) -> Column:
    """Leading whole number, such as 3 of ``3U : Principal``."""
    return F.nullif(F.regexp_extract(x.cast("string"), r"^\s*(\d+)", 1), F.lit("")).cast("int")


def recode_statistics_type(x: Column) -> Column:
    x = F.trim(x)
    return F.when(x == "A", "Actual").when(x.isin("E", "Actual_Est"), "Estimated").otherwise(x)


def without_decimal(x: Column) -> Column:
    """Text of an id without a trailing ``.0``; blank is null."""
    return clean_text(F.regexp_replace(F.trim(x.cast("string")), r"\.0$", ""))


def null_bad_coordinates(lat: Column, lon: Column) -> Column:
    """Struct lat, lon; null if both lie within a degree of zero."""
    bad = (F.abs(lat) < 1) & (F.abs(lon) < 1)
    return F.struct(F.when(~F.coalesce(bad, F.lit(False)), lat).alias("lat"), F.when(~F.coalesce(bad, F.lit(False)), lon).alias("lon"))


# What is taken out of road names, in this order.
ROAD_NAME_PATTERNS = ((r"\*+", ""), (r"\n", " "), (r"SCHOOL\s*ZONE", ""), (r"\(.*?\)", ""), (r"/.*$", ""), (r"[.\-,'\"]", " "), (r"\s+", " "))


def normalize_road_name(x: Column) -> Column:
    """Upper case without school-zone notes, brackets, alternatives after a slash and punctuation, with short road words; null is empty."""
    s = F.rtrim(F.upper(F.trim(F.coalesce(x, F.lit("")))), F.lit(";"))
    for pattern, by in ROAD_NAME_PATTERNS:
        s = F.regexp_replace(s, pattern, by)
    words = F.split(F.trim(s), " ")
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(mapping(ROAD_WORDS), w), w)), " ")


def rclink_candidates(route_id: Column, function_type: Column | None = None, system_code: Column | None = None) -> Column:
    """One or two ten-character reference keys of a route id: county, system, four digits, suffix.

    The digits are the last four of the route number, or the last three with a zero before
    them for function types 2 to 4. On the state system a second key has county 000.
    Ids of fewer than 13 characters and ids without digits have none.
    """
    x = F.upper(F.trim(F.coalesce(route_id, F.lit(""))))
    r = parse_route_id(x)
    kind = F.coalesce(clean_text(function_type) if function_type is not None else F.lit(None), r["function_type"])
    system = F.coalesce(clean_text(system_code) if system_code is not None else F.lit(None), r["system_code"])
    digits = F.regexp_replace(r["route_number"], "[^0-9]", "")
    number = F.lpad(F.when(kind.isin("2", "3", "4"), F.right(digits, F.lit(3))).otherwise(F.right(digits, F.lit(4))), 4, "0")
    rest = F.upper(F.concat(system, number, r["suffix"]))
    keys = F.array_compact(F.array(F.concat(r["county"], rest), F.when((system == "1") & (r["county"] != "000"), F.concat(F.lit("000"), rest))))
    return F.when((F.length(x) >= 13) & (digits != ""), F.array_distinct(keys)).otherwise(F.array().cast("array<string>"))


# Patterns of route designations, the first that matches counts.
NUMBER_PATTERNS = (
    r"(?i)(?:^|\b)I[- ]?(\d{1,4})(?:\b|;)",
    r"(?i)(?:^|\b)INTERSTATE\s+(\d{1,4})(?:\b|;)",
    r"(?i)(?:^|\b)US(?:\s+HIGHWAY)?\s*(\d{1,4})(?:\b|;)",
    r"(?i)(?:^|\b)(\d{1,4})(?:AL|BU|BY|CO|SP|LO|WE|EA|SO|NO|SE|SB|AS|CW|EC)(?:\b|;)",
    r"(?i)(?:^|\b)SR[- ]?(\d{1,4})(?:\b|;)",
    r"(?i)(?:^|\b)STATE\s+ROUTE\s+(\d{1,4})(?:\b|;)",
)


def route_number_of_name(x: Column) -> Column:
    """Number of the first designation pattern that a name matches."""
    return F.coalesce(*[F.nullif(F.regexp_extract(x, p, 1), F.lit("")) for p in NUMBER_PATTERNS]).cast("int")


# A designation, and the short forms of its suffixes; directions are no suffix.
DESIGNATION = r"(?i)(I|Interstate|US|SR|CR)\s*-?\s*(\d+)(?:\s+(North|South|East|West|Spur|Business|Connector|Bypass|Loop|Alternate))?"
SUFFIX_SHORT = {"SPUR": "SPUR", "BUSINESS": "BUS", "CONNECTOR": "CONN", "BYPASS": "BYP", "LOOP": "LOOP", "ALTERNATE": "ALT"}


def _designations(x: Column) -> Column:
    """array<struct<type, digits, suffix>> of the first designation in each part of a name between slashes; suffix in upper case."""
    plain = F.trim(F.regexp_replace(x, r"\s+", " "))

    def one(part: Column) -> Column:
        part = F.trim(part)
        kind = F.upper(F.regexp_extract(part, DESIGNATION, 1))
        suffix = F.upper(F.regexp_extract(part, DESIGNATION, 3))
        return F.struct(
            F.when(kind == "INTERSTATE", "I").otherwise(kind).alias("type"), F.regexp_extract(part, DESIGNATION, 2).alias("digits"), F.when(suffix.isin(*SUFFIX_SHORT), suffix).alias("suffix")
        )

    found = F.filter(F.transform(F.split(plain, "/"), one), lambda s: s["digits"] != "")
    return F.coalesce(found, F.array().cast("array<struct<type:string,digits:string,suffix:string>>"))


def route_designations(x: Column) -> Column:
    """array<struct<type, number, suffix>> of the designations, such as ``US 27 Business/SR 1``, in a name; empty if there is none."""
    return F.transform(_designations(x), lambda s: F.struct(s["type"].alias("type"), s["digits"].try_cast("int").alias("number"), F.initcap(s["suffix"]).alias("suffix")))


def corridor_prefixes(x: Column) -> Column:
    """Names such as ``SR-1`` and ``US-27 BUS`` of the designations in a name."""
    return F.transform(_designations(x), lambda s: F.concat_ws(" ", F.concat_ws("-", s["type"], s["digits"]), F.try_element_at(mapping(SUFFIX_SHORT), s["suffix"])))


def expected_family(x: Column) -> Column:
    """Route family that a name states."""
    u = F.upper(x)
    return F.when(u.rlike(r"\b(I[- ]?\d|INTERSTATE)"), "Interstate").when(u.rlike(r"\bUS[- ]?(HIGHWAY)?\s*\d"), "U.S. Route").when(u.rlike(r"\b(SR[- ]?\d|STATE ROUTE)"), "State Route")


def city_ids(cities: DataFrame, name: str = "Name", object_id: str = "OBJECTID") -> DataFrame:
    """CITY_ID: 48 bits of the md5 of the collapsed lower-case name; null and repeated names take object id + 2^48, or fail without one."""
    plain = F.lower(F.regexp_replace(F.trim(name), r"\s+", " "))
    hashed = F.conv(F.substring(F.md5(plain), 1, 12), 16, 10).cast("bigint")
    single = plain.isNotNull() & (plain != "") & (F.count("*").over(Window.partitionBy(plain)) == 1)
    other = F.when(F.col(object_id).isNull(), F.raise_error(F.lit("a city without a unique name needs an object id")).cast("bigint")).otherwise(F.col(object_id).cast("bigint") + (1 << 48))
    return cities.withColumn("CITY_ID", F.when(F.coalesce(single, F.lit(False)), hashed).otherwise(other))


def geoid(code: Column, width: int) -> Column:
    """Digits padded with zeros to 15 (block), 12 (block group), 11 (tract) or 5 (county)."""
    return F.lpad(without_decimal(code), width, "0")


def geoid_parent(code: Column, width: int) -> Column:
    """The enclosing geography: a prefix."""
    return F.substring(code, 1, width)


def in_state(code: Column, state: str, width: int = 11) -> Column:
    """Whether a tract (or another geography of ``width`` digits) lies in a state, by the two digits it begins with."""
    return F.coalesce(F.substring(geoid(code, width), 1, 2) == state, F.lit(False))


def acs_rate(part: Column, whole: Column) -> Column:
    """part / whole; 0 where either is null or whole is 0."""
    return F.coalesce(F.when(whole != 0, part / whole), F.lit(0.0))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres on a sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def fc_bin(x: Column) -> Column:
    """Functional class in bins 1-2, 3-4, 5-6, 7, 8-9."""
    n = as_int(x)
    return F.when(n.isin(1, 2), "1-2").when(n.isin(3, 4), "3-4").when(n.isin(5, 6), "5-6").when(n == 7, "7").when(n.isin(8, 9), "8-9")


def urban_rural(code: Column) -> Column:
    """Urban code 99999 is rural; null stays null."""
    n = as_int(code)
    return F.when(n == 99999, "rural").when(n.isNotNull(), "urban")


# Names of the functional classes.
FUNCTIONAL_CLASSES = {1: "Interstate", 2: "Principal Arterial - Freeway", 3: "Principal Arterial - Other", 4: "Minor Arterial", 5: "Major Collector", 6: "Minor Collector", 7: "Local"}


def functional_class_label(x: Column) -> Column:
    n = as_int(x)
    return F.when(n.isNotNull(), F.coalesce(F.try_element_at(mapping(FUNCTIONAL_CLASSES), n.cast("int")), F.concat(F.lit("Class "), n.cast("string"))))


def road_name(name: Column, route: Column) -> Column:
    """The highway's name, else the route's id, else a plain word; blank ones don't count."""

    def said(x: Column) -> Column:
        return F.when(F.trim(x.cast("string")) != "", x.cast("string"))

    return F.coalesce(said(name), said(route), F.lit("Roadway segment"))


def highway_description(lanes: Column, median: Column, family: Column, access: Column) -> Column:
    """Lanes with D (divided) or U; null without lanes."""
    divided = F.coalesce(median.cast("int") != 1, F.lit(False)) | F.coalesce(F.trim(family) == "Interstate", F.lit(False)) | (F.coalesce(access.cast("int").isin(1, 2, 3), F.lit(False)) & (lanes >= 4))
    return F.when(lanes > 0, F.concat(lanes.cast("int").cast("string"), F.when(divided, "D").otherwise("U")))


def evacuation_label(route: Column, contraflow: Column) -> Column:
    return F.when(contraflow.cast("int") == 1, "Contraflow Route").when(route.cast("int") == 1, "Evacuation Route")


# Properties of the map's themes and the columns they are; others are derived.
THEMATIC_COLUMNS = {
    "aadt": "AADT", "system_code_label": "SYSTEM_CODE_LABEL", "direction_label": "DIRECTION_LABEL", "num_lanes": "NUM_LANES", "future_aadt_2044": "FUTURE_AADT_2044", "k_factor": "K_FACTOR", "d_factor": "D_FACTOR",
    "truck_aadt": "TRUCK_AADT", "vmt": "VMT", "nhs_ind_label": "NHS_IND_LABEL", "median_type_label": "MEDIAN_TYPE_LABEL", "speed_limit": "SPEED_LIMIT", "truck_pct": "TRUCK_PCT",
    "functional_class_viz": "FUNCTIONAL_CLASS", "surface_type_label": "SURFACE_TYPE_LABEL", "ownership_label": "OWNERSHIP_LABEL", "facility_type_label": "FACILITY_TYPE_LABEL",
}


def thematic_properties(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the properties of the map's themes, the road's name among them; a column that ``df`` lacks gives nulls."""

    def col(name: str, kind: str = "string") -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)

    def share(part: str) -> Column:
        value = col("AADT", "double")
        return F.when(value > 0, F.round(col(part, "double") * 100.0 / value, 1))

    made = {n: col(c) for n, c in THEMATIC_COLUMNS.items()}
    made |= {"pct_sadt": share("SINGLE_UNIT_AADT_2024"), "pct_cadt": share("COMBO_UNIT_AADT_2024"), "hwy_des": highway_description(col("NUM_LANES", "int"), col("MEDIAN_TYPE", "int"), col("ROUTE_FAMILY"), col("HPMS_ACCESS_CONTROL", "int"))}
    made |= {"sec_evac": evacuation_label(col("SEC_EVAC", "int"), col("SEC_EVAC_CONTRAFLOW", "int")), "road_name": road_name(col("HWY_NAME"), col("ROUTE_ID"))}
    return df.select(*keep, *[c.alias(n) for n, c in made.items()])


def move_column_after(df: DataFrame, column: str, after: str) -> DataFrame:
    names = [c for c in df.columns if c != column]
    at = names.index(after) + 1
    return df.select(*names[:at], column, *names[at:])


def sync_aliases(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Fill each alias (key) from its source column only where it is null."""
    return df.withColumns({alias: F.coalesce(F.col(alias), F.col(source)) for alias, source in pairs.items()})


def harmonize(df: DataFrame, keep: list[str], state_columns: tuple[str, ...] = (), state: str | None = None) -> DataFrame:
    """Keep the listed columns that exist; filter by the first state column that exists."""
    column = next((c for c in state_columns if c in df.columns), None)
    df = df.where(F.upper(F.trim(column)) == state.upper()) if column and state else df
    return df.select(*[c for c in keep if c in df.columns])


def union_labelled(layers: dict[str, DataFrame], label: str) -> DataFrame:
    """All layers one below the other, with their name in ``label``; columns that a layer lacks are null."""
    frames = [df.withColumn(label, F.lit(name)) for name, df in layers.items()]
    whole = frames[0]
    for df in frames[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole
