"""Sources and sinks: interval tables, feature files, station years, segment tables, code snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.scalars import clean_text, null_bad_coordinates, parse_functional_class, parse_lat_long, recode_statistics_type, round_milepoint, without_decimal
from waymark.lineage import checkpointed
from waymark.operators.spatial import polygons_meeting

STATION_COLUMNS = {
    "year": "int", "tc_number": "string", "latitude": "double", "longitude": "double", "aadt": "bigint", "statistics_type": "string", "single_unit_aadt": "bigint", "combo_unit_aadt": "bigint",
    "k_factor": "double", "d_factor": "double", "functional_class": "int", "station_type": "string", "traffic_class": "string", "future_aadt": "bigint", "source": "string",
}

#: Column names tried in order for each station column, by layout of the yearly files.
_COMMON = {
    "tc_number": ["Station ID"], "aadt": ["AADT", "aadt"], "statistics_type": ["Statistics type", "Statistics Type"], "single_unit_aadt": ["Single-Unit Truck AADT", "Single Unit AADT"],
    "combo_unit_aadt": ["Combo-Unit Truck AADT", "Combo Unit AADT"], "k_factor": ["K-Factor", "k30"], "d_factor": ["D-Factor", "d30"], "functional_class": ["Functional Class"],
    "station_type": ["Station Type"], "traffic_class": ["Traffic Class"], "future_aadt": ["Future AADT"], "latitude": ["Lat/Long", "Lat", "Latitude"], "longitude": ["Long", "Longitude"],
}
STATION_LAYOUTS: dict[str, dict[str, list[str]]] = {
    "2015": _COMMON | {"latitude": ["Coordinate"]},
    "2016": {"tc_number": ["TC_NUMBER"], "aadt": ["AADT"], "single_unit_aadt": ["AADT_SINGL"], "combo_unit_aadt": ["AADT_COMBI"], "k_factor": ["K_FACTOR"], "d_factor": ["D_Factor"], "future_aadt": ["FUTURE_AAD"], "latitude": ["Lat"], "longitude": ["Long"]},
    "2017": _COMMON, "2018": _COMMON, "2019_2021": _COMMON, "2022_2023": _COMMON | {"latitude": ["Latitude", "Lat"], "longitude": ["Longitude", "Long"]},
}


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or CSV with a header, by the path's ending."""
    return spark.read.option("header", True).csv(path) if path.endswith((".csv", ".csv.gz")) else spark.read.parquet(path)


def read_interval_table(spark: SparkSession, path: str, key: str, begin: str, end: str, rename: dict[str, str] | None = None, numeric: Iterable[str] = ()) -> DataFrame:
    """Trimmed names, numbers cast (what isn't one is null), milepoints of four decimals, rows with end beyond begin only."""
    df = read_any(spark, path)
    df = df.toDF(*[c.strip() for c in df.columns])
    df = df.withColumnsRenamed(rename or {})
    cast = {c: F.col(c).cast("string").try_cast("double") for c in {*numeric, begin, end}}
    df = df.withColumns(cast).withColumns({key: F.trim(F.col(key).cast("string")), "from_mp": round_milepoint(F.col(begin)), "to_mp": round_milepoint(F.col(end))})
    return df.where(F.col("to_mp") > F.col("from_mp"))


def read_feature_json(spark: SparkSession, path: str, rename: dict[str, str] | None = None) -> DataFrame:
    """Rows of ``features[].attributes``."""
    df = spark.read.option("multiLine", True).json(path)
    return df.select(F.explode("features").alias("f")).select("f.attributes.*").withColumnsRenamed(rename or {})


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Properties with lower-case underscored names, ``geometry_type``, and ``parts``: arrays of (x, y), one for a point or line, the rings of polygons.

    A file of one geometry type has arrays of equal depth; they are read as text and taken
    apart by that type.
    """
    df = spark.read.option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    flat = df.select("f.properties.*", F.col("f.geometry.type").alias("geometry_type"), F.to_json(F.struct(F.col("f.geometry.coordinates").alias("c"))).alias("_c"))
    names = [c.strip().lower().replace(" ", "_") for c in flat.columns[:-1]]

    def points(x: Column) -> Column:
        return F.transform(x, lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))

    def at_depth(n: int) -> Column:
        return F.from_json(F.get_json_object("_c", "$.c"), "array<" * n + "double" + ">" * n)

    kind = F.col("geometry_type")
    parts = (
        F.when(kind == "Point", F.array(points(F.array(at_depth(1)))))
        .when(kind.isin("LineString", "MultiPoint"), F.array(points(at_depth(2))))
        .when(kind.isin("Polygon", "MultiLineString"), F.transform(at_depth(3), points))
        .when(kind == "MultiPolygon", F.transform(F.flatten(at_depth(4)), points))
    )
    return flat.toDF(*names, "_c").withColumn("parts", parts).drop("_c")


def load_station_year(df: DataFrame, year: int, layout: str, source: str) -> DataFrame:
    """A yearly station table in the common 15 columns; a required column without any known name is an error that lists them."""
    if layout not in STATION_LAYOUTS:
        raise ValueError(f"unknown station layout {layout!r}; known: {sorted(STATION_LAYOUTS)}")
    named = {c.strip(): c for c in df.columns}

    def find(column: str) -> Column | None:
        return next((F.col(f"`{named[n]}`") for n in STATION_LAYOUTS[layout].get(column, []) if n in named), None)

    for column in ("tc_number", "aadt", "latitude"):
        if find(column) is None:
            raise ValueError(f"{year}: no column for {column}; tried {STATION_LAYOUTS[layout].get(column, [])}")
    lat, lon = find("latitude"), find("longitude")
    if lon is None:
        both = parse_lat_long(lat)
    else:
        both = F.struct(lat.cast("string").try_cast("double").alias("lat"), lon.cast("string").try_cast("double").alias("lon"))
    place = null_bad_coordinates(both["lat"], both["lon"])
    made = {"year": F.lit(year), "tc_number": without_decimal(find("tc_number")), "latitude": place["lat"], "longitude": place["lon"], "source": F.lit(source)}
    for column, kind in STATION_COLUMNS.items():
        if column in made:
            continue
        x = find(column)
        if x is None:
            x = F.lit(None)
        elif column == "functional_class":
            x = parse_functional_class(x)
        elif column == "statistics_type":
            x = recode_statistics_type(x)
        elif kind in ("bigint", "double"):
            x = F.regexp_replace(x.cast("string"), ",", "").try_cast("double")
        else:
            x = clean_text(x.cast("string"))
        made[column] = x
    return df.select(*[made[c].cast(kind).alias(c) for c, kind in STATION_COLUMNS.items()]).where("tc_number is not null")


def union_station_years(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no station years")
    return reduce(DataFrame.unionByName, [f.select(*STATION_COLUMNS) for f in frames])


def join_static_attributes(routes: DataFrame, layers: dict[str, DataFrame], keys: tuple[str, ...] = ("ROUTE_ID", "BeginPoint", "EndPoint")) -> DataFrame:
    """Exact left joins of one-row-per-key layers, whose other columns are taken; of repeated keys the least row counts."""
    for layer in layers.values():
        rest = [c for c in layer.columns if c not in keys]
        one = layer.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_l")).select(*keys, "_l.*")
        routes = routes.join(one, list(keys), "left")
    return routes


def attribute_coverage(joined: DataFrame, layers: dict[str, list[str]]) -> DataFrame:
    """(layer, matched, rows): rows that have any of a layer's columns, in one pass."""
    any_of = {name: F.coalesce(*[F.col(c).cast("string") for c in columns]) for name, columns in layers.items()}
    wide = joined.agg(F.count("*").alias("rows"), *[F.count(x).alias(f"_{name}") for name, x in any_of.items()])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(n).alias("layer"), F.col(f"_{n}").alias("matched"), F.col("rows")) for n in layers])))


def station_year_counts(stations: DataFrame) -> DataFrame:
    return stations.groupBy("year").agg(F.count("*").alias("rows"))


def load_roadway_inventory(segments: DataFrame, district: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """State-system or evacuation segments, of one district if given; the predicate reaches the scan."""
    wanted = (F.col("SYSTEM_CODE") == "1") | F.coalesce(F.col("SEC_EVAC"), F.lit(False))
    wanted = wanted if district is None else wanted & (F.col("DISTRICT") == district)
    return segments.where(wanted).select(*(keep or segments.columns))


def load_all(segments: DataFrame, categories: dict[str, Callable[[DataFrame], DataFrame]], district: int | None = None, keep: list[str] | None = None) -> dict[str, DataFrame]:
    """The roadway inventory (``roadways``), of one district if given, and each category's metrics of it by name.

    The inventory is written to the checkpoint folder once, as all categories read it.
    """
    roadways = checkpointed(load_roadway_inventory(segments, district, keep))
    return {"roadways": roadways} | {name: metrics(roadways) for name, metrics in categories.items()}


def write_segments(segments: DataFrame, path: str, geometry: str = "geometry", partition: str = "DISTRICT") -> None:
    """Two tables below ``path``: attributes without, and all with geometry; columns that begin with ``_`` are internal."""
    public = segments.drop(*[c for c in segments.columns if c.startswith("_")])
    public.drop(geometry).write.mode("overwrite").partitionBy(partition).parquet(f"{path}/attributes")
    public.write.mode("overwrite").partitionBy(partition).parquet(f"{path}/features")


def write_feature_json(rows: DataFrame, path: str) -> None:
    """One JSON file of ``features[].attributes``. A feature file is one value, so this is for layers, not for tables of any size."""
    whole = rows.agg(F.to_json(F.struct(F.collect_list(F.struct(F.struct(*rows.columns).alias("attributes"))).alias("features")), {"ignoreNullFields": "false"}).alias("value"))
    whole.write.mode("overwrite").text(path)


def write_geojson(rows: DataFrame, kind: str, parts: str, path: str) -> None:
    """One GeoJSON file of a layer whose ``parts`` are arrays of (x, y): one for a Point or LineString, the rings of a Polygon."""

    def pairs(p: Column) -> Column:
        return F.transform(p, lambda v: F.array(v["x"], v["y"]))

    coordinates = {"Point": F.get(pairs(F.get(F.col(parts), 0)), 0), "LineString": pairs(F.get(F.col(parts), 0)), "Polygon": F.transform(parts, pairs)}[kind]
    properties = F.struct(*[c for c in rows.columns if c != parts])
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"))
    whole = rows.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features")), {"ignoreNullFields": "false"}).alias("value"))
    whole.write.mode("overwrite").text(path)


def code_snapshot(layer: DataFrame, id_: str, name: str) -> DataFrame:
    """Distinct trimmed, non-empty id and name, sorted."""
    return layer.select(clean_text(F.col(id_).cast("string")).alias("id"), clean_text(F.col(name).cast("string")).alias("name")).where("id is not null and name is not null").distinct().orderBy("id", "name")


# Columns tried for ids and labels of legislative layers.
LABEL_CANDIDATES = ("NAMELSAD20", "NAMELSAD", "NAME20", "NAME")


def normalize_boundary_layer(layer: DataFrame, id_candidates: tuple[str, ...], id_: str, name: str | None = None, name_candidates: tuple[str, ...] = LABEL_CANDIDATES, pad: int | None = None, names: dict[int, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A boundary layer with a plain id and a trimmed name; rows without an id go.

    The id is the first candidate the layer has (none is an error that lists them): a
    whole number, or with ``pad`` a text with zeros in front. Names of ``names`` win over
    the layer's own.
    """
    found = next((c for c in id_candidates if c in layer.columns), None)
    if found is None:
        raise ValueError(f"none of {id_candidates} present; there are {layer.columns}")
    text = without_decimal(F.col(found))
    key = F.lpad(text, pad, "0") if pad else text.try_cast("double").try_cast("bigint")
    told = layer.withColumn("_id", key)
    own = next((F.trim(F.col(c).cast("string")) for c in name_candidates if c in layer.columns), F.lit(None).cast("string"))
    if names:
        own = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("_id").cast("int")), own)
    columns = [F.col("_id").alias(id_), *([own.alias(name)] if name else []), *[c for c in keep if c in layer.columns]]
    return told.where("_id is not null").select(*columns)


def within_state(layer: DataFrame, polygon: str, state: DataFrame, size: float) -> DataFrame:
    """Polygons of a layer that have a point in common with the state: one that covers it or crosses it without a vertex inside stays too. No clipping of rings."""
    outline = state.select(F.lit(1).alias("_state"), "rings")
    return layer.join(polygons_meeting(layer, polygon, outline, "_state", size).select(polygon).distinct(), polygon, "left_semi")


def county_projections(rows: DataFrame, counties: DataFrame, expected: int) -> DataFrame:
    """(COUNTY, COUNTY_FIPS, year, value) of a sheet whose columns c0, c1, ... hold any text, from the row that begins with COUNTY on.

    ``rows`` have their place in ``n``. Year columns are those whose header is a whole number;
    the state's own row and sources go. Names meet the counties (name, fips) by their
    letters and digits in upper case; other than ``expected`` mapped counties is an error.
    """
    columns = [c for c in rows.columns if c != "n"]
    header = rows.where(F.trim("c0") == "COUNTY").orderBy("n").limit(1).collect()
    if not header:
        raise ValueError("no row begins with COUNTY")
    years = {c: str(int(float(header[0][c]))) for c in columns[1:] if header[0][c] and header[0][c].strip().replace(".", "", 1).isdigit()}
    body = rows.where((F.col("n") > header[0]["n"]) & F.col("c0").isNotNull()).withColumn("COUNTY", F.trim("c0"))
    body = body.where((F.upper("COUNTY") != "GEORGIA") & ~F.col("COUNTY").startswith("Source:"))

    def plain(x: str) -> Column:
        return F.regexp_replace(F.upper(x), "[^A-Z0-9]", "")

    told = body.withColumn("_k", plain("COUNTY")).join(counties.select(plain("name").alias("_k"), F.col("fips").alias("COUNTY_FIPS")).distinct(), "_k", "left")
    counts = told.agg(F.count("COUNTY_FIPS").alias("rows"), F.count_distinct("COUNTY_FIPS").alias("fips"), F.collect_set(F.when(F.col("COUNTY_FIPS").isNull(), F.col("COUNTY"))).alias("missing")).first()
    if counts["rows"] != expected or counts["fips"] != expected:
        raise ValueError(f"{counts['rows']} rows and {counts['fips']} counties mapped, {expected} expected; missing: {sorted(counts['missing'])[:10]}")
    each = F.array(*[F.struct(F.lit(int(y)).alias("year"), F.col(c).try_cast("double").alias("value")) for c, y in years.items()])
    return told.select("COUNTY", "COUNTY_FIPS", F.inline(each))
