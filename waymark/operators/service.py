"""Filters, themes, summaries, pages and options of the query service."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.geometry import utm17_to_lonlat
from waymark.functions.scalars import clean_text


@dataclass(frozen=True)
class Filters:
    """Values wanted by dimension (column), counties by name, families, cities; empty means all."""

    dimensions: dict[str, tuple] = field(default_factory=dict)
    counties: tuple[str, ...] = ()
    families: tuple[str, ...] = ()
    cities: tuple = ()
    include_unincorporated: bool = False

    def predicate(self) -> Column:
        """One expression, so simple parts reach the scan."""
        terms = [F.col(c).isin(*v) for c, v in sorted(self.dimensions.items()) if v]
        if self.counties:
            terms.append(county_match(F.col("county_all"), self.counties))
        if self.families:
            terms.append(F.col("ROUTE_FAMILY").isin(*self.families))
        city = [F.col("CITY_ID").isin(*self.cities)] if self.cities else []
        city += [F.col("CITY_ID").isNull()] if self.include_unincorporated else []
        return reduce(and_, [*terms, *([reduce(or_, city)] if city else [])], F.lit(True))


def county_match(listed: Column, names: tuple[str, ...]) -> Column:
    """Whether a comma-separated list holds one of the names, in any case."""
    return F.arrays_overlap(F.split(F.lower(listed), r",\s*"), F.array(*[F.lit(n.strip().lower()) for n in names]))


# Short names of route families in requests.
FAMILY_ALIASES = {"interstate": "Interstate", "us": "U.S. Route", "us_route": "U.S. Route", "state": "State Route", "state_route": "State Route", "local": "Local/Other", "local_other": "Local/Other"}


def resolve_filters(raw: dict[str, list], known_counties: dict[str, str] | None = None) -> Filters:
    """Filters of a request: aliases of families, county codes or names, ids without a trailing ``.0``, all sorted and unique."""
    known = {k.zfill(3): v for k, v in (known_counties or {}).items()}

    def plain(values: list) -> tuple:
        return tuple(sorted({str(v).strip().removesuffix(".0") for v in values if v is not None and str(v).strip()}))

    counties = {known.get(v.zfill(3), v) for v in plain(raw.get("counties", []))}
    families = {FAMILY_ALIASES.get(v.lower().replace(" ", "_"), v) for v in plain(raw.get("families", []))}
    rest = {k: plain(v) for k, v in raw.items() if k not in ("counties", "families", "cities", "include_unincorporated")}
    return Filters({k: v for k, v in rest.items() if v}, tuple(sorted(counties)), tuple(sorted(families)), plain(raw.get("cities", [])), bool(raw.get("include_unincorporated")))


def summary_by_class(segments: DataFrame, filters: Filters, by: str = "FUNCTIONAL_CLASS", miles: str = "segment_length_mi") -> DataFrame:
    """Rows and miles by class, and in total (``is_total``)."""
    return segments.where(filters.predicate()).rollup(by).agg(F.count("*").alias("rows"), F.sum(miles).alias("miles"), (F.grouping(by) == 1).alias("is_total"))


def bounds(segments: DataFrame, filters: Filters, line: str = "geometry") -> DataFrame:
    """Envelope of the lines; nulls when nothing is left."""
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return segments.where(filters.predicate()).agg(F.min(F.array_min(xs)).alias("min_x"), F.min(F.array_min(ys)).alias("min_y"), F.max(F.array_max(xs)).alias("max_x"), F.max(F.array_max(ys)).alias("max_y"))


def property_bounds(segments: DataFrame, columns: list[str]) -> DataFrame:
    """Least and largest value of each column, in one pass: property, min_value, max_value."""
    wide = segments.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("property"), F.col(f"{c}.lo").alias("min_value"), F.col(f"{c}.hi").alias("max_value")) for c in columns])))


def theme_filter(value: Column, low: float | None = None, high: float | None = None, off_bins: list[tuple[float, float]] = (), off_values: list = (), no_data: bool = True) -> Column:
    """Whether a value passes: nulls by ``no_data``; not among unselected values; in range and in no unselected bin (both ends count)."""
    test = F.lit(True)
    if off_values:
        test = test & ~value.isin(*off_values)
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    for a, b in off_bins:
        test = test & ~value.between(a, b)
    return F.when(value.isNull(), F.lit(no_data)).otherwise(test)


def legend_presence(df: DataFrame, value: str, bins: DataFrame, passes: Column) -> DataFrame:
    """Rows and passing rows by legend bin (label, min_value, max_value; the last that matches wins), null for no data."""
    told = df.select(F.col(value).cast("double").alias("_v"), passes.alias("_p"))
    kinds = told.groupBy("_v").agg(F.count("*").alias("rows"), F.count_if("_p").alias("passing"))
    met = kinds.join(F.broadcast(bins), F.col("_v").between(F.col("min_value"), F.col("max_value")), "left")
    best = met.groupBy("_v").agg(F.first("rows").alias("rows"), F.first("passing").alias("passing"), F.max_by("label", "min_value").alias("label"))
    return best.groupBy(F.when(F.col("_v").isNull(), "no data").otherwise(F.coalesce("label", F.lit("other"))).alias("label")).agg(F.sum("rows").alias("rows"), F.sum("passing").alias("passing"))


def legend_totals(df: DataFrame, value: str, passes: Column) -> DataFrame:
    """total, with_data, has_no_data and passing, the numbers beside a legend."""
    known = F.col(value).isNotNull()
    return df.agg(F.count("*").alias("total"), F.count_if(known).alias("with_data"), F.coalesce(F.bool_or(~known), F.lit(False)).alias("has_no_data"), F.count_if(passes).alias("passing"))


def manifest(segments: DataFrame, filters: Filters, chunk: int = 10_000, line: str | None = None) -> DataFrame:
    """total, chunks and, with a column of lines, the envelope of what passes; one pass."""
    n = F.count("*")
    sides = []
    if line:
        xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
        sides = [F.min(F.array_min(xs)).alias("min_x"), F.min(F.array_min(ys)).alias("min_y"), F.max(F.array_max(xs)).alias("max_x"), F.max(F.array_max(ys)).alias("max_y")]
    return segments.where(filters.predicate()).agg(n.alias("total"), F.ceil(n / chunk).alias("chunks"), *sides)


# Columns by which boundary layers are filtered.
BOUNDARY_COLUMNS = {
    "county_boundaries": {"district": "GDOT_DISTRICT", "counties": "COUNTYFP"}, "district_boundaries": {"district": "GDOT_DISTRICT"}, "area_office_boundaries": {"district": "AREA_OFFICE_DISTRICT", "area_offices": "AREA_OFFICE_ID"},
    "mpo_boundaries": {"mpos": "MPO_ID"}, "regional_commission_boundaries": {"regional_commissions": "RC_ID"}, "state_house_boundaries": {"state_house_districts": "STATE_HOUSE_DISTRICT"},
    "state_senate_boundaries": {"state_senate_districts": "STATE_SENATE_DISTRICT"}, "congressional_boundaries": {"congressional_districts": "CONGRESSIONAL_DISTRICT"},
}


def boundary_filter(boundaries: DataFrame, layer: str, wanted: dict[str, tuple]) -> DataFrame:
    """Boundaries of a layer by the dimensions it has; others don't count, and an unknown layer has none."""
    if layer not in BOUNDARY_COLUMNS:
        return boundaries.limit(0)
    terms = [F.col(column).isin(*wanted[dimension]) for dimension, column in BOUNDARY_COLUMNS[layer].items() if wanted.get(dimension)]
    return boundaries.where(reduce(and_, terms, F.lit(True)))


def theme_catalog(df: DataFrame, themes: dict[str, tuple[str, float | None]]) -> DataFrame:
    """(theme, column, numeric, min_value, max_value, step) of themes (column, step or null if categorical), bounds from one pass."""
    wide = df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(t) for t, (c, step) in themes.items() if step is not None], F.count("*").alias("_n"))
    each = [
        F.struct(
            F.lit(t).alias("theme"), F.lit(c).alias("column"), F.lit(step is not None).alias("numeric"), (F.col(f"{t}.lo") if step is not None else F.lit(None).cast("double")).alias("min_value"),
            (F.col(f"{t}.hi") if step is not None else F.lit(None).cast("double")).alias("max_value"), F.lit(step).cast("double").alias("step"),
        )
        for t, (c, step) in themes.items()
    ]
    return wide.select(F.inline(F.array(*each)))


def features(segments: DataFrame, filters: Filters, limit: int = 250, offset: int = 0, order: str = "unique_id", line: str = "line", digits: int = 6) -> DataFrame:
    """(id, feature) of a page: each row as a GeoJSON feature with longitudes and latitudes; blank texts are null and left out."""
    rows = page(segments, filters, limit, offset, order)
    names = [c for c in segments.columns if c != line]
    kinds = dict(segments.dtypes)
    plain = [(clean_text(F.col(c)) if kinds[c] == "string" else F.col(c)).alias(c) for c in names]
    places = F.transform(line, lambda p: F.array(F.bround(utm17_to_lonlat(p)["x"], digits), F.bround(utm17_to_lonlat(p)["y"], digits)))
    shape = F.struct(F.lit("LineString").alias("type"), places.alias("coordinates"))
    return rows.select(F.col(order).cast("string").alias("id"), F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*plain).alias("properties"), shape.alias("geometry"))).alias("feature"))


def page(segments: DataFrame, filters: Filters, limit: int = 250, offset: int = 0, order: str = "unique_id") -> DataFrame:
    """A page in a stable order, of at most 20,000 rows (the service's own limit)."""
    return segments.where(filters.predicate()).orderBy(order).offset(offset).limit(min(limit, 20_000))


def detail(segments: DataFrame, unique_id: str) -> DataFrame:
    return segments.where(F.col("unique_id") == unique_id)


def options(segments: DataFrame, dimensions: dict[str, tuple[str, str]]) -> DataFrame:
    """Distinct (id, name) of each dimension, in one pass: dimension, id, name."""
    each = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(i).cast("string").alias("id"), F.col(n).cast("string").alias("name")) for d, (i, n) in dimensions.items()])
    return segments.select(F.explode(each).alias("o")).select("o.*").where("id is not null").distinct().orderBy("dimension", "id")


def city_cascade(segments: DataFrame, city: str, parent: str, miles: str) -> DataFrame:
    """The parent with most miles of each city; ties go to the smaller."""
    told = segments.where(F.col(city).isNotNull() & F.col(parent).isNotNull()).groupBy(city, parent).agg(F.sum(miles).alias("miles"))
    return told.groupBy(city).agg(F.min_by(F.struct(parent, "miles"), F.struct(-F.col("miles"), F.col(parent))).alias("b")).select(city, f"b.{parent}", "b.miles")


def county_options(segments: DataFrame, county: str, district: str) -> DataFrame:
    """Districts with most rows of each county; equals stay."""
    told = segments.where(F.col(county).isNotNull()).groupBy(county, district).agg(F.count("*").alias("rows"))
    return told.withColumn("_r", F.rank().over(Window.partitionBy(county).orderBy(F.desc("rows")))).where("_r = 1").drop("_r")
