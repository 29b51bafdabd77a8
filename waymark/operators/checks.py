"""Data-quality checks: one row for each, with name, passed and detail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.geometry import line_length


def _plain(value: Column) -> Column:
    """A value as text; numbers from ten million on are written out like smaller ones."""
    text = value.cast("string")
    scientific = text.rlike(r"^-?\d\.\d+E-?\d+$") & F.abs(text.try_cast("double")).between(1e-4, 9e15)
    # a double has at most 17 digits, so the decimal holds all of them
    long = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(scientific, long).otherwise(text)


def _rows(df: DataFrame, tests: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One aggregate for all tests (aggregate boolean, aggregate detail) of a table."""
    each = [F.struct(F.lit(n).alias("name"), F.coalesce(t, F.lit(False)).alias("passed"), _plain(d).alias("detail")) for n, (t, d) in tests.items()]
    wide = df.agg(F.array(*each).alias("c"))
    return wide.select(F.inline("c"))


def table_checks(df: DataFrame, min_rows: int = 200_000, min_columns: int = 100, max_nulls: dict[str, float] | None = None, ranges: dict[str, tuple[float, float]] | None = None, unique: str | None = None) -> DataFrame:
    """Row and column thresholds, null shares, value ranges and uniqueness, in one pass."""
    n = F.count("*")
    tests = {"row_count": (n >= min_rows, n), "column_count": (F.lit(len(df.columns) >= min_columns) & (n >= 0), F.lit(len(df.columns)))}
    for c, most in (max_nulls or {}).items():
        share = F.count_if(F.col(c).isNull()) / F.greatest(n, F.lit(1))
        tests[f"nulls_{c}"] = (share < most, F.round(share, 6))
    for c, (lo, hi) in (ranges or {}).items():
        bad = F.count_if(~F.col(c).between(lo, hi))
        tests[f"range_{c}"] = (bad == 0, bad)
    if unique:
        twice = n - F.count_distinct(F.coalesce(F.col(unique).cast("string"), F.lit("")))
        tests[f"unique_{unique}"] = (twice == 0, twice)
    return _rows(df, tests)


def required_when(df: DataFrame, name: str, when: Column, columns: list[str], least: float = 1.0) -> DataFrame:
    """Whether, where ``when`` holds, each column is filled in at least the given share of rows."""
    on = F.coalesce(when, F.lit(False))
    n = F.greatest(F.count_if(on), F.lit(1))
    return _rows(df, {f"{name}_{c}": (F.count_if(on & F.col(c).isNotNull()) / n >= least, F.count_if(on & F.col(c).isNull())) for c in columns} )


def implies(df: DataFrame, name: str, value: str, provenance: str) -> DataFrame:
    """Whether each value has its provenance."""
    bad = F.count_if(F.col(value).isNotNull() & F.col(provenance).isNull())
    return _rows(df, {name: (bad == 0, bad)})


def labels_match(df: DataFrame, name: str, label: str, decoded: Column) -> DataFrame:
    bad = F.count_if(decoded.isNotNull() & ~F.col(label).eqNullSafe(decoded))
    return _rows(df, {name: (bad == 0, bad)})


def county_list(df: DataFrame, listed: str, known: list[str], leading: str | None = None) -> DataFrame:
    """Structure of a county list: no blanks, no repeats, known names only, the leading name first."""
    parts = F.transform(F.split(F.col(listed), ","), lambda x: F.lower(F.trim(x)))
    names = F.array(*[F.lit(k.lower()) for k in known])
    tests = {
        "blank": F.exists(parts, lambda x: x == ""),
        "repeated": F.size(F.array_distinct(parts)) < F.size(parts),
        "unknown": F.size(F.array_except(F.filter(parts, lambda x: x != ""), names)) > 0,
    }
    if leading:
        tests["leading"] = F.get(parts, 0) != F.lower(F.trim(leading))
    return _rows(df, {f"county_list_{k}": (F.count_if(t) == 0, F.count_if(t)) for k, t in tests.items()})


def columns_present(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Whether each group's columns exist."""
    rows = [(f"columns_{g}", not (gone := [c for c in cols if c not in df.columns]), ", ".join(gone)) for g, cols in groups.items()]
    return df.sparkSession.createDataFrame(rows, "name string, passed boolean, detail string")


def same_keys(a: DataFrame, b: DataFrame, name: str, key: str) -> DataFrame:
    """Whether two tables have the same keys: anti-joins both ways."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    left = x.join(y, key, "left_anti").agg(F.count("*").alias("n"))
    right = y.join(x, key, "left_anti").agg(F.count("*").alias("m"))
    return left.crossJoin(F.broadcast(right)).select(F.lit(name).alias("name"), ((F.col("n") == 0) & (F.col("m") == 0)).alias("passed"), F.concat_ws("/", "n", "m").alias("detail"))


def total_within(df: DataFrame, name: str, column: str, expected: float, share: float) -> DataFrame:
    total = F.coalesce(F.sum(column), F.lit(0))
    return _rows(df, {name: (F.abs(total - expected) <= share * expected, total)})


def regression_cases(df: DataFrame, cases: DataFrame, flag: str) -> DataFrame:
    """Cases (case_id, HWY_NAME, COUNTY_NAME, route_suffix, expected) against whether any matching segment has the flag; without a suffix any ROUTE_ID matches."""
    rows = df.select("HWY_NAME", "COUNTY_NAME", "ROUTE_ID", F.col(flag).alias("_f"))
    on = [cases[c] == rows[c] for c in ("HWY_NAME", "COUNTY_NAME")]
    told = cases.join(rows, on[0] & on[1] & (cases["route_suffix"].isNull() | F.endswith(rows["ROUTE_ID"], cases["route_suffix"])), "left")
    got = told.groupBy("case_id", "expected").agg(F.coalesce(F.bool_or("_f"), F.lit(False)).alias("got"))
    return got.select(F.concat(F.lit("case_"), F.col("case_id").cast("string")).alias("name"), (F.col("got") == F.col("expected")).alias("passed"), F.col("got").cast("string").alias("detail"))


def family_slots(df: DataFrame, families: list[str], listed: str = "SIGNED_ROUTE_FAMILY_ALL", slots: tuple[str, str, str] = ("SIGNED_ROUTE_FAMILY_PRIMARY", "SECONDARY_SIGNED_ROUTE_FAMILY", "TERTIARY_SIGNED_ROUTE_FAMILY")) -> DataFrame:
    """Whether JSON lists hold signed families only, and the three slots are their first three; a list that can't be read is misaligned."""
    blank = F.coalesce(F.trim(listed) == "", F.lit(True))
    read = F.when(blank, F.array().cast("array<string>")).otherwise(F.from_json(listed, "array<string>"))
    said = F.filter(F.transform(read, F.trim), lambda x: x != "")
    signed = F.filter(said, lambda x: x.isin(*families))
    actual = [F.trim(c) for c in slots]
    first = F.when(F.size(signed) > 0, actual[0].eqNullSafe(F.get(signed, 0))).otherwise(~F.coalesce(actual[0].isin(*families), F.lit(False)))
    rest = actual[1].eqNullSafe(F.get(signed, 1)) & actual[2].eqNullSafe(F.get(signed, 2))
    foreign, apart = F.count_if(F.size(said) > F.size(signed)), F.count_if(read.isNull() | ~(first & rest))
    return _rows(df, {"family_list": (foreign == 0, foreign), "family_slots": (apart == 0, apart)})


def geometry_checks(df: DataFrame, line: str = "line") -> DataFrame:
    """Whether no line is missing, empty or without length."""
    none = F.count_if(F.coalesce(F.size(line), F.lit(0)) < 2)
    flat = F.count_if((F.size(line) >= 2) & (line_length(F.col(line)) == 0))
    return _rows(df, {"geometry_empty": (none == 0, none), "geometry_degenerate": (flat == 0, flat)})


def area_office_table(table: DataFrame, counties: DataFrame, areas: DataFrame | None = None, offices: int = 38) -> DataFrame:
    """Code table (county, district, area_id, part; part null for whole counties, else remainder or a municipality) against the counties (county).

    Each county occurs once, whole or split; the pairs of district and area are ``offices``;
    districts lie in 1 to 7, areas from 1; a county has one remainder at most; and with
    ``areas`` (county, whole_m2, covered_m2) offices cover 99.5 to 100.5 percent.
    """
    by_county = table.groupBy("county").agg(F.count_if(F.col("part").isNull()).alias("_whole"), F.count_if(F.col("part").isNotNull()).alias("_split"), F.count_if(F.col("part") == "remainder").alias("_rest"))
    both = counties.select("county").distinct().withColumn("_known", F.lit(True)).join(by_county, "county", "full")
    bad = F.count_if(F.col("_known").isNull() | F.coalesce(((F.col("_whole") > 0) & (F.col("_split") > 0)) | (F.col("_whole") > 1), F.lit(True)))
    many = F.count_if(F.col("_rest") > 1)
    told = _rows(both, {"offices_counties": (bad == 0, bad), "offices_remainders": (many == 0, many)})
    pairs, out = F.count_distinct("district", "area_id"), F.count_if(~F.col("district").between(1, 7) | (F.col("area_id") < 1))
    told = told.unionByName(_rows(table, {"offices_pairs": (pairs == offices, pairs), "offices_ranges": (out == 0, out)}))
    if areas is not None:
        share = F.sum("covered_m2") / F.sum("whole_m2")
        told = told.unionByName(_rows(areas, {"offices_coverage": (share.between(0.995, 1.005), F.round(share, 6))}))
    return told


def loader_checks(statewide: DataFrame, district: DataFrame, wanted: int) -> DataFrame:
    """Whether the load of all has rows, and that of a district has rows of that one only."""
    n = F.count("*")
    other = F.count_if(~F.col("DISTRICT").eqNullSafe(F.lit(wanted)))
    return _rows(statewide, {"load_statewide": (n > 0, n)}).unionByName(_rows(district, {"load_district": ((n > 0) & (other == 0), other)}))


def labels_equal(segments: DataFrame, boundaries: DataFrame, name: str, key: str, label: str, boundary_label: str) -> DataFrame:
    """Whether the label of each key is that of its boundary; keys without a boundary count."""
    said = segments.where(F.col(key).isNotNull()).select(key, F.trim(label).alias("_l")).distinct()
    met = said.join(boundaries.select(key, F.trim(boundary_label).alias("_b")).distinct(), key, "left")
    bad = F.count_if(~F.col("_l").eqNullSafe(F.col("_b")))
    return _rows(met, {name: (bad == 0, bad)})


def count_bounds(flagged: DataFrame, key: str, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """Whether the rows of each key lie within its bounds."""
    wide = flagged.agg(*[F.count_if(F.col(key) == k).alias(f"_{i}") for i, k in enumerate(bounds)])
    each = [F.struct(F.lit(f"count_{k}").alias("name"), F.col(f"_{i}").between(lo, hi).alias("passed"), F.col(f"_{i}").cast("string").alias("detail")) for i, (k, (lo, hi)) in enumerate(bounds.items())]
    return wide.select(F.inline(F.array(*each)))


def all_checks(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
