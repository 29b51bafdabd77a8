"""Corridor matching: buffered overlap of segments with named lines, its rules, and splitting at flagged stretches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.functions.classify import designation_match
from waymark.functions.scalars import clean_text, corridor_prefixes, expected_family, round_even, route_designations, unique_id
from waymark.lineage import checkpointed
from waymark.operators.intervals import direction_mirror, merge_intervals


def build_corridors(lines: DataFrame, id_: str, name: str) -> DataFrame:
    """(corridor, public_name, line): a row per line; lines of a name share a corridor, unnamed ones are one each."""
    key = F.coalesce(F.nullif(F.trim(name), F.lit("")), F.concat(F.lit("__UNNAMED__#"), F.col(id_).cast("string")))
    return lines.select(key.alias("corridor"), F.nullif(F.trim(name), F.lit("")).alias("public_name"), "line")


def _edges(df: DataFrame, keys: list[str], size: float, reach: float) -> DataFrame:
    """Edges of lines with the length before each (a running sum by line), in the cells within ``reach`` of them."""
    # numbered before the explode, so that all edges of a line share its number
    cut = df.withColumn("_line", F.monotonically_increasing_id()).select(*keys, "_line", F.posexplode(G.edges(F.col("line"))).alias("_pos", "_g"))
    n = F.hypot(F.col("_g.bx") - F.col("_g.ax"), F.col("_g.by") - F.col("_g.ay"))
    cut = cut.withColumn("_n", n).withColumn("_at", F.sum("_n").over(Window.partitionBy("_line").orderBy("_pos")) - F.col("_n"))
    e = F.struct(*[F.col(f"_g.{c}").alias(c) for c in ("ax", "ay", "bx", "by")], F.col("_at").alias("at"), F.col("_n").alias("len"))
    ends = F.array(F.struct(F.col("_g.ax").alias("x"), F.col("_g.ay").alias("y")), F.struct(F.col("_g.bx").alias("x"), F.col("_g.by").alias("y")))
    return cut.select(*keys, e.alias("_e"), F.explode(G.line_cells(ends, size, reach)).alias("_cell"))


def _capsule(e: Column, c: Column, radius: float) -> Column:
    """array<struct<a, b>>: shares of edge ``e`` within the radius of edge ``c``: its two end discs and the band along it."""
    ux, uy = e["bx"] - e["ax"], e["by"] - e["ay"]
    n = ux * ux + uy * uy

    def disc(px: Column, py: Column) -> Column:
        wx, wy = e["ax"] - px, e["ay"] - py
        b, k = wx * ux + wy * uy, wx * wx + wy * wy - radius * radius
        root = b * b - n * k
        return F.when((n > 0) & (root >= 0), F.struct(((-b - F.sqrt(root)) / n).alias("a"), ((-b + F.sqrt(root)) / n).alias("b")))

    vx, vy = c["bx"] - c["ax"], c["by"] - c["ay"]
    m = F.hypot(vx, vy)
    # distance to the line of c, and share along c, as linear functions of the share along e
    d0, d1 = ((e["ax"] - c["ax"]) * vy - (e["ay"] - c["ay"]) * vx) / m, (ux * vy - uy * vx) / m
    s0, s1 = ((e["ax"] - c["ax"]) * vx + (e["ay"] - c["ay"]) * vy) / (m * m), (ux * vx + uy * vy) / (m * m)

    def between(at: Column, by: Column, lo: float, hi: float) -> tuple[Column, Column]:
        x, y = (lo - at) / by, (hi - at) / by
        inside = at.between(lo, hi)
        return F.when(F.abs(by) > 1e-12, F.least(x, y)).when(inside, F.lit(-1.0)).otherwise(F.lit(2.0)), F.when(F.abs(by) > 1e-12, F.greatest(x, y)).when(inside, F.lit(2.0)).otherwise(F.lit(-1.0))

    (p, q), (r, s) = between(d0, d1, -radius, radius), between(s0, s1, 0.0, 1.0)
    band = F.when(m > 0, F.struct(F.greatest(p, r).alias("a"), F.least(q, s).alias("b")))
    every = F.array_compact(F.array(disc(c["ax"], c["ay"]), disc(c["bx"], c["by"]), band))
    clipped = F.transform(every, lambda x: F.struct(F.greatest(x["a"], F.lit(0.0)).alias("a"), F.least(x["b"], F.lit(1.0)).alias("b")))
    return F.filter(clipped, lambda x: x["b"] > x["a"])


def _met(segments: DataFrame, keys: list[str], corridors: DataFrame, on: list[str], radius: float, size: float) -> DataFrame:
    """(keys, on, _e, _c): pairs of edges whose cells meet within the radius.

    A pair belongs to the first cell that both touch, so it is met once and not shuffled again.
    """
    near = _edges(segments, keys, size, radius).join(_edges(corridors, on, size, 0.0).withColumnRenamed("_e", "_c"), "_cell")
    e, c = F.col("_e"), F.col("_c")

    def first(a: str, b: str) -> Column:
        return F.greatest(F.floor((F.least(e[a], e[b]) - radius) / size), F.floor(F.least(c[a], c[b]) / size))

    return near.where((F.col("_cell.cx") == first("ax", "bx")) & (F.col("_cell.cy") == first("ay", "by")))


def _along(e: Column, c: Column, radius: float) -> Column:
    """array<struct<from_m, to_m>>: stretches of the line of edge ``e`` within the radius of edge ``c``."""
    return F.transform(_capsule(e, c, radius), lambda p: F.struct((e["at"] + p["a"] * e["len"]).alias("from_m"), (e["at"] + p["b"] * e["len"]).alias("to_m")))


def covered_ranges(segments: DataFrame, id_: str, corridors: DataFrame, radius: float, size: float = 500.0) -> DataFrame:
    """(id, corridor, from_m, to_m): stretches of each segment within the radius of each corridor."""
    near = _met(segments, [id_], corridors, ["corridor"], radius, size)
    ranges = near.select(id_, "corridor", F.inline(_along(F.col("_e"), F.col("_c"), radius)))
    return merge_intervals(ranges, [id_, "corridor"], 0.5)


def length_within(segments: DataFrame, id_: str, corridors: DataFrame, radius: float) -> DataFrame:
    """(id, corridor, overlap_m): length of each segment within the radius of each corridor."""
    return covered_ranges(segments, id_, corridors, radius).groupBy(id_, "corridor").agg(F.sum(F.col("to_m") - F.col("from_m")).alias("overlap_m"))


# Families of the state system, names that never match, and local names that need no state sibling.
STATE_FAMILIES = ("interstate", "us route", "u.s. route", "state route")
EXCLUDED_NAMES = ("RAMP",)
EXEMPT_NAMES = ("CR-785",)
UNNAMED = "__UNNAMED__#"
SAMPLES = 11


@dataclass(frozen=True)
class MatchRules:
    """Thresholds of a corridor match: metres, shares of the segment and degrees."""

    loose: float = 50.0
    tight: float = 20.0
    least_share: float = 0.20
    local_length: float = 200.0
    local_share: float = 0.80
    follower_length: float = 80.0
    follower_share: float = 0.60
    discover_length: float = 300.0
    discover_share: float = 0.70
    discover_overlap: float = 500.0
    discover_long_share: float = 0.20
    short: float = 400.0
    short_share: float = 0.70
    unnamed_tight: float = 30.0
    long: float = 10_000.0
    long_share: float = 0.50
    angle: float = 30.0
    angle_reach: float = 60.0
    angle_share: float = 0.50
    angle_length: float = 2_000.0


def _state_system(family: Column) -> Column:
    return F.coalesce(F.lower(F.trim(family)).isin(*STATE_FAMILIES), F.lit(False))


def _plain(name: Column) -> Column:
    return F.upper(clean_text(name))


def _follower_able(name: Column) -> Column:
    """Whether a local segment may follow a corridor without a state sibling: not by a county road's name."""
    return F.coalesce(F.substring_index(_plain(name), "-", 1) != "CR", F.lit(True))


def section_azimuths(lines: DataFrame, keys: list[str], ranges: DataFrame, on: list[str]) -> DataFrame:
    """(keys, azimuth) of the longest stretch (from_m, to_m) of ``lines`` (on, line) for each of ``keys``."""
    longest = F.max(F.struct((F.col("to_m") - F.col("from_m")).alias("n"), F.col("from_m").alias("a"), F.col("to_m").alias("b"), F.struct(*on).alias("k"))).alias("_m")
    told = ranges.groupBy(*keys).agg(longest).select(*keys, "_m.a", "_m.b", F.col("_m.k").alias("_k"))
    named = lines.select(F.struct(*on).alias("_k"), "line")
    ends = F.array(G.line_at(F.col("line"), F.col("a")), G.line_at(F.col("line"), F.col("b")))
    return told.join(named, "_k").select(*keys, G.azimuth(ends).alias("azimuth"))


def corridor_candidates(segments: DataFrame, id_: str, corridors: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """(id, corridor, overlap_m, tight_m, length_m, share, tight_share, angle) of all pairs with a loose overlap.

    The angle is that between the segment and the corridor's longest stretch near it.
    """
    parts = checkpointed(corridors.withColumn("_part", F.monotonically_increasing_id()).select("_part", "corridor", "line"))
    near = _met(segments, [id_], parts, ["_part", "corridor"], max(rules.loose, rules.tight, rules.angle_reach), 500.0)
    e, c = F.col("_e"), F.col("_c")

    def told_as(kind: str, part: Column, ranges: Column) -> Column:
        return F.transform(ranges, lambda r: F.struct(F.lit(kind).alias("kind"), part.alias("_part"), r["from_m"].alias("from_m"), r["to_m"].alias("to_m")))

    # one join gives the segment's stretches at both reaches and those of each corridor line near it
    whole = F.lit(-1).cast("bigint")
    each = F.concat(told_as("loose", whole, _along(e, c, rules.loose)), told_as("tight", whole, _along(e, c, rules.tight)), told_as("back", F.col("_own"), _along(c, e, rules.angle_reach)))
    rows = near.withColumnRenamed("_part", "_own").select(id_, "corridor", F.inline(each))
    ranges = checkpointed(merge_intervals(rows, [id_, "corridor", "kind", "_part"], 0.5))
    length = F.sum(F.col("to_m") - F.col("from_m"))
    told = ranges.where("kind = 'loose'").groupBy(id_, "corridor").agg(length.alias("overlap_m"))
    tight = ranges.where("kind = 'tight'").groupBy(id_, "corridor").agg(length.alias("tight_m"))
    told = told.join(tight, [id_, "corridor"], "left").na.fill(0.0, ["tight_m"])
    told = told.join(segments.select(id_, G.line_length(F.col("line")).alias("length_m"), G.azimuth(F.col("line")).alias("_z")), id_)
    way = section_azimuths(parts, [id_, "corridor"], ranges.where("kind = 'back'"), ["_part"])
    told = told.join(way, [id_, "corridor"], "left")
    return checkpointed(told.select(id_, "corridor", "overlap_m", "tight_m", "length_m", (F.col("overlap_m") / F.col("length_m")).alias("share"), (F.col("tight_m") / F.col("length_m")).alias("tight_share"), G.alignment_angle(F.col("_z"), F.col("azimuth")).alias("angle")))


def discover_prefixes(candidates: DataFrame, segments: DataFrame, id_: str, name: str, corridors: DataFrame | None = None, rules: MatchRules = MatchRules()) -> DataFrame:
    """(corridor, names): highway names that follow a corridor closely, and those that its own public name states; ramps left out."""
    c = F.col
    follows = (c("length_m") >= rules.discover_length) & ((c("tight_share") >= rules.discover_share) | ((c("tight_m") >= rules.discover_overlap) & (c("tight_share") >= rules.discover_long_share)))
    told = candidates.where(follows).join(segments.select(id_, _plain(F.col(name)).alias("_name")), id_).where(c("_name").isNotNull() & ~c("_name").isin(*EXCLUDED_NAMES)).select("corridor", "_name")
    if corridors is not None:
        said = corridors.select("corridor", "public_name").distinct().select("corridor", F.explode(corridor_prefixes(F.col("public_name"))).alias("_name"))
        told = told.unionByName(said.select("corridor", F.upper("_name").alias("_name")))
    return told.groupBy("corridor").agg(F.array_sort(F.collect_set("_name")).alias("names"))


def corridor_match(candidates: DataFrame, segments: DataFrame, id_: str, name: str, family: str, prefixes: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """Candidates with ``matched``, the first rule that rejects them (``reason``, null if none) and ``state``, whether the segment is of the state system."""
    c = F.col
    told = candidates.join(segments.select(id_, _plain(F.col(name)).alias("_name"), _state_system(F.col(family)).alias("state")), id_).join(prefixes, "corridor", "left")
    unnamed = c("corridor").startswith(UNNAMED)
    follower = (c("length_m") >= rules.follower_length) & (c("tight_share") >= rules.follower_share) & _follower_able(c("_name"))
    along = (c("length_m") >= rules.local_length) & (c("share") >= rules.local_share)
    fits = c("names").isNull() | F.coalesce(F.array_contains("names", c("_name")), F.lit(False))
    proving = (c("share") > rules.angle_share) | (c("overlap_m") > rules.angle_length)
    reason = (
        F.when(F.coalesce(c("_name").isin(*EXCLUDED_NAMES), F.lit(False)), "ramp")
        .when(c("share") < rules.least_share, "share")
        .when(~c("state") & ~(along | follower), "local")
        .when(c("state") & ~fits, "name")
        .when(c("state") & (c("length_m") < rules.short) & (c("share") < rules.short_share), "short")
        .when(unnamed & (c("tight_m") < rules.unnamed_tight), "unnamed")
        .when((c("length_m") > rules.long) & (c("share") < rules.long_share), "long")
        .when((c("length_m") >= rules.short) & ~proving & (c("angle") > rules.angle), "angle")
    )
    return told.withColumn("reason", reason).withColumn("matched", F.col("reason").isNull()).drop("_name", "names")


def _passed(others: DataFrame, on: list[str], size: float) -> DataFrame:
    """(on, _fine): cells that hold a point of a line of ``others``, each once; points are half a cell apart."""
    g = others.select(*on, F.explode(G.edges(F.col("line"))).alias("_g"))
    dx, dy = F.col("_g.bx") - F.col("_g.ax"), F.col("_g.by") - F.col("_g.ay")
    steps = F.greatest(F.ceil(F.hypot(dx, dy) / (size / 2)), F.lit(1))
    g = g.withColumn("_k", steps).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k"))).alias("_i"))
    share = F.col("_i") / F.col("_k")
    return g.select(*on, _fine(F.col("_g.ax") + share * dx, F.col("_g.ay") + share * dy, size).alias("_fine")).distinct()


def _fine(x: Column, y: Column, size: float) -> Column:
    return F.struct(F.floor(x / size).alias("fx"), F.floor(y / size).alias("fy"))


def near_share(lines: DataFrame, keys: list[str], others: DataFrame, on: list[str], reach: float, size: float = 200.0, dense: bool = False) -> DataFrame:
    """(keys, near): share of 11 samples of each line that lie within ``reach`` of a line of ``others`` with equal ``on``; only those with any.

    Where many lines lie side by side (``dense``), samples in a cell that one of them passes are
    near by that alone, as two points of such a cell are less than ``reach`` apart; only the
    others are compared with the lines around them.
    """
    samples = lines.select(*keys, F.posexplode(G.line_samples(F.col("line"), SAMPLES)).alias("_n", "_p"))
    settled = None
    if dense:
        fine = 0.7 * reach
        passed = _passed(others, on, fine).withColumn("_hit", F.lit(True))
        told = samples.withColumn("_fine", _fine(F.col("_p.x"), F.col("_p.y"), fine)).join(passed, [*on, "_fine"], "left")
        settled, samples = told.where("_hit").select(*keys, "_n"), told.where("_hit is null").select(*keys, "_n", "_p")
    cell = F.struct(F.floor(F.col("_p.x") / size).alias("cx"), F.floor(F.col("_p.y") / size).alias("cy"))
    edges = _edges(others, on, size, reach)
    t = G._edge_project(F.col("_e"), F.col("_p.x"), F.col("_p.y"))
    gap = F.hypot(F.col("_e.ax") + t * (F.col("_e.bx") - F.col("_e.ax")) - F.col("_p.x"), F.col("_e.ay") + t * (F.col("_e.by") - F.col("_e.ay")) - F.col("_p.y"))
    near = samples.withColumn("_cell", cell).join(edges, [*on, "_cell"]).where(gap <= reach).select(*keys, "_n").distinct()
    if settled is not None:
        near = near.unionByName(settled)
    return near.groupBy(*keys).agg((F.count("*") / float(SAMPLES)).alias("near"))


def sibling_filter(matches: DataFrame, segments: DataFrame, id_: str, name: str, corridors: DataFrame, reach: float = 25.0, least: float = 0.8, rules: MatchRules = MatchRules()) -> DataFrame:
    """Matches without those of local segments that no named corridor holds up.

    A local segment stays with all its matches if on one of its named corridors at least
    ``least`` of 11 samples lie near a matched state segment of that corridor, or it follows the
    corridor's own line (60 percent of samples within 20 m, aligned, no county road); also if
    its name is exempt or all its corridors are unnamed.
    """
    kept = matches.where("matched")
    lines = segments.select(id_, _plain(F.col(name)).alias("_name"), "line")
    told = kept.join(lines, id_)
    local = checkpointed(told.where(~F.col("state") & ~F.col("corridor").startswith(UNNAMED)).select(id_, "corridor", "_name", "line", "length_m", "angle"))
    state = told.where("state").select("corridor", "line")
    beside = near_share(local, [id_, "corridor"], state, ["corridor"], reach, dense=True).where(F.col("near") >= least).select(id_)
    able = local.where(_follower_able(F.col("_name")) & (F.col("length_m") >= rules.follower_length) & (F.col("angle").isNull() | (F.col("angle") <= rules.angle)))
    following = near_share(able, [id_, "corridor"], corridors.select("corridor", "line"), ["corridor"], rules.tight).where(F.col("near") >= rules.follower_share).select(id_)
    exempt = local.where(F.col("_name").isin(*EXEMPT_NAMES)).select(id_)
    fine = beside.unionByName(following).unionByName(exempt).distinct()
    gone = local.select(id_).distinct().join(fine, id_, "left_anti")
    return kept.join(gone, id_, "left_anti")


def collapse_matches(matches: DataFrame, id_: str, segments: DataFrame | None = None, corridors: DataFrame | None = None, rules: MatchRules = MatchRules(), whole: float = 0.90, least: float = 30.0) -> DataFrame:
    """(id, corridors, overlap_m, share, portion): public names, largest overlap and share of each matched segment, and the portion of it that its corridors hold.

    A portion of at least ``whole``, and one of less than ``least`` metres, counts as 1. Without
    ``segments`` and ``corridors`` there is no portion.
    """
    kept = matches.where("matched")
    named = F.when(~F.col("corridor").startswith(UNNAMED), F.col("corridor"))
    told = kept.groupBy(id_).agg(F.array_sort(F.collect_set(named)).alias("corridors"), F.max("overlap_m").alias("overlap_m"), F.max("share").alias("share"), F.max("length_m").alias("_n"))
    if segments is None or corridors is None:
        return told.drop("_n")
    held = matched_ranges(kept, id_, segments, corridors, rules).groupBy(id_).agg(F.sum(F.col("to_m") - F.col("from_m")).alias("_held"))
    told = told.join(held, id_, "left")
    portion = F.least(F.lit(1.0), F.col("_held") / F.col("_n"))
    return told.withColumn("portion", F.when((F.col("_held") >= least) & (portion < whole), portion).otherwise(1.0)).drop("_n", "_held")


def matched_ranges(matches: DataFrame, id_: str, segments: DataFrame, corridors: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """(id, from_m, to_m): stretches of each matched segment within the loose reach of the corridors it matches."""
    pairs = matches.where("matched").select(id_, "corridor")
    lines = segments.join(pairs.select(id_).distinct(), id_, "left_semi").select(id_, "line")
    near = covered_ranges(lines, id_, corridors, rules.loose).join(pairs, [id_, "corridor"], "left_semi")
    return merge_intervals(near.select(id_, "from_m", "to_m"), [id_], 0.5)


def match_corridors(segments: DataFrame, id_: str, corridors: DataFrame, name: str = "HWY_NAME", family: str = "ROUTE_FAMILY", rules: MatchRules = MatchRules()) -> DataFrame:
    """All rules together: matches of segments (line) with corridors (``build_corridors``)."""
    candidates = corridor_candidates(segments, id_, corridors, rules)
    prefixes = discover_prefixes(candidates, segments, id_, name, corridors, rules)
    matches = checkpointed(corridor_match(candidates, segments, id_, name, family, prefixes, rules))
    return checkpointed(sibling_filter(matches, segments, id_, name, corridors, rules=rules))


def contraflow_match(segments: DataFrame, id_: str, routes: DataFrame, route: str, title: str, family: str = "ROUTE_FAMILY", reach: float = 15.0) -> DataFrame:
    """(id, names, overlap_m, share): interstate segments along contraflow routes (route, title, line).

    At least 200 m and 30 percent have to lie within 15 m (60 percent of segments shorter than
    400 m), at no more than 20 degrees, and a quarter of the segment within reach of any route.
    """
    able = segments.where(F.trim(family) == "Interstate")
    told = _overlaps(able, id_, routes, route, reach)
    short = F.col("length_m") < 400
    fits = F.when(short, F.col("share") >= 0.60).otherwise((F.col("overlap_m") >= 200) & (F.col("share") >= 0.30) & ~F.coalesce(F.col("angle") > 20, F.lit(False)))
    told = told.where(fits).join(routes.select(route, clean_text(F.col(title)).alias("_title")).distinct(), route, "left")
    found = told.groupBy(id_).agg(F.array_sort(F.collect_set("_title")).alias("names"), F.max("overlap_m").alias("overlap_m"), F.max("share").alias("share"), F.max("length_m").alias("_n"))
    union = covered_ranges(able.join(found, id_, "left_semi"), id_, routes.select(F.lit("all").alias("corridor"), "line"), reach).groupBy(id_).agg(F.sum(F.col("to_m") - F.col("from_m")).alias("_u"))
    return found.join(union, id_).where(F.col("_u") >= 0.25 * F.col("_n")).drop("_u", "_n")


def _overlaps(segments: DataFrame, id_: str, overlay: DataFrame, key: str, reach: float) -> DataFrame:
    """(id, key, overlap_m, length_m, share, angle) of segments and single overlay features within reach; the angle between the overlap and the feature's part near the segment."""
    features = overlay.select(F.col(key).alias("corridor"), "line")
    near = checkpointed(covered_ranges(segments, id_, features, reach))
    back = covered_ranges(features.withColumnRenamed("corridor", "_f"), "_f", segments.select(F.col(id_).alias("corridor"), "line"), reach).select(F.col("corridor").alias(id_), F.col("_f").alias("corridor"), "from_m", "to_m")
    own = section_azimuths(segments, [id_, "corridor"], near, [id_]).withColumnRenamed("azimuth", "_a")
    theirs = _feature_azimuths(features, id_, back)
    told = near.groupBy(id_, "corridor").agg(F.sum(F.col("to_m") - F.col("from_m")).alias("overlap_m")).join(segments.select(id_, G.line_length(F.col("line")).alias("length_m")), id_)
    told = told.join(own, [id_, "corridor"], "left").join(theirs, [id_, "corridor"], "left")
    return told.select(id_, F.col("corridor").alias(key), "overlap_m", "length_m", (F.col("overlap_m") / F.col("length_m")).alias("share"), G.alignment_angle(F.col("_a"), F.col("_b")).alias("angle"))


def _feature_azimuths(features: DataFrame, id_: str, ranges: DataFrame) -> DataFrame:
    longest = ranges.groupBy(id_, "corridor").agg(F.max(F.struct((F.col("to_m") - F.col("from_m")).alias("n"), F.col("from_m").alias("a"), F.col("to_m").alias("b"))).alias("_m"))
    ends = F.array(G.line_at(F.col("line"), F.col("_m.a")), G.line_at(F.col("line"), F.col("_m.b")))
    return longest.join(features, "corridor").select(id_, "corridor", G.azimuth(ends).alias("_b"))


@dataclass(frozen=True)
class OverlayRules:
    """Thresholds of a plain overlay: reach, overlap and share, those of short and very long segments, and the largest angle."""

    reach: float = 30.0
    least: float = 150.0
    share: float = 0.20
    short: float = 400.0
    short_share: float = 0.40
    long: float = 10_000.0
    long_least: float = 200.0
    long_share: float = 0.50
    angle: float = 30.0


def threshold_overlay(segments: DataFrame, id_: str, overlay: DataFrame, key: str, name: str, rules: OverlayRules = OverlayRules(), prefilter: bool = False, by_family: bool = False) -> DataFrame:
    """(id, names, overlap_m, share): segments along overlay features (key, name, line) by length, share and angle.

    ``prefilter`` leaves out county roads and city streets that no feature's name states;
    ``by_family`` holds features whose name states a family against the state system only.
    """
    able = segments
    if prefilter:
        local = F.coalesce(F.col("ROUTE_TYPE_GDOT").isin("CR", "CS"), F.lit(False))
        said = overlay.select(F.explode(route_designations(F.col(name))).alias("_d")).where(F.col("_d.type").isin("CR", "CS")).select(F.col("_d.type").alias("ROUTE_TYPE_GDOT"), F.col("_d.number").alias("BASE_ROUTE_NUMBER")).distinct()
        able = segments.where(~local).unionByName(segments.where(local).join(said, ["ROUTE_TYPE_GDOT", "BASE_ROUTE_NUMBER"], "left_semi").select(*segments.columns))
    told = _overlaps(able, id_, overlay, key, rules.reach).join(overlay.select(key, clean_text(F.col(name)).alias("_name")).distinct(), key, "left")
    short, long = F.col("length_m") < rules.short, F.col("length_m") > rules.long
    plain = (F.col("overlap_m") >= rules.least) & (F.col("share") >= rules.share)
    wide = ((F.col("overlap_m") >= rules.long_least) & (F.col("share") >= rules.long_share)) | (F.col("overlap_m") >= rules.least)
    fits = F.when(short, F.col("share") >= rules.short_share).when(long, wide).otherwise(plain) & (short | ~F.coalesce(F.col("angle") > rules.angle, F.lit(False)))
    if by_family:
        told = told.join(segments.select(id_, _state_system(F.col("ROUTE_FAMILY")).alias("_state")), id_).where(expected_family(F.col("_name")).isNull() | F.col("_state"))
    return told.where(fits).groupBy(id_).agg(F.array_sort(F.collect_set("_name")).alias("names"), F.max("overlap_m").alias("overlap_m"), F.max("share").alias("share"))


def hybrid_overlay(segments: DataFrame, id_: str, overlay: DataFrame, key: str, name: str, rules: OverlayRules = OverlayRules()) -> DataFrame:
    """Overlay with the prefilter for features whose name states a route, without it for others; ``method`` tells segments that are such a route from those beside it."""
    stated = F.size(route_designations(F.col(name))) > 0
    by_name = threshold_overlay(segments, id_, overlay.where(stated), key, name, rules, prefilter=True)
    beside = threshold_overlay(segments, id_, overlay.where(~stated), key, name, rules)
    named = designated_segments(segments, id_, overlay.where(stated).select(name), name).withColumn("_named", F.lit(True))
    by_name = by_name.join(named, id_, "left").withColumn("method", F.when(F.col("_named"), "attribute+spatial").otherwise("spatial_only")).drop("_named")
    both = by_name.unionByName(beside.withColumn("method", F.lit("spatial_only")))
    return both.groupBy(id_).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"), F.max("overlap_m").alias("overlap_m"), F.max("share").alias("share"), F.min("method").alias("method"))


def designated_segments(segments: DataFrame, id_: str, names: DataFrame, name: str) -> DataFrame:
    """Ids of segments that one of the names designates (``classify.designation_match``), by equality joins on number and, for interstates, on the digits that their name begins with."""
    said = names.select(F.explode(route_designations(F.col(name))).alias("_d")).distinct()
    digits = F.regexp_extract("HWY_NAME", r"^I-(\d+)", 1)
    starts = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda n: F.substring(digits, F.lit(1), n).try_cast("int"))
    numbers = F.array_distinct(F.array_compact(F.concat(F.array(F.col("BASE_ROUTE_NUMBER").cast("int")), F.when(digits != "", starts).otherwise(F.array().cast("array<int>")))))
    asked = segments.select(id_, "HWY_NAME", "ROUTE_TYPE_GDOT", "BASE_ROUTE_NUMBER", F.explode(numbers).alias("_n"))
    met = asked.join(said.withColumn("_n", F.col("_d.number")), "_n")
    return met.where(designation_match(F.array("_d"), ["HWY_NAME", "ROUTE_TYPE_GDOT", "BASE_ROUTE_NUMBER"])).select(id_).distinct()


def hard_cap(matches: DataFrame, segments: DataFrame, id_: str, corridors: DataFrame, reach: float = 75.0) -> DataFrame:
    """Matches (id, corridors) of segments all of whose samples lie within ``reach`` of one of their corridors; without named ones of any corridor."""
    named = matches.select(id_, F.explode_outer("corridors").alias("_c")).withColumn("corridor", F.coalesce("_c", F.lit("*"))).drop("_c")
    lines = named.join(segments.select(id_, "line"), id_)
    every = corridors.select("corridor", "line").unionByName(corridors.select(F.lit("*").alias("corridor"), "line"))
    fine = near_share(lines, [id_, "corridor"], every, ["corridor"], reach).where(F.col("near") >= 1).select(id_).distinct()
    return matches.join(fine, id_, "left_semi")


def forced_flags(matches: DataFrame, segments: DataFrame, id_: str, corridors: DataFrame, rules: DataFrame, reach: float = 75.0, least: float = 0.70) -> DataFrame:
    """Matches (id, corridors, overlap_m, share) with those that ``rules`` (corridor, HWY_NAME, COUNTY_NAME) add where the segment lies along the corridor."""
    listed = segments.select(id_, "HWY_NAME", "COUNTY_NAME", "line").join(rules.distinct(), ["HWY_NAME", "COUNTY_NAME"])
    near = near_share(listed, [id_, "corridor"], corridors.select("corridor", "line"), ["corridor"], reach).where(F.col("near") >= least)
    added = near.groupBy(id_).agg(F.collect_set("corridor").alias("_more"))
    both = matches.withColumn("_known", F.lit(True)).join(added, id_, "full")
    none = F.array().cast("array<string>")
    names = F.array_sort(F.array_distinct(F.concat(F.coalesce("corridors", none), F.coalesce("_more", none))))
    return both.select(id_, names.alias("corridors"), F.coalesce("overlap_m", F.lit(0.0)).alias("overlap_m"), F.coalesce("share", F.lit(0.0)).alias("share"), F.when(F.col("_known"), "spatial").otherwise("concurrent_forced").alias("method"))


def split_flagged(segments: DataFrame, id_: str, ranges: DataFrame, whole: float = 0.90, sliver: float = 30.0, snap: float = 0.5) -> DataFrame:
    """Pieces of segments (from_mp, to_mp, line) inside and outside flagged ranges (from_m, to_m): ``flagged`` and ``piece``.

    A segment that lies inside for at least ``whole`` of its length stays whole. Gaps of at most
    ``snap`` metres are no piece; the first piece shorter than ``sliver`` joins the longer of its
    neighbours (the one before of equals), and so on until none is left. Milepoints follow the
    share of length.
    """
    merged = merge_intervals(ranges.select(id_, "from_m", "to_m"), [id_], snap)
    listed = merged.groupBy(id_).agg(F.array_sort(F.collect_list(F.struct(F.col("from_m").alias("a"), F.col("to_m").alias("b")))).alias("_r"))
    told = segments.join(listed, id_, "left").withColumn("_n", G.line_length(F.col("line")))
    clamped = F.filter(F.transform("_r", lambda r: F.struct(F.greatest(F.lit(0.0), r["a"]).alias("a"), F.least(F.col("_n"), r["b"]).alias("b"))), lambda r: r["b"] > r["a"])
    told = told.withColumn("_r", clamped).withColumn("_in", F.aggregate("_r", F.lit(0.0), lambda t, r: t + r["b"] - r["a"]))
    kind = "array<struct<a:double,b:double,f:boolean>>"

    def piece(a: Column, b: Column, f: bool) -> Column:
        return F.array(F.struct(a.alias("a"), b.alias("b"), F.lit(f).alias("f")))

    def step(state: Column, r: Column) -> Column:
        gap = F.when(r["a"] > state["at"] + snap, piece(state["at"], r["a"], False)).otherwise(F.array().cast(kind))
        return F.struct(r["b"].alias("at"), F.concat(state["out"], gap, piece(r["a"], r["b"], True)).alias("out"))

    def closed(state: Column) -> Column:
        return F.concat(state["out"], F.when(F.col("_n") > state["at"] + snap, piece(state["at"], F.col("_n"), False)).otherwise(F.array().cast(kind)))

    told = told.withColumn("_cut", F.aggregate("_r", F.struct(F.lit(0.0).alias("at"), F.array().cast(kind).alias("out")), step, closed))

    def absorb(out: Column, _: Column) -> Column:
        i = F.array_position(F.transform(out, lambda p: p["b"] - p["a"] < sliver), True).cast("int")
        n = F.size(out)
        own, last, after = F.get(out, i - 1), F.get(out, i - 2), F.get(out, i)
        before_m, after_m = F.when(i > 1, last["b"] - last["a"]).otherwise(-1.0), F.when(i < n, after["b"] - after["a"]).otherwise(-1.0)
        on = F.concat(F.slice(out, F.lit(1), i - 1), F.array(F.struct(own["a"].alias("a"), after["b"].alias("b"), after["f"].alias("f"))), F.slice(out, i + 2, n))
        back = F.concat(F.slice(out, F.lit(1), F.greatest(i - 2, F.lit(0))), F.array(F.struct(last["a"].alias("a"), own["b"].alias("b"), last["f"].alias("f"))), F.slice(out, i + 1, n))
        return F.when((i == 0) | (n <= 1), out).when(after_m > before_m, on).otherwise(back)

    told = told.withColumn("_cut", F.aggregate(F.sequence(F.lit(1), F.greatest(F.size("_cut"), F.lit(1))), F.col("_cut"), absorb))
    split = F.coalesce((F.size("_cut") > 1) & (F.col("_in") < whole * F.col("_n")), F.lit(False))
    one = F.array(F.struct(F.lit(0.0).alias("a"), F.col("_n").alias("b"), (F.coalesce(F.size("_r"), F.lit(0)) > 0).alias("f")))
    told = told.withColumn("_pieces", F.when(split, F.col("_cut")).otherwise(one)).withColumn("_whole", ~split).select("*", F.posexplode("_pieces").alias("piece", "_p"))
    span = F.col("to_mp") - F.col("from_mp")

    def at(x: Column, kept: str) -> Column:
        return F.when(F.col("_whole"), F.col(kept)).otherwise(round_even(F.col("from_mp") + span * x / F.col("_n"), 4))

    new = {"flagged": F.col("_p.f"), "line": F.when(F.col("_whole"), F.col("line")).otherwise(G.line_substring(F.col("line"), F.col("_p.a"), F.col("_p.b")))}
    new |= {"from_mp": at(F.col("_p.a"), "from_mp"), "to_mp": at(F.col("_p.b"), "to_mp")}
    return told.withColumns(new).select(*segments.columns, "piece", "flagged")


EVACUATION = ["SEC_EVAC", "SEC_EVAC_CONTRAFLOW", "SEC_EVAC_ROUTE_NAME", "SEC_EVAC_SOURCE", "SEC_EVAC_MATCH_METHOD", "SEC_EVAC_OVERLAP_M", "SEC_EVAC_OVERLAP_RATIO", "SEC_EVAC_MATCH_PORTION"]


def apply_evacuation(segments: DataFrame, routes: DataFrame, contraflow: DataFrame, id_: str = "unique_id") -> DataFrame:
    """Segments (ROUTE_ID, from_mp, to_mp, line, HWY_NAME, ROUTE_FAMILY) with the evacuation columns.

    Routes (id, ROUTE_NAME, line) are matched by corridor, contraflow routes (id, TITLE, line) on
    interstates. Flagged segments are cut where their corridors end; pieces outside lose
    everything. DEC rows then take over from the best-overlapping flagged INC row (0.01
    miles at least), and ids are built anew.
    """
    corridors = checkpointed(build_corridors(routes, "id", "ROUTE_NAME"))
    lines = segments.select(id_, "HWY_NAME", "ROUTE_FAMILY", "line")
    matches = match_corridors(lines, id_, corridors)
    evac = collapse_matches(matches, id_, lines, corridors)
    contra = contraflow_match(lines, id_, contraflow, "id", "TITLE").select(id_, F.col("names").alias("_titles"), F.col("overlap_m").alias("_co"), F.col("share").alias("_cs"))
    told = checkpointed(segments.join(evac, id_, "left").join(contra, id_, "left"))
    on, counter = F.col("overlap_m").isNotNull(), F.col("_co").isNotNull()
    none = F.array().cast("array<string>")
    names = F.array_sort(F.array_distinct(F.concat(F.coalesce("corridors", none), F.coalesce("_titles", none))))
    new = {
        "SEC_EVAC": on | counter, "SEC_EVAC_CONTRAFLOW": counter, "SEC_EVAC_ROUTE_NAME": F.when(F.size(names) > 0, F.array_join(names, "; ")),
        "SEC_EVAC_SOURCE": F.when(on, "gdot_eoc_hurricane_evacuation").when(counter, "gdot_eoc_contraflow"), "SEC_EVAC_MATCH_METHOD": F.when(on, "spatial"),
        "SEC_EVAC_OVERLAP_M": F.greatest(F.coalesce("overlap_m", F.lit(0.0)), F.coalesce("_co", F.lit(0.0))), "SEC_EVAC_OVERLAP_RATIO": F.greatest(F.coalesce("share", F.lit(0.0)), F.coalesce("_cs", F.lit(0.0))), "SEC_EVAC_MATCH_PORTION": F.col("portion"),
    }
    told = told.withColumns(new).drop("corridors", "overlap_m", "share", "portion", "_titles", "_co", "_cs")
    # stretches in reach: of the corridors matched, or of the contraflow routes where only these match
    partly = matched_ranges(matches, id_, lines, corridors).join(evac.where("portion < 1"), id_, "left_semi")
    only = told.where("SEC_EVAC_CONTRAFLOW and SEC_EVAC_MATCH_METHOD is null").select(id_, "line")
    flow = covered_ranges(only, id_, contraflow.select(F.lit("all").alias("corridor"), "line"), 15.0).select(id_, "from_m", "to_m")
    ranges = checkpointed(partly.unionByName(flow))
    cut = split_flagged(told.join(ranges.select(id_).distinct(), id_, "left_semi"), id_, ranges)
    cut = cut.withColumn("_same", F.count("*").over(Window.partitionBy(id_)) == 1)
    keep = F.col("_same") | F.col("flagged")
    empty = {"SEC_EVAC": F.lit(False), "SEC_EVAC_CONTRAFLOW": F.lit(False), "SEC_EVAC_OVERLAP_M": F.lit(0.0), "SEC_EVAC_OVERLAP_RATIO": F.lit(0.0)}
    cut = cut.withColumns({c: F.when(keep, F.col(c)).otherwise(empty.get(c, F.lit(None))) for c in EVACUATION}).drop("piece", "flagged", "_same")
    whole = checkpointed(told.join(ranges.select(id_).distinct(), id_, "left_anti").unionByName(cut))
    mirrored = direction_mirror(whole, EVACUATION, F.col("SEC_EVAC"), min_overlap=0.01).drop("mirrored")
    return mirrored.withColumn(id_, unique_id(F.col("ROUTE_ID"), F.col("from_mp"), F.col("to_mp")))


def corridor_qc(matches: DataFrame, corridors: DataFrame, few: int = 3) -> DataFrame:
    """Matched segments of each corridor, with ``none`` and ``few`` (fewer than 3) flags."""
    counts = matches.where("matched").groupBy("corridor").agg(F.count("*").alias("segments"))
    told = corridors.select("corridor").distinct().join(counts, "corridor", "left").na.fill(0, ["segments"])
    return told.withColumns({"none": F.col("segments") == 0, "few": (F.col("segments") > 0) & (F.col("segments") < few)})


def baseline_checks(flagged: DataFrame, baseline: dict[str, float], share: float = 0.30) -> DataFrame:
    """(name, passed, detail): rows of each flag column against a baseline, within ``share`` of it."""
    wide = flagged.agg(*[F.count_if(F.col(c)).alias(c) for c in baseline])
    each = [F.struct(F.lit(f"baseline_{c}").alias("name"), (F.abs(F.col(c) - n) <= share * n).alias("passed"), F.col(c).cast("string").alias("detail")) for c, n in baseline.items()]
    return wide.select(F.inline(F.array(*each)))


def official_tier(segments: DataFrame, id_: str, layers: DataFrame, tiers: list[str], reach: float = 50.0, least: float = 0.30, name: str = "official_tier") -> DataFrame:
    """Segments with the highest tier whose lines (tier, line) lie within ``reach`` of at least ``least`` of their length, else Unclassified."""
    near = length_within(segments.select(id_, "line"), id_, layers.select(F.col("tier").alias("corridor"), "line"), reach)
    told = near.join(segments.select(id_, G.line_length(F.col("line")).alias("_n")), id_).where((F.col("_n") > 0) & (F.col("overlap_m") >= least * F.col("_n")))
    best = told.groupBy(id_).agg(F.min(F.array_position(F.array(*map(F.lit, tiers)), F.col("corridor"))).alias("_t"))
    return segments.join(best, id_, "left").withColumn(name, F.coalesce(F.get(F.array(*map(F.lit, tiers)), (F.col("_t") - 1).cast("int")), F.lit("Unclassified"))).drop("_t")
