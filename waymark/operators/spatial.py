"""Spatial joins by grid cells: polygons, overlaps, distances, densities.

Both sides are cut into cells of a fixed size and meet by an equality join on the
cell, so no pair is looked at that doesn't share one, and a dense cell can be split
by adaptive execution. Lines and polygons are arrays (see ``functions.geometry``).
A polygon is known to a cell by the edges that pass it and by whether the cell's lower
left corner lies inside; cells within it carry no edges at all, so an outline's
vertices are copied to the cells they lie in and nowhere else.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.functions.scalars import round_even
from waymark.lineage import checkpointed
from waymark.operators.lines import measured_edges

METRES_PER_MILE = 1609.344


def _celled(df: DataFrame, cells: Column) -> DataFrame:
    return df.withColumn("_cell", F.explode(cells))


def _ends(e: Column) -> Column:
    return F.array(F.struct(e["ax"].alias("x"), e["ay"].alias("y")), F.struct(e["bx"].alias("x"), e["by"].alias("y")))


def _cell_of(p: Column, size: float) -> Column:
    return F.struct(F.floor(p["x"] / size).alias("cx"), F.floor(p["y"] / size).alias("cy"))


def polygon_cells(polygons: DataFrame, polygon: str, size: float) -> DataFrame:
    """(polygon, _cell, _in, _edges): cells that a polygon touches, whether their lower left corner is inside, and the edges that pass them (null if none)."""
    edges = polygons.select(polygon, F.explode(F.flatten(F.transform("rings", G.edges))).alias("_e"))
    e = F.col("_e")
    border = _celled(edges, G.line_cells(_ends(e), size)).groupBy(polygon, "_cell").agg(F.collect_list("_e").alias("_edges"))
    # where the lower sides of rows cross the outline; a corner is inside if an odd number lies beyond it
    low, high = F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])
    first, last = F.ceil(low / size), F.ceil(high / size) - 1
    rows = edges.where(last >= first).withColumn("_row", F.explode(F.sequence(first, last)))
    y = F.col("_row") * size
    at = e["ax"] + (y - e["ay"]) * (e["bx"] - e["ax"]) / (e["by"] - e["ay"])
    crossings = rows.select(polygon, F.col("_row"), at.alias("_x")).groupBy(polygon, "_row").agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("_xs") / 2) - 1), lambda i: F.struct(F.get(F.col("_xs"), (2 * i).cast("int")).alias("a"), F.get(F.col("_xs"), (2 * i + 1).cast("int")).alias("b")))
    spans = crossings.where(F.size("_xs") > 1).select(polygon, "_row", F.explode(pairs).alias("_p"))
    inner = spans.where(F.ceil(F.col("_p.a") / size) * size < F.col("_p.b"))
    inner = inner.withColumn("_cx", F.explode(F.sequence(F.ceil(F.col("_p.a") / size), F.ceil(F.col("_p.b") / size) - 1)))
    inner = inner.select(polygon, F.struct(F.col("_cx").alias("cx"), F.col("_row").alias("cy")).alias("_cell"), F.lit(True).alias("_in"))
    both = border.join(inner, [polygon, "_cell"], "full")
    return both.select(polygon, "_cell", F.coalesce("_in", F.lit(False)).alias("_in"), "_edges")


def _inside(x: Column, y: Column, size: float) -> Column:
    """Whether a point of a cell lies in the cell's polygon: the way from its corner along its lower side and up crosses the outline an even number of times, or the point lies on it."""
    x0, y0 = F.col("_cell.cx") * size, F.col("_cell.cy") * size
    edges = F.coalesce("_edges", F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>"))

    # the way runs a trifle above the lower side and, by far more, to the right of the point; where it turns, one sign tells the side of an edge for both its legs
    def turn(e: Column) -> Column:
        return (e["bx"] - e["ax"]) * (y0 - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])

    def across(e: Column) -> Column:
        over = (e["ay"] > y0) != (e["by"] > y0)
        at = e["ax"] + (y0 - e["ay"]) * (e["bx"] - e["ax"]) / F.when(over, e["by"] - e["ay"]).otherwise(1.0)
        beyond = F.when(e["by"] > e["ay"], turn(e) > 0).otherwise(turn(e) < 0)
        return (over & ((at > x0) != beyond)).cast("int")

    def up(e: Column) -> Column:
        over = (e["ax"] > x) != (e["bx"] > x)
        at = e["ay"] + (x - e["ax"]) * (e["by"] - e["ay"]) / F.when(over, e["bx"] - e["ax"]).otherwise(1.0)
        rises = (e["bx"] > e["ax"]) == (e["by"] > e["ay"])
        above = F.when(turn(e) == 0, rises & (e["by"] != e["ay"])).when(e["bx"] > e["ax"], turn(e) < 0).otherwise(turn(e) > 0)
        return (over & (above != (at > y))).cast("int")

    def touches(e: Column) -> Column:
        t = G._edge_project(e, x, y)
        return F.hypot(e["ax"] + t * (e["bx"] - e["ax"]) - x, e["ay"] + t * (e["by"] - e["ay"]) - y) < 1e-9

    turns = F.aggregate(edges, F.lit(0), lambda n, e: n + across(e) + up(e))
    return F.exists(edges, touches) | (F.col("_in") != (turns % 2 == 1))


def point_in_polygon(points: DataFrame, id_: str, polygons: DataFrame, polygon: str, size: float) -> DataFrame:
    """(id, polygon) of the first polygon, in order of its id, that holds each point (``p``); all points come out."""
    near = points.select(id_, "p", _cell_of(F.col("p"), size).alias("_cell")).join(polygon_cells(polygons, polygon, size), "_cell")
    hit = near.where(_inside(F.col("p.x"), F.col("p.y"), size)).groupBy(id_).agg(F.min(polygon).alias(polygon))
    return points.select(id_).join(hit, id_, "left")


def stamp(segments: DataFrame, id_: str, layers: dict[str, tuple[DataFrame, str, float]]) -> DataFrame:
    """Segments (line) with the polygon of each layer (polygons, key, cell size) that holds their midpoint."""
    points = segments.select(id_, G.line_interpolate(F.col("line"), 0.5).alias("p"))
    for name, (polygons, key, size) in layers.items():
        segments = segments.join(point_in_polygon(points, id_, polygons, key, size).withColumnRenamed(key, name), id_, "left")
    return segments


def inside_lengths(lines: DataFrame, id_: str, polygons: DataFrame, polygon: str, size: float) -> DataFrame:
    """(id, polygon, inside): length of each line within each polygon.

    Each edge is cut at the borders of cells and, within a cell, where it meets the outline;
    a part counts if its midpoint lies inside.
    """
    edge = lines.select(id_, F.explode(G.edges(F.col("line"))).alias("_l"))
    edge = _celled(edge, G.line_cells(_ends(F.col("_l")), size))
    e = F.col("_l")

    def span(a: str, b: str, c: str) -> tuple[Column, Column]:
        lo, by = F.col(f"_cell.{c}") * size, e[b] - e[a]
        p, q = (lo - e[a]) / F.nullif(by, F.lit(0.0)), (lo + size - e[a]) / F.nullif(by, F.lit(0.0))
        within = (e[a] >= lo) & (e[a] < lo + size)
        return F.coalesce(F.least(p, q), F.when(within, 0.0).otherwise(2.0)), F.coalesce(F.greatest(p, q), F.when(within, 1.0).otherwise(-1.0))

    (p, q), (r, s) = span("ax", "bx", "cx"), span("ay", "by", "cy")
    edge = edge.withColumns({"_t0": F.greatest(F.lit(0.0), p, r), "_t1": F.least(F.lit(1.0), q, s)}).where("_t1 > _t0")
    near = edge.join(polygon_cells(polygons, polygon, size), "_cell")
    hits = F.filter(F.transform(F.coalesce("_edges", F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>")), lambda b: G.edge_crossings(e, b)), lambda t: (t > F.col("_t0")) & (t < F.col("_t1")))
    near = near.withColumn("_cuts", F.array_sort(F.array_distinct(F.concat(F.array("_t0", "_t1"), hits))))
    n = F.size("_cuts") - 1
    parts = F.zip_with(F.slice("_cuts", F.lit(1), n), F.slice("_cuts", F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    near = near.select(id_, polygon, "_cell", "_in", "_edges", "_l", F.explode(parts).alias("_p"))
    m = (F.col("_p.a") + F.col("_p.b")) / 2
    x, y = e["ax"] + m * (e["bx"] - e["ax"]), e["ay"] + m * (e["by"] - e["ay"])
    # between its ends' coordinates: shares of a length would bring a rounding error for each cell
    (x0, y0), (x1, y1) = [(e["ax"] + t * (e["bx"] - e["ax"]), e["ay"] + t * (e["by"] - e["ay"])) for t in (F.col("_p.a"), F.col("_p.b"))]
    length = F.hypot(x1 - x0, y1 - y0)
    held = near.where(_inside(x, y, size)).select(id_, polygon, length.alias("inside"))
    return held.groupBy(id_, polygon).agg(F.sum("inside").alias("inside")).where("inside > 0")


def overlay_winner(lines: DataFrame, id_: str, polygons: DataFrame, polygon: str, size: float) -> DataFrame:
    """The polygon that holds most of each line (ties: the smaller id), that length and its share of all held length; all lines come out."""
    found = inside_lengths(lines, id_, polygons, polygon, size)
    best = found.groupBy(id_).agg(F.min_by(F.struct(polygon, "inside"), F.struct(-F.col("inside"), F.col(polygon))).alias("_b"), F.sum("inside").alias("_all"))
    best = best.select(id_, F.col(f"_b.{polygon}").alias(polygon), F.col("_b.inside").alias("inside"), (F.col("_b.inside") / F.col("_all")).alias("share"))
    return lines.select(id_).join(best, id_, "left")


def admin_overlay(segments: DataFrame, id_: str, layers: dict[str, tuple[DataFrame, str, float]], city: str | None = None, least: float = 0.50, narrow: float = 0.51) -> DataFrame:
    """Segments (line) with the winning polygon of each layer; the layer ``city`` counts only where it holds ``least`` of the segment.

    ``<layer>_borderline`` says whether the winner's share of all held length is at most ``narrow``.
    """
    for name, (polygons, key, size) in layers.items():
        won = overlay_winner(segments, id_, polygons, key, size)
        told = won.join(segments.select(id_, G.line_length(F.col("line")).alias("_n")), id_)
        taken = F.col(key)
        if name == city:
            taken = F.when(F.col("inside") >= least * F.col("_n"), taken)
        told = told.select(id_, taken.alias(name), (taken.isNotNull() & (F.col("share") <= narrow)).alias(f"{name}_borderline"))
        segments = segments.join(told, id_, "left")
    return segments


def overlap_list(lines: DataFrame, id_: str, polygons: DataFrame, polygon: str, name: str, size: float, leading: str | None = None, least: float = 0.01) -> DataFrame:
    """(id, names): polygons with at least ``least`` of each line's length, largest share first (then id), as one comma-separated text.

    A line's ``leading`` name comes first. Names are told apart without regard to case, the
    first spelling stays; blank names don't count. Lines without any have null.
    """
    found = inside_lengths(lines, id_, polygons, polygon, size).where("inside > 1e-4")
    lengths = lines.select(id_, G.line_length(F.col("line")).alias("_n"), (F.nullif(F.trim(leading), F.lit("")) if leading else F.lit(None).cast("string")).alias("_first"))
    told = found.join(lengths.drop("_first"), id_).join(polygons.select(polygon, F.nullif(F.trim(name), F.lit("")).alias("_name")), polygon)
    told = told.where(F.col("_name").isNotNull() & (F.col("inside") >= least * F.col("_n")))
    listed = told.groupBy(id_).agg(F.array_sort(F.collect_list(F.struct((-F.col("inside") / F.col("_n")).alias("s"), F.col(polygon).alias("p"), F.col("_name").alias("n")))).alias("_l"))
    every = lengths.join(listed, id_, "left")
    names = F.array_compact(F.concat(F.array("_first"), F.coalesce(F.transform("_l", lambda x: x["n"]), F.array().cast("array<string>"))))
    every = every.withColumn("_names", names)
    lower = F.transform("_names", lambda x: F.lower(x))
    once = F.filter("_names", lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)
    return every.select(id_, F.nullif(F.array_join(once, ", "), F.lit("")).alias("names"))


def boundary_crossings(routes: DataFrame, key: str, polygons: DataFrame, size: float) -> DataFrame:
    """(key, mp) where routes (key, from_mp, to_mp, line) meet polygon rings, by share of length; four decimals.

    A stretch along a border gives both its ends.
    """
    measured = measured_edges(routes, [key, "from_mp", "to_mp"])
    border = polygons.select(F.explode(F.flatten(F.transform("rings", G.edges))).alias("_b"))
    near = _celled(measured, G.line_cells(_ends(F.col("_e")), size)).join(_celled(border, G.line_cells(_ends(F.col("_b")), size)), "_cell")
    near = near.withColumn("_t", F.explode(G.edge_meetings(F.col("_e"), F.col("_b"))))
    # an edge's share of the length first: that of a line's only edge is 1, so its meetings are not rounded again
    share = F.col("_at") / F.col("_total") + F.col("_t") * (F.col("_len") / F.col("_total"))
    mp = F.col("from_mp") + (F.col("to_mp") - F.col("from_mp")) * share
    return near.select(key, round_even(mp, 4).alias("mp")).where("mp is not null").distinct()


def _distance_edges(df: DataFrame, columns: list[str], size: float, reach: float, name: str) -> DataFrame:
    """Edges of lines in the cells within ``reach`` of them; a single vertex is an edge without length."""
    line = F.when(F.size("line") == 1, F.concat("line", "line")).otherwise(F.col("line"))
    edge = df.select(*columns, F.explode(G.edges(line)).alias(name))
    return _celled(edge, G.line_cells(_ends(F.col(name)), size, reach))


#: rows of a side that is broadcast at most; they are counted
_FEW = 100_000


def _meeting(many: DataFrame, others: DataFrame, on: str | list[str], rows: int | None = None) -> DataFrame:
    """Inner join that broadcasts ``others`` if they have few rows (counted, unless ``rows`` says), and ``many`` never.

    The planner takes a row that is exploded to its cells for one row, and would broadcast either side.
    """
    rows = others.count() if rows is None else rows
    return many.join(F.broadcast(others) if rows <= _FEW else others.hint("merge"), on)


def _within(lines: DataFrame, columns: list[str], others: DataFrame, other: list[str], radius: float, size: float | None) -> DataFrame:
    size = size or max(radius, 1.0)
    a, b = _distance_edges(lines, columns, size, radius, "_x"), _distance_edges(others, other, size, 0.0, "_y")
    return _near_edges(_meeting(a, b, "_cell"), radius)


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a key to at least as many tasks as there are cores: pairs are many where rows are few."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def _near_edges(pairs: DataFrame, radius: float) -> DataFrame:
    """Pairs of edges (_x, _y) within the radius: their boxes first, then the edges themselves."""

    @F.pandas_udf("boolean")
    def within(ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series, cx: pd.Series, cy: pd.Series, dx: pd.Series, dy: pd.Series) -> pd.Series:
        ax, ay, bx, by, cx, cy, dx, dy = (s.to_numpy() for s in (ax, ay, bx, by, cx, cy, dx, dy))

        def to_edge(px, py, qx, qy, rx, ry):
            vx, vy = rx - qx, ry - qy
            n = vx * vx + vy * vy
            share = np.where(n > 0, np.clip(((px - qx) * vx + (py - qy) * vy) / np.where(n > 0, n, 1.0), 0.0, 1.0), 0.0)
            return np.hypot(qx + share * vx - px, qy + share * vy - py)

        gap = np.minimum(np.minimum(to_edge(ax, ay, cx, cy, dx, dy), to_edge(bx, by, cx, cy, dx, dy)), np.minimum(to_edge(cx, cy, ax, ay, bx, by), to_edge(dx, dy, ax, ay, bx, by)))
        ux, uy, vx, vy, wx, wy = bx - ax, by - ay, dx - cx, dy - cy, cx - ax, cy - ay
        cross = ux * vy - uy * vx
        t, s = (a / np.where(cross != 0, cross, np.nan) for a in (wx * vy - wy * vx, wx * uy - wy * ux))
        return pd.Series((gap <= radius) | ((t >= 0) & (t <= 1) & (s >= 0) & (s <= 1)))

    x, y = F.col("_x"), F.col("_y")

    def apart(a: str, b: str) -> Column:
        return F.greatest(F.least(x[a], x[b]) - F.greatest(y[a], y[b]), F.least(y[a], y[b]) - F.greatest(x[a], x[b]), F.lit(0.0))

    across, up = apart("ax", "bx"), apart("ay", "by")
    boxes = pairs.where(across * across + up * up <= radius * radius * (1 + 1e-9))
    return boxes.where(within(*[e[c] for e in (x, y) for c in ("ax", "ay", "bx", "by")]))


def _held_cell(e: Column, size: float, radius: float) -> Column:
    """Whether the row's cell (_cell) lies within the radius of an end of an edge, so that whatever has a point in it is near."""
    x0, y0 = F.col("_cell.cx") * size, F.col("_cell.cy") * size

    def far(px: Column, py: Column) -> Column:
        across, up = F.greatest(F.abs(x0 - px), F.abs(x0 + size - px)), F.greatest(F.abs(y0 - py), F.abs(y0 + size - py))
        return across * across + up * up

    return F.least(far(e["ax"], e["ay"]), far(e["bx"], e["by"])) <= radius * radius * (1 - 1e-9)


def within_distance(lines: DataFrame, id_: str, others: DataFrame, other: str, radius: float, size: float | None = None) -> DataFrame:
    """Distinct (id, other) of lines and points or lines (``line``) within ``radius``, edge by edge."""
    a, b = _dealt(lines.select(F.col(id_).alias("_a"), "line"), "_a"), others.select(F.col(other).alias("_o"), "line")
    return _within(a, ["_a"], b, ["_o"], radius, size).select(F.col("_a").alias(id_), F.col("_o").alias(other)).distinct()


def within_flag(lines: DataFrame, id_: str, others: DataFrame, other: str, radius: float, flag: str) -> DataFrame:
    """``lines`` with whether anything of ``others`` lies within the radius."""
    near = within_distance(lines, id_, others.withColumnRenamed(other, "_near"), "_near", radius).select(id_).distinct().withColumn(flag, F.lit(True))
    return lines.join(near, id_, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def corridor_near_flag(segments: DataFrame, id_: str, corridors: DataFrame, corridor: str, kind: str = "ROUTE_TYPE_GDOT", radius: float = 50.0, flag: str = "IS_GRIP_CORRIDOR") -> DataFrame:
    """Segments with whether a corridor lies within the radius; county roads and city streets have false."""
    told = within_flag(segments, id_, corridors, corridor, radius, flag)
    return told.withColumn(flag, F.col(flag) & ~F.coalesce(F.col(kind).isin("CR", "CS"), F.lit(False)))


def zone_flag(segments: DataFrame, id_: str, sites: DataFrame, name: str, radius: float = 16_093.44, kind: str = "ROUTE_TYPE_GDOT") -> DataFrame:
    """IS_NUCLEAR_EPZ_ROUTE and NUCLEAR_EPZ_PLANT: sites (name, line of one point) within the radius, names joined; local roads have none.

    Sites at the same place meet segments once, and bring their names together.
    """
    able = segments.where(~F.coalesce(F.col(kind).isin("CR", "CS"), F.lit(False)))
    places = checkpointed(sites.groupBy("line").agg(F.collect_set(name).alias("_names")).withColumn("_place", F.monotonically_increasing_id()))
    names = places.agg(F.sum(F.size("_names") + 1)).first()[0] or 0
    near = _meeting(within_distance(able, id_, places, "_place", radius), places.select("_place", "_names"), "_place", names)
    near = near.groupBy(id_).agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_names")))), "; ").alias("NUCLEAR_EPZ_PLANT"))
    return segments.join(near, id_, "left").withColumn("IS_NUCLEAR_EPZ_ROUTE", F.col("NUCLEAR_EPZ_PLANT").isNotNull())


def buffer_counts(lines: DataFrame, id_: str, layers: DataFrame, radius: float, names: list[str]) -> DataFrame:
    """Objects (layer, object_id, line) within the radius of each line by layer, in total, and per square mile of the line's buffer.

    Objects of one short edge or point, equal ones together, have one cell; a cell that lies
    within the radius as a whole brings its count, and only objects of cells that the
    radius passes through are compared one by one, as are objects of several edges or cells.
    """
    size = max(radius / 4, 1.0)

    def edged(line: str) -> Column:
        return G.edges(F.when(F.size(line) == 1, F.concat(line, line)).otherwise(F.col(line)))

    objects = layers.groupBy("layer", "object_id").agg(F.array_distinct(F.flatten(F.collect_list(edged("line")))).alias("_es"))
    objects = checkpointed(objects.withColumns({"_y": F.get("_es", 0), "_cells": F.array_distinct(F.flatten(F.transform("_es", lambda e: G.line_cells(_ends(e), size))))}))
    small = (F.size("_es") == 1) & (F.size("_cells") == 1)
    places = objects.where(small).groupBy("layer", F.get("_cells", 0).alias("_cell"), "_y").agg(F.count("*").alias("_n"))
    counts = places.groupBy("layer", "_cell").agg(F.sum("_n").alias("_n"))
    wide = objects.where(~small).select(F.struct("layer", "object_id").alias("_key"), F.explode("_es").alias("_y"))
    wide = _celled(wide, G.line_cells(_ends(F.col("_y")), size))
    shapes = _dealt(lines.select(id_, "line"), id_).groupBy(id_).agg(F.array_distinct(F.flatten(F.collect_list(edged("line")))).alias("_es"))
    edges = shapes.select(id_, (F.size("_es") == 1).alias("_one"), F.explode("_es").alias("_x"))
    edges = _celled(edges, G.line_cells(_ends(F.col("_x")), size, radius)).withColumn("_held", _held_cell(F.col("_x"), size, radius))
    one, many = edges.where("_one"), edges.where("not _one")
    # a cell is held by a line if any of its edges holds it
    held = many.groupBy(id_, "_cell").agg(F.max("_held").alias("_held"), F.collect_list("_x").alias("_xs"))
    whole = _meeting(one.where("_held").select(id_, "_cell").unionByName(held.where("_held").select(id_, "_cell")), counts, "_cell").groupBy(id_, "layer").agg(F.sum("_n").alias("_n"))
    seen = places.count()
    passed = _near_edges(_meeting(one.where("not _held"), places, "_cell", seen), radius).groupBy(id_, "layer").agg(F.sum("_n").alias("_n"))
    rest = held.where("not _held").select(id_, "_cell", F.explode("_xs").alias("_x"))
    rest = _near_edges(_meeting(rest, places, "_cell", seen), radius).select(id_, "layer", "_y", "_n").distinct().groupBy(id_, "layer").agg(F.sum("_n").alias("_n"))
    others = _near_edges(_meeting(edges.select(id_, "_cell", "_x"), wide, "_cell"), radius).select(id_, "_key").distinct().groupBy(id_, F.col("_key.layer").alias("layer")).agg(F.count("*").alias("_n"))
    near = reduce(DataFrame.unionByName, (whole, passed, rest, others)).groupBy(id_).agg(*[F.sum(F.when(F.col("layer") == n, F.col("_n")).otherwise(0)).alias(n) for n in names])
    told = lines.select(id_, G.line_length(F.col("line")).alias("_n")).join(near, id_, "left").na.fill(0, names)
    total = sum(F.col(f"`{n}`") for n in names)
    area = (2 * radius * F.col("_n") + F.lit(3.141592653589793) * radius * radius) / (1609.34**2)
    return told.withColumn("total", total).withColumn("per_sq_mi", total / area).drop("_n")


def degrees_of_connection(segments: DataFrame, id_: str, name: str, radius: float = 1609.34) -> DataFrame:
    """Distinct other names within the radius of each segment.

    Cells that lie within the radius as a whole settle the names that have a vertex in
    them; only for names that are not settled so edges are compared, equal ones once.
    """
    size = max(radius / 2, 1.0)
    other = segments.where(F.col(name).isNotNull()).select(F.col(name).alias("_name"), "line")
    vertices = other.select("_name", F.explode("line").alias("_p")).select("_name", _cell_of(F.col("_p"), size).alias("_cell")).distinct()
    line = F.when(F.size("line") == 1, F.concat("line", "line")).otherwise(F.col("line"))
    pieces = other.select("_name", F.explode(G.edges(line)).alias("_y")).distinct()
    pieces = _celled(pieces, G.line_cells(_ends(F.col("_y")), size))
    lines = _dealt(segments.select(F.col(id_).alias("_id"), F.col(name).alias("_own"), "line"), "_id")
    edges = _distance_edges(lines, ["_id", "_own"], size, radius, "_x").withColumn("_held", _held_cell(F.col("_x"), size, radius))
    settled = _meeting(edges.where("_held"), vertices, "_cell").where("_name <> _own").groupBy("_id", "_own").agg(F.collect_set("_name").alias("_names"))
    settled = checkpointed(settled)
    open_edges = _distance_edges(lines.join(settled, ["_id", "_own"], "left"), ["_id", "_own", "_names"], size, radius, "_x").where(~_held_cell(F.col("_x"), size, radius))
    unsettled = _meeting(open_edges, pieces.select("_cell", "_name").distinct(), "_cell").where((F.col("_name") != F.col("_own")) & ~F.coalesce(F.array_contains("_names", F.col("_name")), F.lit(False)))
    met = _near_edges(_meeting(unsettled.select("_id", "_own", "_x", "_cell", "_name"), pieces, ["_cell", "_name"]), radius).select("_id", "_own", "_name").distinct()
    met = met.unionByName(settled.select("_id", "_own", F.explode("_names").alias("_name"))).select("_id", "_name").distinct()
    counts = met.groupBy("_id").agg(F.count("*").alias("connections"))
    return segments.select(id_).join(counts.withColumnRenamed("_id", id_), id_, "left").na.fill(0, ["connections"])


def connectivity_metrics(segments: DataFrame, id_: str, name: str, layers: DataFrame, names: list[str], priority: DataFrame, route: str, weights: dict[str, float] | None = None) -> DataFrame:
    """connections, generators, per_sq_mi, near_priority and their weighted score."""
    from waymark.operators.reports import min_max_score

    # each part is planned and run by itself: the score reads them twice, and the driver would hold all their joins twice over
    told = checkpointed(degrees_of_connection(segments, id_, name))
    told = checkpointed(told.join(buffer_counts(segments, id_, layers, 5 * 1609.34, names).select(id_, F.col("total").alias("generators"), "per_sq_mi"), id_))
    flag = within_flag(segments.select(id_, "line"), id_, priority, route, 150.0, "near_priority").drop("line")
    # the bounds of the score need no flag, and of the join only the ids, which would be broadcast
    return min_max_score(told.join(flag.hint("merge"), id_), weights or {"connections": 0.25, "generators": 0.25, "near_priority": 0.50})


def _closed(pieces: pd.DataFrame) -> list[list[dict]]:
    """Rings from the pieces (px, py, qx, qy) of an outline; vertices on a straight stretch go."""
    near: dict[tuple, list] = {}
    for a, b in zip(zip(pieces["px"], pieces["py"]), zip(pieces["qx"], pieces["qy"])):
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    rings = []
    for start in sorted(near):
        while near[start]:
            ring, node = [start], start
            while near[node]:
                last, node = node, near[node].pop()
                near[node].remove(last)
                ring.append(node)
                if node == start:
                    break
            kept = ring[:1]
            for p, q in zip(ring[1:], ring[2:]):
                (ax, ay), (bx, by), (cx, cy) = kept[-1], p, q
                if abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax)) > 1e-9 * ((cx - ax) ** 2 + (cy - ay) ** 2):
                    kept.append(p)
            rings.append([{"x": x, "y": y} for x, y in [*kept, ring[-1]]])
    return rings


def dissolve(polygons: DataFrame, key: str, size: float | None = None) -> DataFrame:
    """(key, rings): the union of all polygons (rows of key and rings) of each key.

    A place is inside if any polygon of the key holds it. Outlines are cut where they meet
    those of the key's other polygons; a piece stays if the key holds one side of it and not
    the other, both looked up a millimetre beside its middle, so gaps and overlaps narrower
    than that don't count. All meetings are joins on key and grid cell (``size`` wide; if
    unset, twice an average edge). The pieces of a key are closed to rings in one task: they
    are a row in the end. Coordinates are rounded to a micrometre. A null key is a key; rows
    without rings have no part; a key without area has empty rings.
    """
    point = "struct<x:double,y:double>"
    rounded = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct(F.bround(p["x"], 6).alias("x"), F.bround(p["y"], 6).alias("y"))))
    parts = checkpointed(polygons.select(F.struct(F.col(key).alias("key")).alias("_key"), rounded.alias("rings"), F.monotonically_increasing_id().alias("_part")))
    edges = checkpointed(parts.select("_key", "_part", F.explode(F.flatten(F.transform("rings", G.edges))).alias("_e")).where("_e.ax <> _e.bx or _e.ay <> _e.by"))
    if size is None:
        size = max(1.0, 2 * (edges.agg(F.avg(F.greatest(F.abs(F.col("_e.bx") - F.col("_e.ax")), F.abs(F.col("_e.by") - F.col("_e.ay"))))).first()[0] or 0.0))
    celled = _celled(edges, G.line_cells(_ends(F.col("_e")), size))
    other = celled.select("_key", "_cell", F.col("_part").alias("_q"), F.col("_e").alias("_f"))
    met = celled.join(other, ["_key", "_cell"]).where(F.col("_part") < F.col("_q"))
    e = F.col("_e")
    spot = F.transform(G.edge_meetings(e, F.col("_f")), lambda t: F.struct(F.bround(e["ax"] + t * (e["bx"] - e["ax"]), 6).alias("x"), F.bround(e["ay"] + t * (e["by"] - e["ay"]), 6).alias("y")))
    met = met.select("_key", "_part", "_e", "_q", "_f", F.explode(spot).alias("_s"))
    both = F.array(F.struct("_part", "_e", "_s"), F.struct(F.col("_q").alias("_part"), F.col("_f").alias("_e"), "_s"))
    cuts = met.select("_key", F.inline(both)).groupBy("_key", "_part", "_e").agg(F.collect_set("_s").alias("_s"))
    told = edges.distinct().join(cuts, ["_key", "_part", "_e"], "left")
    inner = F.transform(F.coalesce("_s", F.array().cast(f"array<{point}>")), lambda s: F.struct(G._edge_project(e, s["x"], s["y"]).alias("t"), s.alias("s")))
    path = F.concat(F.array(F.struct(e["ax"].alias("x"), e["ay"].alias("y"))), F.transform(F.array_sort(inner), lambda s: s["s"]), F.array(F.struct(e["bx"].alias("x"), e["by"].alias("y"))))
    pieces = told.select("_key", F.explode(G.edges(path)).alias("_e")).where("_e.ax <> _e.bx or _e.ay <> _e.by")
    p, q = F.struct(F.col("_e.ax").alias("x"), F.col("_e.ay").alias("y")), F.struct(F.col("_e.bx").alias("x"), F.col("_e.by").alias("y"))
    pieces = checkpointed(pieces.select("_key", F.least(p, q).alias("_p"), F.greatest(p, q).alias("_q")).distinct())
    flat = F.struct(F.col("_p.x").alias("ax"), F.col("_p.y").alias("ay"), F.col("_q.x").alias("bx"), F.col("_q.y").alias("by"))
    beside = F.array(*[F.struct(F.lit(s).alias("side"), _beside(flat, s).alias("p")) for s in (-1, 1)])
    asked = pieces.select("_key", "_p", "_q", F.inline(beside)).withColumn("_cell", _cell_of(F.col("p"), size))
    whole = parts.select(F.struct("_key", "_part").alias("_id"), "rings")
    shapes = polygon_cells(whole, "_id", size).withColumn("_key", F.col("_id._key"))
    held = asked.join(shapes, ["_key", "_cell"]).where(_inside(F.col("p.x"), F.col("p.y"), size)).select("_key", "_p", "_q", "side").distinct()
    border = held.groupBy("_key", "_p", "_q").agg(F.count("*").alias("_sides")).where("_sides = 1")
    flat = border.select(F.to_json("_key").alias("k"), F.col("_p.x").alias("px"), F.col("_p.y").alias("py"), F.col("_q.x").alias("qx"), F.col("_q.y").alias("qy"))
    rings = flat.groupBy("k").applyInPandas(lambda f: pd.DataFrame({"k": [f["k"].iloc[0]], "rings": [_closed(f)]}), f"k string, rings array<array<{point}>>")
    keys = parts.select("_key", F.to_json("_key").alias("k")).distinct()
    return keys.join(rings, "k", "left").select(F.col("_key.key").alias(key), F.coalesce("rings", F.array().cast(f"array<array<{point}>>")).alias("rings"))


def polygons_meeting(polygons: DataFrame, polygon: str, others: DataFrame, other: str, size: float) -> DataFrame:
    """Distinct (polygon, other) of two layers (id, rings) that have a point in common: outlines that meet, or a vertex of one in the other."""
    edges = [_celled(df.select(F.col(i).alias(n), F.explode(F.flatten(F.transform("rings", G.edges))).alias(e)), G.line_cells(_ends(F.col(e)), size)) for df, i, n, e in ((polygons, polygon, "_a", "_x"), (others, other, "_b", "_y"))]
    crossed = edges[0].join(edges[1], "_cell").where(G.edge_distance(F.col("_x"), F.col("_y")) <= 1e-9).select("_a", "_b")

    def holders(points: DataFrame, i: str, n: str, shapes: DataFrame, j: str, m: str) -> DataFrame:
        # one vertex of each ring is enough: where outlines don't meet, a ring lies wholly in or out
        first = points.select(F.col(i).alias(n), F.explode(F.transform(F.filter("rings", lambda r: F.size(r) > 0), lambda r: r[0])).alias("p"))
        near = first.withColumn("_cell", _cell_of(F.col("p"), size)).join(polygon_cells(shapes.select(F.col(j).alias(m), "rings"), m, size), "_cell")
        return near.where(_inside(F.col("p.x"), F.col("p.y"), size)).select("_a", "_b")

    within = holders(polygons, polygon, "_a", others, other, "_b").unionByName(holders(others, other, "_b", polygons, polygon, "_a"))
    return crossed.unionByName(within).distinct().select(F.col("_a").alias(polygon), F.col("_b").alias(other))


def nearest_polygon(points: DataFrame, id_: str, polygons: DataFrame, polygon: str, size: float) -> DataFrame:
    """(id, polygon) with the nearest outline to each point (``p``), ties to the smaller id.

    Points meet edges of their cell and those around it, in cells that grow until each has
    found one no farther than a cell is wide. Points without finite coordinates don't come out,
    nor do edges without them take part.
    """
    finite = F.greatest(*[F.abs(F.col(f"_e.{c}")) for c in ("ax", "ay", "bx", "by")]) < float("inf")
    edges = checkpointed(polygons.select(polygon, F.explode(F.flatten(F.transform("rings", G.edges))).alias("_e")).where(finite))
    placed = (F.abs(F.col("p.x")) < float("inf")) & (F.abs(F.col("p.y")) < float("inf"))
    rest, done = points.select(id_, "p").where(placed), None
    if edges.isEmpty():
        return rest.select(id_, F.lit(None).cast(polygons.schema[polygon].dataType).alias(polygon))
    around = F.expr("flatten(transform(sequence(-1, 1), i -> transform(sequence(-1, 1), j -> struct(i, j))))")
    while True:
        cells = F.transform(around, lambda o: F.struct((F.floor(F.col("p.x") / size) + o["i"]).alias("cx"), (F.floor(F.col("p.y") / size) + o["j"]).alias("cy")))
        near = _celled(rest, cells).join(_celled(edges, G.line_cells(_ends(F.col("_e")), size)), "_cell")
        t = G._edge_project(F.col("_e"), F.col("p.x"), F.col("p.y"))
        d = F.hypot(F.col("_e.ax") + t * (F.col("_e.bx") - F.col("_e.ax")) - F.col("p.x"), F.col("_e.ay") + t * (F.col("_e.by") - F.col("_e.ay")) - F.col("p.y"))
        best = near.groupBy(id_).agg(F.min(F.struct(d.alias("d"), F.col(polygon).alias("k"))).alias("_b"))
        told = checkpointed(rest.join(best, id_, "left").withColumn("_final", F.coalesce(F.col("_b.d") <= size, F.lit(False))))
        ready = told.where("_final").select(id_, F.col("_b.k").alias(polygon))
        done = ready if done is None else done.unionByName(ready)
        rest = told.where("not _final").select(id_, "p")
        size *= 4
        if rest.isEmpty():
            return done


def county_backfill(segments: DataFrame, id_: str, counties: DataFrame, size: float, county: str = "COUNTY_CODE", district: str = "DISTRICT") -> DataFrame:
    """Null or 000 counties and null districts of segments (line) from counties (code, district, rings).

    County 000 takes the county that holds most of it and, summed separately, the district
    that does; other rows the county of their midpoint, or the nearest one. Only what is
    missing is filled.
    """
    whole = F.coalesce(F.col(county) == "000", F.lit(False))
    lines = segments.where(whole & F.col("line").isNotNull())
    held = checkpointed(inside_lengths(lines, id_, counties, "code", size).join(counties.select("code", "district"), "code"))
    most = held.groupBy(id_).agg(F.min_by("code", F.struct(-F.col("inside"), F.col("code"))).alias("_county"))
    by_district = held.where("district is not null").groupBy(id_, "district").agg(F.sum("inside").alias("inside"))
    by_district = by_district.groupBy(id_).agg(F.min_by("district", F.struct(-F.col("inside"), F.col("district"))).alias("_district"))
    open_rows = segments.where(~whole & (F.col(county).isNull() | F.col(district).isNull()))
    points = open_rows.select(id_, G.line_interpolate(F.col("line"), 0.5).alias("p"))
    stamped = checkpointed(point_in_polygon(points, id_, counties, "code", size))
    missing = points.join(stamped.where("code is null").select(id_), id_, "left_semi")
    near = stamped.where("code is not null").unionByName(nearest_polygon(missing, id_, counties, "code", size))
    near = near.join(counties.select("code", F.col("district").alias("_district")), "code", "left").withColumnRenamed("code", "_county")
    found = most.join(by_district, id_, "full").unionByName(near.select(id_, "_county", "_district"))
    told = segments.join(found, id_, "left")
    new = {county: F.when(F.col(county).isNull() | whole, F.coalesce("_county", county)).otherwise(F.col(county)), district: F.coalesce(F.col(district), F.col("_district"))}
    return told.withColumns(new).select(*segments.columns)


def jobs_by_block_group(blocks: DataFrame, geocode: str = "w_geocode", jobs: str = "C000") -> DataFrame:
    """(geoid, jobs): workplace jobs by block group, the first 12 digits of the block; what isn't a number counts as 0."""
    n = F.coalesce(F.col(jobs).cast("string").try_cast("double"), F.lit(0.0))
    return blocks.groupBy(F.substring(F.lpad(F.col(geocode).cast("string"), 15, "0"), 1, 12).alias("geoid")).agg(F.sum(n).alias("jobs"))


def growth_factors(projections: DataFrame, base: str = "2020", future: str = "2050", statewide: bool = False, default: float = 1.15) -> tuple[DataFrame, Column]:
    """(county, factor) of counties with both years, and the factor of all others: the average if ``statewide``, else ``default``."""
    factor = F.coalesce(F.try_divide(F.col(f"`{future}`").cast("double"), F.col(f"`{base}`").cast("double")), F.lit(1.0))
    told = projections.where("county is not null").groupBy("county").agg(F.min(factor).alias("factor"))
    if not statewide:
        return told, F.lit(default)
    return told, F.lit(told.agg(F.avg("factor")).first()[0] or default)


def buffers(lines: DataFrame, id_: str, radius: float, quarter: int = 16, tolerance: float = 1.0) -> DataFrame:
    """(id, rings): all places within ``radius`` of each line, a quarter of a circle drawn by ``quarter`` chords.

    The union of a capsule for each edge, after vertices that lie within ``tolerance`` of
    the straight way between their neighbours are left out. A line of one vertex has a circle; an empty
    or null line has no row.
    """
    edge = F.when(F.size("line") == 1, F.concat("line", "line")).otherwise(G.simplify(F.col("line"), tolerance))
    e = lines.where(F.size("line") > 0).select(id_, F.explode(G.edges(edge)).alias("_e"))
    turn = F.atan2(F.col("_e.by") - F.col("_e.ay"), F.col("_e.bx") - F.col("_e.ax"))

    def arc(end: str, start: float) -> Column:
        angles = F.transform(F.sequence(F.lit(0), F.lit(2 * quarter)), lambda i: turn + start + i * (math.pi / (2 * quarter)))
        return F.transform(angles, lambda t: F.struct((F.col(f"_e.{end}x") + radius * F.cos(t)).alias("x"), (F.col(f"_e.{end}y") + radius * F.sin(t)).alias("y")))

    ring = F.concat(arc("b", -math.pi / 2), arc("a", math.pi / 2))
    capsules = checkpointed(e.select(id_, F.array(F.concat(ring, F.slice(ring, 1, 1))).alias("rings")))
    several = checkpointed(capsules.groupBy(id_).agg(F.count("*").alias("_n")).where("_n > 1").select(id_))
    alone = capsules.join(several, id_, "left_anti")
    return alone if several.isEmpty() else alone.unionByName(dissolve(capsules.join(several, id_, "left_semi"), id_, radius / 4))


def _sided(polygons: DataFrame, key: str, size: float) -> DataFrame:
    """(key, _e, _left): edges of each polygon and whether its inside lies to their left."""
    edges = polygons.select(key, F.explode(F.flatten(F.transform("rings", G.edges))).alias("_e")).where("_e.ax <> _e.bx or _e.ay <> _e.by")
    near = edges.withColumn("_p", _beside(F.col("_e"), 1)).withColumn("_cell", _cell_of(F.col("_p"), size)).join(polygon_cells(polygons, key, size), [key, "_cell"], "left")
    return near.groupBy(key, "_e").agg(F.coalesce(F.bool_or(F.col("_in").isNotNull() & _inside(F.col("_p.x"), F.col("_p.y"), size)), F.lit(False)).alias("_left"))


def _beside(e: Column, side: int | Column) -> Column:
    """The place a millimetre to the left (1) or right (-1) of an edge's middle."""
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    n = F.hypot(dx, dy)
    return F.struct(((e["ax"] + e["bx"]) / 2 - side * 1e-3 * dy / n).alias("x"), ((e["ay"] + e["by"]) / 2 + side * 1e-3 * dx / n).alias("y"))


def _under(e: Column, left: Column) -> Column:
    """An edge's share of its polygon's area."""
    return F.when(left, 1.0).otherwise(-1.0) * (e["ax"] + e["bx"]) / 2 * (e["by"] - e["ay"])


def polygon_areas(polygons: DataFrame, key: str, size: float) -> DataFrame:
    """(key, area): by edges, whatever way they run; holes count as such."""
    return _sided(polygons, key, size).groupBy(key).agg(F.sum(_under(F.col("_e"), F.col("_left"))).alias("area"))


def shared_areas(a: DataFrame, a_id: str, b: DataFrame, b_id: str, size: float) -> DataFrame:
    """(a_id, b_id, area) of all polygons (id, rings) of two layers that share an area.

    The outline of what two polygons share is made of the parts of either outline that lie in
    the other. Outlines are cut where they meet, and each part adds its integral; a common
    stretch counts once if both lie on the same side of it. All meetings are joins on
    cells (``size`` wide): rows grow with the outlines within reach, not with areas. Exact
    to rounding, but for slivers narrower than a millimetre.
    """
    sides = {}
    for n, df, i in (("a", a, a_id), ("b", b, b_id)):
        sides[n] = checkpointed(_sided(df.select(F.col(i).alias("_id"), "rings"), "_id", size).select(F.col("_id").alias(f"_{n}"), F.col("_e").alias(f"_{n}e"), F.col("_left").alias(f"_{n}left")))
    cells = {n: checkpointed(polygon_cells(df.select(F.col(i).alias(f"_{n}"), "rings"), f"_{n}", size)) for n, df, i in (("a", a, a_id), ("b", b, b_id))}

    def within(n: str, m: str, both: bool) -> DataFrame:
        """(_a, _b, area): parts of the outlines of ``n`` inside polygons of ``m``."""
        own, other = sides[n], cells[m]
        e = F.col(f"_{n}e")
        # an edge is cut at the borders of cells and where it meets the other's edges there
        told = _celled(own, G.line_cells(_ends(e), size)).join(other, "_cell")

        def span(p: str, q: str, c: str) -> tuple[Column, Column]:
            lo, by = F.col(f"_cell.{c}") * size, e[q] - e[p]
            s, t = (lo - e[p]) / F.nullif(by, F.lit(0.0)), (lo + size - e[p]) / F.nullif(by, F.lit(0.0))
            held = (e[p] >= lo) & (e[p] < lo + size)
            return F.coalesce(F.least(s, t), F.when(held, 0.0).otherwise(2.0)), F.coalesce(F.greatest(s, t), F.when(held, 1.0).otherwise(-1.0))

        (s, t), (u, v) = span("ax", "bx", "cx"), span("ay", "by", "cy")
        told = told.withColumns({"_t0": F.greatest(F.lit(0.0), s, u), "_t1": F.least(F.lit(1.0), t, v)}).where("_t1 > _t0")
        edges = F.coalesce("_edges", F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>"))
        hits = F.filter(F.flatten(F.transform(edges, lambda x: G.edge_meetings(e, x))), lambda x: (x > F.col("_t0")) & (x < F.col("_t1")))
        told = told.withColumn("_cuts", F.array_sort(F.array_distinct(F.concat(F.array("_t0", "_t1"), hits))))
        k = F.size("_cuts") - 1
        parts = F.zip_with(F.slice("_cuts", F.lit(1), k), F.slice("_cuts", F.lit(2), k), lambda x, y: F.struct(x.alias("s"), y.alias("t")))
        told = told.select("_a", "_b", "_cell", "_in", "_edges", e.alias("_e"), F.col(f"_{n}left").alias("_left"), F.explode(parts).alias("_p"))

        def at(share: Column, c: str) -> Column:
            return F.col(f"_e.a{c}") + share * (F.col(f"_e.b{c}") - F.col(f"_e.a{c}"))

        piece = F.struct(*[at(F.col(f"_p.{x}"), c).alias(f"{y}{c}") for x, y in (("s", "a"), ("t", "b")) for c in "xy"])
        told = told.withColumn("_piece", piece).where("_piece.ax <> _piece.bx or _piece.ay <> _piece.by")
        way = F.when(F.col("_left"), 1).otherwise(-1)
        for side in (way, -way) if both else (way,):
            spot = _beside(F.col("_piece"), side)
            told = told.where(_inside(spot["x"], spot["y"], size))
        return told.select("_a", "_b", _under(F.col("_piece"), F.col("_left")).alias("area"))

    summed = within("a", "b", False).unionByName(within("b", "a", True)).groupBy("_a", "_b").agg(F.sum("area").alias("area"))
    return summed.where("area > 1e-6").select(F.col("_a").alias(a_id), F.col("_b").alias(b_id), "area")


def density_metrics(segments: DataFrame, id_: str, block_groups: DataFrame, factors: DataFrame, other: Column, radius: float = METRES_PER_MILE, job_growth: float = 1.10, quarter: int = 16) -> DataFrame:
    """People and jobs per square mile within ``radius`` of each segment (line), now and projected, two decimals.

    Block groups (geoid, county, population, jobs, rings) count with the share of their
    area in reach, by exact areas of buffer and polygon (``shared_areas``). Segments without any
    have 0. Equal lines are worked out once, under the least of their ids.
    """
    size = radius / 4
    lines = checkpointed(segments.groupBy("line").agg(F.min(id_).alias("_id")))
    reach = checkpointed(buffers(lines, "_id", radius, quarter))
    groups = block_groups.select("geoid", "rings")
    shared = shared_areas(reach, "_id", groups, "geoid", size).withColumnRenamed("area", "_shared")
    whole = polygon_areas(groups, "geoid", size).withColumnRenamed("area", "_whole")
    told = shared.join(whole, "geoid").join(block_groups.select("geoid", "county", "population", "jobs"), "geoid").join(factors, "county", "left")
    weight = F.least(F.lit(1.0), F.try_divide("_shared", "_whole"))
    people, jobs = weight * F.coalesce("population", F.lit(0.0)), weight * F.coalesce("jobs", F.lit(0.0))
    sums = told.groupBy("_id").agg(F.sum(people).alias("_people"), F.sum(jobs).alias("_jobs"), F.sum(people * F.coalesce("factor", other)).alias("_later"))
    area = polygon_areas(reach, "_id", size).select("_id", (F.col("area") / METRES_PER_MILE**2).alias("_area"))
    found = sums.join(area, "_id").join(lines.withColumnRenamed("line", "_line"), "_id")
    new = {"population_density": F.col("_people"), "employment_density": F.col("_jobs"), "population_density_2050": F.col("_later"), "employment_density_2050": F.col("_jobs") * job_growth}
    found = found.select("_line", *[round_even(x / F.col("_area"), 2).alias(n) for n, x in new.items()])
    return segments.join(found, F.col("line") == F.col("_line"), "left").drop("_line").na.fill(0.0, list(new))


def spot_checks(layers: dict[str, DataFrame], texts: dict[str, str]) -> DataFrame:
    """One row per layer: whether it has rows and, where a text is given, whether any of its string columns holds it, in any case."""

    def one(name: str, df: DataFrame) -> DataFrame:
        said = F.lower(F.concat_ws(" ", *[F.col(c) for c, t in df.dtypes if t == "string"]))
        found = F.coalesce(F.bool_or(F.contains(said, F.lit(texts[name].lower()))), F.lit(False)) if name in texts else F.lit(True)
        return df.agg(F.count("*").alias("_n"), found.alias("_f")).select(F.lit(f"layer_{name}").alias("name"), ((F.col("_n") > 0) & F.col("_f")).alias("passed"), F.col("_n").cast("string").alias("detail"))

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in layers.items()])
