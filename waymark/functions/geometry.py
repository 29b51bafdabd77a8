"""Geometry as column expressions on ``array<struct<x, y>>`` lines and ``array<array<struct<x, y>>>`` rings, in metres.

Each works on one row's arrays with higher-order functions, so it stays in the JVM, and
costs in proportion to the number of vertices (pairs of them in ``line_distance``): folds
along a line carry a few numbers, never an array. The joins of ``operators`` work on single
edges; ``operators.lines`` measures and cuts many lines at many places at once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.scalars import METRES_PER_MILE


def point(x: Column | float, y: Column | float) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(float(v))).cast("double").alias(n) for v, n in ((x, "x"), (y, "y"))])


def edges(line: Column) -> Column:
    """array<struct<ax, ay, bx, by>> of consecutive vertices."""
    n = F.greatest(F.size(line) - 1, F.lit(0))
    return F.zip_with(F.slice(line, F.lit(1), n), F.slice(line, F.lit(2), n), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))


def _edge_length(e: Column) -> Column:
    return F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"])


def line_length(line: Column) -> Column:
    return F.aggregate(edges(line), F.lit(0.0), lambda t, e: t + _edge_length(e))


def line_miles(line: Column) -> Column:
    return line_length(line) / METRES_PER_MILE


def line_at(line: Column, distance: Column) -> Column:
    """The point at a distance along a line, clamped to its ends."""
    first = F.get(line, 0)
    start = F.struct(F.lit(0.0).alias("t"), first["x"].alias("x"), first["y"].alias("y"), F.lit(False).alias("found"))

    def step(s: Column, e: Column) -> Column:
        n = _edge_length(e)
        here = distance <= s["t"] + n
        share = F.when(n > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (distance - s["t"]) / n))).otherwise(0.0)
        x = F.when(s["found"], s["x"]).when(here, e["ax"] + share * (e["bx"] - e["ax"])).otherwise(e["bx"])
        y = F.when(s["found"], s["y"]).when(here, e["ay"] + share * (e["by"] - e["ay"])).otherwise(e["by"])
        return F.struct((s["t"] + n).alias("t"), x.alias("x"), y.alias("y"), F.coalesce(s["found"] | here, F.lit(False)).alias("found"))

    return F.aggregate(edges(line), start, step, lambda s: F.when(first.isNotNull(), F.struct(s["x"].alias("x"), s["y"].alias("y"))))


def line_interpolate(line: Column, ratio: Column | float) -> Column:
    """The point at a share of a line's length."""
    return line_at(line, line_length(line) * ratio)


def line_substring(line: Column, begin: Column, end: Column) -> Column:
    """The part of a line between two distances along it: the inner vertices and two interpolated ends."""
    start = F.struct(F.lit(0.0).alias("t"), F.lit(0).alias("before"), F.lit(0).alias("inner"))

    def step(s: Column, e: Column) -> Column:
        return F.struct((s["t"] + _edge_length(e)).alias("t"), (s["before"] + (s["t"] <= begin).cast("int")).alias("before"), (s["inner"] + ((s["t"] > begin) & (s["t"] < end)).cast("int")).alias("inner"))

    # vertices lie in order of their distance, so the inner ones are one stretch of the array
    inner = F.aggregate(edges(line), start, step, lambda s: F.slice(line, s["before"] + 1, s["inner"]))
    return F.concat(F.array(line_at(line, begin)), inner, F.array(line_at(line, end)))


def line_samples(line: Column, n: int = 11) -> Column:
    """``n`` points at equal steps from end to end."""
    return F.array(*[line_interpolate(line, i / (n - 1)) for i in range(n)])


def _edge_project(e: Column, x: Column, y: Column) -> Column:
    """Share along an edge of the point on it that is nearest to (x, y)."""
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    n = dx * dx + dy * dy
    return F.when(n > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((x - e["ax"]) * dx + (y - e["ay"]) * dy) / n))).otherwise(0.0)


def _nearest(line: Column, p: Column) -> Column:
    """Struct distance, along: of the point of a line that is nearest to ``p``, the first of equals."""
    start = F.struct(F.lit(0.0).alias("t"), F.lit(None).cast("double").alias("distance"), F.lit(None).cast("double").alias("along"))

    def step(s: Column, e: Column) -> Column:
        n, share = _edge_length(e), _edge_project(e, p["x"], p["y"])
        d = F.hypot(e["ax"] + share * (e["bx"] - e["ax"]) - p["x"], e["ay"] + share * (e["by"] - e["ay"]) - p["y"])
        nearer = s["distance"].isNull() | (d < s["distance"])
        return F.struct((s["t"] + n).alias("t"), F.when(nearer, d).otherwise(s["distance"]).alias("distance"), F.when(nearer, s["t"] + share * n).otherwise(s["along"]).alias("along"))

    return F.aggregate(edges(line), start, step)


def line_project(line: Column, p: Column) -> Column:
    """Distance along a line of the point on it that is nearest to ``p``."""
    return _nearest(line, p)["along"]


def point_line_distance(line: Column, p: Column) -> Column:
    return _nearest(line, p)["distance"]


def azimuth(line: Column) -> Column:
    """Degrees clockwise from north, from the first to the last vertex."""
    a, b = F.get(line, 0), F.element_at(line, -1)
    return F.pmod(F.degrees(F.atan2(b["x"] - a["x"], b["y"] - a["y"])), F.lit(360.0))


def alignment_angle(a: Column, b: Column) -> Column:
    """Angle between two azimuths, folded to 0 to 90 degrees."""
    d = F.pmod(a - b, F.lit(180.0))
    return F.least(d, 180.0 - d)


def merge_parts(parts: Column) -> Column:
    """Parts of a line joined where one ends at the start of the next, in order."""
    n = F.size(parts)
    every = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(every, lambda i: ~F.coalesce((i > 0) & (F.element_at(F.get(parts, i - 1), -1) == F.get(F.get(parts, i), 0)), F.lit(False)))

    def joined(start: Column, i: Column) -> Column:
        rest = F.slice(parts, start + 2, F.coalesce(F.get(starts, i + 1), n) - start - 1)
        return F.concat(F.get(parts, start), F.flatten(F.transform(rest, lambda p: F.slice(p, F.lit(2), F.size(p)))))

    return F.transform(starts, joined)


def longest_part(parts: Column) -> Column:
    return F.array_max(F.transform(parts, lambda p: F.struct(line_length(p).alias("n"), p.alias("p"))))["p"]


def in_rings(p: Column, rings: Column) -> Column:
    """Whether a point lies in a polygon (parity over all its rings); the boundary counts as inside."""
    every = F.flatten(F.transform(rings, edges))
    x, y = p["x"], p["y"]

    def crosses(e: Column) -> Column:
        over = (e["ay"] > y) != (e["by"] > y)
        return over & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.when(over, e["by"] - e["ay"]).otherwise(1.0) + e["ax"])

    def touches(e: Column) -> Column:
        t = _edge_project(e, x, y)
        return F.hypot(e["ax"] + t * (e["bx"] - e["ax"]) - x, e["ay"] + t * (e["by"] - e["ay"]) - y) < 1e-9

    return F.exists(every, touches) | (F.size(F.filter(every, crosses)) % 2 == 1)


def edge_crossings(a: Column, b: Column) -> Column:
    """Share along edge ``a`` where edge ``b`` meets it; null if they don't meet or are parallel."""
    ux, uy, vx, vy = a["bx"] - a["ax"], a["by"] - a["ay"], b["bx"] - b["ax"], b["by"] - b["ay"]
    cross = ux * vy - uy * vx
    wx, wy = b["ax"] - a["ax"], b["ay"] - a["ay"]
    t, s = (wx * vy - wy * vx) / F.nullif(cross, F.lit(0.0)), (wx * uy - wy * ux) / F.nullif(cross, F.lit(0.0))
    return F.when(t.between(0, 1) & s.between(0, 1), t)


def edge_meetings(a: Column, b: Column) -> Column:
    """Shares along edge ``a`` where edge ``b`` meets it: one where they cross, both ends of a common stretch, none else."""
    ux, uy = a["bx"] - a["ax"], a["by"] - a["ay"]
    n = ux * ux + uy * uy
    crossing = edge_crossings(a, b)
    parallel = F.abs(ux * (b["by"] - b["ay"]) - uy * (b["bx"] - b["ax"])) <= 1e-9 * F.greatest(n, F.lit(1.0))
    apart = F.abs(ux * (b["ay"] - a["ay"]) - uy * (b["ax"] - a["ax"])) / F.sqrt(F.greatest(n, F.lit(1e-18)))
    p, q = ((b["ax"] - a["ax"]) * ux + (b["ay"] - a["ay"]) * uy) / F.nullif(n, F.lit(0.0)), ((b["bx"] - a["ax"]) * ux + (b["by"] - a["ay"]) * uy) / F.nullif(n, F.lit(0.0))
    low, high = F.greatest(F.lit(0.0), F.least(p, q)), F.least(F.lit(1.0), F.greatest(p, q))
    none = F.array().cast("array<double>")
    return F.when(crossing.isNotNull(), F.array(crossing)).when((n > 0) & parallel & (apart < 1e-6) & (low <= high), F.array(low, high)).otherwise(none)


def edge_distance(a: Column, b: Column) -> Column:
    """Distance between two edges; 0 where they cross."""

    def to_edge(px: Column, py: Column, g: Column) -> Column:
        t = _edge_project(g, px, py)
        return F.hypot(g["ax"] + t * (g["bx"] - g["ax"]) - px, g["ay"] + t * (g["by"] - g["ay"]) - py)

    gap = F.least(to_edge(a["ax"], a["ay"], b), to_edge(a["bx"], a["by"], b), to_edge(b["ax"], b["ay"], a), to_edge(b["bx"], b["by"], a))
    return F.when(edge_crossings(a, b).isNotNull(), 0.0).otherwise(gap)


def line_distance(a: Column, b: Column) -> Column:
    """Distance between two lines: the least of all pairs of edges (a point is a line of one vertex)."""

    def cut(x: Column) -> Column:
        return edges(F.when(F.size(x) == 1, F.concat(x, x)).otherwise(x))

    return F.array_min(F.flatten(F.transform(cut(a), lambda e: F.transform(cut(b), lambda g: edge_distance(e, g)))))


def snap(x: Column, tolerance: float) -> Column:
    return F.bround(x / tolerance) * tolerance


def simplify(line: Column, tolerance: float) -> Column:
    """Vertices whose triangle with their neighbours is higher than the tolerance, and both ends. One pass, not recursive."""
    n = F.size(line)

    def keep(p: Column, i: Column) -> Column:
        a, b = F.get(line, i - 1), F.get(line, i + 1)
        base = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
        height = F.abs((b["x"] - a["x"]) * (a["y"] - p["y"]) - (a["x"] - p["x"]) * (b["y"] - a["y"])) / F.greatest(base, F.lit(1e-12))
        return (i == 0) | (i == n - 1) | (height > tolerance)

    return F.filter(line, keep)


def line_cells(line: Column, size: float, reach: float = 0.0) -> Column:
    """Distinct grid cells (cx, cy) that the edges' boxes, widened by ``reach``, touch."""

    def one(e: Column) -> Column:
        def span(a: str, b: str) -> Column:
            return F.sequence(F.floor((F.least(e[a], e[b]) - reach) / size), F.floor((F.greatest(e[a], e[b]) + reach) / size))

        return F.flatten(F.transform(span("ax", "bx"), lambda i: F.transform(span("ay", "by"), lambda j: F.struct(i.alias("cx"), j.alias("cy")))))

    return F.array_distinct(F.flatten(F.transform(edges(line), one)))


def ring_cells(rings: Column, size: float) -> Column:
    """Grid cells of the polygon's bounding box."""
    points = F.flatten(rings)
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    across = F.sequence(F.floor(F.array_min(x) / size), F.floor(F.array_max(x) / size))
    up = F.sequence(F.floor(F.array_min(y) / size), F.floor(F.array_max(y) / size))
    return F.flatten(F.transform(across, lambda i: F.transform(up, lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


# Krueger series of the transverse Mercator projection on WGS 84, zone 17 north.
_A, _F, _K0, _LON0, _E0 = 6378137.0, 1 / 298.257223563, 0.9996, -81.0, 500000.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240]
_BETA = [_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480]
_DELTA = [2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15]
_C = 2 * math.sqrt(_N) / (1 + _N)


def lonlat_to_utm17(lon: Column, lat: Column) -> Column:
    """Struct x, y in metres (EPSG:32617)."""
    phi, lam = F.radians(lat), F.radians(lon - _LON0)
    t = F.sinh(F.atanh(F.sin(phi)) - _C * F.atanh(_C * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return point(_E0 + _K0 * _RADIUS * x, _K0 * _RADIUS * y)


def utm17_to_lonlat(p: Column) -> Column:
    """Struct x (longitude), y (latitude)."""
    xi, eta = p["y"] / (_K0 * _RADIUS), (p["x"] - _E0) / (_K0 * _RADIUS)
    u, v = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return point(_LON0 + F.degrees(F.atan2(F.sinh(v), F.cos(u))), F.degrees(phi))
