"""Lines measured and cut at many places at once: one running sum over exploded edges, no array is walked twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import geometry as G


def measured_edges(lines: DataFrame, keep: list[str], line: str = "line") -> DataFrame:
    """(keep, _line, _pos, _e, _at, _len, _total): each edge of each line with its length, the length before it and the line's.

    A line's edges meet in one task, by a sort; a line is a row anyway. ``_line`` numbers the
    rows, so lines with equal keys stay apart.
    """
    told = lines.withColumn("_line", F.monotonically_increasing_id()).select(*keep, "_line", F.posexplode(G.edges(F.col(line))).alias("_pos", "_e"))
    told = told.withColumn("_len", F.hypot(F.col("_e.bx") - F.col("_e.ax"), F.col("_e.by") - F.col("_e.ay")))
    w = Window.partitionBy("_line").orderBy("_pos")
    told = told.withColumn("_end", F.sum("_len").over(w))
    return told.withColumns({"_at": F.col("_end") - F.col("_len"), "_total": F.max("_end").over(Window.partitionBy("_line"))}).drop("_end")


def slice_lines(pieces: DataFrame, routes: DataFrame, key: str = "ROUTE_ID", tolerance: float = 1e-4) -> DataFrame:
    """``pieces`` (key, piece, from_mp, to_mp, ...) with the part of their route's ``line`` between their milepoints.

    ``routes``: key, from_mp, to_mp, line, one row a key. Milepoints are shares of the line's
    length, clamped to it. A route without span gives its whole line to each piece; a piece
    without length has a null line. (key, piece) tells the pieces apart. Vertices and cuts of a route are put in one order by a
    window, so a route of v vertices and p pieces costs v + p, not v times p.
    """
    numbered = pieces.withColumn("_piece", F.struct(key, "piece"))
    r = routes.select(F.col(key).alias("_key"), F.col("from_mp").alias("_from"), F.col("to_mp").alias("_to"), "line")
    edges = measured_edges(r.withColumn("_span", F.col("_to") - F.col("_from")), ["_key", "_span", "_from"])
    totals = edges.groupBy("_key", "_from", "_span").agg(F.max("_total").alias("_total"))
    short = F.col("_span") <= tolerance
    asked = numbered.join(totals, F.col(key) == F.col("_key"))

    def distance(mp: str) -> Column:
        share = (F.col(mp) - F.col("_from")) / F.col("_span")
        return F.greatest(F.lit(0.0), F.least(F.col("_total"), F.col("_total") * share))

    asked = asked.select("_key", "_piece", F.when(short, F.lit(0.0)).otherwise(distance("from_mp")).alias("_d0"), F.when(short, F.col("_total")).otherwise(distance("to_mp")).alias("_d1")).where("_d1 > _d0")
    cuts = asked.select("_key", F.explode(F.array("_d0", "_d1")).alias("_d")).distinct()
    # vertices come before cuts at the same distance, so that a cut there lies on the edge that begins at the vertex, or at the end of the last
    edge = F.struct("_e", "_at", "_len")
    events = edges.select("_key", F.col("_at").alias("_d"), F.lit(0).alias("_kind"), "_pos", edge.alias("_edge"))
    events = events.unionByName(cuts.select("_key", "_d", F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("_pos"), F.lit(None).cast(edges.select(edge.alias("s")).schema["s"].dataType).alias("_edge")))
    order = Window.partitionBy("_key").orderBy("_d", "_kind", "_pos")
    before = F.last("_edge", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = events.withColumn("_own", before)
    e = F.col("_own._e")
    t = F.when(F.col("_own._len") > 0, F.least(F.lit(1.0), (F.col("_d") - F.col("_own._at")) / F.col("_own._len"))).otherwise(0.0)
    spot = F.when(F.col("_kind") == 0, F.struct(e["ax"].alias("x"), e["ay"].alias("y"))).otherwise(F.struct((e["ax"] + t * (e["bx"] - e["ax"])).alias("x"), (e["ay"] + t * (e["by"] - e["ay"])).alias("y")))
    # the stretch between two cuts that follow each other, with the vertices in between
    placed = placed.select("_key", "_d", "_kind", "_pos", spot.alias("_p"), F.sum("_kind").over(order).alias("_stretch"))
    cut = F.min(F.when(F.col("_kind") == 1, F.struct("_d", "_p"))).alias("_cut")
    vertices = F.array_sort(F.collect_list(F.when(F.col("_kind") == 0, F.struct("_d", "_pos", "_p")))).alias("_inner")
    inner = placed.groupBy("_key", F.col("_stretch").alias("_s")).agg(cut, vertices).where("_cut is not null")
    first = inner.select("_key", F.col("_cut._d").alias("_d0"), F.col("_s").alias("_s0"), F.col("_cut._p").alias("_first"))
    last = inner.select("_key", F.col("_cut._d").alias("_d1"), F.col("_s").alias("_s1"), F.col("_cut._p").alias("_last"))
    ends = asked.join(first, ["_key", "_d0"]).join(last, ["_key", "_d1"])
    # a piece owns the stretches from its first cut up to its last; pieces that tile their route own one or few each
    each = ends.withColumn("_s", F.explode(F.sequence("_s0", F.col("_s1") - 1))).join(inner.select("_key", "_s", "_inner"), ["_key", "_s"])
    whole = each.groupBy("_piece").agg(F.array_sort(F.collect_list(F.struct("_s", "_inner"))).alias("_parts"), F.first(F.struct("_first", "_last", "_d0", "_d1")).alias("_ends"))
    # a vertex within a micrometre of a cut is that cut
    between = F.filter(F.flatten(F.transform("_parts", lambda s: s["_inner"])), lambda v: (v["_d"] > F.col("_ends._d0") + 1e-6) & (v["_d"] < F.col("_ends._d1") - 1e-6))
    line = F.concat(F.array("_ends._first"), F.transform(between, lambda v: v["_p"]), F.array("_ends._last"))
    return numbered.join(whole.select("_piece", line.alias("line")), "_piece", "left").drop("_piece")
