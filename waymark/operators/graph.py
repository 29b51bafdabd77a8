"""The road graph and sole connections."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import geometry as G
from waymark.lineage import checkpointed
from waymark.operators.stations import knn


def road_edges(segments: DataFrame, id_: str, tolerance: float = 50.0) -> DataFrame:
    """(ax, ay, bx, by, segments): snapped end points, the smaller first; no self-loops; parallel segments share an edge."""
    def end(i: int):
        p = F.element_at("line", i)
        return F.struct(G.snap(p["x"], tolerance).alias("x"), G.snap(p["y"], tolerance).alias("y"))

    told = segments.select(id_, end(1).alias("s"), end(-1).alias("e")).where("s <> e")
    low, high = F.when(F.col("s") < F.col("e"), F.col("s")).otherwise(F.col("e")), F.when(F.col("s") < F.col("e"), F.col("e")).otherwise(F.col("s"))
    edges = told.select(id_, low.alias("a"), high.alias("b")).groupBy("a", "b").agg(F.array_sort(F.collect_set(id_)).alias("segments"))
    return edges.select(F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"), "segments")


def bridges(pairs: list[tuple]) -> set[int]:
    """Indices of edges whose removal parts the graph, by low links without recursion."""
    near: dict = {}
    for i, (a, b) in enumerate(pairs):
        near.setdefault(a, []).append((b, i))
        near.setdefault(b, []).append((a, i))
    order, low, found = {}, {}, set()
    for root in near:
        if root in order:
            continue
        order[root] = low[root] = len(order)
        stack = [(root, -1, iter(near[root]))]
        while stack:
            node, by, rest = stack[-1]
            for other, i in rest:
                if i == by:
                    continue
                if other in order:
                    low[node] = min(low[node], order[other])
                else:
                    order[other] = low[other] = len(order)
                    stack.append((other, i, iter(near[other])))
                    break
            else:
                stack.pop()
                if stack:
                    parent = stack[-1][0]
                    low[parent] = min(low[parent], low[node])
                    if low[node] > order[parent]:
                        found.add(by)
    return found


def _near_circles(edges: DataFrame, centres: DataFrame, radius: float) -> DataFrame:
    """(seat, cx, cy, ax, ay, bx, by): edges with both ends within ``radius`` of each centre (seat, cx, cy); they meet by grid cells."""
    around = F.explode(F.expr("flatten(transform(sequence(-1, 1), i -> transform(sequence(-1, 1), j -> struct(i, j))))"))
    c = centres.select("seat", "cx", "cy", around.alias("_o"))
    c = c.select("seat", "cx", "cy", (F.floor(F.col("cx") / radius) + F.col("_o.i")).alias("_gx"), (F.floor(F.col("cy") / radius) + F.col("_o.j")).alias("_gy"))
    near = edges.select("ax", "ay", "bx", "by", F.floor(F.col("ax") / radius).alias("_gx"), F.floor(F.col("ay") / radius).alias("_gy")).join(c, ["_gx", "_gy"])
    both = [F.pow(F.col(f"{e}x") - F.col("cx"), 2) + F.pow(F.col(f"{e}y") - F.col("cy"), 2) <= radius**2 for e in "ab"]
    return near.where(both[0] & both[1]).select("seat", "cx", "cy", "ax", "ay", "bx", "by")


def _peeled(edges: DataFrame, share: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Edges by seat that end in a leaf, which are bridges, taken off again and again, and what is left.

    Goes on while a round takes off at least ``share`` of the edges; what is left is right
    however many rounds there were.
    """
    ends = [F.struct(F.col(f"{e}x").alias("x"), F.col(f"{e}y").alias("y")) for e in "ab"]
    taken, rest = None, checkpointed(edges)
    count = rest.count()
    while count:
        leaves = rest.select("seat", F.explode(F.array(*ends)).alias("_n")).groupBy("seat", "_n").agg(F.count("*").alias("_d")).where("_d = 1").select("seat", "_n")
        a, b = (leaves.select("seat", F.col("_n.x").alias(f"{e}x"), F.col("_n.y").alias(f"{e}y"), F.lit(True).alias(f"_{e}")) for e in "ab")
        told = checkpointed(rest.join(a, ["seat", "ax", "ay"], "left").join(b, ["seat", "bx", "by"], "left").withColumn("_leaf", F.coalesce("_a", "_b", F.lit(False))).drop("_a", "_b"))
        off = told.where("_leaf").drop("_leaf")
        taken = off if taken is None else taken.unionByName(off)
        rest = told.where("not _leaf").drop("_leaf")
        left = rest.count()
        if count - left < share * count:
            break
        count = left
    return (edges.limit(0) if taken is None else taken), rest


def sole_connections(edges: DataFrame, seats: DataFrame, radius: float = 30_000.0, close: float = 5_000.0, least: int = 3) -> DataFrame:
    """(segment, seats): segments of bridges near a county seat (seat, x, y).

    The node of the graph that is nearest to a seat (the least of equals) stands for it, if it
    lies within ``radius``. A seat's graph is all edges with both ends within ``radius`` of
    that node; with fewer than ``least`` edges it has no bridges. A bridge counts if an end lies
    less than ``close`` from the node. Names of seats are joined in order.

    Leaf edges are bridges and are taken off by joins, so that only what has no leaves goes to
    a task, one group a seat, bounded by the roads within the radius. Seats without finite
    coordinates have none; seats of one name are told apart by their places.
    """
    nodes = edges.select(F.explode(F.array(*[F.struct(F.col(f"{e}x").alias("x"), F.col(f"{e}y").alias("y")) for e in "ab"])).alias("node")).distinct()
    asked = seats.select(F.struct("seat", "x", "y").alias("seat"), "x", "y")
    centres = knn(asked, nodes.select("node", "node.x", "node.y"), "seat", "node", 1).where(F.col("distance") <= radius)
    near = checkpointed(_near_circles(edges, centres.select("seat", F.col("node.x").alias("cx"), F.col("node.y").alias("cy")), radius))
    able = near.groupBy("seat").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("seat")
    told = [F.pow(F.col(f"{e}x") - F.col("cx"), 2) + F.pow(F.col(f"{e}y") - F.col("cy"), 2) < close**2 for e in "ab"]
    flat = near.join(able, "seat", "left_semi").select("seat", "ax", "ay", "bx", "by", (told[0] | told[1]).alias("close"))
    leaves, core = _peeled(flat)

    def inner(frame: pd.DataFrame) -> pd.DataFrame:
        ends = list(zip(zip(frame["ax"], frame["ay"]), zip(frame["bx"], frame["by"])))
        return frame.iloc[sorted(bridges(ends))]

    core = core.withColumns({"name": F.col("seat.seat"), "sx": F.col("seat.x"), "sy": F.col("seat.y")}).drop("seat")
    schema = ", ".join(f"{n} {t}" for n, t in core.dtypes)
    found = core.groupBy("name", "sx", "sy").applyInPandas(inner, schema).where("close").select("name", "ax", "ay", "bx", "by")
    found = found.unionByName(leaves.where("close").select(F.col("seat.seat").alias("name"), "ax", "ay", "bx", "by")).distinct()
    segments = found.join(edges, ["ax", "ay", "bx", "by"]).select("name", F.explode("segments").alias("segment"))
    return segments.groupBy(F.col("segment").cast("string").alias("segment")).agg(F.array_join(F.array_sort(F.collect_set("name")), "; ").alias("seats"))
