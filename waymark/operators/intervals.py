"""Joins, gaps and fills on linear-referenced intervals (key, from, to).

Interval joins have the route and a milepoint bin as equality keys, so Spark plans them as
sort-merge joins with a range condition on top, and a long route is dealt out over its
bins; none is a Cartesian product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from waymark.functions.scalars import free_name, round_milepoint
from waymark.operators.lines import slice_lines
from waymark.operators.quantiles import largest_group

EPSILON = 1e-4


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """A row number for telling equal rows apart; deterministic for tables."""
    return df.withColumn(name, F.monotonically_increasing_id())


#: width of a milepoint bin; an interval is copied to each bin it touches, so it should be longer than most intervals
BIN = 32.0


def _binned(left: DataFrame, right: DataFrame, key: str, begin: str, end: str, width: float) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with a row for each milepoint bin they touch, and the condition that makes a pair met in the first bin they share, there alone.

    Left rows have ``begin`` and ``end``, right rows ``_key``, ``_begin`` and ``_end``; rows with
    null bounds go.
    """

    def bins(a: str, z: str) -> Column:
        low = F.floor(F.least(a, z) / width)
        return F.explode(F.sequence(low, F.greatest(low, F.floor(F.greatest(a, z) / width))))

    a = left.where(F.col(begin).isNotNull() & F.col(end).isNotNull()).withColumn("_bin", bins(begin, end))
    b = right.where("_begin is not null and _end is not null").withColumn("_bin", bins("_begin", "_end")).withColumnRenamed("_bin", "_bin2")
    shared = F.greatest(F.floor(F.least(begin, end) / width), F.floor(F.least("_begin", "_end") / width))
    return a, b, (F.col(key) == F.col("_key")) & (F.col("_bin") == F.col("_bin2")) & (F.col("_bin") == shared)


#: key and bounds of a left interval while its partners are sought
_OWN = ["_own_key", "_own_begin", "_own_end"]


def _pairs(left: DataFrame, right: DataFrame, key: str, begin: str, end: str, width: float, alike: list[str], rest: Column) -> DataFrame:
    """Different intervals of ``left`` (``_OWN``) with the right ones they share a bin with, and the miles shared (``_shared``); of right rows that are equal in ``alike`` the least ``rest`` (``_first``).

    One shuffle a side: equal rows are reduced where they meet for the join. A pair that shares
    several bins is met once, one that shares no mile may be met too.
    """
    own = left.select(*[F.col(c).alias(n) for c, n in zip((key, begin, end), _OWN)])
    a, b, met = _binned(own, right, *_OWN, width)
    a = a.repartition("_own_key", "_bin").distinct()
    b = b.repartition("_key", "_bin2").groupBy(*alike, "_bin2").agg(F.min(rest).alias("_first"))
    return a.join(b, met).withColumn("_shared", F.least("_own_end", "_end") - F.greatest("_own_begin", "_begin"))


def _given(left: DataFrame, found: DataFrame, key: str, begin: str, end: str) -> DataFrame:
    """Left rows that have both bounds with what is ``found`` for their key and bounds (``_OWN``)."""
    same = [F.col(c) == F.col(n) for c, n in zip((key, begin, end), _OWN)]
    return left.where(F.col(begin).isNotNull() & F.col(end).isNotNull()).join(found, same, "left").drop(*_OWN)


#: right rows of a route up to which they are one array
FEW = 256


def _listed(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame | None:
    """Left rows with the right ones of their route (``_near``: array of ``columns``, null if none); None if a route has too many (counted).

    Where both sides come dealt by key nothing is shuffled, and rows keep their columns on the
    way; a row costs at most ``FEW`` comparisons.
    """
    if largest_group(right, ["_key"]) > FEW:
        return None
    lists = right.groupBy("_key").agg(F.collect_list(F.struct(*columns)).alias("_near"))
    return left.join(lists.hint("merge"), F.col(key) == F.col("_key"), "left")


def _shared_miles(x: Column, begin: str, end: str) -> Column:
    """Miles that a row shares with one of its ``_near``; null if a bound is (``least`` and ``greatest`` would skip it)."""
    bounds = F.col(begin).isNotNull() & F.col(end).isNotNull() & x["_begin"].isNotNull() & x["_end"].isNotNull()
    return F.when(bounds, F.least(F.col(end), x["_end"]) - F.greatest(F.col(begin), x["_begin"]))


def _pick(pairs: DataFrame, left: DataFrame, take: Column, rank: Column) -> DataFrame:
    """Each left row (``_row``) with what it takes of the partner of the least rank (``_best``); rows without a partner in one bin may have one in another."""
    found = F.struct(F.col("_key").isNull().alias("none"), rank.alias("rank"))
    return pairs.groupBy("_left").agg(F.first(F.struct(*left.columns)).alias("_row"), F.min_by(take, found).alias("_best"))


def best_overlap(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: list[str],
    order: list[str] | None = None,
    begin: str = "from_mp",
    end: str = "to_mp",
    min_overlap: float = EPSILON,
    strict: bool = True,
    width: float = BIN,
    together: bool = False,
) -> DataFrame:
    """Left rows with ``columns`` of the right row of the same key that overlaps most, and ``overlap``.

    Ties go to the smaller begin, then to ``order``. An overlap has to exceed
    ``min_overlap`` (or reach it, if not ``strict``). A left row with a null bound takes the
    first right row of its key. Each left row comes out once; without a match the
    columns are null.

    Both sides meet by key and milepoint bin, so a route that holds a third of all rows is
    dealt out and costs in proportion to its different intervals and their overlaps; equal
    intervals meet once, and only keys and bounds of left rows take part. The best of each bin
    is taken before the second shuffle. Where both sides come dealt by key, as from a window
    over it, ``together`` compares rows with the list of their route, unless that is long.
    """
    order = order or columns
    r = right.select(F.col(key).alias("_key"), F.col(begin).alias("_begin"), F.col(end).alias("_end"), F.struct(*order).alias("_order"), F.struct(*columns).alias("_take"))
    near = _listed(left, r, key, ["_begin", "_end", "_order", "_take"]) if together else None
    if near is not None:
        shared = F.transform("_near", lambda x: F.struct((-_shared_miles(x, begin, end)).alias("_less"), x["_begin"].alias("_begin"), x["_order"].alias("_order"), x["_take"].alias("_take")))
        best = F.array_min(F.filter(shared, lambda x: (-x["_less"] > min_overlap) if strict else (-x["_less"] >= min_overlap)))
        first = F.array_min(F.transform("_near", lambda x: F.struct(x["_begin"].alias("_begin"), x["_order"].alias("_order"), x["_take"].alias("_take"))))["_take"]
        bare = F.col(begin).isNull() | F.col(end).isNull()
        told = near.select(*left.columns, best.alias("_best"), F.when(bare, first).alias("_least"))
        return told.select(*left.columns, *[F.coalesce(f"_best._take.{c}", f"_least.{c}").alias(c) for c in columns], (-F.col("_best._less")).alias("overlap"))
    pairs = _pairs(left, r, key, begin, end, width, ["_key", "_begin", "_end"], F.struct("_order", "_take"))
    pairs = pairs.where((F.col("_shared") > min_overlap) if strict else (F.col("_shared") >= min_overlap))
    best = pairs.groupBy(*_OWN).agg(F.min(F.struct((-F.col("_shared")).alias("_less"), "_begin", "_first")).alias("_best"))
    told = _given(left, best, key, begin, end)
    told = told.select(*left.columns, *[F.col(f"_best._first._take.{c}").alias(c) for c in columns], (-F.col("_best._less")).alias("overlap"))
    first = r.groupBy("_key").agg(F.min_by("_take", F.struct("_begin", "_order")).alias("_best"))
    open_rows = left.where(F.col(begin).isNull() | F.col(end).isNull()).join(first, F.col(key) == F.col("_key"), "left")
    return told.unionByName(open_rows.select(*left.columns, *[F.col(f"_best.{c}").alias(c) for c in columns], F.lit(None).cast("double").alias("overlap")))


def first_covering(left: DataFrame, right: DataFrame, key: str, columns: list[str], begin: str = "from_mp", end: str = "to_mp", width: float = BIN) -> DataFrame:
    """Left rows with ``columns`` of the first right row (by begin, end) that covers them within epsilon; met by key and milepoint bin of the left row's begin."""
    lefts = _numbered(left, "_left")
    r = right.select(F.col(key).alias("_key"), F.col(begin).alias("_begin"), F.col(end).alias("_end"), F.struct(*columns).alias("_take"))
    covers = (F.col("_begin") <= F.col(begin) + EPSILON) & (F.col("_end") >= F.col(end) - EPSILON)
    # a left row is in one bin, that of its begin; a right row in all that it touches, widened by epsilon
    low = F.floor((F.col("_begin") - 2 * EPSILON) / width)
    b = r.where("_begin is not null and _end is not null").withColumn("_bin2", F.explode(F.sequence(low, F.greatest(low, F.floor((F.col("_end") + 2 * EPSILON) / width)))))
    pairs = lefts.withColumn("_bin", F.floor(F.col(begin) / width)).join(b, (F.col(key) == F.col("_key")) & (F.col("_bin") == F.col("_bin2")) & covers, "left")
    best = _pick(pairs, left, F.col("_take"), F.struct("_begin", "_end", "_take"))
    return best.select("_row.*", *[F.col(f"_best.{c}").alias(c) for c in columns])


def enrich(segments: DataFrame, reference: DataFrame, key: str, audit: dict[str, str], fill: dict[str, str], source: str, value: str = "AADT", order: list[str] | None = None) -> DataFrame:
    """Best-overlap enrichment: audit columns always take the reference, fill columns only where they are null.

    Of references that overlap alike and begin alike the first in ``order`` (columns of the
    reference) counts, by default that of the least values.

    ``audit`` and ``fill`` map target columns to reference columns. Where ``value`` was
    filled, ``<value>_SOURCE`` and ``<value>_FILL_METHOD`` say so.
    """
    wanted = sorted({*audit.values(), *fill.values()})
    r = reference.select(key, "from_mp", "to_mp", *[F.col(c).alias(f"_r_{c}") for c in dict.fromkeys([*wanted, *(order or [])])])
    found = best_overlap(segments, r, key, [f"_r_{c}" for c in wanted], [f"_r_{c}" for c in [*(order or []), *wanted]])
    new = {t: F.col(f"_r_{c}") for t, c in audit.items()}
    new |= {t: F.coalesce(F.col(t), F.col(f"_r_{c}")) for t, c in fill.items()}
    if value in fill:
        filled = F.col(value).isNull() & F.col(f"_r_{fill[value]}").isNotNull()
        new[f"{value}_SOURCE"] = F.when(filled, source).otherwise(F.col(f"{value}_SOURCE") if f"{value}_SOURCE" in segments.columns else F.when(F.col(value).isNotNull(), "official_exact"))
        new[f"{value}_FILL_METHOD"] = F.when(filled, "best_overlap").otherwise(F.when(F.col(value).isNotNull(), "direct"))
    return found.withColumns(new).drop("overlap", *[f"_r_{c}" for c in wanted])


def yearly_values(segments: DataFrame, history: DataFrame, key: str, segment_id: str, value: str, years: list[int], name: str = "AADT_{}_HPMS", together: bool = False) -> DataFrame:
    """A column per year with the value of the best-overlapping record of that year: one join and one aggregate for all years (``together``: see ``best_overlap``)."""
    r = history.where(F.col("year").isin(*years)).select(F.col(key).alias("_key"), "year", F.col("from_mp").alias("_begin"), F.col("to_mp").alias("_end"), F.col(value).alias("_value"))
    near = _listed(segments, r, key, ["year", "_begin", "_end", "_value"]) if together else None
    if near is not None:
        shared = F.transform("_near", lambda x: F.struct((-_shared_miles(x, "from_mp", "to_mp")).alias("_less"), x["_begin"].alias("_begin"), x["_value"].alias("_value"), x["year"].alias("year")))
        told = near.select(*segments.columns, F.filter(shared, lambda x: -x["_less"] > EPSILON).alias("_met"))
        best = {y: F.array_min(F.filter("_met", lambda x: x["year"] == y))["_value"] for y in years}
        return told.select(*segments.columns, *[b.cast("bigint").alias(name.format(y)) for y, b in best.items()])
    pairs = _pairs(segments, r, key, "from_mp", "to_mp", BIN, ["_key", "year", "_begin", "_end"], F.struct("_value")).where(F.col("_shared") > EPSILON)
    rank = F.struct((-F.col("_shared")).alias("_less"), "_begin", "_first")
    best = pairs.groupBy(*_OWN).agg(*[F.min(F.when(F.col("year") == y, rank)).alias(f"_best_{y}") for y in years])
    new = {name.format(y): F.col(f"_best_{y}._first._value").cast("bigint") for y in years}
    told = _given(segments, best, key, "from_mp", "to_mp").select(*segments.columns, *[v.alias(n) for n, v in new.items()])
    bare = segments.where(F.col("from_mp").isNull() | F.col("to_mp").isNull())
    return told.unionByName(bare.select("*", *[F.lit(None).cast("bigint").alias(n) for n in new]))


def fill_from_overlap(segments: DataFrame, reference: DataFrame, key: str, fill: dict[str, str], together: bool = False) -> DataFrame:
    """Null columns (keys of ``fill``) take the column named there of the best-overlapping reference row; nothing else changes (``together``: see ``best_overlap``)."""
    wanted = list(dict.fromkeys(fill.values()))
    r = reference.select(key, "from_mp", "to_mp", *[F.col(c).alias(f"_r_{c}") for c in wanted])
    found = best_overlap(segments, r, key, [f"_r_{c}" for c in wanted], together=together)
    return found.withColumns({t: F.coalesce(F.col(t), F.col(f"_r_{c}")) for t, c in fill.items()}).select(*segments.columns)


def dedupe_intervals(df: DataFrame, key: list[str], order: list[str], told: Observation | None = None) -> DataFrame:
    """The first row (by ``order``) of each (route, begin, end); ``told`` learns, as the result is read, how many rows there were and went (``rows``, ``dropped``)."""
    n = free_name(df, "_n")
    rows = df.withColumn(n, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    if told is not None:
        rows = rows.observe(told, F.count("*").alias("rows"), F.count_if(F.col(n) > 1).alias("dropped"))
    return rows.where(F.col(n) == 1).drop(n)


def unambiguous(df: DataFrame, keys: list[str], value: str, flags: list[str]) -> DataFrame:
    """Keys with one distinct value: the value, and flags that hold for any of their rows."""
    told = df.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_most"), *[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags])
    return told.where(F.col(value) == F.col("_most")).drop("_most")


def direction_mirror(segments: DataFrame, columns: list[str], covered: Column, route: str = "ROUTE_ID", min_overlap: float = EPSILON, strict: bool = False) -> DataFrame:
    """Uncovered rows of routes that end in DEC take ``columns`` of the best-overlapping covered row of the INC route; ``mirrored`` says which."""
    base, way = F.expr(f"substring({route}, 1, length({route}) - 3)"), F.expr(f"right({route}, 3)")
    told = segments.withColumns({"_base": base, "_open": (way == "DEC") & ~F.coalesce(covered, F.lit(False))})
    giver = segments.where((way == "INC") & covered).select(base.alias("_base"), "from_mp", "to_mp", *[F.col(c).alias(f"_m_{c}") for c in columns])
    taken = best_overlap(told.where("_open"), giver, "_base", [f"_m_{c}" for c in columns], min_overlap=min_overlap, strict=strict)
    hit = F.col("overlap").isNotNull()
    taken = taken.withColumns({c: F.when(hit, F.col(f"_m_{c}")).otherwise(F.col(c)) for c in columns}).withColumn("mirrored", hit)
    rest = told.where("not coalesce(_open, false)").withColumn("mirrored", F.lit(False))
    return rest.select(*segments.columns, "mirrored").unionByName(taken.select(*segments.columns, "mirrored"))


def mirror_intervals(intervals: DataFrame, routes: DataFrame, route: str = "ROUTE_ID") -> DataFrame:
    """Intervals, and those of the INC route without attributes for DEC routes that have none of their own."""
    bare = routes.where(F.expr(f"right({route}, 3)") == "DEC").select(route).distinct().join(intervals, route, "left_anti")
    giver = intervals.where(F.expr(f"right({route}, 3)") == "INC").select(F.expr(f"concat(substring({route}, 1, length({route}) - 3), 'DEC')").alias(route), "from_mp", "to_mp")
    return intervals.unionByName(giver.join(bare, route, "left_semi"), allowMissingColumns=True)


def segment_routes(routes: DataFrame, intervals: DataFrame, crossings: DataFrame | None = None, key: str = "ROUTE_ID") -> DataFrame:
    """Homogeneous pieces of each route: cut at interval ends and crossings, clamped to the route, four decimals.

    Routes: key, from_mp, to_mp and attributes; intervals: key, from_mp, to_mp;
    crossings: key, mp. A degenerate or uncut route stays whole. Pieces tile their route.
    """
    points = intervals.select(key, F.explode(F.array("from_mp", "to_mp")).alias("_mp"))
    if crossings is not None:
        points = points.unionByName(crossings.select(key, F.col("mp").alias("_mp")))
    points = points.withColumn("_mp", round_milepoint(F.col("_mp"))).where("_mp is not null").distinct()
    cuts = points.groupBy(key).agg(F.array_sort(F.collect_set("_mp")).alias("_cuts"))
    low, high = round_milepoint(F.col("from_mp")), round_milepoint(F.col("to_mp"))
    inner = F.filter(F.coalesce("_cuts", F.array().cast("array<double>")), lambda x: (x > low + EPSILON) & (x < high - EPSILON))
    told = routes.join(cuts, key, "left").withColumn("_ends", F.array_distinct(F.concat(F.array(low), inner, F.array(high))))
    whole = F.array(F.struct(F.col("from_mp").alias("b"), F.col("to_mp").alias("e")))
    pairs = F.arrays_zip(F.expr("slice(_ends, 1, size(_ends) - 1)").alias("b"), F.expr("slice(_ends, 2, size(_ends) - 1)").alias("e"))
    pieces = F.when(F.size("_ends") >= 2, pairs).otherwise(whole)
    rest = [c for c in routes.columns if c not in ("from_mp", "to_mp")]
    return told.select(*rest, F.posexplode(pieces).alias("piece", "_p")).select(*rest, "piece", F.col("_p.b").alias("from_mp"), F.col("_p.e").alias("to_mp"))


def segment_lines(routes: DataFrame, intervals: DataFrame, columns: list[str], crossings: DataFrame | None = None, key: str = "ROUTE_ID") -> DataFrame:
    """Pieces of each route (key, from_mp, to_mp, ``line``, attributes) with their part of the line and ``columns`` of the first interval that covers them.

    Pieces whose part of the line has no length go, as they have no place.
    """
    pieces = segment_routes(routes.drop("line"), intervals, crossings, key)
    cut = slice_lines(pieces, routes.select(key, "from_mp", "to_mp", "line"), key)
    return first_covering(cut.where("line is not null"), intervals, key, columns)


# What a gap run could be filled from, and how much that is worth.
GAP_STRATEGIES = {"interpolate_between_adjacent_covered": "high", "single_side_extension": "medium", "route_has_nonadjacent_covered_only": "low", "no_current_aadt_on_route": "low"}


def gap_runs(segments: DataFrame, covered: Column, route: str = "ROUTE_ID", value: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Contiguous runs of uncovered rows, with the rows on either side, a strategy and its priority.

    Columns: route, run, from_mp, to_mp, rows, length, has_before, has_after, before_mp (where
    the row before ends), after_mp (where the row after begins), with ``value`` also
    before_value and after_value, route_covered and route_uncovered (rows), strategy,
    priority, and ``keep`` of the run's first row. One window order per route.
    """
    w = Window.partitionBy(route).orderBy("from_mp", "to_mp")
    whole = Window.partitionBy(route)
    told = segments.select(route, "from_mp", "to_mp", F.struct(*[F.col(c) for c in keep], F.lit(0).alias("_0")).alias("_keep"), (F.col(value) if value else F.lit(None)).alias("_v"), F.coalesce(covered, F.lit(False)).alias("_on"))
    told = told.withColumn("_run", F.sum((F.col("_on") != F.coalesce(F.lag("_on").over(w), ~F.col("_on"))).cast("int")).over(w))
    beside = F.struct("_on", "from_mp", "to_mp", "_v")
    told = told.withColumns({"_before": F.lag(beside).over(w), "_after": F.lead(beside).over(w), "_all": F.count_if("_on").over(whole), "_none": F.count_if(~F.col("_on")).over(whole)})
    place = F.struct("from_mp", "to_mp")
    runs = told.where("not _on").groupBy(route, F.col("_run").alias("run")).agg(
        F.min("from_mp").alias("from_mp"), F.max("to_mp").alias("to_mp"), F.count("*").alias("rows"), F.sum(F.col("to_mp") - F.col("from_mp")).alias("length"),
        F.min_by("_before", place).alias("_before"), F.max_by("_after", place).alias("_after"), F.min_by("_keep", place).alias("_keep"), F.max("_all").alias("route_covered"), F.max("_none").alias("route_uncovered"),
    )
    before, after = F.coalesce(F.col("_before._on"), F.lit(False)), F.coalesce(F.col("_after._on"), F.lit(False))
    both, one, other, none = GAP_STRATEGIES
    strategy = F.when(before & after, both).when(before | after, one).when(F.col("route_covered") > 0, other).otherwise(none)
    priority = F.create_map(*[F.lit(x) for pair in GAP_STRATEGIES.items() for x in pair])[F.col("strategy")]
    values = [F.col("_before._v").alias("before_value"), F.col("_after._v").alias("after_value")] if value else []
    told = runs.select(route, "run", "from_mp", "to_mp", "rows", "length", before.alias("has_before"), after.alias("has_after"), F.col("_before.to_mp").alias("before_mp"), F.col("_after.from_mp").alias("after_mp"), *values, "route_covered", "route_uncovered", strategy.alias("strategy"), *[F.col(f"_keep.{c}").alias(c) for c in keep])
    return told.withColumn("priority", priority)


def _ordered(route: str) -> tuple[Window, Window, Window]:
    """The order along a route, all rows before in it, and all rows behind (as rows before in the reversed order, which Spark works off in one pass)."""
    w = Window.partitionBy(route).orderBy("from_mp", "to_mp")
    back = Window.partitionBy(route).orderBy(F.desc("from_mp"), F.desc("to_mp"))
    return w, w.rowsBetween(Window.unboundedPreceding, -1), back.rowsBetween(Window.unboundedPreceding, -1)


def interpolate_gaps(segments: DataFrame, value: str, official: Column, route: str = "ROUTE_ID", longest: float = 5.0) -> DataFrame:
    """Fill runs of rows without official value, up to ``longest`` in all, between two that have one; ``interpolated`` says which.

    ``official`` says whether a row's value is one. The rows beside a run are the next
    ones in order, whether or not they touch it. A row takes the value at its midpoint on
    the straight line from the end of the row before to the begin of the row after, clipped
    to that span (its middle if it has no length), rounded half to even.
    """
    w, past, ahead = _ordered(route)
    on = official & F.col(value).isNotNull()
    known = F.when(on, F.struct(F.col(value).cast("double").alias("v"), F.col("from_mp").alias("b"), F.col("to_mp").alias("e")))
    told = segments.withColumns({"_known": known, "_gap": ~F.coalesce(on, F.lit(False))})
    # the reversed order first, so that what follows the order along the route shares one sort
    told = told.withColumn("_n", F.last("_known", ignorenulls=True).over(ahead)).withColumn("_p", F.last("_known", ignorenulls=True).over(past))
    told = told.withColumn("_run", F.sum((F.col("_gap") != F.coalesce(F.lag("_gap").over(w), ~F.col("_gap"))).cast("int")).over(w))
    told = told.withColumn("_length", F.sum(F.col("to_mp") - F.col("from_mp")).over(Window.partitionBy(route, "_run")))
    span = F.col("_n.b") - F.col("_p.e")
    share = F.when(span <= EPSILON, 0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((F.col("from_mp") + F.col("to_mp")) / 2 - F.col("_p.e")) / span)))
    new = F.bround(F.col("_p.v") + share * (F.col("_n.v") - F.col("_p.v"))).cast("bigint")
    bracketed = F.col("_p").isNotNull() & F.col("_n").isNotNull()
    told = told.withColumn("interpolated", F.coalesce(F.col("_gap") & (F.col("_length") <= longest) & bracketed, F.lit(False)))
    return told.withColumn(value, F.when(F.col("interpolated"), new).otherwise(F.col(value).cast("bigint"))).drop("_known", "_gap", "_p", "_n", "_run", "_length")


def nearest_on_route(segments: DataFrame, value: str, route: str = "ROUTE_ID", farthest: float = 20.0) -> DataFrame:
    """Null values take the nearest known midpoint's on the route within ``farthest``; ties to the lower milepoint; ``nearest_distance`` tells how far.

    As-of in both directions over the ordered route, without a self-join.
    """
    middle = (F.col("from_mp") + F.col("to_mp")) / 2
    _, past, ahead = _ordered(route)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("_middle").alias("m")))
    told = segments.withColumn("_middle", middle).withColumn("_known", known)
    told = told.withColumns({"_p": F.last("_known", ignorenulls=True).over(past), "_n": F.last("_known", ignorenulls=True).over(ahead)})
    back, on = F.col("_middle") - F.col("_p.m"), F.col("_n.m") - F.col("_middle")
    earlier = back.isNotNull() & (on.isNull() | (back <= on))
    distance, found = F.when(earlier, back).otherwise(on), F.when(earlier, F.col("_p.v")).otherwise(F.col("_n.v"))
    fills = F.col(value).isNull() & (distance <= farthest)
    told = told.withColumn("nearest_distance", F.when(fills, distance)).withColumn(value, F.when(fills, found.cast("bigint")).otherwise(F.col(value)))
    return told.drop("_middle", "_known", "_p", "_n")


def merge_intervals(intervals: DataFrame, key: list[str], gap: float = 0.5, begin: str = "from_m", end: str = "to_m") -> DataFrame:
    """Intervals of a key merged where they overlap or lie within ``gap``."""
    w = Window.partitionBy(*key).orderBy(begin, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.coalesce((F.col(begin) > reach + gap).cast("int"), F.lit(0))).over(w)
    return intervals.withColumn("_island", island).groupBy(*key, "_island").agg(F.min(begin).alias(begin), F.max(end).alias(end)).drop("_island")


def component_ranges(parts: DataFrame, key: str = "ROUTE_ID") -> DataFrame:
    """from_mp and to_mp of each part of a route by its share of the cumulative length; parts: key, part, length, route_from, route_to."""
    w = Window.partitionBy(key).orderBy("part")
    so_far, total = F.sum("length").over(w), F.sum("length").over(Window.partitionBy(key))
    span = F.col("route_to") - F.col("route_from")
    return parts.withColumns({"from_mp": F.col("route_from") + span * (so_far - F.col("length")) / total, "to_mp": F.col("route_from") + span * so_far / total})
