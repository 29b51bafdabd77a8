"""Station joins, predictions and cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.classify import resolver_confidence
from waymark.functions.scalars import fc_bin, haversine_m, percent, urban_rural
from waymark.lineage import checkpointed
from waymark.operators.quantiles import SMALL, exact_quantiles, largest_group


def knn(points: DataFrame, stations: DataFrame, id_: str, station: str, k: int = 5, by: list[str] | None = None, cell: float | None = None) -> DataFrame:
    """The ``k`` nearest stations of each point (x, y in metres) of a group (``by``): id, group, k_rank, station, distance.

    Groups (years) are searched apart: a point of several groups has its own neighbours, its
    own end of the search and its own ranks in each, and a group's cells are as wide as hold
    about ``k`` of its stations on average (or ``cell``). Points meet stations of their own
    and the eight neighbouring cells; a point is final when its k-th distance lies within the
    ring searched, the others go on with cells twice as wide, until none is open: cells as
    wide as the group's extent and a point's distance to it hold every station, so a round
    count bounds nothing. Points far outside begin at the stations' border: they are moved
    onto it for the choice of cells. A station is told to the nine cells from which it is
    seen, so a point is shuffled once and pairs never are: a cell's stations are lists of
    about ``_LISTED``, of which a point keeps the ``k`` best. Each round's points go to the
    checkpoint folder.

    Ties go to the smaller station id; of repeated points or stations of a group the least
    place counts; a place that is null, NaN or infinite is none; ranks without a station
    are padded with nulls, in a null group all of them.
    """
    by = by or []
    key = [id_, *by]

    def finite(c: str) -> Column:
        return F.when(F.abs(F.col(c)) < float("inf"), F.col(c).cast("double"))

    s = stations.select(*by, F.col(station).alias("_station"), F.struct(finite("x").alias("x"), finite("y").alias("y")).alias("_at")).where("_at.x is not null and _at.y is not null")
    s = s.groupBy(*by, "_station").agg(F.min("_at").alias("_at")).select(*by, "_station", F.col("_at.x").alias("_sx"), F.col("_at.y").alias("_sy"))
    extent = s.groupBy(*by).agg(F.min("_sx").alias("_lx"), F.max("_sx").alias("_hx"), F.min("_sy").alias("_ly"), F.max("_sy").alias("_hy"), F.count("*").alias("_supply"))
    width, height = F.col("_hx") - F.col("_lx"), F.col("_hy") - F.col("_ly")
    area = F.when((width > 0) & (height > 0), width * height).otherwise(F.pow(F.greatest(width, height), F.lit(2)) / F.col("_supply"))
    extent = checkpointed(extent.withColumn("_size", F.greatest(F.lit(1.0), F.sqrt(area * k / F.col("_supply"))) if cell is None else F.lit(float(cell))))
    # years are few; a table of many groups is joined by a shuffle instead
    few = F.broadcast(extent) if extent.count() <= _FEW_GROUPS else extent

    def grouped(df: DataFrame, how: str) -> DataFrame:
        return df.join(few, by, how) if by else df.crossJoin(F.broadcast(extent))

    s = grouped(s, "inner").select(*s.columns, "_size")
    place = F.struct(finite("x").alias("x"), finite("y").alias("y"))
    place = F.when(place["x"].isNotNull() & place["y"].isNotNull(), place)
    open_points = points.select(*key, place.alias("_at")).groupBy(*key).agg(F.min("_at").alias("_at"))
    open_points = grouped(open_points.select(*key, F.col("_at.x").alias("x"), F.col("_at.y").alias("y")), "left")
    need = F.when(F.col("x").isNull(), 0).otherwise(F.least(F.lit(k), F.coalesce("_supply", F.lit(0))))
    # where the search of a point begins: the nearest place of the stations' extent
    open_points = open_points.withColumns({"_need": need, "_ox": F.greatest("_lx", F.least("_hx", "x")), "_oy": F.greatest("_ly", F.least("_hy", "y"))})
    # a point that needs none is done; the others meet all stations around them in the one cell that they lie in
    none = F.lit(None).cast(f"array<struct<d:double,s:{s.schema['_station'].dataType.simpleString()}>>")
    done, times = open_points.where("_need = 0").select(*key, none.alias("_near")), 1.0
    open_points = open_points.where("_need > 0")
    cell_of = [*by, "_cx", "_cy"]
    while True:
        size = F.col("_size") * times
        around = F.explode(F.expr("flatten(transform(sequence(-1, 1), i -> transform(sequence(-1, 1), j -> struct(i, j))))"))
        cells = s.select(*by, "_station", "_sx", "_sy", F.floor(F.col("_sx") / size).alias("_px"), F.floor(F.col("_sy") / size).alias("_py"), around.alias("_o"))
        cells = cells.select(*by, (F.col("_px") + F.col("_o.i")).alias("_cx"), (F.col("_py") + F.col("_o.j")).alias("_cy"), F.struct("_station", "_sx", "_sy").alias("_s"), F.pmod(F.xxhash64("_station"), F.lit(_LISTS)).alias("_list"))
        # crowded cells have several lists of stations, so that none is long
        crowd = cells.groupBy(*cell_of).agg(F.ceil(F.count("*") / _LISTED).alias("_lists"))
        cells = cells.join(crowd, cell_of).groupBy(*cell_of, F.pmod("_list", "_lists").alias("_list")).agg(F.collect_list("_s").alias("_ss"))
        px, py = F.floor(F.col("_ox") / size), F.floor(F.col("_oy") / size)
        asked = open_points.withColumns({"_cx": px, "_cy": py}).join(cells, cell_of, "left")
        away = F.transform("_ss", lambda p: F.struct(F.sqrt(F.pow(F.col("x") - p["_sx"], 2) + F.pow(F.col("y") - p["_sy"], 2)).alias("d"), p["_station"].alias("s")))
        asked = asked.select(*cell_of, id_, F.struct(*open_points.columns).alias("_point"), F.slice(F.sort_array(away), 1, k).alias("_best"))
        told = asked.groupBy(*cell_of, id_).agg(F.first("_point").alias("_point"), F.flatten(F.collect_list("_best")).alias("_best"))
        told = told.select("_point.*", F.slice(F.sort_array("_best"), 1, k).alias("_near"))
        ox, oy = F.col("_ox"), F.col("_oy")
        # stations beyond the ring are at least this far from the place where the search begins, and farther from the point itself unless that lies outside
        border = F.least(ox - (px - 1) * size, (px + 2) * size - ox, oy - (py - 1) * size, (py + 2) * size - oy)
        outside = F.sqrt(F.pow(F.col("x") - ox, 2) + F.pow(F.col("y") - oy, 2))
        reach = F.when(outside == 0, border).otherwise(F.sqrt(F.pow(border, 2) + F.pow(outside, 2)))
        covered = ((px - 1) * size <= F.col("_lx")) & ((px + 2) * size > F.col("_hx")) & ((py - 1) * size <= F.col("_ly")) & ((py + 2) * size > F.col("_hy"))
        enough = F.coalesce((F.size("_near") >= F.col("_need")) & (F.element_at("_near", -1)["d"] <= reach), F.lit(False))
        told = checkpointed(told.withColumn("_final", F.coalesce(covered, F.lit(False)) | enough))
        done = done.unionByName(told.where("_final").select(*key, "_near"))
        open_points = told.where("not _final").drop("_near", "_final")
        times *= 2
        if open_points.isEmpty():
            break
    ranks = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get("_near", i)))
    wide = done.select(*key, ranks.alias("k_rank", "_n"))
    return wide.select(*key, (F.col("k_rank") + 1).alias("k_rank"), F.col("_n.s").alias(station), F.col("_n.d").alias("distance"))


#: groups that are broadcast at most; their count is checked
_FEW_GROUPS = 10_000
#: stations in a list of a crowded cell, on average, and lists of a cell at most
_LISTED, _LISTS = 256, 1 << 40
ANCHOR_YEAR = 2024


def _on_earth(lat: str, lon: str) -> Column:
    """Whether a latitude and a longitude are numbers in range; a NaN is greater than any number."""
    return (F.abs(F.col(lat)) <= 90) & (F.abs(F.col(lon)) <= 360)


def _placed(df: DataFrame) -> DataFrame:
    """Rows with null coordinates where these are no place on earth."""
    fine = _on_earth("latitude", "longitude")
    return df.withColumns({c: F.when(fine, F.col(c)) for c in ("latitude", "longitude")})


def _lat_lon_cells(df: DataFrame, degree: float) -> DataFrame:
    """Cells of latitude and longitude; one of longitude is wide enough up to 66 degrees of latitude."""
    return df.withColumns({"_cy": F.floor(F.col("latitude") / degree), "_cx": F.floor(F.col("longitude") / (degree * 2.5))})


def _around(df: DataFrame) -> DataFrame:
    """Rows for their own cell and the eight around it."""
    near = F.explode(F.expr("flatten(transform(sequence(-1, 1), i -> transform(sequence(-1, 1), j -> struct(i, j))))"))
    return df.withColumn("_o", near).withColumns({"_cy": F.col("_cy") + F.col("_o.i"), "_cx": F.col("_cx") + F.col("_o.j")}).drop("_o")


def nearest_anchor(targets: DataFrame, anchors: DataFrame, radius: float = 500.0) -> DataFrame:
    """(year, tc_number, metres) to the nearest of ``anchors`` (latitude, longitude), whatever the distance.

    Targets meet anchors of their cell and those around it; who finds one within the
    radius that a cell spans is done, the others go on with twice the radius.
    """
    a = anchors.select(F.col("latitude").alias("a_lat"), F.col("longitude").alias("a_lon"), "latitude", "longitude").where(_on_earth("latitude", "longitude")).distinct()
    open_rows, done = targets.select("year", "tc_number", "latitude", "longitude"), None
    if a.isEmpty():
        return open_rows.select("year", "tc_number", F.lit(None).cast("double").alias("metres"))
    while True:
        degree = radius / 111_000.0
        whole = degree > 72
        d = haversine_m(F.col("latitude"), F.col("longitude"), F.col("a_lat"), F.col("a_lon"))
        cells = _lat_lon_cells(a, degree).drop("latitude", "longitude")
        near = _around(_lat_lon_cells(open_rows, degree)).join(cells, ["_cy", "_cx"]).withColumn("_d", d)
        found = near.groupBy("year", "tc_number").agg(F.min("_d").alias("metres"))
        told = checkpointed(open_rows.join(found, ["year", "tc_number"], "left").withColumn("_final", F.coalesce(F.col("metres") <= radius, F.lit(False)) | F.lit(whole)))
        ready = told.where("_final").select("year", "tc_number", "metres")
        done = ready if done is None else done.unionByName(ready)
        open_rows = told.where("not _final").drop("metres", "_final")
        radius *= 4
        if open_rows.isEmpty():
            return done


def _first_rows(df: DataFrame, key: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    return df.withColumn("_turn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("_turn") <= n).drop("_turn")


def _around_values(entries: DataFrame, asked: DataFrame) -> DataFrame:
    """(_place, _group, _v, _near): for each asked value the anchors of the two next values below (or equal) and above.

    ``entries``: _place, _group, _v and its anchors (_ids), a row a value; ``asked``: _place, _group, _v.
    """
    key = ["_place", "_group"]
    order = Window.partitionBy(*key).orderBy("_v")
    e = entries.withColumns({"_down": F.lag("_ids").over(order), "_up": F.lead("_ids").over(order)})
    none = F.lit(None).cast(entries.schema["_ids"].dataType)
    rows = e.withColumn("_ask", F.lit(False)).unionByName(asked.select(*key, "_v", none.alias("_ids"), none.alias("_down"), none.alias("_up"), F.lit(True).alias("_ask")))
    # an entry comes before what asks for its value; what lies ahead is looked up in the reversed order
    entry = F.when(~F.col("_ask"), F.struct("_ids", "_down", "_up"))
    ways = {"_b": Window.partitionBy(*key).orderBy("_v", "_ask"), "_a": Window.partitionBy(*key).orderBy(F.col("_v").desc(), "_ask")}
    for name, way in ways.items():
        rows = rows.withColumn(name, F.last(entry, True).over(way.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    met = rows.where("_ask")
    return met.select(*key, "_v", F.flatten(F.filter(F.array("_b._ids", "_b._down", "_a._ids", "_a._up"), lambda x: x.isNotNull())).alias("_near"))


def _within_reach(targets: DataFrame, anchors: DataFrame, radius: float) -> DataFrame:
    """(_t, n, best, next) of kinds of targets (_t: latitude, longitude, aadt, fc): anchors within the radius, the best and the score of the runner-up.

    Places meet, not stations. At a place, of the anchors of the target's class, those of
    none, and all together, the closest in value are those of the two next values on either
    side, and where ratios are capped or missing the least ids count; so a few anchors of
    each hold the best two, however many stations a place has.
    """
    degree, place = radius / 111_000.0, F.struct("latitude", "longitude")
    # a value that is no positive number gives no ratio
    a = anchors.select(place.alias("_place"), F.col("tc_number").alias("id"), F.when(F.col("aadt") > 0, F.col("aadt")).alias("_v"), F.col("functional_class").cast("int").alias("fc"))
    a = checkpointed(a)
    sizes = a.groupBy("_place").agg(F.count("*").alias("_size"))
    g = a.withColumn("_group", F.explode(F.array(F.lit("all"), F.coalesce(F.col("fc").cast("string"), F.lit("none")))))
    one = F.struct("id", "_v", "fc")
    entries = _first_rows(g.where("_v is not null"), ["_place", "_group", "_v"], ["id"], 2).groupBy("_place", "_group", "_v").agg(F.collect_list(one).alias("_ids"))
    # of three ids at most one is nearer than the cap where the cap decides
    least = _first_rows(g.withColumn("_none", F.col("_v").isNull()), ["_place", "_group", "_none"], ["id"], 3).groupBy("_place", "_group").agg(F.collect_list(one).alias("_least"))

    def celled(df: DataFrame) -> DataFrame:
        return _lat_lon_cells(df, degree)

    spots = celled(sizes.select("_place.*", "_place", "_size")).select("_cy", "_cx", "_place", "_size")
    asked = _around(celled(targets.select("_t.latitude", "_t.longitude").distinct()))
    d = haversine_m(F.col("latitude"), F.col("longitude"), F.col("_place.latitude"), F.col("_place.longitude"))
    reach = checkpointed(asked.join(spots, ["_cy", "_cx"]).withColumn("_d", d).where(F.col("_d") <= radius).select(place.alias("_at"), "_place", "_size", "_d"))
    t = targets.select("_t", F.struct("_t.latitude", "_t.longitude").alias("_at"), F.when(F.col("_t.aadt") > 0, F.col("_t.aadt")).alias("_v"), F.col("_t.fc").alias("_fc"))
    groups = F.when(F.col("_fc").isNull(), F.array(F.lit("all"))).otherwise(F.array(F.lit("all"), F.col("_fc").cast("string"), F.lit("none")))
    met = t.join(reach.drop("_size"), "_at").drop("_at").withColumn("_group", F.explode(groups))
    near = _around_values(entries, met.where("_v is not null").select("_place", "_group", "_v").distinct())
    met = met.join(near, ["_place", "_group", "_v"], "left").join(least, ["_place", "_group"], "left")

    def scored(x: Column) -> Column:
        ratio = F.when(F.col("_v").isNotNull() & x["_v"].isNotNull(), F.least(F.lit(2.0), F.abs(F.log(x["_v"] / F.col("_v")))) / 2)
        differs = (F.col("_fc") != x["fc"]).cast("double")
        score = 0.30 * F.col("_d") / radius + 0.35 * F.coalesce(ratio, F.lit(0.5)) + 0.35 * F.coalesce(differs, F.lit(0.5))
        return F.struct(score.alias("_score"), x["id"].alias("a_tc"), F.col("_d"))

    empty = F.array().cast(entries.schema["_ids"].dataType)
    every = F.transform(F.concat(F.coalesce("_near", empty), F.coalesce("_least", empty)), scored)

    def two(found: Column) -> Column:
        return F.slice(F.array_distinct(found), 1, 2)

    # an anchor is among a row's candidates three times at most
    best = met.select("_t", two(F.slice(F.sort_array(every), 1, 6)).alias("_best"))
    best = best.groupBy("_t").agg(two(F.sort_array(F.flatten(F.collect_list("_best")))).alias("_best"))
    n = reach.groupBy("_at").agg(F.sum("_size").alias("n"))
    told = best.withColumn("_at", F.struct("_t.latitude", "_t.longitude")).join(n, "_at")
    return told.select("_t", "n", F.get("_best", 0).alias("best"), F.get("_best", 1)["_score"].alias("next"))


def resolve_stations(anchor: DataFrame, target: DataFrame, radius: float = 500.0, anchor_year: int = ANCHOR_YEAR) -> DataFrame:
    """Identity of each target station (year, tc_number, latitude, longitude, aadt, functional_class) among the anchors.

    The same id within the radius is the same station (tc_number); else the only candidate
    within it (spatial), or the best of several (scored): the least of 0.30 distance + 0.35
    half log ratio + 0.35 class difference, half of a weight where a value is missing, with
    the margin to the runner-up; equal scores go to the smaller id. Without a candidate a
    station has an id of its own (tc_conflict if an anchor has its number, else
    unresolved) and the distance to the nearest anchor. Places meet by grid cells at
    least a radius wide. Coordinates that are no place on earth count as missing.
    """
    anchor, target = _placed(anchor), _placed(target)
    a = anchor.where("latitude is not null").select(F.col("tc_number").alias("a_tc"), F.col("latitude").alias("a_lat"), F.col("longitude").alias("a_lon"))
    kind = F.struct("latitude", "longitude", "aadt", F.col("functional_class").cast("int").alias("fc"))
    kinds = target.where("latitude is not null").select("year", "tc_number", "latitude", "longitude", kind.alias("_t"))
    told = _within_reach(kinds.select("_t").distinct(), anchor.where("latitude is not null"), radius)
    own = a.select(F.col("a_tc").alias("tc_number"), "a_lat", "a_lon")
    d = haversine_m(F.col("latitude"), F.col("longitude"), F.col("a_lat"), F.col("a_lon"))
    own = kinds.join(own, "tc_number").withColumn("_d", d).where(F.col("_d") <= radius).groupBy("year", "tc_number").agg(F.lit(True).alias("has_own"), F.min(F.struct("_d", F.col("tc_number").alias("a_tc"))).alias("own"))
    told = kinds.select("year", "tc_number", "_t").join(told, "_t").drop("_t")
    everyone = target.select("year", "tc_number", "latitude", "longitude").join(told, ["year", "tc_number"], "left").join(own, ["year", "tc_number"], "left")
    known = anchor.where("latitude is not null and longitude is not null").select(F.col("tc_number").alias("_known")).distinct()
    everyone = checkpointed(everyone.join(known, F.col("tc_number") == F.col("_known"), "left"))
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    far = nearest_anchor(everyone.where(placed & F.col("n").isNull()), a.select(F.col("a_lat").alias("latitude"), F.col("a_lon").alias("longitude")), radius)
    everyone = everyone.join(far, ["year", "tc_number"], "left")
    own = F.coalesce("has_own", F.lit(False))
    method = F.when(~placed, "unresolved").when(own, "tc_number").when(F.col("n") == 1, "spatial").when(F.col("n") > 1, "scored").when(F.col("_known").isNotNull(), "tc_conflict").otherwise("unresolved")
    margin = F.when(method == "scored", F.col("next") - F.col("best._score"))
    anchored = F.concat(F.lit(f"GA{anchor_year % 100:02d}_"), F.when(own, F.col("own.a_tc")).otherwise(F.col("best.a_tc")))
    uid = F.when(F.col("n") >= 1, anchored).otherwise(F.concat(F.lit("GA"), F.lpad((F.col("year") % 100).cast("string"), 2, "0"), F.lit("_"), F.col("tc_number")))
    delta = F.when(own, F.col("own._d")).when(F.col("n") >= 1, F.col("best._d")).otherwise(F.col("metres"))
    return everyone.select("year", "tc_number", uid.alias("station_uid"), method.alias("resolver_method"), delta.alias("resolver_delta_m"), resolver_confidence(margin).alias("resolver_confidence"))


def run_resolver(stations: DataFrame, radius: float = 500.0, anchor_year: int = ANCHOR_YEAR) -> DataFrame:
    """Resolver rows of all years at once: the anchor year's stations as they are, all others against them.

    Of repeated (year, tc_number) the least row counts. Stations without coordinates are
    unresolved, and so are all where the anchor year has none with coordinates.
    """
    columns = ["latitude", "longitude", "aadt", "functional_class"]
    once = _placed(stations).groupBy("year", "tc_number").agg(F.min(F.struct(*columns)).alias("_s")).select("year", "tc_number", "_s.*")
    anchor = once.where(F.col("year") == anchor_year)
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    own = anchor.select(
        "year", "tc_number", F.concat(F.lit(f"GA{anchor_year % 100:02d}_"), "tc_number").alias("station_uid"), F.lit("anchor").alias("resolver_method"),
        F.when(placed, 0.0).alias("resolver_delta_m"), F.when(placed, "high").otherwise("low").alias("resolver_confidence"),
    )
    return own.unionByName(resolve_stations(anchor, once.where(F.col("year") != anchor_year), radius, anchor_year))


def resolver_report(resolved: DataFrame, anchor_year: int = ANCHOR_YEAR) -> DataFrame:
    """By year: rows by method and by confidence, the resolved share, and quantiles of the distance of resolved stations."""
    methods = ("anchor", "tc_number", "spatial", "scored", "tc_conflict", "unresolved")
    moved = F.when((F.col("resolver_method") != "anchor") & F.col("resolver_delta_m").isNotNull(), F.col("resolver_delta_m"))
    told = resolved.groupBy("year").agg(
        F.count("*").alias("rows"), *[F.count_if(F.col("resolver_method") == m).alias(m) for m in methods], *[F.count_if(F.col("resolver_confidence") == c).alias(c) for c in ("high", "medium", "low")],
        percent(F.count_if(F.col("resolver_method") != "unresolved"), F.count("*")).alias("resolved_pct"), F.max(moved).alias("max_m"),
    )
    told = _with_quantiles(told, resolved, ["year"], {"_": moved}, {"median_m": 0.5, "p95_m": 0.95}, SMALL).withColumnsRenamed({"__median_m": "median_m", "__p95_m": "p95_m"})
    return told.select(*[c for c in told.columns if c != "max_m"], "max_m")


def nearest_station(points: DataFrame, stations: DataFrame, id_: str, station: str, by: list[str] | None = None) -> DataFrame:
    """The nearest station of each point; points without any keep a row of nulls."""
    return knn(points, stations, id_, station, 1, by).drop("k_rank")


def station_routes(segments: DataFrame, stations: DataFrame, id_: str = "unique_id", route: str = "ROUTE_ID", station: str = "tc_number") -> DataFrame:
    """(station, inferred_route): the route of the segment (x, y of its midpoint) that is nearest to each station."""
    link = knn(stations.select(station, "x", "y"), segments.select(id_, "x", "y"), station, id_, 1)
    return link.join(segments.select(id_, route), id_, "left").select(station, F.col(route).alias("inferred_route"))


def same_route_flag(links: DataFrame, segments: DataFrame, routes: DataFrame, id_: str = "unique_id", route: str = "ROUTE_ID", station: str = "tc_number") -> DataFrame:
    """Links (id, station) with same_route_flag: 1 if the station's inferred route is the segment's, else 0."""
    told = links.join(segments.select(id_, route), id_, "left").join(routes, station, "left")
    return told.withColumn("same_route_flag", F.coalesce(F.col(route) == F.col("inferred_route"), F.lit(False)).cast("int")).drop(route, "inferred_route")


def attach_nearest_value(stations: DataFrame, segments: DataFrame, value: str, name: str, id_: str = "unique_id", station: str = "station_uid") -> DataFrame:
    """Stations with the value of the nearest segment that has one."""
    known = segments.where(F.col(value).isNotNull())
    link = knn(stations.select(station, "x", "y"), known.select(id_, "x", "y"), station, id_, 1)
    return stations.join(link.join(known.select(id_, F.col(value).alias(name)), id_, "left").select(station, name), station, "left")


def station_segment_attributes(stations: DataFrame, resolver: DataFrame, links: DataFrame, segments: DataFrame) -> DataFrame:
    """Stations with station_uid, and fc_bin, urban_rural and district of the segment they are the nearest station of.

    ``links``: year, k_rank, nearest_tc_number, unique_id. Of several segments the nearest
    (the smallest id of equals) counts, so a station stays one row.
    """
    first = links.where("k_rank = 1").groupBy("year", F.col("nearest_tc_number").alias("tc_number"))
    link = first.agg(F.min_by("unique_id", F.struct(F.col("station_distance_m"), F.col("unique_id"))).alias("nearest_segment_uid"))
    told = stations.join(resolver.select("year", "tc_number", "station_uid"), ["year", "tc_number"], "left").join(link, ["year", "tc_number"], "left")
    attributes = segments.select(F.col("unique_id").alias("nearest_segment_uid"), fc_bin(F.col("FUNCTIONAL_CLASS")).alias("fc_bin"), urban_rural(F.col("URBAN_CODE")).alias("urban_rural"), F.col("DISTRICT").alias("district"))
    return told.join(attributes, "nearest_segment_uid", "left")


def actual_on_flagged(links: DataFrame, stations: DataFrame, segments: DataFrame, flag: str, value: str) -> DataFrame:
    """(unique_id, tc_number, aadt_actual, value): stations of type Actual whose linked segment is flagged and has the same value within 1."""
    actual = stations.where("statistics_type = 'Actual'").select("year", F.col("tc_number").alias("nearest_tc_number"), F.col("aadt").alias("aadt_actual"))
    flagged = segments.where(F.col(flag) == 1).select("unique_id", F.col(value).alias("value"))
    met = links.join(actual, ["year", "nearest_tc_number"]).join(flagged, "unique_id")
    return met.where(F.abs(F.col("aadt_actual") - F.col("value")) < 1).select("unique_id", F.col("nearest_tc_number").alias("tc_number"), "aadt_actual", "value")


def assign_folds(ids: DataFrame, column: str, folds: int = 5, seed: str = "42") -> DataFrame:
    """Folds of the distinct ids by their order of md5(seed, id), balanced within one.

    The order comes from a global sort of the distinct ids (stations, some ten thousand);
    row numbers are worked out per range of the sort, from the ranges' sizes.
    """
    ranked = ids.select(column).distinct().withColumn("_h", F.md5(F.concat(F.lit(seed), F.col(column).cast("string"))))
    ranked = ranked.withColumn("_b", F.substring("_h", 1, 2))
    before = ranked.groupBy("_b").count()
    before = before.select("_b", (F.sum("count").over(Window.orderBy("_b")) - F.col("count")).alias("_before"))  # at most 256 rows
    within = F.row_number().over(Window.partitionBy("_b").orderBy("_h", column))
    return ranked.withColumn("_n", within).join(F.broadcast(before), "_b").select(column, ((F.col("_before") + F.col("_n") - 1) % folds).cast("int").alias("fold"))


def idw_predict(knn_links: DataFrame, stations: DataFrame, id_: str = "unique_id", value: str = "aadt", cutoff: float = 2000.0) -> DataFrame:
    """Inverse-distance prediction by (id, year): rounded value, neighbours' bounds that contain it, confidence and number used.

    Links: id, year, k_rank, nearest_tc_number, station_distance_m, same_route_flag. Neighbours
    within ``cutoff`` that have a value count; if the first in rank lies beyond it, there
    is no prediction. The first in rank, with or without a value, gives the confidence:
    high within 500 m on the same route, else medium; none without a prediction.
    """
    s = stations.select("year", F.col("tc_number").alias("nearest_tc_number"), F.col(value).cast("double").alias("_v")).where("_v is not null")
    met = knn_links.join(s, ["year", "nearest_tc_number"], "left")
    d = F.col("station_distance_m")
    v = F.when((d <= cutoff) & F.col("_v").isNotNull(), F.col("_v"))
    w = F.when(v.isNotNull(), 1 / F.greatest(d, F.lit(1.0)))
    told = met.groupBy(id_, "year").agg(
        (F.sum(w * v) / F.sum(w)).alias("_p"), F.min(v).alias("_low"), F.max(v).alias("_high"), F.count(v).alias("_used"),
        F.min_by(F.struct(d.alias("d"), F.col("same_route_flag").alias("same"), F.col("nearest_tc_number").alias("tc")), "k_rank").alias("_first"),
    )
    reached = (F.col("_used") > 0) & F.coalesce(F.col("_first.d") <= cutoff, F.lit(False))
    p = F.when(reached, F.bround("_p").cast("bigint"))
    close = (F.col("_first.d") <= 500) & (F.col("_first.same") == 1)
    return told.select(
        id_, "year", p.alias("predicted"), F.when(reached, F.least(F.bround("_low").cast("bigint"), p)).alias("lower"), F.when(reached, F.greatest(F.bround("_high").cast("bigint"), p)).alias("upper"),
        F.when(~reached, "none").when(close, "high").otherwise("medium").alias("confidence"), F.when(reached, F.col("_used")).otherwise(F.lit(0)).cast("bigint").alias("n_used"),
        F.bround("_first.d", 1).alias("nearest_distance_m"), F.col("_first.tc").alias("nearest_tc_number"),
    )


def truck_aadt(single: Column, combo: Column) -> Column:
    """Single-unit and combination trucks together; null if neither is known."""
    return F.when(single.isNotNull() | combo.isNotNull(), F.coalesce(single, F.lit(0)) + F.coalesce(combo, F.lit(0)))


def station_wide(stations: DataFrame, resolver: DataFrame, years: list[int], values: tuple[str, ...] = ("aadt",), anchor: int | None = None, attributes: tuple[str, ...] = ("latitude", "longitude", "functional_class", "statistics_type")) -> DataFrame:
    """One row per resolved station: a column per value and year (first by tc_number), and the number of years with data.

    With ``anchor`` only stations with a row of that year, with its ``attributes`` and number
    (``statistics_type`` and ``tc_number`` carry the year in their names); of several such rows
    that of the least number counts.
    """
    told = resolver.where("resolver_method <> 'unresolved'").select("year", "tc_number", "station_uid").join(stations, ["year", "tc_number"], "left")
    dated = {c: f"{c}_{anchor}" for c in ("statistics_type", "tc_number")}
    own = [F.min_by(F.when(F.col("year") == anchor, F.struct("tc_number", *attributes)), F.when(F.col("year") == anchor, F.col("tc_number"))).alias("_anchor")] if anchor is not None else []
    wide = told.groupBy("station_uid").agg(
        *[F.min_by(F.when(F.col("year") == y, F.col(v)), F.when((F.col("year") == y) & F.col(v).isNotNull(), F.col("tc_number"))).alias(f"{v}_{y}") for v in values for y in years], *own
    )
    wide = wide.withColumn("years_with_data", sum(F.col(f"{values[0]}_{y}").isNotNull().cast("int") for y in years))
    if anchor is None:
        return wide
    kept = [F.col(f"_anchor.{c}").alias(dated.get(c, c)) for c in ("tc_number", *attributes)]
    return wide.where("_anchor is not null").select("station_uid", *kept, *[c for c in wide.columns if c not in ("station_uid", "_anchor")])


def _with_quantiles(df: DataFrame, rows: DataFrame, keys: list[str], columns: dict[str, Column], shares: dict[str, float], small: int = 0) -> DataFrame:
    """``df`` (one row a key) with exact quantiles of ``rows``; null is a key like others."""
    found = exact_quantiles(rows, keys, columns, shares, small)
    key = F.struct(*keys, F.lit(0)).alias("_k")
    values = found.select(key, *[c for c in found.columns if c not in keys])
    return df.withColumn("_k", key).join(values, "_k", "left").drop("_k")


def _cohorts(rows: DataFrame, version: list[str], keys: list[str], size: Column, base: Column, ratios: dict[str, Column], min_size: int, small: int = SMALL) -> DataFrame:
    """Size, median of ``base`` and of each ratio by version and keys; small cohorts take all of them from the parent without the last key.

    Exact medians at both levels from one pass of grouping sets, or, where a parent has more
    than ``small`` rows, by selection; null is a key like others.
    """
    told = rows.withColumns({"_base": base} | {f"_{n}": x for n, x in ratios.items()})
    fixed, own_keys = [F.col(k) for k in version], [F.col(k) for k in keys]
    level = F.grouping(keys[-1])
    large = largest_group(told, [*version, *keys[:-1]]) > small
    medians = [F.median("_base").alias("median_value"), *[F.median(f"_{n}").alias(n) for n in ratios]]
    both = told.groupingSets([[*fixed, *own_keys], [*fixed, *own_keys[:-1]]], *fixed, *own_keys).agg(
        size.alias("n"), *([] if large else medians), level.cast("int").alias("_parent")
    )
    own, parent = both.where("_parent = 0").drop("_parent"), both.where("_parent = 1")
    if large:
        columns = {"median_value": F.col("_base")} | {n: F.col(f"_{n}") for n in ratios}
        own, parent = (_with_quantiles(df, told, names, columns, {"m": 0.5}).withColumnsRenamed({f"{c}_m": c for c in columns}) for df, names in ((own, [*version, *keys]), (parent, [*version, *keys[:-1]])))
    own, parent = own.alias("o"), parent.alias("p")
    on = F.lit(True)
    for k in [*version, *keys[:-1]]:
        on = on & F.col(f"o.{k}").eqNullSafe(F.col(f"p.{k}"))
    few = F.col("o.n") < min_size
    taken = [F.when(few, F.col(f"p.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in ("n", "median_value", *ratios)]
    return own.join(parent, on, "left").select(*[F.col(f"o.{k}").alias(k) for k in [*version, *keys]], *taken, few.cast("int").alias("fallback_used"))


COHORT_VERSIONS = ("full", "exclude_2020", "exclude_2022", "exclude_2023", "exclude_2024")
COHORT_KEYS = ["fc_bin", "urban_rural", "district"]


def _ratio(numerator: str, denominator: str) -> Column:
    return F.when(F.col(denominator) > 0, F.col(numerator) / F.col(denominator))


def cohort_ratios(segments: DataFrame, min_size: int = 30, names: str = "AADT_{}_HPMS") -> DataFrame:
    """Cohorts of segments (FUNCTIONAL_CLASS, URBAN_CODE, DISTRICT and the yearly values) in five versions.

    Columns: version, fc_bin, urban_rural, district, n, median_value (of 2020), ratio_2022 and
    ratio_2024 (to 2020), fallback_used. A version hides what rests on its year: exclude_2022
    and exclude_2024 their ratio, exclude_2020 all medians, exclude_2023 nothing.
    """
    year = names.format
    told = segments.withColumns({"fc_bin": fc_bin(F.col("FUNCTIONAL_CLASS")), "urban_rural": urban_rural(F.col("URBAN_CODE")), "district": F.col("DISTRICT")})
    ratios = {"ratio_2022": _ratio(year(2022), year(2020)), "ratio_2024": _ratio(year(2024), year(2020))}
    found = _cohorts(told, [], COHORT_KEYS, F.count("*"), F.col(year(2020)).cast("double"), ratios, min_size)
    found = found.crossJoin(F.broadcast(segments.sparkSession.createDataFrame([(v,) for v in COHORT_VERSIONS], "version string")))
    hidden = {"median_value": ["exclude_2020"], "ratio_2022": ["exclude_2020", "exclude_2022"], "ratio_2024": ["exclude_2020", "exclude_2024"]}
    return found.withColumns({c: F.when(~F.col("version").isin(*v), F.col(c)) for c, v in hidden.items()})


def station_cohort_ratios(stations: DataFrame, folds: int = 5, min_size: int = 30) -> DataFrame:
    """Cohorts of stations (station_uid, year, aadt, fc_bin, urban_rural, district) in a full version and one without each fold.

    One row per station and attributes carries the first value (by row order of value) of
    each year and goes into the versions that keep its station; sizes count distinct stations.
    """
    years = (2020, 2022, 2023, 2024)
    complete = stations.where("fc_bin is not null and urban_rural is not null and district is not null and station_uid is not null")
    wide = complete.groupBy("station_uid", *COHORT_KEYS).agg(*[F.min(F.when(F.col("year") == y, F.col("aadt"))).alias(f"_y{y}") for y in years])
    told = wide.join(assign_folds(stations.where("station_uid is not null"), "station_uid", folds), "station_uid")
    versions = F.concat(F.array(F.lit("full")), F.transform(F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda i: i != F.col("fold")), lambda i: F.concat(F.lit("fold_"), i.cast("string"))))
    told = told.withColumn("version", F.explode(versions))
    ratios = {"ratio_2022": _ratio("_y2022", "_y2020"), "ratio_2024": _ratio("_y2024", "_y2020")}
    return _cohorts(told, ["version"], COHORT_KEYS, F.count_distinct("station_uid"), F.col("_y2020").cast("double"), ratios, min_size)


def median_with_fallback(rows: DataFrame, value: str, levels: list[list[str]], small: int = SMALL) -> DataFrame:
    """Each row with the median of its first level (then the next, at last of all rows) that has one, and which it was.

    Medians are exact; a group of more than ``small`` rows, as all rows together are, never
    meets in one task. Rows with a null key have no median of that level.
    """
    found, cover, names = rows, [], []
    known = rows.where(F.col(value).isNotNull())
    for i, keys in enumerate([*levels, []]):
        level = exact_quantiles(known, keys, {"_m": F.col(value)}, {str(i): 0.5}, small).withColumnRenamed(f"_m_{i}", f"_m{i}")
        found = found.join(level, keys, "left") if keys else found.crossJoin(F.broadcast(level))
        cover.append(F.col(f"_m{i}"))
        names.append(F.when(F.col(f"_m{i}").isNotNull(), "+".join(keys) or "all"))
    found = found.withColumns({f"{value}_median": F.coalesce(*cover), f"{value}_median_level": F.coalesce(*names)})
    return found.drop(*[f"_m{i}" for i in range(len(levels) + 1)])


def implied_growth(now: Column, future: Column, years: int = 20) -> Column:
    """Compound yearly growth, clipped to -3 to 5 percent."""
    return F.when((now > 0) & (future > 0), F.greatest(F.lit(-0.03), F.least(F.lit(0.05), F.pow(future / now, 1.0 / years) - 1)))


def dominant_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value of each key; ties go to the smaller."""
    votes = df.where(F.col(value).isNotNull()).groupBy(key, value).count()
    return votes.groupBy(key).agg(F.min_by(value, F.struct(-F.col("count"), F.col(value))).alias(value))


def trajectory(years: list[int], columns: list[Column]) -> Column:
    """Struct level, slope, bend of the least-squares parabola of ln(value) on the centred year; null with fewer than 3 values."""
    centre = sum(years) / len(years)
    x = [float(y - centre) for y in years]
    v = [F.when(c > 0, F.log(c)) for c in columns]
    on = [c.isNotNull() for c in v]

    def total(p: int, q: bool) -> Column:
        return sum(F.when(o, F.lit(t**p) * (c if q else F.lit(1.0))).otherwise(0.0) for o, t, c in zip(on, x, v, strict=True))

    s = [total(p, False) for p in range(5)]
    b = [total(p, True) for p in range(3)]

    def det(m: list[list[Column]]) -> Column:
        return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])

    normal = [[s[i + j] for j in range(3)] for i in range(3)]
    whole = det(normal)
    parts = [det([[b[i] if j == k else normal[i][j] for j in range(3)] for i in range(3)]) / whole for k in range(3)]
    enough = s[0] >= 3
    return F.struct(*[F.when(enough, p).alias(n) for p, n in zip(parts, ("level", "slope", "bend"), strict=True)], F.lit(centre).alias("centre"))


def eligible_for_fit(a2020: Column, a2022: Column, a2023: Column, a2024: Column) -> Column:
    """Whether a segment has values of 2020 and 2022 and of at least one later year."""
    return a2020.isNotNull() & a2022.isNotNull() & (a2023.isNotNull() | a2024.isNotNull())


def clamp_prediction(raw: Column, a2020: Column, a2022: Column, widened: Column | bool = False) -> Column:
    """Within 0.8 of the lesser (0.5 if widened, never below half of 2022) and 1.2 of the greater of the values of 2020 and 2022."""
    wide = widened if isinstance(widened, Column) else F.lit(widened)
    low = F.greatest(F.least(a2020, a2022) * F.when(wide, 0.5).otherwise(0.8), a2022 * 0.5)
    return F.least(F.greatest(a2020, a2022) * 1.2, F.greatest(low, raw))


def trajectory_raw(fit: Column, year: int) -> Column:
    """The fitted value of a year; null where there is no fit."""
    t = F.lit(float(year)) - fit["centre"]
    return F.exp(fit["level"] + fit["slope"] * t + fit["bend"] * t * t)


def predict_2021(a2020: Column, a2022: Column, a2023: Column, a2024: Column, widened: Column | bool = False) -> Column:
    """The clamped prediction of 2021 of the eligible segments; null for others."""
    fit = trajectory([2020, 2022, 2023, 2024], [a2020, a2022, a2023, a2024])
    return F.when(eligible_for_fit(a2020, a2022, a2023, a2024), clamp_prediction(trajectory_raw(fit, 2021), a2020, a2022, widened))


def holdout_metrics(df: DataFrame, predicted: str, truth: str, by: list[str] | None = None) -> DataFrame:
    """Mean, median and 95th percentile of the absolute percentage error, and the share within 10 percent."""
    error = F.abs(percent(F.col(predicted) - F.col(truth), F.col(truth)))
    told = df.withColumn("_e", error).where("_e is not null")
    return told.groupBy(*(by or [])).agg(
        F.count("*").alias("n"), F.avg("_e").alias("mape"), F.median("_e").alias("median_ape"), F.percentile("_e", 0.95).alias("p95_ape"), percent(F.count_if(F.col("_e") <= 10), F.count("*")).alias("within_10_pct")
    )


# Weight of the pandemic's effect by year, and the gates of a validation.
COVID_WEIGHT = {2020: 1.0, 2021: 0.6, 2022: 0.15, 2023: 0.05, 2024: 0.0}
GATES = {"within_10_pct": 80.0, "median_ape": 8.0, "mape": 25.0}


def covid_widened(fc: Column, area: Column) -> Column:
    """Whether the lower bound is widened: urban segments of classes 1 to 3."""
    return F.coalesce((area == "urban") & fc.isin(1, 2, 3), F.lit(False))


def predict_held_out(year: int, values: dict[int, Column], widened: Column) -> Column:
    """Clamped prediction of a hidden year from at least three others; null without them or without its true value.

    The bounds come from 2020 and 2022, for a hidden 2022 from the next year that is there
    (2020 itself without one).
    """
    rest = [y for y in sorted(values) if y != year]
    fit = trajectory(rest, [values[y] for y in rest])
    later = F.coalesce(*[values[y] for y in (2023, 2024) if y in rest]) if year == 2022 else values[2022]
    clamped = clamp_prediction(trajectory_raw(fit, year), values[2020], F.coalesce(later, values[2020]), widened)
    return F.when(values[year].isNotNull() & fit["level"].isNotNull(), clamped)


def validation_gates(metrics: DataFrame) -> DataFrame:
    """Metrics with ``passes`` (share within 10 percent and median error) and ``stops`` (mean error beyond the hard limit)."""
    passes = (F.col("within_10_pct") >= GATES["within_10_pct"]) & (F.col("median_ape") <= GATES["median_ape"])
    return metrics.withColumns({"passes": passes, "stops": F.col("mape") > GATES["mape"]})


def idw_all_years(links: DataFrame, stations: DataFrame, years: list[int], id_: str = "unique_id") -> DataFrame:
    """One row per segment: predicted count, bounds, confidence and number used of each year, and predicted trucks.

    Trucks are single and combination units together, null only where both are.
    """
    one = stations.groupBy("year", "tc_number").agg(F.min(F.struct("aadt", "single_unit_aadt", "combo_unit_aadt")).alias("_s")).select("year", "tc_number", "_s.*")
    trucks = F.when(F.col("single_unit_aadt").isNotNull() | F.col("combo_unit_aadt").isNotNull(), F.coalesce("single_unit_aadt", F.lit(0)) + F.coalesce("combo_unit_aadt", F.lit(0)))
    total = idw_predict(links, one, id_)
    heavy = idw_predict(links, one.withColumn("trucks", trucks), id_, "trucks").select(id_, "year", F.col("predicted").alias("trucks"))
    told = total.join(heavy, [id_, "year"])
    names = {"predicted": "AADT_{}_MODELED", "lower": "AADT_{}_NEIGHBOR_MIN", "upper": "AADT_{}_NEIGHBOR_MAX", "confidence": "AADT_{}_CONFIDENCE", "n_used": "AADT_{}_N_STATIONS_USED", "trucks": "TRUCK_AADT_{}_MODELED"}
    return told.groupBy(id_).agg(*[F.max(F.when(F.col("year") == y, F.col(c))).alias(n.format(y)) for y in years for c, n in names.items()])


def idw_fill(segments: DataFrame, wanted: Column, links: DataFrame, stations: DataFrame, year: int, id_: str = "unique_id") -> DataFrame:
    """AADT_<year>_LOCAL_FILL and its confidence for the segments for which ``wanted`` holds, where a prediction exists; null for all others."""
    asked = segments.where(wanted).select(id_).distinct()
    told = idw_predict(links.where(F.col("year") == year).join(asked, id_, "left_semi"), stations.where(F.col("year") == year), id_).where("predicted is not null")
    fill = told.select(id_, F.col("predicted").alias(f"AADT_{year}_LOCAL_FILL"), F.col("confidence").alias(f"AADT_{year}_LOCAL_FILL_CONFIDENCE"))
    return segments.join(fill, id_, "left")


def knn_features_wide(rows: DataFrame, links: DataFrame, stations: DataFrame, k: int = 5) -> DataFrame:
    """(station_uid, year) with a column set for each of the ``k`` nearest other stations of a station's segment, and how many lie within 1 and 5 km.

    Rows: station_uid, year, tc_number, nearest_segment_uid. The station itself is left out and
    the rest ranked anew by distance (then id).
    """
    met = links.withColumnRenamed("unique_id", "nearest_segment_uid").join(rows.select("station_uid", "year", "tc_number", "nearest_segment_uid").distinct(), ["nearest_segment_uid", "year"])
    met = met.where(F.col("nearest_tc_number").isNotNull() & (F.col("nearest_tc_number") != F.col("tc_number")))
    order = Window.partitionBy("station_uid", "year").orderBy("station_distance_m", "nearest_tc_number", "nearest_segment_uid")
    met = met.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    facts = ["aadt", "k_factor", "d_factor", "functional_class", "statistics_type"]
    one = stations.groupBy("year", F.col("tc_number").alias("nearest_tc_number")).agg(F.min(F.struct(*facts)).alias("_s")).select("year", "nearest_tc_number", "_s.*")
    told = met.join(one, ["year", "nearest_tc_number"], "left")
    actual = F.when(F.col("aadt").isNotNull() | F.col("statistics_type").isNotNull(), F.coalesce(F.col("statistics_type") == "Actual", F.lit(False)).cast("int"))
    columns = {"distance": F.col("station_distance_m"), "same_route": F.col("same_route_flag"), "aadt": F.col("aadt"), "k_factor": F.col("k_factor"), "d_factor": F.col("d_factor"), "fc": F.col("functional_class"), "is_actual": actual}
    wide = [F.max(F.when(F.col("_r") == r, x)).alias(f"knn_{n}_{r}") for r in range(1, k + 1) for n, x in columns.items()]
    near = [F.count_if(F.col("station_distance_m") <= 1000 * km).alias(f"num_neighbors_within_{km}km") for km in (1, 5)]
    return told.groupBy("station_uid", "year").agg(*wide, *near)


def training_rows(stations: DataFrame, resolver: DataFrame, links: DataFrame, segments: DataFrame, cohorts: DataFrame, years: tuple[int, ...] = (2020, 2022, 2023, 2024)) -> DataFrame:
    """A row per station and year of type Actual: fold, attributes of the nearest segment, neighbours, cohort, and target ln(aadt).

    Years since 2020, the pandemic's weight, and half a sample weight for urban rows of 2020
    in classes 1 to 3.
    """
    wanted = stations.where((F.col("statistics_type") == "Actual") & F.col("year").isin(*years))
    told = wanted.join(resolver.select("year", "tc_number", "station_uid"), ["year", "tc_number"]).where("station_uid is not null")
    told = told.groupBy("station_uid", "year").agg(F.min(F.struct("tc_number", "aadt")).alias("_s")).select("station_uid", "year", "_s.tc_number", "_s.aadt")
    told = told.join(assign_folds(told, "station_uid"), "station_uid")
    first = links.where("k_rank = 1").groupBy("year", F.col("nearest_tc_number").alias("tc_number")).agg(F.min_by("unique_id", F.struct("station_distance_m", "unique_id")).alias("nearest_segment_uid"))
    told = told.join(first, ["year", "tc_number"], "left")
    attributes = segments.select(F.col("unique_id").alias("nearest_segment_uid"), "FUNCTIONAL_CLASS", fc_bin(F.col("FUNCTIONAL_CLASS")).alias("fc_bin"), urban_rural(F.col("URBAN_CODE")).alias("urban_rural"), F.col("DISTRICT").alias("district"))
    told = checkpointed(told.join(attributes, "nearest_segment_uid", "left"))
    told = told.join(knn_features_wide(told, links, stations), ["station_uid", "year"], "left")
    full = cohorts.where("version = 'full'").select("fc_bin", "urban_rural", "district", F.col("n").alias("cohort_size"), F.col("median_value").alias("cohort_median_2020"), "ratio_2022", "ratio_2024")
    told = told.join(full, ["fc_bin", "urban_rural", "district"], "left")
    weight = F.create_map(*[F.lit(x) for pair in COVID_WEIGHT.items() for x in pair])
    halved = (F.col("year") == 2020) & covid_widened(F.col("FUNCTIONAL_CLASS"), F.col("urban_rural"))
    return told.withColumns({"years_since_2020": F.col("year") - 2020, "covid_phase_weight": F.try_element_at(weight, F.col("year")), "target": F.log(F.greatest(F.col("aadt").cast("double"), F.lit(1.0))), "sample_weight": F.when(halved, 0.5).otherwise(1.0)})
