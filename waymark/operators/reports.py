"""Coverage, agreement and score reports."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.scalars import percent, round_even
from waymark.lineage import checkpointed
from waymark.operators.quantiles import exact_quantiles


def coverage_by(df: DataFrame, keys: list[str], covered: Column, miles: str, limit: int | None = None) -> DataFrame:
    """Rows and miles, covered and not, by keys; most uncovered miles first, at most ``limit`` of them (the report's own)."""
    on = F.coalesce(covered, F.lit(False))
    told = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count_if(on).alias("covered_rows"), F.count_if(~on).alias("uncovered_rows"),
        F.coalesce(F.sum(F.when(on, F.col(miles))), F.lit(0)).alias("covered_miles"), F.coalesce(F.sum(F.when(~on, F.col(miles))), F.lit(0)).alias("uncovered_miles"),
    )
    told = told.withColumn("covered_pct", percent(F.col("covered_rows"), F.col("rows")))
    return told.orderBy(F.desc("uncovered_miles"), *keys).limit(limit) if limit else told


def coverage_audit(df: DataFrame, keys: list[str], covered: Column, miles: str) -> DataFrame:
    """Coverage by each key alone and in total, in one pass of grouping sets: dimension, member, rows, covered_rows, miles, covered_miles."""
    on = F.coalesce(covered, F.lit(False))
    told = df.withColumns({f"_{k}": F.col(k).cast("string") for k in keys} | {"_on": on})
    sets = [[F.col(f"_{k}")] for k in keys] + [[]]
    level = F.concat_ws("", *[F.when(F.grouping(f"_{k}") == 0, F.lit(k)) for k in keys])
    found = told.groupingSets(sets, *[F.col(f"_{k}") for k in keys]).agg(
        level.alias("dimension"), F.count("*").alias("rows"), F.count_if("_on").alias("covered_rows"), F.sum(miles).alias("miles"), F.coalesce(F.sum(F.when(F.col("_on"), F.col(miles))), F.lit(0)).alias("covered_miles")
    )
    return found.select(F.when(F.col("dimension") == "", "total").otherwise(F.col("dimension")).alias("dimension"), F.coalesce(*[F.col(f"_{k}") for k in keys]).alias("member"), "rows", "covered_rows", "miles", "covered_miles")


def coverage_headline(df: DataFrame, covered: Column, official: Column, source: str, system: str, miles: str) -> DataFrame:
    """One row: segments and miles in all, covered, officially covered, filled analytically and uncovered, their shares (four decimals), and those of the state system."""
    on, sure, length = F.coalesce(covered, F.lit(False)), F.coalesce(official, F.lit(False)), F.coalesce(F.col(miles).cast("double"), F.lit(0.0))
    filled, state = F.coalesce(F.col(source) == "analytical_gap_fill", F.lit(False)), F.coalesce(F.col(system).cast("string") == "1", F.lit(False))
    counts = {"segments": F.lit(True), "covered_segments": on, "official_segments": sure, "gap_fill_segments": filled, "uncovered_segments": ~on, "state_segments": state, "state_uncovered_segments": state & ~on}
    sums = {"miles": F.lit(True), "covered_miles": on, "official_miles": sure, "gap_fill_miles": filled, "uncovered_miles": ~on}
    told = df.agg(*[F.count_if(x).alias(n) for n, x in counts.items()], *[F.coalesce(F.sum(F.when(x, length)), F.lit(0.0)).alias(n) for n, x in sums.items()])
    shares = {"covered_pct": ("covered_segments", "segments"), "official_pct": ("official_segments", "segments"), "covered_miles_pct": ("covered_miles", "miles")}
    told = told.withColumns({n: F.round(percent(F.col(a), F.col(b)), 4) for n, (a, b) in shares.items()})
    return told.withColumn("state_covered_pct", F.round(percent(F.col("state_segments") - F.col("state_uncovered_segments"), F.col("state_segments")), 4))


def uncovered_rows(df: DataFrame, covered: Column, columns: list[str], order: list[str]) -> DataFrame:
    """Rows without a value: those of ``columns`` that there are, in ``order``, nulls last."""
    rows = df.where(~F.coalesce(covered, F.lit(False)))
    return rows.select(*[c for c in columns if c in df.columns]).orderBy(*[F.asc_nulls_last(c) for c in order if c in df.columns])


def uncovered_routes(df: DataFrame, keys: list[str], covered: Column, miles: str) -> DataFrame:
    """Coverage by route (and what else is in ``keys``) of those that have uncovered rows, most uncovered first."""
    return coverage_by(df, keys, covered, miles).where("uncovered_rows > 0").orderBy(F.desc("uncovered_rows"), F.desc("uncovered_miles"), *keys)


def match_summary(df: DataFrame, matched: Column, route: str, miles: str) -> DataFrame:
    on = F.coalesce(matched, F.lit(False))
    return df.agg(F.count("*").alias("rows"), F.count_if(on).alias("matched"), F.count_distinct(F.when(on, F.col(route))).alias("routes"), F.sum(F.when(on, F.col(miles))).alias("miles"))


def column_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null rows and share of each column, from one wide aggregate turned to rows."""
    wide = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in columns])
    long = wide.unpivot(["rows"], columns, "column_name", "filled")
    return long.withColumn("filled_pct", percent(F.col("filled"), F.col("rows")))


@dataclass(frozen=True)
class Summary:
    """What an enrichment's summary counts, by item: rows with a value, with a flag, with one value, without; and rows by value (``known``: nulls left out), by part of a joined text, and by pair of values."""

    filled: dict[str, str] = field(default_factory=dict)
    flags: dict[str, str] = field(default_factory=dict)
    equal: dict[str, tuple[str, str]] = field(default_factory=dict)
    missing: dict[str, str] = field(default_factory=dict)
    values: dict[str, str] = field(default_factory=dict)
    known: dict[str, str] = field(default_factory=dict)
    parts: dict[str, tuple[str, str]] = field(default_factory=dict)
    pairs: dict[str, tuple[str, str]] = field(default_factory=dict)


# Items of the six summaries and the columns they count.
_HPMS_COVERAGE = {f"hpms_{n}_coverage": f"HPMS_{c}" for n, c in (("iri", "IRI"), ("psr", "PSR"), ("rutting", "RUTTING"), ("cracking", "CRACKING_PCT"), ("access_control", "ACCESS_CONTROL"), ("terrain", "TERRAIN_TYPE"), ("nhfn", "NHFN"), ("strahnet_type", "STRAHNET_TYPE"), ("route_signing", "ROUTE_SIGNING"))}
SUMMARIES = {
    "speed_limits": Summary(filled={"speed_limit_coverage": "SPEED_LIMIT"}, flags={"school_zone_segments": "IS_SCHOOL_ZONE"}, values={"speed_limit_source_counts": "SPEED_LIMIT_SOURCE"}, known={"speed_limit_distribution": "SPEED_LIMIT"}),
    "hpms": Summary(
        filled=_HPMS_COVERAGE | {"final_aadt_coverage": "AADT"}, equal={"hpms_aadt_filled": ("AADT_2024_SOURCE", "hpms_2024"), "hpms_signing_upgrades": ("SIGNED_ROUTE_VERIFY_SOURCE", "hpms_2024")},
        values={"signed_route_source_counts": "SIGNED_ROUTE_VERIFY_SOURCE", "final_aadt_source_counts": "AADT_2024_SOURCE"},
    ),
    "signed_routes": Summary(
        flags={"signed_interstate_segments": "SIGNED_INTERSTATE_FLAG", "signed_us_route_segments": "SIGNED_US_ROUTE_FLAG", "signed_state_route_segments": "SIGNED_STATE_ROUTE_FLAG"},
        values={"primary_family_counts": "SIGNED_ROUTE_FAMILY_PRIMARY", "verification_confidence_counts": "SIGNED_ROUTE_VERIFY_CONFIDENCE", "verification_source_counts": "SIGNED_ROUTE_VERIFY_SOURCE", "verification_method_counts": "SIGNED_ROUTE_VERIFY_METHOD"},
    ),
    "evacuation": Summary(flags={"evacuation_segments": "SEC_EVAC", "contraflow_segments": "SEC_EVAC_CONTRAFLOW"}, parts={"evacuation_route_names": ("SEC_EVAC_ROUTE_NAME", "; ")}),
    "priority": Summary(missing={"null_srp_count": "SRP_DERIVED"}, known={"tier_counts": "SRP_DERIVED"}, parts={"reason_counts": ("SRP_DERIVED_REASONS", " | ")}, pairs={"tier_by_route_type": ("ROUTE_TYPE_GDOT", "SRP_DERIVED")}),
    "phase_1b": Summary(
        filled={"nhfn_non_null": "NHFN", "strahnet_type_non_null": "STRAHNET_TYPE"}, flags={"grip_flagged": "IS_GRIP_CORRIDOR", "epz_flagged": "IS_NUCLEAR_EPZ_ROUTE", "sole_connection_flagged": "IS_SOLE_COUNTY_SEAT_CONNECTION"},
        missing={"srp_null_count": "SRP_DERIVED"}, known={"srp_tier_counts": "SRP_DERIVED"},
    ),
}


def enrichment_summary(df: DataFrame, name: str, spec: Summary | None = None, gap_fills: tuple[str, ...] = ()) -> DataFrame:
    """(summary, item, member, rows): an enrichment's counts as one long table, from one pass.

    ``gap_fills`` are further columns whose filled rows count (``hpms_gap_fill_<column>``). An item
    of a column that ``df`` lacks is 0, or has no members; a null member is "-".
    """
    spec = spec or SUMMARIES[name]
    filled = spec.filled | {f"hpms_gap_fill_{c.lower()}": c for c in gap_fills}

    def has(*columns: str) -> bool:
        return all(c in df.columns for c in columns)

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    ones = {i: F.col(c).isNotNull() if has(c) else F.lit(False) for i, c in filled.items()}
    ones |= {i: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) if has(c) else F.lit(False) for i, c in spec.flags.items()}
    ones |= {i: F.col(c) == v if has(c) else F.lit(False) for i, (c, v) in spec.equal.items()}
    ones |= {i: F.col(c).isNull() for i, c in spec.missing.items() if has(c)}

    def told(item: str, members: Column) -> Column:
        return F.transform(members, lambda m: F.struct(F.lit(item).alias("item"), m.alias("member")))

    none = F.array().cast("array<string>")
    lists = [told("segment_count", F.array(F.lit("")))] + [told(i, F.when(x, F.array(F.lit(""))).otherwise(none)) for i, x in ones.items()]
    lists += [told(i, F.array(F.coalesce(text(c), F.lit("-")))) for i, c in spec.values.items() if has(c)]
    lists += [told(i, F.array_compact(F.array(text(c)))) for i, c in spec.known.items() if has(c)]
    lists += [told(i, F.filter(F.transform(F.coalesce(F.split(text(c), re.escape(by)), none), lambda x: F.trim(x)), lambda x: x != "")) for i, (c, by) in spec.parts.items() if has(c)]
    lists += [told(i, F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.array(F.concat_ws("/", text(a), text(b)))).otherwise(none)) for i, (a, b) in spec.pairs.items() if has(a, b)]
    counts = df.select(F.explode(F.concat(*lists)).alias("_c")).groupBy("_c.item", "_c.member").agg(F.count("*").alias("rows"))
    fixed = df.sparkSession.createDataFrame([(i, "") for i in ("segment_count", *ones)], "item string, member string")
    every = fixed.join(counts, ["item", "member"], "left").na.fill(0, ["rows"]).unionByName(counts.where("member <> ''"))
    return every.select(F.lit(name).alias("summary"), "item", "member", "rows")


def family_counts(df: DataFrame, family: str = "ROUTE_FAMILY") -> DataFrame:
    return df.groupBy(F.coalesce(family, F.lit("Unknown")).alias("family")).agg(F.count("*").alias("rows")).orderBy("family")


def confusion_matrix(df: DataFrame, derived: str, official: str, tiers: list[str]) -> DataFrame:
    """A row per official tier, a column per derived tier."""
    return df.groupBy(official).pivot(derived, tiers).agg(F.count(F.lit(1))).na.fill(0, tiers)


def tier_agreement(df: DataFrame, derived: str, official: str, tiers: list[str]) -> DataFrame:
    """Shares of exact and within-one-tier agreement, promotions and demotions (tiers in order, the highest first)."""
    rank = [F.array_position(F.array(*map(F.lit, tiers)), F.col(c)) for c in (derived, official)]
    gap = rank[0] - rank[1]
    told = df.select(gap.alias("gap")).where("gap is not null")
    n = F.count("*")
    return told.agg(n.alias("n"), percent(F.count_if(F.col("gap") == 0), n).alias("exact_pct"), percent(F.count_if(F.abs("gap") <= 1), n).alias("within_one_pct"), F.count_if(F.col("gap") < 0).alias("promotions"), F.count_if(F.col("gap") > 0).alias("demotions"))


def largest_differences(df: DataFrame, a: str, b: str, weight: str, id_: str, k: int = 20, agreement: Column | None = None) -> DataFrame:
    """The ``k`` largest differences times weight (the report's own limit), of rows whose values disagree, if ``agreement`` tells."""
    rows = df if agreement is None else df.where(agreement == "both_disagree")
    return rows.withColumn("impact", F.abs(F.col(a) - F.col(b)) * F.col(weight)).where("impact is not null").orderBy(F.desc("impact"), id_).limit(k)


# Order of the report's buckets and tiers, and lower bounds and names of its bins of relative differences.
AGREEMENTS = ("state_only", "hpms_only", "both_agree", "both_disagree", "missing")
CONFIDENCES = ("high", "medium", "low", "missing")
DIFFERENCE_BINS = {0: "0-25%", 25: "25-50%", 50: "50-100%", 100: "100-250%", 250: "250-500%", 500: "500-1000%", 1000: "≥1000%"}


def relative_difference(state: Column, other: Column) -> Column:
    """Difference in percent of the state's value; null if that is 0."""
    return F.try_divide(F.abs(other - state).cast("double"), F.when(F.abs(state) > 0, state.cast("double"))) * 100


def _difference_bin(r: Column) -> Column:
    name = F.lit(None).cast("string")
    for low, label in DIFFERENCE_BINS.items():
        name = F.when(r >= low, label).otherwise(name)
    return name


def difference_histogram(df: DataFrame, state: str, other: str, agreement: str) -> DataFrame:
    """Disagreeing rows by their difference in percent of the state's value, in right-open bins; empty bins are 0."""
    r = relative_difference(F.col(state), F.col(other))
    told = df.where(F.col(agreement) == "both_disagree").select(_difference_bin(r).alias("bin")).groupBy("bin").agg(F.count("*").alias("rows"))
    bins = df.sparkSession.createDataFrame([(b,) for b in DIFFERENCE_BINS.values()], "bin string")
    return bins.join(told, "bin", "left").na.fill(0, ["rows"])


@dataclass(frozen=True)
class ReportColumns:
    """Names of the columns that the agreement report reads."""

    state: str = "AADT_2024_OFFICIAL"
    other: str = "AADT_2024_HPMS"
    agreement: str = "AADT_2024_SOURCE_AGREEMENT"
    confidence: str = "AADT_2024_CONFIDENCE"
    statistics: str = "AADT_2024_STATS_TYPE"
    source: str = "AADT_2024_SOURCE"
    value: str = "AADT"
    road_class: str = "FUNCTIONAL_CLASS"
    label: str = "FUNCTIONAL_CLASS_LABEL"
    system: str = "SYSTEM_CODE"
    miles: str = "segment_length_mi"
    id: str = "unique_id"


def agreement_report(df: DataFrame, names: ReportColumns = ReportColumns(), top: int = 20) -> DataFrame:
    """The report on two sources of a value as one long table: section, member, item, value.

    Sections: agreement and confidence (rows, pct, miles), disagreement (rows, shares of
    overlap and of all, medians and means of differences), top (impact of the ``top``
    largest), histogram (rows by bin), by_class (class and label) and by_system (total and
    rows by tier), statistics (rows by type), uplift (rows and pct with a value), source
    (rows, pct). All counts come from one pass of grouping sets, medians by
    selection from a second one, which keeps the rows that disagree.
    A missing member is "-"; buckets, tiers and bins without rows are 0.
    """
    c = {f: F.col(getattr(names, f)) for f in names.__dataclass_fields__}
    disagree = c["agreement"] == "both_disagree"
    rel, gap = F.when(disagree, relative_difference(c["state"], c["other"])), F.when(disagree, F.abs(c["other"] - c["state"]).cast("double"))
    whole = F.coalesce(c["road_class"].cast("double").cast("int").cast("string"), F.lit("-"))
    members = {
        "agreement": c["agreement"], "confidence": c["confidence"], "by_class": F.concat_ws(" ", whole, F.coalesce(F.nullif(c["label"], F.lit("")), F.lit("-"))),
        "by_system": c["system"].cast("string"), "statistics": c["statistics"], "source": c["source"], "histogram": _difference_bin(rel),
    }
    told = df.select(*[F.coalesce(m, F.lit("-")).alias(n) for n, m in members.items()], c["miles"].cast("double").alias("_miles"), c["confidence"].alias("_tier"), rel.alias("_rel"), gap.alias("_gap"), disagree.alias("_dis"),
                     c["agreement"].isin("both_agree", "both_disagree").alias("_both"), c["state"].isNotNull().alias("_state"), c["other"].isNotNull().alias("_other"), c["value"].isNotNull().alias("_value"))
    # which of the sets a row of the result belongs to
    section = F.concat_ws("", *[F.when(F.grouping(n) == 0, F.lit(n)) for n in members])
    sets = told.groupingSets([[F.col(n)] for n in members] + [[]], *[F.col(n) for n in members]).agg(
        section.alias("section"), F.count("*").alias("rows"), F.coalesce(F.sum("_miles"), F.lit(0.0)).alias("miles"), *[F.count_if(F.col("_tier") == x).alias(x) for x in CONFIDENCES], F.count_if("_dis").alias("disagree"), F.count_if("_both").alias("overlap"),
        F.count_if("_state").alias("state"), F.count_if("_other").alias("other"), F.count_if(F.col("_state") | F.col("_other")).alias("either"), F.count_if("_value").alias("with_value"), F.avg("_rel").alias("mean_rel"), F.avg("_gap").alias("mean_gap"),
    )
    sets = checkpointed(sets.withColumn("member", F.coalesce(*[F.col(n) for n in members])))
    total = F.broadcast(sets.where("section = ''").select(F.col("rows").alias("_all")))
    # the medians and the largest differences read the rows that disagree, in the few columns they need, more than once
    apart = df.where(disagree).select(rel.alias("_rel"), gap.alias("_gap"), c["state"], c["other"], c["miles"], c["id"])
    apart = checkpointed(apart)
    middle = exact_quantiles(apart, [], {"rel": F.col("_rel"), "gap": F.col("_gap")}, {"median": 0.5})

    def items(told_of: DataFrame, /, **values: Column) -> DataFrame:
        each = F.array(*[F.struct(F.lit(n).alias("item"), v.cast("double").alias("value")) for n, v in values.items()])
        return told_of.select("section", "member", F.inline(each))

    def only(*sections: str) -> DataFrame:
        return sets.where(F.col("section").isin(*sections)).crossJoin(total)

    fixed = [("agreement", m) for m in AGREEMENTS] + [("confidence", m) for m in CONFIDENCES] + [("histogram", m) for m in DIFFERENCE_BINS.values()]
    fixed = df.sparkSession.createDataFrame(fixed, "section string, member string")
    n, pct = F.coalesce("rows", F.lit(0)), percent(F.coalesce("rows", F.lit(0)), F.col("_all"))
    listed = fixed.join(sets, ["section", "member"], "left").crossJoin(total)
    parts = [
        items(listed.where("section <> 'histogram'"), rows=n, pct=pct, miles=F.coalesce("miles", F.lit(0.0))), items(listed.where("section = 'histogram'"), rows=n),
        items(only("by_class", "by_system"), total=n, **{x: F.col(x) for x in CONFIDENCES}), items(only("statistics"), rows=n), items(only("source"), rows=n, pct=pct),
    ]
    one = sets.where("section = ''").crossJoin(total)
    uplift = one.select(F.lit("uplift").alias("section"), "_all", F.inline(F.array(*[F.struct(F.lit(m).alias("member"), F.col(x).alias("rows")) for m, x in (("all", "rows"), ("state", "state"), ("other", "other"), ("either", "either"), ("value", "with_value"))])))
    whole_gap = one.crossJoin(F.broadcast(middle)).select(F.lit("disagreement").alias("section"), F.lit("both_disagree").alias("member"), "*").drop(sets["section"]).drop(sets["member"])
    parts.append(items(uplift, rows=n, pct=pct))
    parts.append(items(whole_gap, rows=F.col("disagree"), pct_of_overlap=percent(F.col("disagree"), F.col("overlap")), pct_of_all=percent(F.col("disagree"), F.col("_all")), median_rel_pct=F.col("rel_median"), mean_rel_pct=F.col("mean_rel"), median_abs=F.col("gap_median"), mean_abs=F.col("mean_gap")))
    largest = largest_differences(apart, names.state, names.other, names.miles, names.id, top)
    parts.append(items(largest.select(F.lit("top").alias("section"), F.col(names.id).cast("string").alias("member"), F.col("impact").alias("_impact")), impact=F.col("_impact")))
    return reduce(DataFrame.unionByName, parts)


def min_max_score(df: DataFrame, weights: dict[str, float], name: str = "score") -> DataFrame:
    """Weighted sum of min-max scaled columns, four decimals; booleans as 0 and 1, constant columns as 0."""
    kinds = dict(df.dtypes)
    numeric = [c for c in weights if kinds[c] != "boolean"]
    if numeric:
        bounds = df.agg(*[F.min(c).cast("double").alias(f"_lo_{c}") for c in numeric], *[F.max(c).cast("double").alias(f"_hi_{c}") for c in numeric])
        told = df.crossJoin(F.broadcast(bounds))
    else:
        told = df

    def scaled(c: str) -> Column:
        if c not in numeric:
            return F.coalesce(F.col(c).cast("int").cast("double"), F.lit(0.0))
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        return F.coalesce(F.when(hi > lo, (F.col(c) - lo) / (hi - lo)), F.lit(0.0))

    total = F.lit(0.0)
    for c, w in weights.items():
        total = total + w * scaled(c)
    return told.select(*df.columns, round_even(total, 4).alias(name))


def load_summary(df: DataFrame, by: str) -> DataFrame:
    """Rows, columns, and null counts and distribution of ``by`` as JSON maps; one pass for the nulls."""
    nulls = F.to_json(F.create_map(*[x for c in df.columns for x in (F.lit(c), F.count_if(F.col(c).isNull()))]))
    spread = df.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("null")).alias("k")).agg(F.count("*").alias("n"))
    spread = spread.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n"))))).alias("distribution"))
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"), nulls.alias("nulls")).crossJoin(F.broadcast(spread))


def flag_rates(df: DataFrame, flag: str, keys: list[str]) -> DataFrame:
    """Flagged rows, rows and their share by keys."""
    told = df.groupBy(*keys).agg(F.count_if(F.col(flag) == 1).alias("flagged"), F.count("*").alias("rows"))
    return told.withColumn("flagged_pct", percent(F.col("flagged"), F.col("rows")))


def sample_by_hash(df: DataFrame, id_: str, by: list[str], n: int = 10) -> DataFrame:
    """A deterministic sample of ``n`` rows by key (the report's own limit)."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.md5(F.col(id_).cast("string")), id_))).where(F.col("_n") <= n).drop("_n")
