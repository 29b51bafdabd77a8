"""Exact quantiles of groups of any size by histograms that are refined until a value is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.lineage import checkpointed

#: buckets of a histogram; values of a group up to which Spark's own percentile, which holds them in one task, does
BUCKETS, SMALL = 1024, 200_000
#: ranks that are broadcast at most; their count is checked
_FEW = 20_000


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _selected(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """(_k, _name, _rank, _value): the value of each rank (from 0) among ``values`` (_k, _name, _v, _n: value and count).

    Each round counts the values between a rank's bounds in buckets, by partial sums, and
    takes the bucket that holds the rank; its least and greatest value are the next bounds.
    These differ from the last ones, so rounds end, and no task sees more of a group than
    its part of a scan and ``BUCKETS`` rows for each rank.
    """
    open_ranks, done = checkpointed(ranks), None
    while True:
        ready = open_ranks.where("_low = _high").select("_k", "_name", "_rank", F.col("_low").alias("_value"))
        done = ready if done is None else done.unionByName(ready)
        open_ranks = open_ranks.where("_low < _high")
        count = open_ranks.count()
        if not count:
            return done
        # ranks are two for each share, group and column; many of them are joined by a shuffle, in which adaptive execution splits a hot group
        met = values.join(F.broadcast(open_ranks) if count <= _FEW else open_ranks, ["_k", "_name"]).where(F.col("_v").between(F.col("_low"), F.col("_high")))
        share = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        bucket = F.least(F.lit(BUCKETS - 1), F.floor(share * BUCKETS)).cast("int")
        counted = met.groupBy("_k", "_name", "_rank", "_below", bucket.alias("_b")).agg(F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        w = Window.partitionBy("_k", "_name", "_rank").orderBy("_b")
        counted = counted.withColumn("_end", F.col("_below") + F.sum("_n").over(w))
        own = counted.where((F.col("_end") > F.col("_rank")) & (F.col("_end") - F.col("_n") <= F.col("_rank")))
        open_ranks = checkpointed(own.select("_k", "_name", "_rank", "_low", "_high", (F.col("_end") - F.col("_n")).alias("_below")))


def exact_quantiles(df: DataFrame, keys: list[str], columns: dict[str, Column], shares: dict[str, float], small: int = SMALL) -> DataFrame:
    """(keys, a column for each of ``columns`` and ``shares``, named ``<column>_<share>``): exact quantiles, interpolated as Spark's ``percentile`` does.

    Nulls and values that aren't finite don't count; a group without values has nulls; null
    is a key like others. While no group has more than ``small`` rows, Spark's
    percentile takes them; the values are the same either way.
    """
    told = df.select(*keys, *[F.when(F.abs(c.cast("double")) < float("inf"), c.cast("double")).alias(f"_c{i}") for i, c in enumerate(columns.values())])
    names = [(i, c, s) for i, c in enumerate(columns) for s in shares]
    if largest_group(told, keys) <= small:
        return told.groupBy(*keys).agg(*[F.percentile(f"_c{i}", shares[s]).alias(f"{c}_{s}") for i, c, s in names])
    told = told.withColumn("_k", F.struct(*[F.col(k) for k in keys], F.lit(0).alias("_0")))
    each = told.select("_k", F.inline(F.array(*[F.struct(F.lit(i).alias("_name"), F.col(f"_c{i}").alias("_v")) for i in range(len(columns))]))).where("_v is not null")
    # equal values are one row with a count, so a value that a third of all rows has is small
    values = checkpointed(each.groupBy("_k", "_name", "_v").agg(F.count("*").alias("_n")))
    spans = checkpointed(values.groupBy("_k", "_name").agg(F.sum("_n").alias("_all"), F.min("_v").alias("_low"), F.max("_v").alias("_high")))
    place = {s: F.lit(float(q)) * (F.col("_all") - 1) for s, q in shares.items()}
    ranks = F.array_distinct(F.concat(*[F.array(F.floor(p), F.ceil(p)) for p in place.values()]))
    asked = spans.select("_k", "_name", F.explode(ranks).alias("_rank"), "_low", "_high", F.lit(0).cast("long").alias("_below"))
    found = checkpointed(_selected(values, asked))
    at = found.groupBy("_k", "_name").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    wide = spans.join(at, ["_k", "_name"])

    def quantile(p: Column) -> Column:
        low, high = F.floor(p), F.ceil(p)
        a, b = F.element_at("_at", low), F.element_at("_at", high)
        return F.when((low == high) | (a == b), a).otherwise((high - p) * a + (p - low) * b)

    wide = wide.select("_k", "_name", *[quantile(p).alias(f"_q_{s}") for s, p in place.items()])
    row = wide.groupBy("_k").agg(*[F.max(F.when(F.col("_name") == i, F.col(f"_q_{s}"))).alias(f"{c}_{s}") for i, c, s in names])
    every = told.select("_k").distinct()
    return every.join(row, "_k", "left").select(*[F.col(f"_k.{k}").alias(k) for k in keys], *[f"{c}_{s}" for _, c, s in names])
