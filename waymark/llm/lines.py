"""Line dedup by a deletion-neighbourhood join (DataFrame functions only).

Of equal lines, and of lines within one word edit (a word put in, taken out or
replaced), the earliest in order of doc_id, row and line stays. Lines of fewer than
``min_words`` words are compared for equality only, since one word of a few is no
small edit. Blank lines are kept.

1. Equal lines meet by a 128-bit hash; aggregates give the earliest, so a line with
   a third of all rows is one small row per task before the shuffle.
2. Lines within one edit agree in their first or in their last ``m`` words for an
   ``m`` that follows from their length. Only lines that share such a half with
   another line can have a neighbour, and only they go on.
3. These emit their deletion neighbourhood: the hash of the line itself and of each
   variant with one word deleted. Hashes are sums over adjacent word pairs, so all
   variants of a line cost one pass over it.
4. Equal variants meet. Two lines without the word at the same place in both are a
   replacement; a line that equals another's variant is a deletion. The earliest
   partner of either kind is a minimum over the variant's rows, so no pairs are
   emitted within a group.
5. Pairs (a line and its earliest partner) are verified on the words themselves: the
   lengths of the common prefix and suffix show whether one edit makes them equal.
6. Only texts that lose a line are shuffled and put together anew.

Defined results: null text stays null; an empty text stays empty; null ids come
last and their lines are handled alike; of repeated rows the first keeps its lines;
a text all of whose lines went is empty; an empty table gives no rows; all columns
are kept, and columns with the working names are no trouble.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import checkpointed, free_name

_BITS = (1 << 40) - 1
_EDGE = "\x00"
_BUCKETS = 1 << 19


def _hash(*columns: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b"))


def _halves(line: Column, n: Column) -> Column:
    """Hashes of the first and of the last ``m`` of ``n`` words, for the ``m`` of this length and of the next greater one."""

    def m(n: Column) -> Column:
        return F.pow(F.lit(2.0), F.floor(F.log2((n - 1) / 2.0))).cast("int")

    def keys(k: Column) -> Column:
        return F.array(F.xxhash64(F.lit("first"), F.call_function("substring_index", line, F.lit(" "), k)), F.xxhash64(F.lit("last"), F.call_function("substring_index", line, F.lit(" "), -k)))

    return F.when(m(n) == m(n + 1), keys(m(n))).otherwise(F.concat(keys(m(n)), keys(m(n + 1))))


def _pair(a: Column, b: Column, seed: int) -> Column:
    """A 40-bit hash of two adjacent words, so that sums of many stay below 2^63."""
    return F.xxhash64(F.lit(seed), a, b).bitwiseAND(F.lit(_BITS))


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (key, place, at, a, b, n) for each line (key, place, words): itself (at -1) and each variant without word ``at``.

    ``n`` words are left. Each step has its own select, so that no array is worked out anew for each word.
    """
    padded = lines.select("key", "place", F.concat(F.array(F.lit(_EDGE)), "words", F.array(F.lit(_EDGE))).alias("w"))

    def pairs(seed: int, far: int) -> Column:
        """Hashes of the words at i and i + ``far``, for each i that has both."""
        ahead = F.slice("w", F.lit(1 + far), F.size("w") - far)
        return F.zip_with(F.slice("w", F.lit(1), F.size("w") - far), ahead, lambda x, y: _pair(x, y, seed))

    hashed = padded.select("key", "place", (F.size("w") - 2).alias("n"), *[pairs(s, far).alias(f"{x}{s}") for s in (1, 2) for x, far in (("near", 1), ("far", 2))])
    total = [F.aggregate(f"near{s}", F.lit(0).cast("long"), lambda x, y: x + y).alias(f"sum{s}") for s in (1, 2)]
    summed = hashed.select("*", *total)

    def without(s: int) -> Column:
        gone = F.zip_with(F.slice(f"near{s}", F.lit(1), F.col("n")), F.slice(f"near{s}", F.lit(2), F.col("n")), lambda x, y: x + y)
        return F.zip_with(gone, f"far{s}", lambda x, y: y - x)

    change = summed.select("key", "place", "n", "sum1", "sum2", F.arrays_zip(without(1).alias("a"), without(2).alias("b")).alias("change"))
    whole = F.struct(F.lit(-1).alias("at"), F.col("sum1").alias("a"), F.col("sum2").alias("b"), F.col("n"))
    rest = F.transform("change", lambda c, i: F.struct(i.alias("at"), (F.col("sum1") + c["a"]).alias("a"), (F.col("sum2") + c["b"]).alias("b"), (F.col("n") - 1).alias("n")))
    return change.select("key", "place", F.inline(F.concat(F.array(whole), rest)))


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether one word put in, taken out or replaced makes two arrays of words equal."""

    def common(x: Column, y: Column) -> Column:
        least = F.least(F.size(x), F.size(y))
        same = F.zip_with(F.slice(x, 1, least), F.slice(y, 1, least), lambda p, q: p == q)
        at = F.array_position(same, False)
        return F.when(at == 0, least).otherwise(at - 1)

    longer = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1)


def _among(rows: DataFrame, keys: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have a partner in ``keys``, and those that surely have none.

    The broadcast holds hashes of the keys modulo ``_BUCKETS``, so its size is bounded;
    when most buckets are taken, more rows only go through the join that follows.
    """
    (name,) = free_name(rows, "bucket")
    bucket = F.pmod(F.xxhash64(*columns), F.lit(_BUCKETS)).alias(name)
    taken = F.broadcast(keys.select(bucket).distinct())
    marked = rows.withColumn(name, bucket)
    return marked.join(taken, name, "left_semi").drop(name), marked.join(taken, name, "left_anti").drop(name)


def _near(distinct: DataFrame, lines: DataFrame) -> DataFrame:
    """Keys of the distinct lines (key, place, halves) that have an earlier one within one edit."""
    halves = distinct.select("key", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("key.a").alias("low"), F.max("key.a").alias("high")).where("low <> high").select("half")
    able = halves.join(shared, "half", "left_semi").select("key").distinct().join(distinct.select("key", "place"), "key")
    able = checkpointed(able.select("key", "place", F.col("place.row").alias("row"), F.col("place.at").alias("at")))
    texts, _ = _among(lines, able, ["row", "at"])
    able = checkpointed(texts.join(able, ["row", "at"]).select("key", "place", F.split("line", " ").alias("words")))
    variants = _variants(able).select(F.xxhash64("a", "b", "n").alias("variant"), "at", F.struct("place", "key").alias("me"))
    met = variants.select("variant", F.col("me.key.a").alias("a")).groupBy("variant").agg(F.min("a").alias("low"), F.max("a").alias("high")).where("low <> high")
    variants = checkpointed(variants.join(met.select("variant"), "variant", "left_semi"))
    replaced = variants.where("at >= 0").groupBy("variant", "at").agg(F.min("me").alias("first"), F.max("me").alias("last")).where("first <> last")
    both = (
        variants.groupBy("variant")
        .agg(F.min(F.when(F.col("at") < 0, F.col("me"))).alias("whole"), F.min(F.when(F.col("at") >= 0, F.col("me"))).alias("less"))
        .where("whole is not null and less is not null")
    )
    pairs = variants.join(replaced, ["variant", "at"]).select("me", F.col("first").alias("partner"))
    other = F.when(F.col("at") < 0, F.col("less")).otherwise(F.col("whole"))
    pairs = pairs.unionByName(variants.join(both, "variant").select("me", other.alias("partner"))).where("partner.place < me.place").distinct()
    words = able.select("key", "words")
    told = pairs.select(F.col("me.key").alias("key"), F.col("partner.key").alias("partner")).join(words, "key")
    told = told.join(words.select(F.col("key").alias("partner"), F.col("words").alias("earlier")), "partner")
    return told.where(within_one_edit(F.col("words"), F.col("earlier"))).select("key").distinct()


def dedup_lines(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """``docs`` (doc_id, text and any further columns) with repeated lines, equal or within one word edit, taken out of ``text``.

    A line within one edit of an earlier one goes, whether or not that one stays.
    ``docs`` should be a table or another plan that gives the same rows when it is read
    again.
    """
    row, kept_at, own, blank_at = free_name(docs, "row", "kept", "lines", "blank")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    split = F.split("text", "\n", -1)
    lines = rows.where("text is not null").select(F.col(row).alias("row"), F.col("doc_id").alias("id"), F.posexplode(split).alias("at", "line"))
    lines = lines.where(F.trim("line") != "")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row", "at")
    counted = lines.withColumn("n", F.length("line") - F.length(F.translate("line", " ", "")) + 1)
    halves = F.when(F.col("n") >= min_words, _halves(F.col("line"), F.col("n")))
    told = counted.select(_hash(F.col("line")).alias("key"), place.alias("place"), halves.alias("halves"))
    distinct = checkpointed(told.groupBy("key").agg(F.min("place").alias("place"), F.first("halves").alias("halves")))
    kept = distinct.join(_near(distinct, lines), "key", "left_anti")
    kept = kept.groupBy(F.col("place.row").alias("row")).agg(F.collect_list("place.at").alias("kept"))
    # blank lines stay, so texts that lose nothing keep as many lines as aren't blank
    said = rows.where("text is not null").select(F.col(row).alias("row"), F.size(F.filter(split, lambda x: F.trim(x) != "")).alias("n"))
    changed = said.where("n > 0").join(kept, "row", "left").where("kept is null or size(kept) < n")
    changed = checkpointed(changed.select(F.col("row").alias(row), F.coalesce("kept", F.array().cast("array<int>")).alias(kept_at)))
    able, rest = _among(rows, changed, [row])
    able = able.join(changed, row, "left")
    blank = F.filter(F.transform(split, lambda x, i: F.when(F.trim(x) == "", i)), lambda i: i.isNotNull())
    order = F.array_sort(F.concat(F.col(kept_at), F.col(blank_at)))
    text = F.array_join(F.transform(order, lambda i: F.get(F.col(own), i)), "\n")
    able = able.withColumns({own: split, blank_at: blank})
    able = able.withColumn("text", F.when(F.col(kept_at).isNull(), F.col("text")).otherwise(text))
    return rest.select(*docs.columns).unionByName(able.select(*docs.columns))
