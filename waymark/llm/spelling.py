"""Spelling variants of a vocabulary by pivotal grams: words one code point apart, and the frequent form of each.

1. The vocabulary is counted over whole texts; partial sums keep a frequent word small.
2. Bigrams are put in order, rare ones first, by how many words hold one of their
   bucket (65,536 counts, whatever the alphabet). A word's prefix is its three first
   bigrams in that order, with all repeats of the third. Of the prefix the two cheapest
   bigrams that don't overlap, by dynamic programming, are its pivots.
3. One edit leaves at least one pivot whole. If the prefix of a word ends no later in the
   order than that of another, the pivot left whole is in the other's prefix: so pivots
   meet prefixes. The edit lies on one side of that pivot, so on the other side the words
   agree up to the border: a bigram's position is fixed from the left or from the right,
   and what lies on that side belongs to the key. Where that side is short, half of the far
   side joins the key, for an edit there leaves its first or its last half whole. Keys are
   thus most of a word, and lists stay short however large the vocabulary grows.
4. What meets is compared in the join's condition: lengths, a mask of the letters, then
   the edit distance. No pair is dropped and none is capped.
5. Words follow their forms to the last by doubling pointers.

Defined results: null texts and null ids count as empty; a run of letters is as long as it
is; words of any length take part (those of the text are filtered by the caller's bounds);
ties of the form go to the smaller word in code-point order; repeated rows count as often
as they occur; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import checkpointed

RUN = r"[A-Za-zÀ-ÿ]+"
#: buckets of bigrams, bigrams of a prefix, pivots, and the length from which a side needs no half of the other
_BUCKETS, _PREFIX, _PIVOTS, _LONG = 1 << 16, 3, 2, 6
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(x: Column) -> Column:
    """``x`` with A-Z in lower case and nothing else changed."""
    return F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(F.translate(x, _UPPER, _UPPER.lower()))


def vocabulary(docs: DataFrame, drop_every: int = 31, length: int = 7, least: int = 2) -> DataFrame:
    """(word, n) of the letter runs of ``docs`` (doc_id, text) that have ``length`` code points and occur ``least`` times.

    Where ``drop_every`` divides the crc32 of ``<doc_id>:<run>``, the run loses one code point.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= length).select("id", lower_ascii(F.col("run")).alias("run"))
    told = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = told.select(F.when(F.col("h") % drop_every == 0, less).otherwise(F.col("run")).alias("word")).where(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _padded(word: str) -> str:
    return f"\x01\x01{word}\x02\x02"


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % _BUCKETS


def prefix_and_pivots(text: str, order: np.ndarray | list[int]) -> tuple[list[int], list[int], tuple[int, str]]:
    """Positions of the prefix and of the pivots of a padded word, and where the prefix ends in the order of bigrams."""
    grams = [text[i : i + 2] for i in range(len(text) - 1)]
    place = [(int(order[_bucket(g)]), g) for g in grams]
    last = sorted(place)[_PREFIX - 1]
    prefix = [i for i, p in enumerate(place) if p <= last]
    # best[c][j]: least cost, and choice, of c bigrams without overlap among the first j of the prefix
    best: list[list] = [[(0, ())] * (len(prefix) + 1)] + [[None] * (len(prefix) + 1) for _ in range(_PIVOTS)]
    for c in range(1, _PIVOTS + 1):
        for j in range(1, len(prefix) + 1):
            before = best[c - 1][bisect_right(prefix, prefix[j - 1] - 2, 0, j - 1)]
            taken = before and (before[0] + place[prefix[j - 1]][0], (*before[1], prefix[j - 1]))
            best[c][j] = min((x for x in (best[c][j - 1], taken) if x), default=None)
    return prefix, list(best[_PIVOTS][-1][1]), last


def keys(text: str, at: int) -> Iterator[str]:
    """The keys under which a padded word lists the bigram at ``at``: what lies on one side, and half of the other side where that is short."""
    for side, near, far in (("<", text[: at + 2], text[at + 2 :]), (">", text[at:], text[:at])):
        if len(near) >= _LONG:
            yield f"{side}{near}"
        else:
            # the longer of two such far sides has as many code points as this one or one more
            for n in (len(far), len(far) + 1):
                half = max(0, (n - 1) // 2)
                yield f"{side}{near}\x03{n}\x03{far[:half]}"
                yield f"{side}{near}\x04{n}\x04{far[len(far) - half :]}"


def _listed(words: DataFrame) -> DataFrame:
    """(pivot, key, word, size, letters, freq, gram): a row for each key of each pivot and of each bigram of the prefix."""
    spark = words.sparkSession

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(_BUCKETS, dtype=np.int64)
        for batch in batches:
            for word in batch["word"]:
                text = _padded(word)
                for b in {_bucket(text[i : i + 2]) for i in range(len(text) - 1)}:
                    count[b] += 1
        found = np.flatnonzero(count)
        yield pd.DataFrame({"bucket": found, "n": count[found]})

    counted = words.select("word").mapInPandas(held, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    order = np.zeros(_BUCKETS, dtype=np.int64)
    for r in counted.collect():  # at most 65,536 counts
        order[r["bucket"]] = r["n"]
    shared = spark.sparkContext.broadcast(order)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank = shared.value.tolist()
        for batch in batches:
            for lo in range(0, len(batch), 2_000):
                out = []
                for word in batch["word"].iloc[lo : lo + 2_000]:
                    text = _padded(word)
                    prefix, pivots, (freq, gram) = prefix_and_pivots(text, rank)
                    letters = 0
                    for c in word:
                        letters |= 1 << (ord(c) % 63)
                    for pivot, places in ((True, pivots), (False, prefix)):
                        for key in {k for p in places for k in keys(text, p)}:
                            out.append((pivot, xxhash.xxh3_64_intdigest(key.encode()) - (1 << 63), word, len(word), letters, freq, gram))
                yield pd.DataFrame(out, columns=["pivot", "key", "word", "size", "letters", "freq", "gram"])

    return words.select("word").mapInPandas(listed, "pivot boolean, key long, word string, size int, letters long, freq long, gram string")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of ``words`` (word, distinct) that one inserted, deleted or replaced code point makes equal."""
    rows = checkpointed(_listed(words))
    a = rows.where("pivot").select("key", *[F.col(c).alias(f"a_{c}") for c in ("word", "size", "letters", "freq", "gram")])
    b = rows.where("not pivot").select("key", *[F.col(c).alias(f"b_{c}") for c in ("word", "size", "letters", "freq", "gram")])
    ends = F.struct("a_freq", "a_gram") <= F.struct("b_freq", "b_gram")
    close = (F.abs(F.col("a_size") - F.col("b_size")) <= 1) & (F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2)
    met = a.join(b, (a["key"] == b["key"]) & close & (F.col("a_word") != F.col("b_word")) & ends & (F.levenshtein("a_word", "b_word", 1) == 1))
    both = F.array(F.struct(F.col("a_word").alias("word"), F.col("b_word").alias("near")), F.struct(F.col("b_word").alias("word"), F.col("a_word").alias("near")))
    return met.select(F.inline(both)).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form). Pointers double, so rounds grow with the logarithm of the longest chain."""
    rows = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        step = rows.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        told = checkpointed(rows.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if told.where("_moved").isEmpty():
            return told.select("word", "root")
        rows = told.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n; words distinct).

    The form is the near word of largest n, if it has ``ratio`` times the word's n or more;
    the root is where following forms ends.
    """
    words = checkpointed(words.select("word", F.col("n").cast("long")))
    pairs = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    far = F.coalesce(-F.col("best.n") >= ratio * F.col("n"), F.lit(False))
    told = checkpointed(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.n")).alias("form_n")))
    roots = _roots(told.where("form is not null").select("word", "form"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
