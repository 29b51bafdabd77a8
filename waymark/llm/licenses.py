"""License scans by diagonal voting (DataFrame functions only).

1. A text's words give rolling hashes of two and of three words. One pass over the text
   explodes them and joins them with the positions of all templates (a fixed list of some
   hundred words, broadcast). The join's condition compares the words themselves, so equal
   hashes of different words are no hit.
2. Hits are summed by document, template and diagonal (place in the text less place in the
   template); partial sums come before the shuffle. A hit of its own kind, one for each
   document, brings the documents without a hit along, so texts are read once and only
   hits are shuffled.
3. Neighbouring diagonals of a template are merged: words put in or left out move the rest
   of a copy to the next ones. ``slack`` is less than a template is long, so copies that
   follow each other stay apart.
4. A merged span is verified: the share of the template's grams that it holds, the same
   share of both its own and the template's (Dice), and a hit on a word that tells the
   license where the wording alone doesn't.

Phrases are found where all their words stand one after the other; each such place is a
diagonal of its own and counts.

Defined results: a null text is empty; an empty text has 0 words and no span; null and
repeated ids are rows like others; a text is scanned whole however long; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.spelling import lower_ascii


@dataclass(frozen=True)
class Template:
    """A wording of a license. ``telling``: words of which one must be hit; ``phrase``: it counts where all its words stand, and nowhere else."""

    label: str
    text: str
    telling: tuple[str, ...] = ()
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def k(self) -> int:
        """Words of a gram: two of short wordings, three of others."""
        return 2 if len(self.words) == 2 or (len(self.words) < 9 and not self.phrase) else 3


# Phrases and labels of the base, and public wordings of licenses.
PHRASES = (
    Template("cc-by", "cc by", phrase=True),
    Template("gpl", "general public license", phrase=True),
    Template("reserved", "all rights reserved", phrase=True),
)
TEMPLATES = (
    Template("agpl", "under the terms of the gnu affero general public license", ("affero",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache",)),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("bsd", "released under the bsd license", ("bsd",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("attribution",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("sa",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    Template("epl", "made available under the terms of the eclipse public license", ("eclipse",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu", "free")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("lesser",)),
    Template("mit", "released under the mit license", ("mit",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)

#: words with A-Z in any case; the base lower-cases them first, which gives the same runs
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: hash of the hit that every document has
_HERE = 0


def words_of(text: Column) -> Column:
    """A text's words, A-Z in lower case; none of a null."""
    return F.coalesce(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lower_ascii), F.array().cast("array<string>"))


def grams(words: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words."""
    n = F.greatest(F.size(words) - (k - 1), F.lit(0))
    first = F.transform(F.slice(words, F.lit(1), n), lambda w: F.xxhash64(w)) if k == 1 else F.slice(words, F.lit(1), n)
    return reduce(lambda h, i: F.zip_with(h, F.slice(words, F.lit(i + 1), n), lambda a, b: F.xxhash64(a, b)), range(1, k), first)


def index(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(hash, k, at, template, said, telling) of each template's grams, and the hit that every document has (k = 0, template -1)."""
    rows = [(i, t.words, t.k, list(t.telling)) for i, t in enumerate(templates)]
    told = spark.createDataFrame(rows, "template int, words array<string>, k int, telling array<string>")
    parts = []
    for k in sorted({t.k for t in templates}):
        own = told.where(F.col("k") == k).select("*", F.posexplode(grams(F.col("words"), k)).alias("at", "hash"))
        said = F.slice("words", F.col("at") + 1, k)
        parts.append(own.select("hash", "k", "at", "template", said.alias("said"), ((F.size("telling") == 0) | F.arrays_overlap(said, "telling")).alias("telling")))
    here = spark.range(1).select(F.lit(_HERE).cast("long").alias("hash"), F.lit(0).alias("k"), F.lit(0).alias("at"), F.lit(-1).alias("template"), F.array().cast("array<string>").alias("said"), F.lit(False).alias("telling"))
    return reduce(DataFrame.unionByName, parts, here)


def hits(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(row, doc_id, n_words, template, at, pos, telling): template places met by each document's grams."""
    sizes = sorted({t.k for t in templates})
    said = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    listed = F.concat(F.array(F.lit(_HERE).cast("long")), *[grams(F.col("words"), k) for k in sizes])
    flat = said.select("row", "doc_id", "words", F.size("words").alias("n_words"), listed.alias("hashes"))
    flat = flat.select("row", "doc_id", "words", "n_words", F.posexplode("hashes").alias("p", "hash"))
    # the list holds the document's own hit, then the grams of each size in turn
    k, before, start = F.when(F.col("p") == 0, 0), F.when(F.col("p") == 0, 0), F.lit(1)
    for size in sizes:
        end = start + F.greatest(F.col("n_words") - (size - 1), F.lit(0))
        k, before, start = k.when(F.col("p") < end, size), before.when(F.col("p") < end, start), end
    flat = flat.select("row", "doc_id", "words", "n_words", "hash", k.alias("k"), (F.col("p") - before).alias("pos"))
    known = F.broadcast(index(docs.sparkSession, templates))
    same = F.slice("words", F.col("pos") + 1, flat["k"]) == known["said"]
    met = flat.join(known, (flat["hash"] == known["hash"]) & (flat["k"] == known["k"]) & same)
    return met.select("row", "doc_id", "n_words", "template", "at", "pos", "telling")


def scan(docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, templates: tuple[Template, ...] = TEMPLATES, slack: int = 3, least: float = 0.6, alike: float = 0.5) -> DataFrame:
    """(doc_id, n_words, spans) of each row of ``docs`` (doc_id, text); spans hold label, template, start, words, share, dice, phrase.

    ``share`` and ``dice`` are those of step 4, at least ``least`` and ``alike``.
    """
    every = (*phrases, *templates)
    met = hits(docs, every).withColumn("diagonal", F.col("pos") - F.col("at"))
    votes = met.groupBy("row", "doc_id", "template", "diagonal").agg(
        F.max("n_words").alias("n_words"), F.min("pos").alias("low"), F.max("pos").alias("high"), F.collect_set("at").alias("places"), F.bool_or("telling").alias("telling")
    )
    # what is known of a template, looked up by its number
    about = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.k).alias("k"), F.lit(len(t.words) - t.k + 1).alias("grams"), F.lit(0 if t.phrase else min(slack, len(t.words) - 2)).alias("slack"), F.lit(t.phrase).alias("phrase")) for t in every])
    t = F.get(about, F.col("template"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    votes = votes.withColumns({"t": t, "_new": F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > t["slack"], F.lit(True)).cast("int")})
    chains = votes.withColumn("chain", F.sum("_new").over(order))
    spans = chains.groupBy("row", "doc_id", "template", "t", "chain").agg(
        F.max("n_words").alias("n_words"), F.min("low").alias("start"), F.max("high").alias("high"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"), F.bool_or("telling").alias("telling")
    )
    own = F.col("high") - F.col("start") + 1
    share, dice = F.col("found") / F.col("t.grams"), 2 * F.col("found") / (F.col("t.grams") + own)
    sound = F.when(F.col("t.phrase"), F.col("found") == F.col("t.grams")).otherwise(F.col("telling") & (share >= least) & (dice >= alike))
    span = F.struct("start", F.col("t.label").alias("label"), "template", (own + F.col("t.k") - 1).alias("words"), share.alias("share"), dice.alias("dice"), F.col("t.phrase").alias("phrase"))
    told = spans.groupBy("row", "doc_id").agg(F.max("n_words").alias("n_words"), F.array_sort(F.collect_list(F.when(sound & (F.col("template") >= 0), span))).alias("spans"))
    return told.select("doc_id", "n_words", "spans")


def licenses(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: its words, places and labels of the phrases, all labels, and the greatest Dice of a span."""
    found = scan(docs)
    base = F.filter("spans", lambda s: s["phrase"])

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform("base", lambda s: s["start"].cast("long"))
    return found.withColumn("base", base).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["dice"])), F.lit(0.0)).alias("score"),
    )
