"""Near-duplicates by BagMinHash signatures, banding and exact verification.

A text is the bag of its five-word shingles, each weighted by how often it occurs.
Weights are discretised to whole numbers. For each shingle a hierarchy of Poisson
processes runs over the dyadic weight ranges [0,1), [1,2), [2,4), [4,8), ...: each
has points of a random time, signature component and place within its range, drawn
from a hash of shingle and range alone. A point counts for a text if its place lies
below the shingle's weight there, and a component's value is the point of the least
time, so two texts agree in a component with the probability of their weighted
Jaccard similarity. Points are drawn in order of time up to a bound by which all
components have one, and ranges drop out as their next point lies beyond it.

1. Equal texts are one node (by their md5) from the start.
2. 25 bands of 5 components: nodes that share a band's value are candidates; a pair
   at similarity 0.8 shares none with a probability of 5e-5.
3. Each bucket links its nodes to its least one (a star); candidates are verified by
   the exact similarity of their bags, and verified links give components: those of
   the first five bands at once, then those of the others that lie across components.
4. Only nodes of one bucket that lie in different components are compared further: in
   buckets of up to 17 nodes all pairs, in larger ones each node with the three before it.
5. The nodes of larger buckets that still hold different components meet by exact
   prefixes, which lose no pair: a node's shingles are put in one order, rare ones
   first, and two bags whose overlap reaches the similarity share a shingle among
   the first few of each, as many as their sizes tell. So texts from one template
   that are below the similarity to each other don't meet by the template. Where a
   shingle's nodes lie in different components, those outside its largest one meet
   all others, in salted blocks where there are many; candidates are verified in
   three steps, a few for each node first, then more and in the end all whose
   components still differ.

No bucket emits pairs within a component, and copies cost a row each. Pairs across
components that share a rare shingle are all compared, however many there are. What
reaches the driver are counts, those of the order of shingles in a bounded table.

Defined results: null and empty texts, and texts without words, have no shingles,
so each is a class of its own for null, and equal texts without words form one as
copies, but null is like no other row; texts of fewer than five words are one
shingle; repeated rows are copies; null ids come last when the first of a class is
chosen; an empty table gives no rows. ``docs`` should be a table or another plan
that gives the same rows when it is read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.bloom import maybe_in
from waymark.llm.common import checkpointed, few, free_name, release
from waymark.llm.graph import components
from waymark.llm.words import WordCodes, mix, shingles, weighted_jaccard

COMPONENTS, BANDS, ROWS = 128, 25, 5
_GOLDEN, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_WINDOW, _FEW, _EARLY = 16, 3, 5
#: places of the table of frequencies by which shingles are put in order, nodes of a shingle in one block, candidates of a node in the first steps
_PLACES, _BLOCK, _FIRST = 1 << 18, 1024, (4, 64)
#: texts, or pairs of texts, of a task
_TEXTS = 1000
#: places of that table that a task reports in one row
_STRETCH = 1 << 12


def bag_min_hash(items: np.ndarray, weights: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """Signature of ``m`` 64-bit values of a bag: distinct codes with whole weights of at least 1."""
    seed, low, length, weight = [], [], [], []
    lo, size = 0, 1
    while True:
        own = weights > lo
        if not own.any():
            break
        seed.append(mix(items[own] ^ mix(np.full(own.sum(), lo + 1, dtype=np.uint64))))
        low.append(np.full(own.sum(), lo))
        length.append(np.full(own.sum(), size))
        weight.append(weights[own])
        lo, size = max(1, 2 * lo), max(1, lo * 2)
    seed, low, length, weight = map(np.concatenate, (seed, low, length, weight))
    bound = (np.log(m) + 4) / weights.sum()
    while True:
        s, lo, size, w = seed, low, length, weight
        time, step = np.zeros(len(s)), 0
        times, places, values = [], [], []
        while len(s):
            # the next few points of each range at once; ranges whose last one lies beyond the bound drop out
            ahead = int(min(64, max(2, np.ceil(1.2 * bound * m * size.mean()))))
            steps = np.array([(i * _GOLDEN) & _MASK for i in range(step + 1, step + 1 + ahead)], dtype=np.uint64)
            step += ahead
            point = mix(s[:, None] + steps)
            gap = -np.log(((point >> np.uint64(11)).astype(float) + 0.5) / 2.0**53)
            at = time[:, None] + np.cumsum(gap, axis=1) / (m * size)[:, None]
            row, column = np.nonzero(at <= bound)
            point, when = point[row, column], at[row, column]
            draw = mix(point)
            # the place within the range takes as many hash bits as the range has halvings
            place = lo[row] + ((draw >> np.uint64(32)) % size[row].astype(np.uint64)).astype(np.int64)
            counts = place < w[row]
            times.append(when[counts])
            places.append((draw[counts] & np.uint64(0xFFFFFFFF)) % np.uint64(m))
            values.append(point[counts])
            on = at[:, -1] <= bound
            s, lo, size, w, time = s[on], lo[on], size[on], w[on], at[on, -1]
        order = np.argsort(np.concatenate(times), kind="stable")[::-1]
        signature, filled = np.zeros(m, dtype=np.uint64), np.zeros(m, dtype=bool)
        where = np.concatenate(places)[order].astype(np.int64)
        signature[where] = np.concatenate(values)[order]
        filled[where] = True
        if filled.all():
            return signature
        bound *= 2


def bag(codes: WordCodes, text: str | None) -> np.ndarray:
    return shingles(codes.of(text))


def _signed(docs: DataFrame) -> DataFrame:
    """node, bands and sketch (a byte of each component) of each distinct text that has words."""

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = WordCodes()
        for batch in batches:
            out = []
            for node, text in zip(batch["node"], batch["text"], strict=True):
                found = bag(codes, text)
                if len(found):
                    signature = bag_min_hash(*np.unique(found, return_counts=True))
                    rows = signature[: BANDS * ROWS].reshape(BANDS, ROWS)
                    total = np.zeros(BANDS, dtype=np.uint64)
                    for i in range(ROWS):
                        total = mix(total + rows[:, i])
                    out.append((node, total.astype(np.int64).tolist(), (signature & np.uint64(255)).astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["node", "bands", "sketch"])

    rows = docs.select(_node().alias("node"), "text").where("text is not null")
    rows = rows.mapInPandas(signed, "node binary, bands array<long>, sketch binary")
    return rows.groupBy("node").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))


def _node() -> Column:
    return F.unhex(F.md5("text"))


def _alike(least: float):
    """Whether two sketches agree as often as texts of at least the given similarity do, seven standard deviations allowed."""
    limit = least - 7 * np.sqrt(least * (1 - least) / COMPONENTS)

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), dtype=np.uint8).reshape(-1, COMPONENTS) for s in (a, b))
        return pd.Series((x == y).mean(axis=1) >= limit)

    return alike.asNondeterministic()


def _similarity():
    @F.pandas_udf("double")
    def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        codes, held = WordCodes(), {}

        def of(text: str) -> np.ndarray:
            found = held.get(text)
            if found is None:
                if len(held) >= 64:
                    held.clear()
                held[text] = found = bag(codes, text)
            return found

        for a, b in batches:
            yield pd.Series([weighted_jaccard(of(x), of(y)) for x, y in zip(a, b, strict=True)], dtype=float)

    return similarity.asNondeterministic()


def _verified(pairs: DataFrame, most: int, signed: DataFrame, texts: DataFrame, n_texts: int, least: float) -> DataFrame:
    """Those of the pairs (u, v), at most ``most``, whose texts have the similarity.

    Each pair takes both texts along, so pairs go in slices of at most as many as there are
    texts (``n_texts``), and what one slice has shuffled is released before the next.
    Joins are merged to fewer tasks before Python compares, or a task would keep a queue for
    each of its partitions; so that Spark leaves this order, the comparisons are marked as
    not deterministic, though they are.
    """
    sketch = signed.select("node", "sketch")
    rows = few(few(pairs.distinct(), most).join(sketch.toDF("u", "sketch_u"), "u"), most)
    rows = few(rows.join(sketch.toDF("v", "sketch_v"), "v"), most)
    rows = checkpointed(rows.where(_alike(least)(F.col("sketch_u"), F.col("sketch_v"))).select("u", "v"))
    n = rows.count()
    rows = few(rows, n)
    slices = 1 + n // max(1, n_texts)
    found = None
    for i in range(slices):
        part = rows.where(F.pmod(F.xxhash64(F.lit("slice"), "u", "v"), F.lit(slices)) == i)
        part = few(part.join(texts.toDF("u", "text_u"), "u"), n // slices, _TEXTS)
        part = few(part.join(texts.toDF("v", "text_v"), "v"), n // slices, _TEXTS)
        alike = checkpointed(part.where(_similarity()(F.col("text_u"), F.col("text_v")) >= least - 1e-12).select("u", "v"))
        found = alike if found is None else found.unionByName(alike)
        release(pairs.sparkSession)
    return few(found, n)


def _window_pairs(members: DataFrame) -> DataFrame:
    """Each node of a bucket (key, n, node, component) with those before it, if their components differ: all in small buckets, the last ``_FEW`` in others.

    Large buckets are cut by a hash into windows of some thousand nodes.
    """
    salt = F.when(F.col("n") > 2048, F.pmod(F.xxhash64(F.lit("salt"), "node"), F.ceil(F.col("n") / 2048))).otherwise(0)
    before = Window.partitionBy("key", "salt").orderBy("node").rowsBetween(-_WINDOW, -1)
    rows = members.withColumn("salt", salt).withColumn("before", F.collect_list(F.struct("node", "component")).over(before))
    few = F.slice("before", F.greatest(F.size("before") - _FEW + 1, F.lit(1)), F.lit(_FEW))
    rows = rows.select(F.col("node").alias("u"), "component", F.explode(F.when(F.col("n") > _WINDOW + 1, few).otherwise(F.col("before"))).alias("x"))
    return rows.where("component <> x.component").select("u", F.col("x.node").alias("v"))


def _elements(codes: WordCodes, text: str) -> np.ndarray:
    """Distinct codes for each occurrence of each shingle of a text, so that bags become sets."""
    found, n = np.unique(bag(codes, text), return_counts=True)
    turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return mix(np.repeat(found, n) + turn.astype(np.uint64) * np.uint64(_GOLDEN))


def _prefixes(texts: DataFrame, least: float) -> DataFrame:
    """Rows (node, size, element, at) for the first elements of each text (node, text) in one order, rare ones first.

    Of two bags of which the larger has ``size`` elements, the overlap is at least
    ``least * size`` at the similarity, so further elements can't be the first in common.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, seen = WordCodes(), np.zeros(_PLACES, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                seen += np.bincount((_elements(codes, text) % np.uint64(_PLACES)).astype(np.int64), minlength=_PLACES)
        # a row for each stretch of the table, not for each place
        place = np.flatnonzero(seen)
        stretch = place // _STRETCH
        rows = [(int(s), place[stretch == s].tobytes(), seen[place[stretch == s]].tobytes()) for s in np.unique(stretch)]
        yield pd.DataFrame(rows, columns=["stretch", "place", "n"])

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        place, n = (np.concatenate([np.frombuffer(x, dtype=np.int64) for x in frame[c]]) for c in ("place", "n"))
        own, at = np.unique(place, return_inverse=True)
        total = np.zeros(len(own), dtype=np.int64)
        np.add.at(total, at, n)
        return pd.DataFrame({"stretch": [int(frame["stretch"].iloc[0])], "place": [own.tobytes()], "n": [total.tobytes()]})

    schema = "stretch int, place binary, n binary"
    counts = np.zeros(_PLACES, dtype=np.int64)
    for row in texts.select("text").mapInPandas(counted, schema).groupBy("stretch").applyInPandas(summed, schema).collect():
        counts[np.frombuffer(row["place"], dtype=np.int64)] = np.frombuffer(row["n"], dtype=np.int64)
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, counts = WordCodes(), shared.value
        for batch in batches:
            for node, text in zip(batch["node"], batch["text"], strict=True):
                found = _elements(codes, text)
                found = found[np.lexsort((found, counts[(found % np.uint64(_PLACES)).astype(np.int64)]))]
                first = found[: len(found) - int(np.ceil(least * len(found) - 1e-9)) + 1].view(np.int64)
                yield pd.DataFrame({"node": [node] * len(first), "size": len(found), "element": first, "at": np.arange(len(first))})

    return texts.select("node", "text").mapInPandas(cut, "node binary, size int, element long, at int")


def _prefix_pairs(prefixes: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """All pairs (u, v) of nodes in different components whose prefixes allow the similarity."""
    n = prefixes.count()
    rows = few(few(prefixes, n).join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), n)
    each = few(rows.groupBy("element", "component").agg(F.count("*").alias("n")), n)
    each = each.groupBy("element").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max_by("component", F.struct("n", "component")).alias("main"))
    rows = rows.join(each.where("parts > 1").drop("parts"), "element")
    rows = checkpointed(few(rows.withColumn("blocks", F.ceil(F.col("n") / _BLOCK).cast("int")), n))
    side = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int"))
    side = side.select("element", "block", F.col("node").alias("v"), F.col("component").alias("cv"), F.col("size").alias("size_v"), F.col("at").alias("at_v"), (F.col("component") == F.col("main")).alias("main_v"))
    own = rows.where("component <> main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("element", "block", F.col("node").alias("u"), F.col("component").alias("cu"), F.col("size").alias("size_u"), F.col("at").alias("at_u"))
    # the overlap that the similarity asks for; the first common element leaves room for it in both
    need = F.ceil(F.lit(least / (1 + least)) * (F.col("size_u") + F.col("size_v")) - 1e-9)
    met = own.join(side, ["element", "block"]).where("cu <> cv and (main_v or u > v)")
    met = met.where((F.col("size_u") - F.col("at_u") >= need) & (F.col("size_v") - F.col("at_v") >= need))
    return met.select("u", "v").distinct()


def near_duplicate_links(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(node, component): distinct texts, by md5, that are linked to others; a component is called by its least node."""
    signed = checkpointed(_signed(docs))
    signed = few(signed, signed.count())
    members = signed.select("node", F.posexplode("bands").alias("band", "value")).select("node", F.struct("band", "value").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
    members = checkpointed(members.join(shared, "key"))
    n = members.count()
    members = few(members, n)
    able = members.select("node").distinct()
    texts = docs.where("text is not null").select(_node().alias("node"), "text")
    texts = texts.where(maybe_in(F.col("node"), able)).join(able, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    texts = checkpointed(texts)
    n_texts = texts.count()
    texts = few(texts, n_texts, _TEXTS)

    def verified(pairs: DataFrame, most: int) -> DataFrame:
        return _verified(pairs, most, signed, texts, n_texts, similarity)

    def mixed(members: DataFrame, found: DataFrame) -> DataFrame:
        """Members of those buckets that hold different components."""
        rows = few(members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), n)
        across = rows.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key")
        return checkpointed(few(rows.join(across, "key", "left_semi"), n))

    def apart(pairs: DataFrame, found: DataFrame, most: int) -> DataFrame:
        """Pairs (u, v), at most ``most``, of nodes in different components."""
        for x in "uv":
            pairs = few(pairs.join(found.toDF(x, f"c{x}"), x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x)), most)
        return pairs.where("cu <> cv").drop("cu", "cv")

    # the stars of a few bands link most of what is alike, so that the others bring little more to verify
    stars = members.where("node <> least").select(F.col("key.band").alias("band"), F.col("node").alias("u"), F.col("least").alias("v"))
    links = verified(stars.where(F.col("band") < _EARLY).select("u", "v"), n)
    rest = apart(few(stars.where(F.col("band") >= _EARLY).select("u", "v").distinct(), n), components(links), n)
    links = links.unionByName(verified(rest, n))
    members = mixed(members, components(links))
    more = _window_pairs(members).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = links.unionByName(verified(more, _WINDOW * n))
    found = components(links)
    wide = members.where(F.col("n") > _WINDOW + 1).drop("component")
    if wide.isEmpty():
        return found
    nodes = mixed(wide, found).select("node").distinct()
    prefixes = checkpointed(_prefixes(texts.join(nodes, "node", "left_semi"), similarity))
    pairs = checkpointed(_prefix_pairs(prefixes, found, similarity))
    n_pairs = pairs.count()
    if not n_pairs:
        return found
    # a few candidates for each node first, then more and in the end all of those that still lie apart
    pairs = few(pairs, n_pairs).select("u", "v", F.row_number().over(Window.partitionBy("u").orderBy(F.xxhash64("u", "v"))).alias("turn"))
    pairs = few(checkpointed(pairs), n_pairs)
    done = 0
    for most in (*_FIRST, None):
        pairs = checkpointed(apart(pairs.where(F.col("turn") > done), found, n_pairs).select("u", "v", "turn"))
        if pairs.isEmpty():
            break
        part = pairs if most is None else pairs.where(F.col("turn") <= most)
        links = links.unionByName(verified(part.select("u", "v"), n_pairs))
        found, done = components(links), most
    return found


def near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``docs`` (doc_id, text and any further columns) with class_id, class_size and is_first.

    class_id is the doc_id of the class's first document, which has the least doc_id.
    """
    class_id, class_size, is_first, row, node, link, first, size, able = free_name(docs, "class_id", "class_size", "is_first", "row", "node", "link", "first", "size", "able")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    rows = rows.withColumn(node, F.coalesce(_node(), F.concat(F.lit("null").cast("binary"), F.col(row).cast("string").cast("binary"))))
    linked = near_duplicate_links(docs, similarity)
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    copies = rows.groupBy(F.col(node).alias("node")).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    copies = copies.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = copies.groupBy("component").agg(F.min("first").alias(first), F.sum("n").alias(size)).where(F.col(size) > 1)
    found = checkpointed(copies.select(F.col("node").alias(link), "component").join(classes, "component").select(link, first, size))
    flagged = rows.withColumn(able, maybe_in(F.col(node), found))
    alone = flagged.where(~F.col(able)).select(*docs.columns, F.col("doc_id").alias(class_id), F.lit(1).cast("long").alias(class_size), F.lit(True).alias(is_first))
    joined = flagged.where(F.col(able)).join(found, F.col(node) == F.col(link), "left")
    in_class = F.col(size).isNotNull()
    joined = joined.select(
        *docs.columns,
        F.when(in_class, F.col(f"{first}.id")).otherwise(F.col("doc_id")).alias(class_id),
        F.coalesce(size, F.lit(1)).cast("long").alias(class_size),
        F.when(in_class, F.col(f"{first}.row") == F.col(row)).otherwise(True).alias(is_first),
    )
    return alone.unionByName(joined)
