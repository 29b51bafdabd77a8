"""Approximate nearest neighbours by an inverted multi-index, for the largest inner product.

Equal vectors are one entry, with their smallest ids. Vectors are split into halves.
Each half is quantised by its own k-means codebook, fitted on a bounded sample, so a
pair of centroids names a cell. Codebooks grow with the square root of the table (up to
1,024 centroids each), so cells keep their size. A query walks the cells by the sum of its
halves' inner products with the two centroids, largest first: a heap holds the frontier
of the sorted half lists. It first gathers ``first`` entries; their reranked scores give
the score that the k-th neighbour has at least. Then it walks on as far as a cell's
sum, plus ``margin`` standard deviations of what quantisation leaves of an inner product,
could reach that score. Entries of all cells visited are reranked by the exact inner
product in double precision.

The walk needs the number of entries of each cell only (a broadcast of at most a
million numbers). Entries and queries meet by bundles of neighbouring cells of some
thousand entries; a cell with more is cut into parts by a hash of the entry, and only
its queries are copied to each part. Equal queries are searched once. Every row is
indexed.

Defined results: vectors that are null, empty, of another length than the most
frequent one, zero, or that hold null or non-finite components take no part; rows
with a null id likewise; of rows that repeat an id the least vector counts; ties go
to the smaller id; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import checkpointed

#: entries of a bundle of cells, and centroids of a codebook at most
_BUNDLE, _MOST = 4_000, 1_024


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part, one row per id."""
    x = F.col("embedding").cast("array<double>")
    fine = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & fine).select(F.col("vec_id").cast("long"), x.alias("embedding"))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("embedding") == (length["n"] if length else 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Centroids of the rows of ``x`` (fewer than ``k`` if ``x`` has fewer rows), by Lloyd's rounds from k-means++ seeds."""
    random = np.random.default_rng(seed)
    centre = x[[random.integers(len(x))]]
    far = ((x - centre[0]) ** 2).sum(axis=1)
    while len(centre) < min(k, len(x)) and far.sum() > 0:
        centre = np.vstack([centre, x[random.choice(len(x), p=far / far.sum())]])
        far = np.minimum(far, ((x - centre[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        own = (x @ centre.T - (centre**2).sum(axis=1) / 2).argmax(axis=1)
        for c in np.unique(own):
            centre[c] = x[own == c].mean(axis=0)
    return centre


@dataclass
class MultiIndex:
    """Two codebooks, the entries of each cell, and the variance per dimension that quantisation leaves in each half."""

    first: np.ndarray
    second: np.ndarray
    spread: tuple[float, float]
    cells: np.ndarray | None = None
    #: bundle of each cell, and parts of each bundle
    bundle: np.ndarray | None = None
    parts: np.ndarray | None = None

    def cell(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid numbers of the halves of each row."""
        d = self.first.shape[1]
        return tuple((h @ c.T - (c**2).sum(axis=1) / 2).argmax(axis=1) for h, c in ((x[:, :d], self.first), (x[:, d:], self.second)))

    def walk(self, query: np.ndarray, entries: int, least: float | None = None, margin: float = 0.0) -> list[tuple[int, int]]:
        """Cells in order of their sum until ``entries`` are gathered and, given ``least``, until no sum could reach it."""
        d = self.first.shape[1]
        a, b = self.first @ query[:d], self.second @ query[d:]
        i_of, j_of = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[i_of], b[j_of]
        slack = margin * np.sqrt(self.spread[0] * (query[:d] @ query[:d]) + self.spread[1] * (query[d:] @ query[d:]))
        heap, found, gathered = [(-(a[0] + b[0]), 0, 0)], [], 0
        reached = [-1] * len(a)
        while heap:
            total, i, j = heapq.heappop(heap)
            if gathered >= entries and (least is None or -total + slack < least):
                break
            if n := int(self.cells[i_of[i], j_of[j]]):
                found.append((int(i_of[i]), int(j_of[j])))
                gathered += n
            reached[i] = j
            # a cell enters the frontier once the cells above and to the left of it are done
            if j + 1 < len(b) and (i == 0 or reached[i - 1] >= j + 1):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if i + 1 < len(a) and reached[i + 1] == j - 1:
                heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
        return found


def build(vectors: DataFrame, centroids: int | None = None, sample: int = 20_000) -> tuple[MultiIndex | None, DataFrame]:
    """Index fitted on about ``sample`` vectors (64 for each centroid, if that is more), and the entries (key, embedding, ids, bundle, cell, part) of all ``vectors`` (key, embedding, ids)."""
    count = vectors.count()
    centroids = centroids or int(min(_MOST, max(16, round(count**0.5 / 4))))
    grain = 1_000_000
    place = F.pmod(F.xxhash64(F.lit("ann"), "key"), F.lit(grain))
    wanted = max(sample, 64 * centroids)
    rows = vectors.where(place < max(1, int(grain * min(1.0, wanted / max(1, count))))).select("key", "embedding").collect()
    rows = rows or vectors.select("key", "embedding").limit(1).collect()
    schema = "key struct<a: long, b: long>, embedding array<double>, ids array<long>, bundle int, cell int, part int"
    if not rows:
        return None, vectors.sparkSession.createDataFrame([], schema)
    x = np.array([r["embedding"] for r in sorted(rows, key=lambda r: r["key"])])
    d = (x.shape[1] + 1) // 2
    index = MultiIndex(k_means(x[:, :d], centroids), k_means(x[:, d:], centroids) if x.shape[1] > d else np.zeros((1, 0)), (0.0, 0.0))
    i, j = index.cell(x)
    index.spread = (float(((x[:, :d] - index.first[i]) ** 2).mean()), float(((x[:, d:] - index.second[j]) ** 2).mean()) if x.shape[1] > d else 0.0)
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                i, j = shared.value.cell(np.stack(batch["embedding"].to_numpy()))
                yield pd.DataFrame({"key_a": batch["a"], "key_b": batch["b"], "embedding": batch["embedding"], "ids": batch["ids"], "cell": i * len(shared.value.second) + j})

    flat = vectors.select("key.a", "key.b", "embedding", "ids")
    entries = checkpointed(flat.mapInPandas(placed, "key_a long, key_b long, embedding array<double>, ids array<long>, cell int"))
    cells = np.zeros(len(index.first) * len(index.second), dtype=np.int64)
    for r in entries.groupBy("cell").count().collect():
        cells[r["cell"]] = r["count"]
    index.cells = cells.reshape(len(index.first), len(index.second))
    # neighbouring cells are bundled up to some thousand entries; one with more is a bundle of its own, in parts
    bundle, held, number = np.zeros(len(cells), dtype=np.int32), 0, 0
    for c, n in enumerate(cells.tolist()):
        if held and held + n > _BUNDLE:
            number, held = number + 1, 0
        bundle[c], held = number, held + n
    index.bundle = bundle
    index.parts = 1 + np.bincount(bundle, weights=cells).astype(np.int64) // (2 * _BUNDLE)
    known = vectors.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("struct<bundle: int, parts: int>")
    def bundled(cell: pd.Series) -> pd.DataFrame:
        b = known.value.bundle[cell.to_numpy()]
        return pd.DataFrame({"bundle": b, "parts": known.value.parts[b].astype(np.int32)})

    told = entries.withColumn("_b", bundled("cell"))
    part = F.pmod(F.xxhash64("key_a", "key_b"), F.col("_b.parts")).cast("int")
    return index, told.select(F.struct(F.col("key_a").alias("a"), F.col("key_b").alias("b")).alias("key"), "embedding", "ids", F.col("_b.bundle").alias("bundle"), "cell", part.alias("part"))


def _reranked(entries: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """(query, score, ids): each query's ``k`` best entries of the cells that it probes.

    ``probes``: query (its key), vector, bundle, part, cells.
    """

    def best(entry: pd.DataFrame, probe: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entry) and len(probe):
            entry = entry.sort_values("cell", kind="stable")
            x, cell = np.stack(entry["embedding"].to_numpy()), entry["cell"].to_numpy()
            ids = entry["ids"].to_numpy()
            least_id = np.array([i[0] for i in ids], dtype=np.int64)
            for a, b, vector, cells in zip(probe["a"], probe["b"], probe["vector"], probe["cells"], strict=True):
                lo, hi = np.searchsorted(cell, cells), np.searchsorted(cell, cells, side="right")
                at = np.concatenate([np.arange(p, q) for p, q in zip(lo, hi, strict=True)])
                if len(at):
                    vector = np.asarray(vector)
                    s = x[at] @ vector
                    if len(at) > k:
                        # all that tie with the k-th within rounding go on, to be scored exactly
                        least = np.partition(s, len(s) - k)[len(s) - k]
                        at = at[s >= least - 1e-9 * max(1.0, abs(least))]
                    exact = (x[at] * vector).sum(axis=1)
                    top = np.lexsort((least_id[at], -exact))[:k]
                    out += [(a, b, float(exact[t]), ids[at[t]]) for t in top]
        return pd.DataFrame(out, columns=["a", "b", "score", "ids"])

    right = probes.select("query.a", "query.b", "vector", "bundle", "part", "cells")
    key = ["bundle", "part"]
    found = entries.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(best, "a long, b long, score double, ids array<long>")
    order = Window.partitionBy("a", "b").orderBy(F.desc("score"), F.col("ids")[0])
    top = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    return top.select(F.struct("a", "b").alias("query"), "score", "ids")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, centroids: int | None = None, first: int = 256, margin: float = 3.0, sample: int = 20_000) -> DataFrame:
    """The ``k`` nearest found of each row of ``vectors`` (vec_id, embedding) for which ``queries`` holds, itself left out.

    ``queries`` is a condition on ``vec_id``. Columns: query_id, rank, vec_id, score.
    """
    rows = checkpointed(usable(vectors).withColumn("key", F.struct(F.xxhash64(F.lit(1), "embedding").alias("a"), F.xxhash64(F.lit(2), "embedding").alias("b"))))
    # of equal vectors no more than the k + 1 smallest ids can be among the nearest of any query
    few = rows.withColumn("_r", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("_r") <= k + 1)
    distinct = checkpointed(few.groupBy("key").agg(F.first("embedding").alias("embedding"), F.array_sort(F.collect_list("vec_id")).alias("ids")))
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), F.col("key").alias("query"))
    index, entries = build(distinct, centroids, sample)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    searched = distinct.join(asked.select(F.col("query").alias("key")).distinct(), "key", "left_semi").select(F.col("key").alias("query"), F.col("embedding").alias("vector"))
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        wide = len(index.second)
        for batch in batches:
            out = []
            least = batch["least"] if "least" in batch else [None] * len(batch)
            for a, b, vector, far in zip(batch["a"], batch["b"], batch["vector"], least, strict=True):
                vector, by_bundle = np.asarray(vector), {}
                for i, j in index.walk(vector, max(first, k + 1), None if far is None or np.isnan(far) else far, margin):
                    cell = i * wide + j
                    by_bundle.setdefault(int(index.bundle[cell]), []).append(cell)
                out += [(a, b, vector, n, part, cells) for n, cells in by_bundle.items() for part in range(int(index.parts[n]))]
            yield pd.DataFrame(out, columns=["a", "b", "vector", "bundle", "part", "cells"])

    def probes(rows: DataFrame) -> DataFrame:
        flat = rows.select("query.a", "query.b", *[c for c in rows.columns if c != "query"])
        found = flat.mapInPandas(walked, "a long, b long, vector array<double>, bundle int, part int, cells array<int>")
        return found.select(F.struct("a", "b").alias("query"), "vector", "bundle", "part", "cells")

    near = _reranked(entries, probes(searched), k + 1)
    least = near.groupBy("query").agg(F.when(F.sum(F.size("ids")) > k, F.min("score")).alias("least"))
    again = checkpointed(_reranked(entries, probes(searched.join(least, "query", "left")), k + 1))
    each = again.select("query", "score", F.explode("ids").alias("vec_id"))
    each = each.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("_r") <= k + 1)
    told = asked.join(each.drop("_r"), "query").where("vec_id <> query_id")
    ranked = told.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
