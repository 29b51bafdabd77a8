"""Bounded samples of labelled documents for fitting classifiers, and calibration of their scores."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GRAIN = 1_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """Texts of about ``per_class`` labelled documents of each class: columns doc_id, text,
    label (0/1), part (0..9).

    Rows are taken by a hash of their id, at a rate that follows from the number of
    labels, so the sample and its broadcast list of ids have a bound that doesn't
    grow with the corpus. Null ids and labels are left out; an id with several
    labels takes the largest, one with several rows the least text, so an id is one row
    however often it occurs. ``part`` is another hash of the id.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(_GRAIN))
    taken = [(F.col("label") == y) & (place < int(_GRAIN * min(1.0, per_class / n))) for y, n in counts.items()]
    chosen = known.where(taken[0] if len(taken) == 1 else taken[0] | taken[1]) if taken else known.limit(0)
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return found.select("doc_id", "text", "label", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(10)).cast("int").alias("part"))


def without_copies(sample: DataFrame, tries: int = 3) -> DataFrame:
    """A bounded sample with one document of each group of near copies.

    A document goes if one of its ``tries`` minimal hashes of three-word shingles is
    that of one with a smaller id. The sample's hashes are compared on the driver.
    """
    masks = np.random.default_rng(1).integers(1, 2**32, size=(tries, 1), dtype=np.uint64)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                words = text.split()
                codes = np.array([zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))], dtype=np.uint64)
                found.append(((codes ^ masks) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)).min(axis=1).astype(np.int64).tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "hashes": found})

    seen: set[tuple[int, int]] = set()
    first = []
    for row in sorted(sample.select("doc_id", "text").mapInPandas(hashed, "doc_id long, hashes array<long>").collect()):
        own = set(enumerate(row["hashes"]))
        if not own & seen:
            first.append((row["doc_id"],))
        seen |= own
    kept = sample.sparkSession.createDataFrame(first, "doc_id long")
    return sample.join(F.broadcast(kept), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of the probability of ``y`` = 1 given the one feature ``x`` (Platt's targets)."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = float(np.std(x)) or 1.0
    z, a, b = x / scale, 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - t) * z).sum() + ridge * a, (p - t).sum()])
        h = np.array([[(w * z * z).sum() + ridge, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return a / scale, b


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-min(max(x, -500.0), 500.0))))
