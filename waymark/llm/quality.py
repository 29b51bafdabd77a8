"""Quality by naive Bayes support vectors.

A document's features are indicators of its n-grams: word 1- and 2-grams, and 1-
to 3-grams of word shapes (kinds of characters, runs collapsed; a word equal to
the one before has a shape of its own). Each indicator is scaled by its
log-count ratio between the classes, rows are brought to length one, and a
linear hinge-loss model is fitted by dual coordinate descent. A logistic fit on
training documents kept aside turns its margin into a probability.

Defined results: null and empty texts have no features, so their score is that
of the bias alone; repeated rows score alike; an empty table gives no rows; a
column of the result's name is replaced. Labels that lack one class give 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.labelled import fit_logistic, labelled_sample, logistic

_RUN = re.compile(r"[^\W\d_]+|\d+|(.)\1+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_SAME = np.uint64(xxhash.xxh3_64_intdigest("same as before"))


def _kind(run: re.Match) -> str:
    x = run[0]
    if not x.isalpha():
        return "9" if x[0].isdigit() else x[:2]
    return "a" if x.islower() else "A" if x.isupper() else "Aa" if x[0].isupper() and x[1:].islower() else "x"


def _shape(token: str) -> str:
    return _RUN.sub(_kind, token)


class _Codes(dict):
    """64-bit codes of (word, shape) by token, filled on demand."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) > 300_000:
            self.clear()
        word = xxhash.xxh3_64_intdigest("w" + token.lower().strip(".,!?;:"))
        self[token] = found = (word, xxhash.xxh3_64_intdigest("s" + _shape(token)))
        return found


def features(text: str, codes: dict[str, tuple[int, int]]) -> np.ndarray:
    """Distinct codes of a text's n-grams, sorted."""
    tokens = text.split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    both = np.array([codes[t] for t in tokens], dtype=np.uint64)
    words, shapes = both[:, 0], both[:, 1].copy()
    shapes[1:][words[1:] == words[:-1]] = _SAME
    found = [words, shapes, words[:-1] * _MIX[0] + words[1:] * _MIX[1]]
    pairs = shapes[:-1] * _MIX[0] + shapes[1:] * _MIX[1]
    found += [pairs, pairs[:-1] * _MIX[2] + shapes[2:]]
    return np.unique(np.concatenate(found))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, n: int, cost: np.ndarray, epochs: int = 20, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) of the hinge-loss linear model; ``rows`` and ``values`` are sparse, ``y`` is -1 or 1."""
    w, alpha, random = np.zeros(n + 1), np.zeros(len(y)), np.random.default_rng(seed)
    size = np.array([v @ v + 1.0 for v in values])
    for _ in range(epochs):
        for i in random.permutation(len(y)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[n]) - 1
            new = min(max(alpha[i] - gradient / size[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                w[n] += step
                alpha[i] = new
    return w


@dataclass
class QualityModel:
    """Sorted feature codes with ratio and weight; their number is bounded by the training sample."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    slope: float = 0.0
    intercept: float = 0.0

    def row(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices and values of a document's scaled indicators."""
        if not len(self.keys):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        at = np.searchsorted(self.keys, found)
        at[at == len(self.keys)] = 0
        at = at[self.keys[at] == found]
        values = self.ratio[at]
        return at, values / (np.sqrt((values * values).sum()) or 1.0)

    def margin(self, found: np.ndarray) -> float:
        at, values = self.row(found)
        return float(self.weight[at] @ values) + self.bias


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 2000, least: int = 3, smoothing: float = 1.0, cost: float = 1.0) -> QualityModel:
    """Fit on about ``per_class`` documents with ``labels.quality`` 0 and as many with 1.

    A fifth of them (by a hash of the id) is kept aside for the logistic fit. N-grams in
    fewer than ``least`` of the others are left out.
    """

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = _Codes()
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "part": batch["part"], "codes": [features(t, codes).tobytes() for t in batch["text"]]})

    seen = labelled_sample(docs, labels, "quality", per_class).mapInPandas(coded, "label int, part int, codes binary").collect()
    sets = [np.frombuffer(r["codes"], dtype=np.uint64) for r in seen]
    y, aside = np.array([r["label"] for r in seen], dtype=int), np.array([r["part"] >= 8 for r in seen], dtype=bool)
    model = QualityModel()
    if min(((y == k) & ~aside).sum() for k in (0, 1)) == 0:
        return model
    fit = np.flatnonzero(~aside)
    keys, counts = np.unique(np.concatenate([sets[i] for i in fit]), return_counts=True)
    model.keys = keys[counts >= least]
    model.ratio = np.ones(len(model.keys))
    by_class = []
    for k in (0, 1):
        n = np.full(len(model.keys), smoothing)
        for i in fit[y[fit] == k]:
            n[model.row(sets[i])[0]] += 1
        by_class.append(np.log(n / n.sum()))
    model.ratio = by_class[1] - by_class[0]
    rows = [model.row(sets[i]) for i in fit]
    sign = np.where(y[fit] == 1, 1.0, -1.0)
    share = np.where(sign > 0, (sign > 0).mean(), (sign < 0).mean())
    w = dual_coordinate_descent([r for r, _ in rows], [v for _, v in rows], sign, len(model.keys), cost * 0.5 / share)
    model.weight, model.bias = w[:-1], float(w[-1])
    held = np.flatnonzero(aside) if len(set(y[aside])) == 2 else fit
    model.slope, model.intercept = fit_logistic(np.array([model.margin(sets[i]) for i in held]), y[held].astype(float))
    return model


def with_quality(docs: DataFrame, model: QualityModel, column: str = "quality_score") -> DataFrame:
    """``docs`` (text and any further columns) with a double ``column``, the probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, codes = shared.value, _Codes()
        for texts in batches:
            yield pd.Series([logistic(model.slope * model.margin(features(t or "", codes)) + model.intercept) for t in texts], dtype=float)

    # told to be non-deterministic, so that a filter on its result doesn't run it a second time
    return docs.withColumn(column, scored.asNondeterministic()(F.col("text")))
