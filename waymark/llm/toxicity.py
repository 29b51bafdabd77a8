"""Toxicity by maximum-scoring segments of token log-odds.

Each token scores its log-odds of occurring in toxic rather than clean text, with
informative Dirichlet priors that follow the pooled corpus. The same is worked out
for classes of words with the same first four letters, and a word scores like its
class unless its own log-odds say more or the contrary. Log-odds that lie within
a few standard deviations of zero are left out, the others moved towards zero by
one; all other tokens score a small negative drift.

A linear-time scan finds all maximal scoring segments of a text. The chance that
a clean text of ``n`` tokens has a segment of score ``S`` follows an
extreme-value law, ``E = K n exp(-lambda S)``; ``lambda`` and ``K`` are fitted on
clean training texts. Segments of ``E`` below a limit are the toxic passages. The
evidence of all segments, ``sum of -log E`` where ``E`` is below one, is turned into a probability by a
logistic fit on training texts that the log-odds haven't seen.

Defined results: null and empty texts score as texts without tokens; repeated rows
score alike; an empty table gives no rows; a column of the result's name is
replaced. Labels that lack one class, or too few to tell them apart, give a score of 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.labelled import fit_logistic, labelled_sample, logistic, without_copies

_WORD = re.compile(r"\w+")
_STEM = 4
#: Pseudo-count of a rare word; parts (of ten) of the sample that give log-odds.
_LEAST, _ODDS_PARTS = 0.5, 7
RESULT = "struct<score: double, spans: array<struct<start: int, end: int, score: double, e_value: double>>>"


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``[start, end)`` with their sums, by one pass over the positive scores."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum at the end, nearest earlier one with a lower sum before
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, high = i, total[i], total[i + 1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append((start, i + 1, low, high, j))
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, float(high - low)) for a, b, low, high, _ in kept]


@dataclass
class ToxicityModel:
    """``words`` and ``stems`` have the scores that aren't the drift; their number is bounded by the training sample."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    drift: float = -0.05
    decay: float = 1.0
    k: float = 0.1
    slope: float = 0.0
    intercept: float = -500.0
    e_limit: float = 0.01

    def scorer(self) -> dict[str, float]:
        """Scores by token, filled on demand."""
        words, stems, drift = self.words, self.stems, self.drift

        class Scores(dict):
            def __missing__(self, token: str) -> float:
                if len(self) > 500_000:
                    self.clear()
                score = words.get(token)
                if score is None:
                    score = stems.get(token[:_STEM], drift) if len(token) > _STEM else drift
                self[token] = score
                return score

        return Scores()

    def segments(self, text: str, scores: dict[str, float]) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and the maximal segments in tokens."""
        tokens = _WORD.findall(text.lower())
        return len(tokens), maximal_segments(np.fromiter(map(scores.__getitem__, tokens), dtype=float, count=len(tokens)))

    def surprise(self, n: int, score: float) -> float:
        """-log E of a segment in a text of ``n`` tokens."""
        return self.decay * score - math.log(self.k * max(n, 1))

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """Summed surprise of all segments that a clean text has fewer than once, or else the best one's, at most 100."""
        each = [self.surprise(n, s) for _, _, s in found]
        strong = [x for x in each if x > 0]
        return min(100.0, sum(strong)) if strong else max([min(0.0, self.surprise(n, 0.0)), *each])


def _counts(sample: DataFrame) -> dict[tuple[str, str], np.ndarray]:
    """Clean and toxic texts, of the parts for log-odds, in which words and stems occur."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = set(_WORD.findall(text.lower()))
                found.update(("w", token, label) for token in words)
                found.update(("s", stem, label) for stem in {token[:_STEM] for token in words if len(token) > _STEM})
        yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["kind", "token", "label", "n"])

    rows = sample.where(F.col("part") < _ODDS_PARTS).select("text", "label").mapInPandas(counted, "kind string, token string, label int, n long")
    rows = rows.groupBy("kind", "token").agg(F.sum(F.expr("if(label = 0, n, 0)")).alias("n0"), F.sum(F.expr("if(label = 1, n, 0)")).alias("n1"))
    return {(r["kind"], r["token"]): np.array([r["n0"], r["n1"]], dtype=float) for r in rows.where("n0 + n1 >= 3 or kind = 's'").collect()}


def _log_odds(n0: float, n1: float, total0: float, total1: float, prior: float, z: float) -> float:
    """Log-odds under a Dirichlet prior, moved towards zero by a standard deviation; 0 if ``z`` of them reach it."""
    odds = math.log((n1 + prior) / total1) - math.log((n0 + prior) / total0)
    spread = math.sqrt(1 / (n1 + prior) + 1 / (n0 + prior))
    return math.copysign(abs(odds) - spread, odds) if abs(odds) > z * spread else 0.0


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 6000, prior: float = 2000.0, z: float = 2.5) -> ToxicityModel:
    """Fit on about ``per_class`` documents with ``labels.toxic`` 0 and as many with 1.

    Most of them (by a hash of the id) give the log-odds, with ``prior`` pseudo-counts
    spread like the pooled corpus; the others give the extreme-value law and the
    logistic fit. Of near copies one is used, as copies aren't further evidence.
    """
    sample = without_copies(labelled_sample(docs, labels, "toxic", per_class))
    counts = _counts(sample)
    model = ToxicityModel()
    total0, total1 = (sum(c[y] for (kind, _), c in counts.items() if kind == "w") + prior for y in (0, 1))
    if min(total0, total1) <= prior:
        return model
    pooled = total0 + total1 - 2 * prior
    for (kind, token), (n0, n1) in counts.items():
        if kind == "s" and n0 + n1 >= 5:
            share = max(_LEAST, prior * (n0 + n1) / pooled)
            if odds := _log_odds(n0, n1, total0, total1, share, z):
                model.stems[token] = odds
    for (kind, token), (n0, n1) in counts.items():
        if kind == "w":
            odds = _log_odds(n0, n1, total0, total1, max(_LEAST, prior * (n0 + n1) / pooled), z)
            stem = model.stems.get(token[:_STEM], 0.0) if len(token) > _STEM else 0.0
            if odds and (odds * stem <= 0 or abs(odds) > abs(stem)):
                model.words[token] = odds
    hot = sum(c[1] for (kind, t), c in counts.items() if kind == "w" and model.words.get(t, 0) > 0)
    model.drift = math.log1p(-min(0.5, max(0.02, hot / (total1 - prior))))
    return _calibrated(model, sample)


def _calibrated(model: ToxicityModel, sample: DataFrame) -> ToxicityModel:
    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = model.scorer()
        for batch in batches:
            found = [model.segments(t, scores) for t in batch["text"]]
            yield pd.DataFrame({"label": batch["label"], "n": [n for n, _ in found], "sums": [[s for _, _, s in x] for _, x in found]})

    seen = sample.where(F.col("part") >= _ODDS_PARTS).select("text", "label").mapInPandas(scanned, "label int, n int, sums array<double>").collect()
    clean = [(max(1, r["n"]), max(r["sums"], default=0.0)) for r in seen if r["label"] == 0]
    if not clean or len(clean) == len(seen):
        return model
    n, best = (np.array(x, dtype=float) for x in zip(*clean, strict=True))

    def fit(decay: float) -> tuple[float, float]:
        k = len(n) / (n * np.exp(-decay * best)).sum()
        return float((math.log(decay) + np.log(k * n) - decay * best - k * n * np.exp(-decay * best)).sum()), float(k)

    model.decay = max(np.linspace(0.1, 1.0, 91), key=lambda d: fit(d)[0])
    model.k = fit(model.decay)[1]
    x = np.array([model.evidence(r["n"], [(0, 0, s) for s in r["sums"]]) for r in seen])
    slope, intercept = fit_logistic(x, np.array([r["label"] for r in seen], dtype=float))
    if slope > 0:
        model.slope, model.intercept = slope, intercept
    return model


def with_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "toxicity") -> DataFrame:
    """``docs`` (text and any further columns) with a struct ``column``: score (0 to 1) and the significant spans in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        scores = model.scorer()
        for texts in batches:
            out = []
            for text in texts:
                text = text or ""
                n, found = model.segments(text, scores)
                strong = [(a, b, s) for a, b, s in found if model.surprise(n, s) > -math.log(model.e_limit)]
                at = [m.span() for m in _WORD.finditer(text.lower())] if strong else []
                spans = [{"start": at[a][0], "end": at[b - 1][1], "score": s, "e_value": math.exp(-model.surprise(n, s))} for a, b, s in strong]
                out.append((logistic(model.slope * model.evidence(n, found) + model.intercept), spans))
            yield pd.DataFrame(out, columns=["score", "spans"])

    # told to be non-deterministic, so that a filter on its result doesn't run it a second time
    return docs.withColumn(column, scored.asNondeterministic()(F.col("text")))
