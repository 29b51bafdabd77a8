"""Personal data by patterns and a skip-chain conditional random field.

Patterns find emails, IP addresses, payment cards and phone numbers; these base
spans stay. Other mentions (words with an @, long digit groups) that no pattern
accepts, such as a phone number repeated without its prefix, are labelled by a
conditional random field over a text's mentions: node potentials from a mention's
shape, chain potentials between neighbours, and skip potentials between distant
mentions that are equal or similar (same digits at the end, same local part of an
address). Loopy message passing gives the marginals, with base spans held at
their kind; a mention that gets a kind with high probability becomes a span.

Equal mentions are linked as a chain (each to the one before), so the graph grows
with the text and not with the square of a mention's repeats. Weights are fitted by
pseudo-likelihood on a bounded sample of different texts, with the patterns' decisions
as labels; mentions similar to a base span are left out there, as theirs are open. Of
base spans that have an equal or similar one in their text, every other one is learnt
with its shape hidden, so that the skip potentials have to carry its kind. A text
without any mention that resembles a base span gets no further span: the field carries
kinds across a document and makes up none.

Mentions have bounds of their own, whatever the text's length: words of up to 64
characters before an @ and 255 after it, and groups of digits and separators of 7 to 35
characters; longer runs are taken in parts.

Defined results: null and empty texts have no spans; repeated rows give equal
spans; an empty table gives no rows; a column of the result's name is replaced;
without sample texts all weights but the skip prior are zero.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
RESULT = "struct<base: array<struct<kind: string, start: int, end: int>>, added: array<struct<kind: string, start: int, end: int>>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MENTION = re.compile(r"[^\s@]{1,64}@[^\s@]{1,255}|[+(]{0,2}[0-9][0-9().\x20-]{5,30}[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SAME, _SIMILAR = 0, 1


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of all pattern matches that hold, sorted.

    Same matches as the plain patterns give, found without their quadratic cost on long
    runs: an address starts where the run of local characters before its @ starts.
    """
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            found.append((start, 0, last))
        at = text.find("@", max(last, at + 1))
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) of base spans and of other mentions, which don't overlap them and have label 0; sorted."""
    found = [(a, b, k + 1) for a, k, b in base]
    ends = np.maximum.accumulate([b for _, b, _ in found]).tolist() if found else []
    starts = [a for a, _, _ in found]
    for m in _MENTION.finditer(text):
        a, b = m.span()
        b -= len(m[0]) - len(m[0].rstrip(".,;:!?)\"'"))
        if "@" not in m[0] and sum(map(str.isdigit, m[0])) < 7:
            continue
        i = bisect_right(starts, b - 1)
        if i == 0 or ends[i - 1] <= a:
            found.append((a, b, 0))
    return sorted(found)


def _features(x: str) -> np.ndarray:
    digits = _NOT_DIGIT.sub("", x)
    n = len(digits)
    return np.array([1, "@" in x, "@" in x and "." in x.partition("@")[2], x[:1] == "+", "(" in x, " " in x, "-" in x, x.count(".") == 3 and n <= 12, n < 9, 9 <= n <= 11, 12 <= n <= 15, n >= 16, n >= 12 and luhn(digits), len(x) == n], dtype=float)


N_FEATURES, N_LABELS = 14, len(KINDS) + 1


def links(said: list[str]) -> list[tuple[int, int, int]]:
    """(earlier, later, type) of equal and of similar mentions, each linked to the nearest earlier one."""
    last: dict[tuple, int] = {}
    found = []
    for i, x in enumerate(said):
        digits = _NOT_DIGIT.sub("", x)
        similar = ("@", x.partition("@")[0].lower()) if "@" in x else ("#", digits[-7:])
        for key, kind in (((_SAME, x.lower()), _SAME), ((_SIMILAR, similar), _SIMILAR)):
            j = last.get(key)
            if j is not None and (kind == _SAME or said[j].lower() != x.lower()):
                found.append((j, i, kind))
            last[key] = i
    return found


@dataclass
class SkipChain:
    """Weights: node (features x labels), chain and the two skip potentials (labels x labels)."""

    node: np.ndarray = field(default_factory=lambda: np.zeros((N_FEATURES, N_LABELS)))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((N_LABELS, N_LABELS)))
    skip: np.ndarray = field(default_factory=lambda: np.stack([np.eye(N_LABELS) * 4.0, np.eye(N_LABELS) * 2.0]))
    least: float = 0.9
    rounds: int = 12

    def marginals(self, said: list[str], labels: list[int]) -> np.ndarray:
        """Of each mention over O and the kinds, by loopy sum-product messages; labels above 0 are held."""
        n = len(said)
        unary = np.stack([_features(x) for x in said]) @ self.node
        for i, y in enumerate(labels):
            if y:
                unary[i] = -1e3
                unary[i, y] = 0
        edges = [(i, i + 1, self.chain) for i in range(n - 1)] + [(i, j, self.skip[k]) for i, j, k in links(said)]
        source = np.array([e for i, j, _ in edges for e in (i, j)], dtype=int)
        target = np.array([e for i, j, _ in edges for e in (j, i)], dtype=int)
        belief = unary.copy()
        if len(edges):
            weights = np.stack([w for _, _, m in edges for w in (m, m.T)])
            back = np.arange(len(source)) ^ 1
            message = np.zeros((len(source), N_LABELS))
            for _ in range(self.rounds):
                cavity = belief[source] - message[back]
                new = np.logaddexp.reduce(cavity[:, :, None] + weights, axis=1)
                new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
                done = np.abs(new - message).max() < 1e-4
                message = 0.5 * message + 0.5 * new if not done else new
                belief = unary.copy()
                np.add.at(belief, target, message)
                if done:
                    break
        return np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True))

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(start, kind index, end) of mentions beside the base spans that get a kind."""
        found = mentions(text, base)
        labels = [y for _, _, y in found]
        if 0 not in labels:
            return []
        p = self.marginals([text[a:b] for a, b, _ in found], labels)
        return [(a, int(p[i, 1:].argmax()), b) for i, (a, b, y) in enumerate(found) if y == 0 and p[i, 1:].max() >= self.least]


def fit_skip_chain(docs: DataFrame, texts: int = 4000, mentions_each: int = 200, rounds: int = 150, rate: float = 0.5, ridge: float = 1e-3) -> SkipChain:
    """Fit by pseudo-likelihood on about ``texts`` different texts, taken by their hash, with at most ``mentions_each`` mentions of each, by theirs, from all over the text."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = mentions(text, base_spans(text))
                if len(found) > mentions_each:
                    kept = sorted(range(len(found)), key=lambda i: crc32(f"{i} {text[found[i][0] : found[i][1]]}".encode("utf-8", "surrogatepass")))[:mentions_each]
                    found = [found[i] for i in sorted(kept)]
                out.append(([text[a:b] for a, b, _ in found], [y for _, _, y in found]))
            yield pd.DataFrame(out, columns=["said", "labels"]).loc[lambda x: x["said"].str.len() > 0]

    grain = 1_000_000
    count = max(1, docs.count())
    sample = docs.select("text").where(F.pmod(F.xxhash64(F.lit("pii"), "text"), F.lit(grain)) < int(grain * min(1.0, texts / count)))
    rows = sample.where("text is not null").distinct().mapInPandas(seen, "said array<string>, labels array<int>").collect()
    model = SkipChain()
    x, y, known, pairs, offset = [], [], [], [], 0
    for row in rows:
        n, edges = len(row["said"]), links(row["said"])
        near_base = {e for i, j, _ in edges for e in (i, j) if row["labels"][i] or row["labels"][j]}
        shapes = [_features(s) for s in row["said"]]
        repeated = sorted({e for i, j, _ in edges for e in (i, j) if row["labels"][i] and row["labels"][j]})
        for i in repeated[::2]:
            shapes[i] = np.eye(N_FEATURES)[0]
        x += shapes
        y += row["labels"]
        known += [bool(row["labels"][i]) or i not in near_base for i in range(n)]
        pairs += [(offset + i, offset + i + 1, 2) for i in range(n - 1)] + [(offset + i, offset + j, k) for i, j, k in edges]
        offset += n
    if not x:
        return model
    x, y, known = np.stack(x), np.array(y), np.array(known, dtype=float)
    i, j, k = (np.array([p[c] for p in pairs], dtype=int) for c in range(3))
    both = known[i] * known[j] > 0 if len(i) else np.zeros(0, dtype=bool)
    i, j, k = i[both], j[both], k[both]
    truth = np.eye(N_LABELS)[y]
    potentials = [model.skip[0], model.skip[1], model.chain]
    n = known.sum()
    for _ in range(rounds):
        logits = x @ model.node
        for t, w in enumerate(potentials):
            a, b = i[k == t], j[k == t]
            np.add.at(logits, b, w[y[a]])
            np.add.at(logits, a, w.T[y[b]])
        p = np.exp(logits - np.logaddexp.reduce(logits, axis=1, keepdims=True))
        g = (truth - p) * known[:, None]
        model.node += rate * (x.T @ g / n - ridge * model.node)
        for t, w in enumerate(potentials):
            a, b = i[k == t], j[k == t]
            step = np.zeros_like(w)
            np.add.at(step, y[a], g[b])
            np.add.at(step.T, y[b], g[a])
            w += rate * (step / n - ridge * (w if t == 2 else 0))
    return model


def with_pii(docs: DataFrame, model: SkipChain, column: str = "pii") -> DataFrame:
    """``docs`` (text and any further columns) with a struct ``column``: base and added spans in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def told(spans: list[tuple[int, int, int]]) -> list[dict]:
            return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

        for texts in batches:
            out = []
            for text in texts:
                base = base_spans(text or "")
                out.append((told(base), told(shared.value.added(text or "", base))))
            yield pd.DataFrame(out, columns=["base", "added"])

    # told to be non-deterministic, so that a filter on its result doesn't run it a second time
    return docs.withColumn(column, found.asNondeterministic()(F.col("text")))
