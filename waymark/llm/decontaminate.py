"""Benchmark decontamination by SimHash of item-sized windows.

Each benchmark item has a 64-bit SimHash of its five-word shingles, weighted by
how often they occur in it. Windows of as many words as an item slide over every
text; a text shorter than the item is one window as a whole. Fingerprints are cut into ``radius + 1`` blocks, so that any two within
``radius`` bits agree in one block at least; tables of the items' blocks, by item
length, give all items within the radius of a window. Exact weighted similarity of
the shingles (sum of smaller over sum of larger multiplicities) decides.

A window of ``w`` shingles reaches similarity ``t`` with an item of ``s`` only if
``t (w + s) / (1 + t)`` of its shingles occur in the benchmark; windows with fewer are
left out before they get a fingerprint, which loses nothing. Shingles of a pair at
similarity 0.8 put its fingerprints some 10 bits apart on average; the default
radius of 23 lies more than four standard deviations beyond.

Items reach the executors in blocks of bounded size, one broadcast after the other, a
checkpoint between them; documents are never shuffled.

Defined results: null and empty texts, and items without words, match nothing;
items of fewer than five words match as one shingle; a repeated item matches under
each of its ids; null ids are kept; repeated documents match alike; an empty table
on either side gives no match; a column of the result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import checkpointed, free_name
from waymark.llm.words import SHINGLE, WordCodes, mix, shingles, weighted_jaccard

BITS = 64
MATCHES = "array<struct<item_id: bigint, similarity: double, start_word: int, n_words: int>>"
_MAP_BITS = 20


def _signs(codes: np.ndarray) -> np.ndarray:
    """+1 and -1 of each code's bits, after mixing."""
    bits = np.unpackbits(mix(codes ^ np.uint64(0x5851F42D4C957F2D)).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _blocks(bits: np.ndarray, radius: int) -> np.ndarray:
    """Values of the ``radius + 1`` blocks of each row of bits."""
    edges = np.linspace(0, BITS, radius + 2).astype(int)
    weights = np.zeros((BITS, radius + 1), dtype=np.float32)
    for b, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        weights[low:high, b] = 1 << np.arange(high - low)
    return (bits.astype(np.float32) @ weights).astype(np.int64)


@dataclass
class _Class:
    """Items of one length: ids, shingles, fingerprint bits and, per block, item numbers in order of the block's value."""

    ids: list
    bags: list[np.ndarray]
    bits: np.ndarray
    blocks: np.ndarray
    order: np.ndarray
    values: np.ndarray

    def near(self, bits: np.ndarray, radius: int) -> list[tuple[int, int]]:
        """(row of ``bits``, item) of all fingerprints within the radius, by equal blocks."""
        own, found = _blocks(bits, radius), []
        if len(own) * len(self.ids) <= 20_000:  # few enough to look at the blocks themselves
            rows, items = np.nonzero((own[:, None, :] == self.blocks).any(axis=2))
            close = (bits[rows] != self.bits[items]).sum(axis=1) <= radius
            return list(zip(rows[close].tolist(), items[close].tolist(), strict=True))
        for b in range(own.shape[1]):
            low = np.searchsorted(self.values[b], own[:, b], "left")
            n = np.searchsorted(self.values[b], own[:, b], "right") - low
            rows = np.repeat(np.arange(len(own)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            found.append(rows * len(self.ids) + self.order[b][at])
        pairs = np.unique(np.concatenate(found))
        rows, items = pairs // len(self.ids), pairs % len(self.ids)
        close = (bits[rows] != self.bits[items]).sum(axis=1) <= radius
        return list(zip(rows[close].tolist(), items[close].tolist(), strict=True))


class Index:
    """Fingerprint tables of a block of items, by their number of words."""

    def __init__(self, items: list[tuple[int | None, str | None]], radius: int, similarity: float):
        self.radius, self.similarity = radius, similarity
        codes, by_length = WordCodes(), {}
        for item_id, text in items:
            words = codes.of(text)
            if len(words):
                by_length.setdefault(len(words), []).append((item_id, shingles(words)))
        self.classes: dict[int, _Class] = {}
        for length, own in by_length.items():
            bits = np.stack([_signs(s).sum(axis=0) >= 0 for _, s in own])
            blocks = _blocks(bits, radius)
            values = blocks.T
            order = np.argsort(values, axis=1, kind="stable")
            self.classes[length] = _Class([i for i, _ in own], [s for _, s in own], bits, blocks, order, np.take_along_axis(values, order, axis=1))
        self.known = {}
        for k in {min(SHINGLE, n) for n in self.classes}:
            every = np.unique(np.concatenate([s for n, c in self.classes.items() if min(SHINGLE, n) == k for s in c.bags]))
            seen = np.zeros(1 << _MAP_BITS, dtype=bool)
            seen[every & np.uint64((1 << _MAP_BITS) - 1)] = True
            self.known[k] = (every, seen)

    def matches(self, words: np.ndarray) -> list[dict]:
        """Best window of each matching item."""
        best: dict[tuple[int, int], dict] = {}
        for k, (every, seen) in self.known.items():
            if len(words) < k:
                continue
            said = shingles(words, k)
            hit = seen[said & np.uint64((1 << _MAP_BITS) - 1)]
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            true = every[np.minimum(np.searchsorted(every, said[at]), len(every) - 1)] == said[at]
            hit[at[~true]] = False
            hits, total = int(true.sum()), None
            for length, c in self.classes.items():
                size = length - k + 1
                span = min(size, len(said))  # a text shorter than the item is its one window
                need = self.similarity * (size + span) / (1 + self.similarity)
                if min(SHINGLE, length) != k or hits < need - 1e-9:
                    continue
                if total is None:
                    total = np.concatenate([[0], np.cumsum(hit)])
                starts = np.flatnonzero(total[span:] - total[:-span] >= need - 1e-9)
                for part in np.array_split(starts, len(starts) // 2048 + 1):
                    if len(part):
                        self._verify(said, part, span, min(length, len(words)), c, best)
        return sorted(best.values(), key=lambda m: (m["item_id"] is None, m["item_id"] or 0))

    def _verify(self, said: np.ndarray, starts: np.ndarray, size: int, n_words: int, c: _Class, best: dict) -> None:
        low = starts[0]
        sums = np.concatenate([np.zeros((1, BITS), dtype=np.int32), np.cumsum(_signs(said[low : starts[-1] + size]), axis=0, dtype=np.int32)])
        bits = sums[starts - low + size] - sums[starts - low] >= 0
        for row, item in c.near(bits, self.radius):
            start = int(starts[row])
            score = weighted_jaccard(said[start : start + size], c.bags[item])
            key = (id(c), item)
            if score >= self.similarity and (key not in best or score > best[key]["similarity"]):
                best[key] = {"item_id": c.ids[item], "similarity": score, "start_word": start, "n_words": n_words}


def with_matches(docs: DataFrame, items: DataFrame, similarity: float = 0.8, radius: int = 23, block_chars: int = 20_000_000, column: str = "matches") -> DataFrame:
    """``docs`` (text and any further columns) with an array ``column``: benchmark items found in the text.

    ``items``: item_id, text. They are collected and broadcast in blocks of about
    ``block_chars`` characters; with more than one block the documents are written to the
    checkpoint folder after each and its broadcast is destroyed, so a task holds one block
    however large the benchmark is.
    """
    context = docs.sparkSession.sparkContext
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // block_chars) + 1
    found, (so_far,) = docs, free_name(docs, "_found")
    none = F.array().cast(MATCHES)
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select(F.col("item_id").cast("long"), "text").collect()
        if own:
            shared = context.broadcast(Index([tuple(r) for r in own], radius, similarity))
            new = _matcher(shared)(F.col("text"))
            if blocks == 1:
                return docs.withColumn(column, new)
            before = F.col(so_far) if so_far in found.columns else none
            found = checkpointed(found.withColumn(so_far, F.concat(before, new)))
            shared.destroy()
    if so_far not in found.columns:
        return docs.withColumn(column, none)
    return found.withColumn(column, F.col(so_far)).drop(so_far)


def _matcher(shared):
    @F.pandas_udf(MATCHES)
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, codes = shared.value, WordCodes()
        for texts in batches:
            yield pd.Series([index.matches(codes.of(t)) for t in texts], dtype=object)

    # told to be non-deterministic, so that a filter on its result doesn't run it a second time
    return matched.asNondeterministic()
