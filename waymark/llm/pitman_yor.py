"""Language-model scoring by a hierarchical Pitman-Yor model with Gibbs-sampled seating.

Contexts are restaurants of the Chinese-restaurant franchise. Every pair of words
seen in training is one, whose customers are the words that follow; its parent is
the restaurant of the pair's second word, and the parent of those is the root, whose
base is uniform over the training words and one unknown word. Each table of a
restaurant is a customer of its parent. No context is left out.

Gibbs sampling reseats a dish's customers all at once: given the other dishes' tables
and the parent, the number of tables of ``c`` customers is drawn from its exact
conditional (generalised Stirling numbers), up to ``EXACT`` customers of one dish;
further ones are seated in blocks. Dishes are reseated side by side, so each sees the
others as the last sweep left them. Discounts come from the numbers of dishes with one
and two customers, strengths are sampled by auxiliary variables. After ``burn_in``
sweeps the predictive probabilities of the next ``kept`` ones are averaged; a text's
score is the sum of their logarithms.

Scale: a bucket holds all restaurants of some second words, so the two lower levels
are local to it, and gets about ``GRAIN`` tokens. Tokens are shuffled once, as packed
blocks of distinct triples with their documents, into a table bucketed by that key.
The root lives by word: a round sends each bucket's customers to the buckets of words
and gets back what is seated there. A second word that fills more than half a bucket
is dealt out by the word before it, and its own dishes are seated by word as the
root's are. A pair that makes up a sixteenth of a block of such a word has a
restaurant for that block, so that no pair's tokens meet in one task. Score sums go
back as one packed row for a bucket and a block of documents.

Defined results: a null text is empty; an empty text is its end token; repeated rows
score alike and each gives a row; null ids are learnt from and scored like others; an
empty table gives no rows; without training texts every token is unknown. Words are
told apart by 63-bit hashes.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import checkpoint_folder, checkpointed, text_slices
from waymark.llm.words import mix

END = np.int64(1)
GRAIN, BLOCK, EXACT = 1_000_000, 3_000_000, 128
#: words with short codes, and the least code of any other
_TOP, _FIRST = 1 << 19, 1 << 20
_MASK = (1 << 63) - 1
# a base score of 9e7, that of a text of ten million tokens, still fits its unit
_BASE_UNIT, _SCORE_UNIT = 1e-11, 1e-6


def _hashed(words: pa.Array) -> np.ndarray:
    """63-bit hashes of different words; END is no word's."""
    return np.fromiter((max(_FIRST, xxhash.xxh3_64_intdigest(w) & _MASK) for w in words.cast(pa.large_binary()).to_pylist()), dtype=np.int64, count=len(words))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of texts (null is empty; A-Z in lower case, cut at ASCII white space), the place of each token's word among them, and tokens by text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    coded = lists.flatten().dictionary_encode()
    turn, ends = coded.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    said = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    if not said.all():
        # white space at a text's begin or end leaves an empty word there
        kept = said[turn]
        ends = np.append(0, np.cumsum(kept))[ends]
        turn = (np.cumsum(said) - 1)[turn[kept]]
    return coded.dictionary.filter(pa.array(said)), turn, np.diff(ends)


def codes_of(texts: pa.Array, layout: Layout | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts' words and ends, one after the other, and how many each text has."""
    words, turn, n = split_words(texts)
    codes = _hashed(words)
    if layout is not None and len(layout.top):
        at = np.minimum(np.searchsorted(layout.top, codes), len(layout.top) - 1)
        codes = np.where(layout.top[at] == codes, layout.place[at], codes)
    out = np.full(len(turn) + len(n), END, dtype=np.int64)
    out[np.arange(len(turn)) + np.repeat(np.arange(len(n)), n)] = codes[turn]
    return out, n + 1


def _bundle(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte planes of each apart."""
    out = []
    for x in arrays:
        planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T).tobytes()
        data = zstandard.compress(x.dtype.char.encode() + planes, 1)
        out += [struct.pack("<I", len(data)), data]
    return b"".join(out)


def _unbundle(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        (n,) = struct.unpack_from("<I", data, at)
        raw = zstandard.decompress(data[at + 4 : at + 4 + n])
        kind = np.dtype(raw[:1].decode())
        planes = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(kind.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 4 + n
    return out


def _deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


@dataclass
class Layout:
    """How tokens are dealt: buckets, and the codes (sorted) of words that fill more than half a bucket, with their parts.

    ``top`` holds the hashes (sorted) of the most frequent words, at most ``_TOP``, and
    ``place`` their codes by frequency.
    """

    buckets: int
    hot: np.ndarray
    parts: np.ndarray
    top: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    place: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))

    def rank(self, codes: np.ndarray) -> np.ndarray:
        """Place among the hot words, -1 for others."""
        if not len(self.hot):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.hot, codes), len(self.hot) - 1)
        return np.where(self.hot[at] == codes, at, -1)


def _layout(docs: DataFrame, grain: int) -> Layout:
    """Count words; those seen once by a task count there as none, which moves no frequent word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 0):
            words, turn, n = split_words(batch.column(0))
            count = np.bincount(turn, minlength=len(words))
            often = np.flatnonzero(count > 1)
            word = np.concatenate([_hashed(words.take(pa.array(often))), [END, 0]])
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.concatenate([count[often], [len(n), len(turn) + len(n)]]))], names=["word", "n"])

    counts = docs.select("text").mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.col("word") != 0, F.desc("n"), "word").limit(_TOP + 1).collect()
    tokens = rows[0]["n"] if rows else 0
    word, n = (np.array([r[x] for r in rows[1:]], dtype=np.int64) for x in ("word", "n"))
    place = np.where(word == END, END, np.arange(2, len(word) + 2)).astype(np.int32)
    wide, order = np.flatnonzero(n > grain // 2), np.argsort(word)
    wide = wide[np.argsort(place[wide])]
    return Layout(max(1, round(tokens / grain)), place[wide].astype(np.int64), 1 + 4 * n[wide] // grain, word[order], place[order])


def _block(held: list[tuple[np.ndarray, ...]], number: int, layout: Layout) -> Iterator[tuple]:
    """(bucket, block, data) rows of some documents (ids, nulls, learn, lengths, codes, in parts): their triples by bucket, and themselves below 0; takes them out of ``held``."""
    ids, nulls, learn, lengths, said = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    yield -1 - number % layout.buckets, number, _bundle(ids, nulls, lengths.astype(np.int32))
    codes = np.unique(said)
    third = np.searchsorted(codes, said).astype(np.int32)
    del said
    end = int(np.searchsorted(codes, END))
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
    first = np.cumsum(lengths) - lengths
    second, one = np.roll(third, 1), np.roll(third, 2)
    second[first] = one[first] = end
    one[first[lengths > 1] + 1] = end
    rank = layout.rank(codes)
    of_code = mix(codes.astype(np.uint64))
    part = np.zeros(len(third), dtype=np.uint64)
    spread = rank[second] >= 0
    if spread.any():
        at = np.flatnonzero(spread)
        part[at] = mix(of_code[one[at]]) % layout.parts[rank[second[at]]].astype(np.uint64)
        pair, turn, n = np.unique(second[at].astype(np.int64) * len(codes) + one[at], return_inverse=True, return_counts=True)
        wide = np.flatnonzero(n > len(third) // 16)
        for i, p in enumerate(wide):
            # a restaurant of this pair for this block alone
            own = at[turn == p]
            salt = mix(np.array([number * 16 + i], dtype=np.uint64))
            part[own] = salt % np.uint64(1 << 20)
            codes = np.append(codes, np.int64(salt[0] & np.uint64(_MASK)))
            one[own] = len(codes) - 1
    bucket = (mix(of_code[second] + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(layout.buckets)).astype(np.int32)
    size = len(codes)
    by_bucket = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[by_bucket], np.arange(layout.buckets + 1))
    place = np.zeros(size, dtype=np.int64)
    code_order = np.argsort(codes, kind="stable")
    rise = np.empty(size, dtype=np.int64)
    rise[code_order] = np.arange(size)
    for b in range(layout.buckets):
        at = by_bucket[starts[b] : starts[b + 1]]
        if not len(at):
            continue
        j, k, i, d = second[at], one[at], third[at], doc[at]
        # local places follow the order of codes, as they do in every other block
        used = np.unique(np.concatenate([j, k, i]))
        used = used[np.argsort(rise[used])]
        place[used] = np.arange(len(used))
        j, k, i = place[j], place[k], place[i]
        if len(used) < 1 << 21:
            key = (j * len(used) + k) * len(used) + i
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort((i, k, j))
        j, k, i, d = j[order], k[order], i[order], d[order]
        new = np.ones(len(j), dtype=bool)
        new[1:] = (j[1:] != j[:-1]) | (k[1:] != k[:-1]) | (i[1:] != i[:-1])
        apart = new.copy()
        apart[1:] |= d[1:] != d[:-1]
        pair_at, triple_at = np.flatnonzero(apart), np.flatnonzero(new)
        n = np.diff(np.append(pair_at, len(j)))
        run = np.diff(np.append(np.searchsorted(pair_at, triple_at), len(pair_at)))
        taught = np.add.reduceat(learn[d], triple_at)
        yield b, number, _bundle(
            _deltas(codes[used]), *(_deltas(x[triple_at]).astype(np.int32) for x in (j, k)), i[triple_at].astype(np.int32), taught.astype(np.int32), run.astype(np.int32), d[pair_at].astype(np.int32), n.astype(np.int32)
        )


def _gathered(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """One row of a bucket: the model's triples with training counts, and each block's occurrences; rows of documents stay."""
    columns = ["bucket", "block", "model", "blocks", "pieces"]
    if key[0] < 0:
        return pd.DataFrame({"bucket": frame["bucket"], "block": frame["block"], "model": frame["data"], "blocks": [[]] * len(frame), "pieces": [[]] * len(frame)}, columns=columns)
    frame = frame.sort_values("block")
    parts = [_unbundle(x) for x in frame["data"]]
    local = [np.cumsum(p[0]) for p in parts]
    words = np.unique(np.concatenate(local))
    at = [np.searchsorted(words, x) for x in local]
    j = np.concatenate([a[np.cumsum(p[1])] for a, p in zip(at, parts, strict=True)])
    k = np.concatenate([a[np.cumsum(p[2])] for a, p in zip(at, parts, strict=True)])
    i = np.concatenate([a[p[3]] for a, p in zip(at, parts, strict=True)])
    pairs, pair = np.unique(j * len(words) + k, return_inverse=True)
    triples, turn = np.unique(pair * len(words) + i, return_inverse=True)
    taught = np.bincount(turn, weights=np.concatenate([p[4] for p in parts]), minlength=len(triples)).astype(np.int64)
    of_pair = triples // len(words)
    model = _bundle(_deltas(words), _deltas(pairs // len(words)).astype(np.int32), (pairs % len(words)).astype(np.int32), _deltas(of_pair).astype(np.int32), (triples % len(words)).astype(np.int32), taught)
    pieces, done = [], 0
    for p in parts:
        pieces.append(_bundle(_deltas(turn[done : done + len(p[1])]).astype(np.int32), *p[5:]))
        done += len(p[1])
    return pd.DataFrame([(int(key[0]), None, model, frame["block"].tolist(), pieces)], columns=columns)


def stirling(discount: float, n: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: weights of ``t`` tables for ``c`` customers, at [c, t]."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(n + 1)
    for c in range(n):
        stay = np.full(n + 1, -np.inf)
        stay[1 : c + 1] = out[c, 1 : c + 1] + np.log(c - discount * t[1 : c + 1])
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay[1:])
    return out


def draw_tables(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, strength: float, discount: float, numbers: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Tables of each dish given the tables of the restaurant's other dishes and the parent's probability of the dish.

    Exact up to ``EXACT`` customers. Further ones are seated in blocks of a sixteenth of
    those who sit, with one chance for a block.
    """
    tables = (customers > 0).astype(np.int64)
    order = np.flatnonzero(customers > 1)
    order = order[np.argsort(customers[order], kind="stable")]
    exact = np.minimum(customers[order], EXACT)
    log_parent = np.log(parent[order])
    bounds = np.searchsorted(exact, np.arange(2, EXACT + 2))
    for c, (a, z) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), 2):
        step = max(1, 2_000_000 // c)
        for lo in range(a, z, step):
            hi = min(z, lo + step)
            seats = np.log(strength + discount * (others[order[lo:hi], None] + np.arange(c)))
            weight = np.cumsum(seats + log_parent[lo:hi, None], axis=1) + numbers[c, 1 : c + 1]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[order[lo:hi]] = 1 + (weight < random.random(hi - lo)[:, None] * weight[:, -1:]).sum(axis=1)
    more = order[np.searchsorted(exact, EXACT) :]
    more = more[customers[more] > EXACT]
    at = np.full(len(more), EXACT)
    while len(more):
        block = np.minimum(np.maximum(1, at // 16), customers[more] - at)
        rate = (strength + discount * (others[more] + tables[more])) * parent[more]
        stay = at + block / 2 - discount * tables[more]
        tables[more] += random.binomial(block, rate / (rate + stay))
        at = at + block
        on = at < customers[more]
        more, at = more[on], at[on]
    return tables


@dataclass
class Model:
    """What all buckets know: the layout, totals, discounts and strengths by level (root, word, pair), and totals of hot words' restaurants."""

    layout: Layout
    seed: int = 11
    tokens: int = 0
    words: int = 0
    root: tuple[int, int] = (0, 0)
    discount: list[float] = field(default_factory=lambda: [0.8, 0.8, 0.8])
    strength: list[float] = field(default_factory=lambda: [1.0, 1.0, 1.0])
    hot: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))

    def root_probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        fresh = (self.strength[0] + self.discount[0] * self.root[1]) / (self.words + 1)
        return (np.maximum(customers - self.discount[0] * tables, 0) + fresh) / (self.strength[0] + self.root[0])


class Bucket:
    """The restaurants of some second words, and of all their pairs."""

    def __init__(self, number: int, data: bytes, layout: Layout):
        words, j, self.k, pair, self.word, self.taught = _unbundle(data)
        self.number, self.layout = number, layout
        self.words, j, self.pair = np.cumsum(words), np.cumsum(j), np.cumsum(pair)
        size = len(self.words)
        self.said = np.unique(self.word)
        self.word_taught = np.bincount(self.word, weights=self.taught, minlength=size).astype(np.int64)
        # dishes of the second words' restaurants
        dishes, self.dish = np.unique(j[self.pair].astype(np.int64) * size + self.word, return_inverse=True)
        self.dish_second, self.dish_word = dishes // size, dishes % size
        rank = layout.rank(self.words)[self.dish_second]
        self.is_hot, self.rank = rank >= 0, rank
        # each word's bucket at the root, and words in the order in which they are sent
        at = (mix(self.words[self.said].astype(np.uint64)) % np.uint64(layout.buckets)).astype(np.int64)
        self.sent = np.argsort(at, kind="stable")
        self.sent_bounds = np.searchsorted(at[self.sent], np.arange(layout.buckets + 1))
        self.hot_dish = np.flatnonzero(self.is_hot)
        turn = np.empty(size, dtype=np.int64)
        turn[self.said[self.sent]] = np.arange(len(self.said))
        self.hot_dish = self.hot_dish[np.lexsort((self.dish_second[self.hot_dish], turn[self.dish_word[self.hot_dish]]))]
        self.hot_turn = turn[self.dish_word[self.hot_dish]]
        self.hot_bounds = np.searchsorted(self.hot_turn, self.sent_bounds)

    def start(self) -> None:
        """A table for each dish."""
        self.t3 = np.minimum(self.taught, 1)
        self.c2 = np.bincount(self.dish, weights=self.t3, minlength=len(self.dish_word)).astype(np.int64)
        self.t2 = np.minimum(self.c2, 1)

    def messages(self) -> Iterator[tuple[int, bytes]]:
        """What each bucket of words gets: codes, training counts and customers of words, and customers of hot words' dishes."""
        own = np.bincount(self.dish_word[~self.is_hot], weights=self.t2[~self.is_hot], minlength=len(self.words)).astype(np.int64)
        for q, (a, z, b, y) in enumerate(zip(self.sent_bounds[:-1], self.sent_bounds[1:], self.hot_bounds[:-1], self.hot_bounds[1:], strict=True)):
            if z > a:
                word = self.said[self.sent[a:z]]
                dish = self.hot_dish[b:y]
                yield q, _bundle(_deltas(self.words[word]), self.word_taught[word].astype(np.int32), own[word].astype(np.int32), (self.hot_turn[b:y] - a).astype(np.int32), self.rank[dish].astype(np.int32), self.c2[dish].astype(np.int32))

    def seen(self) -> tuple[float, ...]:
        """Numbers of dishes with one and two customers, of pairs' and of words' restaurants."""
        return (self.taught == 1).sum(), (self.taught == 2).sum(), (self.c2 == 1).sum(), (self.c2 == 2).sum()

    def receive(self, answers: list[tuple[int, bytes]], model: Model) -> None:
        """Take the root's state of the words, and that of hot words' dishes."""
        size = len(self.words)
        self.count, customers, tables = np.zeros((3, size), dtype=np.int64)
        hot_c, hot_t = np.zeros((2, len(self.dish_word)))
        for q, data in answers:
            count, c, t, hc, ht = _unbundle(data)
            word = self.said[self.sent[self.sent_bounds[q] : self.sent_bounds[q + 1]]]
            self.count[word], customers[word], tables[word] = count, c, t
            dish = self.hot_dish[self.hot_bounds[q] : self.hot_bounds[q + 1]]
            hot_c[dish], hot_t[dish] = hc, ht
        self.root = model.root_probability(customers, tables)
        d, s = model.discount[1], model.strength[1]
        at = self.rank[self.hot_dish]
        c_all, t_all = model.hot[:, at]
        self.hot_probability = (np.maximum(hot_c[self.hot_dish] - d * hot_t[self.hot_dish], 0) + (s + d * t_all) * self.root[self.dish_word[self.hot_dish]]) / (s + c_all)

    def _totals(self) -> tuple[np.ndarray, ...]:
        pairs, size = len(self.k), len(self.words)
        return (
            np.bincount(self.pair, weights=self.taught, minlength=pairs), np.bincount(self.pair, weights=self.t3, minlength=pairs),
            np.bincount(self.dish_second, weights=self.c2, minlength=size), np.bincount(self.dish_second, weights=self.t2, minlength=size),
        )

    def _second(self, model: Model, c2: np.ndarray, t2: np.ndarray, at: np.ndarray, c_all: np.ndarray, t_all: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Probability of dishes ``at`` in the second words' restaurants."""
        d, s = model.discount[1], model.strength[1]
        j = self.dish_second[at]
        p = (np.maximum(c2 - d * t2, 0) + (s + d * t_all[j]) * self.root[self.dish_word[at]]) / (s + c_all[j])
        return np.where(self.is_hot[at], hot[at], p)

    def sweep(self, model: Model, numbers: list[np.ndarray], random: np.random.Generator) -> None:
        """Reseat all dishes of the pairs' and then of the second words' restaurants."""
        _, t_pair, c_all, t_all = self._totals()
        hot = np.zeros(len(self.dish_word))
        hot[self.hot_dish] = self.hot_probability
        live = np.flatnonzero(self.taught > 1)
        at = self.dish[live]
        # the parent as it is with one customer from this dish, as the first table is there anyway
        c2 = self.c2[at] - (self.t3[live] - 1)
        parent = self._second(model, c2, np.minimum(self.t2[at], c2), at, c_all, t_all, hot)
        self.t3[live] = draw_tables(self.taught[live], t_pair[self.pair[live]] - self.t3[live], parent, model.strength[2], model.discount[2], numbers[2], random)
        self.c2 = np.bincount(self.dish, weights=self.t3, minlength=len(self.dish_word)).astype(np.int64)
        self.t2 = np.minimum(self.t2, self.c2)
        own = np.flatnonzero(~self.is_hot & (self.c2 > 0))
        others = t_all[self.dish_second[own]] - self.t2[own]
        self.t2[own] = draw_tables(self.c2[own], others, self.root[self.dish_word[own]], model.strength[1], model.discount[1], numbers[1], random)

    def auxiliary(self, model: Model, random: np.random.Generator) -> list[float]:
        """Sums of the auxiliary variables of the strengths of words' and pairs' restaurants."""
        c_pair, t_pair, c_all, t_all = self._totals()
        out = []
        for level, c, t in ((1, c_all, t_all), (2, c_pair, t_pair)):
            d, s = model.discount[level], model.strength[level]
            c, t = c[c > 1], t[c > 1].astype(np.int64)
            logs = np.log(random.beta(s + 1, c - 1)).sum() if len(c) else 0.0
            above = len(t) - np.cumsum(np.bincount(t)) if len(t) else np.zeros(0, dtype=np.int64)
            i = np.arange(1, len(above))
            out += [logs, random.binomial(above[1:], s / (s + d * i)).sum() if len(i) else 0]
        return out

    def probability(self, model: Model) -> np.ndarray:
        """Predictive probability of each triple."""
        c_pair, t_pair, c_all, t_all = self._totals()
        hot = np.zeros(len(self.dish_word))
        hot[self.hot_dish] = self.hot_probability
        parent = self._second(model, self.c2, self.t2, np.arange(len(self.dish_word)), c_all, t_all, hot)[self.dish]
        d, s = model.discount[2], model.strength[2]
        return (np.maximum(self.taught - d * self.t3, 0) + (s + d * t_pair[self.pair]) * parent) / (s + c_pair[self.pair])


def _seat(shared, turn: int):
    """Seats the customers of a bucket of words, and those of hot words' dishes; answers every sender."""
    columns = ["kind", "bucket", "q", "data", "a", "b", "c", "d"]

    def seat(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        q = int(key[0])
        if q < 0:
            return pd.DataFrame([("seen", 0, 0, None, *map(float, np.sum(list(frame["sums"]), axis=0)))], columns=columns)
        frame = frame.sort_values("bucket")
        parts = [_unbundle(x) for x in frame["data"]]
        codes, word = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
        size = len(codes)
        taught, customers = (np.bincount(word, weights=np.concatenate([p[c] for p in parts]), minlength=size).astype(np.int64) for c in (1, 2))
        start = np.cumsum([0, *[len(p[0]) for p in parts]])
        hot_word = word[np.concatenate([p[3] + s for p, s in zip(parts, start, strict=False)]).astype(np.int64)]
        hots = len(model.layout.hot)
        dishes, dish = np.unique(np.concatenate([p[4] for p in parts]) * np.int64(size) + hot_word, return_inverse=True)
        of_word, of_hot = dishes % size, dishes // size
        hot_c = np.bincount(dish, weights=np.concatenate([p[5] for p in parts]), minlength=len(dishes)).astype(np.int64)
        hot_t = np.minimum(hot_c, 1)
        whole = customers + np.bincount(of_word, weights=hot_t, minlength=size).astype(np.int64)
        tables = np.minimum(whole, 1)
        if turn:
            random = np.random.default_rng([model.seed, turn, 1, q])
            numbers = [stirling(model.discount[x]) for x in (0, 1)]
            for _ in range(2):
                root = model.root_probability(whole, tables)
                others = np.maximum(model.hot[1][of_hot] - hot_t, 0) if hots else np.zeros(0)
                hot_t = draw_tables(hot_c, others, root[of_word], model.strength[1], model.discount[1], numbers[1], random)
                whole = customers + np.bincount(of_word, weights=hot_t, minlength=size).astype(np.int64)
                others = np.maximum(model.root[1] - tables, 0)
                tables = draw_tables(whole, others, np.full(size, 1.0 / (model.words + 1)), model.strength[0], model.discount[0], numbers[0], random)
        rows, done = [], 0
        for p, s, b in zip(parts, start, frame["bucket"], strict=False):
            w, h = word[s : s + len(p[0])], dish[done : done + len(p[4])]
            done += len(p[4])
            rows.append(("answer", int(b), q, _bundle(*(x.astype(np.int32) if x.max(initial=0) < 2**31 else x for x in (taught[w], whole[w], tables[w], hot_c[h], hot_t[h]))), 0.0, 0.0, 0.0, 0.0))
        rows.append(("total", 0, 0, None, float(taught.sum()), float((taught > 0).sum()), float(whole.sum()), float(tables.sum())))
        rows.append(("words", 0, 0, None, float((whole == 1).sum()), float((whole == 2).sum()), 0.0, 0.0))
        by_hot = np.bincount(of_hot, weights=hot_c, minlength=hots), np.bincount(of_hot, weights=hot_t, minlength=hots)
        rows += [("hot", h, 0, None, float(c), float(t), 0.0, 0.0) for h, (c, t) in enumerate(zip(*by_hot, strict=True)) if c]
        return pd.DataFrame(rows, columns=columns)

    return seat


def _round(table: DataFrame, answers: DataFrame | None, model: Model, turn: int, sweeps: int) -> DataFrame:
    """Sweeps over all buckets and the root's part of it; adds totals to the model and returns the answers (bucket, answers)."""
    context = table.sparkSession.sparkContext
    shared = context.broadcast(model)

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            for r in batch.itertuples():
                bucket = Bucket(r.bucket, r.model, model.layout)
                bucket.start()
                random = np.random.default_rng([model.seed, turn, 0, r.bucket])
                if turn:
                    _swept(bucket, r.answers, model, sweeps, random)
                sums = [float(x) for x in (bucket.auxiliary(model, random) if turn else bucket.seen())]
                out = [(q, r.bucket, data, []) for q, data in bucket.messages()]
                yield pd.DataFrame([*out, (-1, r.bucket, None, sums)], columns=["q", "bucket", "data", "sums"])

    rows = table.where("bucket >= 0").select("bucket", "model")
    if answers is not None:
        rows = rows.join(answers, "bucket")
    told = rows.mapInPandas(sent, "q int, bucket int, data binary, sums array<double>")
    schema = "kind string, bucket int, q int, data binary, a double, b double, c double, d double"
    seated = checkpointed(told.groupBy("q").applyInPandas(_seat(shared, turn), schema))
    sums = {(r["kind"], r["bucket"]): [r[x] for x in "abcd"] for r in seated.where("kind <> 'answer'").groupBy("kind", "bucket").agg(*[F.sum(x).alias(x) for x in "abcd"]).collect()}
    total = sums.get(("total", 0), [0.0] * 4)
    model.tokens, model.words, model.root = int(total[0]), int(total[1]), (int(total[2]), int(total[3]))
    hots = len(model.layout.hot)
    model.hot = np.array([sums.get(("hot", h), [0.0] * 4)[:2] for h in range(hots)], dtype=float).reshape(hots, 2).T
    seen = sums.get(("seen", 0), [0.0] * 4)
    if turn == 0:
        ones = sums.get(("words", 0), [0.0] * 4)[:2], seen[2:], seen[:2]
        model.discount = [min(0.95, max(0.1, a / max(1.0, a + 2 * b))) for a, b in ones]
    else:
        random = np.random.default_rng([model.seed, turn, 2])
        for level, (logs, chosen) in ((1, seen[:2]), (2, seen[2:])):
            model.strength[level] = float(max(0.01, random.gamma(1 + chosen, 1 / (1 - logs))))
    found = seated.where("kind = 'answer'").groupBy("bucket").agg(F.collect_list(F.struct("q", "data")).alias("answers"))
    return found


def _swept(bucket: Bucket, answers: list, model: Model, sweeps: int, random: np.random.Generator) -> list[np.ndarray]:
    numbers = [stirling(d) for d in model.discount]
    bucket.receive([(a["q"], a["data"]) for a in answers], model)
    for _ in range(sweeps):
        bucket.sweep(model, numbers, random)
    return numbers


def score_texts(docs: DataFrame, learn: str = "learn", burn_in: int = 4, kept: int = 4, rounds: int = 1, grain: int = GRAIN) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text, and a boolean column ``learn`` that marks the training rows).

    Columns: doc_id, n_tokens, n_known, train_tokens, base_score (add-one unigrams), score
    (the model's log10 probability of the text). After the first seating, ``rounds``
    times ``burn_in`` sweeps are followed by reseating the root; then come ``burn_in``
    sweeps and the ``kept`` ones that are averaged.
    """
    session = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().cast("int").alias("gone"), F.coalesce(learn, F.lit(False)).cast("int").alias("learn"), "text")
    layout = _layout(rows, grain)
    shared = session.sparkContext.broadcast(layout)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in text_slices(batches, 3):
            codes, lengths = codes_of(batch.column(3), shared.value)
            ids, nulls, learn = (batch.column(i).to_numpy().astype(kind) for i, kind in enumerate((np.int64, np.uint8, np.int64)))
            ends = np.cumsum(lengths)
            a = 0
            while a < len(ids):
                before = ends[a] - lengths[a]
                z = max(a + 1, int(np.searchsorted(ends, before + BLOCK - size, side="right")))
                held.append((ids[a:z], nulls[a:z], learn[a:z], lengths[a:z], codes[before : ends[z - 1]]))
                size += int(ends[z - 1] - before)
                a = z
                if size >= BLOCK or a < len(ids):
                    yield _rows(_block(held, number, shared.value))
                    number, held, size = number + 1, [], 0
        if held:
            yield _rows(_block(held, number, shared.value))

    def _rows(found: Iterator[tuple]) -> pa.RecordBatch:
        bucket, block, data = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(block, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "block", "data"])

    blocks = rows.mapInArrow(cut, "bucket int, block long, data binary").repartition(layout.buckets, "bucket")
    gathered = blocks.groupBy("bucket").applyInPandas(_gathered, "bucket int, block long, model binary, blocks array<long>, pieces array<binary>")
    name = f"waymark_lm_{uuid.uuid4().hex}"
    gathered.write.bucketBy(layout.buckets, "bucket").option("path", f"{checkpoint_folder(session)}/{name}").saveAsTable(name)
    table = session.table(name)
    model = Model(layout)
    answers = _round(table, None, model, 0, 0)
    for turn in range(1, rounds + 1):
        answers = _round(table, answers, model, turn, burn_in)
    final = session.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = final.value
        for batch in batches:
            for r in batch.itertuples():
                if r.bucket < 0:
                    yield pd.DataFrame({"block": [int(r.block)], "head": [True], "data": [r.model]})
                    continue
                bucket = Bucket(r.bucket, r.model, model.layout)
                bucket.start()
                random = np.random.default_rng([model.seed, rounds + 1, 0, r.bucket])
                numbers = _swept(bucket, r.answers, model, burn_in, random)
                total = np.zeros(len(bucket.taught))
                for _ in range(kept):
                    bucket.sweep(model, numbers, random)
                    total += bucket.probability(model)
                count = bucket.count[bucket.word]
                logs, base = np.log10(total / kept), np.log10((count + 1) / (model.tokens + model.words + 1))
                out = []
                for block, piece in zip(r.blocks, r.pieces, strict=True):
                    triple, run, doc, n = _unbundle(piece)
                    triple = np.repeat(np.cumsum(triple), run)
                    used, at = np.unique(doc, return_inverse=True)
                    sums = [np.bincount(at, weights=n * x[triple], minlength=len(used)) for x in (count > 0, base / _BASE_UNIT, logs / _SCORE_UNIT)]
                    out.append((int(block), False, _bundle(_deltas(used).astype(np.int32), sums[0].astype(np.int32), *(np.rint(-x).astype(np.int64) for x in sums[1:]))))
                yield pd.DataFrame(out, columns=["block", "head", "data"])

    tokens = model.tokens

    def summed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        heads = frame["head"].to_numpy(dtype=bool)
        ids, nulls, lengths = _unbundle(frame["data"][heads].iloc[0])
        sums = np.zeros((3, len(ids)), dtype=np.int64)
        for data in frame["data"][~heads]:
            used, *parts = _unbundle(data)
            used = np.cumsum(used)
            for i, x in enumerate(parts):
                sums[i, used] += x
        found = pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "n_tokens": lengths.astype(np.int64), "n_known": sums[0], "train_tokens": tokens, "base_score": -sums[1] * _BASE_UNIT, "score": -sums[2] * _SCORE_UNIT})
        found["doc_id"] = found["doc_id"].mask(nulls > 0)
        return found

    parts = table.join(answers, "bucket", "left").mapInPandas(scored, "block long, head boolean, data binary")
    scores = parts.groupBy("block").applyInPandas(summed, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    scores = checkpointed(scores)
    session.sql(f"DROP TABLE {name}")
    return scores
