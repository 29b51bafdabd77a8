import math
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa

from waymark.llm.common import table
from waymark.llm.pitman_yor import END, Bucket, Layout, Model, _block, _bundle, _gathered, _seat, _swept, _unbundle, codes_of, draw_tables, score_texts, stirling
from waymark.llm.queries import op6_lm_score

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def check(rows, docs, learn):
    count = Counter(t for d, x in docs if learn(d) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    assert len(rows) == len(docs)
    want = sorted((d is None, d or 0, len(tokens(x)), sum(count[t] > 0 for t in tokens(x)), round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(x)), 5)) for d, x in docs)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(abs(g[4] - w[4]) < 3e-5 for g, w in zip(got, want, strict=True))
    assert {r.train_tokens for r in rows} == {n}


def test_base_by_brute_force_and_better_on_held_out(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = op6_lm_score(spark, SF).collect()
    check(rows, docs, lambda d: zlib.crc32(str(d).encode()) % 7 != 2)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held)


def test_buckets_and_frequent_words_change_little(spark):
    """Many small buckets, with words dealt out and pairs cut by block, against one bucket."""
    docs = table(spark, SF, "documents").selectExpr("doc_id", "text", "doc_id % 7 <> 2 as learn")
    hot = spark.range(300).selectExpr("1000000 + id as doc_id", "repeat('same pair ', 60) || 'x' || id as text", "true as learn")
    docs = docs.unionByName(hot)
    one, many = score_texts(docs).collect(), score_texts(docs, grain=4000).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for got in (one, many):
        check(got, rows, lambda d: d >= 1000000 or d % 7 != 2)
    a, b = (sum(r.score for r in got if r.doc_id % 7 == 2) for got in (one, many))
    assert abs(a / b - 1) < 0.03


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "A b\u00a0c\x1cd a\tÀ"), (3, "A b\u00a0c\x1cd a\tÀ"), (None, "a b"), (None, "a b"), (4, "zz " * 3000)]
    df = spark.createDataFrame([(*d, d[0] != 4, 7) for d in docs], "doc_id long, text string, learn boolean, block int")
    rows = score_texts(df).collect()
    check(rows, docs, lambda d: d != 4)
    assert all(math.isfinite(r.score) for r in rows)
    assert len({(r.doc_id, r.score) for r in rows}) == 5
    none = df.selectExpr("doc_id", "text", "false as learn")
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in score_texts(none).collect())
    assert score_texts(df.limit(0)).count() == 0


def test_codes_follow_the_contract():
    texts = ["a\x1cb \x0b c\u00a0d", " ÀB\tÀb", None, "", "àb \x0c", "\r\n"]
    codes, n = codes_of(pa.array(texts))
    assert n.tolist() == [len(tokens(t)) for t in texts] == [3, 3, 1, 1, 2, 1]
    parts = np.split(codes, np.cumsum(n)[:-1])
    assert all(p[-1] == END and (p[:-1] != END).all() for p in parts)
    assert parts[1][0] == parts[1][1] != parts[4][0]
    sliced, m = codes_of(pa.array(texts)[1:3])
    assert m.tolist() == [3, 1] and (sliced == codes[3:7]).all()


def test_bundle():
    arrays = [np.arange(9, dtype=np.int32), np.zeros(0, dtype=np.int64), np.array([-1, 2**60])]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, _unbundle(_bundle(*arrays)), strict=True))


def seatings(n):
    """All seatings of n customers as tuples of table sizes, with repeats for the ways to get them."""
    def step(sizes, left):
        if not left:
            yield sizes
            return
        for i in range(len(sizes)):
            yield from step((*sizes[:i], sizes[i] + 1, *sizes[i + 1 :]), left - 1)
        yield from step((*sizes, 1), left - 1)

    return step((1,), n - 1)


def test_tables_by_enumeration():
    strength, discount, parent, others = 0.7, 0.6, 0.2, 3
    draw = np.random.default_rng(3)
    numbers = stirling(discount)
    for c in (2, 5, 8):
        weight = Counter()
        for sizes in seatings(c):
            w = 1.0
            for k, n in enumerate(sizes):
                w *= (strength + discount * (others + k)) * parent * math.prod(i - discount for i in range(1, n))
            weight[len(sizes)] += w
        want = np.array([weight[t] for t in range(1, c + 1)]) / sum(weight.values())
        got = draw_tables(np.full(40_000, c), np.full(40_000, others), np.full(40_000, parent), strength, discount, numbers, draw)
        seen = np.bincount(got, minlength=c + 1)[1:] / 40_000
        assert np.abs(seen - want).max() < 0.012
    many = draw_tables(np.full(2000, 1000), np.full(2000, others), np.full(2000, parent), strength, discount, numbers, draw)
    few = draw_tables(np.full(2000, 128), np.full(2000, others), np.full(2000, parent), strength, discount, numbers, draw)
    assert few.mean() < many.mean() < few.mean() * (1000 / 128) ** 0.8


DISCOUNT, STRENGTH = [0.5, 0.6, 0.7], [1.0, 0.8, 0.6]


def plain_gibbs(train, test, sweeps, burn):
    """One customer after the other is taken away and seated again, given all others; mean log10 probability of the test tokens."""
    r = random.Random(5)
    v = len({w for s in train for w in s})
    tables = defaultdict(lambda: defaultdict(list))  # context -> word -> sizes
    total = defaultdict(lambda: [0, 0])

    def p(context, w):
        if context is None:
            return 1 / (v + 1)
        level = len(context)
        up = p(context[1:] if level else None, w)
        c, t = total[context]
        sizes = tables[context][w] if context in tables else []
        d, s = DISCOUNT[level], STRENGTH[level]
        return (sum(sizes) - d * len(sizes) + (s + d * t) * up) / (s + c)

    def add(context, w):
        if context is None:
            return
        level = len(context)
        d, s = DISCOUNT[level], STRENGTH[level]
        up = context[1:] if level else None
        sizes = tables[context][w]
        weights = [n - d for n in sizes] + [(s + d * total[context][1]) * p(up, w)]
        at = r.choices(range(len(weights)), weights)[0]
        total[context][0] += 1
        if at == len(sizes):
            sizes.append(1)
            total[context][1] += 1
            add(up, w)
        else:
            sizes[at] += 1

    def remove(context, w):
        if context is None:
            return
        sizes = tables[context][w]
        at = r.choices(range(len(sizes)), sizes)[0]
        sizes[at] -= 1
        total[context][0] -= 1
        if not sizes[at]:
            sizes.pop(at)
            total[context][1] -= 1
            remove(context[1:] if len(context) else None, w)

    def grams(s):
        padded = [1, 1, *s]
        return [((padded[i], padded[i + 1]), w) for i, w in enumerate(s)]

    data = [g for s in train for g in grams(s)]
    for g in data:
        add(*g)
    asked = [g for s in test for g in grams(s)]
    sums = np.zeros(len(asked))
    for sweep in range(sweeps):
        for g in data:
            remove(*g)
            add(*g)
        if sweep >= burn:
            sums += [p(*g) for g in asked]
    return np.log10(sums / (sweeps - burn)).mean()


def test_agrees_with_a_plain_sampler():
    r = random.Random(8)
    chain = {a: r.choices(range(2, 14), k=4) for a in range(1, 14)}

    def sentence():
        out, a = [], 1
        for _ in range(r.randrange(4, 15)):
            a = r.choice(chain[a]) if r.random() < 0.85 else r.randrange(2, 14)
            out.append(a)
        return [*out, 1]

    train, test = [sentence() for _ in range(60)], [sentence() for _ in range(20)]
    layout = Layout(1, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    every = [*train, *test]
    held = [(np.arange(len(every)), np.zeros(len(every), dtype=np.uint8), (np.arange(len(every)) < len(train)).astype(np.int64), np.array([len(x) for x in every]), np.concatenate(every).astype(np.int64))]
    frame = pd.DataFrame([x for x in _block(held, 0, layout) if x[0] == 0], columns=["bucket", "block", "data"])
    row = _gathered((0,), frame).iloc[0]
    model = Model(layout, discount=DISCOUNT, strength=STRENGTH)
    sums, kept = 0, 0
    for turn in range(8):
        bucket = Bucket(0, row["model"], layout)
        bucket.start()
        if turn:
            draw = np.random.default_rng(turn)
            numbers = _swept(bucket, [{"q": a.q, "data": a.data} for a in answers], model, 10, draw)
        if turn > 1:
            for _ in range(30):
                bucket.sweep(model, numbers, draw)
                sums, kept = sums + bucket.probability(model), kept + 1
        told = pd.DataFrame([(q, 0, data) for q, data in bucket.messages()], columns=["q", "bucket", "data"])
        seated = _seat(SimpleNamespace(value=model), turn)((0,), told)
        total = seated[seated["kind"] == "total"].iloc[0]
        model.tokens, model.words, model.root = int(total.a), int(total.b), (int(total.c), int(total.d))
        answers = list(seated[seated["kind"] == "answer"].itertuples())
    triple, run, doc, n = _unbundle(row["pieces"][0])
    triple = np.repeat(np.cumsum(triple), run)
    asked = doc >= len(train)
    got = (n * np.log10(sums / kept)[triple])[asked].sum() / n[asked].sum()
    want = plain_gibbs(train, test, 150, 40)
    assert abs(got - want) < 0.015


def test_base_scores_to_many_digits(spark):
    texts = ["a b c", None, "", "A B \x85 c", "x\x1cy \x1f z", "a " * 5000, "\x0b\x0ca\rb"]
    docs = spark.createDataFrame([(i, t, i != 3) for i, t in enumerate(texts)], "doc_id long, text string, learn boolean")
    said = [tokens(t) for t in texts]
    count = Counter(w for i, x in enumerate(said) if i != 3 for w in x)
    total = sum(count.values()) + len(count) + 1
    for r in score_texts(docs, rounds=0, burn_in=0, kept=1).collect():
        want = sum(math.log10((count[w] + 1) / total) for w in said[r.doc_id])
        assert abs(r.base_score - want) < 1e-10 * max(1, abs(want))
