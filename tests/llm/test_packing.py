import itertools
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm.packing import Cuts, pack
from waymark.llm.queries import op9_pack
from waymark.llm.tokens import encoder

SF = "/root/testdata/sf0.001"


def cost_of(cuts, at, fee, window):
    spans = list(zip(cuts, cuts[1:]))
    if any(at[b] - at[a] > window for a, b in spans):
        return float("inf")
    return sum(window - (at[b] - at[a]) + fee[b] for a, b in spans)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.sampled_from([0.0, 1.0, 4.0])), min_size=1, max_size=9))
def test_best_cuts_brute_force(steps):
    at = np.cumsum([0] + [s for s, _ in steps])
    fee = np.array([0.0] + [f for _, f in steps])
    n = len(at) - 1
    best = min(cost_of([0, *c, n], at, fee, 8) for k in range(n) for c in itertools.combinations(range(1, n), k))
    index = {int(x): i for i, x in enumerate(at)}
    cuts = Cuts(8)
    cuts.add(at[1:].tolist(), fee[1:].tolist())
    assert cost_of([index[x] for x in cuts.settled(ended=True)], at, fee, 8) == best


def test_stretches_lose_a_window_at_most():
    r = np.random.default_rng(4)
    for _ in range(40):
        at = np.cumsum(np.append(0, r.integers(1, 12, size=400)))
        fee = np.append(0, r.choice([0.0, 2.0, 8.0], size=400))
        index = {int(x): i for i, x in enumerate(at)}
        whole, parts, found, n = Cuts(40), Cuts(40), [0], 0
        whole.add(at[1:].tolist(), fee[1:].tolist())
        for i in range(1, 401, 80):
            parts.add(at[i : i + 80].tolist(), fee[i : i + 80].tolist())
            found, n = found + parts.settled()[1:], n + 1
        found += parts.settled(ended=True)[1:]
        best = cost_of([index[x] for x in whole.settled(ended=True)], at, fee, 40)
        assert best <= cost_of([index[x] for x in found], at, fee, 40) <= best + n * (40 + 8)


def test_encoder_equals_tokenizer():
    code = encoder()
    texts = ["", "Plain words, twice. Plain!", "it's O'Neil's 12.5% \t x\x1cy", "naïve ΣΑΣ İstanbul", "a<|endoftext|>b", "é ½ 漢字\n\n  z", "..., !?", "ǅ ß ﬁ"]
    for text, ids in zip(texts, code.encode(texts), strict=True):
        assert ids.tolist() == code.tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, texts, window):
    """Each id lies in exactly one piece; sequences are gapless and at most ``window`` long."""
    code, by_doc, by_sequence = encoder(), {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for k, text in texts.items():
        ids = np.array(code.tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for r in sorted(by_doc[k], key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert (r.ids_crc32 if "ids_crc32" in r else zlib.crc32(r.ids)) == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return 1 - sum(r.length for r in rows) / window / len(by_sequence)


def test_all_documents_little_padding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = op9_pack(spark, SF).collect()
    assert check(rows, {r.doc_id: r.text for r in docs.collect()}, 4096) < 0.05


def test_edge_cases(spark):
    texts = {1: None, 2: "", 3: "word " * 700, 4: "One. Two. " * 300, 5: "tiny"}
    df = spark.createDataFrame([(k, t, 1, 1) for k, t in texts.items()], "doc_id long, text string, ids int, start int").coalesce(1)
    check(pack(df, window=64).collect(), texts, 64)
    again = spark.createDataFrame([(None, "a"), (None, "a"), (7, "b"), (7, "b")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.length) for r in pack(again).collect()) == [(False, 2), (False, 2), (True, 2), (True, 2)]
    assert pack(df.limit(0)).count() == 0
