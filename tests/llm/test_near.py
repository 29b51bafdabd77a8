import random
from collections import Counter

import numpy as np

from waymark.llm.common import table
from waymark.llm.graph import components
from waymark.llm.near import bag, bag_min_hash, near_duplicates
from waymark.llm.queries import op2_near_dedup
from waymark.llm.words import WordCodes, weighted_jaccard

SF = "/root/testdata/sf0.001"


def brute(docs, least=0.8):
    """Class (set of positions) of each document (doc_id, text)."""
    codes = WordCodes()
    bags = [Counter(bag(codes, t).tolist()) for _, t in docs]
    owner = list(range(len(docs)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            same = docs[i][1] is not None and docs[i][1] == docs[j][1]
            both = sum((bags[i] & bags[j]).values())
            if same or both and both / sum((bags[i] | bags[j]).values()) >= least:
                owner[root(i)] = root(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(root(i), []).append(i)
    return sorted(map(sorted, groups.values()))


def test_signature_is_unbiased():
    r = np.random.default_rng(6)
    agreed = expected = 0.0
    for _ in range(40):
        items = r.integers(1, 2**63, size=60, dtype=np.uint64)
        a, b = r.integers(0, 12, size=60), r.integers(0, 12, size=60)
        b[:40] = a[:40]
        x = bag_min_hash(items[a > 0], a[a > 0], 256)
        y = bag_min_hash(items[b > 0], b[b > 0], 256)
        agreed += (x == y).mean()
        expected += weighted_jaccard(np.repeat(items, a), np.repeat(items, b))
    assert abs(agreed - expected) / 40 < 0.01


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)]
    owner = {x: x for e in edges for x in e}
    for _ in owner:
        for a, b in edges:
            owner[a] = owner[b] = min(owner[a], owner[b])
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in owner.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_query_brute_force(spark):
    docs = [(x.doc_id, x.text) for x in table(spark, SF, "documents").orderBy("doc_id").collect()]
    got = op2_near_dedup(spark, SF).collect()
    want = {docs[i][0]: docs[g[0]][0] for g in brute(docs) for i in g}
    assert {x.doc_id: x.class_id for x in got} == want and len(got) == len(docs)
    assert sum(x.is_first for x in got) == len(set(want.values()))


def test_large_mixed_groups(spark):
    """Groups far above the window, one of copies of copies, and unrelated texts from one template."""
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = []
    base = r.choices(vocabulary, k=120)
    for _ in range(60):
        words = list(base)
        words[r.randrange(120)] = r.choice(vocabulary)
        docs.append(" ".join(words))
    chain = r.choices(vocabulary, k=120)
    for _ in range(30):
        chain[r.randrange(120)] = r.choice(vocabulary)
        docs.append(" ".join(chain))
    template = r.choices(vocabulary, k=100)
    docs += [" ".join(template + r.choices(vocabulary, k=30)) for _ in range(60)]
    docs += ["same text here"] * 50 + ["", None, None, "a", "?!", "?!"]
    docs = [(i, t, 1, "x") for i, t in enumerate(docs)] + [(None, "same text here", 1, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, class_id int, node string")
    got = near_duplicates(df).collect()
    assert df.columns + ["_class_id", "class_size", "is_first"] == near_duplicates(df).columns
    want = {tuple(g) for g in brute([d[:2] for d in docs])}
    groups = {}
    for x in got:
        groups.setdefault(x._class_id, []).append(len(docs) - 1 if x.doc_id is None else x.doc_id)
    assert {tuple(sorted(g)) for g in groups.values()} == want
    assert sum(x.is_first for x in got) == len(want)


def test_hot_template(spark):
    """Some thousands of texts below the similarity to each other by one template; planted pairs reach it."""
    r = random.Random(12)
    template = [f"t{i}" for i in range(140)]
    docs = []
    for i in range(3000):
        docs.append(" ".join(template + [f"p{i}x{j}" for j in range(24)]))
    planted = {}
    for i in r.sample(range(3000), 120):
        # 144 of 160 shingles in common, a similarity of 0.818
        planted[len(docs)] = i
        docs.append(" ".join(template + [f"p{i}x{j}" for j in range(8)] + [f"q{i}x{j}" for j in range(16)]))
    codes = WordCodes()
    assert all(weighted_jaccard(bag(codes, docs[a]), bag(codes, docs[b])) >= 0.8 for a, b in planted.items())
    assert max(weighted_jaccard(bag(codes, docs[0]), bag(codes, docs[b])) for b in range(1, 3000)) < 0.8
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in near_duplicates(df).collect()}
    assert got == {i: planted.get(i, i) for i in range(len(docs))}


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_clashing_names(spark):
    names = ["class_id", "class_size", "is_first", "row", "node", "link", "first", "size", "able", "component", "n", "_n", "_able", "u", "v", "key", "Text_", "_class_id"]
    docs = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "other words here")]
    df = spark.createDataFrame([(*d, *range(len(names))) for d in docs], ["doc_id", "text", *names])
    got = near_duplicates(df)
    assert got.columns[: len(df.columns)] == df.columns and len(got.columns) == len(df.columns) + 3
    rows = sorted(tuple(r) for r in got.collect())
    assert [r[-3:] for r in rows] == [(1, 2, True), (1, 2, False), (3, 1, True)]
    assert all(r[2:-3] == tuple(range(len(names))) for r in rows)


def test_few_edges_take_few_tasks(spark):
    """A small graph ends in as many partitions as its edges need, not one for each shuffle partition."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 10 != 9], "u int, v int")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = components(edges)
        got = {(r.node, r.component) for r in found.collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == {(i, i // 10 * 10) for i in range(40)}
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
