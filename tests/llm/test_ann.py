import heapq

import numpy as np
from pyspark.sql import functions as F

from waymark.llm.ann import MultiIndex, nearest
from waymark.llm.common import table
from waymark.llm.queries import op4_nearest

SF = "/root/testdata/sf0.01"


def exact(rows, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=float)
    out = {}
    for n in np.flatnonzero(ids % 20 == 0):
        s = x @ x[n]
        order = [m for m in np.lexsort((ids, -s)) if m != n][:k]
        out[int(ids[n])] = [(int(ids[m]), s[m]) for m in order]
    return out


def test_walk_visits_cells_in_order():
    r = np.random.default_rng(2)
    index = MultiIndex(r.normal(size=(7, 3)), r.normal(size=(5, 3)), (0.0, 0.0), np.ones((7, 5), dtype=int))
    q = r.normal(size=6)
    sums = [float(index.first[i] @ q[:3] + index.second[j] @ q[3:]) for i, j in index.walk(q, 35)]
    assert len(sums) == 35 and np.allclose(sums, heapq.nlargest(35, sums))


def test_recall_and_exact_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    want = exact(rows)
    got = {}
    for r in op4_nearest(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    vectors = {k: np.array(v, dtype=float) for k, v in rows}
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - vectors[q] @ vectors[v]) < 1e-12 for _, v, s in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hits / 20 / len(want) >= 0.95


def test_edge_cases(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0, 1.0]), (1, [1.0, 0.0, 1.0]), (2, [1.0, 0.0, 1.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 1.0]), (6, [None, 1.0, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0, 1.0]), (20, [0.5, 0.5, 0.5]), (20, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, i int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 1.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 1.0)]
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_equal_vectors_and_a_hot_cell(spark):
    """A third of all rows is one vector, another third lies in one cell; results stay exact there."""
    r = np.random.default_rng(8)
    base = r.normal(size=8)
    rows = [(i, base.tolist()) for i in range(0, 1500)] + [(i, (base + r.normal(size=8) * 0.01).tolist()) for i in range(1500, 3000)] + [(i, r.normal(size=8).tolist()) for i in range(3000, 4500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in nearest(df, F.col("vec_id") % 500 == 0).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    ids, x = np.arange(4500), np.array([v for _, v in rows])
    hits = 0
    for q in range(0, 4500, 500):
        s = (x * x[q]).sum(axis=1)
        want = [int(m) for m in np.lexsort((ids, -s)) if m != q][:20]
        hits += len(set(want) & {v for _, v, _ in got[q]})
        assert [n for n, _, _ in sorted(got[q])] == list(range(1, 21))
    assert hits / 180 >= 0.95
