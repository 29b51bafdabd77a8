import math

import numpy as np
import pytest

from waymark.llm.queries import QUERIES
from waymark.llm.whitening import bit_sliced_cross, turned, whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, component string"


def brute(rows, components=32):
    """Columns by component and row, from Python integers and a dense eigh."""
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in fine], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = n * x - s
    scatter = (centred.T @ centred).astype(float) / n**3
    values, vectors = np.linalg.eigh(scatter)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (centred.astype(float) / n) @ vectors / np.sqrt(values)
    return [i for i, _ in fine], n, [(r * r).sum() for r in centred], white[:, :components], (values / np.trace(scatter))[:components]


@pytest.mark.parametrize("bits", [0, 1, 7, 33])
def test_bit_slices_are_exact(bits):
    y = np.random.default_rng(bits).integers(0, 1 << bits, (201, 5), endpoint=True)
    y[:, 2] = 0
    z = y.astype(object)
    assert (bit_sliced_cross(y) == z.T @ z).all()


def test_query_against_integers(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, n, deviation, white, explained = brute(rows)
    got = {(r.vec_id, r.component): r for r in QUERIES["op12_whiten"](spark, SF).collect()}
    assert len(got) == len(ids) * white.shape[1]
    for at, i in enumerate(ids):
        assert {got[i, c + 1].deviation for c in range(white.shape[1])} == {deviation[at]}
    for c in range(white.shape[1]):
        own = np.array([got[i, c + 1].whitened for i in ids])
        assert abs(abs(own @ white[:, c]) / n - 1) < 1e-6
        assert got[ids[0], c + 1].explained == pytest.approx(explained[c], rel=1e-9)
    assert {r.n for r in got.values()} == {n}
    assert max(r.identity_error for r in got.values()) < 1e-9


def test_small_eigenvalues_keep_their_digits():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    exact = np.longdouble(10) ** -np.arange(0, 16, 3)
    u = q.astype(np.longdouble)
    for _ in range(3):
        u = u @ (1.5 * np.eye(6, dtype=np.longdouble) - 0.5 * (u.T @ u))
    matrix = (u * exact) @ u.T
    _, start = np.linalg.eigh(matrix.astype(float))
    values, vectors = turned((matrix + matrix.T) / 2, start)
    assert np.allclose((values / exact).astype(float)[:5], 1, rtol=1e-4)
    assert abs(vectors.T @ vectors - np.eye(6)).max() < 1e-16


def test_rows_that_take_no_part_repeats_and_large_entries(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * [1, 1000, 1e6]], "x") for i in range(40)]
    rows += [rows[0], rows[0], (None, [0.0, -0.0, 5.0], None)]
    fine = list(rows)
    rows += [(50, None, "a"), (51, [1.0, None, 2.0], "b"), (52, [1.0, float("nan"), 2.0], "c"), (53, [1.0, float("inf"), 2.0], "d"), (54, [1.0], "e"), (55, [], "f")]
    ids, n, deviation, white, explained = brute([r[:2] for r in fine])
    got = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 3 * n and {r.n for r in got} == {n}
    first = [r for r in got if r.component == 1]
    assert sorted(int(r.deviation) for r in first) == sorted(deviation)
    assert sum(r.vec_id is None for r in first) == 1 and sum(r.vec_id == 0 for r in first) == 3
    assert all(r.identity_error < 1e-9 for r in got)
    by = {r.component: r.explained for r in got}
    assert [by[c] for c in (1, 2, 3)] == pytest.approx(list(explained), rel=1e-6)


def test_too_few_rows_and_empty_tables(spark):
    one = whiten(spark.createDataFrame([(1, [0.5, 2.0], "x")], SCHEMA)).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    two = whiten(spark.createDataFrame([(1, [0.5, 2.0], "x"), (2, [1.0, 3.0], "y")], SCHEMA)).collect()
    assert [r.whitened is None for r in sorted(two, key=lambda r: r.component)] == [False, False, True, True]
    assert all(r.identity_error < 1e-9 for r in two)
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
