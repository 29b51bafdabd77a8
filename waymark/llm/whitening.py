"""Whitening of vectors from an exact integer scatter matrix, summed by bit slices.

1. Each entry c becomes the integer x = floor(64 c) + 1,000,000. Rows are read in blocks. In
   a block each dimension is shifted by its least x, so that few bit planes are left, and
   each plane is packed across the rows into 64-bit words. The cross-product of two
   dimensions is the sum over their planes a and b of 2^(a+b) times the set bits of the
   words' AND: exact, whatever the order of rows.
2. Blocks are moved back to a common origin and summed in a task; a task gives one row for
   each pair of dimensions, and Spark sums these as decimals. So what is shuffled depends
   on the dimensions and the tasks, never on the rows.
3. n * scatter - S S^T is centred in Python integers, and only the centred matrix becomes
   doubles for ``eigh``. Its vectors are turned further by Jacobi rotations in extended
   precision, so that small eigenvalues beside large ones keep their digits.
4. Rows are centred as integers (n x - S), projected and scaled. The covariance of the
   whitened rows is measured on them, in a pass of its own.

Defined results: vectors that are null, empty or of another length than the most frequent
one take no part (ties go to the shorter), nor do those with null or non-finite entries
or with entries of 2^40 and more in size. Repeated rows and ids count as often as they
occur; a null id stays null. A component whose eigenvalue is no more than rounding of the
largest (fewer rows than dimensions, equal vectors) has a null ``whitened`` and takes no
part in the identity; with no eigenvalue above 0 ``explained`` and ``identity_error`` are
null as well. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
#: rows that are sliced together, and the size from which an entry takes no part
_BLOCK, _HUGE = 1 << 14, float(1 << 40)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    fine = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= _HUGE)) & (F.size(x) > 0)
    rows = vectors.where(fine).select(F.col("vec_id").cast("long"), x.alias("embedding"))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (length["n"] if length else 0))


def quantised(x: np.ndarray) -> np.ndarray:
    """The integers of an array of doubles, without the shift that all of them have."""
    return np.floor(SCALE * x).astype(np.int64)


def _matrices(batches: Iterator[pa.RecordBatch], most: int = _BLOCK) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integers of up to ``most`` rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            rows = part.column(1)
            yield part.column(0), quantised(rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1))


def bit_sliced_cross(y: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of ``y`` (integers from 0 on) of the products of each two dimensions, as Python integers."""
    rows, dims = y.shape
    planes = [[] for _ in range(dims)]  # (weight, words) of each dimension's planes that aren't empty
    bits = max(1, int(y.max()).bit_length())
    fill = -rows % 64
    for b in range(bits):
        plane = np.packbits(np.pad(((y >> b) & 1).astype(np.uint8), ((0, fill), (0, 0))), axis=0, bitorder="little")
        words = np.ascontiguousarray(plane.T).view(np.uint64)
        for d in np.flatnonzero(words.any(axis=1)):
            planes[d].append((b, words[d]))
    flat = [(d, b, w) for d in range(dims) for b, w in planes[d]]
    out = np.zeros((dims, dims), dtype=object)
    if not flat:
        return out
    of, weight, words = np.array([d for d, _, _ in flat]), np.array([b for _, b, _ in flat]), np.stack([w for _, _, w in flat])
    small = 2 * bits + rows.bit_length() < 62
    total = np.zeros((dims, dims), dtype=np.int64 if small else object)
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    for d, b, w in flat:
        count = np.bitwise_count(words & w).sum(axis=1, dtype=np.int64)
        weighted = count << (weight + b) if small else np.array([int(c) << int(e) for c, e in zip(count, weight + b, strict=True)], dtype=object)
        total[d, of[starts]] += np.add.reduceat(weighted, starts)
    return total.astype(object)


@dataclass
class Whitening:
    """Rows fitted, integer sums and their components; ``values`` are the eigenvalues of the covariance, largest first."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    #: components whose eigenvalue is above rounding
    sound: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S of unshifted integers, in 64 bits where they hold it."""
        largest = max(1, int(np.abs(x).max(initial=0)), *(abs(s) // max(1, self.n) for s in self.sums))
        if self.n * 2 * largest < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def whiten(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows of centred integers; NaN where a component isn't sound."""
        scaled = y.astype(np.float64) / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.sound, scaled @ self.vectors / np.sqrt(np.where(self.sound, self.values, 1.0)), np.nan)


def deviations(y: np.ndarray) -> list[int]:
    """Exact sums of squares of the rows of integers."""
    most = max(1, int(np.abs(y).max(initial=0)))
    if y.dtype != object and most * most * y.shape[1] < 1 << 63:
        return (y * y).sum(axis=1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in y]


def turned(matrix: np.ndarray, vectors: np.ndarray, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (largest first) and vectors of a symmetric matrix in extended precision, from vectors that nearly are.

    Jacobi rotations of the nearly diagonal matrix, until no entry beside the diagonal counts.
    """
    u = vectors.astype(np.longdouble)
    for _ in range(2):  # columns as unit vectors at right angles, beyond double precision
        u = u @ (1.5 * np.eye(u.shape[1], dtype=np.longdouble) - 0.5 * (u.T @ u))
    a = u.T @ matrix @ u
    tiny = np.finfo(np.longdouble).eps * 16
    for _ in range(rounds):
        size = np.sqrt(np.abs(np.diag(a)))
        open_pairs = np.argwhere(np.triu(np.abs(a) > tiny * np.outer(size, size) + tiny * np.finfo(np.float64).tiny, 1))
        if not len(open_pairs):
            break
        for p, q in open_pairs:
            if a[p, q]:
                t = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = (1 if t >= 0 else -1) / (abs(t) + np.sqrt(t * t + 1))
                c = 1 / np.sqrt(t * t + 1)
                s = t * c
                for x in (a, u):
                    x[:, p], x[:, q] = c * x[:, p] - s * x[:, q], s * x[:, p] + c * x[:, q]
                a[p], a[q] = c * a[p] - s * a[q], s * a[p] + c * a[q]
    values = np.diag(a)
    order = np.argsort(-values, kind="stable")
    return values[order], u[:, order]


def fit_whitening(rows: DataFrame, components: int) -> Whitening | None:
    """Components of all ``rows`` as ``usable`` gives them. The driver gets one number for each pair of dimensions."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        n, sums, cross = 0, None, None
        for _, x in _matrices(batches):
            least = x.min(axis=0)
            y = x - least
            shift, part = least.astype(object), y.sum(axis=0).astype(object)
            moved = bit_sliced_cross(y) + np.outer(shift, part) + np.outer(part, shift) + len(x) * np.outer(shift, shift)
            n, sums, cross = (len(x), part + len(x) * shift, moved) if sums is None else (n + len(x), sums + part + len(x) * shift, cross + moved)
        if n:
            i, j = np.triu_indices(len(sums))
            yield pd.DataFrame({"i": i, "j": j, "n": n, "value": [str(v) for v in cross[i, j]], "sum": [str(sums[a]) if a == b else "0" for a, b in zip(i, j, strict=True)]})

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in summed(batches):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    parts = rows.mapInArrow(arrow, "i long, j long, n long, value string, sum string")
    exact = parts.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    told = exact.collect()
    if not told:
        return None
    dims, n = max(r["i"] for r in told) + 1, told[0]["n"]
    sums, cross = [0] * dims, np.zeros((dims, dims), dtype=object)
    for r in told:
        cross[r["i"], r["j"]] = cross[r["j"], r["i"]] = int(r["value"])
        if r["i"] == r["j"]:
            sums[r["i"]] = int(r["sum"])
    s = np.array(sums, dtype=object)
    centred = n * cross - np.outer(s, s)  # exact integers: n squared times the covariance
    trace = sum(centred[i, i] for i in range(dims))
    _, vectors = np.linalg.eigh(centred.astype(np.float64))
    values, vectors = turned(_extended(centred), vectors)
    sound = values > dims * np.finfo(np.float64).eps * max(values[0], 0)
    keep, square = min(components, dims), np.longdouble(n) ** 2
    return Whitening(n, sums, (values[:keep] / square).astype(np.float64), vectors[:, :keep].astype(np.float64), float(_extended(np.array([trace], dtype=object))[0] / square), sound[:keep])


def _extended(x: np.ndarray) -> np.ndarray:
    """Python integers as extended doubles, in two parts, so that no digit is lost on the way."""
    high = x.astype(np.float64)
    rest = np.array([int(v) - int(h) for v, h in zip(x.ravel(), high.ravel(), strict=True)], dtype=object).reshape(x.shape)
    return high.astype(np.longdouble) + rest.astype(np.float64)


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """Largest entry in size of the covariance of the whitened rows less the identity; centred about their mean before multiplying."""
    k = int(model.sound.sum())
    if not k:
        return None
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def sums(about: np.ndarray | None):
        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            told = shared.value
            total = np.zeros(k if about is None else (k, k))
            for _, x in _matrices(batches):
                w = told.whiten(told.centred(x))[:, told.sound]
                total += w.sum(axis=0) if about is None else (w - about).T @ (w - about)
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(total.size), pa.int64()), "value": pa.array(total.ravel(), pa.float64())})

        found = rows.mapInArrow(one, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()
        return np.array([r["value"] for r in found]) / model.n

    covariance = sums(sums(None)).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row of ``vectors`` (vec_id, embedding) and component.

    ``deviation`` is the exact sum over dimensions of (n x - S)^2, as decimal(38, 0).
    """
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = usable(vectors)
    model = fit_whitening(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        explained = [float(v) / m.trace if m.trace > 0 else None for v in m.values]
        for ids, x in _matrices(batches, 4_096):
            y = m.centred(x)
            n = len(x)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": ids.take(pa.array(np.repeat(np.arange(n), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    "deviation": pa.array([str(d) for d in deviations(y)]).take(pa.array(np.repeat(np.arange(n), k))),
                    "whitened": pa.array(m.whiten(y).ravel(), from_pandas=True),
                    "explained": pa.array(explained * n, pa.float64()),
                }
            )

    out = rows.mapInArrow(told, "vec_id long, component int, deviation string, whitened double, explained double")
    return out.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))
