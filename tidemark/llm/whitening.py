"""Whitening of embeddings by polarisation covariance (operator 11).

Vectors are integers ``x``. Over the ``n`` distinct vectors with sums ``S``, the centred
value of a dimension is the integer ``c = n * x - S``. Only sums of squares are aggregated:
``Q(i)`` of the centred value of every dimension and ``Q(i, j)`` of the sum of two of them.
As ``(a + b)^2 - a^2 - b^2 = 2ab``, differences of these variances give every
cross-covariance ``(Q(i, j) - Q(i) - Q(j)) / (2 n^3)``. All of it is exact: tasks add in
64-bit integers cut so that nothing overflows, Spark adds the tasks' totals as decimals, and
the division is the first rounding. The matrix is assembled on the driver (its size depends
on the number of dimensions only) and decomposed by ``eigh``.

Distinct vectors are found by one shuffle, reduced before it, so a vector that a third of
the rows hold is one row a task. Sums, squares and projections run where the rows are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged, unstage
from tidemark.llm.vectors import by_length, finite, integers, peak

_LIMB = 10 ** 18
_ROWS = 4096
_TOTALS = "size int, i int, j int, hi decimal(38,0), lo decimal(38,0)"


def _totals(totals: dict[tuple[int, int, int], int]) -> pa.RecordBatch:
    """Exact totals as rows, each in two limbs that decimals can add up."""
    keys = sorted(totals)
    limbs = [divmod(totals[k], _LIMB) for k in keys]
    big = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays(
        [*(pa.array([k[p] for k in keys], pa.int32()) for p in range(3)),
         *(pa.array([Decimal(limb[p]) for limb in limbs], big) for p in range(2))], names=["size", "i", "j", "hi", "lo"])


def _collect(totals: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """Totals of all tasks by vector length: as many as a matrix has entries, whatever the rows."""
    out: dict[int, dict[tuple[int, int], int]] = defaultdict(dict)
    for r in totals.groupBy("size", "i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect():
        out[r["size"]][r["i"], r["j"]] = int(r["hi"]) * _LIMB + int(r["lo"])
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (at i = -1) and the sum of every dimension."""
    totals: dict[tuple[int, int, int], int] = defaultdict(int)
    for batch in batches:
        for d, x, _ in by_length(batch, "x"):
            exact = x if peak(x) * len(x) < 1 << 62 else x.astype(object)
            totals[d, -1, -1] += len(x)
            for i, s in enumerate(exact.sum(axis=0).tolist()):
                totals[d, i, i] += s
    yield _totals(totals)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, in 64-bit integers if they hold it, else in Python's."""
    if n * peak(x) + max(map(abs, sums), default=0) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sum_squares(t: np.ndarray, bits: int) -> list[int]:
    """Exact sums of squares of the rows of a matrix whose values are below ``2 ** bits``."""
    if t.dtype == object:
        return (t * t).sum(axis=1).tolist()

    def dot(a, b):
        return np.einsum("ij,ij->i", a, b).astype(object)
    if 2 * bits + t.shape[1].bit_length() < 63:
        return dot(t, t).tolist()
    half = (bits + 1) // 2          # t = hi * 2^half + lo, no product over 2^(2 * half)
    hi = t >> half
    lo = t - (hi << half)
    return ((dot(hi, hi) << 2 * half) + (dot(hi, lo) << half + 1) + dot(lo, lo)).tolist()


def squares(c: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of squares of every column and of the sum of every two columns."""
    out: dict[tuple[int, int], int] = defaultdict(int)
    bits = (2 * peak(c)).bit_length() + 1
    if c.dtype != object and bits > 50:             # 4096 products of limbs would overflow
        c = c.astype(object)
    for k in range(0, len(c), _ROWS):
        t = np.ascontiguousarray(c[k:k + _ROWS].T)
        for i, s in enumerate(_sum_squares(t, bits)):
            out[i, i] += s
        for i in range(len(t) - 1):
            for j, s in enumerate(_sum_squares(t[i + 1:] + t[i], bits), i + 1):
                out[i, j] += s
    return out


def covariance(n: int, q: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances (divisor ``n``) from sums of squares of values that are centred and ``n`` times too large."""
    d = max((i for i, _ in q), default=-1) + 1
    v = np.zeros((d, d))
    for (i, j), s in q.items():
        # quotients of integers are rounded once
        v[i, j] = v[j, i] = s / n ** 3 if i == j else (s - q[i, i] - q[j, j]) / (2 * n ** 3)
    return v


class _Model:
    """What one vector length's rows are projected with."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, components: int):
        self.n, self.sums = n, sums
        e, vectors = np.linalg.eigh(v)
        e, vectors = e[::-1][:components], vectors[:, ::-1][:, :components]
        trace = float(np.trace(v))
        self.explained = [float(max(x, 0.0)) / trace if trace > 0 else None for x in e]
        # directions in which nothing varies have no scale
        rank = int((e > max(float(e[0]), 0.0) * len(v) * np.finfo(float).eps).sum()) if len(e) and e[0] > 0 else 0
        self.axes = vectors[:, :rank] / np.sqrt(e[:rank])

    def project(self, c: np.ndarray) -> np.ndarray:
        return np.einsum("ij,jk->ik", c.astype(float) / self.n, self.axes)


def whiten(df: DataFrame, *, components: int = 4, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per input row and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``.

    Rows whose vector is null or holds a null or non-finite component are dropped. Rows that
    repeat, and rows with a null id, are each returned; equal vectors count once in the fit.
    Vectors of each length are a fit of their own; one without components yields no row.
    Components in which the fit does not vary have a null ``whitened``; ``explained`` and
    ``identity_error`` are null if nothing varies. Equal eigenvalues have no order of their
    own: any orthonormal basis of theirs may be returned, the same for all rows. A
    ``deviation`` that no long can hold is null. Other columns are not read; an empty table
    gives an empty one.
    """
    x = integers(vec_col, scale)
    rows = df.where(finite(vec_col)).select(F.col(id_col).alias("id"), x.alias("x"))
    fit = staged(rows.select("x").distinct(), "whiten-fit")
    sums = {d: (q[-1, -1], [q[i, i] for i in range(d)]) for d, q in _collect(fit.mapInArrow(_sums, _TOTALS)).items()}

    def run_squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], int] = defaultdict(int)
        for batch in batches:
            for d, m, _ in by_length(batch, "x"):
                for (i, j), s in squares(centred(m, *sums[d])).items():
                    totals[d, i, j] += s
        yield _totals(totals)
    squared = _collect(fit.mapInArrow(run_squares, _TOTALS))
    models = {d: _Model(*sums[d], covariance(sums[d][0], squared[d]), components) for d in sums if d}

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums (at a = -1) and products of the whitened fit list."""
        totals: dict[tuple[int, int, int], float] = defaultdict(float)
        for batch in batches:
            for d, m, _ in by_length(batch, "x"):
                if d:
                    w = models[d].project(centred(m, *sums[d]))
                    for b in range(w.shape[1]):
                        totals[d, -1, b] += float(w[:, b].sum())
                        for a in range(b + 1):
                            totals[d, a, b] += float((w[:, a] * w[:, b]).sum())
        keys = sorted(totals)
        yield pa.RecordBatch.from_arrays([*(pa.array([k[p] for k in keys], pa.int32()) for p in range(3)),
                                          pa.array([totals[k] for k in keys], pa.float64())], names=["size", "a", "b", "s"])
    errors: dict[int, float] = {}
    found = {(r["size"], r["a"], r["b"]): r["s"] for r in fit.mapInArrow(moments, "size int, a int, b int, s double")
             .groupBy("size", "a", "b").agg(F.sum("s").alias("s")).collect()}
    for (d, a, b), s in found.items():
        if a >= 0:
            n = sums[d][0]
            off = abs(s / n - (found[d, -1, a] / n) * (found[d, -1, b] / n) - (a == b))
            errors[d] = max(errors.get(d, 0.0), off)
    unstage(fit.staged_path)

    kind = next(f.dataType for f in rows.schema if f.name == "id")
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(k, t) for k, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType())))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, m, part in by_length(batch, "x"):
                if not d:
                    continue
                model = models[d]
                c = centred(m, *sums[d])
                if c.dtype == object or peak(c) ** 2 * d >= 1 << 63:
                    deviation = [s if s < 1 << 63 else None for s in (c.astype(object) ** 2).sum(axis=1).tolist()]
                else:
                    deviation = np.einsum("ij,ij->i", c, c)
                w, k, rank = model.project(c), len(model.explained), model.axes.shape[1]
                at = pa.array(np.repeat(np.arange(len(m)), k))
                whole = np.full((len(m), k), np.nan)
                whole[:, :rank] = w
                tiled = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))), pa.array(np.full(len(m) * k, model.n, np.int64)),
                         pa.array(deviation, pa.int64()).take(at), pa.array(whole.reshape(-1), from_pandas=True),
                         pa.array(model.explained * len(m), pa.float64()), pa.array([errors.get(d)] * (len(m) * k), pa.float64())]
                yield pa.RecordBatch.from_arrays([part.column("id").take(at), *tiled], names=schema.names)
    return rows.mapInArrow(project, schema)
