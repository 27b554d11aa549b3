"""Whitening of embeddings through a bidiagonal qd solver.

1. Exact sums per dimension give the mean.
2. Blockwise QR: a task reduces its centred rows, a block at a time, to one
   triangular R; the R of all tasks are reduced in rounds, as a tree.
3. On one small R: Householder reflections bring it to an upper bidiagonal B, and
   the differential qd algorithm with shifts (dqds) finds the singular values to
   high relative accuracy, with no covariance matrix ever formed.
4. For each wanted singular value a twisted factorisation of B'B minus its
   square gives the singular vector; vectors of close values are made orthogonal,
   and the reflections carry them back to the whitening directions.
5. A pass over the rows measures the whitened covariance, another writes rows.

The covariance of V = X'X / n has the eigenvalues s^2 / n of the singular values
s of the centred X, and X's right singular vectors as eigenvectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut, scratch

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Rows of one QR block, and partial results that one task (at the end the driver) combines.
BLOCK_ROWS, FAN_IN = 4096, 32
_EPS = np.finfo(np.float64).eps
#: Relative gap of singular values below which vectors are made orthogonal to each other.
CLOSE = 1e-3


# bidiagonal singular values and vectors ------------------------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v of length 1 and alpha such that (I - 2 v v') x = alpha e1; v is zero where there is nothing to do."""
    norm = float(np.linalg.norm(x))
    if norm == 0 or not np.any(x[1:]):
        return np.zeros_like(x), float(x[0])
    alpha = -math.copysign(norm, x[0])
    v = x.copy()
    v[0] -= alpha
    return v / np.linalg.norm(v), alpha


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, Q) with U' r Q upper bidiagonal, by Householder reflections from both sides."""
    a, d = r.astype(np.float64).copy(), r.shape[1]
    q = np.eye(d)
    for k in range(d):
        v, _ = _reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, _ = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def _dqds_step(q: list, e: list, shift: float, lo: int, hi: int) -> tuple[list, list, float, float]:
    """One sweep over q[lo..hi], e[lo..hi-1]: the new ones, the least d of the sweep and the last."""
    nq, ne = q[: hi + 1], e[:hi]
    d = q[lo] - shift
    least = d
    for k in range(lo, hi):
        nq[k] = d + e[k]
        if nq[k] == 0:
            return nq, ne, -1.0, -1.0
        t = q[k + 1] / nq[k]
        ne[k] = e[k] * t
        d = d * t - shift
        if d < least:
            least = d
    nq[hi] = d
    return nq, ne, least, d


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """All singular values of an upper bidiagonal matrix, falling, by dqds on the squares.

    A sweep with a shift that turns out too large (a negative d) is thrown away and done again with a smaller one; shift 0 never
    fails.  A value is finished when the last off-diagonal is negligible, two when the one before it is.
    """
    scale = float(max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0)))
    if scale == 0:
        return np.zeros(len(diagonal))
    q, e = [float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2]
    found, tiny = [], np.finfo(np.float64).tiny
    stack = [(0, len(q) - 1, 0.0)]
    while stack:
        lo, hi, sigma = stack.pop()
        if any(x == 0 for x in q[lo:hi]) and hi > lo:  # an exact zero on the diagonal: one sweep without shift moves it down
            for _ in range(hi - lo + 1):
                qz, ez = q[lo : hi + 1], e[lo:hi]
                d = qz[0]
                for k in range(hi - lo):
                    s = d + ez[k]
                    t = qz[k + 1] / s if s else 0.0
                    e[lo + k] = ez[k] * t
                    q[lo + k], d = s, (d * t if s else qz[k + 1])
                q[hi] = d
        fresh, last_shift = True, 0.0
        while hi >= lo:
            if hi == lo:
                found.append(sigma + q[lo])
                break
            if e[hi - 1] <= _EPS**2 * (sigma + q[hi]) or e[hi - 1] <= tiny:
                found.append(sigma + q[hi])
                hi -= 1
                continue
            if hi - lo == 1 or e[hi - 2] <= _EPS**2 * (sigma + q[hi - 1]) or e[hi - 2] <= tiny:
                # the last two by themselves: the eigenvalues of [[q1, sqrt(q1 e)], [., q2 + e]]
                a, b, c = q[hi - 1], e[hi - 1], q[hi]
                half = 0.5 * (a + b + c)
                root = math.sqrt(max(0.0, (0.5 * (a - c) + 0.5 * b) ** 2 + b * c))
                big = half + root
                found += [sigma + big, sigma + (a * (c / big) if big else 0.0)]
                hi -= 2
                continue
            part = next((k for k in range(hi - 3, lo - 1, -1) if e[k] <= _EPS**2 * (sigma + q[k + 1]) or e[k] <= tiny), None)
            if part is not None:
                stack.append((lo, part, sigma))
                lo = part + 1
                continue
            # shift: a bound from below on the least value by the last rows, zero in the first sweep
            if fresh:
                shift = 0.0
            else:
                a, b, c = q[hi - 1], e[hi - 1], q[hi]
                half = 0.5 * (a + b + c)
                big = half + math.sqrt(max(0.0, (0.5 * (a - c) + 0.5 * b) ** 2 + b * c))
                shift = max(0.0, min(last_shift, (a * (c / big)) * (1 - 4 * _EPS)))
            while True:
                nq, ne, least, d = _dqds_step(q, e, shift, lo, hi)
                if least >= 0 and all(x >= 0 for x in nq[lo:]):
                    break
                shift = 0.0 if shift < _EPS * (sigma + q[hi]) else shift * 0.25
                if shift == 0:
                    nq, ne, least, d = _dqds_step(q, e, 0.0, lo, hi)
                    break
            q[lo : hi + 1], e[lo:hi] = nq[lo : hi + 1], ne[lo:hi]
            sigma, last_shift, fresh = sigma + shift, max(least, 0.0) if least else 0.0, False
    return np.sqrt(np.maximum(np.sort(np.array(found))[::-1], 0)) * scale


class Twisted:
    """B'B - shift as twisted factorisations: from the top to the twist and from the bottom to it."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, shift: float):
        q, e, n = diagonal**2, above**2, len(diagonal)
        self.n, self.off = n, diagonal[:-1] * above  # off-diagonal of B'B
        least = _EPS**2 * max(shift, float(q.max()), np.finfo(np.float64).tiny)  # in place of a pivot of exactly 0
        self.top, self.down = np.empty(n), np.empty(n)
        stationary, progressive = np.empty(n), np.empty(n)
        # stationary qd: pivots from above; progressive qd: pivots from below; both in differential form
        stationary[0] = -shift
        for k in range(n):
            self.top[k] = (stationary[k] + q[k]) or least
            if k < n - 1:
                stationary[k + 1] = e[k] * (stationary[k] / self.top[k]) - shift
        progressive[n - 1] = q[n - 1] - shift
        for k in range(n - 2, -1, -1):
            self.down[k + 1] = (e[k] + progressive[k + 1]) or least
            progressive[k] = progressive[k + 1] * (q[k] / self.down[k + 1]) - shift
        self.gamma = stationary + progressive + shift

    def vector(self, twist: int) -> np.ndarray:
        """z with (B'B - shift) z = gamma[twist] e_twist and z[twist] = 1, scaled to length 1."""
        z = np.zeros(self.n)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -self.off[k] * z[k + 1] / self.top[k]
        for k in range(twist, self.n - 1):
            z[k + 1] = -self.off[k] * z[k] / self.down[k + 1]
        size = np.abs(z).max()
        z = z / size
        return z / np.linalg.norm(z)

    @np.errstate(over="ignore", invalid="ignore")
    def solve(self, b: np.ndarray, twist: int) -> np.ndarray:
        """z with (B'B - shift) z = b, through the factorisation twisted at ``twist``; not finite where that is singular."""
        y = b.astype(np.float64).copy()
        for k in range(twist):
            y[k + 1] -= self.off[k] / self.top[k] * y[k]
        for k in range(self.n - 1, twist, -1):
            y[k - 1] -= self.off[k - 1] / self.down[k] * y[k]
        z = np.empty(self.n)
        pivot = self.gamma[twist] or _EPS * max(np.abs(self.gamma).max(), np.finfo(np.float64).tiny)
        z[twist] = y[twist] / pivot
        for k in range(twist - 1, -1, -1):
            z[k] = (y[k] - self.off[k] * z[k + 1]) / self.top[k]
        for k in range(twist, self.n - 1):
            z[k + 1] = (y[k + 1] - self.off[k] * z[k]) / self.down[k + 1]
        return z


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of the bidiagonal matrix for its ``values`` (falling), as columns."""
    scale = float(np.abs(diagonal).max(initial=0)) or 1.0
    b, c, out = diagonal / scale, above / scale, []
    rng = np.random.default_rng(5)
    parts = np.concatenate([[0], np.flatnonzero(np.abs(c) <= _EPS * np.minimum(np.abs(b[:-1]), np.abs(b[1:]))) + 1, [len(b)]])

    for k, value in enumerate(values / scale):
        close = [j for j in range(k) if values[j] / scale - value <= CLOSE * max(value, _EPS)]
        best = None
        for lo, hi in zip(parts[:-1], parts[1:]):  # a matrix that falls apart has vectors that live on one part
            f = Twisted(b[lo:hi], c[lo : hi - 1], value**2)
            order = np.argsort(np.abs(f.gamma))
            for twist in order[: len(close) + 1]:
                z = np.zeros(len(b))
                z[lo:hi] = f.vector(int(twist))
                free = z
                for _ in range(2):
                    for j in close:
                        free = free - out[j] * (out[j] @ free)
                left = np.linalg.norm(free)
                wrong = abs(f.gamma[twist]) * abs(z[lo + twist])
                if left > 0.5 and (best is None or wrong < best[0]):
                    best = (wrong, free / left, f, lo, hi, int(order[0]))
                if left > 0.5:
                    break
        if best is None:  # every twisted vector lies in the span of the close ones: iterate from a random start beside it
            lo, hi = max(zip(parts[:-1], parts[1:]), key=lambda p: p[1] - p[0])
            best = (0.0, rng.standard_normal(len(b)), Twisted(b[lo:hi], c[lo : hi - 1], value**2), lo, hi, int(order[0]) if len(order) == hi - lo else 0)
        _, z, f, lo, hi, twist = best
        for _ in range(3 if close else 0):  # inverse iteration with the same factorisation
            y = np.zeros(len(b))
            y[lo:hi] = f.solve(z[lo:hi], twist)
            if not np.isfinite(y).all() or not np.any(y):
                break
            y /= np.abs(y).max()
            for _ in range(2):
                for j in close:
                    y = y - out[j] * (out[j] @ y)
            if np.linalg.norm(y) < 1e-8:
                break
            z = y / np.linalg.norm(y)
        out.append(z / np.linalg.norm(z))
    return np.array(out).T.reshape(len(b), len(out))


def directions(r: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(singular values of ``r``, its first right singular vectors as columns); values that are rounding alone have no vector."""
    diagonal, above, q = bidiagonalise(r)
    values = singular_values(diagonal, above)
    rank = int((values > len(values) * _EPS * values.max(initial=0)).sum())
    return values, q @ right_vectors(diagonal, above, values[: min(components, rank)])


# the rows ------------------------------------------------------------------------------------------------


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): entries as long floor(1024 c) + 100000, of vectors without null or non-finite entries."""
    v = F.col("v")
    good = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(good & (F.size("v") > 0))
    return rows.select("vec_id", F.transform("v", lambda c: (F.floor(c * SCALE) + SHIFT).cast("long")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def reduced(parts: DataFrame, combine, schema: str) -> list:
    """Partial results, one row of ``schema`` a task, combined in rounds of FAN_IN until the driver can take the rest; ``combine`` maps a list of rows to one row."""

    def run(batches):
        held = [r for b in batches for r in b.to_pylist()]
        if held:
            yield pa.RecordBatch.from_pylist([combine(held)], schema=kind)

    parts = cut(parts, "parts")
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(parts.schema)
    while (n := parts.count()) > FAN_IN:
        parts = cut(parts.repartition(math.ceil(n / FAN_IN)).mapInArrow(run, schema), "parts")
    held = [r.asDict(recursive=True) for r in parts.collect()]
    return [combine(held)] if held else []


def _sums(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    def run(batches):
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            n, total = n + batch.num_rows, total + _matrix(batch.column(1), d).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "s": total.tolist()}])

    def combine(parts):
        return {"n": sum(p["n"] for p in parts), "s": [sum(x) for x in zip(*(p["s"] for p in parts))]}

    found = reduced(rows.mapInArrow(run, "n long, s array<long>"), combine, "n long, s array<long>")
    return (found[0]["n"], np.array(found[0]["s"], np.int64)) if found else (0, np.zeros(d, np.int64))


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - S / n; the whole part of the mean is taken off in integers, so that no digit is lost."""
    whole = total // n
    return (x - whole).astype(np.float64) - (total - whole * n) / n


def _triangle(rows: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    d = len(total)

    def stack(parts: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.concatenate(parts), mode="r")

    def run(batches):
        r = np.zeros((0, d))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                r = stack([r, _centred(_matrix(batch.slice(at, BLOCK_ROWS).column(1), d), n, total)])
        if len(r):
            yield pa.RecordBatch.from_pylist([{"r": r.ravel().tolist()}])

    def combine(parts):
        return {"r": stack([np.array(p["r"]).reshape(-1, d) for p in parts]).ravel().tolist()}

    r = np.array(reduced(rows.mapInArrow(run, "r array<double>"), combine, "r array<double>")[0]["r"]).reshape(-1, d)
    return np.concatenate([r, np.zeros((max(0, d - len(r)), d))])


def _moments(rows: DataFrame, n: int, total: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Covariance of the whitened rows, centred before multiplying: each task about its own mean, tasks joined by the difference of their means."""
    d, k = times.shape

    def join(parts):
        many = sum(p["n"] for p in parts)
        means = np.array([p["mean"] for p in parts])
        mean = sum(p["n"] * m for p, m in zip(parts, means)) / many
        m2 = sum(np.array(p["m2"]).reshape(k, k) + p["n"] * np.outer(m - mean, m - mean) for p, m in zip(parts, means))
        return {"n": many, "mean": mean.tolist(), "m2": m2.ravel().tolist()}

    def run(batches):
        held = []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                w = _centred(_matrix(batch.slice(at, BLOCK_ROWS).column(1), d), n, total) @ times
                mean = w.mean(axis=0)
                held = [join([*held, {"n": len(w), "mean": mean.tolist(), "m2": ((w - mean).T @ (w - mean)).ravel().tolist()}])]
        if held:
            yield pa.RecordBatch.from_pylist(held)

    kind = "n long, mean array<double>, m2 array<double>"
    found = reduced(rows.mapInArrow(run, kind), join, kind)[0]
    return np.array(found["m2"]).reshape(k, k) / found["n"]


def whiten(vectors: DataFrame, *, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or hold null or non-finite entries, are
    dropped.  All vectors should have one length; where they have not, the most
    frequent one counts (the longer of equals), and vectors of other lengths
    are dropped.  Rows of null or repeated ids are rows like any other, and
    extra columns are not looked at.  There are as many components as the rows
    have independent directions, ``components`` at most: one row, or rows that
    are all equal, vary in none and give no rows, as does an empty table.
    ``deviation`` is exact; where it does not fit into a long it is null.  The
    sign of a component is that which makes the largest entry (the first of
    equals) positive.
    """
    spark = vectors.sparkSession
    with scratch(spark):
        every = integer_rows(vectors, id_col, vector_col)
        lengths = every.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
        kind = f"vec_id {every.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        if not lengths:
            return spark.createDataFrame([], kind)
        d = lengths[0].d
        rows = every.where(F.size("x") == d)
        n, total = _sums(rows.select(F.lit(0).alias("i"), "x"), d)
        r = _triangle(rows.select(F.lit(0).alias("i"), "x"), n, total)
        values, basis = directions(r, components)
        if not basis.shape[1]:
            return spark.createDataFrame([], kind)
        basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])] < 0, -1.0, 1.0)
        e = values**2 / n
        times = basis / np.sqrt(e[: basis.shape[1]])
        error = float(np.abs(_moments(rows.select(F.lit(0).alias("i"), "x"), n, total, times) - np.eye(basis.shape[1])).max())
        explained = e[: basis.shape[1]] / ((r**2).sum() / n)

    def run(batches):
        k = times.shape[1]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = _matrix(part.column(1), d)
                away = n * x - total
                size = (away.astype(np.float64) ** 2).sum(axis=1)
                deviation = pa.array((away**2).sum(axis=1), mask=size >= 9.2e18)
                which = pa.array(np.repeat(np.arange(part.num_rows), k))
                columns = [
                    part.column(0).take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)), pa.array(np.full(part.num_rows * k, n)), deviation.take(which),
                    pa.array((_centred(x, n, total) @ times).ravel()), pa.array(np.tile(explained, part.num_rows)), pa.array(np.full(part.num_rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, kind)
