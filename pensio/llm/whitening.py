"""Embedding whitening: principal directions from a QR of the rows and a bidiagonal qd solver.

1. Every block of centred rows is reduced to its triangular factor R, a task's blocks to one; factors are stacked and
   reduced again, at most ``FAN`` in a task, until one is left. It is as wide as a vector, whatever the number of rows.
2. Householder reflections from both sides turn R into an upper bidiagonal B with the same singular values.
3. dqds finds the squared singular values of B without squaring it, each to high relative accuracy.
4. Twisted factorisations of B'B - t give the singular vectors: stationary qd from the top and progressive qd from the
   bottom meet where the remainder is least. Vectors of values too close to tell apart are made orthogonal.

The covariance has divisor n; component k is the direction with the k-th largest variance. A direction without variance
cannot be whitened and is no component, so there may be fewer than asked for; with no more than one distinct vector
there are none.

Vectors that are null, empty, or hold null or non-finite entries are left out; so are those of another length than most
have (of equally many lengths the greatest). Repeated rows count as often as they occur, other columns are not looked at.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pensio.llm.common import stage

COMPONENTS = 32
FAN = 32  # triangular factors that one task, and the driver, reduces to one
ROWS = 4096  # vectors worked on at a time
_EPS = np.finfo(float).eps


# Dense d x d algebra: d is the length of a vector.


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, v): r = u B v' with orthogonal u and v; u is not kept."""
    a = np.array(r, float)
    n = a.shape[1]
    v = np.eye(n)
    for k in range(n):
        _reflect(a[k:, k:])
        if k + 2 < n:
            h = _reflect(a[k:, k + 1 :].T)
            if h is not None:
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ h, h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflect(a: np.ndarray) -> np.ndarray | None:
    """Makes the first column of ``a`` zero below its head, in place; the reflection's unit vector, None if it is none."""
    x = a[:, 0].copy()
    scale = np.abs(x).max()
    if len(x) < 2 or scale == 0 or not np.any(x[1:]):
        return None
    x /= scale
    x[0] += np.copysign(np.linalg.norm(x), x[0])
    x /= np.linalg.norm(x)
    a -= 2 * np.outer(x, x @ a)
    return x


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    q, e = diagonal.astype(float) ** 2, above.astype(float) ** 2
    done, at = [], [(q, e, 0.0)]
    while at:
        q, e, moved = at.pop()
        tries = 0
        while len(q) > 1:
            # A coupling that is negligible beside its neighbours parts the matrix.
            small = np.flatnonzero(e <= _EPS**2 * np.maximum(np.minimum(q[:-1], q[1:]), _EPS**2 * (moved + q.max())))
            if len(small):
                cut = int(small[-1]) + 1
                at.append((q[:cut], e[: cut - 1], moved))
                q, e = q[cut:], e[cut:]
                continue
            if q[0] < q[-1] and tries % 8 == 7:  # graded the wrong way round
                q, e = _flipped(q, e)
            shift = 0.0 if tries == 0 else _shift(q, e) / (1 << min(tries % 4, 3))
            tries += 1
            new = _sweep(q, e, shift)
            if new is None:
                new, shift = _sweep(q, e, 0.0), 0.0
            q, e = new
            moved += shift
        done.append(float(q[0]) + moved)
    return np.sort(np.maximum(np.array(done), 0.0))[::-1]


def _flipped(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return q[::-1].copy(), e[::-1].copy()


def _shift(q: np.ndarray, e: np.ndarray) -> float:
    """A guess below the least squared singular value: that of the last two rows, less what couples them to the others."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), e[-1], q[-1]
    half = (a + b + c) / 2
    low = a * c / (half + np.sqrt(max(half * half - a * c, 0.0))) if half > 0 else 0.0
    return max(0.0, min(low, c)) * 0.98


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One dqds transform; None if the shift was too large."""
    n = len(q)
    nq, ne = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        nq[i] = d + e[i]
        if nq[i] == 0:
            ne[i], d = 0.0, q[i + 1] - shift
            continue
        ratio = q[i + 1] / nq[i]
        ne[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    nq[-1] = d
    return nq, ne


def singular_vectors(diagonal: np.ndarray, above: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Unit right singular vectors of an upper bidiagonal matrix, one column for each of its squared values."""
    n = len(diagonal)
    top = float(squares[0]) if len(squares) else 0.0
    a = np.where(np.abs(diagonal) > _EPS * np.sqrt(top) / n, diagonal, _EPS * np.sqrt(top) / n + 1e-300)
    pivots, factors = a**2, above / a[:-1]
    out = np.zeros((n, len(squares)))
    lead = 0  # the first of a cluster of values that are close
    for k, value in enumerate(squares):
        if k and squares[k - 1] - value > 1e-3 * squares[k - 1]:
            lead = k
        z = _twisted(pivots, factors, float(value), top)
        # Close values: keep what is new in each vector; start anew where nothing is left.
        for attempt in range(8):
            for _ in range(2):
                z = z - out[:, lead:k] @ (out[:, lead:k].T @ z)
            size = np.linalg.norm(z)
            if size > 0.1:
                break
            start = np.random.default_rng([k, attempt]).normal(size=n)
            z = _inverse(diagonal, above, float(value), top, start, out[:, lead:k])
        out[:, k] = z / np.linalg.norm(z)
    return out


def _twisted(pivots: np.ndarray, factors: np.ndarray, value: float, top: float) -> np.ndarray:
    """The vector of L D L' - value (L unit lower bidiagonal) by twisted factorisation."""
    n, tiny = len(pivots), _EPS**2 * top + 1e-300
    for _ in range(4):
        down, s = np.zeros(n - 1), np.zeros(n)
        s[0] = -value
        for i in range(n - 1):
            d = pivots[i] + s[i]
            d = d if abs(d) > tiny else -tiny
            down[i] = pivots[i] * factors[i] / d
            s[i + 1] = down[i] * factors[i] * s[i] - value
        up, p = np.zeros(n - 1), np.zeros(n)
        p[-1] = pivots[-1] - value
        for i in range(n - 2, -1, -1):
            d = pivots[i] * factors[i] ** 2 + p[i + 1]
            d = d if abs(d) > tiny else -tiny
            t = pivots[i] / d
            up[i] = factors[i] * t
            p[i] = p[i + 1] * t - value
        rest = s + p + value
        r = int(np.argmin(np.abs(rest)))
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -up[i] * z[i]
        size = float(z @ z)
        if not np.isfinite(size):
            z = np.where(np.isfinite(z), z, 0.0)
            return z / max(np.linalg.norm(z), 1e-300)
        move = rest[r] / size
        if abs(move) <= 4 * _EPS * abs(value):
            break
        value += move
    return z / np.sqrt(size)


def _inverse(diagonal, above, value, top, start, others) -> np.ndarray:
    """Inverse iteration away from ``others``: for values that are equal to working precision."""
    b = np.diag(diagonal) + np.diag(above, 1)
    shifted = b.T @ b - (value + 8 * _EPS * top) * np.eye(len(diagonal))
    z = start
    for _ in range(3):
        z = z - others @ (others.T @ z)
        z = np.linalg.solve(shifted, z) if np.linalg.norm(z) > 1e-8 else z
        z = z / max(np.linalg.norm(z), 1e-300)
    return z


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, right singular vectors as columns) of a triangular factor, those above zero, falling."""
    if not r.size or not np.any(r):
        return np.zeros(0), np.zeros((r.shape[1], 0))
    scale = np.abs(r).max()
    diagonal, above, v = bidiagonal(r / scale)
    squares = dqds(diagonal, above)
    squares = squares[squares > (len(r) * _EPS * np.sqrt(squares[0])) ** 2]
    z = v @ singular_vectors(diagonal, above, squares)
    return squares * scale**2, z * np.where(z[np.abs(z).argmax(0), np.arange(z.shape[1])] < 0, -1.0, 1.0)


# Spark.


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _per_task(df: DataFrame, schema: str, start, add, end) -> DataFrame:
    """One row per task that has rows: ``start()``, then ``add(state, matrix)`` per block of ``ROWS``, ``end(state)``."""

    def run(batches):
        state = start()
        seen = False
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.column(0).slice(at, ROWS)
                state = add(state, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1))
                seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in end(state).items()})

    return df.mapInArrow(run, schema)


def totals(df: DataFrame, column: str) -> list:
    """Sums by place of a column of arrays of one length; the rows meet by place, so none is gathered whole."""
    each = df.select(F.posexplode(column).alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x"))
    return [r.x for r in sorted(each.collect(), key=lambda r: r.place)]


@dataclass(frozen=True)
class Model:
    """``sums`` over ``n`` vectors by place, variances of the components, their directions as columns, total variance."""

    n: int
    sums: np.ndarray
    variances: np.ndarray
    directions: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        if x.dtype.kind == "i" and int(np.abs(x).max(initial=0)) * self.n < 1 << 62:
            return (x * self.n - self.sums) / self.n  # exact up to the division
        return x - self.sums / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.variances))

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector has only finite entries and the most frequent length."""
    whole = f"size({column}) > 0 AND forall({column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    good = vectors.where(f"coalesce({whole}, false)")
    lengths = good.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size(column) == F.lit(lengths.d if lengths else 0))


def fit(vectors: DataFrame, column: str = "x", components: int = COMPONENTS) -> Model | None:
    """The model of ``column`` (arrays of long or double as ``usable`` leaves them); None without a row.

    Sums of long entries are exact.
    """
    x = vectors.select(column)
    kind = "long" if x.schema[column].dataType.elementType.typeName() == "long" else "double"
    sums = stage(_per_task(x, f"n long, sums array<{kind}>", lambda: [0, 0],
                           lambda s, m: [s[0] + len(m), s[1] + m.sum(0)], lambda s: {"n": s[0], "sums": s[1].tolist()}))
    n = sums.agg(F.sum("n")).first()[0]
    if not n:
        return None
    model = Model(n, np.array(totals(sums, "sums")), np.zeros(0), np.zeros((0, 0)), 0.0)
    d = len(model.sums)

    def triangle(r, m):
        return np.linalg.qr(np.vstack([r, m]), mode="r")

    factor = "r array<double>"
    empty = np.zeros((0, d))
    factors = stage(_per_task(x, factor, lambda: empty, lambda r, m: triangle(r, model.centred(m)), lambda r: {"r": r.ravel().tolist()}))
    left = factors.count()
    while left > FAN:
        gathered = factors.repartition(-(-left // FAN))
        factors = stage(_per_task(gathered, factor, lambda: empty,
                                  lambda r, m: triangle(r, m.reshape(-1, d)), lambda r: {"r": r.ravel().tolist()}))
        left = factors.count()
    r = np.linalg.qr(np.vstack([np.array(f.r).reshape(-1, d) for f in factors.collect()]), mode="r")
    squares, v = directions(np.vstack([r, np.zeros((d - len(r), d))]))
    k = min(components, len(squares))
    return Model(n, model.sums, squares[:k] / n, v[:, :k], float(squares.sum() / n))


def apply(vectors: DataFrame, model: Model, column: str = "x", name: str = "whitened") -> DataFrame:
    """``vectors`` with a column of whitened arrays, one entry a component."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields} | {name: "array<double>"}

    def run(batches):
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), ROWS):
                part = batch.slice(at, ROWS)
                y = model.whitened(_matrix(part.column(column), len(model.sums)))
                arrays = {c: part.column(c) for c in part.schema.names} | {name: pa.array(list(y), pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_arrays([arrays[c] for c in kinds], list(kinds))

    return vectors.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in kinds.items()))


def identity_error(vectors: DataFrame, model: Model, column: str = "x") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured on all rows."""
    k = len(model.variances)
    if not k:
        return 0.0

    def add(s, m):
        y = model.whitened(m)
        return s[0] + y.sum(0), s[1] + y.T @ y

    sums = stage(_per_task(vectors.select(column), "one array<double>, two array<double>", lambda: (np.zeros(k), np.zeros((k, k))),
                           add, lambda s: {"one": s[0].tolist(), "two": s[1].ravel().tolist()}))
    mean = np.array(totals(sums, "one")) / model.n
    two = np.array(totals(sums, "two")).reshape(k, k) / model.n
    return float(np.abs(two - np.outer(mean, mean) - np.eye(k)).max())


SCALE, SHIFT = 64, 1_000_000  # entries as whole numbers: floor(SCALE * entry) + SHIFT

DIGEST = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def digests(embeddings: DataFrame) -> DataFrame:
    """One row per usable vector (vec_id, embedding) and component, over the entries as whole numbers.

    ``deviation`` is the sum over places of (n * x - S) ** 2, null beyond the range of a long. Components without
    variance have no rows.
    """
    spark = embeddings.sparkSession
    good = usable(embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("e")), "e")
    x = F.transform("e", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    x = stage(good.select("vec_id", x.alias("x")))
    model = fit(x)
    if model is None:
        return spark.createDataFrame([], DIGEST)
    error, k = identity_error(x, model), len(model.variances)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                m = _matrix(part.column("x"), len(model.sums))
                size = len(m) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(np.repeat(np.arange(len(m)), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))),
                        pa.array(np.full(size, model.n)),
                        deviations(m, model).take(pa.array(np.repeat(np.arange(len(m)), k))),
                        pa.array(model.whitened(m).ravel()),
                        pa.array(np.tile(model.explained, len(m))),
                        pa.array(np.full(size, error)),
                    ],
                    [c.split()[0] for c in DIGEST.split(", ")],
                )

    return x.mapInArrow(run, DIGEST)


def deviations(m: np.ndarray, model: Model) -> pa.Array:
    """The sum over places of (n * x - S) ** 2 for each row, exactly; null beyond the range of a long."""
    far = int(np.abs(m).max(initial=0)) * model.n + int(np.abs(model.sums).max(initial=0))
    if far < 1 << 62:
        off = m * model.n - model.sums
        widest = int(np.abs(off).max(initial=0))
        if widest * widest * m.shape[1] < 1 << 63:
            return pa.array((off * off).sum(1))
    out = [sum((int(a) * model.n - int(s)) ** 2 for a, s in zip(row, model.sums)) for row in m]
    return pa.array([v if v < 1 << 63 else None for v in out], pa.int64())
