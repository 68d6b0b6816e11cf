"""Embedding whitening from singular values of the centred rows, without forming their covariance.

Rows are centred exactly (they are whole numbers; the mean is a whole part and a rest). Tasks reduce their rows block by
block to a triangle by QR, and triangles of neighbouring tasks are reduced again until one is left. Householder steps make it
bidiagonal, dqds finds the singular values to high relative accuracy, and a twisted factorisation of each gives its
direction. Only the last triangle, as wide as a vector is long, reaches the driver.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import stage, table
from wayfare.llm.hardnegatives import is_usable, whole

COMPONENTS = 32
BLOCK_ROWS = 4096
GROUP_BYTES = 1 << 26  # of triangles or moments that meet in one task
EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
CLOSE = 1e-3  # relative distance under which neighbouring values are one cluster
PASSES = 60  # qd steps allowed per value; a few are the rule


# ---- the solver, on one triangle


def bidiagonal(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and upper off-diagonal of U' R V by Householder steps from both sides, and the vectors of V's reflections."""
    a = np.array(triangle, float)
    n = a.shape[1]
    right: list[np.ndarray] = []

    def reflector(x: np.ndarray) -> np.ndarray:
        """Unit v with (I - 2vv')x along the first axis; zero if x is there already."""
        v = x.copy()
        size = np.linalg.norm(x)
        if not np.any(x[1:]):
            return np.zeros_like(x)
        v[0] += np.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        w = np.zeros(n)
        if k < n - 2:
            w[k + 1 :] = reflector(a[k, k + 1 :])
            a[k:] -= 2 * np.outer(a[k:] @ w, w)
        right.append(w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step with a shift: new q and e, and the d's on the way, all positive if the shift is under the least value."""
    n, d = len(q), q[0] - shift
    new_q, new_e, ds = [0.0] * n, [0.0] * (n - 1), [d]
    for i in range(n - 1):
        new_q[i] = d + e[i]
        if new_q[i] == 0.0:
            d = q[i + 1] - shift
        else:
            t = q[i + 1] / new_q[i]
            new_e[i] = e[i] * t
            d = d * t - shift
        ds.append(d)
    new_q[-1] = d
    return new_q, new_e, ds


def singular_squares(diagonal: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling, by dqds.

    Steps without and with a shift take turns. The first kind gives the diagonal of an inverse, whose sum bounds the least
    value from below (a Newton step), so the shift that follows is safe. Products and sums of positive numbers only: small values come out as accurate as large ones.
    """
    found: list[float] = []
    work = [((np.asarray(diagonal, float) ** 2).tolist(), (np.asarray(off, float) ** 2).tolist(), 0.0)]
    while work:
        q, e, moved = work.pop()
        for _ in range(PASSES * max(1, len(q))):
            while len(q) > 1 and e[-1] <= EPS * EPS * (moved + q[-1]):
                found.append(moved + q.pop())
                e.pop()
            if len(q) == 1:
                found.append(moved + q[0])
                q = []
            cut = next((i for i, x in enumerate(e) if x <= EPS * EPS * (moved + min(q[i], q[i + 1]))), None) if q else None
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if not q:
                break
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]  # the least values belong at the end
            q, e, ds = _transform(q, e, 0.0)
            least = min(ds)
            if least <= 0.0:
                continue
            shift = (1.0 - 4 * len(q) * EPS) / sum(1.0 / d for d in ds)
            shifted = _transform(q, e, shift)
            if min(shifted[2]) > 0.0:
                q, e = shifted[0], shifted[1]
                moved += shift
        else:
            raise ArithmeticError("singular values did not settle")
    return np.sort(np.array(found))[::-1]


class Twisted:
    """Factorisations of B'B - value from the top and from the bottom, joined where the twist is least."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, value: float):
        self.a, self.b, n = diagonal, off, len(diagonal)
        least = TINY + EPS * EPS * max(value, float(np.max(diagonal**2, initial=0)))
        top, bottom = np.zeros(n), np.zeros(n)  # pivots from above and from below
        s, p = np.zeros(n), np.zeros(n)
        s[0] = -value
        for i in range(n - 1):
            top[i] = self._pivot(diagonal[i] ** 2 + s[i], least)
            s[i + 1] = off[i] ** 2 * s[i] / top[i] - value
        p[-1] = diagonal[-1] ** 2 - value
        for i in range(n - 2, -1, -1):
            bottom[i + 1] = self._pivot(off[i] ** 2 + p[i + 1], least)
            p[i] = diagonal[i] ** 2 * p[i + 1] / bottom[i + 1] - value
        gamma = s + p + value
        self.k = int(np.argmin(np.abs(gamma)))
        self.gamma = float(gamma[self.k])
        self.twist = self._pivot(self.gamma, least)
        self.down, self.up = diagonal[:-1] * off / top[:-1], diagonal[:-1] * off / bottom[1:]  # multipliers above the twist and below it
        self.top, self.bottom = top, bottom

    @staticmethod
    def _pivot(x: float, least: float) -> float:
        return x if abs(x) > least else (-least if x < 0 else least)

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.a))
        z[self.k] = 1.0
        for i in range(self.k - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(self.k, len(z) - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z

    def solve(self, y: np.ndarray) -> np.ndarray:
        """x with (B'B - value) x = y, one inverse iteration."""
        x, k, n = y.copy(), self.k, len(y)
        for i in range(k):
            x[i + 1] -= self.down[i] * x[i]
        for i in range(n - 1, k, -1):
            x[i - 1] -= self.up[i - 1] * x[i]
        x[:k] /= self.top[:k]
        x[k + 1 :] /= self.bottom[k + 1 :]
        x[k] /= self.twist
        for i in range(k - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(k, n - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x


def _direction(diagonal: np.ndarray, off: np.ndarray, value: float, close: list[np.ndarray], rng: np.random.Generator) -> np.ndarray:
    """Unit vector of one value, at right angles to those of its cluster found before."""

    def away(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for z in close:
                x = x - (z @ x) * z
        size = np.linalg.norm(x)
        return x / size if size > 0 else x

    factors = Twisted(diagonal, off, value)
    x = factors.vector()
    for _ in range(2):  # a Rayleigh step where the value can still be told more exactly
        step = factors.gamma / float(x @ x)
        if close or abs(step) <= 2 * EPS * abs(value):
            break
        factors = Twisted(diagonal, off, value + step)
        x = factors.vector()
        value += step
    if not close:
        return x / np.linalg.norm(x)
    kept = away(x / np.linalg.norm(x))
    if abs(kept @ x) < 0.5 * np.linalg.norm(x):  # the cluster's earlier vectors hold most of it: start afresh
        kept = away(rng.standard_normal(len(x)))
    for _ in range(3):
        solved = factors.solve(kept)
        largest = np.max(np.abs(solved))
        if not np.isfinite(largest) or largest == 0:
            break
        kept = away(solved / largest)
    return kept


def separated(diagonal: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same matrix up to rotations from the left, which leave right vectors alone, with zeros where it falls apart.

    Entries at rounding level of the largest become zero, and a row whose diagonal entry is zero is rotated into the rows below.
    """
    a, b = np.array(diagonal, float), np.array(off, float)
    least = EPS * float(np.max(np.abs(np.concatenate([a, b])), initial=0))
    a[np.abs(a) <= least] = 0.0
    b[np.abs(b) <= least] = 0.0
    for k in np.flatnonzero(a[:-1] == 0).tolist():
        carried, b[k] = b[k], 0.0
        for j in range(k + 1, len(a)):
            if carried == 0.0:
                break
            size = float(np.hypot(a[j], carried))
            cosine, sine, a[j] = a[j] / size, carried / size, size
            if j < len(b):
                carried, b[j] = -sine * b[j], cosine * b[j]
    return a, b


def directions(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest squared singular values of a bidiagonal matrix and the right vectors, as columns.

    The matrix is cut where it falls apart, and each part has its own values: vectors of different parts are at right
    angles by their places. Within a part, vectors of values closer than CLOSE are kept apart by inverse iteration.
    """
    a, b = separated(diagonal, off)
    n = len(a)
    edges = [0, *(np.flatnonzero(b == 0) + 1).tolist(), n] if n else [0]
    rng = np.random.default_rng(1)
    pairs = []
    for first, last in zip(edges, edges[1:]):
        own, between = a[first:last], b[first : last - 1]
        close: list[np.ndarray] = []
        before = None
        for value in singular_squares(own, between)[:wanted].tolist():
            if before is None or before - value > CLOSE * before:
                close = []
            before = value
            close.append(_direction(own, between, value, close, rng) if last - first > 1 else np.ones(1))
            placed = np.zeros(n)
            placed[first:last] = close[-1]
            pairs.append((value, placed))
    pairs = sorted(pairs, key=lambda pair: -pair[0])[:wanted]
    return np.array([value for value, _ in pairs]), np.array([z for _, z in pairs]).reshape(len(pairs), n).T


def singular_pairs(triangle: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest squared singular values of a matrix of full rows and its right singular vectors, as columns."""
    diagonal, off, right = bidiagonal(triangle)
    squares, vectors = directions(diagonal, off, wanted)
    for w in reversed(right):
        vectors -= 2 * np.outer(w, w @ vectors)
    return squares, vectors


# ---- over Spark


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), np.int64)


@dataclass
class Centre:
    """Number of rows and exact sum of each entry; whole part and rest of the means."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.means = np.array([s // self.n for s in self.sums], np.int64)
        self.rests = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.means).astype(float) - self.rests / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the entries of (n x - sum)^2, exact; null where it exceeds 64 bits."""
        apart = x - self.means
        largest = float(np.abs(apart).max(initial=0)) + 1
        if (largest * self.n) ** 2 * max(1, x.shape[1]) < 2**62:
            return ((apart * self.n - self.rests) ** 2).sum(axis=1).tolist()
        rests = self.rests.tolist()
        totals = [sum((a * self.n - r) ** 2 for a, r in zip(line, rests)) for line in apart.tolist()]
        return [t if t < 2**63 else None for t in totals]


def _bytes_of(arrays: list[np.ndarray]) -> list[bytes]:
    return [np.ascontiguousarray(a, float).tobytes() for a in arrays]


def merged(parts: DataFrame, combine, width: int) -> tuple[int, np.ndarray] | None:
    """Combine staged rows (part int, n long, value binary) in a tree until one is left. A task meets GROUP_BYTES of them at most.

    ``combine(ns, values)`` gives the count and the value of several; values are matrices of ``width`` columns.
    """
    fan = max(2, GROUP_BYTES // (8 * max(1, width * width)))

    def work(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        values = [np.frombuffer(v, float).reshape(-1, width) for v in group.column("value").to_pylist()]
        n, value = combine(group.column("n").to_pylist(), values)
        first = group.column("part")[0].as_py() // fan
        return pa.table({"part": pa.array([first], pa.int32()), "n": pa.array([n], pa.int64()), "value": pa.array(_bytes_of([value]), pa.binary())})

    while parts.count() > 1:
        ranked = parts.groupBy(F.floor(F.col("part") / fan).cast("int").alias("group"))
        parts = stage(ranked.applyInArrow(work, "part int, n long, value binary"), "merged")
    last = parts.first()
    return (last.n, np.frombuffer(last.value, float).reshape(-1, width)) if last else None


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r") if rows.size else np.zeros((0, rows.shape[1]))


def _stacked(ns: list[int], triangles: list[np.ndarray]) -> tuple[int, np.ndarray]:
    return sum(ns), _triangle(np.concatenate(triangles))


def triangle(rows: DataFrame, centre: Centre) -> np.ndarray:
    """R of the centred rows: each task reduces its own block by block, then triangles meet in a tree."""
    width = len(centre.sums)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros((0, width)), 0
        for batch in batches:
            for first in range(0, len(batch), BLOCK_ROWS):
                x = centre.centred(_rows(batch.column(0).slice(first, BLOCK_ROWS)))
                held, n = _triangle(np.concatenate([held, x])), n + len(x)
        if n:
            yield _part(n, held)

    found = merged(stage(rows.select("x").mapInArrow(work, "part int, n long, value binary"), "triangles"), _stacked, width)
    return found[1] if found else np.zeros((0, width))


def centre_of(rows: DataFrame) -> Centre | None:
    """Count and exact sums of all rows: a row per task and entry is added up by Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(0))
            entries = pa.array(np.arange(-1, x.shape[1]), pa.int32())  # entry -1 counts the rows
            yield pa.RecordBatch.from_arrays([entries, pa.array(np.concatenate([[len(x)], x.sum(axis=0)]), pa.int64())], ["entry", "total"])

    summed = rows.select("x").mapInArrow(work, "entry int, total long").groupBy("entry").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = {entry: int(total) for entry, total in summed.collect()}  # a row per entry of a vector
    return Centre(totals[-1], [totals[i] for i in range(len(totals) - 1)]) if totals.get(-1) else None


def _part(n: int, value: np.ndarray) -> pa.RecordBatch:
    part = pa.array([TaskContext.get().partitionId()], pa.int32())
    return pa.RecordBatch.from_arrays([part, pa.array([n], pa.int64()), pa.array(_bytes_of([value]), pa.binary())], ["part", "n", "value"])


def _moments(x: np.ndarray) -> np.ndarray:
    """Mean, then the products of the rows centred on it."""
    mean = x.mean(axis=0)
    apart = x - mean
    return np.concatenate([mean[None], apart.T @ apart])


def _joined_moments(ns: list[int], values: list[np.ndarray]) -> tuple[int, np.ndarray]:
    n, held = ns[0], values[0]
    for m, value in zip(ns[1:], values[1:]):
        step = value[0] - held[0]
        products = held[1:] + value[1:] + np.outer(step, step) * (n * m / (n + m))
        n, held = n + m, np.concatenate([(held[0] + step * (m / (n + m)))[None], products])
    return n, held


@dataclass
class Whitening:
    """Centre, eigenvalues and eigenvectors (columns, largest first) of the covariance, and the sum of all its eigenvalues."""

    centre: Centre
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues))

    def identity_error(self, rows: DataFrame) -> float:
        """Largest entry of the covariance of all whitened rows less the identity, measured on the rows."""
        k = len(self.eigenvalues)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = np.zeros((k + 1, k)), 0
            for batch in batches:
                for first in range(0, len(batch), BLOCK_ROWS):
                    x = self.whitened(_rows(batch.column(0).slice(first, BLOCK_ROWS)))
                    n, held = _joined_moments([n, len(x)], [held, _moments(x)]) if n else (len(x), _moments(x))
            if n:
                yield _part(n, held)

        found = merged(stage(rows.select("x").mapInArrow(work, "part int, n long, value binary"), "moments"), _joined_moments, k) if k else None
        return float(np.max(np.abs(found[1][1:] / found[0] - np.eye(k)))) if found else 0.0

    def apply(self, rows: DataFrame) -> DataFrame:
        """vec_id, the exact deviation and the whitened entries of every row."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _rows(batch.column(1))
                values = self.whitened(x)
                flat = pa.array(values.reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * values.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(self.centre.deviations(x), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

        return rows.select("vec_id", "x").mapInArrow(work, "vec_id long, deviation long, whitened array<double>")


def of_usual_length(rows: DataFrame) -> DataFrame:
    """Only rows whose vector has the most frequent length, the longer one on a tie: a covariance needs one length."""
    sizes = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.filter(F.size("x") == (sizes.width if sizes else 0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the rows' vectors ``x`` (whole numbers of one length); None if there is no row.

    Directions without variance, at the rounding level of the largest, can't be whitened and are left out: a table whose
    rows are all equal, a single row included, has no component. Repeated rows count as often as they occur.
    """
    centre = centre_of(rows)
    if centre is None:
        return None
    width = len(centre.sums)
    reduced = triangle(rows, centre)
    trace = float((reduced**2).sum()) / centre.n
    squares, vectors = singular_pairs(np.concatenate([reduced, np.zeros((max(0, width - len(reduced)), width))]), components)
    real = squares > (squares.max(initial=0) * (width * EPS) ** 2)
    return Whitening(centre, squares[real] / centre.n, vectors[:, real], trace)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings, up to 32 a row, from the covariance of all of them.

    Rows whose vector is null or has a null or non-finite entry are dropped; so are vectors of another length than most.
    Entries count as floor(64 * entry) + 1000000. Rows with a null or repeated vec_id are rows like others. An empty table, and one
    without variance, give no row.
    """
    usable = table(spark, sf_dir, "embeddings").filter(is_usable(F.col("embedding")))
    x = F.transform(whole(F.col("embedding"), 64), lambda c: c + 1_000_000)
    rows = of_usual_length(usable.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")))
    model = fit(rows)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e)) for e in model.eigenvalues / model.trace])
    listed = model.apply(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return listed.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error(rows)).alias("identity_error"),
    )
