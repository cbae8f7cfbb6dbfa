"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers ``floor(1024 * c) + 100000``; the fit list is all
usable vectors.  The steps:

* every task reduces its centred rows block by block to one triangular factor
  (QR of the factor so far above the next block); the factors are merged the
  same way in two rounds, so only one ``d x d`` factor R reaches the driver;
* Householder reflections turn R into an upper bidiagonal matrix;
* dqds steps (differential quotient-difference with shifts) give all its
  singular values to high relative accuracy;
* twisted factorisations give the right singular vector of each leading value,
  which the reflections carry back to a whitening direction;
* every task projects its centred rows.  The covariance of the result is merged
  from centred block moments and compared with the identity.

Centring is exact: a row is ``n * x - S`` in whole numbers before it is divided
by ``n``.  The factor has d * d numbers (8 MB at 1,024 dimensions).

Defined results: rows whose vector is null, empty or holds null or non-finite
entries are dropped, and so are vectors of another length than most (ties: the
longest); entries beyond ``LARGEST`` count as that; a null id stays null; equal
rows and ids are kept each; components without variance (fewer than
``components`` dimensions or distinct directions, one row) are left out, so a
table of equal vectors gives no row, like an empty one; a deviation beyond a
long is null.  Only the id and vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import map_batches, merge_states, state_batch

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Whole numbers up to here are exact as doubles.
LARGEST = 1 << 52
EPS = np.finfo(float).eps
_LONG = (1 << 63) - 1


# ---------------------------------------------------------------------------
# Rows
# ---------------------------------------------------------------------------

def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors without null or non-finite entries."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(math.inf)), F.lit(False)))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)


def _whole(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    c = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * c), -LARGEST, LARGEST).astype(np.int64) + SHIFT


@dataclass
class Centre:
    """Size and per-dimension sums of the fit list."""

    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: 64-bit where that is wide enough, else Python's whole numbers."""
        high = max(map(abs, self.sums)) + self.n * int(np.abs(x).max(initial=0))
        if high < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n

    def squares(self, x: np.ndarray) -> list[int | None]:
        """Sum of squared deviations of each row; None beyond a long."""
        d = self.deviations(x)
        if d.dtype == object or x.shape[1] * float(np.abs(d).max(initial=0)) ** 2 >= 2.0 ** 62:
            d = d.astype(object)
        return [int(v) if v <= _LONG else None for v in (d * d).sum(axis=1)]


def _numbers(values: list[int]) -> bytes:
    return ",".join(map(str, values)).encode()


def centre(rows: DataFrame, dims: int) -> Centre:
    def add(states: Iterator[bytes]) -> bytes | None:
        total = None
        for s in states:
            v = list(map(int, s.split(b",")))
            total = v if total is None else [a + b for a, b in zip(total, v)]
        return None if total is None else _numbers(total)

    def run(batches):
        total = [0] * (dims + 1)
        for b in batches:
            x = _whole(b, dims)
            wide = x.astype(object) if len(x) and int(np.abs(x).max()) * len(x) >= 1 << 62 else x
            total = [a + int(c) for a, c in zip(total, [len(x), *wide.sum(axis=0)])]
        if total[0]:
            yield state_batch(_numbers(total))

    n, *sums = map(int, merge_states(map_batches(rows, ["v"], "state binary", run), add).split(b","))
    return Centre(n, sums)


def triangular_factor(rows: DataFrame, at: Centre) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    dims = len(at.sums)

    def stack(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        r = None
        for block in blocks:
            if len(block):
                r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
        return r

    def merge(states: Iterator[bytes]) -> bytes | None:
        r = stack(np.frombuffer(s).reshape(-1, dims) for s in states)
        return None if r is None else r.tobytes()

    def run(batches):
        r = stack(at.centred(_whole(b, dims)) for b in batches)
        if r is not None:
            yield state_batch(r.tobytes())

    r = np.frombuffer(merge_states(map_batches(rows, ["v"], "state binary", run), merge)).reshape(-1, dims)
    return np.vstack([r, np.zeros((dims - len(r), dims))])


# ---------------------------------------------------------------------------
# Singular values and right singular vectors
# ---------------------------------------------------------------------------

def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector of the reflection that leaves only the first entry of ``x``."""
    if not np.any(x[1:]):
        return None
    top = np.abs(x).max()
    v = x / top
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with ``r = U B V'``."""
    a, n = r.copy(), len(r)
    right = np.eye(n)
    for k in range(n):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = _reflector(a[k, k + 1:]) if k + 2 < n else None
        if v is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2 * np.outer(right[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _differences(q: list[float], e: list[float], shift: float):
    """One dqds step: (new q, new e, all d), or None if the shift was too large."""
    new_q, new_e, ds = [], [], []
    d = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        ds.append(d)
        up = d + e[i]
        ratio = q[i + 1] / up if up else 0.0
        new_q.append(up)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift if up else q[i + 1] - shift
    if d < 0:
        return None
    ds.append(d)
    return [*new_q, d], new_e, ds


def _bounds(ds: list[float]) -> tuple[float, float]:
    """Lower and upper bound of the smallest eigenvalue, from the ``d`` of a step without shift."""
    high = min(ds)
    return (1 / sum(1 / d for d in ds) * (1 - 8 * EPS * len(ds)) if high > 0 else 0.0), high


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, ascending, by dqds.

    The smallest value left is approached from below: a step without shift
    bounds it on both sides, a bold shift between the bounds is tried first and
    the lower bound, which is always safe, last.
    """
    small = (100 * EPS) ** 2
    found, work = [], [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while work:
        q, e, base = work.pop()
        while q:
            if len(q) == 1:
                found.append(base + q[0])
                break
            if e[-1] <= small * (base + q[-1]):
                found.append(base + q.pop())
                e.pop()
                continue
            split = next((i for i in range(len(e)) if e[i] <= small * (base + min(q[i], q[i + 1]))), None)
            if split is not None:
                work.append((q[:split + 1], e[:split], base))
                q, e = q[split + 1:], e[split + 1:]
                continue
            plain = _differences(q, e, 0.0)
            low, high = _bounds(plain[2])
            step = None
            if high - low > 0.1 * high:
                for part in (0.9, 0.5):
                    step = _differences(q, e, shift := low + part * (high - low))
                    if step:
                        break
            if not step:
                step = _differences(q, e, shift := low)
            if not step or shift <= 0 or base + shift == base:
                step, shift = plain, 0.0
            q, e, base = step[0], step[1], base + shift
    return np.sort(np.array(found))


@dataclass
class Twisted:
    """``L D L' - value`` of one unreduced block, factorised from both ends to meet at any row."""

    lower: list[float]    # multipliers from the top
    upper: list[float]    # multipliers from the bottom
    down: list[float]     # pivots from the top
    up: list[float]       # pivots from the bottom
    gamma: np.ndarray     # pivot at the twist, by row

    @classmethod
    def at(cls, diagonal: np.ndarray, above: np.ndarray, value: float) -> "Twisted":
        n = len(diagonal)
        d = [float(x) ** 2 for x in diagonal]
        l = [float(b) / float(a) for a, b in zip(diagonal, above)]  # noqa: E741
        tiny = EPS * EPS * max(d)
        s, p = [-value] + [0.0] * (n - 1), [0.0] * (n - 1) + [d[-1] - value]
        lower, upper, down, up = [0.0] * (n - 1), [0.0] * (n - 1), [0.0] * n, [0.0] * n
        for i in range(n - 1):
            down[i] = s[i] + d[i] or tiny
            lower[i] = d[i] * l[i] / down[i]
            s[i + 1] = lower[i] * l[i] * s[i] - value
        for i in range(n - 2, -1, -1):
            up[i + 1] = d[i] * l[i] ** 2 + p[i + 1] or tiny
            upper[i] = l[i] * d[i] / up[i + 1]
            p[i] = p[i + 1] * d[i] / up[i + 1] - value
        gamma = np.array(s) + np.array(p) + value
        return cls(lower, upper, down, up, np.where(gamma == 0, tiny, gamma))

    def solve(self, right: np.ndarray, twist: int) -> np.ndarray:
        n, w = len(right), right.astype(float)
        for i in range(1, twist + 1):
            w[i] -= self.lower[i - 1] * w[i - 1]
        for i in range(n - 2, twist - 1, -1):
            w[i] -= self.upper[i] * w[i + 1]
        pivots = np.array([*self.down[:twist], self.gamma[twist], *self.up[twist + 1:]])
        w /= pivots
        for i in range(twist - 1, -1, -1):
            w[i] -= self.lower[i] * w[i + 1]
        for i in range(twist + 1, n):
            w[i] -= self.upper[i - 1] * w[i - 1]
        return w / np.linalg.norm(w)


def _vector(twisted: Twisted, near: list[np.ndarray]) -> np.ndarray:
    """The vector at the best twist, kept orthogonal to those of close values before it."""
    order = np.argsort(np.abs(twisted.gamma), kind="stable")
    away = lambda z: z - sum(((u @ z) * u for u in near), np.zeros(len(z)))
    best = None
    for twist in order[:len(near) + 2]:
        start = np.zeros(len(order))
        start[twist] = 1.0
        z = away(away(twisted.solve(start, int(twist))))
        size = np.linalg.norm(z)
        if best is None or size > best[0]:
            best = (size, z, int(twist))
        if size > 0.1:
            break
    z = best[1] / best[0]
    for _ in range(2):
        z = away(away(twisted.solve(z, best[2])))
        z /= np.linalg.norm(z)
    return z


def leading_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` squared singular values of ``r``, falling, and their right vectors as columns.

    Values that cannot be told from zero are left out.
    """
    n = len(r)
    top = np.abs(r).max(initial=0)
    if top == 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, above, right = bidiagonalise(r / top)
    norm = max(np.abs(diagonal).max(), np.abs(above).max(initial=0))
    diagonal = np.where(np.abs(diagonal) < EPS * norm, EPS * norm, diagonal)
    above = np.where(np.abs(above) < EPS * norm, 0, above)
    edges = [0, *(np.flatnonzero(above == 0) + 1).tolist(), n]
    pairs = []
    for lo, hi in zip(edges, edges[1:]):
        values = squared_singular_values(diagonal[lo:hi], above[lo:hi - 1])
        pairs += [(v, lo, hi) for v in values]
    pairs.sort(key=lambda p: (-p[0], p[1]))
    floor = (n * EPS) ** 2 * pairs[0][0]
    kept = [p for p in pairs[:count] if p[0] > max(floor, (n * EPS * norm) ** 2)]
    vectors: list[tuple[float, int, np.ndarray]] = []
    for value, lo, hi in kept:
        near = [z for v, at, z in vectors if at == lo and v - value <= 1e-3 * v]
        z = _vector(Twisted.at(diagonal[lo:hi], above[lo:hi - 1], value), near) if hi - lo > 1 else np.ones(1)
        vectors.append((value, lo, z))
    columns = np.zeros((n, len(kept)))
    for j, (_, lo, z) in enumerate(vectors):
        columns[lo:lo + len(z), j] = z
    return np.array([v for v, _, _ in vectors]) * top ** 2, right @ columns


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------

@dataclass
class Whitening:
    centre: Centre
    values: np.ndarray       # eigenvalues of the covariance, falling
    directions: np.ndarray   # one column per component
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.directions / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows`` (vec_id, v of one length); None without a row."""
    size = rows.select(F.size("v").alias("d")).limit(1).collect()
    if not size:
        return None
    at = centre(rows, size[0].d)
    r = triangular_factor(rows, at)
    squares, directions = leading_directions(r, components)
    return Whitening(at, squares / at.n, directions, squares / max((r * r).sum(), np.finfo(float).tiny))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k, dims = len(model.values), len(model.centre.sums)

    def join(parts: Iterator[np.ndarray]) -> np.ndarray | None:
        total = None
        for p in parts:  # count, means, centred products
            if total is None:
                total = p.copy()
                continue
            n, m = total[0], p[0]
            gap = p[1:1 + k] - total[1:1 + k]
            total[1 + k:] += p[1 + k:] + (np.outer(gap, gap) * (n * m / (n + m))).ravel()
            total[1:1 + k] += gap * (m / (n + m))
            total[0] += m
        return total

    def moments(x: np.ndarray) -> np.ndarray:
        y = model.project(x)
        mean = y.mean(axis=0)
        return np.concatenate([[len(y)], mean, ((y - mean).T @ (y - mean)).ravel()])

    def run(batches):
        total = join(moments(_whole(b, dims)) for b in batches if b.num_rows)
        if total is not None:
            yield state_batch(total.tobytes())

    def merge(states: Iterator[bytes]) -> bytes | None:
        total = join(np.frombuffer(s) for s in states)
        return None if total is None else total.tobytes()

    total = np.frombuffer(merge_states(map_batches(rows, ["v"], "state binary", run), merge))
    return float(np.abs(total[1 + k:].reshape(k, k) / total[0] - np.eye(k)).max())


_COLUMNS = [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
            ("explained", pa.float64()), ("identity_error", pa.float64())]
_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and leading component."""
    rows = usable(embeddings)
    most = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.where(F.size("v") == (most.d if most else 0))
    model = fit(rows, components) if most else None
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], _SCHEMA)
    error, k, dims = identity_error(rows, model), len(model.values), most.d
    schema = pa.schema(_COLUMNS)

    def run(batches):
        for b in batches:
            x = _whole(b, dims)
            every = np.repeat(np.arange(len(x)), k)
            columns = [b.column(0).take(pa.array(every)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(len(every), model.centre.n),
                       pa.array(model.centre.squares(x), pa.int64()).take(pa.array(every)), model.project(x).ravel(),
                       np.tile(model.explained, len(x)), np.full(len(every), error)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, _COLUMNS)], schema=schema)

    return map_batches(rows, ["vec_id", "v"], _SCHEMA, run)
