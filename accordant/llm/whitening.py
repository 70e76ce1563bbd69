"""Whitening directions of embeddings by blockwise QR and the qd algorithms.

Each task reduces its centred rows to a triangular factor, factors are stacked and reduced again in a tree
until one is left (its Gram matrix is that of all rows, which is never formed). That factor, as wide and as
high as a vector, is made bidiagonal by Householder reflections; dqds finds the singular values to high
relative accuracy, and twisted factorisations of the tridiagonal Gram matrix give the vectors that belong to
them. What the driver holds depends on the length of a vector alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm.text import stored

EPS = float(np.finfo(float).eps)
#: Factors that one task stacks at each level of the tree.
FAN_IN = 32
#: Vectors that are worked on at once.
BLOCK = 4096
#: Eigenvalues closer than this, relative to their size, are taken as one cluster.
CLUSTER = 1e-4
_SAFE = 1 << 62


# --- bidiagonal form, singular values and vectors of one small matrix -----------------------------------


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' r V, and V, by Householder reflections from both sides."""
    a, d = np.array(r, float), r.shape[0]
    v = np.eye(d)

    def reflector(x):
        w = x.copy()
        norm = np.linalg.norm(x)
        w[0] += np.copysign(norm, x[0])
        size = np.linalg.norm(w)
        return (w / size) if norm and size else None

    for k in range(d):
        if (w := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k < d - 1 and (w := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds_step(q: list, e: list, shift: float) -> tuple[list, list, float] | None:
    """One transformation of a qd array by ``shift``; None if a value would turn negative. Also the least d."""
    qs, es = [], []
    d = least = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        qs.append(top)
        if top:
            t = q[i + 1] / top
            es.append(e[i] * t)
            d = d * t - shift
        else:  # d and e are zero: the array splits here
            es.append(0.0)
            d = q[i + 1] - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*qs, d], es, least


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling.

    Shifts below the least value (a Gershgorin bound, or parts of the least d of the last step) are tried, the
    largest that keeps all values non-negative is taken, and no subtraction meets values of different sign, so
    that small values come out as accurately as large ones.
    """
    found, work = [], [(list(np.square(diagonal)), list(np.square(upper)), 0.0)]
    while work:
        q, e, moved = work.pop()
        least = 0.0
        for _ in range(200 * len(q) + 200):
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (moved + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], moved))
                q, e, least = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if q[0] * 1.5 < q[-1]:  # keep the small values at the end
                q.reverse()
                e.reverse()
            bound = max(0.0, min(q[-1] - np.sqrt(q[-1] * e[-1]), min(q)))
            for shift in (bound, 0.75 * least, 0.25 * least, 0.0):
                if (step := _dqds_step(q, e, shift)) is not None:
                    q, e, least = step
                    moved += shift
                    break
        else:
            raise ArithmeticError("singular values did not settle")
    return np.sort(np.array(found))[::-1]


def twisted(diag: np.ndarray, off: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pivots from the top, from the bottom, and at each twist (gamma) of the tridiagonal matrix less ``value``."""
    n, tiny = len(diag), EPS * EPS * max(np.max(np.abs(diag)), 1e-300)
    down, up = np.empty(n), np.empty(n)
    shifted = diag - value
    for i in range(n):
        down[i] = shifted[i] - (off[i - 1] ** 2 / down[i - 1] if i else 0.0)
        down[i] = down[i] or tiny
    for i in range(n - 1, -1, -1):
        up[i] = shifted[i] - (off[i] ** 2 / up[i + 1] if i < n - 1 else 0.0)
        up[i] = up[i] or tiny
    return down, up, down + up - shifted


def twisted_solve(diag: np.ndarray, off: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """The tridiagonal matrix less ``value`` solved for ``right`` (columns), from both ends to the best twist."""
    down, up, gamma = twisted(diag, off, value)
    k, n = int(np.argmin(np.abs(gamma))), len(diag)
    tiny = EPS * max(np.max(np.abs(diag)), 1e-300)
    y = right.astype(float).copy()
    for i in range(k):
        y[i + 1] -= off[i] / down[i] * y[i]
    for i in range(n - 1, k, -1):
        y[i - 1] -= off[i - 1] / up[i] * y[i]
    z = np.empty_like(y)
    z[k] = y[k] / (gamma[k] if abs(gamma[k]) > tiny else tiny)
    for i in range(k - 1, -1, -1):
        z[i] = (y[i] - off[i] * z[i + 1]) / down[i]
    for i in range(k + 1, n):
        z[i] = (y[i] - off[i - 1] * z[i - 1]) / up[i]
    return z


def twisted_vector(diag: np.ndarray, off: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """Unit vector for a single eigenvalue, with the value corrected by its Rayleigh quotient."""
    z = np.zeros(len(diag))
    for _ in range(3):
        down, up, gamma = twisted(diag, off, value)
        k = int(np.argmin(np.abs(gamma)))
        z[:] = 0
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -off[i] * z[i + 1] / down[i]
        for i in range(k + 1, len(z)):
            z[i] = -off[i - 1] * z[i - 1] / up[i]
        size = z @ z
        change = gamma[k] / size
        z /= np.sqrt(size)
        value += change
        if abs(change) <= 2 * EPS * abs(value):
            break
    return z, value


def _cluster_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal vectors of eigenvalues too close to be told apart one by one: iterated together with twisted
    solves at their middle, then rotated to the values within their space."""
    z = np.random.default_rng(len(diag)).standard_normal((len(diag), len(values)))
    full = np.diag(diag) + np.diag(off, 1) + np.diag(off, -1)
    middle = values.mean()
    for _ in range(6):
        z = np.linalg.qr(twisted_solve(diag, off, middle * (1 + EPS), np.linalg.qr(z)[0]))[0]
    inner, turn = np.linalg.eigh(z.T @ full @ z)
    return z @ turn[:, ::-1], inner[::-1]


def leading_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the largest singular values of ``r``, falling, and their right singular vectors as columns.

    Values that are zero up to rounding have no direction. Signs make the largest entry of a vector positive.
    """
    d = r.shape[0]
    scale = float(np.max(np.abs(r))) if r.size else 0.0
    if not scale:
        return np.empty(0), np.empty((d, 0))
    a, b, v = bidiagonalise(r / scale)
    values = dqds(a, b)
    values = values[: int(np.sum(values > (d * EPS) ** 2 * values[0]))]
    diag = np.square(a) + np.concatenate(([0.0], np.square(b)))
    off = a[:-1] * b
    # parts of the matrix that nothing joins are worked on alone
    cuts = np.flatnonzero(np.abs(off) <= EPS * np.sqrt(diag[:-1] * diag[1:]))
    bounds = [0, *(cuts + 1).tolist(), d]
    found: list[tuple[float, np.ndarray]] = []
    for lo, hi in zip(bounds, bounds[1:]):
        own_diag, own_off = diag[lo:hi], off[lo : hi - 1]
        own = values if len(bounds) == 2 else dqds(*_factor(own_diag, own_off))
        at = 0
        while at < min(len(own), count):
            end = at + 1
            while end < len(own) and own[end - 1] - own[end] <= CLUSTER * own[end - 1]:
                end += 1
            if end - at == 1:
                z, value = twisted_vector(own_diag, own_off, own[at])
                part = [(value, z)]
            else:
                z, inner = _cluster_vectors(own_diag, own_off, own[at:end])
                part = list(zip(inner.tolist(), z.T))
            for value, z in part:
                whole = np.zeros(d)
                whole[lo:hi] = z
                found.append((value, whole))
            at = end
    found.sort(key=lambda f: -f[0])
    found = found[: min(count, len(values))]
    vectors = v @ np.array([z for _, z in found]).T
    vectors *= np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return np.array([f[0] for f in found]) * scale**2, vectors


def _factor(diag: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bidiagonal Cholesky factor of a tridiagonal matrix without negative eigenvalues."""
    a, b = np.zeros(len(diag)), np.zeros(len(off))
    rest = diag[0]
    for i in range(len(diag)):
        a[i] = np.sqrt(max(rest, 0.0))
        if i < len(off):
            b[i] = off[i] / a[i] if a[i] else 0.0
            rest = diag[i + 1] - b[i] ** 2
    return a, b


# --- rows on Spark --------------------------------------------------------------------------------------


def scaled_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(``vec_id``, ``x``): vectors as longs, each entry floor(scale * c).

    Rows whose vector is null or empty, or holds a null, NaN or infinite entry, are dropped.
    """
    entry = F.col(vector_col).cast("array<double>")
    sound = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & sound).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(entry, lambda c: F.floor(F.lit(float(scale)) * c).cast("long")).alias("x"))


def _matrices(column: pa.Array, d: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(column), BLOCK):
        part = column.slice(at, BLOCK)
        yield at, part.flatten().to_numpy().reshape(len(part), d)


def _sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sums of every dimension."""
    def run(batches):
        total = [0] * d
        for batch in batches:
            for _, x in _matrices(batch.column(0), d):
                wide = int(np.max(np.abs(x.astype(float)))) * len(x) >= _SAFE
                total = [t + int(s) for t, s in zip(total, (x.astype(object) if wide else x).sum(0))]
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(d), pa.int32()), "s": pa.array(map(str, total), pa.string())})

    parts = fit.select("x").mapInArrow(run, "at int, s string")
    rows = parts.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # a row for each dimension
    sums = [0] * d
    for r in rows:
        sums[r["at"]] = int(r["s"])
    return sums


def _spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, in longs where they hold it, else in Python's integers."""
    if n * int(np.max(np.abs(x.astype(float)), initial=0)) < _SAFE and max(map(abs, sums)) < _SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _triangular(fit: DataFrame, n: int, sums: list[int], d: int) -> np.ndarray:
    """R of the centred rows: a factor for each task, then a tree of stacked factors."""
    def reduced(blocks: Iterator[np.ndarray]) -> bytes:
        r = np.zeros((0, d))
        for block in blocks:
            r = np.linalg.qr(np.vstack((r, block)), mode="r")
        return np.vstack((r, np.zeros((d - len(r), d)))).tobytes()

    def leaves(batches):
        r = reduced(_spread(x, n, sums).astype(float) / n for b in batches for _, x in _matrices(b.column(0), d))
        yield pa.RecordBatch.from_pydict({"r": pa.array([r], pa.binary())})

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        r = reduced(np.frombuffer(x.as_py()).reshape(d, d) for x in table.column("r"))
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int32()), "r": pa.array([r], pa.binary())})

    tasks = fit.rdd.getNumPartitions()
    parts = fit.select("x").mapInArrow(leaves, "r binary").select(F.spark_partition_id().alias("slot"), "r")
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int")).groupBy("slot").applyInArrow(merge, "slot int, r binary")
    tops = [np.frombuffer(bytes(row.r)).reshape(d, d) for row in parts.select("r").collect()]  # at most FAN_IN
    return np.frombuffer(reduced(iter(tops))).reshape(d, d)


def _identity_error(fit: DataFrame, whiten: Callable[[np.ndarray], np.ndarray], n: int, d: int, k: int) -> float:
    """Largest entry of the covariance of whitened rows, less the identity."""
    def run(batches):
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _matrices(batch.column(0), d):
                z = whiten(x)
                total += z.sum(0)
                square += z.T @ z
        flat = np.concatenate((total, square.ravel()))
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(flat)), pa.int32()), "s": pa.array(flat)})

    rows = fit.select("x").mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(k + k * k)
    for r in rows:
        flat[r["at"]] = r["s"]
    mean = flat[:k] / n
    return float(np.max(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)), initial=0.0))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """A row for each vector and component: (``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``).

    Vectors become longs (``scaled_rows``); the distinct ones are fitted, each once, so repeated rows and very
    common vectors weigh as one. Components are numbered from 1 by falling variance. Rows with an unsound
    vector are left out, ids may be null or repeat, and of vectors of several lengths the most frequent
    length counts (of equally frequent ones the longest), others are left out. A direction without variance is no
    component: one distinct vector, or an empty table, gives no rows. ``deviation`` is exact, and null where
    it exceeds a long.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    sound = scaled_rows(rows, id_col, vector_col, scale)
    lengths = sound.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = lengths["d"]
    sound = sound.filter(F.size("x") == d)
    fit = stored(sound.select("x").distinct(), "whitening-fit")
    n = fit.count()
    sums = _sums(fit, d)
    r = _triangular(fit, n, sums, d)
    squares, vectors = leading_directions(r, components)
    k = len(squares)
    if not k:
        return spark.createDataFrame([], schema)
    trace = float(np.sum(np.square(r)))
    explained = squares / trace
    turn = vectors / np.sqrt(squares / n)

    def project(x: np.ndarray) -> np.ndarray:
        return (_spread(x, n, sums).astype(float) / n) @ turn

    error = _identity_error(fit, project, n, d, k)

    def run(batches):
        for batch in batches:
            for at, x in _matrices(batch.column(1), d):
                ids = batch.column(0).slice(at, BLOCK)
                spread = _spread(x, n, sums)
                wide = spread.dtype == object or d * float(np.max(np.abs(spread.astype(float)), initial=0)) ** 2 >= _SAFE
                far = np.square(spread.astype(object) if wide else spread).sum(1).tolist()
                far = [f if f < 1 << 63 else None for f in far]
                repeat = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(repeat)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n, np.int64)),
                    pa.array(far, pa.int64()).take(pa.array(repeat)), pa.array((spread.astype(float) / n @ turn).ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return sound.mapInArrow(run, schema)
