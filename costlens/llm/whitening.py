"""Embedding whitening with components from FEAST contour integration.

Entries become whole numbers, so sums, centres and the covariance are exact: one pass
sums the dimensions, a second one sums the products of the entries less their rounded
means, in tasks, then in Spark by pair of dimensions. What reaches the driver are the
sums per dimension and per pair of dimensions, whatever the number of rows.

The covariance V (dimension x dimension) then goes through FEAST. Counting the negative
pivots of V - s I (Sylvester's law of inertia) places an interval over the largest
eigenvalues and cuts it into slices of at most ``SLICE`` eigenvalues. On each slice a
Gauss-Legendre quadrature over a half circle of complex shifted solves
(z I - V) X = Y projects a block onto the slice's eigenspace, Rayleigh-Ritz extracts the
pairs, and both are repeated until the residuals no longer fall. A slice whose number of
Ritz values differs from its inertia count is run again with a larger block.

A row is used if its vector is not null, holds no null or non-finite entry, and has as
many entries as most such vectors (ties: the longer); others have no result. An entry c
becomes floor(scale * c) + shift, held to +-2^52 where it lies beyond. Components whose
eigenvalue is rounding noise (a constant dimension, fewer rows than components) are left
out, so there may be fewer than asked for, and none when all vectors are equal. Among
equal eigenvalues any orthonormal basis serves, the same for all rows. ``deviation`` is
null where it does not fit a long. Empty table: no rows. Rows repeated or without an id
each have their result. Other columns, whatever their names, are ignored."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import cut

SCALE, SHIFT = 1024, 100_000
#: Eigenvalues in one slice, quadrature nodes on the half circle, and refinements at most.
SLICE, NODES, ROUNDS = 8, 8, 40
_LIMIT = 2 ** 52
_DDL = "vec_id long, n long, deviation long, whitened array<double>"


# --- eigenpairs on an interval ---------------------------------------------------

def above(v: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of symmetric ``v`` over ``shift``: the positive
    pivots of an L D L' factorisation with 1 x 1 and 2 x 2 pivots (Bunch-Parlett)."""
    a = v - shift * np.eye(len(v))
    count, alpha = 0, (1 + math.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        k = int(diagonal.argmax())
        i, j = divmod(int(np.abs(a).argmax()), len(a))
        if a[i, j] == 0:
            return count
        if diagonal[k] >= alpha * abs(a[i, j]):
            pivots = [k]
            count += a[k, k] > 0
        else:
            pivots = [i, j]  # one positive and one negative eigenvalue
            count += 1
        rest = np.setdiff1d(np.arange(len(a)), pivots)
        block = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - block @ np.linalg.solve(a[np.ix_(pivots, pivots)], block.T)
    return count


def slices(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) from the top down that together hold
    the ``wanted`` largest eigenvalues of ``v``, and more only where those are close."""
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-12)  # Gershgorin
    fine = top * 1e-13
    low, high = -fine, top
    for _ in range(60):
        if above(v, low) <= wanted + SLICE or high - low <= fine:
            break
        mid = (low + high) / 2
        low, high = (mid, high) if above(v, mid) >= wanted else (low, mid)
    out, todo = [], [(low, top, above(v, low), 0)]
    while todo:
        a, b, under, over = todo.pop()
        if under == over:
            continue
        if under - over <= SLICE or b - a <= fine:
            out.append((a, b, under - over))
            continue
        mid = (a + b) / 2
        at = above(v, mid)
        todo += [(a, mid, under, at), (mid, b, at, over)]
    return out


def feast(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` in (low, high], values rising."""
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (1 - nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    points = centre + radius * np.exp(1j * angle)
    norm, size, rng = np.abs(v).sum(axis=1).max(), min(d, 2 * count + 4), np.random.default_rng(13)
    while True:
        basis, best, still = np.linalg.qr(rng.standard_normal((d, size)))[0], np.inf, 0
        for _ in range(ROUNDS):
            if size < d:
                filtered = np.zeros((d, size))
                for z, w, t in zip(points, weights, angle):
                    filtered += w / 2 * (radius * np.exp(1j * t) * np.linalg.solve(z * np.eye(d) - v, basis)).real
                basis = np.linalg.qr(filtered)[0]
            values, turn = np.linalg.eigh(basis.T @ v @ basis)
            basis = basis @ turn
            inside = (values > low) & (values <= high)
            worst = np.abs(v @ basis[:, inside] - basis[:, inside] * values[inside]).max(initial=0) / norm
            if inside.sum() == count and (worst < 1e-15 or worst >= best / 2):
                still += 1
                if still == 2 or size == d:
                    break
            best = min(best, worst) if inside.sum() == count else np.inf
        if inside.sum() == count or size == d:  # none missed; a block of all dimensions spans everything
            return values[inside], basis[:, inside]
        size = min(d, 2 * size)


def components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of covariance ``v``, falling, and their unit vectors as
    columns: ``wanted`` of them, fewer where the others are rounding noise."""
    if not len(v) or not np.abs(v).max(initial=0):
        return np.zeros(0), np.zeros((len(v), 0))
    parts = [feast(v, *x) for x in slices(v, min(wanted, len(v)))]
    basis = np.linalg.qr(np.hstack([x for _, x in parts]))[0]  # of one slice to another's
    values, turn = np.linalg.eigh(basis.T @ v @ basis)
    values, basis = values[::-1][:wanted], (basis @ turn)[:, ::-1][:, :wanted]
    real = values > values[0] * len(v) * 1e-13
    return values[real], basis[:, real]


# --- sums over the rows ----------------------------------------------------------

def _whole(batch: pa.RecordBatch, scale: int, shift: int) -> np.ndarray:
    """The vectors of column ``v`` as whole numbers, a row each."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return (np.clip(np.floor(flat * scale), -_LIMIT, _LIMIT).astype(np.int64) + shift).reshape(batch.num_rows, -1)


def _products(y: np.ndarray) -> np.ndarray:
    """y'y exactly: in doubles where all sums stay under 2^53, else in Python numbers."""
    step = int(2 ** 53 // max(1, int(np.abs(y).max(initial=0)) ** 2))
    if not step:
        wide = y.astype(object)
        return wide.T.dot(wide)
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), step):
        part = y[at:at + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _sums(scale: int, shift: int, centre: list[int] | None):
    """(i, j, total) of a partition: the sums of the products of dimensions i <= j less
    ``centre``; without one, the sums of the dimensions, and at i = -1 the rows."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = _whole(b, scale, shift)
                if centre is not None:
                    part = _products(x - np.array(centre))
                else:  # rows of a batch times 2^52 stay under 2^63 only up to 2^10 rows
                    part = sum(x[at:at + 1024].sum(axis=0).astype(object) for at in range(0, len(x), 1024))
                part = np.append(part, b.num_rows) if centre is None else part
                total = part if total is None else total + part
        if total is not None:
            i, j = (np.append(np.arange(len(total) - 1), -1),) * 2 if centre is None else np.triu_indices(len(total))
            value = total if centre is None else total[i, j]
            yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "total": pa.array([str(x) for x in value])})
    return run


def _gather(vectors: DataFrame, scale: int, shift: int, centre: list[int] | None = None) -> dict[tuple[int, int], int]:
    parts = vectors.select("v").mapInArrow(_sums(scale, shift, centre), "i int, j int, total string")
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {(r["i"], r["j"]): int(r["total"]) for r in sums.toLocalIterator()}


def _covariance(sums: dict[tuple[int, int], int], rest: list[int], n: int) -> np.ndarray:
    """Of products about a rounded mean; ``rest`` is what the sums keep of it."""
    v = np.zeros((len(rest),) * 2)
    for (i, j), total in sums.items():
        v[i, j] = v[j, i] = float(Fraction(n * total - rest[i] * rest[j], n * n))
    return v


def _project(scale: int, shift: int, n: int, total: list[int], turn: np.ndarray):
    def run(batches):
        centre = np.array(total, object)
        reach = max(abs(x) for x in total)
        for b in batches:
            if not b.num_rows:
                continue
            x = _whole(b, scale, shift)
            most = n * int(np.abs(x).max()) + reach
            if most < 2 ** 62:  # n x and S fit a long
                off = x * n - np.array(total, np.int64)
                wide = int(np.abs(off).max())
                squares = (off * off).sum(axis=1) if wide * wide * len(total) < 2 ** 63 else [sum(int(e) * int(e) for e in r) for r in off]
            else:
                off = x.astype(object) * n - centre
                squares = [sum(e * e for e in r) for r in off]
            squares = [int(s) if s < 2 ** 63 else None for s in squares]
            white = (off.astype(np.float64) / n) @ turn
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * turn.shape[1], white.ravel())
            yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id"), "n": pa.array([n] * len(x), pa.int64()), "deviation": pa.array(squares, pa.int64()), "whitened": lists})
    return run


def _moments(size: int):
    """(i, j, total) of a partition's whitened values, i = -1 for the plain sums."""
    def run(batches):
        first, second = np.zeros(size), np.zeros((size, size))
        for b in batches:
            w = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            first, second = first + w.sum(axis=0), second + w.T @ w
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.append(np.full(size, -1), i), pa.int32()), "j": pa.array(np.append(np.arange(size), j), pa.int32()), "total": np.append(first, second[i, j])})
    return run


def _identity_error(white: DataFrame, n: int, size: int) -> float:
    parts = white.select("whitened").mapInArrow(_moments(size), "i int, j int, total double")
    got = {(r["i"], r["j"]): r["total"] for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    return max(abs(got[i, j] / n - got[-1, i] / n * got[-1, j] / n - (i == j)) for i, j in got if i >= 0)


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))


def whiten(embeddings: DataFrame, wanted: int = 8, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per
    usable vector and component."""
    spark = embeddings.sparkSession
    vector = embeddings["embedding"].cast("array<double>")
    vectors = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), vector.alias("v")).filter(usable(F.col("v")) & (F.size("v") > 0))
    none = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    common = vectors.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return none
    vectors = vectors.filter(F.size("v") == common["size"])
    sums = _gather(vectors, scale, shift)
    n = sums.pop((-1, -1))
    total = [sums[i, i] for i in range(common["size"])]
    centre = [(2 * s + n) // (2 * n) for s in total]
    v = _covariance(_gather(vectors, scale, shift, centre), [s - n * c for s, c in zip(total, centre)], n)
    values, basis = components(v, wanted)
    if not len(values):
        return none
    white = cut(vectors.mapInArrow(_project(scale, shift, n, total, basis / np.sqrt(values)), _DDL), "whitened")
    error = _identity_error(white, n, len(values))
    explained = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    rows = white.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("place", "value"))
    return rows.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("value").alias("whitened"), explained[F.col("place")].alias("explained"), F.lit(error).alias("identity_error"))
