"""Whitening of embeddings by their principal components.

Entries become integers, so that sums and deviations are exact at any size. A pass
adds up every dimension; the second centres each vector (``n * x - S``, an exact
integer, over ``n``) and multiplies: tasks hold one matrix each, its rows are dealt
out and added up by row number, and only the finished matrix, of as many entries as
dimensions squared, reaches the driver. There Householder reflections make it
tridiagonal, bisection over Sturm counts finds the leading eigenvalues, and inverse
iteration, with vectors of close eigenvalues kept orthogonal, their components. The
projection is sent to the tasks; a last pass measures the covariance of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsaw.llm.shards import frugal

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1
# Eigenvalues closer than this share of the matrix's norm get vectors that are made orthogonal to each other.
CLUSTER = 1e-3
EPS = float(np.finfo(np.float64).eps)


# --- the eigenproblem of one symmetric matrix -------------------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of ``a`` by Householder reflections.

    The i-th reflector is a unit vector (or zeros, if nothing is to be reflected) that acts on rows i + 1 onwards.
    """
    a = a.astype(np.float64, copy=True)
    n = len(a)
    off = np.zeros(max(n - 1, 0))
    reflectors = []
    for i in range(n - 2):
        x = a[i + 1 :, i]
        top = np.abs(x).max()
        length = top * np.sqrt(((x / top) ** 2).sum()) if top else 0.0
        v = x.copy()
        v[0] += length if x[0] >= 0 else -length
        size = np.sqrt((v / top) @ (v / top)) * top if top else 0.0
        if not size:
            off[i] = 0.0
            reflectors.append(np.zeros(n - i - 1))
            continue
        v /= size
        off[i] = -length if x[0] >= 0 else length
        rest = a[i + 1 :, i + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        reflectors.append(v)
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diagonal(a).copy(), off, reflectors


def reflected(vectors: np.ndarray, reflectors: list[np.ndarray]) -> np.ndarray:
    """Columns of ``vectors``, given for the tridiagonal matrix, for the matrix that was reduced."""
    out = vectors.copy()
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        out[i + 1 :] -= 2 * np.outer(v, v @ out[i + 1 :])
    return out


def counts_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each shift: negative pivots of the Sturm sequence."""
    tiny = np.finfo(np.float64).tiny / EPS * max(1.0, float((off**2).max(initial=0.0)))
    q = diagonal[0] - shifts
    below = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diagonal[i] - shifts - off[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until its bounds are neighbours in double precision."""
    n = len(diagonal)
    around = np.zeros(n)
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    low, high = float((diagonal - around).min()), float((diagonal + around).max())
    slack = 4 * EPS * max(abs(low), abs(high)) + np.finfo(np.float64).tiny
    rank = n - np.arange(k)  # the j-th largest is below x if all but j are
    lo, hi = np.full(k, low - slack), np.full(k, high + slack)
    for _ in range(1100):
        middle = lo + (hi - lo) / 2
        open_ = (middle > lo) & (middle < hi) & (hi - lo > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if not open_.any():
            break
        below = counts_below(diagonal, off, middle) >= rank
        hi = np.where(open_ & below, middle, hi)
        lo = np.where(open_ & ~below, middle, lo)
    return lo + (hi - lo) / 2


def _solved(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """``z`` of ``(T - shift) z = b`` for every shift at once, by elimination with row exchange."""
    n, k = b.shape
    main = np.empty((n, k))
    upper, second = np.zeros((n, k)), np.zeros((n, k))
    b = b.copy()
    row, beside = diagonal[0] - shifts, np.full(k, off[0] if n > 1 else 0.0)
    for i in range(n - 1):
        next_row, next_beside = diagonal[i + 1] - shifts, np.full(k, off[i + 1] if i + 2 < n else 0.0)
        under = np.full(k, off[i])
        swap = np.abs(under) > np.abs(row)
        pivot = np.where(swap, under, row)
        pivot = np.where(np.abs(pivot) < least, np.where(pivot < 0, -least, least), pivot)
        factor = np.where(swap, row, under) / pivot
        main[i], upper[i], second[i] = pivot, np.where(swap, next_row, beside), np.where(swap, next_beside, 0.0)
        row = np.where(swap, beside, next_row) - factor * upper[i]
        beside = np.where(swap, 0.0, next_beside) - factor * second[i]
        first, other = np.where(swap, b[i + 1], b[i]), np.where(swap, b[i], b[i + 1])
        b[i], b[i + 1] = first, other - factor * first
    main[n - 1] = np.where(np.abs(row) < least, np.where(row < 0, -least, least), row)
    z = np.empty((n, k))
    for i in range(n - 1, -1, -1):
        rest = b[i].copy()
        if i + 1 < n:
            rest -= upper[i] * z[i + 1]
        if i + 2 < n:
            rest -= second[i] * z[i + 2]
        z[i] = rest / main[i]
        big = np.abs(z[i:]).max(axis=0)  # a solution grows towards its eigenvector; keep it in range
        over = big > 1e100
        if over.any():
            z[i:, over] /= big[over]
            b[:i, over] /= big[over]
    return z


def _orthogonal(z: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Unit columns, each orthogonal to those before it in its cluster (``firsts``: where the cluster begins)."""
    z = z / np.maximum(np.abs(z).max(axis=0), np.finfo(np.float64).tiny)
    for j in range(z.shape[1]):
        before = z[:, firsts[j] : j]
        for _ in range(2):
            z[:, j] -= before @ (before.T @ z[:, j])
        z[:, j] /= np.sqrt(z[:, j] @ z[:, j]) or 1.0
    return z


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix for ``values`` (falling), as columns, by inverse iteration."""
    n, k = len(diagonal), len(values)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0.0)))
    if not norm:
        return np.eye(n)[:, :k]
    firsts, shifts = np.arange(k), values.copy()
    for j in range(1, k):
        if values[j - 1] - values[j] < CLUSTER * norm:
            firsts[j] = firsts[j - 1]
        if shifts[j] > shifts[j - 1] - 4 * EPS * norm:  # equal values get shifts a few steps apart
            shifts[j] = shifts[j - 1] - 4 * EPS * norm
    z = np.random.default_rng(7).uniform(-1, 1, (n, k))
    z = _orthogonal(z, firsts)
    for _ in range(6):
        z = _orthogonal(_solved(diagonal, off, shifts, z, EPS * norm), firsts)
    return z


def principal(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the k leading components with any variance."""
    diagonal, off, reflectors = tridiagonal(covariance)
    values = leading_eigenvalues(diagonal, off, min(k, len(diagonal)))
    vectors = reflected(eigenvectors(diagonal, off, values), reflectors)
    kept = values > 8 * len(diagonal) * EPS * max(float(np.trace(covariance)), 0.0)
    return values[kept], vectors[:, kept]


# --- passes over the vectors ------------------------------------------------------------------------------------


def integers(vectors: DataFrame, vector: str, key: str) -> DataFrame:
    """(vec_id, x): rows whose vector is not null and has only finite entries, as integers."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter(F.coalesce(finite, F.lit(False)))
    held = F.transform(v, lambda c: F.least(F.greatest(F.floor(c * SCALE), F.lit(LONG_MIN + SHIFT)), F.lit(LONG_MAX - SHIFT)) + F.lit(SHIFT))
    return rows.select(F.col(key).alias("vec_id"), held.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], width: int, rows: int = 4096) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            part = batch.slice(first, rows)
            yield part.column("vec_id"), part.column("x").flatten().to_numpy().reshape(-1, width)


def sums(rows: DataFrame, width: int) -> tuple[int, list[int], list[int], list[int]]:
    """(n, sums, least, greatest) per dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, least, most = 0, [0] * width, None, None
        for _, x in _matrices(batches, width):
            low, high = x.min(axis=0), x.max(axis=0)
            fits = max(abs(int(low.min())), abs(int(high.max()))) < 2**50  # no sum of 4,096 leaves a long
            own = x.sum(axis=0).tolist() if fits else [sum(c) for c in x.T.tolist()]
            total = [a + b for a, b in zip(total, own, strict=True)]
            least = low if least is None else np.minimum(least, low)
            most = high if most is None else np.maximum(most, high)
            n += len(x)
        if n:
            whole = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
            columns = [pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, n)), whole, pa.array(least), pa.array(most)]
            yield pa.RecordBatch.from_arrays(columns, ["i", "n", "s", "lo", "hi"])

    parts = rows.mapInArrow(frugal(run), "i int, n bigint, s decimal(38,0), lo bigint, hi bigint")
    whole = parts.groupBy("i").agg(F.sum("n"), F.sum("s").cast("decimal(38,0)"), F.min("lo"), F.max("hi")).collect()
    whole = sorted(whole)
    return whole[0][1], [int(r[2]) for r in whole], [r[3] for r in whole], [r[4] for r in whole]


def products(rows: DataFrame, width: int, centred: Callable[[np.ndarray], np.ndarray], out: int) -> np.ndarray:
    """The sum over all rows of the outer products of ``centred(x)``, which has ``out`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, width):
            c = centred(x)
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").flatten().to_numpy().reshape(-1, out), strict=True):
                held[i] = held[i] + row if i in held else row.copy()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], ["i", "row"])

    schema = "i int, row array<double>"
    added = rows.mapInArrow(frugal(run), schema).repartition("i").mapInArrow(frugal(add), schema)
    return np.array([r.row for r in sorted(added.collect())])


def deviations(x: np.ndarray, n: int, total: list[int], exact: bool) -> np.ndarray:
    """``n * x - S``; ``exact`` takes Python's integers, which cannot overflow."""
    if exact:
        return x.astype(object) * n - np.array(total, object)
    return x * np.int64(n) - np.array(total, np.int64)


def whitened(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per remaining row and component.

    Vectors that are null or hold null or non-finite entries are dropped. One covariance
    needs one length: vectors of another length than the most frequent one (of equally
    frequent ones the greatest) are dropped too, and so are empty ones. Rows that repeat, or share
    or lack an id, are vectors of their own. Entries beyond a long are taken at its bounds.
    Components without variance are left out, as nothing can be divided by zero: a single
    vector, or equal ones, give no rows, as does an empty table. There are at most as many
    components as dimensions. A ``deviation`` beyond a long is null. Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = f"vec_id {dict(vectors.dtypes)[key]}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = integers(vectors, vector, key)
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).filter("width > 0").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], schema)
    width = widths[0].width
    rows = rows.filter(F.size("x") == width)
    n, total, least, most = sums(rows, width)
    farthest = max(max(n * h - s, s - n * low) for s, low, h in zip(total, least, most, strict=True))
    exact = n * max(abs(v) for v in least + most) > LONG_MAX or farthest * farthest * width > LONG_MAX

    def centred(x: np.ndarray) -> np.ndarray:
        return deviations(x, n, total, exact).astype(np.float64) / n

    covariance = products(rows, width, centred, width) / n
    values, components = principal(covariance, k)
    if not len(values):
        return spark.createDataFrame([], schema)
    projection = spark.sparkContext.broadcast(components / np.sqrt(values))  # dimensions x components

    def with_ones(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ projection.value
        return np.column_stack([w, np.ones(len(w))])

    moments = products(rows, width, with_ones, len(values) + 1) / n
    mean = moments[-1, :-1]
    error = float(np.abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, width):
            d = deviations(x, n, total, exact)
            far = (d * d).sum(axis=1)
            far = pa.array([v if v <= LONG_MAX else None for v in far.tolist()], pa.int64())
            w = (d.astype(np.float64) / n) @ projection.value
            # arrays, not rows: Spark opens them in the JVM
            yield pa.RecordBatch.from_arrays([ids, far, pa.array(list(w), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"])

    share = F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)])
    found = rows.mapInArrow(frugal(run), f"vec_id {dict(rows.dtypes)['vec_id']}, deviation bigint, w array<double>")
    found = found.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return found.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        share[F.col("i")].alias("explained"), F.lit(error).alias("identity_error"),
    )
