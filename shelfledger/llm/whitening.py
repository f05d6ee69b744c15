"""Whitening of embeddings along leading components, found by spectrum slicing.

Two passes over the vectors give the covariance: exact sums per dimension, then products of the
centred entries, added up in Spark from one partial per task. What reaches the driver is a square
of the dimension, whatever the number of vectors. There the LDL^T form of the covariance less a
shift counts, by its negative pivots, the eigenvalues below the shift (Sylvester's law of
inertia): halving intervals by their counts isolates each leading eigenvalue, Rayleigh quotient
iteration converges to it cubically, and two more counts at its borders certify its number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm.batches import small_batches

#: Components at most.
COMPONENTS = 32
#: An entry c counts as floor(FACTOR * c) + OFFSET.
FACTOR, OFFSET = 64, 1_000_000
#: Entries beyond this, either way, count as this.
LARGEST = 1 << 53
#: Components whose share of the variance is less than this have no direction of their own.
LEAST_SHARE = 1e-13
_LIMIT = 1 << 62


# ----------------------------------------------------------------------------- spectrum

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The diagonal and the one beside it of a matrix in tridiagonal form, by reflections."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        if length == 0 or not x[1:].any():
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        a[k + 1:, k:] -= 2 * np.outer(x, x @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each shift: the negative pivots of L D L^T of the shifted
    matrix. A pivot of zero counts as a tiny positive one."""
    tiny = np.finfo(float).tiny ** 0.5 + np.finfo(float).eps ** 2 * np.abs(diagonal).max()
    pivot = diagonal[0] - shifts
    below = (pivot < 0).astype(np.int64)
    for d, b in zip(diagonal[1:], beside, strict=True):
        pivot = d - shifts - b * b / np.where(pivot == 0, tiny, pivot)
        below += pivot < 0
    return below


def isolated(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> np.ndarray:
    """(low, high) of each of the ``wanted`` greatest eigenvalues, greatest first: intervals that
    hold no other eigenvalue and are short against the gaps between them, or that rounding can't
    part any further. All are halved at once, one more than wanted for the last gap."""
    n = len(diagonal)
    more = min(wanted + 1, n)
    radius = np.abs(np.concatenate([[0.0], beside])) + np.abs(np.concatenate([beside, [0.0]]))
    margin = 1e-12 * max(np.abs(diagonal).max(), radius.max())
    low = np.full(more, (diagonal - radius).min() - margin)
    high = np.full(more, (diagonal + radius).max() + margin)
    width = 4 * np.finfo(float).eps * max(abs(low[0]), abs(high[0]))
    index = n - 1 - np.arange(more)  # its place, counted from the least
    while True:
        between = np.concatenate([[np.inf], low[:-1] - high[1:], [np.inf]])
        gap = np.minimum(between[:-1], between[1:])
        # one against a hundred: each step of inverse iteration wins two digits at least
        open_ = high - low > np.maximum(width, np.minimum(gap, np.abs(high)) / 100)
        if not open_.any():
            return np.stack([low, high], axis=1)[:wanted]
        middle = (low + high) / 2
        up = inertia(diagonal, beside, middle) <= index
        low, high = np.where(open_ & up, middle, low), np.where(open_ & ~up, middle, high)


def _refined(
    a: np.ndarray, low: float, high: float, near: np.ndarray, seed: int
) -> tuple[float, np.ndarray]:
    """The eigenpair in (low, high), by Rayleigh quotient iteration. It stays orthogonal to the
    columns of ``near``, the vectors of greater eigenvalues. A quotient that leaves the interval is put
    back to its middle, which is a step of inverse iteration."""
    n = len(a)
    scale = max(np.abs(a).max(), np.finfo(float).tiny)
    v = np.random.default_rng(seed).standard_normal(n)

    def unit(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - near @ (near.T @ x)
        return x / np.linalg.norm(x)

    v, value, best = unit(v), (low + high) / 2, None
    for step in range(50):
        shifted = a - value * np.eye(n)
        try:
            v = unit(np.linalg.solve(shifted, v))
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            v = unit(np.linalg.solve(shifted + 1e-15 * scale * np.eye(n), v))
        quotient = float(v @ a @ v)
        rest = float(np.linalg.norm(a @ v - quotient * v))
        inside = low <= quotient <= high
        if inside and (best is None or rest < best[0]):
            best = (rest, quotient, v)
        elif inside and best is not None and rest <= 1e-13 * scale * n:
            break
        value = quotient if inside and step else (low + high) / 2
    if best is None:
        raise ValueError("no eigenvalue found in an isolated interval")
    return best[1], best[2]


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their unit vectors as columns.

    Equal eigenvalues get some orthogonal vectors of their space. Raises where the counts do not
    certify a number, which no symmetric matrix of finite entries should bring about.
    """
    n = len(a)
    wanted = min(wanted, n)
    diagonal, beside = tridiagonal(a)
    found = isolated(diagonal, beside, wanted)
    scale = np.abs(a).max()
    # rounding of the reflections moves eigenvalues by so much
    slack = 64 * np.finfo(float).eps * n * scale
    values, vectors = np.zeros(wanted), np.zeros((n, wanted))
    for k, (low, high) in enumerate(found):
        values[k], vectors[:, k] = _refined(
            a, low - slack, high + slack, vectors[:, :k], seed=k
        )
    edges = inertia(diagonal, beside, np.concatenate([values - slack, values + slack]))
    place = n - 1 - np.arange(wanted)
    if (edges[:wanted] > place).any() or (edges[wanted:] <= place).any():
        raise ValueError("the counts do not certify the numbers of the eigenvalues")
    return values, vectors


# ----------------------------------------------------------------------------- passes

def _entries(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors of a list column as rows of longs, and where they stand."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy()
    right = np.flatnonzero(lengths == width)
    flat = column.take(pa.array(right)).flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    rows = values.reshape(len(right), width)
    good = np.isfinite(rows).all(axis=1)
    grown = np.clip(np.floor(rows[good] * float(FACTOR)), -LARGEST, LARGEST)
    return grown.astype(np.int64) + OFFSET, right[good]


def _partials(
    vectors: DataFrame, width: int, work: Callable[[np.ndarray, np.ndarray | None], np.ndarray],
    kind: str,
) -> DataFrame:
    """``work`` over the batches of each task, one row (values) each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x, _ = _entries(batch.column("embedding"), width)
            total = work(x, total)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([total.tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))],
                names=["values"],
            )

    return vectors.select("embedding").mapInArrow(run, f"values array<{kind}>")


def _added(partials: DataFrame) -> list:
    """Sums of the partial values place by place, exact for longs."""
    cells = partials.select(F.posexplode("values").alias("at", "value"))
    total = F.sum(F.col("value").cast("decimal(38,0)")) if "bigint" in dict(cells.dtypes)[
        "value"] else F.sum("value")
    return [r["total"] for r in cells.groupBy("at").agg(total.alias("total")).orderBy("at").collect()]


def sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of usable vectors and the exact sum of each dimension."""
    def work(x: np.ndarray, total: np.ndarray | None) -> np.ndarray:
        # two halves of 27 bits, so that sums of extreme entries stay in range
        found = np.concatenate([[len(x)], (x >> 27).sum(axis=0), (x & (1 << 27) - 1).sum(axis=0)])
        return found if total is None else total + found

    found = [int(v) for v in _added(_partials(vectors, width, work, "long"))]
    if not found:
        return 0, [0] * width
    return found[0], [(found[1 + d] << 27) + found[1 + width + d] for d in range(width)]


def _centred(x: np.ndarray, middle: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """x less the mean, which is ``middle`` (whole) plus ``offset`` (under one)."""
    return (x - middle).astype(float) - offset


def products(vectors: DataFrame, width: int, project: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of the products of the entries that ``project`` makes of one."""
    def work(x: np.ndarray, total: np.ndarray | None) -> np.ndarray:
        z = project(x)
        found = (z.T @ z)[np.triu_indices(z.shape[1])]
        return found if total is None else total + found

    found = np.array(_added(_partials(vectors, width, work, "double")), dtype=float)
    side = int((2 * len(found)) ** 0.5)
    whole = np.zeros((side, side))
    whole[np.triu_indices(side)] = found
    return whole + np.triu(whole, 1).T


def deviations(x: np.ndarray, n: int, total: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S) ** 2, exact; null where it is no long."""
    s = np.array(total, dtype=object)
    most = max(int(np.abs(x).max(initial=0)), 1)
    if n * most < _LIMIT and max((abs(v) for v in total), default=0) < _LIMIT:
        y = n * x - s.astype(np.int64)
        rough = (y.astype(float) ** 2).sum(axis=1)
        found = (y * y).sum(axis=1)  # wraps only where the rough sum says so
        if rough.max(initial=0) < 9.2e18:
            return pa.array(found)
        exact = [int(v) if r < 9.2e18 else sum(int(c) ** 2 for c in row)
                 for v, r, row in zip(found, rough, y, strict=True)]
    else:
        exact = [sum((n * int(c) - t) ** 2 for c, t in zip(row, total, strict=True)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per usable
    vector and component.

    Takes vec_id and embedding; other columns are left out. Vectors that are null, or hold null
    or non-finite entries, are dropped; so are empty ones, and where vectors differ in length
    those that have not the most frequent length (of equally frequent ones the greatest). Null
    and repeated ids stay as they are. ``deviation`` is null where it is beyond a long; entries
    beyond LARGEST count as LARGEST. Components without variance are left out, so equal vectors,
    a single vector and an empty table give no rows.
    """
    small_batches(vectors.sparkSession, 4096)
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    schema = (
        f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, deviation long, "
        "whitened array<double>"
    )
    lengths = (
        vectors.where("size(embedding) > 0").groupBy(F.size("embedding").alias("width"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    )
    width = lengths["width"] if lengths else 0
    n, total = sums(vectors, width) if width else (0, [])
    values, vecs, trace = np.zeros(0), np.zeros((width, 0)), 0.0
    middle = np.array([round(s / n) if n < 1 << 30 else s // n for s in total] if n else [],
                      dtype=np.int64)
    offset = np.array([(s - n * int(m)) / n for s, m in zip(total, middle, strict=False)])
    if n:
        covariance = products(vectors, width, lambda x: _centred(x, middle, offset)) / n
        trace = float(np.trace(covariance))
        if trace > 0:
            values, vecs = leading(covariance, components)
            real = values > LEAST_SHARE * trace
            values, vecs = values[real], vecs[:, real]
    weights = vecs / np.sqrt(values)
    error = 0.0
    if len(values):
        found = products(vectors, width, lambda x: _centred(x, middle, offset) @ weights) / n
        error = float(np.abs(found - np.eye(len(values))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = _entries(batch.column("embedding"), width)
            found = _centred(x, middle, offset) @ weights
            ends = np.arange(len(x) + 1, dtype=np.int32) * len(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), deviations(x, n, total),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))],
                names=["vec_id", "deviation", "whitened"],
            )

    if not len(values):
        rows = vectors.where("false").selectExpr(
            "vec_id", "0L AS deviation", "CAST(array() AS array<double>) AS whitened")
    else:
        rows = vectors.mapInArrow(run, schema)
    share = F.element_at(F.lit([float(v / trace) for v in values] or [0.0]), F.col("component"))
    return rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).withColumn("component", F.col("at") + 1).select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
