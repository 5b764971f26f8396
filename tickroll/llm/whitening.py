"""Whitening of vectors by spectral divide and conquer (operator 12).

1. One pass sums the vectors' integers x = floor(1024 * c) + 100000 exactly
   (in two halves, so that no sum overflows), a second one adds up the products
   of x less its mean: a matrix of the dimension per task, summed by row.
2. ``spectrum`` splits the covariance: the polar factor U of V - shift * I, by
   QR-based dynamically weighted Halley steps, gives the projector (U + I) / 2
   of the eigenvalues above the shift. An orthonormal basis of its range and
   of the rest turns V into two blocks, and each block that holds wanted
   components is split again until its parts are single eigenvectors (or a
   multiple of the identity, where every basis is one).
3. The first components (dimension x 8 numbers) are sent to every task, which
   projects its vectors. The projections are written once; their covariance is
   taken from what was written and compared with the identity.

The covariance alone passes through the driver: its size is that of the
dimension, whatever the number of vectors.

Defined cases: vectors that are NULL or hold NULL, NaN or infinite entries are
dropped, so are empty ones and those with an entry whose x is no long; of
several lengths the most frequent one counts (of equally frequent ones the
largest) and the others are dropped; components whose eigenvalue is zero
(within rounding of the largest) have no scale and are left out, so equal
vectors, or a single one, give no rows; equal eigenvalues have one basis out of
many, the same for all rows; repeated rows and rows with NULL id are rows of
their own; a deviation of more than 38 digits is NULL; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import stage

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LOW_BITS = 20                  # sums are kept as high * 2^20 + low
EPS = np.finfo(float).eps
OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


# ------------------------------------------------------------- the spectrum
def polar(x: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by weighted Halley steps in QR form."""
    n = len(x)
    x = x / np.linalg.norm(x)
    try:       # a lower bound of the least singular value
        low = max(1 / (np.sqrt(n) * np.linalg.norm(np.linalg.inv(x), 1)), EPS)
    except np.linalg.LinAlgError:
        low = EPS
    eye = np.eye(n)
    for _ in range(40):
        l2 = low * low
        d = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        root = np.sqrt(1 + d)
        a = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - l2) / (l2 * root))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
        new = b / c * x + (a - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (a + b * l2) / (1 + c * l2))
        if 1 - low < 1e-14 and moved < 1e-14 * n:
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, int]:
    """An orthonormal basis whose first k columns span the eigenvectors above a shift, 0 < k < n."""
    n, size = len(a), np.linalg.norm(a)
    rng = np.random.default_rng(n)
    middle = float(np.median(np.diag(a)))
    for turn in range(24):
        # the median of the diagonal halves most blocks; the mean always lies inside the spectrum
        shift = middle if turn == 0 else float(rng.normal(0, 0.02 * (turn - 1))) * size / np.sqrt(n)
        u = polar(a - shift * np.eye(n))
        projector = (u + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-10 * n:
            continue                      # the shift hits an eigenvalue, or all lie on one side
        basis = np.linalg.qr(projector @ rng.normal(size=(n, k)))[0]
        basis = np.linalg.qr(projector @ basis, mode="complete")[0]
        if np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]) <= 1e-13 * n * size:
            return basis, k
    raise ArithmeticError("no shift splits the spectrum")


def spectrum(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    zero = len(v) * EPS * np.linalg.norm(v)

    def parts(a: np.ndarray, basis: np.ndarray, wanted: int) -> list[np.ndarray]:
        n = len(a)
        rest = a - np.trace(a) / n * np.eye(n)
        if n == 1 or np.linalg.norm(rest) <= zero:
            return [basis[:, i] for i in range(min(n, wanted))]
        turn, k = _split(rest)
        found: list[np.ndarray] = []
        for here in (turn[:, :k], turn[:, k:]):
            if len(found) < wanted:
                block = here.T @ a @ here
                found += parts((block + block.T) / 2, basis @ here, wanted - len(found))
        return found

    if not len(v) or not np.linalg.norm(v):
        return np.empty(0), np.empty((len(v), 0))
    vectors = np.linalg.qr(np.column_stack(parts(v, np.eye(len(v)), count)))[0]
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ------------------------------------------------------------- the passes
def _integers(values: pa.ListArray, width: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, integers) of the usable vectors of each length (or of ``width`` alone)."""
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(values.flatten(), float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes) if width is None else [width]:
        rows = np.flatnonzero(sizes == size)
        if size and len(rows):
            c = flat[starts[rows][:, None] + np.arange(size)] * SCALE
            good = (np.abs(c) < 2.0**63 - 2 * OFFSET).all(axis=1)      # not for NaN either
            if good.any():
                yield rows[good], np.floor(c[good]).astype(np.int64) + OFFSET


def _totals(rows: DataFrame) -> tuple[int, list[int]]:
    """Number and sums of the vectors of the length that counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for _, x in _integers(batch.column("v")):
                held = total.setdefault(x.shape[1], [0, 0, 0])
                held[0] += len(x)
                held[1] = held[1] + (x >> LOW_BITS).sum(axis=0)
                held[2] = held[2] + (x & (1 << LOW_BITS) - 1).sum(axis=0)
        for width, (n, high, low) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([width] * width, pa.int64()), pa.array(range(width), pa.int64()), pa.array([n] * width, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["width", "i", "n", "high", "low"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    sums = stage(rows.select("v").mapInArrow(run, "width long, i long, n long, high long, low long").groupBy("width", "i").agg(
        F.sum("n").alias("n"), exact("high").alias("high"), exact("low").alias("low")), "whitening-sums")
    top = sums.filter("i = 0").orderBy(F.desc("n"), F.desc("width")).first()
    if top is None:
        return 0, []
    found = sums.filter(F.col("width") == top["width"]).orderBy("i").collect()      # one row a dimension
    return top["n"], [(int(r["high"]) << LOW_BITS) + int(r["low"]) for r in found]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """x less the whole part of its mean (integers), and less the mean (doubles)."""
    whole = np.array([s // n for s in sums], np.int64)
    y = x - whole
    return y, y - np.array([s % n / n for s in sums])


def _covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _integers(batch.column("v"), d):
                y = _centred(x, n, sums)[1]
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    def add(t: pa.Table) -> pa.Table:
        total = t["row"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, d).sum(axis=0)
        return pa.table({"i": t["i"][:1], "row": pa.array([total], pa.list_(pa.float64()))})

    kind = "i long, row array<double>"
    found = rows.select("v").mapInArrow(run, kind).groupBy("i").applyInArrow(add, kind).collect()   # the matrix: d rows
    v = np.array([r["row"] for r in sorted(found)]) / n
    return (v + v.T) / 2


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Per row the sum of (n*x - S)^2, exact: n*x - S = n*y - r, with r what the mean's whole part leaves of S."""
    r = [s % n for s in sums]
    most = int(np.abs(y).max(initial=0)) + 1
    if len(r) * most * max(most, n) >= 1 << 62:
        y = y.astype(object)
    squares, cross = (y * y).sum(axis=1), (y * np.array(r, y.dtype)).sum(axis=1)
    tail = sum(v * v for v in r)
    return [n * n * int(s) - 2 * n * int(c) + tail for s, c in zip(squares, cross)]


def _identity_error(projected: DataFrame, k: int) -> float:
    """Largest absolute entry of the projections' covariance minus the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + k + k * k)
        for batch in batches:
            w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            total += np.concatenate([[len(w)], w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(total)], names=["i", "value"])

    found = projected.select("w").mapInArrow(run, "i long, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    total = np.array([r["value"] for r in sorted(found)])
    mean = total[1:1 + k] / total[0]
    return float(np.abs(total[1 + k:].reshape(k, k) / total[0] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, count: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("d"), F.col(vector).cast("array<double>").alias("v"))
    n, sums = _totals(rows)
    if not n:
        return spark.createDataFrame([], OUT)
    v = _covariance(rows, n, sums)
    values, basis = spectrum(v, count)
    real = values > len(sums) * 16 * EPS * max(values, default=0)
    values, basis = values[real], basis[:, real]
    k = len(values)
    if not k:
        return spark.createDataFrame([], OUT)
    scaled = basis / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, x in _integers(batch.column("v"), len(sums)):
                y, centred = _centred(x, n, sums)
                away = [Decimal(a) if a < 10**38 else None for a in deviations(y, n, sums)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d").take(pa.array(where)), pa.array(list(centred @ scaled), pa.list_(pa.float64())),
                     pa.array(away, pa.decimal128(38, 0))], names=["vec_id", "w", "deviation"])

    projected = stage(rows.mapInArrow(run, "vec_id long, w array<double>, deviation decimal(38,0)"), "whitening-projected")
    share = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    return projected.select("vec_id", "deviation", F.posexplode("w").alias("_i", "whitened")).select(
        "vec_id", (F.col("_i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("_i")).alias("explained"), F.lit(_identity_error(projected, k)).alias("identity_error"))
