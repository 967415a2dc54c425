"""Whitening of embeddings by cyclic Jacobi rotations of their exact scatter matrix.

Components become integers, x = floor(64 c) + 1000000; the fit list holds each distinct vector once. Tasks centre the list at
its rounded mean and sum products of centred integers exactly; what rounding the mean left is taken off in integers too. So
n^2 times the covariance is an exact integer matrix, the same whatever the partitions, retries and order of rows, and nothing
cancels against the offset. Only this matrix goes to the driver. Cyclic Jacobi sweeps there rotate each pair of dimensions
until every off-diagonal entry vanishes beside the diagonal ones of its row and column, which is what keeps small eigenvalues
accurate. The matrix of a few components is sent with the tasks that project all rows; their own covariance over the fit list,
measured in another pass, is compared with the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.clusters import scaled, usable
from tidewright.llm.common import table, written

COMPONENTS, SCALE, OFFSET = 16, 64.0, 1_000_000
MAX_SWEEPS = 60
#: Eigenvalues below this part of the largest, times the dimensions, are rounding: there is no direction to whiten.
NOTHING = 2.0**-50
LONG = 2**63 - 1
SUMS = "i int, j int, v decimal(38,0)"


def jacobi(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns, largest entry positive) of a symmetric matrix."""
    a = a.copy()
    d = len(a)
    v = np.eye(d)
    for _ in range(MAX_SWEEPS):
        rotated = False
        for p in range(d - 1):
            for q in range(p + 1, d):
                apq = a[p, q]
                if abs(apq) <= 2.0**-53 * np.sqrt(abs(a[p, p] * a[q, q])):
                    continue
                rotated = True
                theta = (a[q, q] - a[p, p]) / (2 * apq)
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(1.0, theta))
                c = 1 / np.hypot(1.0, t)
                s = t * c
                app, aqq = a[p, p] - t * apq, a[q, q] + t * apq
                rp, rq = a[p].copy(), a[q].copy()
                a[p], a[q] = c * rp - s * rq, s * rp + c * rq
                a[:, p], a[:, q] = a[p], a[q]
                a[p, p], a[q, q], a[p, q], a[q, p] = app, aqq, 0.0, 0.0
                v[:, p], v[:, q] = c * v[:, p] - s * v[:, q], s * v[:, p] + c * v[:, q]
        if not rotated:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    v = v[:, order]
    return np.diag(a)[order], v * np.where(v[np.abs(v).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(n, -1)


def _entries(i: np.ndarray, j: np.ndarray, v: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(x)) for x in v], pa.decimal128(38, 0))], names=["i", "j", "v"])


def _exact(m: np.ndarray, rows: int) -> np.ndarray:
    """The integers as they are where sums of this many products fit a long, otherwise as Python's."""
    most = int(np.abs(m).max(initial=0))
    return m if most * most * max(rows, 1) <= LONG else m.astype(object)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the components in the first column, and the number of vectors at (-1, 0)."""
    total, n = 0, 0
    for batch in batches:
        total = total + _matrix(batch.column("x"), batch.num_rows).sum(axis=0).astype(object)
        n += batch.num_rows
    if n:
        yield _entries(np.arange(-1, len(total)), np.zeros(len(total) + 1), [n, *total])


def _products(centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = _exact(_matrix(batch.column("x"), batch.num_rows) - centre, batch.num_rows)
            total = (0 if total is None else total) + (y.T @ y).astype(object)
        if total is not None:
            i, j = np.triu_indices(len(centre))
            yield _entries(i, j, total[i, j])

    return run


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: n * (x - m) - (S - n * m) with m, the mean rounded down, which keeps the numbers small."""
    m = np.array([s // n for s in sums], np.int64)
    y = x - m
    rest = np.array([s % n for s in sums], np.int64)
    if int(np.abs(y).max(initial=0)) * n < LONG // 2:
        return n * y - rest
    return n * y.astype(object) - rest.astype(object)


def _deviation(t: np.ndarray) -> list[int | None]:
    found = (_exact(t, t.shape[1]) ** 2).sum(axis=1) if t.size else np.zeros(len(t), np.int64)
    return [int(v) if int(v) <= LONG else None for v in found]


def _whitened(t: np.ndarray, n: int, w: np.ndarray) -> np.ndarray:
    return (t / n).astype(float) @ w


def _covariances(n: int, sums: list[int], w: np.ndarray):
    """Sums of products of whitened components, and of these themselves in row -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((w.shape[1] + 1, w.shape[1]))
        for batch in batches:
            z = _whitened(centred(_matrix(batch.column("x"), batch.num_rows), n, sums), n, w)
            total += np.vstack([z.sum(axis=0), z.T @ z])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel() - 1, pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    return run


def whitening(vectors: DataFrame, id_col: str, vec_col: str, components: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained and identity_error, for each usable row and each component.

    Rows are usable if the vector has no null or non-finite entry and as many as most vectors have, the greater number among
    equally frequent ones, and at least one; others are left out. Components are as many as asked, or the dimensions where
    these are fewer. A component without variance, as of one vector or one repeated vector, is null; explained is null where
    nothing varies; a deviation beyond a long is null. Repeated rows count once in the fit and all get rows. Entries beyond
    two million are held there. Ids may be null. No usable rows give no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    vec = vectors[vec_col]
    sizes = vectors.where(usable(vec, F.size(vec)) & (F.size(vec) > 0)).groupBy(F.size(vec).alias("d")).count()
    d = (sizes.orderBy(F.desc("count"), F.desc("d")).first() or [1])[0]
    rows = vectors.where(usable(vec, d)).select(vectors[id_col].alias("id"), F.transform(scaled(vec, SCALE), lambda c: c + F.lit(OFFSET)).alias("x"))
    schema = f"id {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = written(rows.select("x").distinct(), "fit-list")
    found = {r.i: int(r.v) for r in fit.mapInArrow(_sums, SUMS).groupBy("i").agg(F.sum("v").alias("v")).collect()}  # a row for each dimension
    if not found:
        return spark.createDataFrame([], schema)
    n = found.pop(-1)
    sums = [found[i] for i in range(d)]
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    scatter = np.zeros((d, d), object)
    for r in fit.mapInArrow(_products(centre), SUMS).groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # one for each pair of dimensions
        scatter[r.i, r.j] = scatter[r.j, r.i] = int(r.v)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre, strict=True)], object)
    exact = n * scatter - np.outer(rest, rest)  # n^2 times the covariance
    covariance = np.array([[float(Fraction(int(v), n * n)) for v in row] for row in exact])
    values, directions = jacobi(covariance)
    k = min(components, d)
    real = (values > NOTHING * d * max(values.max(), 0.0))[:k]
    w = directions[:, :k] / np.where(real, np.sqrt(np.where(real, values[:k], 1.0)), np.inf)
    trace = float(Fraction(int(sum(exact[i, i] for i in range(d))), n * n))
    explained = [float(v) / trace if trace > 0 else None for v in values[:k]]
    second = np.zeros((k + 1, k))
    for r in fit.mapInArrow(_covariances(n, sums, w), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        second[r.i + 1, r.j] = r.v / n
    error = np.abs(second[1:] - np.outer(second[0], second[0]) - np.eye(k))[np.ix_(real, real)]
    identity = float(error.max(initial=0.0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = centred(_matrix(batch.column("x"), batch.num_rows), n, sums)
            z = _whitened(t, n, w)
            at = pa.array(np.repeat(np.arange(batch.num_rows), k))
            many = batch.num_rows * k
            columns = [
                batch.column("id").take(at),
                pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()),
                pa.array(np.full(many, n), pa.int64()),
                pa.array(_deviation(t), pa.int64()).take(at),
                pa.array(z.ravel(), mask=np.tile(~real, batch.num_rows)),
                pa.array(explained * batch.num_rows, pa.float64()),
                pa.array(np.full(many, identity)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumnRenamed("id", "vec_id")
