"""Centroid clustering by Elkan's bounds, exact in integers.

Each vector keeps, from round to round, an upper bound of the distance to its centroid and k lower bounds of the distances to
all of them. When centroids move, the bounds give way by the way moved. A distance is computed only where the lower bound, and
half the distance between the two centroids, both leave room for it. Bounds are doubles rounded away from the truth, a
distance is left out only if its bound is strictly greater, so ties are seen and settled for the smaller number; distances that
are computed are squares of integers, compared exactly.

A round is one pass over the table of vectors and bounds, stored in the scratch folder so that a lost executor costs only its
tasks. Sums by cluster and component are Spark's; only k centroids and their distances go through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import released, scope, table, written

DIMENSIONS, SCALE, CENTROIDS, ROUNDS = 64, 64.0, 16, 3
#: Components are held within this range, so that squared distances of 64 of them fit a long; it is two million after scaling back.
LIMIT = 2**27
STATE = "id long, x array<int>, cluster int, upper double, lower array<double>, distance long, computed int"


def usable(vec: Column, dimensions: int) -> Column:
    """Whether a vector has this many components, none null or not finite."""
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) == dimensions) & finite, F.lit(False))


def scaled(vec: Column, scale: float) -> Column:
    """Each component as the integer floor(scale * x), held within LIMIT."""
    bound = F.lit(float(LIMIT))
    return F.transform(vec, lambda c: F.floor(F.greatest(-bound, F.least(bound, F.lit(scale) * c.cast("double")))).cast("int"))


def _root_up(square: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(square.astype(float)) * (1 + 1e-15), np.inf)


def _root_down(square: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, np.nextafter(np.sqrt(square.astype(float)) * (1 - 1e-15), -np.inf))


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to the centroid c, or to rows of c."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def assigned(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, ...]:
    """One round for a block of vectors: cluster, upper, lower, exact squared distance and the number of distances computed.

    x and centroids are integers; moved says how far each centroid has gone since the bounds were made, rounded up."""
    k = len(centroids)
    half = np.stack([_root_down(squares(centroids, c)) for c in centroids]) / 2
    upper = np.nextafter(upper + moved[cluster], np.inf)
    lower = np.maximum(0.0, np.nextafter(lower - moved[None, :], -np.inf))
    cluster = cluster.copy()
    rest = half + np.where(np.eye(k, dtype=bool), np.inf, 0.0)
    best = squares(x, centroids[cluster])  # of every vector, as the sums want it exact
    tight = _root_up(best)
    upper = np.minimum(upper, tight)
    lower[np.arange(len(x)), cluster] = _root_down(best)
    computed = np.ones(len(x), np.int32)
    open_rows = np.flatnonzero(upper >= rest.min(axis=1)[cluster]) if k > 1 else np.array([], int)
    for j in range(k):
        own = cluster[open_rows]
        rows = open_rows[(own != j) & (lower[open_rows, j] <= upper[open_rows]) & (half[own, j] <= upper[open_rows])]
        if not len(rows):
            continue
        d = squares(x[rows], centroids[j])
        computed[rows] += 1
        lower[rows, j] = _root_down(d)
        won = (d < best[rows]) | ((d == best[rows]) & (j < cluster[rows]))
        to = rows[won]
        cluster[to], best[to], upper[to] = j, d[won], _root_up(d[won])
    return cluster, upper, lower, best, computed


def _round(centroids: np.ndarray, moved: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy().astype(np.int64).reshape(n, -1)
            cluster = batch.column("cluster").to_numpy().astype(np.int64)
            lower = batch.column("lower").flatten().to_numpy().reshape(n, k)
            got = assigned(x, cluster, batch.column("upper").to_numpy(), lower, centroids, moved)
            bounds = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * k, k), pa.int32()), pa.array(got[2].ravel()))
            columns = [batch.column("id"), batch.column("x"), pa.array(got[0], pa.int32()), pa.array(got[1]), bounds, pa.array(got[3], pa.int64())]
            columns.append(pa.array(got[4] + batch.column("computed").to_numpy(), pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def centroid_sha256(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, id_col: str, vec_col: str, k: int = CENTROIDS, rounds: int = ROUNDS, scale: float = SCALE, dimensions: int = DIMENSIONS) -> tuple[DataFrame, np.ndarray]:
    """Of every usable vector: id, x (its integers), cluster, distance (squared) and computed (distances computed for it in
    all rounds, of k * (rounds + 1) that would be without bounds); and the final centroids.

    Ids are whole numbers or null. Vectors with another number of components, or with null or non-finite ones, are left out. The first centroids are the k
    vectors with the least hash of their id, null ids last, equal hashes by components; where there are fewer vectors, there
    are fewer centroids, and repeated rows may give equal ones, of which the smaller number gets all. Components beyond LIMIT
    are held there. No vectors give no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    spent: list[str] = []
    vec = vectors[vec_col]
    kept = vectors.where(usable(vec, dimensions)).select(vectors[id_col].cast("long").alias("id"), scaled(vec, scale).alias("x"))
    first = kept.orderBy(F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256).asc_nulls_last(), "x").limit(k).collect()
    centroids = np.array([r.x for r in first], np.int64).reshape(-1, dimensions)
    start = {"cluster": F.lit(0), "upper": F.lit(float("inf")), "lower": F.array_repeat(F.lit(0.0), len(centroids)), "distance": F.lit(0).cast("long"), "computed": F.lit(0)}
    state = kept.withColumns(start)
    moved = np.zeros(len(centroids))
    for n in range(rounds + 1):
        if not len(centroids):
            break
        used, spent = spent, []
        with scope(spent):
            state = written(state.mapInArrow(_round(centroids, moved), STATE), f"elkan-{n}")
        released(spark, used)  # the round before, which this one has read
        if n < rounds:
            sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i].cast("long")).alias(f"s{i}") for i in range(dimensions)])
            old = centroids.copy()
            for r in sums.collect():  # k rows
                centroids[r.cluster] = [r[f"s{i}"] // r.n for i in range(dimensions)]
            moved = _root_up(squares(centroids, old))
    return state, centroids


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, centroids = clustered(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    inertia = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    shas = spark.createDataFrame([(n, centroid_sha256(c)) for n, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    whole = inertia.agg(F.sum("sum")).first()[0]
    facts = shas.join(inertia, "cluster").select("cluster", "centroid_sha256", F.expr("try_cast(sum AS long)").alias("cluster_inertia"))
    done = state.join(F.broadcast(facts), "cluster")  # a row for each centroid
    total = F.lit(whole).cast("decimal(38,0)")
    return done.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", total.try_cast("long").alias("inertia"), "centroid_sha256")


_VECTORS = """
raw AS (
  SELECT vec_id, [CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len([1 FOR c IN embedding IF c IS NOT NULL AND isfinite(c)]) = 64),
r0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS cluster, x FROM raw
  QUALIFY cluster < 16)"""


def _assignment(n: int) -> str:
    return f"""
a{n} AS MATERIALIZED (
  SELECT vec_id, v.x AS x, min({{'d': d, 'c': cluster}}) AS m
  FROM (SELECT row_number() OVER () AS row, vec_id, x FROM raw) v
  JOIN (SELECT cluster, x AS y FROM r{n}) c ON true,
  LATERAL (SELECT CAST(list_sum([(v.x[i] - c.y[i]) * (v.x[i] - c.y[i]) FOR i IN range(1, 65)]) AS BIGINT) AS d)
  GROUP BY row, vec_id, v.x)"""


def _update(n: int) -> str:
    return f"""
r{n + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(u.x, o.x) AS x
  FROM r{n} o LEFT JOIN (
    SELECT cluster, list(m ORDER BY i) AS x
    FROM (SELECT m.c AS cluster, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
          FROM a{n}, range(1, 65) AS t(i) GROUP BY ALL)
    GROUP BY cluster) u USING (cluster))"""


SQL = f"""
WITH {_VECTORS},
{','.join(_assignment(n) + ',' + _update(n) for n in range(ROUNDS))},
{_assignment(ROUNDS)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance,
       CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(r.x, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN r{ROUNDS} r ON r.cluster = m.c
"""
