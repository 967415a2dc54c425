"""Quality scores: random Fourier features over document statistics, ridge by partition-summed normal equations, isotonic calibration.

The statistics of a text (lengths, shares of byte classes, repetition of words and lines) are standardised; cosines of random
projections approximate a Gaussian kernel over them. Each partition of the training rows sums its part of the normal
equations, apart for each of FOLDS folds; the sums are added up by fold. Every fold is scored by the ridge solution of the
others, and pool-adjacent-violators over these scores gives the calibration; the final weights use all folds.
Training reads at most MAX_TRAIN labelled rows, those first by a hash of the id; scoring is one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import bucket_of, table, text_of

#: Bound of the training sample, in labelled rows.
MAX_TRAIN = 20_000
#: Partitions that hold the training statistics, so the sums to add up do not grow with the input's partitions.
TRAIN_PARTS = 16
FEATURES, FOLDS, SEED, RIDGE, GAMMA = 160, 4, 7, 1.0, 0.06
KEEP_FROM = 0.3
SPACES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)

_CLASS = np.zeros(256, np.int64)  # 0: other bytes
for _k, _bytes in enumerate((SPACES, range(97, 123), range(65, 91), range(48, 58), b".,;:'\"()-?", b"!", b"#$%&*", b"|", b"<>[]{}=/\\_~^@+`", range(128, 256)), 1):
    _CLASS[list(_bytes)] = _k
STATISTICS = 24


def statistics(text: str) -> np.ndarray:
    """The statistics of a whole text, each of the size of 1; for an empty text zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(STATISTICS)
    if not raw:
        return out
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASS, weights=hist, minlength=11) / len(raw)
    words = raw.split()
    lines = raw.split(b"\n")
    n = max(1, len(words))
    distinct = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:])) / n
    out[:11] = shares
    out[11] = np.log1p(len(raw)) / 5
    out[12] = np.log1p(len(words)) / 5
    out[13] = min(5.0, len(raw) / n / 6)
    out[14] = distinct / n
    out[15] = np.log1p(distinct) / np.log1p(n)
    out[16] = same
    out[17] = len(set(lines)) / len(lines)
    out[18] = min(5.0, np.log1p(len(raw) / len(lines)) / 5)
    p = hist[hist > 0] / len(raw)
    out[19] = float(-(p * np.log(p)).sum()) / 3
    letters = shares[2] + shares[3] + shares[10]
    out[20] = shares[3] / letters if letters else 0
    out[21] = (hist[list(b"#$%&*|!")].sum()) / n
    out[22] = (hist[46] + hist[63]) / n
    out[23] = len(words[0]) / 10 if words else 0
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = fourier((x - self.mean) / self.scale) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.values), 0.0, 1.0)


def fourier(z: np.ndarray) -> np.ndarray:
    """A constant, the standardised statistics themselves and the random Fourier features."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, np.sqrt(2 * GAMMA), (z.shape[1], FEATURES))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip(z, -8, 8)
    return np.hstack([np.ones((len(z), 1)), z * 0.1, np.sqrt(2 / FEATURES) * np.cos(z @ w + b)])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, steps: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and non-decreasing values of the least-squares fit, weighted by w; equal x are pooled
    first. A block's knot is its centre, or with steps both its ends, so that it holds from one to the other."""
    w = np.ones(len(x)) if w is None else w
    x, at = np.unique(x, return_inverse=True)
    weight = np.bincount(at, weights=w)
    mean = np.bincount(at, weights=y * w) / weight
    blocks: list[list[float]] = []  # mean, weight, sum of x * weight, first and last x
    for m, n, v in zip(mean, weight, x, strict=True):
        blocks.append([m, n, v * n, v, v])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, s2, _, end = blocks.pop()
            m1, w1, s1, begin, _ = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, s1 + s2, begin, end])
    if steps:
        return np.array([e for *_, a, b in blocks for e in (a, b)]), np.repeat([b[0] for b in blocks], 2)
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks])


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [statistics(t.as_py()).tolist() for t in batch.column("__text")]
        yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("order"), batch.column("fold"), pa.array(x, pa.list_(pa.float64()))], names=["y", "order", "fold", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, STATISTICS)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, STATISTICS))
    n = 0
    for batch in batches:
        x = _matrix(batch.column("x"))
        total += np.stack([x.sum(0), (x * x).sum(0)])
        n += len(x)
    yield pa.RecordBatch.from_pydict({"n": [n], "sums": [total.tobytes()]})


def _normal_sums(mean: np.ndarray, scale: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = 1 + STATISTICS + FEATURES
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            f = fourier((_matrix(batch.column("x")) - mean) / scale)
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            for k in np.unique(fold).tolist():
                g = f[fold == k]
                sums.setdefault(k, np.zeros((d, d + 1)))
                sums[k] += np.hstack([g.T @ g, (g.T @ y[fold == k])[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fold", "sums"])

    return run


def _add(key, frame):
    import pandas as pd

    return pd.DataFrame({"fold": [key[0]], "sums": [sum(np.frombuffer(s) for s in frame["sums"]).tobytes()]})


def labelled(labels: DataFrame, label: str, is_train: Column) -> DataFrame:
    """doc_id, y and order (a hash of the id) of the labels to train on; a repeated label counts as its largest."""
    known = labels.where(labels.doc_id.isNotNull() & labels[label].isNotNull()).groupBy("doc_id").agg(F.max(labels[label]).cast("double").alias("y"))
    return known.where(is_train).withColumn("order", F.xxhash64(F.col("doc_id"), F.lit(SEED)))


def training_rows(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """chosen, labels of bounded number, each with its __text: one row a label, of an id that several rows have the text with
    the least hash. So there are never more rows than labels, however often an id repeats."""
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("__text"))
    found = rows.join(F.broadcast(chosen), "doc_id").groupBy(*chosen.columns)
    return found.agg(F.min_by("__text", F.struct(F.xxhash64("__text"), F.col("__text"))).alias("__text"))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_TRAIN) -> QualityModel:
    """The model from labelled documents whose bucket of five is not 0; without any, every score is 1."""
    chosen = labelled(labels, "quality", bucket_of(F.col("doc_id"), 5) != 0).orderBy("order", "doc_id").limit(limit)
    x = training_rows(docs, chosen, id_col, text_col)
    x = x.select("y", "order", F.pmod("order", F.lit(FOLDS)).cast("int").alias("fold"), "__text").mapInArrow(_statistics_of, "y double, order long, fold int, x array<double>")
    x = x.repartition(TRAIN_PARTS, "order").coalesce(TRAIN_PARTS).persist()  # dealt by the hash of the id, so equal texts spread
    moments = [(r.n, np.frombuffer(r.sums).reshape(2, STATISTICS)) for r in x.mapInArrow(_moments, "n long, sums binary").where("n > 0").collect()]
    n = sum(m for m, _ in moments)
    if not n:
        x.unpersist()
        return QualityModel(np.zeros(STATISTICS), np.ones(STATISTICS), np.zeros(1 + STATISTICS + FEATURES), np.array([0.0]), np.array([1.0]))
    total = sum(s for _, s in moments)
    mean = total[0] / n
    scale = np.sqrt(np.maximum(total[1] / n - mean * mean, 0))
    scale = np.where(scale < 1e-6, 1.0, scale)
    parts = x.mapInArrow(_normal_sums(mean, scale), "fold int, sums binary").groupBy("fold").applyInPandas(_add, "fold int, sums binary").collect()
    d = 1 + STATISTICS + FEATURES
    folds = {r.fold: np.frombuffer(r.sums).reshape(d, d + 1) for r in parts}
    whole = sum(folds.values())
    solve = lambda s: np.linalg.solve(s[:, :d] + RIDGE * np.eye(d), s[:, d])
    weights = {k: solve(whole - s if len(folds) > 1 else whole) for k, s in folds.items()}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = fourier((_matrix(batch.column("x")) - mean) / scale)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            raw = np.zeros(len(f))
            for k in np.unique(fold).tolist():
                raw[fold == k] = f[fold == k] @ weights[k]
            yield pa.RecordBatch.from_arrays([pa.array(np.round(raw, 4)), batch.column("y")], names=["raw", "y"])

    pairs = x.mapInArrow(held, "raw double, y double").toPandas()  # two numbers for each training row, so bounded by limit
    x.unpersist()
    knots, values = isotonic(pairs["raw"].to_numpy(), pairs["y"].to_numpy())
    return QualityModel(mean, scale, solve(whole), knots, values)


def scored(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, and with carry the input row as a struct.

    Null and empty texts are scored as the empty text. Repeated rows get equal scores; no rows give no rows; columns other
    than id and text have no influence.
    """

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array([statistics(t.as_py()) for t in texts]).reshape(-1, STATISTICS)))

    columns = [docs[id_col].alias("doc_id"), (bucket_of(docs[id_col], 5) == 0).alias("held_out"), *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else [])]
    return docs.select(*columns, score(text_of(docs, text_col)).alias("score")).withColumn("predicted", F.when(F.col("score") >= KEEP_FROM, 1).otherwise(0))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with their own columns. Null and empty texts are judged as the empty text, repeated
    rows alike; without labels nothing is rejected, no rows give no rows, and further columns are carried along."""
    return scored(docs, fit_quality(docs, labels, id_col, text_col), id_col, text_col, carry=True).where("predicted = 1").select("row.*")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit_quality(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")
