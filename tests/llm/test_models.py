"""The trained models against direct forms: quality by least squares and min-max means, toxicity by all paths of a chain."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import quality, toxicity
from tidewright.llm.common import table


def direct_quality(spark, docs, labels):
    """Scores by text as a dict, of the documents (id, text) and labels (id, quality or None) as rows: all features in one
    matrix, ridge as least squares over rows added for the penalty, and the isotonic fit by its min-max formula."""
    best = {}
    for i, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5 != 0:
            best[i] = max(best.get(i, y), y)
    texts = {}
    for i, t in docs:
        assert i not in texts or i not in best  # of several rows of one id any could be the trained one
        texts[i] = t or ""
    ids = [i for i in best if i in texts]
    frame = spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.pmod(F.xxhash64("i", F.lit(quality.SEED)), F.lit(quality.FOLDS)).alias("fold"))
    folds = {r.i: r.fold for r in frame.collect()}
    rng = np.random.default_rng(quality.SEED)
    w = rng.normal(0, np.sqrt(2 * quality.GAMMA), (quality.STATISTICS, quality.FEATURES))
    b = rng.uniform(0, 2 * np.pi, quality.FEATURES)
    x = np.array([quality.statistics(texts[i]) for i in ids])
    y, fold = np.array([best[i] for i in ids], float), np.array([folds[i] for i in ids])
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-6] = 1

    def features(t):
        z = np.clip((quality.statistics(t) - mean) / scale, -8, 8)
        return np.concatenate([[1], 0.1 * z, [np.sqrt(2 / quality.FEATURES) * np.cos(sum(z[k] * w[k, j] for k in range(len(z))) + b[j]) for j in range(quality.FEATURES)]])

    f = np.array([features(texts[i]) for i in ids])

    def ridge(rows):
        d = f.shape[1]
        return np.linalg.lstsq(np.vstack([f[rows], np.sqrt(quality.RIDGE) * np.eye(d)]), np.concatenate([y[rows], np.zeros(d)]))[0]

    by_fold = {c: ridge(fold != c) for c in set(fold.tolist())}
    raw = np.array([f[k] @ by_fold[c] for k, c in enumerate(fold.tolist())])
    at, place = np.unique(np.round(raw, 4), return_inverse=True)
    n = np.bincount(place)
    total, count = np.concatenate([[0], np.cumsum(np.bincount(place, weights=y))]), np.concatenate([[0], np.cumsum(n)])
    lo, hi = np.arange(len(at))[:, None], np.arange(len(at))[None, :]
    means = np.where(hi >= lo, (total[hi + 1] - total[lo]) / np.maximum(count[hi + 1] - count[lo], 1), np.inf)
    least = np.minimum.accumulate(means[:, ::-1], 1)[:, ::-1]  # of the runs from lo on to i or beyond
    level = np.array([least[: i + 1, i].max() for i in range(len(at))])
    values = np.unique(level)
    knots = np.array([(at * n)[level == v].sum() / n[level == v].sum() for v in values])
    weights = ridge(np.ones(len(ids), bool))
    return {t: float(np.interp(features(t) @ weights, knots, values)) for t in {t or "" for _, t in docs}}


def test_quality_equals_the_direct_solution(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    docs = docs.unionByName(docs.limit(2).withColumns({"doc_id": F.col("doc_id") + 10**9, "text": F.lit(None).cast("string")}))
    want = direct_quality(spark, [(r.doc_id, r.text) for r in docs.collect()], [(r.doc_id, r.quality) for r in labels.collect()])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = quality.scored(docs.repartition(5), quality.fit_quality(docs, labels)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.score == pytest.approx(want[texts[r.doc_id]], abs=1e-6) and r.predicted == (r.score >= 0.3)


def emission(weights, token):
    return sum(weights[k] for k in toxicity.features(token.lower()))


def paths(emit, trans, start):
    """The score of each path of a chain."""
    for y in itertools.product((0, 1), repeat=len(emit)):
        yield y, start[y[0]] + sum(trans[a, b] for a, b in itertools.pairwise(y)) + sum(e for e, k in zip(emit, y, strict=True) if k)


def test_document_scores_and_spans_by_all_paths(spark):
    rng = np.random.default_rng(8)
    weights, trans, start = rng.normal(0, 0.7, toxicity.SLOTS), rng.normal(size=(2, 2)), rng.normal(size=2)
    bend = (np.array([-3.0, -1.0, 0.5, 2.0]), np.array([0.05, 0.2, 0.6, 0.9]))
    words = ["ab", "Ünder", "zorgl", "zorglix", "it's", "x", "QUAFF", "naïve", "🙂", "9", "ba-ba"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 8))) + "." * int(rng.integers(0, 3)) for _ in range(60)] + ["", None, " \n "]
    texts += texts[:3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.Field(weights, trans, start, bend)).collect()}
    assert len(got) == len(texts)
    hits = 0
    for i, text in enumerate(texts):
        tokens = list(toxicity.TOKEN.finditer(text or ""))
        p = np.zeros(len(tokens))
        if tokens:
            scores = list(paths([emission(weights, m.group()) for m in tokens], trans, start))
            total = sum(np.exp(s) for _, s in scores)
            p = sum(np.exp(s) * np.array(y) for y, s in scores) / total
        any_toxic = 1 - np.prod(1 - p)
        want = np.interp(np.log(any_toxic / (1 - any_toxic)) if any_toxic else -np.inf, *bend)
        assert got[i].score == pytest.approx(want, abs=1e-9) and got[i].predicted == (want >= 0.7)
        spans = [(m.start(), m.end(), x) for m, x in zip(tokens, p, strict=True) if x >= 0.5]
        assert [(s.start, s.end) for s in got[i].spans] == [s[:2] for s in spans]
        assert [s.p for s in got[i].spans] == pytest.approx([s[2] for s in spans], abs=1e-9)
        hits += len(spans)
    assert hits > 20


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(9)
    weights, trans, start = rng.normal(0, 0.5, toxicity.SLOTS), rng.normal(size=(2, 2)), rng.normal(size=2)
    texts = [["zorgl", "ab", "zorglix"], ["ab"], ["naïve", "zorgl", "zorgl", "quaff"]]
    truth = [[1, 0, 1], [0], [0, 1, 1, 0]]
    words = sorted({w for t in texts for w in t})
    slots = [toxicity.features(w) for w in words]
    arrays = {
        "ids": np.array([words.index(w) for t in texts for w in t]),
        "first": np.array([k == 0 for t in texts for k in range(len(t))]),
        "truth": np.array([y == 1 for t in truth for y in t]),
        "owner": np.repeat(np.arange(len(words)), [len(s) for s in slots]),
        "slots": np.concatenate(slots),
        "n_words": np.array(len(words)),
    }
    row = toxicity._gradient(weights, trans, start, arrays).to_pylist()[0]
    small = np.frombuffer(row["small"])
    g = np.zeros(toxicity.SLOTS)
    g[np.frombuffer(row["at"], np.int32)] = np.frombuffer(row["g"], np.float32)

    def likelihood():
        out = 0.0
        for tokens, y in zip(texts, truth, strict=True):
            scores = dict(paths([emission(weights, w) for w in tokens], trans, start))
            out += scores[tuple(y)] - np.log(sum(np.exp(s) for s in scores.values()))
        return out

    def slope(array, at, h=1e-5):
        old = array[at]
        array[at] = old + h
        up = likelihood()
        array[at] = old - h
        down = likelihood()
        array[at] = old
        return (up - down) / (2 * h)

    for k in set(arrays["slots"].tolist()):
        assert g[k] == pytest.approx(slope(weights, k), abs=1e-4)
    for at in np.ndindex(2, 2):
        assert small[:4].reshape(2, 2)[at] == pytest.approx(slope(trans, at), abs=1e-4)
    for k in (0, 1):
        assert small[4 + k] == pytest.approx(slope(start, k), abs=1e-4)
    assert small[-1] == 8 and not set(np.flatnonzero(g)) - set(arrays["slots"].tolist())
