"""Operators 11 to 13 against brute force and SQL, and their odd cases."""

import hashlib
import random
from collections import Counter
from math import exp, floor, log

import numpy as np
import pytest
import xxhash

from tests.compare import same
from tidewright.llm import clusters, fingerprints, whitening

SMALL = "/root/testdata/sf0.001"


def test_clusters_equal_sql_and_skip_distances(spark):
    same(clusters.op11_clusters(spark, SMALL), clusters.SQL, SMALL)
    rng = np.random.default_rng(1)  # well-parted groups, where bounds leave out most distances
    centres = rng.normal(0, 8, (16, 64))
    rows = [(i, (centres[i % 16] + rng.normal(0, 0.05, 64)).tolist()) for i in range(800)]
    state, _ = clusters.clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert np.mean([r.computed for r in state.select("computed").collect()]) < 64 * 0.5


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, np.array([floor(64 * float(c)) for c in v], object)) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and np.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1].tolist()))
    cents = [x for _, x in order[:k]]
    nearest = lambda x: min(((int(((x - c) ** 2).sum()), j) for j, c in enumerate(cents)))
    for _ in range(rounds):
        at = [nearest(x)[1] for _, x in kept]
        for j in range(len(cents)):
            mine = [x for (_, x), a in zip(kept, at, strict=True) if a == j]
            if mine:
                cents[j] = np.array([int(s) // len(mine) for s in sum(mine)], object)
    return Counter((i, nearest(x)[1], nearest(x)[0]) for i, x in kept)


@pytest.mark.parametrize("number", [0, 1, 9, 120])
def test_clusters_of_ties_nulls_and_repeated_rows(spark, number):
    rng = random.Random(number)
    rows = [(None if n % 17 == 5 else n % 50, [rng.choice([-1.0, 0.0, 1.0]) if d < 3 else 0.0 for d in range(64)]) for n in range(number)]
    rows += [(1, None), (2, [1.0] * 63), (3, [None] + [1.0] * 63), (4, [float("nan")] * 64), (5, [float("inf")] + [0.0] * 63), (6, [])] if number else []
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string")
    state, _ = clusters.clustered(df, "vec_id", "embedding")
    assert Counter((r.id, r.cluster, r.distance) for r in state.collect()) == plain_clusters(rows)


def test_clusters_hold_huge_components(spark):
    rows = [(n, [1e30 * (-1) ** n] + [float(n)] * 63) for n in range(20)]
    state, _ = clusters.clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert all(r.distance >= 0 for r in state.collect())


def test_bounds_are_conservative():
    rng = np.random.default_rng(3)
    x = rng.integers(-60, 60, (500, 64))
    cents = x[:16].copy()
    cluster, upper, lower = np.zeros(500, np.int64), np.full(500, np.inf), np.zeros((500, 16))
    moved = np.zeros(16)
    for _ in range(4):
        cluster, upper, lower, best, _ = clusters.assigned(x, cluster, upper, lower, cents, moved)
        d = ((x[:, None] - cents[None]) ** 2).sum(axis=2)
        assert (d.argmin(axis=1) == cluster).all() and (best == d.min(axis=1)).all()
        assert (upper >= np.sqrt(best)).all() and (lower <= np.sqrt(d)).all()
        new = np.stack([x[cluster == j].sum(axis=0) // max(1, (cluster == j).sum()) for j in range(16)])
        moved, cents = clusters._root_up(clusters.squares(new, cents)), new


def test_jacobi_keeps_small_eigenvalues():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    want = 10.0 ** -np.arange(12)
    scale = 10.0 ** rng.integers(-6, 6, 12)
    a = (q * want) @ q.T
    values, vectors = whitening.jacobi(a)
    assert np.allclose(values, want, rtol=0, atol=1e-15) and np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-14)
    graded = np.outer(scale, scale) * (np.eye(12) + 0.1 * (q @ np.diag(rng.uniform(0, 1, 12)) @ q.T))
    graded = (graded + graded.T) / 2
    small = whitening.jacobi(graded)[0][-1]
    inverse = 1 / np.linalg.eigvalsh(np.linalg.inv(graded))[-1]  # the smallest one as the largest of the inverse, accurately
    assert abs(small / inverse - 1) < 1e-9


def plain_whitening(rows, d):
    kept = [(i, [floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), [sum(int(x) for x in col) for col in fit.T]
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(d, d))
    return kept, n, sums, values[::-1], vectors[:, ::-1], fit.mean(axis=0)


def test_whitening_equals_direct_solution(spark):
    rng = np.random.default_rng(2)
    mix = rng.normal(size=(24, 24))
    rows = [(n, (rng.normal(size=24) @ mix).tolist()) for n in range(300)]
    rows += rows[:40] * 3 + [(None, rows[7][1]), (900, None), (901, [None] * 24), (902, [float("nan")] * 24), (903, [1.0] * 23), (904, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n int")
    got = whitening.whitening(df, "vec_id", "embedding").collect()
    kept, n, sums, values, vectors, mean = plain_whitening(rows, 24)
    assert len(got) == 16 * len(kept) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    want = Counter((i, sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True))) for i, v in kept)
    assert Counter((r.id, r.deviation) for r in got if r.component == 1) == want
    expected = {i: np.abs((np.array(v) - mean) @ vectors[:, :16] / np.sqrt(values[:16])) for i, v in kept}
    for r in got:
        assert abs(abs(r.whitened) - expected[r.id][r.component - 1]) < 1e-8
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9


def test_whitening_of_few_flat_and_huge_vectors(spark):
    frame = lambda rows: whitening.whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    assert frame([]) == [] and frame([(1, None), (2, [])]) == []
    alone = frame([(1, [0.5, 1.0]), (2, [0.5, 1.0])])
    assert len(alone) == 4 and all((r.n, r.deviation, r.whitened, r.explained) == (1, 0, None, None) for r in alone)
    line = frame([(n, [float(n), 2.0 * n, 0.0]) for n in range(5)])
    assert all((r.whitened is None) == (r.component > 1) for r in line) and line[0].identity_error < 1e-12
    huge = frame([(n, [1e30 * (-1) ** n, float(n)]) for n in range(6)])
    assert len(huge) == 12 and max(r.identity_error for r in huge) < 1e-6


def spark_xx(value, seed=42):
    h = xxhash.xxh64_intdigest(value, seed)
    return h - (1 << 64) if h >= 1 << 63 else h


def long_bytes(v):
    return (v & (2**64 - 1)).to_bytes(8, "little")


def plain_samples(text, samples=fingerprints.SAMPLES):
    """The least a of each sample over all words, no pair left out."""
    out = []
    bag = Counter(spark_xx(w.encode()) for w in (text.lower().split() or [""]))
    for k in range(samples):
        best = None
        for term, weight in bag.items():
            h = spark_xx(k.to_bytes(4, "little"), spark_xx(long_bytes(term)) & (2**64 - 1)) & (2**64 - 1)
            u = [((h >> s & 65535) + 0.5) / 65536 for s in (0, 16, 32, 48)]
            b = ((spark_xx(long_bytes(h)) & (2**32 - 1)) + 0.5) / 2**32
            r, c = -log(u[0] * u[1]), -log(u[2] * u[3])
            t = floor(log(weight) / r + b)
            a = c * exp(-r * (t - b + 1))
            best = min(best or (a, term, t), (a, term, t))
        out.append(best[1:])
    return out


def plain_likeness(a, b):
    return sum(x == y for x, y in zip(plain_samples(a), plain_samples(b), strict=True)) / fingerprints.SAMPLES


def plain_chain(rows):
    keys = sorted({(i is None, i or 0, spark_xx((t or "").encode()), spark_xx((t or "").encode(), spark_xx((1).to_bytes(4, "little")) & (2**64 - 1)), t or "") for i, t in rows})
    after = {(k[0], k[1], k[4]): keys[(n + 1) % len(keys)][4] for n, k in enumerate(keys)}
    for i, t in rows:
        text = t or ""
        follow, cut = after[(i is None, i or 0, text)], len(text) // 2
        yield i, text, follow, text[: len(text) - cut] + follow[:cut]


ODD = [(3, "a b b c  c c"), (1, "B a"), (None, "x y z"), (None, None), (2, ""), (2, " \t"), (1, "B a"), (7, "é ü 漢字 " * 9), (9, "w " * 3000), (8, "one")]


@pytest.mark.parametrize("bounds", [1, 4, 64])
@pytest.mark.parametrize("rows", [ODD, ODD[:1], [], [(5, "hot text here")] * 300 + [(n % 40, f"text {n % 7} of {n}") for n in range(200)]])
def test_fingerprints_equal_brute_force(spark, rows, bounds):
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, key int, bucket string")
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in fingerprints.neighbour_fingerprints(df, bounds=bounds).collect())
    known: dict = {}
    like = lambda a, b: known.setdefault((a, b), plain_likeness(a, b))
    want = Counter()
    for i, text, follow, edited in plain_chain(rows):
        want[(i, len(text), hashlib.sha256(edited.encode()).hexdigest(), like(text, edited), like(text, follow))] += 1
    assert got == want


def test_fingerprints_meet_generalised_jaccard(spark):
    rng = random.Random(4)
    rows, truth = [], []
    for n in range(150):
        a, b = (Counter({f"w{w}": rng.randint(1, 9) for w in rng.sample(range(60), 30)}) for _ in range(2))
        truth.append(sum((a & b).values()) / sum((a | b).values()))
        rows += [(2 * n, " ".join(a.elements())), (2 * n + 1, " ".join(b.elements()))]
    got = {r.doc_id: r.parts for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), samples=64).collect()}
    found = [np.mean([x == y for x, y in zip(got[2 * n], got[2 * n + 1], strict=True)]) for n in range(150)]
    assert abs(np.mean(found) - np.mean(truth)) < 0.02


def test_fingerprints_need_no_python(spark):
    found = fingerprints.op13_fingerprints(spark, SMALL)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and found.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
