"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

The tokens that train the field are labelled from document labels: a lower-case word, or an opening of at least four letters
of it, is a mark if enough different toxic training texts hold it and hardly any other text does; a token of a toxic text is
TOXIC if a mark fits it, all others are CLEAN. The field has two states; a token's score is a sum of weights of its word,
openings and ending (hashed), plus transition weights. It is trained by gradient steps on the exact likelihood, with
marginals from forward-backward. Both passes run over all tokens of a block of texts at once: products of 2 x 2 matrices,
scanned in lanes, with a step that forgets the past at the start of each text.
A document's score is the calibrated probability that any token is toxic; its spans are the tokens whose marginal is 0.5 or
more, as code-point offsets.

Training reads at most MAX_TRAIN labelled rows in blocks of texts: each block counts the words that may be marks and, in each
step, sums its gradient; the counts are added up by word, the gradients, of fixed size and bounded number, on the driver. A
third of the sample is kept from the field and fits the calibration, so that scores are not over-sure. Scoring reads every
whole text.
"""

from __future__ import annotations

import io
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import bucket_of, table, text_of, written
from tidewright.llm.quality import isotonic, labelled, training_rows

#: Bound of the training sample, in labelled rows; its partitions, and the share of it that calibrates (one in).
MAX_TRAIN, TRAIN_PARTS, CALIBRATE = 6_000, 16, 3
#: How unlikely a mark must be by chance (odds against, for all words together), and the largest share of its texts that are clean.
MARK_ODDS, MARK_CLEAN = 20, 0.35
SLOTS, STEPS, RATE, DECAY = 1 << 16, 12, 1.0, 1e-4
#: Tokens of one block of the field; texts are never cut, a longer text is a block of its own.
BLOCK = 200_000
#: Words whose scores a worker remembers.
REMEMBER = 300_000
TOXIC_FROM = 0.7
TOKEN = re.compile(r"[^\W_]+")
#: A field without training: no token is toxic.
QUIET = (np.zeros(SLOTS), np.array([[0.0, -20.0], [0.0, -20.0]]), np.array([0.0, -20.0]), (np.zeros(1), np.zeros(1)))


def openings(word: str) -> list[str]:
    return [word[:k] for k in range(4, min(8, len(word)))]


_ANY = zlib.crc32(b"any") % SLOTS
_WORD, _OPENING, _ENDING = (zlib.crc32(k) for k in (b"w", b"p", b"s"))


def features(word: str) -> list[int]:
    """Slots of a lower-case word: one that all words share, itself, its openings, its ending."""
    crc, last = zlib.crc32, SLOTS - 1  # a power of two
    if word.isascii():
        e = word.encode()
        return [_ANY, crc(e, _WORD) & last, *[crc(e[:k], _OPENING) & last for k in range(4, min(8, len(e)))], crc(e[-3:], _ENDING) & last]
    code = lambda part, kind: crc(part.encode("utf-8", "surrogatepass"), kind) & last
    return [_ANY, code(word, _WORD), *[code(p, _OPENING) for p in openings(word)], code(word[-3:], _ENDING)]


def names(word: str) -> list[int]:
    """Hashes of what may be a mark in a lower-case word: the word itself and its openings."""
    return [xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass")) >> 1 for n in ("w" + word, *("p" + p for p in openings(word)))]


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """y / x after each of n steps (x, y) -> (a x + b y, c x + d y) from (1, 1); all numbers positive.

    The steps are laid out in lanes: the product of each lane's steps comes first, then the state at the start of each lane,
    then all lanes run at once. Two passes of sqrt(n) array operations instead of n scalar ones.
    """
    n = len(a)
    lanes = max(1, int(np.sqrt(n)))
    length = -(-n // lanes)
    a, b, c, d = (np.ascontiguousarray(np.concatenate([x, np.full(lanes * length - n, fill)]).reshape(lanes, length).T) for x, fill in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    p, q, r, s = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for k in range(length):
        p, q, r, s = a[k] * p + b[k] * r, a[k] * q + b[k] * s, c[k] * p + d[k] * r, c[k] * q + d[k] * s
        if k % 8 == 7:
            z = p + q + r + s
            p, q, r, s = p / z, q / z, r / z, s / z
    start = np.empty(lanes)
    y = 1.0
    for k in range(lanes):
        start[k] = y
        y = (r[k] + s[k] * y) / (p[k] + q[k] * y)
    out = np.empty((length, lanes))
    y = start
    for k in range(length):
        y = (c[k] + d[k] * y) / (a[k] + b[k] * y)
        out[k] = y
    return out.T.ravel()[:n]


def marginals(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray, want_pairs: bool = False):
    """P(state 1) of every token; emit: score of state 1 over state 0, first: True at the start of each text. With want_pairs
    also the summed pair marginals (2, 2) within texts and the summed marginals of first tokens (2,)."""
    e = np.exp(np.clip(emit, -25, 25))
    t, s = np.exp(trans), np.exp(start)
    forward = _scan(np.where(first, s[0], t[0, 0]), np.where(first, s[0], t[1, 0]), e * np.where(first, s[1], t[0, 1]), e * np.where(first, s[1], t[1, 1]))
    last = np.append(first[1:], True)[::-1]
    e_next = np.append(e[1:], 1.0)[::-1]
    backward = _scan(np.where(last, 1.0, t[0, 0]), np.where(last, 1.0, t[0, 1] * e_next), np.where(last, 1.0, t[1, 0]), np.where(last, 1.0, t[1, 1] * e_next))[::-1]
    odds = forward * backward
    p = odds / (1 + odds)
    if not want_pairs:
        return p
    inner = np.flatnonzero(~first[1:])
    x, y = forward[inner], e[inner + 1] * backward[inner + 1]
    joint = np.stack([np.full(len(inner), t[0, 0]), t[0, 1] * y, t[1, 0] * x, t[1, 1] * x * y])
    p1 = p[first]
    return p, (joint / joint.sum(0)).sum(1).reshape(2, 2), np.array([(1 - p1).sum(), p1.sum()])


class Field:
    """Scores texts; remembers the scores of words, up to a bound."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, start: np.ndarray, bend: tuple[np.ndarray, np.ndarray], known: dict[str, float] | None = None):
        self.weights, self.trans, self.start, self.bend = weights, trans, start, bend
        self.known = {} if known is None else known

    def learn(self, token_lists: list[list[str]]) -> None:
        """Scores of the words that are not known yet."""
        if len(self.known) > REMEMBER:
            self.known.clear()
        new = [w for w in dict.fromkeys(chain.from_iterable(token_lists)) if w not in self.known]
        if new:
            slots = [features(w.lower()) for w in new]
            ends = np.cumsum([len(x) for x in slots])
            sums = np.add.reduceat(self.weights[np.fromiter(chain.from_iterable(slots), np.int64, ends[-1])], np.concatenate([[0], ends[:-1]]))
            self.known.update(zip(new, sums.tolist(), strict=True))

    def tags(self, token_lists: list[list[str]]) -> list[np.ndarray]:
        """P(TOXIC) of each token of each text."""
        sizes = [len(t) for t in token_lists]
        n = sum(sizes)
        if not n:
            return [np.zeros(0) for _ in token_lists]
        self.learn(token_lists)
        emit = np.fromiter(map(self.known.__getitem__, chain.from_iterable(token_lists)), float, n)
        first = np.zeros(n, bool)
        ends = np.cumsum(sizes)
        first[(ends - sizes)[np.array(sizes) > 0]] = True
        p = marginals(emit, first, self.trans, self.start)
        return np.split(p, ends[:-1])

    def raw(self, p: np.ndarray) -> float:
        """Log odds that any token is toxic, taking the tokens' marginals as independent."""
        none = float(np.log1p(-np.minimum(p, 1 - 1e-9)).sum())
        some = -np.expm1(min(none, -1e-12))
        return float(np.log(some) - none)

    def score(self, p: np.ndarray) -> float:
        return float(np.interp(self.raw(p), *self.bend))


def _calibrate(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the isotonic fit of labels to log odds; half a row of the other label at each end keeps values off 0 and 1."""
    if not len(raw):
        return np.array([-4.0, 0.0, 4.0]), np.array([0.02, 0.5, 0.98])
    ends = np.array([raw.max(), raw.min()])
    return isotonic(np.concatenate([raw, ends]), np.concatenate([y > 0.5, [False, True]]), np.concatenate([weight, np.full(2, min(0.5, weight.min()))]), steps=True)


def _blocks(token_lists: list[list[str]]) -> Iterator[list[list[str]]]:
    held, n = [], 0
    for t in token_lists:
        if held and n + len(t) > BLOCK:
            yield held
            held, n = [], 0
        held.append(t)
        n += len(t)
    if held:
        yield held


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _each(blocks: DataFrame, work: Callable, schema: str, column: str = "block") -> DataFrame:
    """work(arrays) -> a record batch or None, for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                with np.load(io.BytesIO(blob.as_py())) as arrays:
                    out = work(arrays)
                if out is not None:
                    yield out

    return blocks.select(column).mapInArrow(run, schema)


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole texts as arrays: label and size of each text, words in lower case and the number of each token's word."""
    for batch in batches:
        ys = batch.column("y").to_pylist()
        texts = [[w.lower() for w in TOKEN.findall(t.as_py())] for t in batch.column("__text")]
        at = 0
        for block in _blocks(texts):
            y, at = ys[at : at + len(block)], at + len(block)
            words = sorted({w for t in block for w in t})
            number = {w: i for i, w in enumerate(words)}
            ids = np.fromiter((number[w] for t in block for w in t), np.int32, sum(map(len, block)))
            joined = np.frombuffer("\n".join(words).encode("utf-8", "surrogatepass"), np.uint8)
            yield pa.RecordBatch.from_pydict({"block": pa.array([_packed(y=np.array(y), sizes=np.array([len(t) for t in block]), ids=ids, words=joined)], pa.binary())})


def _words(arrays) -> list[str]:
    joined = arrays["words"].tobytes().decode("utf-8", "surrogatepass")
    return joined.split("\n") if joined else []


def marks(blocks: DataFrame, toxic: int, clean: int) -> set[int]:
    """Words and openings (as hashes) that mark toxic texts, of so many toxic and clean ones.

    A mark's texts are mostly toxic, and so many that chance, by Chernoff's bound, would not make one such word among all of
    them. Toxic texts with a mark are then set aside and the search goes on among the others, where rarer marks stand out.
    """
    found: set[int] = set()
    while True:
        so_far = frozenset(found)

        def counted(arrays, so_far=so_far):
            by_word = [names(w) for w in _words(arrays)]
            bad, good, left = Counter(), Counter(), 0
            ends = np.cumsum(arrays["sizes"])
            ids = arrays["ids"]
            for y, a, b in zip(arrays["y"].tolist(), (ends - arrays["sizes"]).tolist(), ends.tolist(), strict=True):
                held = {x for i in np.unique(ids[a:b]).tolist() for x in by_word[i]}
                if y <= 0.5:
                    good.update(held)
                elif held.isdisjoint(so_far):
                    bad.update(held)
                    left += 1
            keys = list(bad.keys() | good.keys())
            columns = [[0, *keys], [left, *(bad[k] for k in keys)], [0, *(good[k] for k in keys)]]  # 0: the number of texts left
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["name", "bad", "good"])

        sums = _each(blocks, counted, "name long, bad long, good long").groupBy("name").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where("bad > 0")
        # Of a name in a handful of texts no evidence can be enough; the rest are few, for their texts are bounded.
        rows = sums.groupBy().agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("name") == 0, F.col("bad"))).alias("left"), F.collect_list(F.when((F.col("name") != 0) & (F.col("bad") >= 3) & (F.col("good") <= MARK_CLEAN * (F.col("bad") + F.col("good"))), F.struct("name", "bad", "good"))).alias("likely")).first()
        if not rows.left:
            return found
        share = min(0.9, rows.left / (rows.left + clean))
        new = {r.name for r in rows.likely if _evidence(r.bad, r.good, share) >= np.log(MARK_ODDS * rows.n)}
        if not new:
            return found
        found |= new


def _evidence(bad: int, good: int, share: float) -> float:
    """How far chance, with a share of toxic texts, is from so many toxic texts of a word's: the exponent of Chernoff's bound."""
    n = bad + good
    p = bad / n
    if p <= share:
        return 0.0
    return n * (p * np.log(p / share) + ((1 - p) * np.log((1 - p) / (1 - share)) if good else 0.0))


def _chains(arrays, marked: frozenset) -> pa.RecordBatch:
    """A block as the gradient steps need it: slots of each word, true states and where texts start."""
    words, sizes = _words(arrays), arrays["sizes"]
    sizes_y = [(n, y) for n, y in zip(sizes.tolist(), arrays["y"].tolist(), strict=True) if n]
    slots = [features(w) for w in words]
    is_mark = np.fromiter((not marked.isdisjoint(names(w)) for w in words), bool, len(words))
    truth = is_mark[arrays["ids"]] & np.repeat([y > 0.5 for _, y in sizes_y], [n for n, _ in sizes_y])
    first = np.zeros(len(truth), bool)
    first[np.cumsum([0] + [n for n, _ in sizes_y[:-1]])] = True
    owner = np.repeat(np.arange(len(words)), [len(x) for x in slots])
    block = _packed(ids=arrays["ids"], first=first, truth=truth, owner=owner, slots=np.concatenate(slots), n_words=np.array(len(words)))
    return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.binary())})


def _gradient(weights: np.ndarray, trans: np.ndarray, start: np.ndarray, arrays) -> pa.RecordBatch:
    """The gradient's sum over a block: by slot where it is not zero, by transition, by start; and the true counts' share."""
    ids, first, owner, slots, n_words = (arrays[k] for k in ("ids", "first", "owner", "slots", "n_words"))
    y = arrays["truth"].astype(int)
    inner = np.flatnonzero(~first[1:])
    pairs_true = np.bincount(y[inner] * 2 + y[inner + 1], minlength=4).astype(float)
    first_true = np.array([(1 - y[first]).sum(), y[first].sum()], float)
    emit = np.bincount(owner, weights=weights[slots], minlength=n_words)[ids]
    p, pairs, firsts = marginals(emit, first, trans, start, True)
    by_word = np.bincount(ids, weights=y - p, minlength=n_words)
    g = np.bincount(slots, weights=by_word[owner], minlength=SLOTS)
    at = np.flatnonzero(np.abs(g) > 1e-9).astype(np.int32)
    small = np.concatenate([pairs_true - pairs.ravel(), first_true - firsts, pairs_true, first_true, [len(ids)]])
    return pa.RecordBatch.from_pydict({"at": pa.array([at.tobytes()], pa.binary()), "g": pa.array([g[at].astype(np.float32).tobytes()], pa.binary()), "small": pa.array([small.tobytes()], pa.binary())})


def fit_field(chains: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights by slot, transition and start weights after STEPS steps; a step is one job, of which each block gives a sum."""
    weights, trans, start = np.zeros(SLOTS), np.zeros((2, 2)), np.zeros(2)
    squares, squares_t, squares_s = np.full(SLOTS, 1e-8), np.full((2, 2), 1e-8), np.full(2, 1e-8)
    for k in range(STEPS + 1):
        # A vector of SLOTS at most for each block of a bounded sample.
        rows = _each(chains, lambda arrays, m=(weights.copy(), trans.copy(), start.copy()): _gradient(*m, arrays), "at binary, g binary, small binary").collect()
        g = np.zeros(SLOTS)
        for r in rows:
            g[np.frombuffer(r.at, np.int32)] += np.frombuffer(r.g, np.float32)
        small = np.sum([np.frombuffer(r.small) for r in rows], axis=0)
        n = small[-1]
        if k == 0:  # from the frequencies of the true transitions
            pairs, firsts = small[6:10].reshape(2, 2) + 1, small[10:12] + 1
            trans, start = np.log(pairs / pairs.sum(1, keepdims=True)), np.log(firsts / firsts.sum())
            continue
        g, g_t, g_s = g / n - DECAY * weights / n, small[:4].reshape(2, 2) / n, small[4:6] / n
        squares += g * g
        squares_t += g_t * g_t
        squares_s += g_s * g_s
        weights = weights + RATE * g / np.sqrt(squares)
        trans = trans + RATE * g_t / np.sqrt(squares_t)
        start = start + RATE * g_s / np.sqrt(squares_s)
    return weights, trans, start


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_TRAIN) -> Field:
    """The field from labelled documents whose bucket of three is not 1, half of the sample toxic where there are so many.

    A repeated label counts as its largest, equal texts of one label once. Without toxic training texts every score is near 0.
    """
    known = labelled(labels, "toxic", bucket_of(F.col("doc_id"), 3) != 1)
    halves = [known.where(c).orderBy("order", "doc_id").limit(limit // 2) for c in ("y > 0.5", "y <= 0.5")]
    rows = training_rows(docs, halves[0].unionByName(halves[1]), id_col, text_col)
    rows = written(rows.groupBy("y", "__text").agg(F.min("order").alias("order")).repartition(TRAIN_PARTS, "order").sortWithinPartitions("order", "y", "__text"), "toxicity-rows")
    held = F.pmod(F.xxhash64("order"), F.lit(CALIBRATE)) == 0
    for_field, for_bend = (written(rows.where(c).select("y", "__text").mapInArrow(_in_blocks, "block binary"), "toxicity-blocks") for c in (~held, held))
    size = {r.bad: r["count"] for r in rows.where(~held).groupBy((F.col("y") > 0.5).alias("bad")).count().collect()}
    marked = frozenset(marks(for_field, size.get(True, 0), size.get(False, 0))) if size.get(True) else frozenset()
    if not marked:
        return Field(*QUIET)
    chains = written(_each(for_field, lambda arrays: _chains(arrays, marked) if len(arrays["ids"]) else None, "block binary"), "toxicity-chains")
    weights, trans, start = fit_field(chains)

    def raw(arrays) -> pa.RecordBatch:
        own, words = Field(weights, trans, start, QUIET[3]), _words(arrays)
        lists = [[words[i] for i in x] for x in np.split(arrays["ids"], np.cumsum(arrays["sizes"])[:-1])]
        return pa.RecordBatch.from_arrays([pa.array([own.raw(p) for p in own.tags(lists)], pa.float64()), pa.array(arrays["y"].astype(float))], names=["raw", "y"])

    pairs = np.array([(r.raw, r.y) for r in _each(for_bend, raw, "raw double, y double").collect()]).reshape(-1, 2)  # two numbers a row of the sample
    # The sample has more toxic texts than there are; weights give its labels the shares that they have among all.
    total = {r.bad: r["count"] for r in known.groupBy((F.col("y") > 0.5).alias("bad")).count().collect()}
    drawn = {bad: max(1, int((pairs[:, 1] > 0.5).sum()) if bad else int((pairs[:, 1] <= 0.5).sum())) for bad in (True, False)}
    weight = np.where(pairs[:, 1] > 0.5, total.get(True, 0) / drawn[True], total.get(False, 0) / drawn[False])
    return Field(weights, trans, start, _calibrate(pairs[:, 0], pairs[:, 1], weight * len(pairs) / max(1.0, weight.sum())))


@lru_cache(maxsize=1)
def _known(model: int) -> dict[str, float]:
    """The scores of words that a worker has met under a model, in all its partitions."""
    return {}


def scored(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and spans (start, end, marginal of each toxic token) of every document.

    Null and empty texts, and texts without a word, have no spans and the score of no toxic token. Repeated rows get equal
    results; no rows give no rows; further columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), (bucket_of(docs[id_col], 3) == 1).alias("held_out"), text_of(docs, text_col).alias("__text"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    weights, trans, start, bend = field.weights, field.trans, field.start, field.bend
    model = zlib.crc32(weights.tobytes())

    def results(texts: list[str], own: Field) -> tuple[list, list]:
        scores, spans = [], []
        at = 0
        for block in _blocks([TOKEN.findall(t) for t in texts]):
            for p in own.tags(block):
                scores.append(own.score(p))
                hit = set(np.flatnonzero(p >= 0.5).tolist())
                spans.append([{"start": m.start(), "end": m.end(), "p": float(p[k])} for k, m in enumerate(TOKEN.finditer(texts[at])) if k in hit] if hit else [])
                at += 1
        return scores, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(weights, trans, start, bend, _known(model))
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                scores, spans = results(part.column("__text").to_pylist(), own)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(s >= TOXIC_FROM) for s in scores], pa.int32()), pa.array(spans, span)], names=["doc_id", "held_out", "score", "predicted", "spans"])

    schema = rows.drop("__text").withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "spans": F.lit(None).cast("array<struct<start:int,end:int,p:double>>")}).schema
    return rows.mapInArrow(run, schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scored(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return found.withColumn("spans", F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start, s.end)), ","))
