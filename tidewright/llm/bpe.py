"""Byte-level BPE: encoding by recursive DuckDB queries in each partition, decoding by ordered aggregation.

Texts are cut by the tokenizer's pattern. Each worker keeps a table of the words it has seen in its partitions, up to a bound;
the words that are new in a chunk of texts go to an in-process DuckDB. There a word that is a token stands for itself, any other for its
bytes, and a recursive query unfolds each word to one row for each token position, joins neighbouring tokens with the merge
table, contracts in each word the leftmost pair of least rank and goes on until no word has a pair left. The ids of a text
are those of its words one behind another. For decoding, the ids of the chunk's texts become one row for each position,
are joined with the vocabulary, and an ordered aggregation strings each text's bytes together.
The merge table lists every pair of tokens whose bytes together are a token, as the rank of the joined bytes decides. Words
of over LONG bytes, of which a round would contract one pair in time proportional to their length, run the same
contraction over a heap of pairs.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import table, text_of

#: Texts and characters of a chunk, words that a worker remembers, bytes of a word from which the heap takes over, ids
#: decoded at once.
CHUNK_TEXTS, CHUNK_CHARS, REMEMBER, LONG, DECODE = 1_000, 500_000, 250_000, 512, 125_000

ENCODE = """
WITH RECURSIVE state(word, toks) USING KEY (word) AS (
    SELECT l.word, CASE WHEN v.tok IS NULL THEN l.toks ELSE [v.tok] END FROM letters l LEFT JOIN vocab v ON v.hex = l.hex
  UNION ALL
    SELECT s.word, s.toks[:(b.best & 65535) - 1] || [(b.best >> 16)::INT] || s.toks[(b.best & 65535) + 2:]
    FROM state s JOIN (
      SELECT p.word, min(m.rank::BIGINT * 65536 + p.pos) AS best
      FROM (SELECT word, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r, unnest(range(1, len(toks))) AS pos FROM state WHERE len(toks) > 1) p
      JOIN merges m ON m.l = p.l AND m.r = p.r GROUP BY p.word) b ON b.word = s.word
)
SELECT word, toks AS ids FROM state ORDER BY word
"""

DECODE_IDS = "SELECT c.doc, string_agg(v.hex, '' ORDER BY c.pos) AS hex FROM coded c JOIN vocab v ON v.tok = c.tok GROUP BY c.doc ORDER BY c.doc"


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=1)
def _database(path: str) -> duckdb.DuckDBPyConnection:
    known = ranks(path)
    con = duckdb.connect(config={"threads": 1, "memory_limit": "160MB"})
    rows = [(known[t[:k]], known[t[k:]], n) for t, n in known.items() for k in range(1, len(t)) if t[:k] in known and t[k:] in known]
    pairs = pa.table({"l": pa.array([r[0] for r in rows], pa.int32()), "r": pa.array([r[1] for r in rows], pa.int32()), "rank": pa.array([r[2] for r in rows], pa.int32())})
    words = pa.table({"tok": pa.array(list(known.values()), pa.int32()), "hex": [t.hex() for t in known]})
    con.register("pairs_in", pairs)
    con.register("vocab_in", words)
    con.execute("CREATE TABLE merges AS SELECT * FROM pairs_in")
    con.execute("CREATE TABLE vocab AS SELECT * FROM vocab_in")
    return con


def _contract(word: bytes, known: dict[bytes, int]) -> list[int]:
    """The same contraction, leftmost least rank first, with a heap."""
    n = len(word)
    end, nxt, prev, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def rank(i: int) -> int | None:
        j = nxt[i]
        return known.get(word[i : end[j]]) if j < n else None

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or end[j] != stop or rank(i) != r:
            continue
        alive[j] = False
        end[i], nxt[i] = end[j], nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
        for k in (prev[i], i):
            if k >= 0 and (q := rank(k)) is not None:
                heapq.heappush(heap, (q, k, end[nxt[k]]))
    return [known[word[i : end[i]]] for i in range(n) if alive[i]]


def encode_words(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one behind another, and how many each word has."""
    known = ranks(path)
    letter = np.array([known[bytes((b,))] for b in range(256)], np.int32)
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    short = [w if len(w) <= LONG else b"" for w in words]
    toks = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, short)]), pa.int32()), pa.array(letter[np.frombuffer(b"".join(short), np.uint8)]))
    con = _database(path)
    con.register("letters", pa.table({"word": pa.array(np.arange(len(words), dtype=np.int32)), "toks": toks, "hex": pa.array([w.hex() for w in short])}))
    found = con.sql(ENCODE).to_arrow_table().column("ids").combine_chunks()
    con.unregister("letters")
    ids, counts = found.flatten().to_numpy(), np.diff(found.offsets.to_numpy()).astype(np.int64)
    long = {k: np.array(_contract(w, known), np.int32) for k, w in enumerate(words) if len(w) > LONG}
    if long:
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        pieces = [long.get(k, p) for k, p in enumerate(pieces)]
        ids, counts = np.concatenate(pieces), np.array(list(map(len, pieces)), np.int64)
    return ids, counts


def decoded(ids: np.ndarray, docs: np.ndarray, path: str) -> Iterator[tuple[int, bytes]]:
    """(doc, bytes) of the ids of texts, docs being each id's text in rising order; a text of many ids comes in several parts."""
    con = _database(path)
    for at in range(0, len(ids), DECODE):
        part = slice(at, at + DECODE)
        n = len(ids[part])
        con.register("coded", pa.table({"doc": pa.array(docs[part]), "pos": pa.array(np.arange(n, dtype=np.int32)), "tok": pa.array(ids[part])}))
        rows = con.sql(DECODE_IDS).to_arrow_table()
        con.unregister("coded")
        for doc, hexed in zip(rows.column("doc").to_pylist(), rows.column("hex").to_pylist(), strict=True):
            yield doc, bytes.fromhex(hexed)


class _Numbers(dict):
    """Numbers words in the order of their first look-up; new has those since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Words:
    """The words that a worker has seen, with their ids."""

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.ids, self.begin, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids_of(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, given as lists of words, one behind another, and how many each text has."""
        if len(self.number) > REMEMBER:
            self.clear()
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        words = np.fromiter(map(self.number.__getitem__, chain.from_iterable(lists)), np.int64, sizes.sum())
        try:
            ids, count = encode_words([w.encode("utf-8", "surrogatepass") for w in self.number.new], self.path)
        except BaseException:
            self.clear()  # no number may stay without its ids
            raise
        self.number.new.clear()
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(count) - count])
        self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        count = self.count[words]
        ends = np.cumsum(count)
        at = np.repeat(self.begin[words] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return self.ids[at], np.diff(ends)


def coded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, and with with_ids the ids themselves.

    Null texts count as empty and give no ids, so the hashes are those of no bytes. Repeated rows get equal results; no rows
    give no rows; further columns are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("__text"))
    schema = rows.drop("__text").withColumns({"n_tokens": F.lit(0).cast("long"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit("")}).schema
    if with_ids:
        schema = schema.add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = regex.compile(pattern), _words_of(path)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            for lo, hi in _chunks(texts):
                ids, n = seen.ids_of([cut.findall(t) for t in texts[lo:hi]])
                ends = np.cumsum(n)
                packed = ids.astype("<u4").tobytes()
                whole = [packed[4 * a : 4 * b] for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                back = [hashlib.sha256() for _ in whole]
                for doc, data in decoded(ids, np.repeat(np.arange(len(n), dtype=np.int32), n), path):
                    back[doc].update(data)
                columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in whole]), pa.array([h.hexdigest() for h in back])]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(whole, pa.binary())] if with_ids else [])], names=schema.names)

    return rows.mapInArrow(run, schema)


@lru_cache(maxsize=1)
def _words_of(path: str) -> Words:
    return Words(path)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for k, t in enumerate(texts):
        if k > lo and (k - lo >= CHUNK_TEXTS or held + len(t) > CHUNK_CHARS):
            yield lo, k
            lo, held = k, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def public_vocabulary() -> tuple[str, str]:
    """Path of the public byte-level vocabulary and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"), *public_vocabulary())
