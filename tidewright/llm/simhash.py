"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, verified links and components.

A fingerprint of 64 bits is cut into BLOCKS blocks. Two fingerprints that differ in at most MAX_BITS bits agree in at least
BLOCKS - MAX_BITS blocks, so they share the value of some pair of blocks (six blocks, four bits). Rows are dealt by that
value; documents with one fingerprint are one entry there, so a group of exact copies of any size is a single entry.
Inside a bucket every pair's Hamming distance is verified, but no pairs are emitted: a search from each unvisited entry
takes whatever is within reach out of the bucket, and the bucket returns a star of links, one for each entry at most. A
tight cluster thus empties its bucket after a few searches. Links become components by alternating large and small stars,
each round written to shared storage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import kept_apart, salted_join, table, text_of, written

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: Width in bits of each of the six blocks; any two agree in two blocks at least when at most four bits differ.
BLOCKS = (11, 11, 11, 11, 10, 10)


def fingerprint(text: str) -> int:
    """SimHash of word shingles of a text with A-Z in lower case; 0 without words."""
    words = WORD.findall(text.encode("utf-8", "surrogatepass").lower())  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a:b], SEED) for a, b in zip(begins[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(n, 8)
    for at in range(0, n, 65536):
        counts += np.unpackbits(raw[at : at + 65536], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


@F.arrow_udf(T.LongType())
def _fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array(np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts)).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a signed long."""
    return docs.select(docs[id_col].alias("doc_id"), _fingerprint(text_of(docs, text_col)).alias("fp"))


def _star(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, first value of its group) of the distinct values that hang together at MAX_BITS or fewer bits."""
    rest, heads, tails = values, [], []
    while len(rest) > 1:
        head, rest = rest[:1], rest[1:]
        front, group = head, []
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            step = max(1, 4_000_000 // len(rest))
            for at in range(0, len(front), step):
                near |= (np.bitwise_count(front[at : at + step, None] ^ rest[None, :]) <= MAX_BITS).any(axis=0)
            front, rest = rest[near], rest[~near]
            if len(front):
                group.append(front)
        if group:
            tails.append(np.concatenate(group))
            heads.append(np.full(len(tails[-1]), head[0]))
    return (np.concatenate(tails), np.concatenate(heads)) if tails else (values[:0], values[:0])


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; buckets run on over batches."""
    open_key, held = None, []

    def close(tails: list, heads: list) -> None:
        values = np.concatenate(held)
        if len(values) > 1:
            a, b = _star(values)
            if len(a):
                tails.append(a)
                heads.append(b)

    def out(tails: list, heads: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (tails, heads)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("bucket").to_numpy(zero_copy_only=False)
        values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        tails, heads = [], []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if held and keys[lo] == open_key:
                held.append(values[lo:hi])
            else:
                if held:
                    close(tails, heads)
                open_key, held = keys[lo], [values[lo:hi]]
        if tails:
            yield out(tails, heads)
    if held:
        tails, heads = [], []
        close(tails, heads)
        if tails:
            yield out(tails, heads)


def links(prints: DataFrame) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints of column fp; they hang together just as all pairs in reach do."""
    at, cuts = 0, []
    for width in BLOCKS:
        cuts.append(F.shiftrightunsigned(F.col("fp"), at).bitwiseAND(F.lit((1 << width) - 1)))
        at += width
    pairs = list(combinations(range(len(BLOCKS)), 2))
    keys = F.array(*[F.shiftleft(F.shiftleft(cuts[i], 11).bitwiseOR(cuts[j]), 4).bitwiseOR(F.lit(k).cast("long")) for k, (i, j) in enumerate(pairs)])
    dealt = prints.select("fp", F.explode(keys).alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "fp")
    return dealt.mapInArrow(_bucket_links, "a long, b long").distinct()


def _trace(edges: DataFrame) -> tuple:
    """Number of the edges and two sums of their hashes, which tell whether a round changed them."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit((1 << 28) - 1)))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root for each node of the undirected edges (a, b); the root is the smallest node of its component.

    Large stars link the larger neighbours of each node to its smallest neighbour, small stars the smaller ones; each keeps
    components together, and in a logarithmic number of rounds only stars with the smallest node as centre are left. A
    centre's links are dealt to several tasks.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _trace(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = salted_join(both, least, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = salted_join(large, low, "a", "b")
        edges = written(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "links")
        after = _trace(edges)
        if after == before:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = after


def near_groups(prints: DataFrame, first: Column) -> DataFrame:
    """fp, root and best for each distinct fingerprint of prints; best is the least of first in the whole component."""
    own = written(prints.groupBy("fp").agg(F.min(first).alias("own")), "fingerprints")
    roots = components(links(own.select("fp")))
    placed = own.join(roots, own.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "own")
    return salted_join(placed.select("fp", "root"), placed.groupBy("root").agg(F.min("own").alias("best")), "root", "fp")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits) and component_id.

    Documents whose fingerprints differ in at most four bits are linked; component_id is the smallest id that links reach
    (null only where all ids of the component are null). Null, empty and blank texts have fingerprint zero and are linked
    like others. Rows repeated in full get the same result. No rows give no rows; further columns are ignored.
    """
    prints = written(fingerprints(docs, id_col, text_col), "prints")
    found = prints.join(near_groups(prints, F.col("doc_id")), "fp", "left")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component with its own columns: that with the smallest id, null last; of rows that repeat this id
    the one with the least hash of the text, and of equal ones any. Null, empty and blank texts are linked like others, no
    rows give no rows, and further columns are carried along."""
    whole = kept_apart(docs, "near", doc_id=docs[id_col], fp=_fingerprint(text_of(docs, text_col)), proof=F.xxhash64(text_of(docs, text_col)))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "proof", "__id")
    kept = near_groups(whole.drop("__row"), first).where("fp = root").select("best.__id")
    return whole.join(kept, "__id", "left_semi").select("__row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))
