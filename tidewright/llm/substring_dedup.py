"""Repeated passages by content-defined chunking with a gear rolling hash.

A gear hash over the last 32 bytes cuts a text wherever its upper CUT_BITS bits are zero, so cuts depend on nearby bytes only
and find themselves again after an insertion. Chunks have MIN_BYTES at least and MAX_BYTES at most and never split a
character; at about 23 bytes in the mean a passage of over 50 words nearly always holds SPAN_BYTES in whole chunks. A chunk is
shared when texts of two ids hold its digest (64 bits and the length); a run of neighbouring shared
chunks of SPAN_BYTES or more is a repeated span, which also keeps chance matches of short chunks out. Of a shared chunk the
document with the smallest id keeps its text; the spans of the others can be removed.

Digests are pre-aggregated before they are dealt (only least and greatest id are kept of each), and the chunks are then
joined with the shared digests alone, a join that may split a frequent digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import table, text_of, written

MIN_BYTES, MAX_BYTES, CUT_BITS, SPAN_BYTES, SEED = 8, 512, 4, 120, 5
GEAR = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)
#: More than the size of any chunk.
PLACE = 1024


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the sum of GEAR[byte k places back] << k modulo 2**32, by doubling the window."""
    h = GEAR[raw]
    for k in (1, 2, 4, 8, 16):
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def chunk_ends(data: bytes) -> list[int]:
    """The end of each chunk of a text in UTF-8; together the chunks are the text."""
    n = len(data)
    if not n:
        return []
    raw = np.frombuffer(data, np.uint8)
    whole = np.append((raw[1:] & 0xC0) != 0x80, True)  # a character ends here
    ends, last = [], 0

    def forced(stop: int) -> None:
        nonlocal last
        while stop - last > MAX_BYTES:
            cut = last + MAX_BYTES
            while not whole[cut - 1] and cut - last > MAX_BYTES - 4:
                cut -= 1
            ends.append(cut)
            last = cut

    for p in (np.flatnonzero(((gear_hash(raw) >> np.uint32(32 - CUT_BITS)) == 0) & whole) + 1).tolist():
        if p - last >= MIN_BYTES:
            forced(p)
            if p - last >= MIN_BYTES:
                ends.append(p)
                last = p
    forced(n)
    if last < n:
        ends.append(n)
    return ends


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            keys, sizes = [], []
            for t in part.column("__text"):
                data = t.as_py().encode("utf-8", "surrogatepass")
                ends = chunk_ends(data)
                begins = [0, *ends[:-1]]
                keys.append(np.array([digest(data[a:b]) for a, b in zip(begins, ends, strict=False)], np.uint64).view(np.int64))
                sizes.append(np.diff(np.array([0, *ends], np.int32)))
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate(x))) for x in (keys, sizes)]
            keep = [i for i, name in enumerate(part.schema.names) if name != "__text"]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), *lists], names=[*(part.schema.names[i] for i in keep), "digests", "sizes"])


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, proof (of the text), digests and sizes in bytes of the chunks of every document."""
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("proof"), text.alias("__text"))
    none = {"digests": F.lit(None).cast("array<bigint>"), "sizes": F.lit(None).cast("array<int>")}
    return rows.mapInArrow(_chunked, rows.drop("__text").withColumns(none).schema)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for sizes, shared, later in zip(*(batch.column(c).to_pylist() for c in ("sizes", "shared", "later")), strict=True):
            ends = [0, *np.cumsum(np.array(sizes, np.int64)).tolist()]
            spans, removed = [], []
            later_set = set(later or ())
            for group in _runs(sorted(set(shared or ()))):
                if ends[group[-1] + 1] - ends[group[0]] >= SPAN_BYTES:
                    spans.append((ends[group[0]], ends[group[-1] + 1]))
                    removed += [(ends[g[0]], ends[g[-1] + 1]) for g in _runs([i for i in group if i in later_set])]
            out.append((len(sizes), ends[-1], len(spans), sum(b - a for a, b in spans), ",".join(f"{a}:{b}" for a, b in spans), ",".join(f"{a}:{b}" for a, b in removed)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("proof"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "proof", "n_chunks", "n_bytes", "n_spans", "shared_bytes", "shared", "removable"])


def _runs(numbers: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for i in numbers:
        if out and out[-1][-1] == i - 1:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, proof, n_chunks, n_bytes, n_spans, shared_bytes, shared and removable.

    shared lists the repeated spans as start:end in bytes of the UTF-8 text, removable the parts of them that a document before
    it has too. Ids may be of any type that has an order. Null texts count as empty: no chunks, no spans. Rows with one id are
    one document; so are rows without an id where their texts are equal, and these documents come first, in the order of their
    proofs. What repeats within one document alone is no repeat. No rows give no rows; further columns are ignored.
    """
    rows = written(chunks(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "chunks")
    anon = F.when(F.col("doc_id").isNull(), F.col("proof")).alias("anon")  # tells owners without an id apart
    each = rows.select("row", "doc_id", anon, F.posexplode(F.arrays_zip("digests", "sizes")).alias("at", "c")).withColumns({"digest": F.col("c.digests"), "bytes": F.col("c.sizes")})
    held = each.groupBy("digest", "bytes").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min("anon").alias("first_anon"), F.max("anon").alias("last_anon"))
    two = (F.col("first") != F.col("last")) | (F.col("first_anon") != F.col("last_anon")) | (F.col("first").isNotNull() & F.col("first_anon").isNotNull())
    shared = held.where(two).select("digest", "bytes", "first", "first_anon")
    # The places of all chunks are dealt, so they are packed with the sizes and carry no more than a number for their row; ids are
    # compared where rows meet again.
    place = (F.col("at").cast("long") * PLACE + F.col("bytes")).alias("place")
    hits = each.select(F.col("digest").alias("key"), place, "row").join(shared, (F.col("key") == F.col("digest")) & ((F.col("place") % PLACE).cast("int") == F.col("bytes"))).withColumn("at", F.shiftright("place", PLACE.bit_length() - 1).cast("int")).groupBy("row").agg(F.collect_list(F.struct("at", "first", "first_anon")).alias("hits"))
    later = lambda h: F.when(F.col("doc_id").isNull(), F.col("proof") > h["first_anon"]).otherwise(h["first_anon"].isNotNull() | (F.col("doc_id") > h["first"]))
    both = rows.join(hits, "row", "left").select("doc_id", "proof", "sizes", F.transform("hits", lambda h: h["at"]).alias("shared"), F.transform(F.filter("hits", later), lambda h: h["at"]).alias("later"))
    schema = both.select("doc_id", "proof", *[F.lit(0).cast("long").alias(c) for c in ("n_chunks", "n_bytes", "n_spans", "shared_bytes")], *[F.lit("").alias(c) for c in ("shared", "removable")]).schema
    return both.mapInArrow(_spans, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text of every document without the removable spans; rows repeated in full stay."""
    found = repeated(docs, id_col, text_col).where("removable <> ''").select(F.col("doc_id").alias("id"), "proof", "removable").distinct()
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("proof"))
    joined = rows.join(found, rows.doc_id.eqNullSafe(found.id) & (rows.proof == found.proof), "left").select("doc_id", "text", "removable")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, spans in zip(batch.column("text").to_pylist(), batch.column("removable").to_pylist(), strict=True):
                if spans:
                    data, at, parts = t.encode("utf-8", "surrogatepass"), 0, []
                    for a, b in (map(int, s.split(":")) for s in spans.split(",")):
                        parts.append(data[at:a])
                        at = b
                    t = b"".join([*parts, data[at:]]).decode("utf-8", "surrogatepass")
                texts.append(t)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return joined.mapInArrow(cut, joined.drop("removable").schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chunks", "n_bytes", "n_spans", "shared_bytes", "shared", "removable", (F.col("n_spans") > 0).alias("repeats"))
