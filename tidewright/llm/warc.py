"""Merkle fixity audit of WARC records in replicas.

A shard is a file, the sequence of its records with their byte offsets. A leaf hashes a record's digest with its offset and
length, a node the leaves or nodes of up to FAN consecutive children, so that each node stands for an ordered offset range,
and the root for the shard. Two replicas, each with the manifest of its own bytes, are compared root by root; only below
mismatching nodes are the children compared, level by level, down to the records. Records at mismatching places are then
told apart: moved (the same bytes at another place, as after a lost record), changed, missing or surplus. Records are
reduced to digests where they are read, so no record bytes are dealt; a node gathers at most FAN digests.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.common import table, union_all, written

#: Children of a node, levels above the leaves at least, records of a shard (about), copies of one record that stay together.
FAN, LEVELS, SHARD_RECORDS, COPIES = 16, 3, 256, 32
#: The pages have no time of capture, which a record must name.
DATE = "1970-01-01T00:00:00Z"


def record(page_id: Column, url: Column, html: Column, kind: str = "resource") -> Column:
    """A WARC 1.1 record of a page, as text; null parts count as empty, a null id as 'none'."""
    body = F.coalesce(html.cast("string"), F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def digest(body: Column) -> Column:
    """Length in bytes and sha256 of a record."""
    return F.struct(F.octet_length(body).cast("long").alias("length"), F.sha2(body.cast("binary"), 256).alias("record_sha256"))


def sharded(records: DataFrame, shards: int, *, key: Column) -> DataFrame:
    """records with shard and copy: dealt by a hash of the id, the key (a digest) and the block of COPIES of equal ones, so
    that neither a frequent or null id nor a record that many rows repeat fills a shard. The order of a shard is that of
    id (null first), key and copy."""
    equal = records.groupBy("page_id", *[c for c in records.columns if c != "page_id"]).agg(F.count(F.lit(1)).alias("rows"))
    blocks = equal.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / COPIES))))
    name = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), key, F.col("block").cast("string"))
    placed = blocks.withColumn("shard", F.pmod(F.conv(F.left(F.sha2(name, 256), F.lit(13)), 16, 10).cast("long"), F.lit(shards)).cast("long"))
    # Blocks go to their shards' tasks before they become rows again, so a record that many rows repeat is unfolded by many.
    first = F.col("block") * COPIES
    copies = F.explode(F.sequence(first, F.least(first + COPIES, F.col("rows")) - 1))
    return placed.repartition("shard").withColumn("copy", copies).drop("rows", "block")


def manifest(rows: DataFrame, order: list[str]) -> DataFrame:
    """shard, ordinal, page_id, rec_offset, length and record_sha256 from (shard, page_id, length, record_sha256), with the
    records of a shard one behind another in the given order."""
    line = Window.partitionBy("shard").orderBy(*order)
    return rows.select(
        "shard",
        (F.row_number().over(line) - 1).cast("long").alias("ordinal"),
        "page_id",
        F.coalesce(F.sum("length").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("rec_offset"),
        "length",
        "record_sha256",
    )


def shard_count(n: int) -> int:
    return max(1, -(-n // SHARD_RECORDS))


def tree(rows: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Level by level (shard, node, hash): level 0 are the leaves, the last the roots, node 0 of each shard."""
    out = [rows.select("shard", F.col("ordinal").alias("node"), F.sha2(F.concat_ws(":", "rec_offset", "length", "record_sha256"), 256).alias("hash"))]
    for _ in range(levels):
        kids = F.array_sort(F.collect_list(F.struct("node", "hash")))
        up = out[-1].withColumn("parent", F.floor(F.col("node") / FAN)).groupBy("shard", "parent").agg(kids.alias("kids"))
        out.append(up.select("shard", F.col("parent").alias("node"), F.sha2(F.array_join(F.transform("kids", lambda k: k.hash), ""), 256).alias("hash")))
    return out


def _matched(ours: DataFrame, theirs: DataFrame, key: list[str]) -> DataFrame:
    """Places (shard, ordinal, other) of the n-th record of a key in both."""
    nth = lambda x: x.withColumn("nth", F.row_number().over(Window.partitionBy("shard", *key).orderBy("ordinal")))
    a, b = nth(ours).alias("a"), nth(theirs).alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("shard", "nth", *key)]
    return a.join(b, same).select("a.shard", "a.ordinal", F.col("b.ordinal").alias("other"))


def audit(left: DataFrame, right: DataFrame, levels: int | None = None) -> DataFrame:
    """One row for each record of left, and one for each of right that left has nothing for: shard, ordinal, page_id, rec_offset,
    length, record_sha256 (of right's for surplus ones), root of left's shard, status (same, moved, changed, missing,
    surplus) and other_offset (null for missing and surplus ones).

    Of the records at mismatching places of a shard, the n-th with the same bytes on both sides are moved; of those that
    remain the n-th with the same id (null equals null) are changed. An empty replica has no roots, so all records of the other are missing or
    surplus; two empty ones give no rows. Further columns are ignored. The trees are as deep as the largest shard needs.
    """
    columns = ["shard", "ordinal", "page_id", "rec_offset", "length", "record_sha256"]
    left, right = written(left.select(*columns), "warc-left"), written(right.select(*columns), "warc-right")
    if levels is None:
        most = max(x.agg(F.max("ordinal")).first()[0] or 0 for x in (left, right))
        levels = LEVELS
        while FAN**levels <= most:
            levels += 1
    ours, theirs = tree(left, levels), tree(right, levels)
    roots = ours[-1].where("node = 0").select("shard", F.col("hash").alias("root"))
    bad = None
    for level in range(levels, -1, -1):
        a, b = ours[level], theirs[level].withColumnRenamed("hash", "other")
        if bad is not None:  # only children of mismatching nodes
            parents = bad.select("shard", F.col("node").alias("parent"))
            a, b = (x.withColumn("parent", F.floor(F.col("node") / FAN)).join(parents, ["shard", "parent"], "left_semi").drop("parent") for x in (a, b))
        bad = written(a.join(b, ["shard", "node"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))), f"warc-level{level}")
    places = bad.select("shard", F.col("node").alias("ordinal"))
    a, b = (written(x.join(places, ["shard", "ordinal"], "left_semi"), "warc-bad") for x in (left, right))
    moved = written(_matched(a, b, ["record_sha256"]), "warc-moved")
    rest_a = a.join(moved, ["shard", "ordinal"], "left_anti")
    rest_b = b.join(moved.select("shard", F.col("other").alias("ordinal")), ["shard", "ordinal"], "left_anti")
    changed = written(_matched(rest_a, rest_b, ["page_id"]), "warc-changed")
    pairs = moved.withColumn("status", F.lit("moved")).union(changed.withColumn("status", F.lit("changed")))
    pairs = pairs.join(b.select("shard", F.col("ordinal").alias("other"), F.col("rec_offset").alias("other_offset")), ["shard", "other"]).drop("other")
    surplus = rest_b.join(changed.select("shard", F.col("other").alias("ordinal")), ["shard", "ordinal"], "left_anti")
    faults = a.select("shard", "ordinal").join(pairs, ["shard", "ordinal"], "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    known = left.join(faults, ["shard", "ordinal"], "left").withColumn("other_offset", F.when(F.col("status").isNull(), F.col("rec_offset")).otherwise(F.col("other_offset")))
    rows = union_all([
        known.select(*columns, F.coalesce("status", F.lit("same")).alias("status"), "other_offset"),
        surplus.select(*columns, F.lit("surplus").alias("status"), F.lit(None).cast("long").alias("other_offset")),
    ])
    return rows.join(roots, "shard", "left").select(*columns, "root", "status", "other_offset")


#: How a gzip member begins, and how many bytes are inflated at a time.
GZIP, PART = b"\x1f\x8b\x08", 1 << 16
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.IGNORECASE)


def records_in(data: bytes) -> Iterator[tuple[int, int, str]]:
    """Offset, length and sha256 of each record of an uncompressed WARC file."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        size = _LENGTH.search(data, at, head) if head >= 0 else None
        if not data.startswith(b"WARC/", at) or not size:
            raise ValueError(f"no WARC record at byte {at}")
        end = head + 4 + int(size[1]) + 4
        if data[end - 4 : end] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, end - at, hashlib.sha256(data[at:end]).hexdigest()
        at = end


def _member_end(data: bytes, at: int) -> int | None:
    """Where the gzip member at a place ends; None unless it is whole, its check sum right and its content a record."""
    inflate, place, begun = zlib.decompressobj(31), at, b""
    try:
        while not inflate.eof:
            part = inflate.unconsumed_tail or data[place : place + PART]
            place += 0 if inflate.unconsumed_tail else len(part)
            out = inflate.decompress(part, PART)
            if not part and not out and not inflate.eof:
                return None
            begun = begun if len(begun) >= 5 else begun + out[:5]
    except zlib.error:
        return None
    return place - len(inflate.unused_data) if begun.startswith(b"WARC/") else None


def members_in(data: bytes) -> Iterator[tuple[int, int, str]]:
    """Offset, length and sha256 of each record of a compressed WARC file, whose records are gzip members of their own, as stored.

    A member that does not inflate goes on to the next that does, or to the end of the file, so a spoilt record is one record of
    the manifest, which the audit then tells from its replica, and those behind it keep their places."""
    at = 0
    while at < len(data):
        end, start = _member_end(data, at), at
        while end is None:
            start = data.find(GZIP, start + 1)
            end = len(data) if start < 0 else start if _member_end(data, start) else None
        yield at, end - at, hashlib.sha256(data[at:end]).hexdigest()
        at = end


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of the WARC files in a folder, a shard for each file, told by its path below the folder; a file must fit a
    task's memory. page_id is null. Files that end in .gz are read member by member, see `members_in`; of others a record that
    does not hold together is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = list((members_in if name.endswith(".gz") else records_in)(data.as_py()))
                yield pa.RecordBatch.from_pydict({"file": [name] * len(rows), "ordinal": list(range(len(rows))), "rec_offset": [r[0] for r in rows], "length": [r[1] for r in rows], "record_sha256": [r[2] for r in rows]}, schema=kind)

    kind = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("rec_offset", pa.int64()), ("length", pa.int64()), ("record_sha256", pa.string())])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    found = files.mapInArrow(run, "file string, ordinal long, rec_offset long, length long, record_sha256 string")
    folder = re.sub("^[A-Za-z0-9+.-]+:/*", "/", path).rstrip("/") + "/"
    return found.withColumn("shard", F.xxhash64(F.substring_index("file", folder, -1))).withColumn("page_id", F.lit(None).cast("long"))


def pages_replicas(pages: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Manifests of the pages' archive and of a replica with faults that the id decides: of 1000 classes, 7 has its last
    character changed, 77 its last five cut off, 777 is lost, and behind 333 stands a record too many.

    The replica's lengths, places and offsets are those of its own bytes; both archives are digested in one pass."""
    body = record(pages.page_id, pages.url, pages.html)
    kind = F.coalesce((F.col("page_id") * 7919) % 1000, F.lit(-1))
    end = F.lit("\r\n\r\n")
    spoilt = F.when(kind == 7, F.concat(F.expr("left(body, length(body) - 5)"), F.lit("#"), end)).when(kind == 77, F.concat(F.expr("left(body, length(body) - 9)"), end)).when(kind != 777, F.col("body"))
    rows = pages.select("page_id", body.alias("body"), F.when(kind == 333, record(pages.page_id, F.lit(None), F.lit(None), "metadata")).alias("more"))
    rows = rows.select("page_id", digest(F.col("body")).alias("own"), F.array_compact(F.array(*[F.when(x.isNotNull(), digest(x)) for x in (spoilt, F.col("more"))])).alias("others"))
    placed = written(sharded(rows, shards, key=F.col("own.record_sha256")), "warc-placed")
    order = ["page_id", "key", "copy"]
    left = placed.select("shard", "copy", "page_id", "own.*", F.col("own.record_sha256").alias("key"))
    right = placed.select("shard", "copy", "page_id", F.col("own.record_sha256").alias("key"), F.posexplode("others").alias("nth", "o")).select("*", "o.*")
    return manifest(left, order), manifest(right, [*order, "nth"])


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return audit(*pages_replicas(pages, shard_count(pages.count())))


SQL = r"""
WITH crlf AS (SELECT chr(13) || chr(10) AS e),
r AS (
  SELECT page_id, e, coalesce((page_id * 7919) % 1000, -1) AS kind, '>' || e || 'WARC-Date: 1970-01-01T00:00:00Z' || e || 'WARC-Target-URI: ' AS mid,
         'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, 'none') || mid
         || coalesce(url, '') || e || 'Content-Type: text/html' || e || 'Content-Length: '
         || strlen(coalesce(html, '')) || e || e || coalesce(html, '') || e || e AS body,
         'WARC/1.1' || e || 'WARC-Type: metadata' || e || 'WARC-Record-ID: <urn:page:' || page_id || mid
         || e || 'Content-Type: text/html' || e || 'Content-Length: 0' || e || e || e || e AS more
  FROM pages, crlf),
keyed AS (
  SELECT *, sha256(body) AS key, row_number() OVER (PARTITION BY page_id, sha256(body)) - 1 AS copy FROM r),
m AS (
  SELECT *, ('0x' || left(sha256(coalesce(page_id::VARCHAR, 'none') || ':' || key || ':' || (copy // 32)), 13))::BIGINT
            % (SELECT greatest(1, (count(*) + 255) // 256) FROM pages) AS shard,
         CASE kind WHEN 7 THEN left(body, length(body) - 5) || '#' || e || e WHEN 77 THEN left(body, length(body) - 9) || e || e
                   WHEN 777 THEN NULL ELSE body END AS spoilt
  FROM keyed),
streams AS (
  SELECT 'l' AS side, shard, page_id, key, copy, 0 AS nth, body FROM m
  UNION ALL SELECT 'r', shard, page_id, key, copy, 0, spoilt FROM m WHERE spoilt IS NOT NULL
  UNION ALL SELECT 'r', shard, page_id, key, copy, 1, more FROM m WHERE kind = 333),
places AS (
  SELECT side, shard, row_number() OVER w - 1 AS ordinal, page_id, strlen(body) AS length, sha256(body) AS record_sha256,
         (coalesce(sum(strlen(body)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rec_offset
  FROM streams WINDOW w AS (PARTITION BY side, shard ORDER BY page_id NULLS FIRST, key, copy, nth)),
l0 AS (SELECT shard, ordinal AS node, sha256(concat_ws(':', rec_offset, length, record_sha256)) AS hash FROM places WHERE side = 'l'),
l1 AS (SELECT shard, node // 16 AS node, sha256(string_agg(hash, '' ORDER BY node)) AS hash FROM l0 GROUP BY shard, l0.node // 16),
l2 AS (SELECT shard, node // 16 AS node, sha256(string_agg(hash, '' ORDER BY node)) AS hash FROM l1 GROUP BY shard, l1.node // 16),
l3 AS (SELECT shard, node // 16 AS node, sha256(string_agg(hash, '' ORDER BY node)) AS hash FROM l2 GROUP BY shard, l2.node // 16),
odd AS (
  SELECT * FROM places p WHERE NOT EXISTS (
    SELECT 1 FROM places o WHERE o.side <> p.side AND o.shard = p.shard AND o.ordinal = p.ordinal AND o.rec_offset = p.rec_offset
                              AND o.length = p.length AND o.record_sha256 = p.record_sha256)),
by_bytes AS (SELECT *, row_number() OVER (PARTITION BY side, shard, record_sha256 ORDER BY ordinal) AS n FROM odd),
moved AS (
  SELECT a.shard, a.ordinal, b.ordinal AS other, b.rec_offset AS other_offset
  FROM by_bytes a JOIN by_bytes b ON a.side = 'l' AND b.side = 'r' AND a.shard = b.shard AND a.record_sha256 = b.record_sha256 AND a.n = b.n),
rest AS (
  SELECT *, row_number() OVER (PARTITION BY side, shard, page_id ORDER BY ordinal) AS n
  FROM odd WHERE NOT EXISTS (SELECT 1 FROM moved v WHERE v.shard = odd.shard AND CASE odd.side WHEN 'l' THEN v.ordinal ELSE v.other END = odd.ordinal)),
changed AS (
  SELECT a.shard, a.ordinal, b.ordinal AS other, b.rec_offset AS other_offset
  FROM rest a JOIN rest b ON a.side = 'l' AND b.side = 'r' AND a.shard = b.shard AND a.page_id IS NOT DISTINCT FROM b.page_id AND a.n = b.n),
stated AS (
  SELECT p.*, CASE WHEN odd.ordinal IS NULL THEN 'same' WHEN v.ordinal IS NOT NULL THEN 'moved' WHEN c.ordinal IS NOT NULL THEN 'changed' ELSE 'missing' END AS status,
         CASE WHEN odd.ordinal IS NULL THEN p.rec_offset ELSE coalesce(v.other_offset, c.other_offset) END AS other_offset
  FROM places p LEFT JOIN odd ON odd.side = 'l' AND odd.shard = p.shard AND odd.ordinal = p.ordinal
  LEFT JOIN moved v ON v.shard = p.shard AND v.ordinal = p.ordinal LEFT JOIN changed c ON c.shard = p.shard AND c.ordinal = p.ordinal
  WHERE p.side = 'l'
  UNION ALL
  SELECT rest.* EXCLUDE (n), 'surplus', NULL FROM rest WHERE side = 'r' AND NOT EXISTS (SELECT 1 FROM changed c WHERE c.shard = rest.shard AND c.other = rest.ordinal))
SELECT s.shard, ordinal, page_id, rec_offset, length, record_sha256, l3.hash AS root, status, other_offset
FROM stated s LEFT JOIN l3 ON l3.shard = s.shard AND l3.node = 0
"""
