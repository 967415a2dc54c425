"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame functions only.

Documents are dealt to a power of FAN_IN runs by their row. A run is reduced to one entry for each distinct text, in the
order of the digests: digest, check value, number of rows and best row. Runs have numbers to the base FAN_IN. In round k the
FAN_IN runs whose numbers differ in digit k alone exchange their entries: each takes those whose digest has its own digit
there, and merges the sorted pieces that it gets, settling the best row of each digest anew from the members' best rows.
Entries merge only where digest (SHA-256), an independent 64-bit hash and the normalised length all agree. After the last
round a run's number is the digest's, so one entry for each text is left; a text that makes up a third of all rows was
one entry of each run before it met itself.

Entries of texts with several rows go back down to the (run, digest) pairs that fed them. The rows are joined with
these by (run, digest), so a text that makes up a third of all rows is spread over all runs, and only entries, never rows,
were merged by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE, kept_apart, table, text_of, written

#: Runs that exchange entries in one round; their digits are those of the base FAN_IN.
FAN_IN = 8
KEY = ["digest", "proof", "n_norm"]


def run_count(spark: SparkSession) -> int:
    """A power of FAN_IN, at least 64 and no less than the shuffle partitions up to 4096, so that a hot text has many runs."""
    n = 64
    while n < min(4096, int(spark.conf.get("spark.sql.shuffle.partitions"))):
        n *= FAN_IN
    return n


def _values(docs: DataFrame, id_col: str, text_col: str) -> dict[str, Column]:
    text = text_of(docs, text_col)
    norm = F.regexp_replace(text, f"[{SPACE}]", "")
    return {"doc_id": docs[id_col], "digest": F.unhex(F.sha2(norm, 256)), "proof": F.xxhash64(norm), "n_norm": F.char_length(norm), "n_points": F.char_length(text)}


def _in_runs(rows: DataFrame, runs: int) -> DataFrame:
    return rows.withColumn("run", F.pmod(F.xxhash64("__id"), F.lit(runs)).cast("long"))


def merge_runs(entries: DataFrame, runs: int) -> tuple[DataFrame, DataFrame]:
    """The runs' own entries, and one entry for each text after all rounds; best is (-code points, id is null, id, row)."""
    best = F.struct((-F.col("n_points")).alias("neg"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__id").alias("row"))
    first = entries.groupBy("run", *KEY).agg(F.count(F.lit(1)).alias("rows"), F.min(best).alias("best"))
    prefix = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    merged, place = first, 1
    while place < runs:
        digit = lambda x, place=place: F.pmod(F.floor(x / place).cast("long"), F.lit(FAN_IN)) * place
        partner = F.col("run") - digit(F.col("run")) + digit(prefix)
        merged = merged.withColumn("run", partner).groupBy("run", *KEY).agg(F.sum("rows").alias("rows"), F.min("best").alias("best"))
        place *= FAN_IN
    return first, merged.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int | None = None) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after deleting spaces and tabs to carriage returns; null counts as empty, so all null
    and blank texts are one group. Of a group the row with most code points stays, then the smallest id; null ids come last.
    Of rows that agree in id and code points too, exactly one stays. No rows give no rows; further columns are ignored.
    """
    runs = runs or run_count(docs.sparkSession)
    rows = docs.select(*[v.alias(k) for k, v in _values(docs, id_col, text_col).items()])
    entries = _in_runs(written(rows.withColumn("__id", F.monotonically_increasing_id()), "digests"), runs)
    first, merged = merge_runs(entries, runs)
    copies = merged.where("rows > 1").withColumnRenamed("rows", "group_size")
    down = first.select("run", *KEY).join(copies, KEY)
    found = entries.join(down, ["run", *KEY], "left")
    return found.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("best.row") == F.col("__id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with their own columns; nulls, ties, repeated and no rows are as in exact_dedup, and further
    columns, those with the names used here among them, are carried along. The texts are digested once."""
    whole = kept_apart(docs, "exact", **_values(docs, id_col, text_col))
    runs = run_count(docs.sparkSession)
    kept = merge_runs(_in_runs(whole.drop("__row"), runs), runs)[1].select(F.col("best.row").alias("__id"))
    return whole.join(kept, "__id", "left_semi").select("__row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(body) DESC, doc_id NULLS LAST)
"""
