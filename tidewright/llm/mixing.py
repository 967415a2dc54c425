"""Mixes sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources, in order of code points with null last, weigh WEIGHTS in turn and share SHARE of all tokens; a target stops at
REPEATS times its source's size and the excess is shared again by weight. Targets become blocks of equal tokens: seats go
one by one to the source with the highest quotient target / (2 seats + 1). A source's documents are split by a seeded hash
into shards of about SHARD_DOCS, however many these are, and shards into at most GROUPS groups; a source's seats go to its
groups and a group's to its shards in the same way, by their tokens, so each shard has an integer quota. In a shard the
documents, in seeded order, form one line of tokens cut into blocks; a quota takes every block equally often, and the rest
of the quota from a seeded place on the ring of blocks. A document gives the tokens it has in the blocks taken.

The texts are read once, for their sizes; everything after that is done on a narrow table.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE, kept_apart, salted_join, table, text_of, written

WEIGHTS, SHARE, REPEATS, SEED = (3.0, 1.0, 2.0), 1.5, 2, 11
#: Tokens of a block at most; smaller where the smallest target would not fill SEATS_LEAST blocks.
BLOCK, SEATS_LEAST = 64, 200
#: Documents of a shard, about, and the most groups of shards of a source.
SHARD_DOCS, GROUPS = 256, 1024
#: What rows that repeat in full, id included, have in common: they are one entry of a shard's line, with a count.
ENTRY = ["k", "shard", "order", "proof", "size"]
WORD = rf"[^{SPACE}]++"


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> list[float]:
    """The target of each source, in order; the shares of capped sources' excess go to the others by weight until none is above."""
    goal = share * sum(sizes)
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    capped: set[int] = set()
    while True:
        rest = goal - sum(repeats * sizes[k] for k in capped)
        free = sum(weight[k] for k in range(len(sizes)) if k not in capped)
        want = [repeats * s if k in capped else max(0.0, rest) * weight[k] / free if free else 0.0 for k, s in enumerate(sizes)]
        over = {k for k in range(len(sizes)) if k not in capped and want[k] > repeats * sizes[k]}
        if not over:
            return want
        capped |= over


def apportion(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Sainte-Lague: seats by highest quotients votes / (2 n + 1), ties to the earlier; none gets more than most.

    Rounding at a common divisor gives the apportionment of some number of seats; from there seats are added at the highest
    quotients or taken back at the lowest until the number is right.
    """
    total = float(sum(votes))
    n = len(votes)
    most = most or [seats] * n
    if seats <= 0 or total <= 0:
        return [0] * n
    got = [min(m, int(np.floor(v / total * seats + 0.5))) for v, m in zip(votes, most, strict=True)]
    have = sum(got)
    if have > seats:
        heap = [(v / (2 * g - 1), -k) for k, (v, g) in enumerate(zip(votes, got, strict=True)) if g]
        heapq.heapify(heap)
        while have > seats:
            _, k = heapq.heappop(heap)
            got[-k] -= 1
            have -= 1
            if got[-k]:
                heapq.heappush(heap, (votes[-k] / (2 * got[-k] - 1), k))
    heap = [(-v / (2 * g + 1), k) for k, (v, g, m) in enumerate(zip(votes, got, most, strict=True)) if g < m and v > 0]
    heapq.heapify(heap)
    while have < seats and heap:
        _, k = heapq.heappop(heap)
        got[k] += 1
        have += 1
        if got[k] < most[k]:
            heapq.heappush(heap, (-votes[k] / (2 * got[k] + 1), k))
    return got


def _values(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    proof = F.xxhash64(text_of(docs, text_col))
    return {
        "doc_id": docs[id_col],
        "source": docs[source_col].cast("string"),
        "size": F.regexp_count(text_of(docs, text_col), F.lit(WORD)).cast("long"),
        "order": F.xxhash64(docs[id_col], F.lit(SEED), proof),  # texts without an id spread too
        "proof": proof,
    }


def _quotas(shards: DataFrame, block: int) -> DataFrame:
    """k, shard, tokens, blocks, passes and rest of each shard of (k, group, shard, tokens, seats): its group's seats apportioned."""
    import pandas as pd

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        blocks = (-(-frame["tokens"] // block)).astype("int64")
        got = np.array(apportion(frame["tokens"].astype(float).tolist(), int(frame["seats"].iloc[0]), (REPEATS * blocks).tolist()), "int64")
        per = np.maximum(blocks, 1)
        return pd.DataFrame({"k": frame["k"], "shard": frame["shard"], "tokens": frame["tokens"], "blocks": blocks, "passes": got // per, "rest": got % per})

    return shards.groupBy("k", "group").applyInPandas(run, "k int, shard long, tokens long, blocks long, passes long, rest long")


def _placed(rows: DataFrame, line: DataFrame) -> DataFrame:
    """rows with their entry's columns and _copy, their number among the rows of the entry.

    Rows of an entry with copies are numbered by the part of the stored table that they lie in and within it, so the copies of
    a row that is a third of all rows are numbered by many tasks and never gathered; as copies are alike, their order is free.
    """
    keep = [c for c in line.columns if c not in ENTRY]
    once = rows.join(line.where("copies = 1"), ENTRY).withColumn("_copy", F.lit(0).cast("long"))
    many = line.where("copies > 1")
    part = F.shiftright("__id", 33)  # of the table's part, by the number's making
    copies = salted_join(rows.withColumn("_key", F.struct(*ENTRY)), many.select(F.struct(*ENTRY).alias("_key"), *keep), "_key", "__id")
    copies = copies.withColumn("_part", part)
    before = copies.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("_key").orderBy("_part")) - F.col("_n")).drop("_n")
    number = F.row_number().over(Window.partitionBy("_key", "_part").orderBy("__id")) - 1
    copies = copies.withColumn("_at", number).join(before, ["_key", "_part"]).withColumn("_copy", (F.col("_before") + F.col("_at")).cast("long"))
    return once.unionByName(copies.select(*once.columns))


def taken_of(narrow: DataFrame) -> DataFrame:
    """narrow (a written table of doc_id, source, size, order, proof, __id and more) with source_size, target, taken and part_from."""
    spark = narrow.sparkSession
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).collect()  # a row for each source
    sources.sort(key=lambda r: (r.source is None, [ord(c) for c in r.source or ""]))
    want = targets([r.source_size for r in sources])
    block = max(1, min(BLOCK, int(min([w for w in want if w > 0], default=BLOCK) // SEATS_LEAST)))
    about = spark.createDataFrame([(k, r.source, r.source_size, float(w), -(-r.n // SHARD_DOCS)) for k, (r, w) in enumerate(zip(sources, want, strict=True))], "k int, of string, source_size long, target double, shards long")
    placed = narrow.join(about, F.col("source").eqNullSafe(F.col("of"))).drop("of", "source").withColumn("shard", F.pmod(F.shiftright("order", 3), "shards"))
    entries = written(placed.groupBy(*ENTRY).agg(F.count(F.lit(1)).alias("copies")), "entries")
    shards = written(entries.groupBy("k", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("tokens")).withColumn("group", (F.col("shard") % GROUPS).cast("int")), "shards")
    blocks = F.ceil(F.col("tokens") / block).cast("long")
    groups = shards.groupBy("k", "group").agg(F.sum("tokens").alias("tokens"), F.sum(blocks).alias("blocks")).orderBy("k", "group").collect()  # GROUPS a source at most
    members: dict[int, list] = {}
    for r in groups:
        members.setdefault(r.k, []).append(r)
    seats = []
    for k, n in enumerate(apportion(want, round(sum(want) / block))):
        own = members.get(k, [])
        most = [REPEATS * m.blocks for m in own]
        # At its cap a source gives every block REPEATS times: no other seats are within all the bounds.
        got = most if want[k] >= REPEATS * sources[k].source_size else apportion([float(m.tokens) for m in own], n, most)
        seats += [(m.k, m.group, g) for m, g in zip(own, got, strict=True)]
    quota = _quotas(shards.join(spark.createDataFrame(seats, "k int, group int, seats long"), ["k", "group"]), block)
    line = Window.partitionBy("k", "shard").orderBy(*ENTRY[2:])
    ends = entries.withColumn("_end", F.sum(F.col("size") * F.col("copies")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("_begin", F.col("_end") - F.col("size") * F.col("copies")).join(written(quota, "quotas"), ["k", "shard"])
    at = _placed(placed, written(ends, "line"))
    at = at.withColumn("a", F.col("_begin") + F.col("_copy") * F.col("size")).withColumn("b", F.col("a") + F.col("size"))
    # The part pass takes [lo, lo + n) on the ring of tokens, from the start of a seeded block.
    at = at.withColumn("lo", F.coalesce(F.pmod(F.xxhash64(F.lit(SEED), "k", "shard"), F.when(F.col("blocks") > 0, F.col("blocks"))), F.lit(0)) * block)
    ring_end = F.col("lo") + F.col("rest") * block
    over = F.greatest(F.lit(0), ring_end - F.col("blocks") * block)  # what goes on at the start of the line
    part = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("b"), hi) - F.greatest(F.col("a"), lo))
    ahead, behind = part(F.col("lo"), F.least(ring_end, F.col("tokens"))), part(F.lit(0), over)
    taken = (F.col("passes") * F.col("size") + ahead + behind).cast("long")
    part_from = F.when(ahead > 0, F.greatest(F.lit(0), F.col("lo") - F.col("a"))).otherwise(F.lit(0)).cast("long")
    return at.withColumns({"taken": taken, "part_from": part_from})


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken and the first word taken in the part pass (part_from,
    0 without one). taken = passes * size + words of the part pass, which may wrap round the end.

    Null texts have no words; null sources are a source, the last. Documents without words take none. Rows repeated in full, id and text,
    are one entry of the line, as long as all of them; each takes what its place there gives, and which is which is open. No rows give no
    rows; further columns are ignored. A row for each source is gathered: sources are origins, not addresses.
    """
    narrow = docs.select(*[v.alias(k) for k, v in _values(docs, id_col, text_col, source_col).items()])
    narrow = written(narrow.withColumn("__id", F.monotonically_increasing_id()), "sizes")
    return taken_of(narrow).select("doc_id", "size", "source_size", "target", "taken", "part_from")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself with the documents' columns: a row for each whole pass over a document and one for the part of a pass,
    whose text has the words taken, joined by spaces (and n_chars its length, where there is such a column).

    Nulls, ties, repeated and no rows are as in mixed; a row of which nothing is taken has no row in the mix, as those
    without words. Further columns are carried along."""
    whole = kept_apart(docs, "mix", **_values(docs, id_col, text_col, source_col))
    taken = taken_of(whole.drop("__row")).where("taken > 0").select("__id", "size", "taken", "part_from")
    rows = whole.select("__id", "__row").join(taken, "__id")
    times, part = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    copies = rows.withColumn("part", part).withColumn("copy", F.explode(F.concat(F.array_repeat(F.lit(False), times), F.array_repeat(F.lit(True), F.when(part > 0, 1).otherwise(0)))))
    text = F.col(f"__row.`{text_col}`")
    words = F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))
    doubled = F.concat(words, words)  # the part may wrap round the end
    new = F.when(F.col("copy"), F.array_join(F.slice(doubled, (F.col("part_from") + 1).cast("int"), F.greatest("part", F.lit(1))), " ")).otherwise(text)
    out = copies.withColumn("__text", new)
    columns = [
        F.col("__text").alias(c) if c == text_col else F.when(F.col("copy"), F.char_length("__text")).otherwise(F.col(f"__row.{c}")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"__row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return out.select(*columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("part_from")
