"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a bag of lower-cased words, each weighted by how often it occurs. For each of SAMPLES samples and each word with
weight S the word's hash gives r and c from Gamma(2, 1) and b from the unit interval; t = floor(ln S / r + b) marks the step
below S of the word's random ladder, and a = c * exp(-r * (t - b + 1)) is exponentially distributed with rate S. The least a
over all words is the sample. Two texts have the same sample exactly if the same word wins at the same step, whose
probability is the generalised Jaccard similarity: the sum of the smaller weights over the sum of the larger ones. As a tells
word and step, a sample is stored as 16 bits of a's hash.

Logarithms are taken for few pairs of a word and a sample: a >= c * exp(-r) / S and c >= 2 (1 - v) / (1 + v), v being the
product of the uniform numbers behind c, bound a from below, and the least a of a text of n words is above REACH / n with
probability exp(-REACH), below one in a million. A pair bound to stay above that is left out; a sample without any pair, by
that chance, has the value 0. Equal texts have equal fingerprints always, as all depends on the text alone.

Neighbours by id are found without a window over all rows. A bounded random sample of keys cuts the ids into buckets; a
bucket's rows, after the first row of the next bucket, are met in descending order, so each row sees its successor. A key that
is drawn as a bound has a bucket of its own, dealt to as many tasks as its rows ask for.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE, table, text_of, written

SAMPLES, REACH, PART_BITS = 32, 14.0, 16
#: Bounds of the buckets, for each shuffle partition, and at most.
BOUNDS_A_PARTITION, MAX_BOUNDS, SEED = 4, 16384, 11


def _bound(value: Column, f) -> Column:
    """f of a value that is computed once however often f mentions it."""
    return F.transform(F.array(value), f)[0]


def terms(text: Column) -> Column:
    """The distinct words of a text as structs of term (a hash) and weight (a count); a blank text is one empty word."""
    words = F.split(F.lower(F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")), f"[{SPACE}]+")

    def counted(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        weight = lambda at: lambda p, j: F.struct(F.get(s, p).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - p).cast("double").alias("weight"))
        return _bound(first, lambda at: F.transform(at, weight(at)))

    return _bound(F.sort_array(F.transform(words, lambda w: F.xxhash64(w))), counted)


def _uniform(h: Column, at: int, bits: int) -> Column:
    """Bits of a hash as a number between 0 and 1, neither included."""
    return (F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("double") + 0.5) * F.lit(2.0**-bits)


def signatures(rows: DataFrame, keys: list[str], carried: list[str], texts: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys, carried and, in place of each column of texts, the array of its samples. Rows with equal keys must agree in all
    of these. Keys and carried columns of fixed width (numbers) keep the sums in hash maps."""
    bag = F.array(*[F.struct(F.lit(n * samples).alias("base"), terms(F.col(t)).alias("terms")) for n, t in enumerate(texts)])
    size = F.aggregate("bag.terms", F.lit(0.0), lambda acc, x: acc + x["weight"])
    bags = rows.select(*keys, *carried, F.explode_outer(bag).alias("bag")).select(*keys, *carried, "bag", (F.lit(REACH) / size).alias("reach"))
    each = bags.select(*keys, *carried, "bag.base", "reach", F.explode_outer("bag.terms").alias("t"))
    hashes = F.posexplode_outer(F.array(*[F.xxhash64("t.term", F.lit(k)) for k in range(samples)])).alias("k", "h")
    pairs = each.select(*keys, *carried, "base", F.col("t.weight").alias("weight"), (F.col("reach") * F.col("t.weight")).alias("most"), hashes)
    u = lambda at: _uniform(F.col("h"), at, 16)
    near = pairs.select("*", (u(0) * u(16)).alias("x"), (u(32) * u(48)).alias("v")).where("2 * (1 - v) * x <= most * (1 + v)")
    gamma = near.select(
        *keys, *carried, (F.col("base") + F.col("k")).alias("k"), F.log("weight").alias("w"), (-F.log("x")).alias("r"), (-F.log("v")).alias("c"), _uniform(F.xxhash64("h"), 0, 32).alias("b")
    )
    a = F.col("c") * F.exp(-F.col("r") * (F.floor(F.col("w") / F.col("r") + F.col("b")) - F.col("b") + 1))
    same = [F.max(c).alias(c) for c in carried]
    least = gamma.select(*keys, *carried, "k", a.alias("a")).groupBy(*keys, "k").agg(F.min("a").alias("a"), *same)
    part = F.struct("k", F.xxhash64("a").bitwiseAND(F.lit((1 << PART_BITS) - 1)).cast("int").alias("part"))
    found = least.groupBy(*keys).agg(F.map_from_entries(F.collect_list(part)).alias("parts"), *same)
    of = lambda n: F.transform(F.sequence(F.lit(n * samples), F.lit((n + 1) * samples - 1)), lambda k: F.coalesce(F.try_element_at("parts", k), F.lit(0)))
    return found.select(*keys, *carried, *[of(n).alias(t) for n, t in enumerate(texts)])


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples."""
    return F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"] == p["b"])) / F.size(a)


def printed(parts: Column) -> Column:
    """The samples as one lowercase hex string."""
    return F.array_join(F.transform(parts, lambda p: F.lower(F.lpad(F.hex(p), PART_BITS // 4, "0"))), "")


def key_of(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """id, null last, and two hashes of the text: rows that repeat in full have one key."""
    text = text_of(docs, text_col)
    return F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def _numbers(key: str, name: str) -> list[Column]:
    """Two hashes that stand for a key, which may hold an id of any type."""
    return [F.xxhash64(key).alias(f"{name}1"), F.xxhash64(F.lit(1), key).alias(f"{name}2")]


def _bucket(key: Column, bounds: list, kind: str) -> Column:
    """2 p + 1 for the bound number p, 2 p for keys between the bounds p - 1 and p; two steps of about the root of all bounds."""
    if not bounds:
        return F.lit(0)
    m = math.isqrt(len(bounds) - 1) + 1
    blocks = [bounds[i : i + m] for i in range(0, len(bounds), m)]
    firsts = F.from_json(F.lit(json.dumps([b[0] for b in blocks])), f"array<{kind}>")
    all_blocks = F.from_json(F.lit(json.dumps(blocks)), f"array<array<{kind}>>")
    block = F.size(F.filter(firsts, lambda b: b <= key))
    within = lambda i: F.when(i == 0, F.lit(0)).otherwise(
        _bound(F.get(all_blocks, i - 1), lambda bs: 2 * ((i - 1) * m + F.size(F.filter(bs, lambda b: b < key))) + F.exists(bs, lambda b: b == key).cast("int"))
    )
    return _bound(block, within)


def successors(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, bounds: int) -> DataFrame:
    """bucket, salt, key, text, next_key and next_text of each row; keys holds the keys of all rows, stored.

    The next document of a row is that with the next larger key, the first one for the last; rows that repeat in full are one
    document. bounds is the number of keys drawn to cut the buckets.
    """
    drawn = keys.orderBy(F.rand(SEED)).limit(bounds).agg(F.to_json(F.sort_array(F.collect_set("key")), {"ignoreNullFields": "false"})).first()[0]
    cuts = json.loads(drawn)
    kind = keys.schema["key"].dataType.simpleString()
    placed = keys.select(_bucket(F.col("key"), cuts, kind).alias("bucket"), "key")
    heads = placed.groupBy("bucket").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("rows"))  # two and one for each bound at most
    share = F.ceil(F.col("rows") * bounds / F.sum("rows").over(Window.partitionBy()))
    heads = heads.withColumn("salts", F.when(F.col("bucket") % 2 == 1, F.least(share, F.lit(64))).otherwise(F.lit(1)).cast("int"))
    into = F.struct("bucket", "salts")
    last = F.max(into).over(Window.partitionBy())
    heads = written(heads.withColumn("into", F.coalesce(F.lag(into).over(Window.orderBy("bucket")), last)), "heads")
    rows = docs.select(key_of(docs, id_col, text_col).alias("key"), text_of(docs, text_col).alias("text"))
    whole = rows.withColumn("bucket", _bucket(F.col("key"), cuts, kind)).join(F.broadcast(heads.select("bucket", "salts")), "bucket")
    own = whole.select("bucket", F.pmod(F.monotonically_increasing_id(), "salts").cast("int").alias("salt"), F.lit(False).alias("guest"), "key", "text")
    guests = rows.join(F.broadcast(heads.select("key", "into")), "key").dropDuplicates(["key"])
    guests = guests.select("into.bucket", F.explode(F.sequence(F.lit(0), F.col("into.salts") - 1)).alias("salt"), F.lit(True).alias("guest"), "key", "text")
    down = Window.partitionBy("bucket", "salt").orderBy(F.desc("guest"), F.desc("key"))
    met = own.unionByName(guests).withColumn("before", F.lag(F.struct("guest", "key", "text")).over(down))
    step = F.when(F.col("before.guest") | (F.col("before.key") != F.col("key")), F.struct("before.key", "before.text"))
    found = met.withColumn("next", F.last(step, ignorenulls=True).over(down)).where("NOT guest")
    return found.select("bucket", "salt", "key", "text", F.col("next.key").alias("next_key"), F.col("next.text").alias("next_text"))


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, bounds: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, parts and edited_parts (arrays of samples), near_edited and near_next of every row.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many of the next
    document, or all it has, in ascending order of ids, null last, and of text hashes for equal ids. Rows that repeat in full
    are one document: all have the same next one. Null texts count as empty; a blank text has one empty word. A single document is its own next one; no rows give
    no rows; further columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    bounds = bounds or min(MAX_BOUNDS, BOUNDS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = written(docs.select(key_of(docs, id_col, text_col).alias("key")), "keys")
    rows = successors(docs, keys, id_col, text_col, bounds)
    n = F.char_length("text")
    cut = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    both = rows.select("bucket", "salt", *_numbers("key", "key"), *_numbers("next_key", "next"), n.cast("long").alias("n_chars"), "text", edited.alias("edited")).withColumn("sha", F.sha2("edited", 256))
    shas = [f"sha{k}" for k in range(8)]
    both = both.select("*", *[F.conv(F.substring("sha", 8 * k + 1, 8), 16, 10).cast("long").alias(c) for k, c in enumerate(shas)])
    # bucket and salt, by which the rows lie, are among the keys, so this needs no further shuffle
    signed = signatures(both, ["bucket", "salt", "key1", "key2"], ["next1", "next2", "n_chars", *shas], ["text", "edited"], samples)
    signed = written(signed.drop("bucket", "salt").dropDuplicates(["key1", "key2"]), "signatures")
    after = signed.select(F.col("key1").alias("next1"), F.col("key2").alias("next2"), F.col("text").alias("next_parts"))
    ids = keys.select(F.col("key.id").alias("doc_id"), *_numbers("key", "key"))
    done = ids.join(signed.join(after, ["next1", "next2"]), ["key1", "key2"])
    return done.select(
        "doc_id",
        "n_chars",
        F.lower(F.concat(*[F.lpad(F.hex(c), 8, "0") for c in shas])).alias("edited_sha256"),
        F.col("text").alias("parts"),
        F.col("edited").alias("edited_parts"),
        likeness(F.col("text"), F.col("edited")).alias("near_edited"),
        likeness(F.col("text"), F.col("next_parts")).alias("near_next"),
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """doc_id and parts (the samples) of every row; nulls, blanks, repeated and no rows are as in neighbour_fingerprints."""
    rows = docs.select(key_of(docs, id_col, text_col).alias("key"), text_of(docs, text_col).alias("text"))
    rows = rows.select(F.col("key.id").alias("doc_id"), *_numbers("key", "key"), "text")
    return rows.drop("text").join(signatures(rows, ["key1", "key2"], [], ["text"], samples), ["key1", "key2"]).select("doc_id", F.col("text").alias("parts"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbour_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", printed(F.col("parts")).alias("fingerprint"), printed(F.col("edited_parts")).alias("edited_fingerprint"), "near_edited", "near_next")
