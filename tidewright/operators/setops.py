"""Set operations on tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stacked_tables(*frames: DataFrame) -> DataFrame:
    """Union of all by name; columns that one lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def removed(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(gone.select(*keys).distinct(), keys, "left_anti")


def distinct_on(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(keys) if keys else df.distinct()


#: Buckets of rows whose fingerprints are compared before rows are.
BUCKETS = 1024


def _hash(columns: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.struct(*[F.col(c) for c in columns]))


def prints(df: DataFrame, keys: list[str], columns: list[str], name: str) -> DataFrame:
    """A fingerprint of the rows of each key as a multiset: their number, the sum of one hash and the exclusive or of another.
    Order does not matter and nothing but a row a key is shuffled."""
    facts = [F.count(F.lit(1)).alias("n"), F.sum(_hash(columns, 1).cast("decimal(38,0)")).alias("sum"), F.bit_xor(_hash(columns, 2)).alias("xor")]
    return df.groupBy(*keys).agg(*facts).select(*keys, F.struct("n", "sum", "xor").alias(name))


def same_by(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys and same: whether both hold the same rows of that key as often, in any order; each side is read once."""
    a, b = (prints(df, keys, sorted(left.columns), n) for df, n in ((left, "_l"), (right, "_r")))
    b = b.withColumnsRenamed({k: f"_{k}" for k in keys})  # names of their own, as both may come from one table
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    key = [F.when(F.col("_l").isNotNull(), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys]
    return a.join(b, on, "full").select(*key, F.col("_l").eqNullSafe(F.col("_r")).alias("same"))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either with side 'left' or 'right' that the other does not have as often.

    Rows fall into buckets by a hash; only those of buckets whose fingerprints differ are compared, by one signed count."""
    columns = sorted(left.columns)
    bucket = F.pmod(_hash(columns, 0), F.lit(BUCKETS)).alias("_bucket")
    sides = [df.select(*left.columns, bucket) for df in (left, right)]
    unlike = same_by(*sides, ["_bucket"]).where("NOT same").select("_bucket")  # BUCKETS rows at most
    rows = [df.join(F.broadcast(unlike), "_bucket", "left_semi").withColumn("_sign", F.lit(n)) for df, n in zip(sides, (1, -1), strict=True)]
    counts = rows[0].unionByName(rows[1]).groupBy(*left.columns).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, F.lit("left")).otherwise(F.lit("right"))
    return counts.select(*left.columns, F.explode(F.array_repeat(side, F.abs("_n").cast("int"))).alias("side"))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both hold the same rows as often, in any order: one pass a side, which gathers a fingerprint of each."""
    if sorted(left.columns) != sorted(right.columns):
        return False
    a, b = (prints(df, [], sorted(left.columns), "p").first()["p"] for df in (left, right))
    return a == b


def periodic(df: DataFrame, axis: str, period: float, low: float, high: float) -> DataFrame:
    """df with copies of its rows a period ahead and behind, as far as they fall in [low, high]."""
    at = F.explode(F.array(*[F.col(axis) + k * period for k in (-1, 0, 1)]))
    return df.withColumn("_at", at).where(F.col("_at").between(low, high)).drop(axis).withColumnRenamed("_at", axis)


def window_days(df: DataFrame, day: str, before: int, after: int, name: str) -> DataFrame:
    """Each row with each output day whose window [name - before, name + after] holds its day: one scan serves all windows."""
    return df.withColumn(name, F.explode(F.sequence(F.date_sub(day, after), F.date_add(day, before))))
