"""Scratch storage and small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space in the contracts of these operators, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"


#: The list that gathers paths of scratch tables written just now, or None where nobody has asked for them.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)
#: The temporary folder of a session without a shared one, by application.
_FOLDER: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or a temporary one where that is unset and driver and
    executors are one process; on a cluster a folder of one machine would not do, so there it must be set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        base = _FOLDER[app] = _FOLDER.get(app) or tempfile.mkdtemp(prefix="tidewright-")
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df to the scratch folder and read it back: cuts lineage, and any executor can reread it after a loss."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (paths := _SCOPE.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(paths: list[str]) -> Iterator[None]:
    """Scratch tables written meanwhile are listed in paths, so that their owner, and nobody else, can release them."""
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)


def released(spark: SparkSession, paths: list[str]) -> None:
    """Delete these scratch tables and empty the list. For owners who have stored what they got from them."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()


def kept_apart(docs: DataFrame, name: str, **values: Column) -> DataFrame:
    """docs written to the scratch folder once as __row (a struct) with values and __id, a number for each row. Reading values
    alone leaves the rows' texts on disk, and __id joins results back to whole rows, however often they repeat."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), *[v.alias(k) for k, v in values.items()])
    return written(rows.withColumn("__id", F.monotonically_increasing_id()), name)


def salted_join(big: DataFrame, small: DataFrame, key: str, by: str, n: int = 8) -> DataFrame:
    """big joined with small, which has a row for each key; a key's rows in big are dealt to n tasks by a hash of by."""
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(n)).cast("int"))
    return salted.join(small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))), [key, "__salt"]).drop("__salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def bucket_of(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; 0 for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % F.lit(n), F.lit(0))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
