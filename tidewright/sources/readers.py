"""Readers for granule catalogs, granules, day files, lists, adjacency and colour tables, polygons and file times."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright import schemas
from tidewright.functions.scalars import cycle_pass, date_in_name, padded_id, track_id
from tidewright.operators.flags import metres, priority_pick
from tidewright.operators.lookups import looked_up


def day_span(day: date) -> tuple[datetime, datetime]:
    """A day from its first to its last whole second."""
    begin = datetime(day.year, day.month, day.day)
    return begin, begin + timedelta(days=1) - timedelta(seconds=1)


def query_catalog(fetch: Callable[[str, datetime, datetime], Iterable[dict]], collection: str, day: date, tries: int = 3, wait: float = 15.0, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """What fetch gives for a collection and day; after a RuntimeError it is tried again so many times, with a pause before each."""
    begin, end = day_span(day)
    try:
        return list(fetch(collection, begin, end))
    except RuntimeError as e:
        error = e
    for _ in range(tries):
        sleep(wait)
        try:
            return list(fetch(collection, begin, end))
        except RuntimeError as e:
            error = e
    raise error


def catalog_table(spark: SparkSession, records: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(f) for f in schemas.CATALOG.names) for r in records], schemas.CATALOG)


def granules_of(catalog: DataFrame, rel: str) -> DataFrame:
    """The catalog with href, the first link of the given relation; a granule without one is an error when it is read."""
    href = F.get(F.filter("links", lambda x: x.rel == rel), F.lit(0)).href
    checked = F.when(href.isNotNull(), href).otherwise(F.raise_error(F.concat(F.lit("no link for "), F.col("title"))))
    return catalog.select("id", "title", checked.alias("href"), "time_start", "time_end", "updated", "collection")


def of_collection(catalog: DataFrame, collection: str) -> DataFrame:
    return catalog.where(F.col("collection") == collection)


def best_granules(catalog: DataFrame, priorities: dict[str, int], arrival: str = "seq") -> DataFrame:
    """Of the granules of one cycle and pass that of the best collection, of equals the first; in order of cycle and pass."""
    rank = F.lit(None).cast("int")
    for name, p in priorities.items():
        rank = F.when(F.col("collection") == name, F.lit(p)).otherwise(rank)
    return priority_pick(catalog.withColumn("cycle_pass", cycle_pass(F.col("title"))).withColumn("priority", rank), "cycle_pass", "priority", arrival).orderBy("cycle_pass")


def merged_granules(granules: DataFrame, lookup: DataFrame) -> DataFrame:
    """Granules of the merged kind with ssha in metres, pass by look-up and cycle from the granule."""
    rows = granules.withColumn("id", padded_id(F.col("reference_orbit"), F.col("index")))
    found = looked_up(rows, lookup, "id").drop("id")
    return found.withColumn("ssha", metres(F.col("ssha"))).withColumnsRenamed({"merged_cycle": "cycle", "lat": "latitude", "lon": "longitude"})


def reduced_granules(granules: DataFrame) -> DataFrame:
    """Granules of the reduced kind, flat or in groups data.ku, with cycle and pass as columns."""
    if "data" in granules.columns:
        inner = granules.schema["data"].dataType
        flat = [F.col(f"data.{f.name}") for f in inner if not isinstance(f.dataType, StructType)]
        deep = [F.col(f"data.{g.name}.{f.name}") for g in inner if isinstance(g.dataType, StructType) for f in g.dataType]
        granules = granules.select(*[c for c in granules.columns if c != "data"], *flat, *deep)
    return granules.withColumnsRenamed({"cycle_number": "cycle", "pass_number": "pass"})


def parquet(spark: SparkSession, paths: list[str] | str, schema: StructType | None = None, skip_corrupt: bool = False) -> DataFrame:
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return (reader.schema(schema) if schema else reader).parquet(*([paths] if isinstance(paths, str) else paths))


def window_scan(spark: SparkSession, root: str, first: date, last: date, schema: StructType | None = None, day: str = "obs_date") -> DataFrame:
    """Rows of the days from first to last of a table partitioned by day; only their partitions are read, and days without one
    give no rows."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(root).where(F.col(day).between(F.lit(first), F.lit(last)))


def named_window_scan(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Rows of the Parquet files whose name holds a date from first to last."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path).withColumn("file_date", date_in_name(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)))
    return rows.where(F.col("file_date").between(F.lit(first), F.lit(last)))


def bad_pass_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BAD_PASS).csv(path, header=True)


def pass_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The look-up of passes; ids keep their leading zeros."""
    return spark.read.schema(schemas.PASS_LOOKUP).csv(path, header=True)


def adjacency(lines: DataFrame, line: str = "value") -> DataFrame:
    """basin_id and valid_basin from lines 'id:a,b,c', each pair once."""
    parts = F.split(F.trim(F.col(line)), ":")
    each = lines.where(F.trim(F.col(line)) != "").select(F.trim(parts[0]).cast("int").alias("basin_id"), F.explode(F.split(parts[1], ",")).alias("_link"))
    return each.select("basin_id", F.trim("_link").cast("int").alias("valid_basin")).distinct()


def colours(lines: DataFrame, line: str = "value") -> DataFrame:
    """r, g and b in [0, 1) and alpha 1 from lines of three numbers up to 255, with their place."""
    parts = F.split(F.trim(F.col(line)), r"[\s,]+")
    rows = lines.withColumn("place", F.monotonically_increasing_id()).where(F.size(parts) >= 3)
    return rows.select("place", *[(parts[k].cast("double") / 256).alias(c) for k, c in enumerate("rgb")], F.lit(1.0).alias("alpha"))


def file_times(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, day (from the name) and modificationTime of the files below a path; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return rows.select("path", date_in_name(F.element_at(F.split("path", "/"), -1)).alias("day"), F.col("modificationTime").alias("output_time"))


def renamed_legacy(df: DataFrame) -> DataFrame:
    """Older files' column names brought up to date."""
    return df.withColumnsRenamed({old: new for old, new in (("ssh", "ssha"), ("ssh_smoothed", "ssha_smoothed")) if old in df.columns and new not in df.columns})


def with_track(df: DataFrame, cycle: str = "cycle", number: str = "pass") -> DataFrame:
    return df.withColumn("track", track_id(F.col(cycle), F.col(number)))


def with_constants(df: DataFrame, **values: Column | int | str) -> DataFrame:
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def version_step(version: str) -> int:
    """The last digit of a version name."""
    return int(re.search(r"(\d)$", version)[1])
