"""Writers: day-partitioned tables, lists that change only with their content, indicator text, sidecars and archive, metadata."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright import schemas
from tidewright.functions.scalars import fixed_width
from tidewright.operators.setops import same_rows


def write_partitions(df: DataFrame, path: str, by: list[str], schema: StructType | None = None) -> None:
    """Replace the partitions that df has rows of, and only those; with a schema, its columns and types."""
    if schema:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed table without rows, for days without data."""
    return spark.createDataFrame([], schema)


def empty_day_metadata(day: Column) -> dict[str, Column]:
    """Coverage of a day without data: its first and last second."""
    return {"time_coverage_start": F.date_format(day, "yyyy-MM-dd'T00:00:00Z'"), "time_coverage_end": F.date_format(day, "yyyy-MM-dd'T23:59:59Z'")}


def coverage(df: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias("coverage_start"), F.max(time).alias("coverage_end"))


def write_list_if_changed(df: DataFrame, path: str, read: DataFrame | None) -> bool:
    """Write a small list as one CSV file unless it has the rows that were read; whether it was written."""
    if read is not None and same_rows(df, read):
        return False
    df.orderBy(*df.columns).coalesce(1).write.mode("overwrite").csv(path, header=True)
    return True


def write_float32(df: DataFrame, path: str, by: list[str]) -> None:
    doubles = {n: df[n].cast("float") for n, kind in df.dtypes if kind == "double"}
    write_partitions(df.withColumns(doubles), path, by)


def indicator_lines(series: DataFrame, name: str) -> DataFrame:
    """The lines of an indicator's text file in order of time; the mean level also has its smoothed value."""
    values = [F.col(name), *([F.col("smoothed_gmsl")] if name == "gmsl" else [])]
    return series.orderBy("time").select(fixed_width(F.col("time"), *values).alias("value"))


def header_lines(template: DataFrame, created: Column, mark: str = "PLACEHOLDER_CREATION_DATE") -> DataFrame:
    return template.select(F.replace("value", F.lit(mark), created.cast("string")).alias("value"))


def write_indicator_text(series: DataFrame, name: str, path: str) -> None:
    indicator_lines(series, name).coalesce(1).write.mode("overwrite").text(path)


def sidecar(files: DataFrame, name: str = "name", content: str = "content", changed: str = "modificationTime") -> DataFrame:
    """A JSON description of each file: md5, size and time in milliseconds."""
    body = F.struct(F.col(name).alias("name"), F.md5(F.col(content).cast("binary")).alias("checksum"), F.lit("md5").alias("checksumType"), F.octet_length(content).alias("size"), F.unix_millis(F.col(changed).cast("timestamp")).alias("modified"))
    return files.select(F.col(name).alias("name"), F.to_json(body).alias("json"))


def errors_as_json(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(F.to_json(F.struct(*[v.alias(k) for k, v in values.items()])).alias("json"))


def metadata(spark: SparkSession, dataset: str, variables: dict[str, dict[str, str]]) -> DataFrame:
    """Attributes as rows (dataset, variable, key, value), a variable's in case-insensitive order of keys."""
    rows = [(dataset, v, k, str(x)) for v, attrs in variables.items() for k, x in sorted(attrs.items(), key=lambda a: a[0].lower())]
    return spark.createDataFrame(rows, "dataset string, variable string, key string, value string")


def write_daily(df: DataFrame, path: str) -> None:
    write_partitions(df, path, ["version", "source", "obs_date"], schemas.DAILY)


def write_crossovers(df: DataFrame, path: str) -> None:
    write_partitions(df, path, ["version", "source", "day"], schemas.CROSSOVER)


def write_polynomials(df: DataFrame, path: str) -> None:
    write_partitions(df, path, ["source", "date"], schemas.POLYNOMIAL)


def write_corrections(df: DataFrame, path: str) -> None:
    """Corrections by source and day of their time."""
    days = df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.CORRECTION]).withColumn("date", F.to_date("time"))
    write_partitions(days, path, ["source", "date"])


def grid_folder(root: str, source: str | None = None, resolution: str | None = None) -> str:
    """Where grids go: of one source below p2, of all below p3 or, at a quarter of a degree, quart."""
    if source:
        return f"{root}/p2/{source}"
    return f"{root}/quart" if resolution == "quart" else f"{root}/p3"


def write_grids(df: DataFrame, root: str, source: str | None = None, resolution: str | None = None) -> str:
    """Grids by year and date in their folder, which is returned; coordinates as floats, as they are read as such."""
    folder = grid_folder(root, source, resolution)
    out = df.withColumn("year", F.year("grid_date")).withColumns({c: df[c].cast("float") for c in ("latitude", "longitude") if c in df.columns})
    write_partitions(out, folder, ["year", "grid_date"])
    return folder


def archive_name(name: str, day: date) -> str:
    """The place of a dated copy of an indicator's file: archive/NAME/name_yyyymmdd.ext."""
    stem, _, kind = name.partition(".")
    return f"archive/{stem.upper()}/{stem}_{day:%Y%m%d}.{kind}"


def write_indicators(series: DataFrame, root: str, day: date, names: tuple[str, ...] = ("gmsl", "enso", "iod", "pdo")) -> list[str]:
    """The series as a table, each indicator as text with a sidecar, and dated copies of both; the places written below root."""
    series.select(*[F.col(f.name).cast(f.dataType) for f in schemas.INDICATORS]).coalesce(1).write.mode("overwrite").parquet(f"{root}/indicators")
    places = ["indicators"]
    for name in names:
        lines = indicator_lines(series, name)
        for place in (f"{name}.txt", archive_name(f"{name}.txt", day)):
            lines.coalesce(1).write.mode("overwrite").text(f"{root}/{place}")
            whole = lines.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{root}/{place}").withColumn("name", F.lit(place.rsplit("/", 1)[-1]))
            sidecar(whole).select("json").coalesce(1).write.mode("overwrite").text(f"{root}/{place.removesuffix('.txt')}.mp")
            places += [place, place.removesuffix(".txt") + ".mp"]
    return places


#: Global attributes of a product file, by the public conventions for data discovery (fixed values). Those without a value here
#: name the publisher and the product and are given by the caller.
GLOBAL_ATTRIBUTES = {
    "Conventions": "CF-1.7", "title": None, "summary": None, "institution": None, "source": None, "source_url": None, "references": None, "mean_sea_surface": None,
    "standard_name_vocabulary": None, "id": None, "naming_authority": None, "project": None, "processing_level": None, "product_generation_step": None, "product_short_name": None,
    "acknowledgement": None, "license": None, "product_version": None, "keywords": None, "keywords_vocabulary": None, "cdm_data_type": "Point", "featureType": "trajectory",
    "platform": "Satellite", "instrument": "Altimeter", "publisher_name": None, "publisher_url": None, "publisher_email": None, "creator_name": None, "creator_url": None,
    "creator_email": None, "geospatial_lat_min": "-90.0", "geospatial_lat_max": "90.0", "geospatial_lon_min": "0.0", "geospatial_lon_max": "360.0",
}
NO_DATA = "no data for this date"


def product_attributes(daily: DataFrame, days: DataFrame, created: str, given: dict[str, str] | None = None) -> DataFrame:
    """source, obs_date, key and value of the 38 global attributes of each day of days (source, obs_date), in case-insensitive
    order of keys: the fixed ones, those given, when the file was created, and the coverage of its rows; what nobody gives is
    blank. A day without rows covers itself and has a comment that says so."""
    fixed = GLOBAL_ATTRIBUTES | (given or {}) | {"date_created": created, "history": f"Created on {created}"}
    spans = coverage(daily.select("source", "obs_date", "time"), ["source", "obs_date"])
    rows = days.select("source", "obs_date").distinct().join(spans, ["source", "obs_date"], "left")
    blank = empty_day_metadata(F.col("obs_date"))
    second = lambda c, k: F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"), blank[k])
    pairs = [F.struct(F.lit(k).alias("key"), F.lit(v or "").alias("value")) for k, v in fixed.items()]
    pairs += [F.struct(F.lit(k).alias("key"), second(c, k).alias("value")) for k, c in (("time_coverage_start", "coverage_start"), ("time_coverage_end", "coverage_end"))]
    comment = F.struct(F.lit("comment").alias("key"), F.lit(NO_DATA).alias("value"))
    each = rows.withColumn("a", F.explode(F.concat(F.array(*pairs), F.when(F.col("coverage_start").isNull(), F.array(comment)).otherwise(F.array().cast("array<struct<key:string,value:string>>")))))
    return each.select("source", "obs_date", "a.*").orderBy("source", "obs_date", F.lower("key"))
