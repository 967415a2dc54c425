"""Product files as tables: a type, fill value and attributes for each variable, as the metadata of its column.

Metadata of columns are part of a Parquet file's schema, so a reader has them, and `decoded` needs nothing else to turn a
product back into the rows that it was made of.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.sources.writers import write_partitions

TYPE, FILL, UNITS = "dtype", "_FillValue", "units"
BYTE_FILL, INT_FILL, DOUBLE_FILL = 127, 2**31 - 1, 1.7976931348623157e308
SINCE_1990, EPOCH_1990 = "seconds since 1990-01-01 00:00:00", 631_152_000
_HEIGHT = {UNITS: "m", "coordinates": "latitude longitude", "coverage_content_type": "physicalMeasurement", "valid_min": -1e100, "valid_max": 1e100}
_AUXILIARY = {"coverage_content_type": "auxiliaryInformation"}
_FLAG = _AUXILIARY | {"standard_name": "quality_flag", "flag_values": [0, 1], "flag_meanings": "good bad"}

#: Type, fill value (None: unknown values stay so) and attributes of each variable, in the terms of the public conventions for
#: climate data (fixed values). Comments and whatever names a product or a source are given by the caller.
VARIABLES: dict[str, tuple[str, int | float | None, dict]] = {
    "time": ("double", None, {"long_name": "time", "standard_name": "time", UNITS: SINCE_1990, "coverage_content_type": "coordinate"}),
    "latitude": ("float", None, {"long_name": "latitude", "standard_name": "latitude", UNITS: "degrees_north", "coverage_content_type": "coordinate", "valid_min": -90.0, "valid_max": 90.0}),
    "longitude": ("float", None, {"long_name": "longitude", "standard_name": "longitude", UNITS: "degrees_east", "coverage_content_type": "coordinate", "valid_min": 0.0, "valid_max": 360.0}),
    "cycle": ("int", INT_FILL, {"long_name": "cycle of the satellite"} | _AUXILIARY),
    "pass": ("int", INT_FILL, {"long_name": "pass of the satellite"} | _AUXILIARY),
    "ssha": ("double", DOUBLE_FILL, {"long_name": "sea surface height anomaly", "standard_name": "sea_surface_height_above_mean_sea_level"} | _HEIGHT),
    "ssha_smoothed": ("double", DOUBLE_FILL, {"long_name": "smoothed sea surface height anomaly", "standard_name": "sea_surface_height_above_mean_sea_level"} | _HEIGHT),
    "dac": ("double", DOUBLE_FILL, {"long_name": "dynamic atmospheric correction"} | _HEIGHT | _AUXILIARY),
    "basin_flag": ("int", INT_FILL, {"long_name": "basin of the place"} | _AUXILIARY),
    "quality_flag": ("tinyint", BYTE_FILL, {"long_name": "quality of ssha"} | _FLAG),
    "median_flag": ("tinyint", BYTE_FILL, {"long_name": "outlier of the rolling median"} | _FLAG),
    "source_flag": ("array<tinyint>", BYTE_FILL, {"long_name": "flags of the source"} | _AUXILIARY),
}


def attributes(name: str, given: Mapping[str, Mapping] | None = None) -> dict:
    """The metadata of a variable: its type, fill value and attributes, with those given for it."""
    kind, fill, fixed = VARIABLES[name]
    return {TYPE: kind} | ({} if fill is None else {FILL: fill}) | fixed | dict((given or {}).get(name, {}))


def _coded(c: Column, name: str, kind: str, fill) -> Column:
    if name == "time":
        return (F.unix_micros(c) - EPOCH_1990 * 1_000_000) / 1e6
    if kind.startswith("array"):
        return F.transform(c.cast(kind), lambda x: F.coalesce(x, F.lit(fill).cast("tinyint")))
    c = c.cast(kind)
    if fill is None:
        return c
    return F.coalesce(F.when(~F.isnan(c), c) if kind == "double" else c, F.lit(fill).cast(kind))


def encoded(daily: DataFrame, given: Mapping[str, Mapping] | None = None) -> DataFrame:
    """daily with the variables that it has in the types of a product, unknown values and NaN as fill values, and attributes as
    metadata; given: further attributes by variable. Other columns stay; a null list of flags and null places stay null. A value
    that its type cannot hold is an error when it is read."""
    columns = []
    for name in daily.columns:
        if name in VARIABLES:
            kind, fill, _ = VARIABLES[name]
            columns.append(_coded(daily[name], name, kind, fill).alias(name, metadata=attributes(name, given)))
        else:
            columns.append(daily[name])
    return daily.select(*columns)


def _known(fill: Column, x: Column) -> Column:
    return F.nullif(x, fill)


def decoded(product: DataFrame) -> DataFrame:
    """A product's rows with nulls for fill values and instants for seconds, by the metadata of its columns alone."""
    columns = []
    for field in product.schema:
        c, meta = product[field.name], field.metadata
        fill = meta.get(FILL)
        if meta.get(UNITS) == SINCE_1990:
            c = F.timestamp_micros(F.round(c * 1e6).cast("long") + EPOCH_1990 * 1_000_000)
        elif fill is not None and meta[TYPE].startswith("array"):
            c = F.transform(c, partial(_known, F.lit(fill).cast("tinyint")))
        elif fill is not None:
            c = F.nullif(c, F.lit(fill).cast(meta[TYPE]))
        columns.append(c.alias(field.name, metadata=meta))
    return product.select(*columns)


def write_products(daily: DataFrame, path: str, given: Mapping[str, Mapping] | None = None) -> None:
    """Products by source and day; a written day replaces itself."""
    write_partitions(encoded(daily, given), path, ["source", "obs_date"])


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return decoded(spark.read.parquet(path))


def variable_attributes(product: DataFrame) -> DataFrame:
    """variable, key and value of the attributes of a product's variables, in case-insensitive order of keys."""
    rows = [(f.name, k, str(v)) for f in product.schema for k, v in f.metadata.items()]
    return product.sparkSession.createDataFrame(rows, "variable string, key string, value string").orderBy("variable", F.lower("key"))
