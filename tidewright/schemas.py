"""Explicit schemas of the tables that stages exchange."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "date": T.DateType(), "byte": T.ByteType()}


def _fields(text: str) -> list[str]:
    """Parts between commas that are not inside angle brackets."""
    parts, depth = [""], 0
    for c in text:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return [p.strip() for p in parts]


def _type(text: str) -> T.DataType:
    if text.startswith("array<"):
        return T.ArrayType(_type(text[6:-1]))
    if text.startswith("struct<"):
        return T.StructType([T.StructField(*f.split(":", 1)[:1], _type(f.split(":", 1)[1])) for f in _fields(text[7:-1])])
    return _TYPES[text]


def _ddl(text: str) -> T.StructType:
    """A schema from 'name type, ...', without a session, which Spark's own parser wants."""
    return T.StructType([T.StructField(f.split(" ", 1)[0], _type(f.split(" ", 1)[1])) for f in _fields(text)])


GRANULE_MERGED = _ddl("granule_id string, merged_cycle int, time timestamp, lat double, lon double, ssha double, reference_orbit int, index int, flag int, surface_type int")
GRANULE_NOIB = _ddl("granule_id string, row_index long, ssha_noib double")
PASS_LOOKUP = _ddl("id string, pass int")
GRANULE_REDUCED = _ddl(
    "granule_id string, cycle_number int, pass_number int, time timestamp, latitude double, longitude double, surface_class byte, rain_flag byte, "
    "radiometer_qual byte, dac double, mss1 double, mss2 double, sigma0 double, range_qual byte, swh double, ssha double"
)
CATALOG = _ddl("id string, title string, links array<struct<rel:string,href:string>>, time_start timestamp, time_end timestamp, updated timestamp, collection string")
DAILY = _ddl(
    "source string, version string, obs_date date, time timestamp, latitude double, longitude double, cycle int, pass int, ssha double, ssha_smoothed double, "
    "dac double, basin_flag int, quality_flag byte, median_flag byte, source_flag array<byte>"
)
CROSSOVER = _ddl("source string, version string, day date, time1 timestamp, time2 timestamp, lon double, lat double, ssh1 double, ssh2 double, cycle1 int, pass1 int, cycle2 int, pass2 int")
POLYNOMIAL = _ddl("source string, date date, interval int, lo double, hi double, c3 double, c2 double, c1 double, c0 double, rms_sig double, rms_res double, nint int")
CORRECTION = _ddl("source string, time timestamp, oer double")
BAD_PASS = _ddl("source string, date date, cycle int, pass int")
GRID = _ddl("grid_date date, lat_i int, lon_i int, latitude double, longitude double, ssha double, counts int, basin_flag int")
BASIN_LINKS = _ddl("basin_id int, valid_basin int")
POLYGON = _ddl("feature_id int, name string, ring array<struct<x:double,y:double>>")
STENCIL = _ddl("row int, col int, val double")
INDICATORS = _ddl("time double, gmsl double, smoothed_gmsl double, enso double, pdo double, iod double")
JOB = _ddl("date date, source string, satellite string, bucket string")
