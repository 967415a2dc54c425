"""Scalar functions: names and ids, calendars, planar distances, formats."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1990-01-01"


def date_in_name(c: Column) -> Column:
    """The first run of eight digits of a file name as a date."""
    return F.to_date(F.regexp_extract(c, r"(\d{8})", 1), "yyyyMMdd")


def cycle_pass(title: Column, strict: bool = True) -> Column:
    """The ddd_ddd key of a title, NULL without one; strict wants underscores around it."""
    key = F.regexp_extract(title, r"_(\d{3}_\d{3})_" if strict else r"(\d{3}_\d{3})", 1)
    return F.when(key != "", key)


def padded_id(orbit: Column, index: Column) -> Column:
    return F.concat(F.lpad(orbit.cast("string"), 3, "0"), F.lpad(index.cast("string"), 4, "0"))


def track_id(cycle: Column, number: Column) -> Column:
    return cycle.cast("long") * 10000 + number


def track_parts(track: Column) -> tuple[Column, Column]:
    """Cycle and pass of a track id."""
    return F.floor(track / 10000).cast("int"), F.pmod(track, F.lit(10000)).cast("int")


def wrapped_longitude(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def seconds_since(ts: Column, epoch: str = EPOCH) -> Column:
    return (F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.lit(epoch).cast("timestamp"))) / 1e6


def decimal_year_by_seconds(ts: Column) -> Column:
    """Year and the share of its seconds that have passed."""
    t = ts.cast("timestamp")
    y = F.year(t)
    begin, end = (F.unix_micros(F.make_date(y + k, F.lit(1), F.lit(1)).cast("timestamp")) for k in (0, 1))
    return y + (F.unix_micros(t) - begin) / (end - begin)


def decimal_year_by_day(day: Column) -> Column:
    """Year and day of year over the days of the year: from y + 1/365 on the first day to y + 1 on the last."""
    y = F.year(day)
    return y + F.dayofyear(day) / F.dayofyear(F.make_date(y, F.lit(12), F.lit(31)))


def timestamp_of_decimal_year(t: Column) -> Column:
    """The instant of a decimal year, its fraction taken as days of 1/365.25 year."""
    y = F.floor(t).cast("int")
    begin = F.unix_micros(F.make_date(y, F.lit(1), F.lit(1)).cast("timestamp"))
    return F.timestamp_micros(begin + F.round((t - y) * (365.25 * 86400e6)).cast("long"))


def monday_of(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day))


def last_full_monday(today: Column) -> Column:
    """The latest Monday whose window, up to four days later, ended before today."""
    monday = monday_of(today)
    return F.when(F.date_add(monday, 4) >= today, F.date_sub(monday, 7)).otherwise(monday)


def last_daily_date(today: Column) -> Column:
    return F.date_add(last_full_monday(today), 4)


def bits(flag: Column, n: int | Column = 10) -> Column:
    """The lower n bits as an array of booleans."""
    last = n - 1 if isinstance(n, Column) else F.lit(n - 1)
    each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.getbit(flag, i) == 1)
    return F.slice(each, 1, F.greatest(last + 1, F.lit(0)))


def bit_width(df: DataFrame, flag: str) -> Column:
    """The number of bits that the flags of df need, ceil(log2(max)), as a scalar subquery: one global aggregate of one row,
    which Spark runs before the pass that uses it. The greatest flag itself has a bit of its own only if it is no power of two.
    Without flags, or with none over 1, it is 0."""
    most = F.max(F.col(flag).cast("long"))
    width = F.when(most > 1, F.length(F.bin(most - 1))).otherwise(0)
    return df.agg(width.cast("int").alias("width")).scalar()


def split_flags(df: DataFrame, flag: str, name: str = "bits") -> DataFrame:
    """df with the bits of its flags, as many as the greatest flag of all rows asks for."""
    return df.withColumn("_width", bit_width(df, flag)).withColumn(name, bits(F.col(flag), F.col("_width"))).drop("_width")


def any_bit(flag: Column, which: list[int]) -> Column:
    return flag.bitwiseAND(F.lit(sum(1 << b for b in which))) != 0


def clipped(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """c between the bounds, NULL where c is."""
    out = c if low is None else F.greatest(c, F.lit(low))
    out = out if high is None else F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def local_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column, km_per_degree: float = 111.0) -> Column:
    """Distance in a plane tangent at the mean latitude."""
    dx = (lon2 - lon1) * F.cos((lat1 + lat2) / 2 * (math.pi / 180))
    return F.sqrt(dx * dx + (lat2 - lat1) * (lat2 - lat1)) * km_per_degree


def fixed_width(time: Column, *values: Column) -> Column:
    """A text line: time left-aligned in 12 with 7 decimals, values right-aligned in 12 with 6."""
    return F.format_string("%-12.7f" + " %12f" * len(values), time, *values)


def tidy_name(c: Column, pairs: tuple[tuple[str, str], ...] = ((" ", "_"), ("(", ""), (")", ""), (",", ""), ("'", ""))) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def joined_distinct(c: Column, by: str = ", and ") -> Column:
    """Aggregate: the distinct values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), by)
