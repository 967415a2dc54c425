"""Climate indicators from gridded anomalies."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.scalars import decimal_year_by_day, timestamp_of_decimal_year
from tidewright.operators.grid import NEIGHBOURS, valid_grids
from tidewright.operators.rolling import running_mean

LATITUDE, TREND_EPOCH, BASELINE, FIRST = 66.0, datetime(1992, 10, 2), (1993.0, 1994.0), date(1993, 1, 1)


def in_band(lat: Column, limit: float = LATITUDE) -> Column:
    return lat.between(-limit, limit)


def ocean_only(value: Column, basin: Column, mode: str = "ocean") -> Column:
    """value on ocean cells (0 < basin < 1000); mode none keeps all, which is what upstream's test amounts to."""
    return value if mode == "none" else F.when((basin > 0) & (basin < 1000), value)


def area_mean(df: DataFrame, keys: list[str], value: str, area: str, name: str = "gmsl", scale: float = 100.0) -> DataFrame:
    """Mean over area of the known values, times scale; NULL without any."""
    a = F.when(F.col(value).isNotNull(), F.col(area))
    return df.groupBy(*keys).agg((F.lit(scale) * F.try_divide(F.sum(F.col(value) * F.col(area)), F.sum(a))).alias(name))


def detrended(day: Column, value: Column, slope: Column, offset: Column, annual_mm: Column) -> Column:
    """value less the trend since its epoch (per second) and the seasonal value in mm."""
    seconds = F.unix_seconds(day.cast("timestamp")) - F.unix_seconds(F.lit(TREND_EPOCH).cast("timestamp"))
    return value - (seconds * slope + offset) - annual_mm / 1000


def anomaly_mm(value_m: Column, seasonal_cm: Column, slope_cm: Column, offset_cm: Column, decimal_year: Column) -> Column:
    """The anomaly in mm without season and trend, both given in cm."""
    return value_m * 1000 - seasonal_cm * 10 - (slope_cm * 10 * decimal_year + offset_cm * 10)


def projected(df: DataFrame, keys: list[str], value: str, pattern_mm: str, name: str) -> DataFrame:
    """The factor of the pattern (mm, taken in m) that fits the known values best; a fit without an intercept."""
    p = F.when(F.col(value).isNotNull(), F.col(pattern_mm) / 1000)
    return df.groupBy(*keys).agg(F.try_divide(F.sum(p * F.col(value)), F.sum(p * p)).alias(name))


def shifted_to_baseline(df: DataFrame, keys: list[str], time: str, value: str, span: tuple[float, float] = BASELINE) -> DataFrame:
    inside = (F.col(time) >= span[0]) & (F.col(time) < span[1])
    return df.withColumn(value, F.col(value) - F.avg(F.when(inside, F.col(value))).over(Window.partitionBy(*keys)))


def usable_grids(grids: DataFrame, first: date = FIRST, neighbours: int = NEIGHBOURS) -> DataFrame:
    """grid_date of the grids from the first day on whose cells in the band of latitude have enough neighbours on average."""
    band = grids.where(F.col("grid_date") >= F.lit(first)).where(in_band(F.col("latitude")))
    return valid_grids(band, ["grid_date"], "counts", k=neighbours).select("grid_date")


def series(grids: DataFrame, cells: DataFrame, annual: DataFrame, patterns: DataFrame, names: tuple[str, ...] = ("enso", "pdo", "iod"), mask: str = "ocean", neighbours: int = NEIGHBOURS) -> DataFrame:
    """The indicator series, a row for each grid date from 1993 on that has enough neighbours: time (decimal year), gmsl (cm, less
    its mean of 1993), smoothed_gmsl and the factor of each pattern.

    grids: grid_date, lat_i, lon_i, latitude, ssha, basin_flag, counts. cells: lat_i, lon_i, area, slope, offset. annual: month,
    lat_i, lon_i, annual_mm. patterns: pattern, lat_i, lon_i, pattern_mm. Cells meet by index, not by coordinates. Grids
    without a value have a row without one; none give no rows.
    """
    at = ["lat_i", "lon_i"]
    rows = grids.join(usable_grids(grids, neighbours=neighbours), "grid_date", "left_semi")
    rows = rows.withColumn("ssha", ocean_only(F.col("ssha"), F.col("basin_flag"), mask)).join(cells, at)
    gmsl = area_mean(rows.where(in_band(F.col("latitude"))), ["grid_date"], "ssha", "area")
    level = rows.withColumn("month", F.month("grid_date")).join(annual, [*at, "month"]).withColumn("a", detrended(F.col("grid_date"), F.col("ssha"), F.col("slope"), F.col("offset"), F.col("annual_mm")))
    fits = projected(level.join(patterns, at), ["grid_date", "pattern"], "a", "pattern_mm", "factor")
    wide = fits.groupBy("grid_date").agg(*[F.max(F.when(F.col("pattern") == n, F.col("factor"))).alias(n) for n in names])
    out = gmsl.join(wide, "grid_date", "left").withColumn("time", decimal_year_by_day(F.col("grid_date"))).withColumn("one", F.lit(1))  # a row a week
    out = shifted_to_baseline(out, ["one"], "time", "gmsl")
    return out.withColumn("smoothed_gmsl", running_mean(F.col("gmsl"), timestamp_of_decimal_year(F.col("time")), ["one"])).select("time", "gmsl", "smoothed_gmsl", *names)
