"""Quality masks, outlier rules and unit changes of along-track data.

Two kinds of source: "merged" records carry one bit field, "reduced" records several categorical flags. All masks treat a
comparison with a missing value as false.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.scalars import any_bit
from tidewright.nulls import holds, known

HIGH_LATITUDE, HIGH_SSHA = 60.0, 1.2
#: Bits that reject a merged record before and after the median test, bit 0 being ignored in sets with the cycle below.
PRELIM_BITS, FINAL_BITS, LENIENT_CYCLE = [0, 1, 2, 3, 4, 5, 9], [1, 2, 3, 5], 583
SPREAD_FLOOR = {"merged": 0.05, "reduced": 0.02}
REDUCED_TRIM = 2.0
#: Days and latitude bands with known bad values under -1.
MANUAL_RULES = [(date(1995, 6, 7), 20.0, 25.0, -1.0), (date(2001, 6, 26), -25.0, -15.0, -1.0)]
#: Corners of the lines in (sigma0, wave height) above which a record is rejected.
WAVE_CORNERS = [(11.0, 10.0), (16.0, 6.0), (26.0, 3.0), (32.0, 0.0)]
OVERRIDE_BASINS = [0, 1003, 190]


def metres(millimetres: Column) -> Column:
    return millimetres / 1000


def in_ocean(basin: Column) -> Column:
    return holds((basin > 0) & (basin < 1000))


def too_high(ssha: Column, lat: Column, basin: Column) -> Column:
    """Open ocean poleward of 60 degrees with an anomaly of over 1.2 m."""
    return holds(in_ocean(basin) & (F.abs(lat) > HIGH_LATITUDE) & (F.abs(known(ssha)) > HIGH_SSHA))


def merged_prelim(df: DataFrame, keys: list[str]) -> Column:
    """The mask before the median test of merged records; keys name the granule set."""
    lenient = F.max(F.when(F.col("cycle") == LENIENT_CYCLE, 1).otherwise(0)).over(Window.partitionBy(*keys)) == 1
    bad = F.when(lenient, any_bit(F.col("flag"), [b for b in PRELIM_BITS if b])).otherwise(any_bit(F.col("flag"), PRELIM_BITS))
    return holds(F.col("surface_type").isin(0, 2) & ~bad & known(F.col("ssha")).isNotNull() & ~too_high(F.col("ssha"), F.col("latitude"), F.col("basin_flag")))


def merged_bad() -> Column:
    """True where a merged record is bad, given median_flag."""
    return ~holds(F.col("surface_type").isin(0, 2) & ~any_bit(F.col("flag"), FINAL_BITS) & known(F.col("ssha")).isNotNull() & ~F.col("median_flag") & ~too_high(F.col("ssha"), F.col("latitude"), F.col("basin_flag")))


def manual_outliers(day: Column, lat: Column, ssha: Column, prelim: Column, rules: list[tuple] = MANUAL_RULES) -> Column:
    out = F.lit(False)
    for when, south, north, under in rules:
        out = out | holds((day == F.lit(when)) & prelim & lat.between(south, north) & (ssha < under))
    return out


def wave_reject(s0: Column, swh: Column, corners: list[tuple[float, float]] = WAVE_CORNERS) -> Column:
    """Wave height over 14, over 10 above the first corner, or above the lines through the corners; the third line counts from
    the second corner on, as it does upstream."""
    lines = [(s0 - x1) * ((y2 - y1) / (x2 - x1)) + y1 for (x1, y1), (x2, y2) in zip(corners, corners[1:], strict=False)]
    (x1, _), (x2, _), (x3, _) = corners[:3]
    rules = [swh > 14, (s0 > x1) & (swh > 10), (s0 >= x1) & (s0 < x2) & (swh > lines[0]), (s0 >= x2) & (s0 < x3) & (swh > lines[1]), (s0 >= x2) & (swh > lines[2])]
    out = F.lit(False)
    for r in rules:
        out = out | holds(r)
    return out


def reduced_prelim() -> Column:
    ok = F.col("surface_class").isin(0, 2) & (F.col("range_qual") == 0) & F.col("rain_flag").isin(0, 3, 5) & (F.abs(known(F.col("ssha"))) < 5) & in_ocean(F.col("basin_flag"))
    return holds(ok & ~too_high(F.col("ssha"), F.col("latitude"), F.col("basin_flag")) & ~wave_reject(F.col("sigma0"), F.col("swh")))


def reduced_bad() -> Column:
    ok = known(F.col("ssha")).isNotNull() & F.col("surface_class").isin(0, 2) & (F.col("range_qual") == 0) & F.col("rain_flag").isin(0, 3, 5) & (F.col("radiometer_qual") == 0)
    return ~holds(ok & ~F.col("median_flag") & ~too_high(F.col("ssha"), F.col("latitude"), F.col("basin_flag")))


def source_flags() -> Column:
    return F.array(*[F.col(c).cast("byte") for c in ("range_qual", "surface_class", "radiometer_qual", "rain_flag")])


def basin_override(flag: Column, basin: Column) -> Column:
    return F.when(holds(basin.isin(*OVERRIDE_BASINS)), F.lit(1)).otherwise(flag)


def small_anomalies(df: DataFrame, limit: float = 2.0, value: str = "ssha") -> DataFrame:
    return df.where(F.abs(F.col(value)) < limit)


def of_day(df: DataFrame, day: Column, time: str = "time") -> DataFrame:
    return df.where(F.col(time).isNotNull() & (F.to_date(F.col(time)) == day))


def first_of_time(df: DataFrame, keys: list[str], time: str, arrival: str) -> DataFrame:
    """Of rows with one time the first to arrive."""
    w = Window.partitionBy(*keys, time).orderBy(arrival)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def atmospheric_correction(ssha: Column, ssha_noib_mm: Column) -> Column:
    """Anomaly without the correction (mm, 0 where missing) minus the anomaly with it (m)."""
    return F.coalesce(ssha_noib_mm / 1000, F.lit(0.0)) - ssha


def mss_swap(ssha: Column, mss: Column, solution1: Column | None = None, solution2: Column | None = None) -> Column:
    out = ssha if solution1 is None else ssha + solution1 - solution2
    return out + mss


def priority_pick(df: DataFrame, key: str, priority: str, arrival: str) -> DataFrame:
    """Of rows with one key that of the least priority value, of equals the first to arrive; rows without a key go."""
    w = Window.partitionBy(key).orderBy(priority, arrival)
    return df.where(F.col(key).isNotNull()).withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
