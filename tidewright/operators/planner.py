"""The incremental job planner: which days need work, from the times of inputs and outputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.scalars import cycle_pass, last_full_monday, monday_of

FIRST_DAY, DEFAULT_START, SWITCH = date(1992, 10, 25), date(2024, 1, 1), date(2024, 1, 21)
#: Missions of the reference orbit, each from its first day on; the last is open.
MISSIONS = [
    (date(1992, 1, 1), "TOPEX/Poseidon"),
    (date(2002, 5, 14), "Jason-1"),
    (date(2008, 7, 12), "Jason-2"),
    (date(2016, 3, 18), "Jason-3"),
    (date(2022, 4, 7), "Sentinel-6 Michael Freilich"),
]


def source_of(day: Column, override: str | None = None, switch: date = SWITCH, names: tuple[str, str] = ("merged", "reduced")) -> Column:
    return F.lit(override) if override else F.when(day < F.lit(switch), F.lit(names[0])).otherwise(F.lit(names[1]))


def mission(day: Column, missions: list[tuple[date, str]] = MISSIONS) -> Column:
    """The mission of a day, NULL before the first."""
    out = F.lit(None).cast("string")
    for since, name in missions:
        out = F.when(day >= F.lit(since), F.lit(name)).otherwise(out)
    return out


def day_range(start: date | None, end: date | None, lookback: str | None, today: date, last: date) -> tuple[date, date]:
    """First and last day: as given (not before the first day), all for lookback full, else from the default start."""
    if start and end:
        return max(start, FIRST_DAY), end
    return (FIRST_DAY if lookback == "full" else DEFAULT_START), last


def days(spark, start: date, end: date, name: str = "day") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(name))


def days_by_year(df: DataFrame, day: str = "day") -> DataFrame:
    return df.groupBy(F.year(day).alias("year")).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n"))


def needs_work(output_time: Column, input_time: Column, force: bool = False) -> Column:
    """Forced, without an output, or with an input newer than the output."""
    return F.lit(True) if force else output_time.isNull() | F.coalesce(output_time < input_time, F.lit(False))


def latest(granules: DataFrame, day: str = "day", time: str = "updated") -> DataFrame:
    return granules.groupBy(day).agg(F.max(time).alias("input_time"))


def latest_by_priority(granules: DataFrame, day: str, title: str, priority: str, time: str, arrival: str, reset: bool = False) -> DataFrame:
    """Latest change of each day over granules in order of arrival, of which one counts if no earlier one of its cycle and pass
    has a better priority. With reset only granules of the best priority count."""
    rows = granules.withColumn("_key", cycle_pass(F.col(title), strict=False)).where("_key IS NOT NULL")
    w = Window.partitionBy(day, "_key").orderBy(arrival)
    best = F.min(priority).over(Window.partitionBy(day, "_key") if reset else w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_best", best).where(F.col(priority) <= F.col("_best")).groupBy(day).agg(F.max(time).alias("input_time"))


def jobs(spine: DataFrame, outputs: DataFrame, inputs: DataFrame, bucket: str, force: bool = False, override: str | None = None) -> DataFrame:
    """date, source, satellite and bucket of each day of spine that needs work; outputs: day, output_time; inputs: day, input_time."""
    joined = spine.join(outputs, "day", "left").join(inputs, "day", "left")
    source = source_of(F.col("day"), override)
    return joined.where(needs_work(F.col("output_time"), F.col("input_time"), force)).select(F.col("day").alias("date"), source.alias("source"), source.alias("satellite"), F.lit(bucket).alias("bucket"))


def affected_mondays(dates: DataFrame, day: str, today: Column) -> DataFrame:
    """The Mondays around each day, as far as their window is over, each once."""
    monday = monday_of(F.col(day))
    return dates.select(F.explode(F.array(monday, F.date_add(monday, 7))).alias("monday")).where(F.col("monday") <= last_full_monday(today)).distinct()
