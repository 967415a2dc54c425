"""Bad passes: statistics of crossover differences, the list of bad passes, and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.setops import distinct_on, removed

MEAN_LIMIT, MEAN_LEAST, STD_LIMIT, STD_LEAST, MARGIN_S = 0.1, 15, 0.27, 25, 3600.0
OFFSETS = {"reduced": 0.0291}


def pass_stats(rows: DataFrame, keys: list[str], value: str = "d") -> DataFrame:
    """n, mean and sample standard deviation of the differences of each pass."""
    return rows.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def bad(stats: DataFrame) -> DataFrame:
    """Passes of over 15 differences whose mean is over 0.1, or of over 25 whose deviation is over 0.27."""
    return stats.where(((F.col("n") > MEAN_LEAST) & (F.abs("mean") > MEAN_LIMIT)) | ((F.col("n") > STD_LEAST) & (F.col("std") > STD_LIMIT)))


def bad_passes_of_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """(source, date, track, n, mean, std) of the bad passes of each day: passes with a difference within an hour of the day,
    judged by all differences of the window from 11 days before to one day after.

    rows: source, track, time (seconds), d. Each row goes to the 13 days whose window holds it, and one grouping judges all days.
    """
    day_of = F.floor(F.col("time") / 86400).cast("int")
    each = rows.withColumn("date", F.explode(F.transform(F.sequence(day_of - 1, day_of + 11), lambda k: F.date_add(F.lit("1970-01-01").cast("date"), k))))
    each = each.join(days.select("source", "date").distinct(), ["source", "date"], "left_semi")
    begin = F.unix_seconds(F.col("date").cast("timestamp"))
    touching = F.col("time").between(begin - MARGIN_S, begin + 86400 + MARGIN_S)
    stats = each.groupBy("source", "date", "track").agg(F.count("d").alias("n"), F.avg("d").alias("mean"), F.stddev_samp("d").alias("std"), F.max(touching).alias("_on")).where("_on").drop("_on")
    return bad(stats)


def updated_list(existing: DataFrame, cleared: DataFrame, added: DataFrame) -> DataFrame:
    """The list of (source, date, cycle, pass) without the (source, date) that are processed anew, with the added rows; ids are
    integers on both sides, so equal rows count once."""
    cast = lambda df: df.select(F.col("source").cast("string"), F.col("date").cast("date"), F.col("cycle").cast("int"), F.col("pass").cast("int"))
    return distinct_on(removed(cast(existing), cleared, ["source", "date"]).unionByName(cast(added)))


def applied(daily: DataFrame, listed: DataFrame, mode: str = "pair") -> DataFrame:
    """daily with quality_flag 1 on bad passes, and no ssha_smoothed where any flag is 1.

    mode pair: cycle and pass are listed together for the row's source and date. cross: the cycle is listed and the pass is.
    """
    on = ["source", "date"]
    if mode == "pair":
        marks = listed.select(*on, "cycle", "pass").distinct().withColumn("_bad", F.lit(True))
        found = daily.join(marks, [*on, "cycle", "pass"], "left").withColumn("_hit", F.coalesce("_bad", F.lit(False))).drop("_bad")
    else:
        cycles = listed.select(*on, "cycle").distinct().withColumn("_c", F.lit(True))
        passes = listed.select(*on, "pass").distinct().withColumn("_q", F.lit(True))
        found = daily.join(cycles, [*on, "cycle"], "left").join(passes, [*on, "pass"], "left").withColumn("_hit", F.coalesce(F.col("_c") & F.col("_q"), F.lit(False))).drop("_c", "_q")
    flagged = found.withColumn("quality_flag", F.when(F.col("_hit"), F.lit(1)).otherwise(F.col("quality_flag"))).drop("_hit")
    return flagged.withColumn("ssha_smoothed", F.when(F.col("quality_flag") == 1, F.lit(None).cast("double")).otherwise(F.col("ssha_smoothed")))


def flagged_list(listed: DataFrame, keys: list[str]) -> DataFrame:
    """The passes of each key as 'cycle/pass, cycle/pass', in order."""
    each = F.array_sort(F.collect_list(F.struct("cycle", "pass")))
    return listed.groupBy(*keys).agg(F.array_join(F.transform(each, lambda p: F.format_string("%s/%s", p["cycle"], p["pass"])), ", ").alias("passes"))


def absolute_offset(value: Column, source: Column, before: Column | None = None, offsets: dict[str, float] = OFFSETS) -> Column:
    """value with its source's offset, less an offset applied before; sources without one have 0."""
    offset = F.lit(0.0)
    for name, amount in offsets.items():
        offset = F.when(source == name, F.lit(amount)).otherwise(offset)
    return value - (F.lit(0.0) if before is None else F.coalesce(before, F.lit(0.0))) + offset
