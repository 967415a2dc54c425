"""The processing stages as plans over tables; each handles many days and sources in one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.scalars import bits, decimal_year_by_seconds, track_id, wrapped_longitude
from tidewright.nulls import clean
from tidewright.operators import crossover, flags, grid, indicators, lookups, passes, rolling, smoothing, spline, tiles
from tidewright.operators import polygons as polygons_of


def _finished(rows: DataFrame, mss: DataFrame, day: Column, source: str, mss_grid: dict) -> DataFrame:
    """Day subset, reference swap, basin override and smoothing, in the order that decides the result."""
    keys = ["source", "obs_date"]
    rows = rows.withColumn("source", F.lit(source)).withColumn("obs_date", day).where("time IS NOT NULL AND obs_date IS NOT NULL")
    rows = flags.first_of_time(rows, keys, "time", "arrival")
    rows = lookups.bilinear(rows, mss, "latitude", "longitude", name="_mss", **mss_grid)
    solutions = [F.col("mss1"), F.col("mss2")] if "mss1" in rows.columns else []
    rows = rows.withColumn("ssha", flags.mss_swap(F.col("ssha"), F.col("_mss"), *solutions)).drop("_mss", "mss1", "mss2")
    rows = rows.withColumn("quality_flag", flags.basin_override(F.col("bad").cast("int"), F.col("basin_flag")))
    usable = rows.withColumn("_x", F.when(F.col("quality_flag") == 0, F.col("ssha")))
    spine = smoothing.on_spine(usable, keys, "time", F.col("obs_date"))
    out = smoothing.smoothed(spine, "_x", keys, ["spine_time"], name="ssha_smoothed").where("time IS NOT NULL")
    return out.withColumn("version", F.lit("p1")).withColumn("quality_flag", F.col("quality_flag").cast("byte")).withColumn("median_flag", F.col("median_flag").cast("byte")).drop("_x", "_day", "spine_time", "arrival", "bad", "prelim")


def _with_basins(rows: DataFrame, polygons: DataFrame) -> DataFrame:
    rows = rows.withColumn("_lon180", wrapped_longitude(F.col("longitude")))
    return polygons_of.point_in_polygon(rows, polygons, "_lon180", "latitude", "arrival").drop("_lon180")


def merged_daily(granules: DataFrame, noib: DataFrame | None, polygons: DataFrame, mss: DataFrame, mss_grid: dict) -> DataFrame:
    """Day tables from merged granules: granule_id, arrival (unique), time, latitude, longitude, ssha (m), flag, surface_type,
    cycle, pass. Flags look at the whole granule set, before the day subset. noib: arrival, ssha_noib (mm)."""
    rows = _with_basins(clean(granules), polygons)
    rows = rows.withColumn("prelim", flags.merged_prelim(rows, ["granule_id"]))
    rows = rows.withColumn("prelim", F.col("prelim") & ~flags.manual_outliers(F.to_date("time"), F.col("latitude"), F.col("ssha"), F.col("prelim")))
    rows = rolling.median_outliers(rows, "ssha", "prelim", ["granule_id"], ["time", "arrival"], flags.SPREAD_FLOOR["merged"])
    rows = rows.withColumn("bad", flags.merged_bad())
    if noib is not None:
        rows = rows.join(noib, "arrival", "left")
    rows = rows.withColumn("dac", flags.atmospheric_correction(F.col("ssha"), F.col("ssha_noib") if noib is not None else F.lit(None).cast("double")))
    rows = rows.withColumn("source_flag", F.transform(bits(F.col("flag")), lambda b: b.cast("byte")))
    return _finished(rows, mss, F.to_date("time"), "merged", mss_grid)


def reduced_daily(granules: DataFrame, polygons: DataFrame, mss: DataFrame, mss_grid: dict) -> DataFrame:
    """Day tables from reduced granules, with the columns of flags.reduced_prelim, arrival, dac, mss1 and mss2."""
    rows = _with_basins(clean(granules), polygons)
    rows = rows.withColumn("prelim", flags.reduced_prelim())
    rows = rolling.median_outliers(rows, "ssha", "prelim", ["granule_id"], ["time", "arrival"], flags.SPREAD_FLOOR["reduced"], trim=flags.REDUCED_TRIM)
    rows = rows.withColumn("bad", flags.reduced_bad()).withColumn("source_flag", flags.source_flags())
    return _finished(rows, mss, F.to_date("time"), "reduced", mss_grid)


PROCESSORS: dict[str, Callable[..., DataFrame]] = {"merged": merged_daily, "reduced": reduced_daily}


def processor(source: str) -> Callable[..., DataFrame]:
    if source not in PROCESSORS:
        raise ValueError(f"unknown source {source!r}, known are {sorted(PROCESSORS)}")
    return PROCESSORS[source]


def crossover_table(daily: DataFrame, version: str = "p1") -> DataFrame:
    """Crossovers of all days and sources of the day tables in one job; a pair belongs to the day of its first time.

    Sources are a key of every join, so their number does not show in the plan, and no rows give no rows."""
    pts = daily.where("ssha_smoothed IS NOT NULL").select("source", track_id(F.col("cycle"), F.col("pass")).alias("track"), (F.unix_micros("time") / 1e6).alias("t"), F.pmod("longitude", F.lit(360.0)).alias("lon"), F.col("latitude").alias("lat"), F.col("ssha_smoothed").alias("v"))
    both = crossover.crossovers(pts, keys=("source",))
    times = {c: F.timestamp_micros(F.round(F.col(c) * 1e6).cast("long")) for c in ("time1", "time2")}
    return both.withColumns(times).withColumn("version", F.lit(version)).withColumn("day", F.to_date("time1"))


def orbit_correction(crossovers: DataFrame, daily: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The polynomials, the correction of each row and the corrected day tables (p2)."""
    x = crossovers.select("source", (F.unix_micros("time1") / 1e6).alias("time1"), (F.unix_micros("time2") / 1e6).alias("time2"), track_id(F.col("cycle1"), F.col("pass1")).alias("track1"), track_id(F.col("cycle2"), F.col("pass2")).alias("track2"), (F.col("ssh1") - F.col("ssh2")).alias("d"))
    days = daily.select("source", F.col("obs_date").alias("date")).distinct()
    polynomial = spline.fit_days(spline.day_inputs(x, days), days)
    points = daily.select("source", F.col("obs_date").alias("date"), "time").withColumn("h", (F.unix_micros("time") - F.unix_micros(F.col("date").cast("timestamp"))) / 3600e6)
    correction = spline.evaluated(points, polynomial, ["source", "date"], "h").select("source", "time", "oer")
    return polynomial, correction, spline.corrected(daily, correction, ["source", "time"]).withColumn("version", F.lit("p2"))


def bad_pass_table(crossovers: DataFrame, daily: DataFrame) -> DataFrame:
    """source, date, cycle and pass of the bad passes of each day."""
    rows = crossover.stacked(crossovers, ["source"], (track_id(F.col("cycle1"), F.col("pass1")), F.unix_micros("time1") / 1e6), (track_id(F.col("cycle2"), F.col("pass2")), F.unix_micros("time2") / 1e6), F.col("ssh1") - F.col("ssh2"))
    found = passes.bad_passes_of_days(rows, daily.select("source", F.col("obs_date").alias("date")).distinct())
    return found.select("source", "date", F.floor(F.col("track") / 10000).cast("int").alias("cycle"), (F.col("track") % 10000).cast("int").alias("pass"))


def finalized(daily: DataFrame, listed: DataFrame, mode: str = "pair") -> DataFrame:
    """p3: absolute offset by source, bad passes applied."""
    rows = daily.withColumn("ssha", passes.absolute_offset(F.col("ssha"), F.col("source"))).withColumn("ssha_smoothed", passes.absolute_offset(F.col("ssha_smoothed"), F.col("source")))
    rows = passes.applied(rows.withColumn("date", F.col("obs_date")), listed, mode).drop("date")
    return rows.withColumn("version", F.lit("p3"))


def weekly_grid(daily: DataFrame, cells: DataFrame, links: DataFrame, mondays: DataFrame, reach: float = grid.REACH_M, sigma: float = grid.SIGMA_M, k: int = grid.NEIGHBOURS, least: int = grid.LEAST_POINTS) -> DataFrame:
    """Grids of the given days (grid_date) from the rows of five days before to four after; a grid with too few points has no
    values. cells: cell, lat, lon, basin_id, lat_i, lon_i."""
    rows = daily.where("ssha_smoothed IS NOT NULL").select(F.col("obs_date"), F.struct("source", F.unix_micros("time").alias("time")).alias("point"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("ssha_smoothed").alias("v"), F.col("basin_flag").alias("basin"))
    each = rows.withColumn("grid_date", F.explode(F.sequence(F.date_sub("obs_date", 4), F.date_add("obs_date", 5)))).join(mondays.select("grid_date").distinct(), "grid_date", "left_semi")
    usable = grid.enough_points(each, ["grid_date"], "v", least).where("usable").select("grid_date")
    each = each.join(usable, "grid_date", "left_semi")
    dates = mondays.agg(F.array_sort(F.collect_set("grid_date"))).scalar()  # a day a week
    full = cells.withColumn("_dates", dates).withColumn("grid_date", F.explode("_dates")).drop("_dates")
    near_to = grid.basin_pairs(full, links.distinct()).select("cell", "lat", "lon", "basin", "grid_date").join(usable, "grid_date", "left_semi")
    near_to = near_to.withColumn("target", F.struct("grid_date", "cell"))
    near = lookups.nearest_within(near_to.select("target", "lat", "lon", "basin", "grid_date"), each.select("grid_date", "point", "lat", "lon", "v", "basin"), "target", "point", reach, k, ["basin", "grid_date"])
    means = grid.gaussian_means(near, "target", sigma).select("target.*", F.col("value").alias("ssha"), "counts", "deviation")
    out = full.join(means, ["grid_date", "cell"], "left").withColumn("counts", F.coalesce("counts", F.lit(0)))
    return out.withColumnsRenamed({"lat": "latitude", "lon": "longitude", "basin_id": "basin_flag"})


def anomaly_grid(grids: DataFrame, stencil: list[tuple[int, int, float]], steps: int, season: DataFrame, trend: DataFrame, tile: tiles.Tile | None = None) -> DataFrame:
    """Filled, diffused and deseasoned grids in mm on their own cells. grids: grid_date, cell, ssha, basin_flag; season: cell, at,
    value (cm); trend: cell, slope, offset (cm). Each grid is one task, or with tile its tiles are, for grids of high resolution."""
    rows = grids.select("grid_date", "cell", F.col("ssha").alias("v"), F.col("basin_flag").alias("basin_id"))
    smooth = tiles.fill_and_diffuse(rows, stencil, steps, tile) if tile else grid.fill_and_diffuse(rows, stencil, steps)
    smooth = smooth.withColumn("t", decimal_year_by_seconds(F.col("grid_date").cast("timestamp"))).withColumn("share", F.col("t") - F.year("grid_date"))
    seasonal = grid.season_at(smooth, season, ["cell"], "share", "value", "seasonal").join(trend, "cell")
    return seasonal.select("grid_date", "cell", "basin_id", indicators.anomaly_mm(F.col("v"), F.col("seasonal"), F.col("slope"), F.col("offset"), F.col("t")).alias("anomaly"))


def quarter_degree(anomalies: DataFrame, cells: DataFrame, lat0: float, lon0: float, step: float, n_lon: int, targets: DataFrame) -> DataFrame:
    """An anomaly grid of one date on finer targets (row, col, lat, lon), gaps of one filled along longitude and then latitude, in
    the band of 66 degrees and on ocean targets (basin_id)."""
    coarse = anomalies.join(cells.select("cell", "lat_i", "lon_i"), "cell").select("lat_i", "lon_i", F.col("anomaly").alias("value"))
    fine = grid.regridded(coarse, targets, lat0, lon0, step, n_lon)
    fine = grid.fill_gaps_of_one(grid.fill_gaps_of_one(fine, ["row"], "lon", "value"), ["col"], "lat", "value")
    ocean = (F.col("basin_id") > 0) & (F.col("basin_id") < 1000)
    return fine.withColumn("value", F.when(indicators.in_band(F.col("lat")) & ocean, F.col("value")))
