"""Gridding along-track values and filling, smoothing and regridding grids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.lookups import bilinear, nearest_within
from tidewright.operators.setops import periodic

REACH_M, SIGMA_M, NEIGHBOURS, LEAST_POINTS = 600e3, 175e3, 500, 150_000


def basin_pairs(targets: DataFrame, links: DataFrame) -> DataFrame:
    """Each target cell of a basin under 1000 once for each basin that may feed it, as column basin."""
    return targets.where("basin_id > 0 AND basin_id < 1000").join(links, "basin_id").withColumnRenamed("valid_basin", "basin")


def gaussian_means(near: DataFrame, key: str, sigma: float) -> DataFrame:
    """key, value, counts and deviation of neighbours (key, distance, v): the weighted mean, their number and the weighted
    standard deviation of the sample, NULL for one neighbour."""
    w = F.exp(-(F.col("distance") / sigma) * (F.col("distance") / sigma))
    rows = near.withColumn("_w", w).withColumn("_v", F.col("v").cast("double"))
    sums = rows.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("counts"), F.sum("_w").alias("_n"), F.sum(F.col("_w") * F.col("_w")).alias("_nn"), F.sum(F.col("_w") * F.col("_v")).alias("_s"), F.sum(F.col("_w") * F.col("_v") * F.col("_v")).alias("_ss"))
    mean = F.col("_s") / F.col("_n")
    spread = F.greatest(F.lit(0.0), F.col("_ss") - F.col("_n") * mean * mean)
    deviation = F.when(F.col("counts") > 1, F.sqrt(F.try_divide(F.col("_n"), F.col("_n") * F.col("_n") - F.col("_nn")) * spread))
    return sums.select(key, mean.alias("value"), "counts", deviation.alias("deviation"))


def gaussian_grid(targets: DataFrame, sources: DataFrame, links: DataFrame | None = None, reach: float = REACH_M, sigma: float = SIGMA_M, k: int = NEIGHBOURS) -> DataFrame:
    """cell, value, counts and deviation: the mean of the k nearest sources within reach, weighted by
    exp(-(distance / sigma)**2), their number and weighted standard deviation.

    targets: cell, lat, lon, basin_id; sources: point, lat, lon, v, basin. With links a source counts only for cells whose basin
    is linked with its own. Cells without a source have no value and 0 counts.
    """
    keys = []
    near_to = targets.select("cell", "lat", "lon")
    if links is not None:
        keys = ["basin"]
        near_to = basin_pairs(targets, links.distinct()).select("cell", "lat", "lon", "basin")
    near = nearest_within(near_to, sources.where("v IS NOT NULL"), "cell", "point", reach, k, keys)
    means = gaussian_means(near, "cell", sigma)
    return targets.select("cell").join(means, "cell", "left").withColumn("counts", F.coalesce("counts", F.lit(0)))


def enough_points(df: DataFrame, keys: list[str], value: str, least: int = LEAST_POINTS) -> DataFrame:
    """keys, n and usable of each grid's input."""
    return df.groupBy(*keys).agg(F.count(value).alias("n")).withColumn("usable", F.col("n") >= least)


def valid_grids(grid: DataFrame, keys: list[str], counts: str = "counts", share: float = 0.9, k: int = NEIGHBOURS) -> DataFrame:
    """keys and mean count of the grids whose cells have over share of k neighbours on average."""
    return grid.groupBy(*keys).agg(F.avg(counts).alias("mean_counts")).where(F.col("mean_counts") > share * k)


def extremes(grid: DataFrame, keys: list[str], value: str) -> DataFrame:
    return grid.groupBy(*keys).agg(F.min(value).alias("least"), F.max(value).alias("greatest"))


def matvec(stencil: DataFrame, x: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """keys, row, product and weight of a sparse (row, col, val) times x (keys, col, value): sums over known values."""
    known = stencil.join(x.where(F.col(value).isNotNull()), "col")
    return known.groupBy(*keys, "row").agg(F.sum(F.col("val") * F.col(value)).alias("product"), F.sum("val").alias("weight"))


def fill_once(grid: DataFrame, stencil: DataFrame, keys: list[str]) -> DataFrame:
    """grid (keys, cell, v, basin_id) with unknown ocean cells that have a known neighbour set to the stencil's weighted mean of
    the known ones; the diagonal does not count."""
    found = matvec(stencil.where("row <> col"), grid.select(*keys, F.col("cell").alias("col"), "v"), keys).where("weight <> 0").select(*keys, F.col("row").alias("cell"), (F.col("product") / F.col("weight")).alias("_new"))
    ocean = (F.col("basin_id") > 0) & (F.col("basin_id") < 1000)
    return grid.join(found, [*keys, "cell"], "left").withColumn("v", F.coalesce("v", F.when(ocean, F.col("_new")))).drop("_new")


def diffuse_once(grid: DataFrame, stencil: DataFrame, keys: list[str]) -> DataFrame:
    """v + D v; a cell with an unknown in its stencil row is unknown."""
    x = grid.select(*keys, F.col("cell").alias("col"), F.col("v").alias("_x"))
    step = stencil.join(x, "col").groupBy(*keys, "row").agg(F.when(F.count("_x") == F.count(F.lit(1)), F.sum(F.col("val") * F.col("_x"))).alias("_d"), F.count(F.lit(1)).alias("_n")).withColumnRenamed("row", "cell")
    return grid.join(step, [*keys, "cell"], "left").withColumn("v", F.when(F.col("_n").isNull(), F.col("v")).otherwise(F.col("v") + F.col("_d"))).drop("_d", "_n")


def fill_and_diffuse(grid: DataFrame, stencil: list[tuple[int, int, float]], steps: int, key: str = "grid_date") -> DataFrame:
    """grid (key, cell, v, basin_id) filled until no cell changes and then diffused for so many steps.

    A grid is a few hundred thousand cells and the steps are sequential, so each grid is one group; grids run in parallel. The
    stencil, of fixed size, goes with the function.
    """
    import pandas as pd

    row, col, val = (np.array(x) for x in zip(*stencil, strict=True))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cell")
        cells = frame["cell"].to_numpy()
        r, c = np.searchsorted(cells, row), np.searchsorted(cells, col)
        ok = (r < len(cells)) & (c < len(cells))
        ok[ok] = (cells[r[ok]] == row[ok]) & (cells[c[ok]] == col[ok])
        r, c, w = r[ok], c[ok], val[ok]
        v = frame["v"].to_numpy(float).copy()
        ocean = ((frame["basin_id"] > 0) & (frame["basin_id"] < 1000)).to_numpy()
        off = r != c
        while True:
            known = ~np.isnan(v)
            s = np.bincount(r[off], weights=np.where(known, v, 0)[c[off]] * w[off], minlength=len(v))
            n = np.bincount(r[off], weights=known[c[off]] * w[off], minlength=len(v))
            todo = ~known & ocean & (n != 0)
            if not todo.any():
                break
            v[todo] = s[todo] / n[todo]
        for _ in range(steps):
            v = v + np.bincount(r, weights=v[c] * w, minlength=len(v))
        return frame.assign(v=v)

    return grid.groupBy(key).applyInPandas(run, grid.schema)


def fill_gaps_of_one(df: DataFrame, keys: list[str], axis: str, value: str) -> DataFrame:
    """The first unknown place of each run between known values along an axis gets the linear value; the others stay."""
    w = Window.partitionBy(*keys)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(axis).alias("at"), F.col(value).alias("v")))
    before = F.lag(point).over(w.orderBy(axis))
    after = F.last(point, True).over(w.orderBy(F.desc(axis)).rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_a", before).withColumn("_b", after)
    a, b = F.col("_a"), F.col("_b")
    line = a.v + (b.v - a.v) * F.try_divide(F.col(axis) - a["at"], b["at"] - a["at"])
    return df.withColumn(value, F.coalesce(F.col(value), F.when(a.isNotNull() & b.isNotNull(), line))).drop("_a", "_b")


def season_at(points: DataFrame, months: DataFrame, cells: list[str], at: str, value: str, name: str) -> DataFrame:
    """points (cells, at) with the seasonal value interpolated between the months around.

    A cell's months are one row with an array, so a point meets one row; its place in the array is the number of months that
    have begun. Points before the last month of the year before or after the first of the next are left out."""
    joined = points.join(season_rows(months, cells, value), cells).withColumn("_i", F.size(F.filter("_season", lambda m: m["at"] <= F.col(at))))
    joined = joined.where((F.col("_i") > 0) & (F.col("_i") < F.size("_season")))
    a, b = F.get("_season", F.col("_i") - 1), F.get("_season", F.col("_i"))
    line = a["v"] + (b["v"] - a["v"]) * (F.col(at) - a["at"]) / (b["at"] - a["at"])
    return joined.withColumn(name, line).drop("_season", "_i")


def regridded(grid: DataFrame, targets: DataFrame, lat0: float, lon0: float, step: float, n_lon: int) -> DataFrame:
    """targets (lat, lon) with value interpolated from a grid (lat_i, lon_i, value) that is periodic in longitude."""
    wide = periodic(grid.withColumn("lon_i", F.col("lon_i").cast("double")), "lon_i", n_lon, -2, n_lon + 1).withColumn("lon_i", F.col("lon_i").cast("int"))
    return bilinear(targets, wide, "lat", "lon", lat0, lon0, step, "value")


def season_rows(months: DataFrame, cells: list[str], value: str) -> DataFrame:
    """A row for each cell with _season: its months (at, a share of a year, and v) in order, with the last of the year before
    and the first of the year after."""
    line = F.sort_array(F.collect_list(F.struct(F.col("at"), F.col(value).alias("v"))))
    moved = lambda m, by: F.array(F.struct((m["at"] + by).alias("at"), m["v"].alias("v")))
    rows = months.groupBy(*cells).agg(line.alias("_m"))
    return rows.select(*cells, F.concat(moved(F.element_at("_m", -1), -1), F.col("_m"), moved(F.element_at("_m", 1), 1)).alias("_season"))
