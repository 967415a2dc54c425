"""Seeded synthetic inputs: ground tracks with a known orbit error, polygons, reference grids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _noise(seed: int, *cols: Column) -> Column:
    """Repeatable uniform noise in [-1, 1)."""
    return (F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 20)) / float(1 << 19)) - 1


def ground_tracks(spark: SparkSession, tracks: int = 24, points: int = 600, step_s: int = 5, seed: int = 1, error: Column | None = None) -> DataFrame:
    """track, t (s), lon, lat and v: passes that climb and fall in turn between 66 degrees south and north, each starting west
    of the one before, over a smooth field with a per-pass bias and a little noise; a few points are missing."""
    each = spark.range(tracks * points)
    n, k = F.floor(F.col("id") / points), F.col("id") % points
    share = k / float(points - 1)
    t = n * float(points * step_s + 300) + k * float(step_s)
    lat = F.asin(math.sin(math.radians(66)) * F.sin((share - 0.5) * math.pi * F.when(n % 2 == 0, 1.0).otherwise(-1.0))) * (180 / math.pi)
    lon = F.pmod(n * 163.7 + share * 170.0 + 5.0, F.lit(360.0))
    field = 0.2 * F.sin(lat * (math.pi / 30)) + 0.1 * F.cos(lon * (math.pi / 45))
    bias = 0.05 * F.sin(n * 0.7)
    v = field + bias + 0.002 * _noise(seed, F.col("id")) + (F.lit(0.0) if error is None else error)
    rows = each.select((F.lit(10000) + n + 1).cast("long").alias("track"), t.alias("t"), lon.alias("lon"), lat.alias("lat"), v.alias("v"))
    return rows.withColumn("v", F.when(_noise(seed + 1, F.col("track"), F.col("t")) > -0.96, F.col("v")))


def _star(x: float, y: float, spikes: int, outer: float, inner: float) -> list[tuple[float, float]]:
    return [(x + r * math.cos(k * math.pi / spikes), y + r * math.sin(k * math.pi / spikes)) for k in range(2 * spikes) for r in ((outer, inner)[k % 2],)]


#: A convex, a concave and an overlapping ring; a lake with a hole, an island in the hole and a second part; a star of many edges
#: with a hole: feature_id, name and ring.
RINGS: list[tuple[int, str, list[tuple[float, float]]]] = [
    (1, "Square Sea (west)", [(-40.0, -30.0), (0.0, -30.0), (0.0, 10.0), (-40.0, 10.0)]),
    (2, "Hook Sea", [(10.0, -20.0), (60.0, -20.0), (60.0, 30.0), (40.0, 30.0), (40.0, 0.0), (10.0, 0.0)]),
    (3, "Overlap Sea", [(-10.0, 0.0), (20.0, 0.0), (20.0, 25.0), (-10.0, 25.0)]),
    (4, "Island Lake", [(70.0, -60.0), (120.0, -60.0), (120.0, -10.0), (70.0, -10.0)]),
    (4, "Island Lake", [(80.0, -50.0), (80.0, -20.0), (110.0, -20.0), (110.0, -50.0)]),
    (4, "Island Lake", [(90.0, -40.0), (100.0, -40.0), (95.0, -25.0)]),
    (4, "Island Lake", [(130.0, -50.0), (141.0, -50.0), (141.0, -40.0), (130.0, -40.0)]),
    (5, "Star Sea", _star(-100.0, 40.0, 90, 38.0, 31.0)),
    (5, "Star Sea", _star(-100.0, 40.0, 40, 14.0, 9.0)),
]


def polygons(spark: SparkSession) -> DataFrame:
    """RINGS, a row for each ring."""
    rows = [(i, n, [{"x": x, "y": y} for x, y in r]) for i, n, r in RINGS]
    return spark.createDataFrame(rows, "feature_id int, name string, ring array<struct<x:double,y:double>>")


def cells(spark: SparkSession, n_lat: int = 24, n_lon: int = 48) -> DataFrame:
    """A coarse global grid: cell, lat_i, lon_i, lat, lon, area, basin_id (0 on a band of land)."""
    step = 180.0 / n_lat
    i, j = F.floor(F.col("id") / n_lon).cast("int"), (F.col("id") % n_lon).cast("int")
    lat, lon = -90 + (i + 0.5) * step, (j + 0.5) * (360.0 / n_lon)
    return spark.range(n_lat * n_lon).select(F.col("id").cast("int").alias("cell"), i.alias("lat_i"), j.alias("lon_i"), lat.alias("lat"), lon.alias("lon"), F.cos(lat * (math.pi / 180)).alias("area"), F.when(j % 12 == 0, 0).when(lon < 180, 1).otherwise(2).alias("basin_id"))


def stencil(n_lat: int = 24, n_lon: int = 48, rate: float = 0.1) -> list[tuple[int, int, float]]:
    """The five-point diffusion stencil, periodic in longitude, as (row, col, val)."""
    out = []
    for i in range(n_lat):
        for j in range(n_lon):
            near = [((i, (j + d) % n_lon)) for d in (-1, 1)] + [(i + d, j) for d in (-1, 1) if 0 <= i + d < n_lat]
            out.append((i * n_lon + j, i * n_lon + j, -rate * len(near)))
            out += [(i * n_lon + j, a * n_lon + b, rate) for a, b in near]
    return out
