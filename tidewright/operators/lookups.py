"""Joins: look-up tables, intervals, bands, reference grids, polygons, neighbours on a sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_M = 6_370_997.0


def looked_up(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join with a table of unique keys; a row whose key is missing there is an error when it is read."""
    found = df.join(table.withColumn("_found", F.lit(True)), key, "left")
    check = F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"no entry for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))))
    return found.where(check).drop("_found")


def band_join(left: DataFrame, right: DataFrame, left_at: str, low: str, high: str, width: float, keys: list[str] = [], closed: str = "left", how: str = "inner") -> DataFrame:  # noqa: B006
    """Rows with low <= left_at < high (closed: left, both or none), by equal buckets of the given width.

    The right side is repeated for each bucket that its interval meets, so the width should be near the intervals' length; the
    join is then an equi join, which needs no nested loop over all pairs.
    """
    bucket = F.floor(F.col(left_at) / width)
    a = left.withColumn("_bucket", bucket)
    b = right.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    inside = {"left": (F.col(left_at) >= F.col(low)) & (F.col(left_at) < F.col(high)), "both": F.col(left_at).between(F.col(low), F.col(high)), "none": (F.col(left_at) > F.col(low)) & (F.col(left_at) < F.col(high))}[closed]
    on = (a["_bucket"] == b["_bucket"]) & inside
    for k in keys:
        on = on & (a[k] == b[k])
    out = a.join(b, on, how)
    for k in keys:
        out = out.drop(b[k])
    return out.drop(a["_bucket"]).drop(b["_bucket"])


def granule_days(granules: DataFrame, days: DataFrame, start: str, end: str, day: str = "day", overlap: bool = True) -> DataFrame:
    """Granules with the days that they overlap or, without overlap, whose midnight lies strictly inside them."""
    midnight = F.col(day).cast("timestamp")
    days = days.distinct()
    each = granules.withColumn("_day", F.explode(F.sequence(F.to_date(F.col(start)), F.to_date(F.col(end)))))
    joined = each.join(days, each["_day"] == days[day])
    if overlap:
        return joined.where((F.col(end) > midnight) & (F.col(start) < midnight + F.expr("INTERVAL 1 DAY"))).drop("_day")
    return joined.where((F.col(end) > midnight) & (F.col(start) < midnight)).drop("_day")


def corner_table(grid: DataFrame, lat_i: str = "lat_i", lon_i: str = "lon_i", value: str = "value") -> DataFrame:
    """For each cell its value and those of the cells to the east, north and north-east, as v00, v01, v10, v11."""
    moved = F.explode(F.array(*[F.struct((F.col(lat_i) - a).alias("i"), (F.col(lon_i) - b).alias("j"), F.lit(f"v{a}{b}").alias("c")) for a in (0, 1) for b in (0, 1)]))
    rows = grid.select(F.col(value).alias("_v"), moved.alias("_m")).select("_v", "_m.*")
    return rows.groupBy(F.col("i").alias(lat_i), F.col("j").alias(lon_i)).agg(*[F.max(F.when(F.col("c") == c, F.col("_v"))).alias(c) for c in ("v00", "v01", "v10", "v11")])


def bilinear(points: DataFrame, grid: DataFrame, lat: str, lon: str, lat0: float, lon0: float, step: float, name: str, value: str = "value") -> DataFrame:
    """points with the grid's value at (lat, lon), weighted by area between the four cells around; NULL where one is missing.

    grid has lat_i, lon_i and value; cell (i, j) is at lat0 + i step, lon0 + j step.
    """
    y, x = (F.col(lat) - lat0) / step, (F.col(lon) - lon0) / step
    p = points.withColumn("lat_i", F.floor(y).cast("int")).withColumn("lon_i", F.floor(x).cast("int")).withColumn("_fy", y - F.floor(y)).withColumn("_fx", x - F.floor(x))
    joined = p.join(corner_table(grid, value=value), ["lat_i", "lon_i"], "left")
    fy, fx = F.col("_fy"), F.col("_fx")
    v = F.col("v00") * (1 - fy) * (1 - fx) + F.col("v01") * (1 - fy) * fx + F.col("v10") * fy * (1 - fx) + F.col("v11") * fy * fx
    return joined.withColumn(name, v).drop("lat_i", "lon_i", "_fy", "_fx", "v00", "v01", "v10", "v11")


def edges(ring: Column) -> Column:
    """The edges of a ring of (x, y), closed if it is not."""
    closed = F.concat(ring, F.array(ring[0]))
    return F.zip_with(F.slice(closed, 1, F.size(ring)), F.slice(closed, 2, F.size(ring)), lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")))


def geocentric(lat: Column, lon: Column, radius: float = EARTH_M) -> tuple[Column, Column, Column]:
    la, lo = lat * (math.pi / 180), lon * (math.pi / 180)
    return radius * F.cos(la) * F.cos(lo), radius * F.cos(la) * F.sin(lo), radius * F.sin(la)


#: Cells of a cube of the search radius along a side, halvings of a cell at most, and the part of k that a cell holds, about.
CELLS, HALVINGS, PART = 4, 4, 8


def _indexed(df: DataFrame, reach: float) -> DataFrame:
    """df with _x, _y, _z on the sphere and _f, its place in the finest cells."""
    df = df.withColumns(dict(zip(("_x", "_y", "_z"), geocentric(F.col("lat"), F.col("lon")), strict=True)))
    finest = reach / (CELLS << HALVINGS)
    return df.withColumn("_f", F.struct(*[F.floor(F.col(f"_{c}") / finest).alias(c) for c in "xyz"]))


def _coarser(f: Column, by: int | Column) -> Column:
    return F.struct(*[F.floor(f[c] / by).cast("long").alias(c) for c in "xyz"])


def _boxes(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    box = [g(f"_{c}").alias(f"{name}{c}{n}") for c in "xyz" for n, g in ((0, F.min), (1, F.max))]
    return df.groupBy(*keys, "_leaf").agg(F.first("_cube").alias("_cube"), F.count(F.lit(1)).alias(f"{name}n"), *box)


def near_cells(targets: DataFrame, sources: DataFrame, reach: float, k: int, keys: list[str]) -> DataFrame:
    """keys, _leaf (of targets) and _of (of sources): the pairs of cells that can hold one of the k nearest within reach.

    Between two cells stand a least and a most distance, of their points' boxes. Cells in order of the most distance that hold k
    points together bound the distance of the k-th; a cell whose least distance is beyond that or beyond reach holds none."""
    own = _boxes(targets, keys, "t").drop("tn")
    around = F.transform(F.sequence(F.lit(0), F.lit(26)), lambda i: F.struct((F.col("_cube.x") + i % 3 - 1).alias("x"), (F.col("_cube.y") + F.floor(i / 3) % 3 - 1).alias("y"), (F.col("_cube.z") + F.floor(i / 9) - 1).alias("z")))
    seen = own.withColumn("_cube", F.explode(around))
    held = _boxes(sources, keys, "s").withColumnRenamed("_leaf", "_of")
    both = seen.join(held, [*keys, "_cube"])
    gap = lambda c: F.greatest(F.lit(0.0), F.col(f"s{c}0") - F.col(f"t{c}1"), F.col(f"t{c}0") - F.col(f"s{c}1"))
    span = lambda c: F.greatest(F.col(f"s{c}1") - F.col(f"t{c}0"), F.col(f"t{c}1") - F.col(f"s{c}0"))
    length = lambda f: F.sqrt(sum(f(c) * f(c) for c in "xyz"))
    both = both.select(*keys, "_leaf", "_of", "sn", (length(gap) - 1e-3).alias("_least"), (length(span) + 1e-3).alias("_most")).where(F.col("_least") <= reach)
    w = Window.partitionBy(*keys, "_leaf")
    both = both.withColumn("_held", F.sum("sn").over(w.orderBy("_most", "_of").rowsBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("_bound", F.min(F.when(F.col("_held") >= k, F.col("_most"))).over(w))
    return both.where(F.col("_least") <= F.coalesce("_bound", F.lit(reach))).select(*keys, "_leaf", "_of")


def candidates_within(targets: DataFrame, sources: DataFrame, target_key: str, reach: float, k: int, keys: list[str]) -> DataFrame:
    """Each target with the sources of the cells that can hold one of its k nearest, with the distance of each.

    Cells are a quarter of reach wide, and narrower where the sources lie denser, so that a cell holds about k / 8 of them."""
    base = lambda df: df.withColumn("_base", _coarser(F.col("_f"), 1 << HALVINGS)).withColumn("_cube", _coarser(F.col("_f"), CELLS << HALVINGS))
    s, t = (base(_indexed(df, reach)) for df in (sources, targets))
    dense = s.groupBy(*keys, "_base").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max(8, k // PART))
    halvings = F.least(F.lit(HALVINGS), F.ceil(F.log2(F.col("_n") / max(8, k // PART)) / 2)).cast("int")
    dense = dense.select(*keys, "_base", halvings.alias("_h"))
    fine = lambda df: df.join(dense, [*keys, "_base"], "left").withColumn("_h", F.coalesce("_h", F.lit(0)))
    leaf = lambda df: df.withColumn("_leaf", F.struct("_h", _coarser(F.col("_f"), F.pow(F.lit(2.0), F.lit(HALVINGS) - F.col("_h"))).alias("at")))
    s, t = leaf(fine(s)), leaf(fine(t))
    pairs = near_cells(t, s, reach, k, keys)
    a = t.select(target_key, *keys, "_leaf", *[F.col(f"_{c}").alias(f"_t{c}") for c in "xyz"]).join(pairs, [*keys, "_leaf"]).drop("_leaf")
    b = s.drop("lat", "lon", "_f", "_base", "_cube", "_h").withColumnRenamed("_leaf", "_of")
    d2 = sum((F.col(f"_t{c}") - F.col(f"_{c}")) * (F.col(f"_t{c}") - F.col(f"_{c}")) for c in "xyz")
    return a.join(b, [*keys, "_of"]).withColumn("distance", F.sqrt(d2)).drop("_of", *[f"_{c}" for c in "xyz"], *[f"_t{c}" for c in "xyz"])


def nearest_within(targets: DataFrame, sources: DataFrame, target_key: str, source_key: str, reach: float, k: int, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """The k nearest sources of each target within reach metres of chord, equal in keys: target_key, the sources' columns and
    distance; of equal distances the smaller source key, which is unique, first. Both sides have lat and lon.

    A target meets the sources of few cells; Spark keeps the first k of each task's rows before it deals them by target."""
    near = candidates_within(targets, sources, target_key, reach, k, keys).where(F.col("distance") <= reach)
    w = Window.partitionBy(target_key).orderBy("distance", source_key)
    return near.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")
