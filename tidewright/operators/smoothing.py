"""The gap-aware Gaussian smoother on an even spine."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.rolling import neighbours

HALF, SPACING_KM, SIGMA_KM = 9, 5.745, 15.0


def weights(half: int = HALF, spacing: float = SPACING_KM, sigma: float = SIGMA_KM) -> list[float]:
    """Gaussian weights of places 0 to half, such that all 2 * half + 1 sum to 1."""
    raw = [math.exp(-((k * spacing / sigma) ** 2)) for k in range(half + 1)]
    total = raw[0] + 2 * sum(raw[1:])
    return [w / total for w in raw]


def on_spine(df: DataFrame, keys: list[str], time: str, day: Column, step: str = "1 second") -> DataFrame:
    """Each series on an even spine over its days: keys, _day and spine_time, with df's columns where the times meet (times are cut to
    whole steps of a second; of rows that fall on one place the first in time order stays)."""
    at = F.date_trunc("second", F.col(time).cast("timestamp"))
    rows = df.withColumn("_day", day).withColumn("spine_time", at)
    first = Window.partitionBy(*keys, "spine_time").orderBy(time)
    rows = rows.withColumn("_k", F.row_number().over(first)).where("_k = 1").drop("_k")
    begin = F.col("_day").cast("timestamp")
    spine = rows.select(*keys, "_day").distinct().withColumn("spine_time", F.explode(F.sequence(begin, begin + F.expr("INTERVAL 1 DAY") - F.expr(f"INTERVAL {step}"), F.expr(f"INTERVAL {step}"))))
    return spine.join(rows, [*keys, "_day", "spine_time"], "left")


def smoothed(df: DataFrame, value: str, keys: list[str], order: list[str], half: int = HALF, spacing: float = SPACING_KM, sigma: float = SIGMA_KM, name: str = "smoothed") -> DataFrame:
    """df, one row for each place of the spine, with the smoothed value.

    A window without a value on either side of the centre gives NULL. Inside a window, missing places between known ones are
    filled linearly; a place counts only if its mirror image counts too; the weights left are normalised, and with the
    centre alone left the result is NULL. A missing centre can get a value.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_i", F.row_number().over(w).cast("double"))
    before, after = neighbours(F.col(value), F.col("_i"), keys, order)
    df = df.withColumn("_p", before).withColumn("_q", after)
    p, q = F.col("_p"), F.col("_q")
    filled = F.when(F.col(value).isNotNull(), F.col(value).cast("double")).otherwise(p.v + (q.v - p.v) * F.try_divide(F.col("_i") - p.at, q.at - p.at))
    df = df.withColumn("_c", F.struct(filled.alias("v"), p.at.alias("lo"), q.at.alias("hi")))
    for k in range(1, half + 1):
        df = df.withColumn(f"_b{k}", F.lag("_c", k).over(w)).withColumn(f"_f{k}", F.lead("_c", k).over(w))

    def usable(c: Column) -> Column:
        return F.coalesce((c.lo >= F.col("_i") - half) & (c.hi <= F.col("_i") + half), F.lit(False))

    ws = weights(half, spacing, sigma)
    sides = [(ws[k], usable(F.col(f"_b{k}")) & usable(F.col(f"_f{k}")), F.col(f"_b{k}").v + F.col(f"_f{k}").v) for k in range(1, half + 1)]
    centre = usable(F.col("_c"))
    total = sum((F.when(u, 2 * wk).otherwise(0.0) for wk, u, _ in sides), F.when(centre, ws[0]).otherwise(0.0))
    value_sum = sum((F.when(u, wk * v).otherwise(0.0) for wk, u, v in sides), F.when(centre, ws[0] * F.col("_c").v).otherwise(0.0))
    some = sides[0][1]
    for _, u, _ in sides[1:]:
        some = some | u
    out = df.withColumn(name, F.when(some, F.try_divide(value_sum, total)))
    return out.drop("_i", "_p", "_q", "_c", *[f"_{s}{k}" for k in range(1, half + 1) for s in "bf"])
