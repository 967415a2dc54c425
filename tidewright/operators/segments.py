"""Prefix scans over one long series by many tasks.

A series is cut into segments by quantiles of its first order column; a window runs within each segment, and what goes from one
segment to the next, the number of rows before it or the last known value, is a row a segment: small tables scanned for
themselves and joined back. So a series of a single key is ordered, numbered and filled by as many tasks as it has segments.
Rows with one value of the first order column stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a segment, about; the quantiles taken of a series, and so its most segments; the cuts that one step looks through.
ROWS, CUTS, STEP = 20_000, 1024, 32
SEG = "_seg"


def met(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns of small, which has a row for each key; null keys meet each other."""
    named = small.withColumnsRenamed({k: f"_{k}_of" for k in keys})
    joined = df.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}_of")) for k in keys])
    return joined.drop(*[f"_{k}_of" for k in keys])


def _place(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    return F.unix_micros(F.col(column).cast("timestamp")).cast("double") if kind in ("timestamp", "timestamp_ntz", "date") else F.col(column).cast("double")


def cut(df: DataFrame, keys: list[str], order: list[str], rows: int = ROWS) -> DataFrame:
    """df with _seg, which rises with the first order column within keys: a number, date or time, null first."""
    at = _place(df, order[0])
    quantiles = F.percentile_approx(at, [k / CUTS for k in range(1, CUTS)], 10_000)
    wanted = F.least(F.lit(CUTS), F.ceil(F.count(F.lit(1)) / rows))
    cuts = df.groupBy(*keys).agg(quantiles.alias("_q"), wanted.alias("_w"))
    thin = F.coalesce(F.array_distinct(F.filter("_q", lambda _, i: ((i + 1) * F.col("_w")) % CUTS < F.col("_w"))), F.array().cast("array<double>"))
    cuts = cuts.select(*keys, thin.alias("_cuts"))
    cuts = cuts.withColumn("_coarse", F.filter("_cuts", lambda _, i: i % STEP == STEP - 1))
    joined = met(df, cuts, keys)
    block = F.size(F.filter("_coarse", lambda c: c <= at))
    fine = F.size(F.filter(F.slice("_cuts", F.col("_block") * STEP + 1, STEP), lambda c: c <= at))
    return joined.withColumn("_block", block).withColumn(SEG, F.col("_block") * STEP + fine).drop("_cuts", "_coarse", "_block")


def numbered(df: DataFrame, name: str, keys: list[str], order: list[str]) -> DataFrame:
    """df, which has _seg, with name: the number of the row, from 0, within keys in this order, which is total."""
    counts = df.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.withColumn("_before", F.sum("_rows").over(Window.partitionBy(*keys).orderBy(SEG)) - F.col("_rows")).drop("_rows")
    own = F.row_number().over(Window.partitionBy(*keys, SEG).orderBy(*order)) - 1
    return met(df.withColumn("_own", own), before, [*keys, SEG]).withColumn(name, F.col("_before") + F.col("_own")).drop("_before", "_own")


def known_around(df: DataFrame, point: Column, keys: list[str], order: list[str], before: str, after: str) -> DataFrame:
    """df, which has _seg, with before and after: the nearest point that is not null at or before and at or after each row."""
    df = df.withColumn("_point", point)
    place = F.when(F.col("_point").isNotNull(), F.struct(*[F.col(c).alias(f"o{n}") for n, c in enumerate(order)], F.col("_point").alias("p")))
    ends = df.groupBy(*keys, SEG).agg(F.max(place).alias("_last"), F.min(place).alias("_first"))
    line = Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys,
        SEG,
        F.last("_last", True).over(line.orderBy(SEG))["p"].alias("_from"),
        F.last("_first", True).over(line.orderBy(F.desc(SEG)))["p"].alias("_to"),
    )
    up, down = (Window.partitionBy(*keys, SEG).orderBy(*[f(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0) for f in (F.asc, F.desc))
    within = df.withColumn(before, F.last("_point", True).over(up)).withColumn(after, F.last("_point", True).over(down))
    out = met(within, carried, [*keys, SEG])
    return out.withColumn(before, F.coalesce(before, "_from")).withColumn(after, F.coalesce(after, "_to")).drop("_point", "_from", "_to")
