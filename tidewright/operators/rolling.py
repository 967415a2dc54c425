"""Ordered operators: centred rolling medians, interpolation, outliers, gaps, running means.

Every window is partitioned by keys, so a series (a granule set, a day) is the unit that one task needs; none runs over all
rows. Medians over the rows that pass a mask use the mask as a further partition key, which needs no join back. Rolling
medians cut a series into chunks that overlap by half a frame. With spread, for few and long series, a series is also
numbered and filled in segments (segments.py), so that one key takes as many tasks as it has segments; without, for many
short series, their windows need no further pass over the rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.nulls import holds
from tidewright.operators import segments
from tidewright.session import stored


#: Rows of a chunk of a series.
CHUNK = 20_000


def rolling_median(df: DataFrame, name: str, value: Column, keys: list[str], order: list[str], half: int, spread: bool = False) -> DataFrame:
    """df with name: the median of value over the row and half rows on each side, fewer at the ends; NULLs do not count.

    Rows are numbered within keys and dealt by (keys, chunk); a chunk also gets the half rows before and behind it and slides
    one ordered frame over its rows, where a window aggregate would sort each frame anew.
    """
    schema = df.withColumn(name, F.lit(None).cast("double")).schema
    df = df.withColumn("_v", value.cast("double"))
    if spread:
        own = segments.SEG in df.columns
        numbered = segments.numbered(df if own else segments.cut(df, keys, order), "_at", keys, order)
        numbered = numbered if own else numbered.drop(segments.SEG)
    else:
        numbered = df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    chunk = lambda at: F.floor(at / CHUNK).cast("int")
    near = F.array_distinct(F.array(chunk(F.col("_at")), chunk(F.greatest(F.col("_at") - half, F.lit(0))), chunk(F.col("_at") + half)))
    dealt = numbered.withColumn("_chunk", F.explode(near)).repartition(*keys, "_chunk")

    def run(table: pa.Table) -> pa.Table:
        import pandas as pd

        table = table.sort_by("_at")
        own = table.column("_at").to_numpy() // CHUNK == table.column("_chunk")[0].as_py()
        x = pd.Series(table.column("_v").to_numpy(zero_copy_only=False).astype(float))
        median = x.rolling(2 * half + 1, center=True, min_periods=1).median().to_numpy()
        out = table.select([c for c in schema.names if c != name]).append_column(name, pa.array(median, pa.float64(), from_pandas=True))
        out = out.filter(pa.array(own)).select(schema.names)
        instant = pa.timestamp("us", "UTC")  # instants come in the session's zone and are wanted in this one
        return out.cast(pa.schema([f.with_type(instant) if pa.types.is_timestamp(f.type) and f.type.tz else f for f in out.schema]))

    return dealt.groupBy(*keys, "_chunk").applyInArrow(run, schema)


def _point(value: Column, position: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(position.cast("double").alias("at"), value.cast("double").alias("v")))


def neighbours(value: Column, position: Column, keys: list[str], order: list[str]) -> tuple[Column, Column]:
    """The nearest known (at, v) at or before and at or after a row; order is total within keys.

    Both look back, one of them in descending order: a frame that ends at the current row grows with it, while one from the
    current row to the end is computed anew for each row.
    """
    point = _point(value, position)
    up, down = (Window.partitionBy(*keys).orderBy(*[f(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0) for f in (F.asc, F.desc))
    return F.last(point, True).over(up), F.last(point, True).over(down)


def interpolated(df: DataFrame, name: str, value: str, position: str, keys: list[str], order: list[str], clamp: bool = True, spread: bool = False) -> DataFrame:
    """df with name: value filled linearly over position; past the ends the nearest value, or NULL without clamp."""
    columns = df.columns
    if spread:
        df = df if segments.SEG in columns else segments.cut(df, keys, order)
        df = segments.known_around(df, _point(F.col(value), F.col(position)), keys, order, "_before", "_after")
        df = df.select(*columns, "_before", "_after")
    else:
        before, after = neighbours(F.col(value), F.col(position), keys, order)
        df = df.withColumn("_before", before).withColumn("_after", after)
    a, b = F.col("_before"), F.col("_after")
    inside = F.when(b.at == a.at, a.v).otherwise(a.v + (b.v - a.v) * F.try_divide(F.col(position) - a.at, b.at - a.at))
    filled = F.when(a.isNotNull() & b.isNotNull(), inside)
    if clamp:
        filled = F.coalesce(filled, a.v, b.v)
    return df.withColumn(name, filled).drop("_before", "_after")


def median_outliers(
    df: DataFrame,
    value: str,
    mask: str,
    keys: list[str],
    order: list[str],
    floor: float,
    half_median: int = 7,
    half_std: int = 47,
    factor: float = 5.0,
    trim: float | None = None,
    spread: bool = False,
) -> DataFrame:
    """df with median, spread and median_flag: rows further than factor spreads from the rolling median.

    Median and spread (root of the rolling median of squared residuals, floor at least) come from the rows that pass the
    mask, with trim only from residuals under it, and are interpolated over the row number to all rows. Without any row
    that passes, or where the value is missing, every comparison fails and the row is flagged. With spread the rows are
    stored between the steps, each of which reads them twice.
    """
    if spread:
        df = segments.numbered(segments.cut(df, keys, order), "_n", keys, order)
    else:
        df = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    held = (lambda x: stored(x, "series")) if spread else (lambda x: x)
    ok = holds(F.col(mask) & F.col(value).isNotNull())
    df = held(df.withColumn("_ok", ok))
    df = rolling_median(df, "_med", F.col(value), [*keys, "_ok"], order, half_median, spread).withColumn("_med", F.when(F.col("_ok"), F.col("_med")))
    residual = F.col(value) - F.col("_med")
    use = F.col("_ok") if trim is None else holds(F.col("_ok") & (F.abs(residual) < trim))
    df = held(df.withColumn("_use", use).withColumn("_sq", residual * residual))
    df = rolling_median(df, "_std", F.col("_sq"), [*keys, "_use"], order, half_std, spread).withColumn("_std", F.when(F.col("_use"), F.greatest(F.sqrt("_std"), F.lit(floor))))
    df = interpolated(held(df), "median", "_med", "_n", keys, order, spread=spread)
    df = interpolated(df, "spread", "_std", "_n", keys, order, spread=spread)
    flag = ~holds(F.abs(F.col(value) - F.col("median")) <= factor * F.col("spread"))
    return df.withColumn("median_flag", flag).drop("_n", "_ok", "_med", "_use", "_sq", "_std", segments.SEG)


def running_mean(value: Column, time: Column, keys: list[str], days: float = 28.1) -> Column:
    """Mean of the values within so many days on each side; fewer at the ends; NULLs do not count."""
    reach = round(days * 86_400_000_000)
    w = Window.partitionBy(*keys).orderBy(F.unix_micros(time.cast("timestamp"))).rangeBetween(-reach, reach)
    return F.avg(value).over(w)


def gaps(df: DataFrame, time_hours: str, keys: list[str], small: float = 0.75, large: float = 1.2) -> DataFrame:
    """df with gap (hours to the next row) and constraints: the middle of gaps from small to large, half an hour around the
    left end of larger ones (both measured from there)."""
    gap = F.lead(time_hours).over(Window.partitionBy(*keys).orderBy(time_hours)) - F.col(time_hours)
    t = F.col(time_hours)
    points = F.when((F.col("gap") > small) & (F.col("gap") < large), F.array(t + F.col("gap") / 2)).when(F.col("gap") >= large, F.array(t - 0.5, t + 0.5)).otherwise(F.array().cast("array<double>"))
    return df.withColumn("gap", gap).withColumn("constraints", points)


def sign_changes(value: Column, keys: list[str], order: list[str]) -> Column:
    """True where the next value has the opposite sign; zero has none."""
    nxt = F.lead(F.signum(value)).over(Window.partitionBy(*keys).orderBy(*order))
    return holds(F.abs(nxt - F.signum(value)) == 2)


def cycle_rollover(df: DataFrame, keys: list[str], order: list[str], cycle: str = "cycle", number: str = "pass") -> DataFrame:
    """Rows from the first drop of the pass number on that hold the first row's cycle and pass 1 get the next cycle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    dropped = F.max(F.when(F.col("_last") > F.col(number), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    first = F.first(cycle).over(w)
    df = df.withColumn("_last", F.lag(number).over(w))
    return df.withColumn("_new", F.when(dropped & (F.col(cycle) == first) & (F.col(number) == 1), F.col(cycle) + 1).otherwise(F.col(cycle))).drop("_last", cycle).withColumnRenamed("_new", cycle)
