"""Queries that apply the operators to the star-schema tables, each with the SQL of the same result.

events stand for along-track points (ts: time, user_id: pass, event_type: source, value: height), lineitem and orders for flags
and records, customer and supplier for places. Results are rounded on both sides where sums may differ in order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright import synth
from tidewright.functions import scalars as S
from tidewright.operators import crossover, flags, grid, indicators, lookups, passes, planner, polygons, rolling, segments, setops, smoothing, spline, tiles
from tidewright.session import scratch_folder
from tidewright.sources import commits, products, readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def events(spark: SparkSession, d: str) -> DataFrame:
    """Events with time as an instant."""
    return table(spark, d, "events").drop("props").withColumn("ts", F.col("ts").cast("timestamp"))


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- scans, masks, projections ----------------------------------------------------------------------------------------


@query("SELECT event_id, event_type, round(value / 1000, 9) AS metres FROM events")
def scan_project_scale(spark, d):
    return events(spark, d).select("event_id", "event_type", F.round(flags.metres(F.col("value")), 9).alias("metres"))


@query("""
SELECT event_type, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, event_id, value FROM (
  SELECT event_type, date_trunc('hour', ts) AS slot, event_id, value, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) AS k
  FROM events WHERE ts::DATE = DATE '2024-01-05') WHERE k = 1""")
def day_subset_dedupe(spark, d):
    rows = flags.of_day(events(spark, d), F.lit(date(2024, 1, 5)), "ts").withColumn("slot", F.date_trunc("hour", "ts"))
    return flags.first_of_time(rows, ["event_type"], "slot", "event_id").select("event_type", F.date_format("slot", "yyyy-MM-dd HH:mm:ss").alias("slot"), "event_id", "value")


@query("""
SELECT key, o_orderkey, priority FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY priority, o_orderkey) AS k FROM (
    SELECT lpad((o_custkey % 1000)::VARCHAR, 3, '0') || '_' || lpad((o_orderkey % 7)::VARCHAR, 3, '0') AS key, o_orderkey, left(o_orderpriority, 1)::INT AS priority FROM orders)) WHERE k = 1""")
def priority_pick(spark, d):
    title = F.concat(F.lit("G_"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit("_"), F.lpad((F.col("o_orderkey") % 7).cast("string"), 3, "0"), F.lit("_x"))
    rows = table(spark, d, "orders").select("o_orderkey", S.cycle_pass(title).alias("key"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("priority"))
    return flags.priority_pick(rows, "key", "priority", "o_orderkey").select("key", "o_orderkey", "priority")


@query("SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"((l_partkey >> {k}) & 1) = 1 AS b{k}" for k in range(10)) + " FROM lineitem")
def bitflag_split(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.bits(F.col("l_partkey")).alias("b"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", *[F.col("b")[k].alias(f"b{k}") for k in range(10)])


def _width_sql(name: str) -> str:
    """max(f) -> ceil(log2(max)), without a logarithm."""
    return f"{name} AS (SELECT coalesce(min(k), 0) AS n FROM (SELECT unnest(range(0, 40)) AS k) WHERE (1::BIGINT << k) >= (SELECT max(f) FROM e))"


@query(f"""
WITH raw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
e AS (SELECT l_orderkey, l_linenumber, l_partkey * l_linenumber * 13 % 90001 AS f FROM raw), {_width_sql("w")}
SELECT l_orderkey, l_linenumber, f, array_to_string([CASE WHEN (f >> k) & 1 = 1 THEN '1' ELSE '0' END FOR k IN range(0, (SELECT n FROM w))], '') AS split
FROM e""")
def bitflag_by_data(spark, d):
    """As many bits as the greatest flag of all rows asks for."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") * F.col("l_linenumber") * 13 % 90001).alias("f"))
    text = F.array_join(F.transform("bits", lambda b: F.when(b, F.lit("1")).otherwise(F.lit("0"))), "")
    return S.split_flags(rows, "f").select("l_orderkey", "l_linenumber", "f", text.alias("split"))


MERGED_SQL = """m AS (
  SELECT l_suppkey, l_orderkey % 3000 AS cycle, l_partkey % 1024 AS flag, l_linenumber % 4 AS surface_type, (l_quantity - 25) / 15 AS ssha,
         l_extendedprice / 105000 * 180 - 90 AS latitude, l_partkey % 1100 AS basin_flag, l_discount > 0.09 AS median_flag FROM lineitem)"""


def merged_rows(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        "l_suppkey", (c("l_orderkey") % 3000).alias("cycle"), (c("l_partkey") % 1024).alias("flag"), (c("l_linenumber") % 4).alias("surface_type"), ((c("l_quantity") - 25) / 15).alias("ssha"),
        (c("l_extendedprice") / 105000 * 180 - 90).alias("latitude"), (c("l_partkey") % 1100).alias("basin_flag"), (c("l_discount") > 0.09).alias("median_flag"),
    )


@query(f"""
WITH {MERGED_SQL}, h AS (
  SELECT *, (basin_flag > 0 AND basin_flag < 1000 AND abs(latitude) > 60 AND abs(ssha) > 1.2) AS high, max(CASE WHEN cycle = 583 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey) AS lenient FROM m)
SELECT l_suppkey, sum(CASE WHEN surface_type IN (0, 2) AND (flag & (CASE WHEN lenient = 1 THEN 574 ELSE 575 END)) = 0 AND NOT high THEN 1 ELSE 0 END)::BIGINT AS n_prelim,
       sum(CASE WHEN surface_type IN (0, 2) AND (flag & 46) = 0 AND NOT median_flag AND NOT high THEN 0 ELSE 1 END)::BIGINT AS n_bad FROM h GROUP BY l_suppkey""")
def flag_merged(spark, d):
    rows = merged_rows(spark, d)
    rows = rows.withColumn("prelim", flags.merged_prelim(rows, ["l_suppkey"])).withColumn("bad", flags.merged_bad())
    return rows.groupBy("l_suppkey").agg(F.sum(F.col("prelim").cast("long")).alias("n_prelim"), F.sum(F.col("bad").cast("long")).alias("n_bad"))


WAVE_SQL = """(swh > 14 OR (s0 > 11 AND swh > 10) OR (s0 >= 11 AND s0 < 16 AND swh > (s0 - 11) * (-4.0 / 5.0) + 10)
 OR (s0 >= 16 AND s0 < 26 AND swh > (s0 - 16) * (-3.0 / 10.0) + 6) OR (s0 >= 16 AND swh > (s0 - 26) * (-3.0 / 6.0) + 3))"""
REDUCED_SQL = """r AS (
  SELECT l_suppkey, l_linenumber % 4 AS surface_class, l_partkey % 3 AS range_qual, l_orderkey % 6 AS rain_flag, l_partkey % 2 AS radiometer_qual, (l_quantity - 25) / 15 AS ssha,
         l_extendedprice / 105000 * 180 - 90 AS latitude, l_partkey % 1100 AS basin_flag, l_discount > 0.09 AS median_flag, l_quantity * 0.7 AS s0, l_tax * 150 AS swh FROM lineitem)"""


@query(f"""
WITH {REDUCED_SQL}, h AS (
  SELECT *, (basin_flag > 0 AND basin_flag < 1000) AS sea, (basin_flag > 0 AND basin_flag < 1000 AND abs(latitude) > 60 AND abs(ssha) > 1.2) AS high FROM r)
SELECT l_suppkey, sum(CASE WHEN surface_class IN (0, 2) AND range_qual = 0 AND rain_flag IN (0, 3, 5) AND abs(ssha) < 5 AND sea AND NOT high AND NOT {WAVE_SQL} THEN 1 ELSE 0 END)::BIGINT AS n_prelim,
       sum(CASE WHEN surface_class IN (0, 2) AND range_qual = 0 AND rain_flag IN (0, 3, 5) AND radiometer_qual = 0 AND NOT median_flag AND NOT high THEN 0 ELSE 1 END)::BIGINT AS n_bad,
       sum(range_qual + 10 * surface_class + 100 * radiometer_qual + 1000 * rain_flag)::BIGINT AS flag_sum
FROM h GROUP BY l_suppkey""")
def flag_reduced(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem").select(
        "l_suppkey", (c("l_linenumber") % 4).alias("surface_class"), (c("l_partkey") % 3).alias("range_qual"), (c("l_orderkey") % 6).alias("rain_flag"), (c("l_partkey") % 2).alias("radiometer_qual"),
        ((c("l_quantity") - 25) / 15).alias("ssha"), (c("l_extendedprice") / 105000 * 180 - 90).alias("latitude"), (c("l_partkey") % 1100).alias("basin_flag"), (c("l_discount") > 0.09).alias("median_flag"),
        (c("l_quantity") * 0.7).alias("sigma0"), (c("l_tax") * 150).alias("swh"),
    )
    rows = rows.withColumn("prelim", flags.reduced_prelim()).withColumn("bad", flags.reduced_bad()).withColumn("f", flags.source_flags())
    f = c("f")
    return rows.groupBy("l_suppkey").agg(F.sum(c("prelim").cast("long")).alias("n_prelim"), F.sum(c("bad").cast("long")).alias("n_bad"), F.sum(f[0].cast("long") + f[1] * 10 + f[2] * 100 + f[3].cast("long") * 1000).alias("flag_sum"))


@query(f"SELECT l_linenumber, count(*) AS n, sum(CASE WHEN {WAVE_SQL} THEN 1 ELSE 0 END)::BIGINT AS rejected FROM (SELECT l_linenumber, l_quantity * 0.7 AS s0, l_discount * 160 AS swh FROM lineitem) GROUP BY l_linenumber")
def wave_height_reject(spark, d):
    rows = table(spark, d, "lineitem").withColumn("bad", flags.wave_reject(F.col("l_quantity") * 0.7, F.col("l_discount") * 160))
    return rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("rejected"))


@query("""
SELECT l_suppkey, count(*) AS n FROM lineitem
WHERE (l_shipdate::DATE = DATE '1995-06-07' AND l_extendedprice / 1000 BETWEEN 20 AND 25 AND (l_quantity - 25) / 10 < -1)
   OR (l_shipdate::DATE = DATE '2001-06-26' AND l_extendedprice / 1000 BETWEEN 15 AND 45 AND (l_quantity - 25) / 10 < -1) GROUP BY l_suppkey""")
def manual_outliers(spark, d):
    rules = [(date(1995, 6, 7), 20.0, 25.0, -1.0), (date(2001, 6, 26), 15.0, 45.0, -1.0)]
    hit = flags.manual_outliers(F.to_date("l_shipdate"), F.col("l_extendedprice") / 1000, (F.col("l_quantity") - 25) / 10, F.lit(True), rules)
    return table(spark, d, "lineitem").where(hit).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, n_name, CASE WHEN s_suppkey % 200 IN (0, 1003, 190) THEN 1 ELSE n_regionkey % 2 END AS quality_flag FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def basin_override(spark, d):
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", "n_name", flags.basin_override(F.col("n_regionkey") % 2, F.col("s_suppkey") % 200).alias("quality_flag"))


@query("SELECT c_custkey, round((c_acctbal + 180) - 360 * floor((c_acctbal + 180) / 360) - 180, 6) AS lon FROM customer")
def lon_wrap(spark, d):
    return table(spark, d, "customer").select("c_custkey", r6(S.wrapped_longitude(F.col("c_acctbal"))).alias("lon"))


@query("SELECT o_orderkey, round(coalesce(CASE WHEN o_custkey % 4 > 0 THEN o_totalprice END / 1000, 0) - o_totalprice / 900, 6) AS dac, round(o_totalprice / 900 + 2 - 3 + o_custkey / 7, 6) AS swapped FROM orders")
def dac_and_mss_swap(spark, d):
    ssha = F.col("o_totalprice") / 900
    noib = F.when(F.col("o_custkey") % 4 > 0, F.col("o_totalprice"))
    return table(spark, d, "orders").select("o_orderkey", r6(flags.atmospheric_correction(ssha, noib)).alias("dac"), r6(flags.mss_swap(ssha, F.col("o_custkey") / 7, F.lit(2), F.lit(3))).alias("swapped"))


@query("""
SELECT o_orderkey, CASE WHEN d < DATE '2024-01-21' THEN 'merged' ELSE 'reduced' END AS source,
       CASE WHEN d < DATE '1992-01-01' THEN NULL WHEN d < DATE '2002-05-14' THEN 'TOPEX/Poseidon' WHEN d < DATE '2008-07-12' THEN 'Jason-1' WHEN d < DATE '2016-03-18' THEN 'Jason-2'
            WHEN d < DATE '2022-04-07' THEN 'Jason-3' ELSE 'Sentinel-6 Michael Freilich' END AS mission
FROM (SELECT o_orderkey, (o_orderdate + INTERVAL 1 DAY * (o_custkey % 40) * 300)::DATE AS d FROM orders)""")
def mission_lookup(spark, d):
    day = F.date_add(F.to_date("o_orderdate"), ((F.col("o_custkey") % 40) * 300).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", planner.source_of(day).alias("source"), planner.mission(day).alias("mission"))


@query("""
SELECT o_orderkey, round(year(o_orderdate) + dayofyear(o_orderdate)::DOUBLE / dayofyear(make_date(year(o_orderdate), 12, 31)), 9) AS by_day,
       round(year(o_orderdate) + (epoch(o_orderdate) - epoch(make_date(year(o_orderdate), 1, 1)::TIMESTAMP)) / (epoch(make_date(year(o_orderdate) + 1, 1, 1)::TIMESTAMP) - epoch(make_date(year(o_orderdate), 1, 1)::TIMESTAMP)), 9) AS by_seconds
FROM orders""")
def decimal_years(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.round(S.decimal_year_by_day(F.to_date("o_orderdate")), 9).alias("by_day"), F.round(S.decimal_year_by_seconds(F.col("o_orderdate")), 9).alias("by_seconds"))


# --- windows ------------------------------------------------------------------------------------------------------------


@query("SELECT event_id, round(median(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING), 6) AS med FROM events")
def rolling_median_15(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "ts", "value")
    return rolling.rolling_median(rows, "med", F.col("value"), ["event_type"], ["ts", "event_id"], 7, spread=True).select("event_id", r6("med").alias("med"))


@query("SELECT event_id, round(greatest(sqrt(median((value - 50) * (value - 50)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 47 PRECEDING AND 47 FOLLOWING)), 30), 6) AS spread FROM events")
def rolling_std_95(spark, d):
    x = F.col("value") - 50
    rows = events(spark, d).select("event_id", "event_type", "ts", "value")
    return rolling.rolling_median(rows, "sq", x * x, ["event_type"], ["ts", "event_id"], 47, spread=True).select("event_id", r6(F.greatest(F.sqrt("sq"), F.lit(30.0))).alias("spread"))


def _fill_sql(source: str, name: str, value: str, out: str, keys: str = "event_type", order: str = "n") -> str:
    w = f"PARTITION BY {keys} ORDER BY {order}"
    return f"""{out} AS (
  SELECT * EXCLUDE (a_at, a_v, b_at, b_v), CASE WHEN a_at IS NULL THEN b_v WHEN b_at IS NULL THEN a_v WHEN a_at = b_at THEN a_v ELSE a_v + (b_v - a_v) * (n - a_at) / (b_at - a_at) END AS {name} FROM (
    SELECT *, last_value(CASE WHEN {value} IS NOT NULL THEN n END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a_at,
           last_value({value} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a_v,
           first_value(CASE WHEN {value} IS NOT NULL THEN n END IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b_at,
           first_value({value} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b_v
    FROM {source}))"""


@query(f"""
WITH e AS (SELECT event_id, event_type, value, event_id % 5 <> 0 AS ok, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id))::DOUBLE AS n FROM events),
m AS (SELECT *, CASE WHEN ok THEN median(value) OVER (PARTITION BY event_type, ok ORDER BY n ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) END AS med FROM e),
u AS (SELECT *, ok AND coalesce(abs(value - med) < 150, false) AS used FROM m),
s AS (SELECT *, CASE WHEN used THEN greatest(sqrt(median((value - med) * (value - med)) OVER (PARTITION BY event_type, used ORDER BY n ROWS BETWEEN 47 PRECEDING AND 47 FOLLOWING)), 0.05) END AS std FROM u),
{_fill_sql("s", "median", "med", "f")},
{_fill_sql("f", "spread", "std", "g")}
SELECT event_id, round(median, 6) AS median, round(spread, 6) AS spread, NOT coalesce(abs(value - median) <= 3 * spread, false) AS median_flag FROM g""")
def median_outlier_flag(spark, d):
    rows = events(spark, d).withColumn("ok", F.col("event_id") % 5 != 0)
    out = rolling.median_outliers(rows, "value", "ok", ["event_type"], ["ts", "event_id"], 0.05, factor=3.0, trim=150.0, spread=True)
    return out.select("event_id", r6("median").alias("median"), r6("spread").alias("spread"), "median_flag")


@query(f"""
WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 6 < 2 THEN value END AS v, epoch(ts) AS n FROM events), {_fill_sql("e", "filled", "v", "f", order="n, event_id")}
SELECT event_id, round(filled, 5) AS filled FROM f""")
def interp_linear(spark, d):
    rows = events(spark, d).withColumn("v", F.when(F.col("event_id") % 6 < 2, F.col("value"))).withColumn("n", F.unix_micros("ts") / 1e6)
    return rolling.interpolated(rows, "filled", "v", "n", ["event_type"], ["n", "event_id"], spread=True).select("event_id", F.round("filled", 5).alias("filled"))


@query("""
WITH e AS (SELECT event_id, ts, CASE WHEN event_id % 7 < 3 THEN value END AS v, row_number() OVER (ORDER BY ts, event_id) AS n FROM events),
m AS (SELECT *, median(v) OVER (ORDER BY n ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS med,
  last_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) OVER (ORDER BY n) AS n0, first_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n1,
  last_value(v IGNORE NULLS) OVER (ORDER BY n) AS v0, first_value(v IGNORE NULLS) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1 FROM e)
SELECT event_id, n::BIGINT AS number, round(med, 6) AS med, round(CASE WHEN n0 = n1 THEN v0 WHEN n0 IS NULL THEN v1 WHEN n1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (n - n0) / (n1 - n0) END, 5) AS filled FROM m""")
def whole_series(spark, d):
    """Number, rolling median and fill of all events as one series of a single key."""
    rows = events(spark, d).select("event_id", "ts", F.lit(1).alias("k"), F.when(F.col("event_id") % 7 < 3, F.col("value")).alias("v"))
    order = ["ts", "event_id"]
    series = segments.numbered(segments.cut(rows, ["k"], order), "number", ["k"], order).withColumn("number", F.col("number") + 1)
    out = rolling.interpolated(rolling.rolling_median(series, "med", F.col("v"), ["k"], order, 7, spread=True), "filled", "v", "number", ["k"], order, spread=True)
    return out.select("event_id", "number", r6("med").alias("med"), F.round("filled", 5).alias("filled"))


def _smooth_sql() -> str:
    w = "OVER (PARTITION BY event_type ORDER BY slot)"
    ws = smoothing.weights()
    lags = ", ".join(f"{'lag' if k < 0 else 'lead'}({c}, {abs(k)}) {w} AS {c}_{'b' if k < 0 else 'f'}{abs(k)}" for k in [*range(-9, 0), *range(1, 10)] for c in ("v", "lo", "hi"))
    ok = lambda s: f"coalesce(lo{s} >= i - 9 AND hi{s} <= i + 9, false)"
    both = {k: f"({ok(f'_b{k}')} AND {ok(f'_f{k}')})" for k in range(1, 10)}
    num = " + ".join([f"(CASE WHEN {ok('')} THEN {ws[0]!r} * v ELSE 0 END)", *(f"(CASE WHEN {both[k]} THEN {ws[k]!r} * (v_b{k} + v_f{k}) ELSE 0 END)" for k in range(1, 10))])
    den = " + ".join([f"(CASE WHEN {ok('')} THEN {ws[0]!r} ELSE 0 END)", *(f"(CASE WHEN {both[k]} THEN {2 * ws[k]!r} ELSE 0 END)" for k in range(1, 10))])
    fill = lambda f, x, span: f"{f}({x} IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY slot ROWS BETWEEN {span})"
    past, future = "UNBOUNDED PRECEDING AND CURRENT ROW", "CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS slot, avg(CASE WHEN event_id % 5 < 3 THEN value END) AS x FROM events GROUP BY ALL),
sp AS (SELECT event_type, unnest(generate_series(day::TIMESTAMP, day::TIMESTAMP + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS slot FROM (SELECT DISTINCT event_type, slot::DATE AS day FROM h)),
j AS (SELECT sp.event_type, sp.slot, h.x, (row_number() OVER (PARTITION BY sp.event_type ORDER BY sp.slot))::DOUBLE AS i FROM sp LEFT JOIN h ON h.event_type = sp.event_type AND h.slot = sp.slot),
p AS (SELECT *, {fill("last_value", "CASE WHEN x IS NOT NULL THEN i END", past)} AS lo, {fill("last_value", "x", past)} AS lov,
      {fill("first_value", "CASE WHEN x IS NOT NULL THEN i END", future)} AS hi, {fill("first_value", "x", future)} AS hiv FROM j),
q AS (SELECT event_type, slot, i, lo, hi, CASE WHEN x IS NOT NULL THEN x ELSE lov + (hiv - lov) * (i - lo) / nullif(hi - lo, 0) END AS v FROM p),
l AS (SELECT *, {lags} FROM q)
SELECT event_type, strftime(slot, '%Y-%m-%d %H') AS slot, round(CASE WHEN {" OR ".join(both.values())} THEN ({num}) / ({den}) END, 6) AS smoothed FROM l"""


@query(_smooth_sql())
def gap_smooth_19(spark, d):
    known = F.when(F.col("event_id") % 5 < 3, F.col("value"))  # the others are the gaps
    rows = events(spark, d).groupBy("event_type", F.date_trunc("hour", "ts").alias("slot")).agg(F.avg(known).alias("x"))
    spine = smoothing.on_spine(rows, ["event_type"], "slot", F.to_date("slot"), "1 hour")
    out = smoothing.smoothed(spine, "x", ["event_type"], ["spine_time"])
    return out.select("event_type", F.date_format("spine_time", "yyyy-MM-dd HH").alias("slot"), r6("smoothed").alias("smoothed"))


@query("""
SELECT o_orderpriority, strftime(day, '%Y-%m-%d') AS day, round(avg(total) OVER (PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL '2427840 seconds' PRECEDING AND INTERVAL '2427840 seconds' FOLLOWING) / 99991, 6) AS smoothed
FROM (SELECT o_orderpriority, o_orderdate AS day, sum(o_totalprice) AS total FROM orders GROUP BY ALL)""")
def running_mean_28d(spark, d):
    rows = table(spark, d, "orders").groupBy("o_orderpriority", F.col("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("total"))
    return rows.select("o_orderpriority", F.date_format("day", "yyyy-MM-dd").alias("day"), r6(rolling.running_mean(F.col("total"), F.col("day"), ["o_orderpriority"]) / 99991).alias("smoothed"))


@query("""
SELECT event_id, round(gap, 6) AS gap, CASE WHEN gap > 0.75 AND gap < 1.2 THEN 1 WHEN gap >= 1.2 THEN 2 ELSE 0 END AS n_constraints,
       round(CASE WHEN gap > 0.75 AND gap < 1.2 THEN h + gap / 2 WHEN gap >= 1.2 THEN h - 0.5 END, 4) AS first_constraint
FROM (SELECT event_id, h, lead(h) OVER (PARTITION BY event_type ORDER BY h) - h AS gap FROM (SELECT event_id, event_type, (epoch(ts) - 1704067200) / 3600 AS h FROM events))""")
def gap_detect(spark, d):
    rows = events(spark, d).withColumn("h", (F.unix_micros("ts") / 1e6 - 1704067200) / 3600)
    out = rolling.gaps(rows, "h", ["event_type"])
    return out.select("event_id", r6("gap").alias("gap"), F.size("constraints").alias("n_constraints"), F.round(F.get("constraints", F.lit(0)), 4).alias("first_constraint"))


@query("""
SELECT event_id, coalesce(abs(lead(sign(value - 50)) OVER (PARTITION BY user_id ORDER BY ts, event_id) - sign(value - 50)) = 2, false) AS changes FROM events""")
def sign_change(spark, d):
    return events(spark, d).select("event_id", rolling.sign_changes(F.col("value") - 50, ["user_id"], ["ts", "event_id"]).alias("changes"))


@query("""
SELECT event_id, pass, CASE WHEN dropped = 1 AND pass = 1 THEN cycle + 1 ELSE cycle END AS cycle FROM (
  SELECT *, max(CASE WHEN before > pass THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dropped FROM (
    SELECT event_id, event_type, ts, user_id % 9 + 1 AS pass, 5::BIGINT AS cycle, lag(user_id % 9 + 1) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM events))""")
def cycle_rollover(spark, d):
    rows = events(spark, d).select("event_id", "event_type", "ts", (F.col("user_id") % 9 + 1).alias("pass"), F.lit(5).cast("long").alias("cycle"))
    return rolling.cycle_rollover(rows, ["event_type"], ["ts", "event_id"]).select("event_id", "pass", "cycle")


@query("""
SELECT strftime(out_day, '%Y-%m-%d') AS out_day, count(*) AS n, round(sum(value), 4) AS total FROM (
  SELECT value, unnest(generate_series(ts::DATE - INTERVAL 4 DAY, ts::DATE + INTERVAL 5 DAY, INTERVAL 1 DAY)) AS out_day FROM events) GROUP BY out_day""")
def day_window_explode(spark, d):
    rows = setops.window_days(events(spark, d).withColumn("day", F.to_date("ts")), "day", 5, 4, "out_day")
    return rows.groupBy(F.date_format("out_day", "yyyy-MM-dd").alias("out_day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


# --- crossovers and passes ----------------------------------------------------------------------------------------------


@query("""
WITH j AS (SELECT o_custkey, l_suppkey, o_orderkey, l_linenumber, l_discount - l_tax AS diff FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT track, round(sum(d), 6) AS total, count(*) AS n FROM (SELECT o_custkey AS track, diff AS d FROM j UNION ALL SELECT 100000 + l_suppkey, -diff FROM j) GROUP BY track""")
def self_crossover_stack(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = crossover.stacked(j, [], (F.col("o_custkey"), F.col("o_orderkey")), (F.col("l_suppkey") + 100000, F.col("o_orderkey")), F.col("l_discount") - F.col("l_tax"))
    return out.groupBy("track").agg(r6(F.sum("d")).alias("total"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT user_id, n, round(mean, 6) AS mean, round(std, 6) AS std FROM (
  SELECT user_id, count(value) AS n, avg((value - 50) / 99.7::DOUBLE) AS mean, stddev_samp((value - 50) / 99.7::DOUBLE) AS std FROM events GROUP BY user_id)
WHERE (n > 15 AND abs(mean) > 0.1) OR (n > 25 AND std > 0.27)""")
def bad_pass_stats(spark, d):
    stats = passes.pass_stats(events(spark, d).withColumn("d", (F.col("value") - 50) / 99.7), ["user_id"])
    return passes.bad(stats).select("user_id", "n", r6("mean").alias("mean"), r6("std").alias("std"))


@query("""
WITH e AS (SELECT event_type AS source, user_id % 12 AS track, epoch(ts) AS t, (value - 50) / 99.7::DOUBLE AS d FROM events),
days AS (SELECT DISTINCT event_type AS source, ts::DATE AS date FROM events),
w AS (SELECT days.source, days.date, e.track, e.t, e.d, epoch(days.date::TIMESTAMP) AS b FROM days JOIN e ON e.source = days.source AND floor(e.t / 86400) * 86400 BETWEEN epoch(days.date::TIMESTAMP) - 11 * 86400 AND epoch(days.date::TIMESTAMP) + 86400),
s AS (SELECT source, date, track, count(d) AS n, avg(d) AS mean, stddev_samp(d) AS std, max(CASE WHEN t BETWEEN b - 3600 AND b + 90000 THEN 1 ELSE 0 END) AS touches FROM w GROUP BY source, date, track)
SELECT source, strftime(date, '%Y-%m-%d') AS date, track, n, round(mean, 6) AS mean, round(std, 6) AS std FROM s
WHERE touches = 1 AND ((n > 15 AND abs(mean) > 0.1) OR (n > 25 AND std > 0.27))""")
def bad_passes_by_day(spark, d):
    e = events(spark, d)
    rows = e.select(F.col("event_type").alias("source"), (F.col("user_id") % 12).alias("track"), (F.unix_micros("ts") / 1e6).alias("time"), ((F.col("value") - 50) / 99.7).alias("d"))
    days = e.select(F.col("event_type").alias("source"), F.to_date("ts").alias("date")).distinct()
    return passes.bad_passes_of_days(rows, days).select("source", F.date_format("date", "yyyy-MM-dd").alias("date"), "track", "n", r6("mean").alias("mean"), r6("std").alias("std"))


def _daily(spark, d):
    e = events(spark, d).select("event_id", F.col("event_type").alias("source"), F.to_date("ts").alias("date"), (F.floor(F.col("user_id") / 10) % 15).cast("int").alias("cycle"), (F.col("user_id") % 10).cast("int").alias("pass"), (F.col("event_id") % 11 == 0).cast("int").alias("quality_flag"), F.col("value").alias("ssha_smoothed"))
    return e, e.where("ssha_smoothed > 170").select("source", "date", "cycle", "pass")


DAILY_SQL = """e AS (SELECT event_id, event_type AS source, ts::DATE AS date, (user_id // 10) % 15 AS cycle, user_id % 10 AS pass, CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS quality_flag, value FROM events),
l AS (SELECT DISTINCT source, date, cycle, pass FROM e WHERE value > 170)"""


@query(f"""
WITH {DAILY_SQL}, f AS (SELECT event_id, value, CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.source = e.source AND l.date = e.date AND l.cycle = e.cycle AND l.pass = e.pass) THEN 1 ELSE quality_flag END AS quality_flag FROM e)
SELECT event_id, quality_flag, CASE WHEN quality_flag = 1 THEN NULL ELSE value END AS ssha_smoothed FROM f""")
def bad_pass_apply_pair(spark, d):
    daily, listed = _daily(spark, d)
    return passes.applied(daily, listed, "pair").select("event_id", "quality_flag", "ssha_smoothed")


@query(f"""
WITH {DAILY_SQL}, f AS (SELECT event_id, value, CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.source = e.source AND l.date = e.date AND l.cycle = e.cycle)
   AND EXISTS (SELECT 1 FROM l WHERE l.source = e.source AND l.date = e.date AND l.pass = e.pass) THEN 1 ELSE quality_flag END AS quality_flag FROM e)
SELECT event_id, quality_flag, CASE WHEN quality_flag = 1 THEN NULL ELSE value END AS ssha_smoothed FROM f""")
def bad_pass_apply_cross(spark, d):
    daily, listed = _daily(spark, d)
    return passes.applied(daily, listed, "cross").select("event_id", "quality_flag", "ssha_smoothed")


@query(f"""WITH {DAILY_SQL} SELECT source, strftime(date, '%Y-%m-%d') AS date, string_agg(cycle || '/' || pass, ', ' ORDER BY cycle, pass) AS passes FROM l GROUP BY source, date""")
def flagged_pass_list(spark, d):
    _, listed = _daily(spark, d)
    return passes.flagged_list(listed.distinct(), ["source", "date"]).select("source", F.date_format("date", "yyyy-MM-dd").alias("date"), "passes")


LIST_SQL = """o AS (SELECT o_orderpriority AS source, o_orderdate::DATE AS date, o_custkey % 50 AS cycle, o_orderkey % 250 AS pass, o_orderstatus AS status, o_totalprice AS price FROM orders)"""


def _listed(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("source"), F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 50).alias("cycle"), (F.col("o_orderkey") % 250).alias("pass"))


@query(f"""
WITH {LIST_SQL} SELECT DISTINCT source, strftime(date, '%Y-%m-%d') AS date, cycle::INT AS cycle, pass::INT AS pass FROM (
  SELECT * FROM o WHERE status = 'F' AND NOT EXISTS (SELECT 1 FROM o g WHERE g.status = 'O' AND g.price > 400000 AND g.source = o.source AND g.date = o.date)
  UNION ALL SELECT * FROM o WHERE status = 'P')""")
def bad_pass_list_update(spark, d):
    o = _listed(spark, d)
    out = passes.updated_list(o.where("status = 'F'"), o.where("status = 'O' AND price > 400000"), o.where("status = 'P'"))
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(f"""
WITH {LIST_SQL}, a AS (SELECT source, cycle FROM o WHERE status <> 'P'), b AS (SELECT source, cycle FROM o WHERE status <> 'F')
SELECT source, cycle, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT source, cycle, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def relation_diff(spark, d):
    o = _listed(spark, d)
    return setops.difference(o.where("status <> 'P'").select("source", "cycle"), o.where("status <> 'F'").select("source", "cycle"))


@query(f"""
WITH {LIST_SQL}, a AS (SELECT source, cycle, status FROM o WHERE status <> 'P' OR source <> 'x'), b AS (SELECT source, cycle, CASE WHEN cycle % 97 = 0 THEN 'F' ELSE status END AS status FROM o),
d AS ((SELECT * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))),
s AS (SELECT DISTINCT cycle FROM (SELECT cycle FROM a UNION ALL SELECT cycle FROM b))
SELECT s.cycle, NOT EXISTS (SELECT 1 FROM d WHERE d.cycle = s.cycle) AS same FROM s""")
def relation_same_by(spark, d):
    """Whether two lists have the same rows of each cycle, by fingerprints."""
    o = _listed(spark, d)
    a = o.where("status <> 'P' OR source <> 'x'").select("source", "cycle", "status")
    b = o.select("source", "cycle", F.when(F.col("cycle") % 97 == 0, F.lit("F")).otherwise(F.col("status")).alias("status"))
    return setops.same_by(a, b.repartition(3), ["cycle"])


TRACKS_SQL = "t AS (SELECT user_id AS track, min(epoch(ts) - 1704067200) AS start FROM events GROUP BY user_id)"
PAIR_SQL = "(t2.start - t1.start) > 0 AND (t2.start - t1.start) <= 600 AND abs(t1.track - t2.track) > 1 AND t1.track % 2 <> t2.track % 2"


def _points(spark, d):
    return events(spark, d).select(F.col("user_id").alias("track"), (F.unix_micros("ts") / 1e6 - 1704067200).alias("t"), "value")


@query(f"WITH {TRACKS_SQL} SELECT t1.track AS track1, t2.track AS track2, round(t1.start, 3) AS start1, round(t2.start, 3) AS start2 FROM t t1 JOIN t t2 ON {PAIR_SQL}")
def crossover_candidates(spark, d):
    out = crossover.candidates(crossover.track_starts(_points(spark, d), "track", "t"), 600.0)
    return out.select("track1", "track2", F.round("start1", 3).alias("start1"), F.round("start2", 3).alias("start2"))


@query(f"""
WITH {TRACKS_SQL}, p AS (SELECT t1.track AS track1, t2.track AS track2 FROM t t1 JOIN t t2 ON {PAIR_SQL}),
pt AS (SELECT user_id AS track, (epoch(ts) - 1704067200) / 3600 AS x, value AS y FROM events),
s AS (SELECT * FROM (SELECT track, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM pt WINDOW w AS (PARTITION BY track ORDER BY x)) WHERE x2 IS NOT NULL),
c AS (SELECT track1, track2, a.x1 AS ax1, a.y1 AS ay1, a.x2 - a.x1 AS rx, a.y2 - a.y1 AS ry, b.x2 - b.x1 AS qx, b.y2 - b.y1 AS qy, b.x1 - a.x1 AS dx, b.y1 - a.y1 AS dy
      FROM p JOIN s a ON a.track = track1 JOIN s b ON b.track = track2 AND b.x1 <= a.x2 AND b.x2 >= a.x1),
u AS (SELECT *, (dx * qy - dy * qx) / nullif(rx * qy - ry * qx, 0) AS s, (dx * ry - dy * rx) / nullif(rx * qy - ry * qx, 0) AS u FROM c)
SELECT track1, track2, round(ax1 + rx * s, 4) AS x, round(ay1 + ry * s, 4) AS y FROM u WHERE s >= 0 AND s < 1 AND u >= 0 AND u < 1""")
def crossover_points(spark, d):
    pts = _points(spark, d)
    lines = crossover.segments(pts.withColumn("x", F.col("t") / 3600), ["track"], "x", "value", "x", "value").drop("t1", "t2", "v1", "v2")
    return crossover.line_crossings(lines, crossover.track_starts(pts, "track", "t"), 600.0, cell=12.0).select("track1", "track2", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


KM_SQL = "111.0 * sqrt((({b} - {a}) * cos(({c} + {d}) / 2 * (pi() / 180))) * (({b} - {a}) * cos(({c} + {d}) / 2 * (pi() / 180))) + ({d} - {c}) * ({d} - {c}))"


def _km(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return "(" + KM_SQL.format(a=lon1, b=lon2, c=lat1, d=lat2) + ")"


def _near_sql() -> str:
    ends = [("ax1", "ay1"), ("ax1 + rx", "ay1 + ry"), ("bx1", "by1"), ("bx1 + qx", "by1 + qy")]
    return " AND ".join(f"{_km('x', 'y', f'({lon})', f'({lat})')} < 30" for lon, lat in ends)


@query(f"""
WITH pt AS (SELECT 10001 + event_id // 125 AS track, (event_id // 125) * 1550.0 + (event_id % 125) * 10.0 AS t, CASE WHEN event_id % 37 <> 5 THEN value / 100 END AS v,
              (event_id // 125) * 47.3::DOUBLE % 120 - 60 + (event_id % 125) * 0.16::DOUBLE AS l, CASE WHEN (event_id // 125) % 2 = 0 THEN 1 ELSE -1 END * ((event_id % 125) * 0.16::DOUBLE - 10) AS lat FROM events),
p AS (SELECT track, t, v, l - 360 * floor(l / 360) AS lon, lat FROM pt WHERE v IS NOT NULL),
tr AS (SELECT track, min(t) AS start FROM p GROUP BY track),
pairs AS (SELECT a.track AS track1, b.track AS track2 FROM tr a JOIN tr b ON (a.track + b.track) % 2 = 1 AND abs(a.track - b.track) > 1 AND b.start > a.start AND b.start - a.start <= 9.9156 * 86400),
ld AS (SELECT track, lon AS x1, lat AS y1, t AS t1, v AS v1, lead(lon) OVER w AS x, lead(lat) OVER w AS y2, lead(t) OVER w AS t2, lead(v) OVER w AS v2 FROM p WINDOW w AS (PARTITION BY track ORDER BY t)),
un AS (SELECT * EXCLUDE (x), CASE WHEN x - x1 > 180 THEN x - 360 WHEN x - x1 < -180 THEN x + 360 ELSE x END AS x2 FROM ld WHERE t2 IS NOT NULL),
sh AS (SELECT *, unnest(CASE WHEN least(x1, x2) < 0 THEN [0, 360] WHEN greatest(x1, x2) > 360 THEN [0, -360] ELSE [0] END) AS k FROM un),
sg AS (SELECT track, x1 + k AS x1, y1, t1, v1, x2 + k AS x2, y2, t2, v2 FROM sh WHERE {_km("x1", "y1", "x2", "y2")} < 60),
cl AS (SELECT *, unnest(range(floor(least(x1, x2) / 2)::INT, floor(greatest(x1, x2) / 2)::INT + 1)) AS cell FROM sg),
dl AS (SELECT *, unnest(range(floor(least(y1, y2) / 2)::INT, floor(greatest(y1, y2) / 2)::INT + 1)) AS belt FROM cl),
c AS (SELECT track1, track2, a.x1 AS ax1, a.y1 AS ay1, a.x2 - a.x1 AS rx, a.y2 - a.y1 AS ry, b.x1 AS bx1, b.y1 AS by1, b.x2 - b.x1 AS qx, b.y2 - b.y1 AS qy, b.x1 - a.x1 AS dx, b.y1 - a.y1 AS dy,
             a.t1 AS at1, a.t2 - a.t1 AS adt, a.v1 AS av1, a.v2 - a.v1 AS adv, b.v1 AS bv1, b.v2 - b.v1 AS bdv
      FROM pairs JOIN dl a ON a.track = track1 JOIN dl b ON b.track = track2 AND b.cell = a.cell AND b.belt = a.belt),
u AS (SELECT *, (dx * qy - dy * qx) / nullif(rx * qy - ry * qx, 0) AS s, (dx * ry - dy * rx) / nullif(rx * qy - ry * qx, 0) AS u FROM c),
m AS (SELECT *, ax1 + rx * s AS x, ay1 + ry * s AS y FROM u WHERE s >= 0 AND s < 1 AND u >= 0 AND u < 1)
SELECT any_value(round(x - 360 * floor(x / 360), 4)) AS lon, any_value(round(y, 4)) AS lat, any_value(round(av1 + adv * s, 4)) AS ssh1, any_value(round(bv1 + bdv * u, 4)) AS ssh2,
       (track1 % 10000)::INT AS pass1, (track2 % 10000)::INT AS pass2, round(at1 + adt * s, 3) AS time1
FROM m WHERE {_near_sql()} GROUP BY track1, track2, round(at1 + adt * s, 6), round(at1 + adt * s, 3)""")
def orbit_crossovers(spark, d):
    """The whole crossover job: the events in turn are points of tracks that climb and fall over one sea, across longitude 0."""
    return _orbit_crossovers(spark, d)


def _orbit_crossovers(spark: SparkSession, d: str, before: float | None = None) -> DataFrame:
    c = F.col
    n, k = F.floor(c("event_id") / 125), c("event_id") % 125
    lon = F.pmod(n * F.lit(47.3) % 120 - 60 + k * 0.16, F.lit(360.0))
    lat = F.when(n % 2 == 0, 1).otherwise(-1) * (k * 0.16 - 10)
    pts = events(spark, d).select((n + 10001).alias("track"), (n * 1550.0 + k * 10.0).alias("t"), lon.alias("lon"), lat.alias("lat"), F.when(c("event_id") % 37 != 5, c("value") / 100).alias("v"))
    return crossover.crossovers(pts, before).select(*[F.round(x, 4).alias(x) for x in ("lon", "lat", "ssh1", "ssh2")], "pass1", "pass2", F.round("time1", 3).alias("time1"))


# --- joins --------------------------------------------------------------------------------------------------------------


@query("""
WITH lut AS (SELECT DISTINCT lpad((o_custkey % 100)::VARCHAR, 3, '0') || lpad((o_orderkey % 40)::VARCHAR, 4, '0') AS id FROM orders)
SELECT o_orderkey, id, hash_pass AS pass FROM (SELECT o_orderkey, lpad((o_custkey % 100)::VARCHAR, 3, '0') || lpad((o_orderkey % 40)::VARCHAR, 4, '0') AS id FROM orders) JOIN (SELECT id, id::INT % 254 + 1 AS hash_pass FROM lut) USING (id)""")
def lut_join(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", S.padded_id(F.col("o_custkey") % 100, F.col("o_orderkey") % 40).alias("id"))
    lut = rows.select("id").distinct().withColumn("pass", F.col("id").cast("int") % 254 + 1)
    return lookups.looked_up(rows, lut, "id").select("o_orderkey", "id", "pass")


def _granules(spark, d):
    start = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority", start.alias("start"), (start + F.make_dt_interval(hours=(F.col("o_custkey") % 50 + 1).cast("int"))).alias("end"))


GRANULE_SQL = """g AS (SELECT o_orderkey, o_orderpriority, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS s, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) + INTERVAL 1 HOUR * (o_custkey % 50 + 1) AS e FROM orders),
days AS (SELECT DISTINCT o_orderdate AS m FROM orders)"""


@query(f"WITH {GRANULE_SQL} SELECT strftime(m, '%Y-%m-%d') AS day, count(*) AS n FROM g JOIN days ON e > m AND s < m + INTERVAL 1 DAY GROUP BY m")
def interval_join(spark, d):
    g = _granules(spark, d)
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return lookups.granule_days(g, days, "start", "end").groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {GRANULE_SQL} SELECT strftime(m, '%Y-%m-%d') AS day, count(*) AS n FROM g JOIN days ON e > m AND s < m GROUP BY m")
def interval_join_strict(spark, d):
    g = _granules(spark, d)
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return lookups.granule_days(g, days, "start", "end", overlap=False).groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH lv AS (SELECT row_number() OVER () - 1 AS k, lo, lo + 2.5 AS hi FROM (SELECT unnest(range(0, 40)) * 2.5 AS lo))
SELECT e.user_id, lv.k, count(*) AS n FROM (SELECT user_id, value / 5 AS v FROM events) e JOIN lv ON e.v >= lv.lo AND e.v < lv.hi GROUP BY e.user_id, lv.k""")
def band_join(spark, d):
    levels = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2.5).alias("lo"), (F.col("id") * 2.5 + 2.5).alias("hi"))
    rows = events(spark, d).select("user_id", (F.col("value") / 5).alias("v"))
    return lookups.band_join(rows, levels, "v", "lo", "hi", 2.5).groupBy("user_id", "k").agg(F.count(F.lit(1)).alias("n"))


GRID_SQL = "grid AS (SELECT (p_partkey % 19)::INT AS i, ((p_partkey // 19) % 37)::INT AS j, avg(p_retailprice + p_size * 7) AS v FROM part GROUP BY ALL)"


def _grid(spark, d):
    return table(spark, d, "part").groupBy((F.col("p_partkey") % 19).cast("int").alias("lat_i"), (F.floor(F.col("p_partkey") / 19) % 37).cast("int").alias("lon_i")).agg(F.avg(F.col("p_retailprice") + F.col("p_size") * 7).alias("value"))


@query(f"""
WITH {GRID_SQL}, p AS (SELECT c_custkey, (c_custkey * 7.3 % 178 - 88 + 90) / 10 AS y, (c_custkey * 11.7 % 355 + 0) / 10 AS x FROM customer),
q AS (SELECT c_custkey, floor(y)::INT AS i, floor(x)::INT AS j, y - floor(y) AS fy, x - floor(x) AS fx FROM p)
SELECT c_custkey, round(a.v * (1 - fy) * (1 - fx) + b.v * (1 - fy) * fx + c.v * fy * (1 - fx) + e.v * fy * fx, 6) AS mss
FROM q LEFT JOIN grid a ON a.i = q.i AND a.j = q.j LEFT JOIN grid b ON b.i = q.i AND b.j = q.j + 1 LEFT JOIN grid c ON c.i = q.i + 1 AND c.j = q.j LEFT JOIN grid e ON e.i = q.i + 1 AND e.j = q.j + 1""")
def bilinear_lookup(spark, d):
    # Decimal remainders, as a double just below a multiple of 355 is a place at the other end of the grid.
    key = F.col("c_custkey")
    pts = table(spark, d, "customer").select("c_custkey", (key * Decimal("7.3") % 178 - 88).cast("double").alias("lat"), (key * Decimal("11.7") % 355).cast("double").alias("lon"))
    return lookups.bilinear(pts, _grid(spark, d), "lat", "lon", -90.0, 0.0, 10.0, "mss").select("c_custkey", r6("mss").alias("mss"))


def _ring_sql() -> str:
    sides = [(k, a, b) for k, _, r in synth.RINGS for a, b in zip(r, [*r[1:], r[0]], strict=True)]
    rows = ", ".join(f"({k}, {a[0]!r}::DOUBLE, {a[1]!r}::DOUBLE, {b[0]!r}::DOUBLE, {b[1]!r}::DOUBLE)" for k, a, b in sides)
    return f"edges(id, x1, y1, x2, y2) AS (VALUES {rows})"


@query(f"""
WITH {_ring_sql()}, p AS (SELECT c_custkey, (c_custkey * 0.37) % 110 - 45 AS x, (c_acctbal * 0.013) % 70 - 35 AS y FROM customer),
h AS (SELECT c_custkey, id FROM p JOIN edges ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1 GROUP BY c_custkey, id HAVING count(*) % 2 = 1)
SELECT p.c_custkey, coalesce(min(h.id), 0)::INT AS basin_flag FROM p LEFT JOIN h ON h.c_custkey = p.c_custkey GROUP BY p.c_custkey""")
def point_in_polygon(spark, d):
    pts = table(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") * F.lit(0.37)) % 110 - 45).alias("x"), ((F.col("c_acctbal") * F.lit(0.013)) % 70 - 35).alias("y"))
    return polygons.point_in_polygon(pts, synth.polygons(spark), "x", "y", "c_custkey").select("c_custkey", "basin_flag")


@query(f"""
WITH {_ring_sql()}, p AS (SELECT o_orderkey, (o_orderkey * 0.37) % 290 - 145 AS x, (o_custkey * 1.3 + o_orderkey * 0.11) % 144 - 65 AS y FROM orders),
h AS (SELECT o_orderkey, id FROM p JOIN edges ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1
      GROUP BY o_orderkey, id HAVING count(*) % 2 = 1)
SELECT p.o_orderkey, coalesce(min(h.id), 0)::INT AS basin_flag FROM p LEFT JOIN h ON h.o_orderkey = p.o_orderkey GROUP BY p.o_orderkey""")
def polygon_holes(spark, d):
    """Orders as points over features with holes, an island in a hole, two parts and many edges."""
    x = (F.col("o_orderkey") * F.lit(0.37)) % 290 - 145
    y = (F.col("o_custkey") * F.lit(1.3) + F.col("o_orderkey") * F.lit(0.11)) % 144 - 65
    pts = table(spark, d, "orders").select("o_orderkey", x.alias("x"), y.alias("y"))
    return polygons.point_in_polygon(pts, synth.polygons(spark), "x", "y", "o_orderkey").select("o_orderkey", "basin_flag")


@query("""
SELECT r_name, string_agg(DISTINCT n_name, ', and ' ORDER BY n_name) AS nations, replace(replace(r_name, ' ', '_'), '(', '') AS tidy FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name""")
def source_attr_join(spark, d):
    j = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name").agg(S.joined_distinct(F.col("n_name")).alias("nations")).withColumn("tidy", S.tidy_name(F.col("r_name"), ((" ", "_"), ("(", ""))))


LINKS_SQL = "links AS (SELECT a.n_nationkey AS basin_id, b.n_nationkey AS valid_basin FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey)"


@query(f"""
WITH {LINKS_SQL},
g AS (SELECT s_suppkey AS cell, s_nationkey + 1 AS basin_id, radians((s_suppkey * 37.7::DOUBLE) % 120 - 60) AS la, radians((s_suppkey * 91.3::DOUBLE) % 360) AS lo FROM supplier),
c AS (SELECT c_custkey AS point, c_nationkey + 1 AS basin, c_acctbal AS v, radians((c_custkey * 17.9::DOUBLE) % 130 - 65) AS la, radians((c_custkey * 53.1::DOUBLE) % 360) AS lo FROM customer),
t AS (SELECT cell, valid_basin + 1 AS basin, 6370997.0 * cos(la) * cos(lo) AS x, 6370997.0 * cos(la) * sin(lo) AS y, 6370997.0 * sin(la) AS z FROM g JOIN links ON links.basin_id + 1 = g.basin_id),
s AS (SELECT point, basin, v, 6370997.0 * cos(la) * cos(lo) AS x, 6370997.0 * cos(la) * sin(lo) AS y, 6370997.0 * sin(la) AS z FROM c),
n AS (SELECT cell, point, v, sqrt((t.x - s.x) * (t.x - s.x) + (t.y - s.y) * (t.y - s.y) + (t.z - s.z) * (t.z - s.z)) AS dist FROM t JOIN s ON s.basin = t.basin),
k AS (SELECT *, exp(-(dist / 700000) * (dist / 700000)) AS w FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY dist, point) AS k FROM n WHERE dist <= 2000000) WHERE k <= 8),
m AS (SELECT cell, sum(w * v) / sum(w) AS value, count(*)::INT AS counts, sum(w) AS sw, sum(w * w) AS sww FROM k GROUP BY cell),
d AS (SELECT k.cell, sum(k.w * (k.v - m.value) * (k.v - m.value)) AS ss FROM k JOIN m ON m.cell = k.cell GROUP BY k.cell)
SELECT g.cell, round(m.value, 6) AS value, coalesce(m.counts, 0) AS counts, CASE WHEN m.counts > 1 THEN round(sqrt(sw / (sw * sw - sww) * ss), 4) END AS deviation
FROM g LEFT JOIN m ON m.cell = g.cell LEFT JOIN d ON d.cell = g.cell""")
def knn_gauss_grid(spark, d):
    c = F.col
    links = table(spark, d, "nation").alias("a").join(table(spark, d, "nation").alias("b"), c("a.n_regionkey") == c("b.n_regionkey")).select((c("a.n_nationkey") + 1).alias("basin_id"), (c("b.n_nationkey") + 1).alias("valid_basin"))
    targets = table(spark, d, "supplier").select(c("s_suppkey").alias("cell"), ((c("s_suppkey") * 37.7) % 120 - 60).alias("lat"), ((c("s_suppkey") * 91.3) % 360).alias("lon"), (c("s_nationkey") + 1).alias("basin_id"))
    sources = table(spark, d, "customer").select(c("c_custkey").alias("point"), ((c("c_custkey") * 17.9) % 130 - 65).alias("lat"), ((c("c_custkey") * 53.1) % 360).alias("lon"), c("c_acctbal").alias("v"), (c("c_nationkey") + 1).alias("basin"))
    return grid.gaussian_grid(targets, sources, links, 2e6, 7e5, 8).select("cell", r6("value").alias("value"), "counts", F.round("deviation", 4).alias("deviation"))


# --- orbit error --------------------------------------------------------------------------------------------------------


@query("""
SELECT user_id, round(min(h), 6) AS t_min, round(max(h), 6) AS t_max, count(*) AS n, round(list_sort(list(h))[(count(*) // 2 + 1)::INT], 6) AS t_mid
FROM (SELECT user_id, (epoch(ts) - 1704067200) / 3600 AS h FROM events) GROUP BY user_id""")
def knot_stats(spark, d):
    out = spline.knot_stats(_points(spark, d).withColumn("h", F.col("t") / 3600), ["track"], "h")
    return out.select(F.col("track").alias("user_id"), r6("t_min").alias("t_min"), r6("t_max").alias("t_max"), "n", r6("t_mid").alias("t_mid"))


@query("""
SELECT event_type, round(min(h) FILTER (user_id = lo), 6) AS t_first, round(max(h) FILTER (user_id = hi), 6) AS t_last FROM (
  SELECT event_type, user_id, (epoch(ts) - 1704067200) / 3600 AS h, min(user_id) OVER (PARTITION BY event_type) AS lo, max(user_id) OVER (PARTITION BY event_type) AS hi FROM events) GROUP BY event_type""")
def pass_ends(spark, d):
    rows = events(spark, d).withColumn("h", (F.unix_micros("ts") / 1e6 - 1704067200) / 3600)
    return spline.pass_ends(rows, ["event_type"], "user_id", "h").select("event_type", r6("t_first").alias("t_first"), r6("t_last").alias("t_last"))


@query("""
SELECT o_orderpriority, count(*) AS n, round(sum(hours), 4) AS total FROM (
  SELECT o_orderpriority, unnest(list_concat(list_transform(range(0, greatest(0, ceil((a + 5) / 0.3))::BIGINT), lambda i: -5 + i * 0.3), list_transform(range(1, greatest(1, ceil((29 - b) / 0.3))::BIGINT), lambda i: b + i * 0.3))) AS hours
  FROM (SELECT o_orderpriority, avg(o_custkey % 7) AS a, 20 + avg(o_custkey % 7) AS b FROM orders GROUP BY o_orderpriority)) GROUP BY o_orderpriority""")
def zero_padding(spark, d):
    ends = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.avg(F.col("o_custkey") % 7).alias("t_first"), (F.avg(F.col("o_custkey") % 7) + 20).alias("t_last"))
    return spline.padding(ends, ["o_orderpriority"]).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("hours"), 4).alias("total"))


COEF_SQL = """kinds AS (SELECT event_type, length(event_type) * 0.01 AS shift FROM (SELECT DISTINCT event_type FROM events)),
c AS (SELECT event_type, k, k * 60.0 - 120 AS lo, 0.000001 * k AS c3, -0.0002 * k AS c2, 0.01 AS c1, 0.5 - 0.1 * k + shift AS c0 FROM kinds, (SELECT unnest(range(0, 12)) AS k))"""


@query(f"""
WITH {COEF_SQL}, e AS (SELECT event_id, event_type, floor(round((epoch(ts) - 1704067200), 6)) / 3600 AS h FROM events),
j AS (SELECT e.event_id, e.event_type, h, max(c.k) AS k FROM e LEFT JOIN c ON c.event_type = e.event_type AND c.lo <= h GROUP BY ALL)
SELECT event_id, round(-(((c3 * (h - lo) + c2) * (h - lo) + c1) * (h - lo) + c0), 6) AS oer FROM j JOIN c ON c.event_type = j.event_type AND c.k = coalesce(j.k, 0)""")
def spline_eval(spark, d):
    e, k = events(spark, d), F.col("k")
    kinds = e.select("event_type").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11))))
    coef = kinds.select("event_type", (k * 60.0 - 120).alias("lo"), (k * 0.000001).alias("c3"), (k * -0.0002).alias("c2"), F.lit(0.01).alias("c1"), (0.5 - k * 0.1 + F.length("event_type") * 0.01).alias("c0"))
    pts = e.select("event_id", "event_type", ((F.unix_micros("ts") / 1e6 - 1704067200) / 3600).alias("h"))
    return spline.evaluated(pts, coef, ["event_type"], "h", width=60.0, reach=(-120.0, 600.0)).select("event_id", r6("oer").alias("oer"))


@query("""
SELECT event_type, user_id % 20 AS part, round(sqrt(avg(value * value)), 6) AS rms_sig, round(sqrt(avg((value - 50) * (value - 50))), 6) AS rms_res, count(*) AS nint FROM events GROUP BY ALL""")
def interval_rms(spark, d):
    rows = events(spark, d).withColumn("part", F.col("user_id") % 20).withColumn("res", F.col("value") - 50)
    return spline.interval_rms(rows, ["event_type", "part"], "value", "res").select("event_type", "part", r6("rms_sig").alias("rms_sig"), r6("rms_res").alias("rms_res"), "nint")


def spline_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Crossovers of the events, each of a pass of two hours with one three hours before, as the fit's inputs, and their days."""
    time = F.unix_micros("ts") / 1e6
    passes_of = lambda t: F.floor(t / 7200).cast("long")
    x = events(spark, d).select(F.col("event_type").alias("source"), (time - 10800).alias("time1"), time.alias("time2"), passes_of(time - 10800).alias("track1"), passes_of(time).alias("track2"), ((F.col("value") - 50) / 500).alias("d"))
    days = events(spark, d).select(F.col("event_type").alias("source"), F.to_date("ts").alias("date")).distinct()
    return spline.day_inputs(x, days), days


@query()
def spline_fit(spark, d):
    """A dense solve for each source and day of the events' crossovers; the tests solve the same days in another way."""
    out = spline.fit_days(*spline_inputs(spark, d))
    mid = (F.col("hi") - F.col("lo")) / 2
    return out.select("source", "date", "interval", r6("lo").alias("lo"), r6("hi").alias("hi"), "nint", F.round(spline.horner(mid), 5).alias("middle"), F.round("rms_res", 5).alias("rms_res"))


@query("""
SELECT DISTINCT event_type AS source, strftime(ts::DATE, '%Y-%m-%d') AS date, true AS joined, true AS periodic, true AS rests FROM events""")
def spline_conditions(spark, d):
    """Whether the spline of each source and day meets the conditions that its fit is subject to."""
    out = spline.conditions(spline.fit_days(*spline_inputs(spark, d)), ["source", "date"])
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("""
WITH e AS (SELECT event_type, ts::DATE AS day, hour(ts) AS hour, (epoch(ts) - epoch(date_trunc('hour', ts))) / 3600 AS u, (value - 50) / 500 AS d FROM events)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, hour::INT AS hour, count(*) AS n, """ + ", ".join(f"round(sum({'*'.join(['u'] * k)}), 6) AS u{k}" for k in range(1, 7)) + ", " + ", ".join(f"round(sum({'*'.join(['d', *['u'] * k])}), 6) AS d{k}" for k in range(4)) + """
FROM e GROUP BY event_type, day, hour""")
def spline_gram(spark, d):
    """The sums of the normal equations, of hourly intervals of each source and day."""
    hour = F.unix_micros(F.date_trunc("hour", "ts"))
    rows = events(spark, d).select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.hour("ts").alias("hour"), ((F.unix_micros("ts") - hour) / 3600e6).alias("u"), ((F.col("value") - 50) / 500).alias("d"))
    out = spline.gram_sums(rows, ["event_type", "day", "hour"], "u", "d")
    return out.select("event_type", "day", "hour", "n", *[r6(c).alias(c) for c in out.columns[4:]])


@query("""
WITH days AS (SELECT DISTINCT event_type AS source, ts::DATE AS date FROM events)
SELECT source, strftime(date, '%Y-%m-%d') AS date, (k + 3)::INT AS "interval", k::DOUBLE AS lo, k::DOUBLE + 1 AS hi, 0.0::DOUBLE AS c0, 0 AS nint FROM days, (SELECT unnest(range(-3, 27)) AS k)""")
def zero_polynomials(spark, d):
    """Days whose differences are all too large have the hourly polynomial of zero."""
    inputs, days = spline_inputs(spark, d)
    out = spline.fit_days(inputs.withColumn("near", F.lit(False)), days)
    return out.select("source", F.date_format("date", "yyyy-MM-dd").alias("date"), "interval", "lo", "hi", "c0", "nint")


@query("SELECT * FROM (" + SQL["orbit_crossovers"] + ") WHERE time1 < 9000")
def crossovers_before(spark, d):
    """Crossovers whose first time is before an instant, as a window's output takes them."""
    return _orbit_crossovers(spark, d, 9000.0)


# --- grids and indicators -----------------------------------------------------------------------------------------------


@query("""
SELECT l_suppkey, round(100 * sum(s * l_quantity) / sum(CASE WHEN s IS NOT NULL THEN l_quantity END), 6) AS gmsl
FROM (SELECT *, CASE WHEN l_partkey % 5 > 0 AND l_partkey % 1100 > 0 AND l_partkey % 1100 < 1000 THEN l_discount END AS s FROM lineitem)
WHERE l_extendedprice / 105000 * 180 - 90 BETWEEN -66 AND 66 GROUP BY l_suppkey""")
def gmsl_weighted(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem").where(indicators.in_band(c("l_extendedprice") / 105000 * 180 - 90))
    rows = rows.withColumn("s", indicators.ocean_only(F.when(c("l_partkey") % 5 > 0, c("l_discount")), c("l_partkey") % 1100))
    return indicators.area_mean(rows, ["l_suppkey"], "s", "l_quantity").withColumn("gmsl", r6("gmsl"))


MONTHLY_SQL = "m AS (SELECT l_returnflag, date_trunc('month', l_shipdate) AS month, year(l_shipdate) + (month(l_shipdate) - 0.5) / 12 AS t, avg(l_extendedprice) / 1000 AS v FROM lineitem GROUP BY ALL)"


def _monthly(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", F.to_date(F.date_trunc("month", "l_shipdate")).alias("month"), (F.year("l_shipdate") + (F.month("l_shipdate") - 0.5) / 12).alias("t")).agg((F.avg("l_extendedprice") / 1000).alias("v"))


@query(f"WITH {MONTHLY_SQL} SELECT l_returnflag, strftime(month, '%Y-%m-%d') AS month, round(v - avg(CASE WHEN t >= 1996 AND t < 1997 THEN v END) OVER (PARTITION BY l_returnflag), 6) AS v FROM m")
def baseline_shift(spark, d):
    out = indicators.shifted_to_baseline(_monthly(spark, d), ["l_returnflag"], "t", "v", (1996.0, 1997.0))
    return out.select("l_returnflag", F.date_format("month", "yyyy-MM-dd").alias("month"), r6("v").alias("v"))


@query("""
WITH x AS (SELECT vec_id, unnest(range(1, 65)) AS k, unnest(embedding) AS v FROM embeddings), p AS (SELECT k, v::DOUBLE * 1000 AS p FROM x WHERE vec_id = 0)
SELECT vec_id, round(sum(p / 1000 * v::DOUBLE) / sum(p / 1000 * (p / 1000)), 6) AS factor FROM x JOIN p USING (k) GROUP BY vec_id""")
def pattern_projection(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("k", "v")).withColumn("v", F.col("v").cast("double"))
    pattern = x.where("vec_id = 0").select("k", (F.col("v") * 1000).alias("p"))
    return indicators.projected(x.join(pattern, "k"), ["vec_id"], "v", "p", "factor").withColumn("factor", r6("factor"))


@query(f"""
WITH {MONTHLY_SQL} SELECT l_returnflag, strftime(month, '%Y-%m-%d') AS month, round(v - ((epoch(month) - epoch(TIMESTAMP '1992-10-02')) * 0.00000001 + 2.5) - month(month) / 1000, 6) AS anomaly,
  round(v * 1000 - 3 * 10 - (0.25 * 10 * t + 1.5 * 10), 6) AS anomaly_mm FROM m""")
def detrend_deseason(spark, d):
    m = _monthly(spark, d)
    a = indicators.detrended(F.col("month"), F.col("v"), F.lit(0.00000001), F.lit(2.5), F.month("month"))
    b = indicators.anomaly_mm(F.col("v"), F.lit(3.0), F.lit(0.25), F.lit(1.5), F.col("t"))
    return m.select("l_returnflag", F.date_format("month", "yyyy-MM-dd").alias("month"), r6(a).alias("anomaly"), r6(b).alias("anomaly_mm"))


SERIES_SQL = """
gr AS (SELECT date_trunc('month', l_shipdate)::DATE AS grid_date, (l_suppkey % 7)::INT AS lat_i, l_linenumber::INT AS lon_i, (l_suppkey % 7) * 25.0 - 75 AS latitude, avg(l_discount) AS ssha, count(*) * 4 AS counts FROM lineitem GROUP BY ALL),
g AS (SELECT *, CASE WHEN lat_i = lon_i THEN 0 WHEN lon_i = 7 THEN 1000 ELSE lat_i + 1 END AS basin_flag FROM gr),
ok AS (SELECT grid_date FROM g WHERE grid_date >= DATE '1993-01-01' AND latitude BETWEEN -66 AND 66 GROUP BY grid_date HAVING avg(counts) > 0.9 * 20),
r AS (SELECT g.* EXCLUDE (ssha), CASE WHEN basin_flag > 0 AND basin_flag < 1000 THEN ssha END AS s, cos(radians(latitude)) + lon_i * 0.01 AS area FROM g SEMI JOIN ok USING (grid_date)),
gm AS (SELECT grid_date, 100 * sum(s * area) / sum(CASE WHEN s IS NOT NULL THEN area END) AS gmsl FROM r WHERE latitude BETWEEN -66 AND 66 GROUP BY grid_date),
a AS (SELECT *, s - ((epoch(grid_date::TIMESTAMP) - epoch(TIMESTAMP '1992-10-02')) * (lat_i * 1e-11) + lon_i * 0.001) - (month(grid_date) * 0.1 + lat_i) / 1000 AS v FROM r),
f AS (SELECT grid_date, p.n, sum(p.w * v) / sum(CASE WHEN v IS NOT NULL THEN p.w * p.w END) AS factor FROM a JOIN (
        SELECT i, j, n, (i * 3 + j * n + 1) / 1000 AS w FROM (SELECT unnest(range(0, 7)) AS i), (SELECT unnest(range(1, 8)) AS j), (SELECT unnest([1, 2, 3]) AS n) WHERE i + j > n) p ON p.i = lat_i AND p.j = lon_i GROUP BY ALL),
t AS (SELECT gm.grid_date, year(gm.grid_date) + dayofyear(gm.grid_date) / dayofyear(make_date(year(gm.grid_date), 12, 31)) AS time, gmsl,
             max(factor) FILTER (n = 1) AS enso, max(factor) FILTER (n = 2) AS pdo, max(factor) FILTER (n = 3) AS iod FROM gm LEFT JOIN f ON f.grid_date = gm.grid_date GROUP BY ALL),
b AS (SELECT *, gmsl - (SELECT avg(gmsl) FROM t WHERE time >= 1993 AND time < 1994) AS level, make_date(floor(time)::INT, 1, 1)::TIMESTAMP + to_microseconds(round((time - floor(time)) * 365.25 * 86400000000.0)::BIGINT) AS moment FROM t)
SELECT round(time, 9) AS time, round(level, 6) AS gmsl, round(avg(level) OVER (ORDER BY moment RANGE BETWEEN INTERVAL '2427840 seconds' PRECEDING AND INTERVAL '2427840 seconds' FOLLOWING), 6) AS smoothed_gmsl,
       round(enso, 6) AS enso, round(pdo, 6) AS pdo, round(iod, 6) AS iod FROM b"""


@query(f"WITH {SERIES_SQL}")
def indicator_series(spark, d):
    """The whole indicator job over monthly grids of the line items, with land, a closed sea, thin months and the year before."""
    c = F.col
    li = table(spark, d, "lineitem")
    where = [(c("l_suppkey") % 7).cast("int").alias("lat_i"), c("l_linenumber").cast("int").alias("lon_i")]
    grids = li.groupBy(F.date_trunc("month", "l_shipdate").cast("date").alias("grid_date"), *where).agg(F.avg("l_discount").alias("ssha"), (F.count(F.lit(1)) * 4).alias("counts"))
    grids = grids.withColumn("latitude", c("lat_i") * 25.0 - 75).withColumn("basin_flag", F.when(c("lat_i") == c("lon_i"), 0).when(c("lon_i") == 7, 1000).otherwise(c("lat_i") + 1))
    at = spark.range(49).select(F.floor(c("id") / 7).cast("int").alias("lat_i"), (c("id") % 7 + 1).cast("int").alias("lon_i"))
    cells = at.select("lat_i", "lon_i", (F.cos(F.radians(c("lat_i") * 25.0 - 75)) + c("lon_i") * 0.01).alias("area"), (c("lat_i") * 1e-11).alias("slope"), (c("lon_i") * 0.001).alias("offset"))
    annual = at.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).withColumn("annual_mm", c("month") * 0.1 + c("lat_i"))
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("pattern"), F.lit(k).alias("k")) for k, n in enumerate(("enso", "pdo", "iod"), 1)]))
    patterns = at.withColumn("p", kinds).select("lat_i", "lon_i", "p.*").where("lat_i + lon_i > k").withColumn("pattern_mm", (c("lat_i") * 3 + c("lon_i") * c("k") + 1).cast("double"))
    out = indicators.series(grids, cells, annual, patterns, neighbours=20)
    return out.select(F.round("time", 9).alias("time"), *[r6(n).alias(n) for n in ("gmsl", "smoothed_gmsl", "enso", "pdo", "iod")])


#: The values of o_orderpriority (fixed values).
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("""
WITH mm AS (SELECT o_orderpriority AS cell, (month(o_orderdate) - 0.5) / 12 AS sat, avg(o_totalprice) / 1000 AS v FROM orders GROUP BY ALL),
w AS (SELECT cell, sat, v FROM mm UNION ALL SELECT cell, sat + 1, v FROM mm WHERE sat < 0.05 UNION ALL SELECT cell, sat - 1, v FROM mm WHERE sat > 0.95),
s AS (SELECT cell, sat AS lo, v AS lv, lead(sat) OVER (PARTITION BY cell ORDER BY sat) AS hi, lead(v) OVER (PARTITION BY cell ORDER BY sat) AS hv FROM w)
SELECT p.c_custkey, s.cell, round(lv + (hv - lv) * (p.sat - lo) / (hi - lo), 6) AS season FROM (SELECT c_custkey, (c_custkey % 365) / 365.0 AS sat FROM customer) p JOIN s ON p.sat >= s.lo AND p.sat < s.hi""")
def season_interp(spark, d):
    months = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("cell"), ((F.month("o_orderdate") - 0.5) / 12).alias("at")).agg((F.avg("o_totalprice") / 1000).alias("v"))
    pts = table(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") % 365) / 365.0).alias("when")).withColumn("cell", F.explode(F.array(*map(F.lit, PRIORITIES))))
    return grid.season_at(pts, months, ["cell"], "when", "v", "season").select("c_custkey", "cell", r6("season").alias("season"))


LINE_GRID_SQL = """cells AS (SELECT unnest(range(0, 288)) AS cell),
gv AS (SELECT (l_partkey % 288) AS cell, l_linenumber AS g, avg(CASE WHEN l_partkey % 7 > 2 AND (l_partkey % 288) % 5 <> 3 THEN l_quantity END) AS v FROM lineitem GROUP BY ALL),
g AS (SELECT n.g, cells.cell, gv.v, CASE WHEN cells.cell % 12 = 0 THEN 0 ELSE 1 END AS basin_id FROM cells CROSS JOIN (SELECT DISTINCT l_linenumber AS g FROM lineitem) n LEFT JOIN gv ON gv.cell = cells.cell AND gv.g = n.g),
st AS (SELECT cell AS r, (cell // 24) * 24 + (cell % 24 + d) % 24 AS c, 0.1 AS w FROM cells, (SELECT unnest([1, 23]) AS d)
       UNION ALL SELECT cell, cell + d, 0.1 FROM cells, (SELECT unnest([-24, 24]) AS d) WHERE cell + d >= 0 AND cell + d < 288),
full_st AS (SELECT * FROM st UNION ALL SELECT r, r, -0.1 * count(*) FROM st GROUP BY r)"""


def _line_grid(spark, d):
    li = table(spark, d, "lineitem")
    cell = F.col("l_partkey") % 288
    known = F.when((F.col("l_partkey") % 7 > 2) & (cell % 5 != 3), F.col("l_quantity"))  # the others are the gaps
    values = li.groupBy(cell.alias("cell"), F.col("l_linenumber").alias("g")).agg(F.avg(known).alias("v"))
    cells = li.select(F.col("l_linenumber").alias("g")).distinct().withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(287)))).withColumn("cell", F.col("cell").cast("long"))
    full = cells.join(values, ["g", "cell"], "left").withColumn("basin_id", F.when(F.col("cell") % 12 == 0, 0).otherwise(1))
    st = spark.createDataFrame(synth.stencil(12, 24), "row long, col long, val double")
    return full, st


@query(f"""
WITH {LINE_GRID_SQL}, f AS (SELECT g.g, st.r AS cell, sum(st.w * x.v) / sum(CASE WHEN x.v IS NOT NULL THEN st.w END) AS nv FROM g JOIN st ON st.r = g.cell JOIN g x ON x.g = g.g AND x.cell = st.c GROUP BY g.g, st.r)
SELECT g.g AS g, g.cell, round(coalesce(g.v, CASE WHEN basin_id > 0 THEN f.nv END), 6) AS v FROM g LEFT JOIN f ON f.g = g.g AND f.cell = g.cell""")
def grid_fill_once(spark, d):
    full, st = _line_grid(spark, d)
    return grid.fill_once(full, st, ["g"]).select("g", "cell", r6("v").alias("v"))


@query(f"""
WITH {LINE_GRID_SQL}, f AS (SELECT x.g, s.r AS cell, CASE WHEN count(x.v) = count(*) THEN sum(s.w * x.v) END AS dv FROM full_st s JOIN g x ON x.cell = s.c GROUP BY x.g, s.r)
SELECT g.g AS g, g.cell, round(g.v + f.dv, 6) AS v FROM g JOIN f ON f.g = g.g AND f.cell = g.cell""")
def diffuse_step(spark, d):
    full, st = _line_grid(spark, d)
    return grid.diffuse_once(full, st, ["g"]).select("g", "cell", r6("v").alias("v"))


@query(f"""
WITH {LINE_GRID_SQL}, w AS (SELECT g, cell // 24 AS i, cell % 24 AS j, v FROM g),
n AS (SELECT *, lag(CASE WHEN v IS NOT NULL THEN j END) OVER o AS aj, lag(v) OVER o AS av,
        first_value(CASE WHEN v IS NOT NULL THEN j END IGNORE NULLS) OVER (PARTITION BY g, i ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bj,
        first_value(v IGNORE NULLS) OVER (PARTITION BY g, i ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bv FROM w WINDOW o AS (PARTITION BY g, i ORDER BY j))
SELECT g, i, j, round(coalesce(v, CASE WHEN aj IS NOT NULL AND bj IS NOT NULL THEN av + (bv - av) * (j - aj) / (bj - aj) END), 6) AS v FROM n""")
def interp_na_limit1(spark, d):
    full, _ = _line_grid(spark, d)
    rows = full.select("g", F.floor(F.col("cell") / 24).alias("i"), (F.col("cell") % 24).alias("j"), "v")
    return grid.fill_gaps_of_one(rows, ["g", "i"], "j", "v").select("g", "i", "j", r6("v").alias("v"))


@query("""
SELECT l_suppkey, count(l_quantity) AS n, count(l_quantity) >= 600 AS usable, round(avg(l_quantity), 6) AS mean_counts, min(l_quantity) AS least, max(l_quantity) AS greatest FROM lineitem GROUP BY l_suppkey HAVING avg(l_quantity) > 0.9 * 28""")
def grid_validity(spark, d):
    li = table(spark, d, "lineitem")
    valid = grid.valid_grids(li, ["l_suppkey"], "l_quantity", k=28)
    return grid.enough_points(li, ["l_suppkey"], "l_quantity", 600).join(valid, "l_suppkey").join(grid.extremes(li, ["l_suppkey"], "l_quantity"), "l_suppkey").withColumn("mean_counts", r6("mean_counts"))


@query(f"""
WITH {GRID_SQL}, w AS (SELECT i, j, v FROM grid UNION ALL SELECT i, j + 37, v FROM grid WHERE j <= 1 UNION ALL SELECT i, j - 37, v FROM grid WHERE j >= 35),
p AS (SELECT s_suppkey, ((s_suppkey * 3.7) % 175 + 1) / 10 AS y, ((s_suppkey * 29.3) % 370) / 10 AS x FROM supplier),
q AS (SELECT s_suppkey, floor(y)::INT AS i, floor(x)::INT AS j, y - floor(y) AS fy, x - floor(x) AS fx FROM p)
SELECT s_suppkey, round(a.v * (1 - fy) * (1 - fx) + b.v * (1 - fy) * fx + c.v * fy * (1 - fx) + e.v * fy * fx, 6) AS value
FROM q LEFT JOIN w a ON a.i = q.i AND a.j = q.j LEFT JOIN w b ON b.i = q.i AND b.j = q.j + 1 LEFT JOIN w c ON c.i = q.i + 1 AND c.j = q.j LEFT JOIN w e ON e.i = q.i + 1 AND e.j = q.j + 1""")
def regrid_periodic(spark, d):
    pts = table(spark, d, "supplier").select("s_suppkey", ((F.col("s_suppkey") * 3.7) % 175 + 1).alias("lat"), ((F.col("s_suppkey") * 29.3) % 370).alias("lon"))
    return grid.regridded(_grid(spark, d), pts, 0.0, 0.0, 10.0, 37).select("s_suppkey", r6("value").alias("value"))


@query(f"WITH {MONTHLY_SQL} SELECT l_returnflag, printf('%-12.7f %12f', t, v) AS value FROM m")
def text_lines(spark, d):
    return _monthly(spark, d).select("l_returnflag", S.fixed_width(F.col("t"), F.col("v")).alias("value"))


@query("""
SELECT event_id, round(value - CASE WHEN event_id % 3 = 0 THEN 0.01 ELSE 0 END + CASE WHEN event_type = 'error' THEN 0.0291 ELSE 0 END, 6) AS ssha FROM events""")
def offset_reapply(spark, d):
    before = F.when(F.col("event_id") % 3 == 0, F.lit(0.01))
    return events(spark, d).select("event_id", r6(passes.absolute_offset(F.col("value"), F.col("event_type"), before, {"error": 0.0291})).alias("ssha"))


def _fill_and_diffuse_sql(rounds: int = 12, steps: int = 4) -> str:
    """Both loops unrolled; rounds of filling past the last that changes a cell change nothing."""
    parts = [LINE_GRID_SQL, "sea AS (SELECT * FROM st WHERE r % 12 > 0 AND c % 12 > 0)", "sea_full AS (SELECT * FROM full_st WHERE r % 12 > 0 AND c % 12 > 0)", "x0 AS (SELECT g, cell, v, basin_id FROM g)"]
    for k in range(rounds):
        new = f"SELECT x.g, s.r AS cell, sum(s.w * x.v) / sum(CASE WHEN x.v IS NOT NULL THEN s.w END) AS nv FROM sea s JOIN x{k} x ON x.cell = s.c GROUP BY x.g, s.r"
        parts.append(f"x{k + 1} AS (SELECT o.g, o.cell, coalesce(o.v, CASE WHEN basin_id > 0 THEN f.nv END) AS v, basin_id FROM x{k} o LEFT JOIN ({new}) f ON f.g = o.g AND f.cell = o.cell)")
    for k in range(rounds, rounds + steps):
        step = f"SELECT x.g, s.r AS cell, CASE WHEN count(x.v) = count(*) THEN sum(s.w * x.v) END AS dv FROM sea_full s JOIN x{k} x ON x.cell = s.c GROUP BY x.g, s.r"
        parts.append(f"x{k + 1} AS (SELECT o.g, o.cell, CASE WHEN f.cell IS NULL THEN o.v ELSE o.v + f.dv END AS v, basin_id FROM x{k} o LEFT JOIN ({step}) f ON f.g = o.g AND f.cell = o.cell)")
    return f"WITH {', '.join(parts)} SELECT g, cell, round(v * 1000 / 99991, 6) AS v FROM x{rounds + steps}"


@query(_fill_and_diffuse_sql())
def fill_and_diffuse(spark, d):
    """Each grid filled and diffused in one group, over the sea alone."""
    full, _ = _line_grid(spark, d)
    sea = [(r, c, v) for r, c, v in synth.stencil(12, 24) if r % 12 and c % 12]
    return grid.fill_and_diffuse(full, sea, 4, "g").select("g", "cell", r6(F.col("v") * 1000 / 99991).alias("v"))  # sums of tenths would end in fives


@query(_fill_and_diffuse_sql())
def fill_and_diffuse_tiles(spark, d):
    """The same grids in tiles of five by five cells with halos of three."""
    full, st = _line_grid(spark, d)
    sea = st.where("row % 12 > 0 AND col % 12 > 0")
    done = tiles.fill_and_diffuse(full, sea, 4, tiles.squares(24, 5), "g", depth=3)
    return done.select("g", "cell", r6(F.col("v") * 1000 / 99991).alias("v"))


@query("""
WITH sp AS (SELECT unnest(generate_series(DATE '1998-01-01', DATE '1999-12-31', INTERVAL 1 DAY))::DATE AS day),
o AS (SELECT o_orderdate::DATE AS day, max(o_custkey) AS t FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), i AS (SELECT l_shipdate::DATE AS day, max(l_partkey) AS t FROM lineitem GROUP BY ALL)
SELECT strftime(sp.day, '%Y-%m-%d') AS date, 'merged' AS source, 'merged' AS satellite, 'b' AS bucket FROM sp LEFT JOIN o ON o.day = sp.day LEFT JOIN i ON i.day = sp.day
WHERE o.t IS NULL OR coalesce(o.t < i.t, false)""")
def job_planner(spark, d):
    outputs = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.max("o_custkey").alias("output_time"))
    inputs = planner.latest(table(spark, d, "lineitem").withColumn("day", F.to_date("l_shipdate")), "day", "l_partkey")
    return planner.jobs(planner.days(spark, date(1998, 1, 1), date(1999, 12, 31)), outputs, inputs, "b").withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("""
SELECT DISTINCT strftime(m, '%Y-%m-%d') AS monday FROM (
  SELECT unnest([date_trunc('week', o_orderdate)::DATE, date_trunc('week', o_orderdate)::DATE + 7]) AS m FROM orders) WHERE m <= DATE '2000-06-05'""")
def affected_mondays(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    return planner.affected_mondays(days, "day", F.lit(date(2000, 6, 14))).select(F.date_format("monday", "yyyy-MM-dd").alias("monday"))


PRIORITY_SQL = "r AS (SELECT o_orderdate::DATE AS day, lpad((o_custkey % 5)::VARCHAR, 3, '0') || '_001' AS key, left(o_orderpriority, 1)::INT AS priority, o_totalprice AS t, o_orderkey FROM orders)"


def _priority_rows(spark, d):
    title = F.concat(F.lit("S_"), F.lpad((F.col("o_custkey") % 5).cast("string"), 3, "0"), F.lit("_001_z"))
    return table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), title.alias("title"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("priority"), F.col("o_totalprice").alias("t"), "o_orderkey")


@query(f"""
WITH {PRIORITY_SQL} SELECT strftime(day, '%Y-%m-%d') AS day, max(t) AS input_time FROM (
  SELECT *, min(priority) OVER (PARTITION BY day, key ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best FROM r) WHERE priority <= best GROUP BY day""")
def priority_mtime(spark, d):
    return planner.latest_by_priority(_priority_rows(spark, d), "day", "title", "priority", "t", "o_orderkey").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(f"""
WITH {PRIORITY_SQL} SELECT strftime(day, '%Y-%m-%d') AS day, max(t) AS input_time FROM (SELECT *, min(priority) OVER (PARTITION BY day, key) AS best FROM r) WHERE priority <= best GROUP BY day""")
def priority_mtime_reset(spark, d):
    return planner.latest_by_priority(_priority_rows(spark, d), "day", "title", "priority", "t", "o_orderkey", reset=True).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT year(o_orderdate)::INT AS year, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day, count(*) AS n FROM orders GROUP BY 1")
def days_by_year(spark, d):
    return planner.days_by_year(table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_day", "last_day")})


@query("SELECT DISTINCT o_custkey::INT AS basin_id, (o_orderkey % 90)::INT AS valid_basin FROM orders")
def adjacency_parse(spark, d):
    lines = table(spark, d, "orders").groupBy("o_custkey").agg(F.concat(F.col("o_custkey").cast("string"), F.lit(":"), F.array_join(F.collect_list((F.col("o_orderkey") % 90).cast("string")), ",")).alias("value"))
    return readers.adjacency(lines)


@query("""SELECT s_name AS name, '{"name":"' || s_name || '","checksum":"' || md5(s_name || s_suppkey) || '","checksumType":"md5","size":' || strlen(s_name || s_suppkey) || ',"modified":' || (s_suppkey * 1000) || '}' AS json FROM supplier""")
def sidecar_json(spark, d):
    files = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.concat("s_name", F.col("s_suppkey").cast("string")).alias("content"), F.timestamp_seconds("s_suppkey").alias("modificationTime"))
    return writers.sidecar(files)


@query("SELECT event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS coverage_start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS coverage_end FROM events GROUP BY event_type")
def time_coverage(spark, d):
    return writers.coverage(events(spark, d), ["event_type"], "ts").withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("coverage_start", "coverage_end")})




# --- sources and sinks ------------------------------------------------------------------------------------------------


@query("""
WITH c AS (SELECT o_orderkey, 'X_' || lpad((o_custkey % 50)::VARCHAR, 3, '0') || '_' || lpad((o_orderkey % 254)::VARCHAR, 3, '0') || CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE '_v1' END AS title,
       CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'late' ELSE 'early' END AS collection FROM orders),
k AS (SELECT *, nullif(regexp_extract(title, '_([0-9]{3}_[0-9]{3})_', 1), '') AS cycle_pass FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY cycle_pass ORDER BY CASE collection WHEN 'final' THEN 0 WHEN 'late' THEN 1 ELSE 2 END, o_orderkey) AS n FROM k WHERE cycle_pass IS NOT NULL)
SELECT cycle_pass, o_orderkey::VARCHAR AS id, 's3://granules/' || o_orderkey AS href, collection FROM r WHERE n = 1""")
def catalog_best(spark, d):
    """A catalog of the orders as granules: links by relation, keys in titles, of one cycle and pass the best collection."""
    c = F.col
    o = table(spark, d, "orders")
    title = F.concat(F.lit("X_"), F.lpad((c("o_custkey") % 50).cast("string"), 3, "0"), F.lit("_"), F.lpad((c("o_orderkey") % 254).cast("string"), 3, "0"), F.when(c("o_orderkey") % 9 == 0, "").otherwise("_v1"))
    link = lambda rel, head: F.struct(F.lit(rel).alias("rel"), F.concat(F.lit(head), c("o_orderkey")).alias("href"))
    kind = F.when(c("o_orderstatus") == "F", "final").when(c("o_orderstatus") == "O", "late").otherwise("early")
    none = F.lit(None).cast("timestamp")
    catalog = o.select(c("o_orderkey").cast("string").alias("id"), title.alias("title"), F.array(link("https", "https://granules/"), link("s3", "s3://granules/")).alias("links"), none.alias("time_start"), none.alias("time_end"), none.alias("updated"), kind.alias("collection"))
    every = readers.granules_of(catalog, "s3")
    parts = [readers.of_collection(every, n) for n in ("early", "final", "late")]  # each collection is asked for on its own
    found = readers.best_granules(setops.stacked_tables(*parts).withColumn("seq", c("id").cast("long")), {"final": 0, "late": 1, "early": 2})
    return found.select("cycle_pass", "id", "href", "collection")


@query("""
SELECT l_orderkey, l_linenumber, (l_orderkey % 40)::INT AS cycle, ((l_suppkey % 20) * 1000 + l_linenumber)::INT % 254 + 1 AS pass, round(l_discount * 40 / 1000, 9) AS ssha, round(l_tax * 100, 6) AS latitude FROM lineitem""")
def granule_merged(spark, d):
    """Granules of the merged kind: millimetres, passes by look-up of orbit and index, cycles from the file."""
    c = F.col
    li = table(spark, d, "lineitem")
    g = li.select("l_orderkey", "l_linenumber", (c("l_orderkey") % 40).cast("int").alias("merged_cycle"), (c("l_tax") * 100).alias("lat"), (c("l_discount") * 40).alias("ssha"), (c("l_suppkey") % 20).cast("int").alias("reference_orbit"), c("l_linenumber").cast("int").alias("index"))
    ids = g.select("reference_orbit", "index").distinct()
    lookup = ids.select(S.padded_id(c("reference_orbit"), c("index")).alias("id"), ((c("reference_orbit") * 1000 + c("index")) % 254 + 1).alias("pass"))
    return readers.merged_granules(g, lookup).select("l_orderkey", "l_linenumber", "cycle", "pass", F.round("ssha", 9).alias("ssha"), r6("latitude").alias("latitude"))


@query("""
SELECT l_orderkey, l_linenumber, (l_orderkey % 40)::INT AS cycle, (l_suppkey % 254 + 1)::INT AS pass, l_tax AS dac, l_quantity AS swh, l_discount AS ssha FROM lineitem""")
def granule_grouped(spark, d):
    """Granules of the reduced kind with variables in groups of groups and cycle and pass of the file."""
    c = F.col
    ku = F.struct(c("l_quantity").alias("swh"), c("l_discount").alias("ssha"))
    g = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (c("l_orderkey") % 40).cast("int").alias("cycle_number"), (c("l_suppkey") % 254 + 1).cast("int").alias("pass_number"), F.struct(c("l_tax").alias("dac"), ku.alias("ku")).alias("data"))
    return readers.reduced_granules(g).select("l_orderkey", "l_linenumber", "cycle", "pass", "dac", "swh", "ssha")


@query("""
WITH x AS (SELECT event_type AS source, epoch(ts) - 10800 AS time1, epoch(ts) AS time2, (value - 50) / 500 AS d FROM events),
r AS (SELECT source, floor(time1 / 7200)::BIGINT AS track, time1 AS time, d FROM x UNION ALL SELECT source, floor(time2 / 7200)::BIGINT, time2, -d FROM x),
e AS (SELECT *, unnest(range(floor((time - 7200) / 86400)::INT, floor((time + 7200) / 86400)::INT + 1)) AS k FROM r),
y AS (SELECT *, DATE '1970-01-01' + k::INT AS date FROM e)
SELECT source, strftime(date, '%Y-%m-%d') AS date, track, round((time - k * 86400.0) / 3600, 6) AS hours, round(d, 9) AS d, abs(d) < 0.3 AS near
FROM y SEMI JOIN (SELECT DISTINCT event_type AS source, ts::DATE AS date FROM events) s ON s.source = y.source AND s.date = y.date""")
def crossover_day_inputs(spark, d):
    """Crossovers as signed rows of each day whose span with two hours on either side holds them."""
    rows, _ = spline_inputs(spark, d)
    return rows.select("source", F.date_format("date", "yyyy-MM-dd").alias("date"), "track", r6("hours").alias("hours"), F.round("d", 9).alias("d"), "near")


@query("""
SELECT event_id, round(value + oer, 6) AS ssha, round(value / 2 + oer, 6) AS ssha_smoothed, round(oer, 6) AS oer FROM events JOIN (SELECT event_id, (event_id % 7) * 0.01 AS oer FROM events) USING (event_id)""")
def correction_applied(spark, d):
    e = events(spark, d).select("event_id", F.col("value").alias("ssha"), (F.col("value") / 2).alias("ssha_smoothed"))
    oer = events(spark, d).select("event_id", ((F.col("event_id") % 7) * 0.01).alias("oer"))
    return spline.corrected(e, oer, ["event_id"]).select("event_id", *[r6(n).alias(n) for n in ("ssha", "ssha_smoothed", "oer")])


@query("""
SELECT event_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT event_id, epoch(ts) AS t, ts::DATE + (event_id % 3 - 1)::INT AS day FROM events)
WHERE t >= epoch(day::TIMESTAMP) - 7200 AND t < epoch(day::TIMESTAMP) + 86400 + 7200""")
def margin_days(spark, d):
    """Rows within two hours of a day that may be theirs, the one before or the one after."""
    rows = events(spark, d).select("event_id", (F.unix_micros("ts") / 1e6).alias("t"), F.date_add(F.to_date("ts"), (F.col("event_id") % 3 - 1).cast("int")).alias("day"))
    return spline.near_days(rows, "t", "day").select("event_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("""
SELECT c_custkey, (t // 10000)::INT AS cycle, (t % 10000)::INT AS pass, round(sqrt(dx * dx + dy * dy) * 111.0, 6) AS km FROM (
  SELECT c_custkey, (c_custkey % 900)::BIGINT * 10000 + c_custkey % 254 + 1 AS t, dy, dlon * cos((lat + lat + dy) / 2 * (pi() / 180)) AS dx
  FROM (SELECT c_custkey, (c_custkey % 120) - 60.0::DOUBLE AS lat, (c_custkey % 7) * 0.01::DOUBLE AS dy, (c_custkey % 11) * 0.02::DOUBLE AS dlon FROM customer))""")
def track_distance(spark, d):
    c = F.col
    rows = table(spark, d, "customer").select("c_custkey", (c("c_custkey") % 900).alias("cycle"), (c("c_custkey") % 254 + 1).alias("pass"), ((c("c_custkey") % 120) - 60.0).alias("lat"), ((c("c_custkey") % 7) * 0.01).alias("dy"), ((c("c_custkey") % 11) * 0.02).alias("dlon"))
    cycle, number = S.track_parts(c("track"))
    km = S.local_km(F.lit(0.0), c("lat"), c("dlon"), c("lat") + c("dy"))
    return readers.with_track(rows).select("c_custkey", cycle.alias("cycle"), number.alias("pass"), r6(km).alias("km"))


@query("""
SELECT event_id, (epoch_us(ts::TIMESTAMP) - 631152000000000)::DOUBLE / 1e6 AS time, (value / 3)::FLOAT::DOUBLE AS latitude,
  CASE WHEN event_id % 5 = 0 THEN 2147483647 ELSE user_id END AS pass, CASE WHEN event_type = 'error' OR event_id % 7 = 0 THEN 1.7976931348623157e308 ELSE value END AS ssha,
  CASE WHEN event_id % 3 = 2 THEN 127 ELSE event_id % 3 END AS quality_flag, CASE WHEN event_id % 3 = 2 THEN '127,1' ELSE concat_ws(',', event_id % 3, 1) END AS source_flag,
  event_type = 'error' OR event_id % 7 = 0 AS unknown FROM events""")
def product_encoding(spark, d):
    """Variables in the types and with the fill values of a product, and which heights are unknown once it is read again."""
    c = F.col
    flag = F.when(c("event_id") % 3 < 2, c("event_id") % 3)
    height = F.when(c("event_type") == "error", F.lit(float("nan"))).when(c("event_id") % 7 != 0, c("value"))
    daily = events(spark, d).select("event_id", c("ts").alias("time"), (c("value") / 3).alias("latitude"), F.when(c("event_id") % 5 != 0, c("user_id")).alias("pass"), height.alias("ssha"), flag.alias("quality_flag"), F.array(flag, F.lit(1)).alias("source_flag"))
    product = products.encoded(daily)
    known = products.decoded(product.select("*", F.struct("time", "latitude", "pass", "ssha", "quality_flag", "source_flag").alias("as_written")))
    return known.select("event_id", c("as_written.time").alias("time"), c("as_written.latitude").cast("double").alias("latitude"), c("as_written.pass").cast("long").alias("pass"), "as_written.ssha", c("as_written.quality_flag").cast("long").alias("quality_flag"), F.array_join("as_written.source_flag", ",").alias("source_flag"), c("ssha").isNull().alias("unknown"))


@query("""
SELECT o_orderkey, epoch_us(make_date(floor(t)::INT, 1, 1)::TIMESTAMP) // 1000000 + floor((t - floor(t)) * 31557600)::BIGINT AS second, strftime(strptime(n, '%Y%m%d'), '%Y-%m-%d') AS named, round(since, 3) AS since
FROM (SELECT o_orderkey, 1992 + (o_orderkey % 7000) / 1000.0::DOUBLE + 0.00001 AS t, strftime(o_orderdate, '%Y%m%d') AS n, (epoch(o_orderdate::TIMESTAMP) - epoch(TIMESTAMP '1990-01-01'))::DOUBLE AS since FROM orders)""")
def instants(spark, d):
    """Instants of decimal years, dates in file names, seconds since an epoch."""
    c = F.col
    name = F.concat(F.lit("alt_v1_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_12.nc"))
    t = 1992 + (c("o_orderkey") % 7000) / 1000.0 + 0.00001
    return table(spark, d, "orders").select("o_orderkey", F.floor(F.unix_micros(S.timestamp_of_decimal_year(t)) / 1e6).alias("second"), F.date_format(S.date_in_name(name), "yyyy-MM-dd").alias("named"), F.round(S.seconds_since(c("o_orderdate")), 3).alias("since"))


@query("SELECT event_id, 'merged' AS source, (event_id // 100)::INT AS cycle, round(least(greatest(value, 20), 80), 6) AS clipped FROM events WHERE abs(value - 50) < 40")
def small_and_clipped(spark, d):
    rows = events(spark, d).select("event_id", "value", (F.col("value") - 50).alias("ssha"))
    rows = readers.with_constants(flags.small_anomalies(rows, 40.0), source="merged", cycle=F.floor(F.col("event_id") / 100).cast("int"))
    return rows.select("event_id", "source", "cycle", r6(S.clipped(F.col("value"), 20.0, 80.0)).alias("clipped"))


@query("SELECT c_custkey AS key, c_acctbal AS balance, NULL::VARCHAR AS name FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier UNION ALL SELECT s_suppkey, s_acctbal, s_name FROM supplier WHERE s_acctbal > 5000")
def stacked_by_name(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    rich = s.where("s_acctbal > 5000").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return setops.stacked_tables(c.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance")), s.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), rich)


@query("SELECT replace('HDR created DATE for ' || r_name || ' DATE', 'DATE', '2024-05-06') AS value FROM region")
def header_dates(spark, d):
    template = table(spark, d, "region").select(F.concat(F.lit("HDR created DATE for "), F.col("r_name"), F.lit(" DATE")).alias("value"))
    return writers.header_lines(template, F.lit("2024-05-06"), "DATE")


@query("""
SELECT name, event_type AS source, strftime(ts::DATE, '%Y-%m-%d') AS obs_date, event_id, round(value * f, 6) AS value FROM events, (VALUES ('p2', 1), ('p3', 2)) AS p(name, f)""")
def committed_products(spark, d):
    """Two products committed together, after an earlier commit of some of their days."""
    root = f"{scratch_folder(spark)}/products-{uuid.uuid4().hex}"
    rows = events(spark, d).select("event_id", "value", F.col("event_type").alias("source"), F.to_date("ts").alias("obs_date"))
    scaled = lambda x, f: (x.withColumn("value", F.col("value") * f), ["source", "obs_date"])
    commits.commit(root, {n: scaled(rows.where(F.day("obs_date") == 9), 0) for n in ("p2", "p3")})
    commits.commit(root, {"p2": scaled(rows, 1), "p3": scaled(rows, 2)})
    both = [commits.committed(spark, root, n, rows.schema).withColumn("name", F.lit(n)) for n in ("p2", "p3")]
    return both[0].unionByName(both[1]).select("name", "source", F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"), "event_id", r6("value").alias("value"))


@query("SELECT event_type AS source, event_id, round(value::FLOAT::DOUBLE, 4) AS value, 'float' AS kind FROM events")
def float32_written(spark, d):
    """The events written with doubles as floats, by source, and read back."""
    path = f"{scratch_folder(spark)}/floats-{uuid.uuid4().hex}"
    writers.write_float32(events(spark, d).select(F.col("event_type").alias("source"), "event_id", "value"), path, ["source"])
    back = spark.read.parquet(path)
    return back.select("source", "event_id", F.round(F.col("value").cast("double"), 4).alias("value"), F.lit(dict(back.dtypes)["value"]).alias("kind"))


@query(f"WITH {LIST_SQL} SELECT source, cycle, true AS first, false AS again, true AS changed FROM o WHERE status = 'F'")
def list_written_once(spark, d):
    """A list is written, not written again with its own rows in another order, and written when a row is gone."""
    path = f"{scratch_folder(spark)}/list-{uuid.uuid4().hex}"
    rows = _listed(spark, d).where("status = 'F'").select("source", "cycle")
    first = writers.write_list_if_changed(rows, path, None)
    back = spark.read.schema(rows.schema).csv(path, header=True)
    again = writers.write_list_if_changed(rows.repartition(3), path, back)
    changed = writers.write_list_if_changed(rows.where("cycle % 2 = 0"), f"{path}-less", back)
    return back.select("source", "cycle", F.lit(first).alias("first"), F.lit(again).alias("again"), F.lit(changed).alias("changed"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_extendedprice / 105000 * 180 - 90) <= 66 AND l_partkey % 1100 > 0 AND l_partkey % 1100 < 1000 THEN round(l_discount, 6) END AS ssha, l_tax AS ssha_smoothed FROM lineitem""")
def legacy_masked(spark, d):
    """Older column names brought up to date, and values kept in the band and on ocean basins alone."""
    old = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("ssh"), F.col("l_tax").alias("ssh_smoothed"), (F.col("l_extendedprice") / 105000 * 180 - 90).alias("lat"), (F.col("l_partkey") % 1100).alias("basin"))
    rows = readers.renamed_legacy(old)
    value = F.when(indicators.in_band(F.col("lat")), indicators.ocean_only(F.col("ssha"), F.col("basin")))
    return rows.select("l_orderkey", "l_linenumber", r6(value).alias("ssha"), "ssha_smoothed")


@query("""
SELECT event_type AS source, strftime(ts::DATE, '%Y-%m-%d') AS obs_date, event_id, round(value, 6) AS value FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'""")
def written_window(spark, d):
    """The events written by source and day, some days written again, and a window of days read back by their partitions."""
    path = f"{scratch_folder(spark)}/events-{uuid.uuid4().hex}"
    rows = events(spark, d).select(F.col("event_type").alias("source"), F.to_date("ts").alias("obs_date"), "event_id", "value")
    old = rows.where(F.col("obs_date").between(F.lit(date(2024, 1, 10)), F.lit(date(2024, 1, 12))))
    writers.write_partitions(old.withColumn("value", F.col("value") * 0), path, ["source", "obs_date"])
    writers.write_partitions(rows, path, ["source", "obs_date"])
    back = readers.window_scan(spark, path, date(2024, 1, 5), date(2024, 1, 11))
    return back.select("source", F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"), "event_id", r6("value").alias("value"))
