"""Readers, writers, streaming and the stages end to end on synthetic tracks."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidewright import schemas, synth
from tidewright.operators import passes, tiles
from tidewright.plans import stages
from tidewright.sources import readers, writers
from tidewright.operators import crossover
from tidewright.streaming import incremental

DAY = datetime.date(2020, 3, 1)


@pytest.fixture(scope="module")
def granules(spark):
    pts = synth.ground_tracks(spark, tracks=10, points=1500, step_s=2)
    begin = F.unix_micros(F.lit(DAY).cast("timestamp"))
    return pts.select(
        F.lit("g1").alias("granule_id"), F.xxhash64("track", "t").alias("arrival"), F.timestamp_micros(begin + (F.col("t") * 1e6).cast("long")).alias("time"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("v").alias("ssha"), F.when(F.col("t") % 100 == 0, 2).otherwise(0).alias("flag"), F.lit(0).alias("surface_type"), F.lit(1).alias("cycle"), (F.col("track") % 10000).cast("int").alias("pass"),
    )


@pytest.fixture(scope="module")
def mss(spark):
    return spark.range(19 * 38).select((F.col("id") / 38).cast("int").alias("lat_i"), (F.col("id") % 38).cast("int").alias("lon_i"), F.lit(0.01).alias("value"))


def world(spark):
    ring = [{"x": -181.0, "y": -91.0}, {"x": 181.0, "y": -91.0}, {"x": 181.0, "y": 91.0}, {"x": -181.0, "y": 91.0}]
    return spark.createDataFrame([(1, "World Sea", ring)], schemas.POLYGON)


def test_from_granules_to_grids(spark, granules, mss, tmp_path):
    daily = stages.processor("merged")(granules, None, world(spark), mss, {"lat0": -90.0, "lon0": 0.0, "step": 10.0})
    writers.write_daily(daily, str(tmp_path / "daily"))
    p1 = spark.read.parquet(str(tmp_path / "daily"))
    assert p1.count() == granules.count()
    bad = p1.where("quality_flag = 1").count()
    assert 0 < bad < 0.2 * p1.count()
    assert p1.where("ssha_smoothed IS NOT NULL").count() > 0.8 * p1.count()
    x = stages.crossover_table(p1)
    writers.write_crossovers(x, str(tmp_path / "xover"))
    x = spark.read.parquet(str(tmp_path / "xover"))
    assert x.count() > 5
    before = x.agg(F.stddev(F.col("ssh1") - F.col("ssh2"))).first()[0]
    polynomial, correction, p2 = stages.orbit_correction(x, p1)
    assert correction.count() == p1.count() and polynomial.count() > 0
    p2.write.parquet(str(tmp_path / "p2"))
    p2 = spark.read.parquet(str(tmp_path / "p2"))
    after = stages.crossover_table(p2, "p2").agg(F.stddev(F.col("ssh1") - F.col("ssh2"))).first()[0]
    assert after < before
    listed = stages.bad_pass_table(x, p2).unionByName(p2.select("source", F.col("obs_date").alias("date"), "cycle", "pass").where("pass = 3").distinct())
    p3 = stages.finalized(p2, listed)
    assert p3.where("pass = 3 AND quality_flag <> 1").count() == 0 and p3.where("quality_flag = 1 AND ssha_smoothed IS NOT NULL").count() == 0
    cells = synth.cells(spark, 12, 24)
    mondays = spark.createDataFrame([(datetime.date(2020, 3, 2),), (datetime.date(2020, 3, 30),)], "grid_date date")
    grids = stages.weekly_grid(p3, cells, spark.createDataFrame([(1, 1), (2, 1)], schemas.BASIN_LINKS), mondays, reach=2.5e6, sigma=1e6, k=20, least=100)
    n = {str(r.grid_date): r.n for r in grids.groupBy("grid_date").agg(F.count("ssha").alias("n")).collect()}
    assert n["2020-03-02"] > 50 and n["2020-03-30"] == 0
    season = cells.select("cell", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("m")).select("cell", ((F.col("m") + 0.5) / 12).alias("at"), F.lit(1.0).alias("value"))
    trend = cells.select("cell", F.lit(0.001).alias("slope"), F.lit(0.5).alias("offset"))
    ocean = [(r, c, v) for r, c, v in synth.stencil(12, 24) if r % 12 and c % 12]
    anomaly = stages.anomaly_grid(grids.where("grid_date = '2020-03-02'"), ocean, 3, season, trend)
    assert anomaly.where("anomaly IS NOT NULL").count() > 200
    tiled = stages.anomaly_grid(grids.where("grid_date = '2020-03-02'"), ocean, 3, season, trend, tiles.squares(24, 12))
    pairs = anomaly.join(tiled.select("cell", F.col("anomaly").alias("again")), "cell")
    assert pairs.count() == anomaly.count() and pairs.where("NOT (abs(anomaly - again) < 1e-9 OR coalesce(anomaly, again) IS NULL)").count() == 0
    targets = spark.range(72 * 4).select((F.col("id") / 72).cast("int").alias("row"), (F.col("id") % 72).cast("int").alias("col")).select("row", "col", (F.col("row") * 5.0 - 8).alias("lat"), (F.col("col") * 5.0 + 2.5).alias("lon"), F.lit(1).alias("basin_id"))
    fine = stages.quarter_degree(anomaly, cells, -82.5, 7.5, 15.0, 24, targets)
    assert fine.where("value IS NOT NULL").count() > 200


def test_unknown_source():
    with pytest.raises(ValueError, match="unknown source"):
        stages.processor("other")


def test_reduced_stage(spark, granules, mss):
    extra = {"surface_class": F.lit(0), "range_qual": F.lit(0), "rain_flag": F.lit(0), "radiometer_qual": F.lit(0), "sigma0": F.lit(12.0), "swh": F.lit(2.0), "dac": F.lit(0.0), "mss1": F.lit(1.0), "mss2": F.lit(1.0)}
    out = stages.reduced_daily(granules.drop("flag", "surface_type").withColumns(extra), world(spark), mss, {"lat0": -90.0, "lon0": 0.0, "step": 10.0})
    assert {"ssha_smoothed", "source_flag", "quality_flag"} <= set(out.columns) and out.where("quality_flag = 0").count() > 0


def test_catalog(spark):
    rec = lambda i, title, c, rel="s3": {"id": str(i), "title": title, "links": [{"rel": "x", "href": "h0"}, {"rel": rel, "href": f"h{i}"}], "time_start": None, "time_end": None, "updated": None, "collection": c}
    cat = readers.catalog_table(spark, [rec(1, "A_001_002_x", "late"), rec(2, "A_001_002_y", "best"), rec(3, "A_001_003_x", "late"), rec(4, "no key", "best")])
    got = readers.best_granules(readers.granules_of(cat, "s3").withColumn("seq", F.col("id").cast("int")), {"best": 0, "late": 1}).collect()
    assert [(r.cycle_pass, r.href) for r in got] == [("001_002", "h2"), ("001_003", "h3")]
    with pytest.raises(Exception, match="no link for"):
        readers.granules_of(readers.catalog_table(spark, [rec(9, "t", "c", rel="other")]), "s3").collect()
    assert readers.of_collection(cat, "best").count() == 2


def test_catalog_query_is_tried_again():
    calls, pauses = [], []

    def fetch(collection, begin, end):
        calls.append((collection, begin, end))
        if len(calls) < 3:
            raise RuntimeError("busy")
        return [{"id": "1"}]

    assert readers.query_catalog(fetch, "c", DAY, sleep=pauses.append) == [{"id": "1"}]
    assert pauses == [15.0, 15.0] and calls[0][2] == datetime.datetime(2020, 3, 1, 23, 59, 59)


def test_scans(spark, tmp_path):
    df = spark.createDataFrame([(datetime.date(2020, 1, d), d) for d in range(1, 11)], "obs_date date, v int")
    writers.write_partitions(df, str(tmp_path / "t"), ["obs_date"])
    scan = readers.window_scan(spark, str(tmp_path / "t"), datetime.date(2020, 1, 3), datetime.date(2020, 2, 1))
    assert scan.count() == 8 and "PartitionFilters: [isnotnull(obs_date" in scan._jdf.queryExecution().toString()
    writers.write_partitions(spark.createDataFrame([(datetime.date(2020, 1, 3), 99)], df.schema), str(tmp_path / "t"), ["obs_date"])
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.sum("v")).first()[0] == 55 - 3 + 99
    df.limit(2).coalesce(1).write.parquet(str(tmp_path / "named" / "x_20200105.d"))
    assert readers.file_times(spark, str(tmp_path / "named"), "*.parquet").count() == 1
    (tmp_path / "basin.txt").write_text("1:1,2,2\n2: 2\n")
    assert readers.adjacency(spark.read.text(str(tmp_path / "basin.txt"))).count() == 3
    (tmp_path / "c.txt").write_text("0 128 255\n1 2 3\n")
    assert readers.colours(spark.read.text(str(tmp_path / "c.txt"))).orderBy("place").first()["g"] == 0.5
    (tmp_path / "lut.csv").write_text("id,pass\n0010002,7\n")
    assert readers.pass_lookup(spark, str(tmp_path / "lut.csv")).first().id == "0010002"
    nested = spark.createDataFrame([(1, 2, ((0.5,), 3.0))], "cycle_number int, pass_number int, data struct<ku:struct<ssha:double>,dac:double>")
    assert sorted(readers.reduced_granules(nested).columns) == ["cycle", "dac", "pass", "ssha"]
    assert readers.renamed_legacy(spark.createDataFrame([(1.0,)], "ssh double")).columns == ["ssha"]
    assert readers.version_step("p2") == 2


def test_corrupt_files_are_skipped(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "a"))
    (tmp_path / "a" / "part-bad.parquet").write_bytes(b"not parquet at all")
    assert readers.parquet(spark, str(tmp_path / "a"), spark.range(1).schema, skip_corrupt=True).count() == 3


def test_merged_reader(spark):
    g = spark.createDataFrame([("g", 5, None, 1.0, 2.0, 100.0, 1, 2, 0, 0)], schemas.GRANULE_MERGED)
    r = readers.merged_granules(g, spark.createDataFrame([("0010002", 7)], schemas.PASS_LOOKUP)).first()
    assert (r.ssha, r["pass"], r.cycle, r.latitude) == (0.1, 7, 5, 1.0)


def test_list_is_written_only_when_changed(spark, tmp_path):
    df = spark.createDataFrame([("merged", DAY, 1, 66)], schemas.BAD_PASS)
    path = str(tmp_path / "list")
    assert writers.write_list_if_changed(df, path, None)
    assert not writers.write_list_if_changed(df, path, readers.bad_pass_list(spark, path))
    more = passes.updated_list(df, df.limit(0), spark.createDataFrame([("merged", DAY, 2, 3)], schemas.BAD_PASS))
    assert writers.write_list_if_changed(spark.createDataFrame(more.collect(), schemas.BAD_PASS), path, readers.bad_pass_list(spark, path))
    assert readers.bad_pass_list(spark, path).count() == 2


def test_indicator_text(spark, tmp_path):
    s = spark.createDataFrame([(1993.5, 1.25, 2.5), (1993.25, -0.5, None)], "time double, gmsl double, smoothed_gmsl double")
    lines = [r.value for r in writers.indicator_lines(s.na.fill(0.0), "gmsl").collect()]
    assert lines == ["1993.2500000    -0.500000     0.000000", "1993.5000000     1.250000     2.500000"]
    writers.write_indicator_text(s, "gmsl", str(tmp_path / "t"))
    head = spark.createDataFrame([("made PLACEHOLDER_CREATION_DATE",)], "value string")
    assert writers.header_lines(head, F.lit("2020-01-01")).first().value == "made 2020-01-01"


@pytest.mark.parametrize("schema", [schemas.DAILY, schemas.CROSSOVER, schemas.POLYNOMIAL, schemas.GRID, schemas.INDICATORS], ids=lambda s: s.names[-1])
def test_empty_tables_keep_their_schema(spark, tmp_path, schema):
    df = writers.empty(spark, schema)
    assert df.schema == schema and df.count() == 0


def test_empty_input_goes_through_the_stages(spark, granules, mss):
    none = granules.where("1 = 0")
    daily = stages.merged_daily(none, None, world(spark), mss, {"lat0": -90.0, "lon0": 0.0, "step": 10.0})
    assert daily.count() == 0
    assert stages.bad_pass_table(writers.empty(spark, schemas.CROSSOVER), daily).count() == 0


def test_metadata_rows(spark):
    rows = writers.metadata(spark, "d", {"": {"Title": "t", "abstract": "a"}}).collect()
    assert [r.key for r in rows] == ["abstract", "Title"]


def test_incremental_run_keeps_all_batches_of_a_day(spark, tmp_path):
    source, out, store = (str(tmp_path / n) for n in ("in", "out", "store"))
    df = spark.createDataFrame([(datetime.date(2020, 1, d % 3 + 1), d) for d in range(9)] + [(None, 1)], "day date, v int")
    sums = lambda rows, days: rows.groupBy("day").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))

    def run():
        stream = incremental.arrivals(spark, source, df.schema, files_per_batch=1)
        incremental.run_incremental(stream, sums, store, out, ["day"], str(tmp_path / "cp"), "day").awaitTermination()
        return {r.day.day: (r.v, r.n) for r in spark.read.parquet(out).collect()}

    df.coalesce(1).write.mode("append").parquet(source)
    assert run() == {1: (9, 3), 2: (12, 3), 3: (15, 3)} == run()
    more = spark.createDataFrame([(datetime.date(2020, 1, 2), 100), (datetime.date(2020, 1, 5), 1)], df.schema)
    more.coalesce(1).write.mode("append").parquet(source)  # day 2 comes once more
    assert run() == {1: (9, 3), 2: (112, 4), 3: (15, 3), 5: (1, 1)}
    for _ in range(2):  # a batch that is repeated changes nothing more
        incremental.processed_batch(more, 1, sums, store, out, ["day"], "day", "day")
    assert {r.day.day: r.v for r in spark.read.parquet(out).collect()} == {1: 9, 2: 112, 3: 15, 5: 1}
    assert incremental.affected_outputs(df.where("day IS NOT NULL"), "day", 5, 4).count() == 12


def test_incremental_crossovers_meet_late_days(spark, tmp_path):
    begin = datetime.date(2020, 3, 1)
    pts = synth.ground_tracks(spark, tracks=18, points=400).withColumn("day", F.date_add(F.lit(begin), F.floor(F.col("t") / 10000).cast("int")))
    pts = pts.where("v IS NOT NULL").cache()
    day_of = lambda x: x.withColumn("first_day", F.date_add(F.lit(begin), F.floor(F.col("time1") / 10000).cast("int")))
    found = lambda rows, days: day_of(crossover.crossovers(rows.drop("day")))
    paths = [str(tmp_path / n) for n in ("store", "out")]
    days = sorted(r.day for r in pts.select("day").distinct().collect())
    late = days[2]
    for number, some in enumerate(([x for x in days if x != late], [late])):
        batch = pts.where(F.col("day").isin(some))
        incremental.processed_batch(batch, number, found, *paths, ["first_day"], "day", "first_day", after=len(days))
    columns = ["first_day", *[c for c in found(pts, None).columns if c != "first_day"]]
    rounded = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*columns).collect())
    want = rounded(found(pts, None))
    assert rounded(spark.read.parquet(paths[1])) == want and len(want) > 10
    pts.unpersist()
