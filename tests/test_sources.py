"""Shapefiles, NetCDF files, product writers and small functions."""

import datetime
import math
import struct
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright import schemas
from tidewright.functions import scalars
from tidewright.operators import flags, lookups, polygons, setops, spline
from tidewright.plans import stages
from tidewright.sources import commits, netcdf, products, readers, shapes, writers

DAY = datetime.date(2020, 3, 1)


def shp(records):
    """A .shp file of polygons; a record is a list of rings or None."""
    body = b""
    for k, rings in enumerate(records, 1):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            begins = np.cumsum([0, *map(len, rings)])[:-1].tolist()
            box = (min(x for x, _ in points), min(y for _, y in points), max(x for x, _ in points), max(y for _, y in points))
            content = struct.pack("<i4d2i", 5, *box, len(rings), len(points)) + struct.pack(f"<{len(begins)}i", *begins) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">2i", k, len(content) // 2) + content
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    return head + body


def dbf(rows, widths):
    head = struct.pack("<4BIHH20x", 3, 120, 1, 1, len(rows), 32 + 32 * len(widths) + 1, 1 + sum(widths.values()))
    for name, width in widths.items():
        head += name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([width]) + b"\0" * 15
    return head + b"\r" + b"".join(b" " + b"".join(str(row[n]).encode().ljust(w) for n, w in widths.items()) for row in rows) + b"\x1a"


def test_shapefile_polygons_are_looked_up(spark, tmp_path):
    square = [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0), (0.0, 0.0)]
    hole = [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0), (2.0, 2.0)]
    far = [(x + 50, y) for x, y in square]
    (tmp_path / "sea.shp").write_bytes(shp([[square, hole], None, [far]]))
    (tmp_path / "sea.dbf").write_bytes(dbf([{"feature_id": 7, "name": "Sea: 'One', west"}, {"feature_id": 8, "name": "none"}, {"feature_id": 9.0, "name": "Far Sea"}], {"feature_id": 6, "name": 20}))
    found = shapes.shapefile(spark, str(tmp_path))
    assert [(r.record, r.part, r.hole, len(r.ring)) for r in found.orderBy("record", "part").collect()] == [(0, 0, False, 5), (0, 1, True, 5), (2, 0, False, 5)]
    basins = shapes.basins(found)
    assert [f.dataType for f in basins.schema][1:] == [f.dataType for f in schemas.POLYGON]
    names = {r.feature_id: (r.line, r.meaning) for r in shapes.basin_names(basins).collect()}
    assert names == {0: ("0,Land", None), 7: ("7,Sea:  One  - west", "Sea__One__-_west"), 9: ("9,Far Sea", "Far_Sea")}
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 55.0, 1.0), (3, 30.0, 1.0), (4, 3.0, 3.0)], "point int, lon double, lat double")
    assert {r.point: r.basin_flag for r in polygons.point_in_polygon(points, basins, "lon", "lat", "point").collect()} == {1: 7, 2: 9, 3: 0, 4: 0}  # 4 is in the hole
    with pytest.raises(ValueError, match="no shapefile"):
        list(shapes.rings_of(b"x" * 200))
    with pytest.raises(ValueError, match="no polygons"):
        list(shapes.rings_of(shp([])[:100] + struct.pack(">2i", 1, 10) + struct.pack("<i2d", 1, 0.0, 0.0)))


def cdf(version, dims, attributes, variables, records=0):
    """A file of a classic NetCDF format; variables: name -> (dimensions, attributes, array)."""
    wide = version == 5
    count = lambda n: struct.pack(">q" if wide else ">i", n)
    code = {"i1": 1, "i2": 3, "i4": 4, "f4": 5, "f8": 6}
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    text = lambda s: count(len(s)) + pad(s.encode())

    def attrs(a):
        out = struct.pack(">i", 12 if a else 0) + count(len(a))
        for k, v in a.items():
            if isinstance(v, str):
                out += text(k) + struct.pack(">i", 2) + count(len(v)) + pad(v.encode())
            else:
                v = np.atleast_1d(v)
                out += text(k) + struct.pack(">i", code[v.dtype.str[1:]]) + count(len(v)) + pad(v.astype(v.dtype.newbyteorder(">")).tobytes())
        return out

    names = list(dims)
    grows = lambda v: v[0] and dims[v[0][0]] == 0
    raw = {k: np.asarray(v[2]).astype(np.asarray(v[2]).dtype.newbyteorder(">")) for k, v in variables.items()}
    size = {k: len(pad((raw[k][:1] if grows(v) else raw[k]).tobytes())) for k, v in variables.items()}

    def head(begin):
        out = b"CDF" + bytes([version]) + count(records) + struct.pack(">i", 10) + count(len(dims)) + b"".join(text(k) + count(n) for k, n in dims.items()) + attrs(attributes)
        out += struct.pack(">i", 11) + count(len(variables))
        for k, (d, a, x) in variables.items():
            out += text(k) + count(len(d)) + b"".join((count if wide else lambda n: struct.pack(">i", n))(names.index(i)) for i in d) + attrs(a)
            out += struct.pack(">i", code[np.asarray(x).dtype.str[1:]]) + count(size[k]) + struct.pack(">i" if version == 1 else ">q", begin.get(k, 0))
        return out

    begin, at = {}, len(head({}))
    fixed, growing = [k for k in variables if not grows(variables[k])], [k for k in variables if grows(variables[k])]
    for k in [*fixed, *growing]:
        begin[k] = at
        at += size[k]
    data = head(begin) + b"".join(pad(raw[k].tobytes()) for k in fixed)
    return data + b"".join(pad(raw[k][n : n + 1].tobytes()) for n in range(records) for k in growing)


@pytest.mark.parametrize("version", [1, 2, 5])
def test_classic_netcdf(spark, tmp_path, version):
    ssha = np.array([100, -32767, -50, 7, 9], np.int16)
    time = np.arange(5) * 0.5
    for k in range(3):
        data = cdf(version, {"N_Records": 0, "nv": 2}, {"merged_cycle": np.int32(5 + k), "title": "a granule"}, {
            "time": (("N_Records",), {"units": "seconds"}, time + k), "ssha": (("N_Records",), {"scale_factor": np.float64(0.001)}, ssha),
            "bounds": (("N_Records", "nv"), {}, np.zeros((5, 2), np.float32)), "flag": (("N_Records",), {"_FillValue": np.int8(9)}, np.array([0, 1, 9, 0, 1], np.int8)),
        }, records=5)
        (tmp_path / f"g{k}.nc").write_bytes(data)
    rows = netcdf.granules(spark, str(tmp_path), {"time": "time", "ssha": "ssha", "flag": "flag"}, {"merged_cycle": "merged_cycle"})
    got = [tuple(r) for r in netcdf.timed(rows).orderBy("granule_id", "row_index").collect()]
    begin = datetime.datetime(1990, 1, 1)
    value = lambda x: None if x == -32767 else x * 0.001
    assert len(got) == 15 and [g[0] for g in got[::5]] == ["g0.nc", "g1.nc", "g2.nc"]
    assert [(g[1], g[4], g[5]) for g in got[5:10]] == [(i, None if f == 9 else float(f), 6.0) for i, f in enumerate([0, 1, 9, 0, 1])]
    assert [g[3] for g in got[:5]] == [None if x == -32767 else pytest.approx(value(int(x))) for x in ssha]
    assert got[1][2].replace(tzinfo=None) == begin + datetime.timedelta(seconds=0.5) or got[1][2] is not None
    with pytest.raises(Exception, match="no variable 'sla'"):
        netcdf.granules(spark, str(tmp_path), {"x": "sla"}).collect()


def test_reference_grid(spark, tmp_path):
    z = np.arange(12.0).reshape(3, 4)
    z[1, 1] = 9.969209968386869e36
    (tmp_path / "mss.nc").write_bytes(cdf(2, {"latitude": 3, "longitude": 4}, {}, {"latitude": (("latitude",), {}, np.array([-10.0, 0.0, 10.0])), "longitude": (("longitude",), {}, np.arange(4) * 90.0), "mss": (("latitude", "longitude"), {}, z)}))
    got = netcdf.reference_grid(spark, str(tmp_path), "mss").orderBy("lat_i", "lon_i").collect()
    assert [(r.lat_i, r.lon_i, r.latitude, r.longitude, r.value) for r in got] == [(i, j, -10.0 + 10 * i, 90.0 * j, None if (i, j) == (1, 1) else z[i, j]) for i in range(3) for j in range(4)]
    points = spark.createDataFrame([(5.0, 45.0)], "lat double, lon double")
    assert lookups.bilinear(points, netcdf.reference_grid(spark, str(tmp_path), "mss"), "lat", "lon", -10.0, 0.0, 10.0, "v").count() == 1


def test_files_of_groups_need_their_package(monkeypatch):
    with pytest.raises(ValueError, match="no NetCDF"):
        netcdf.opened(b"something else")
    monkeypatch.setitem(sys.modules, "netCDF4", None)
    with pytest.raises(RuntimeError, match="netCDF4"):
        netcdf.opened(b"\x89HDF\r\n")

    class Var:
        def __init__(self, data, **attrs):
            self.data, self.attrs, self.dimensions = np.array(data), attrs, ("time",)

        def __getitem__(self, _):
            return self.data

        def ncattrs(self):
            return list(self.attrs)

        def getncattr(self, k):
            return self.attrs[k]

    class Group:
        def __init__(self, variables, groups):
            self.variables, self.groups = variables, groups

    ku = Group({"ssha_nr": Var([1, 2, -1], scale_factor=0.5, _FillValue=-1)}, {})

    class Dataset(Group):
        def __init__(self, *_, memory):
            super().__init__({}, {"data_01": Group({"latitude": Var([3.0, 4.0, 5.0])}, {"ku": ku})})

        def set_auto_maskandscale(self, on):
            assert not on

        def ncattrs(self):
            return ["cycle_number"]

        def getncattr(self, _):
            return 12

    monkeypatch.setitem(sys.modules, "netCDF4", types.SimpleNamespace(Dataset=Dataset))
    f = netcdf.opened(b"\x89HDF\r\n")
    assert f.attributes == {"cycle_number": 12} and set(f.variables) == {"data_01/latitude", "data_01/ku/ssha_nr"}
    np.testing.assert_array_equal(f.variables["data_01/ku/ssha_nr"].decoded(), [0.5, 1.0, np.nan])


def test_product_attributes(spark):
    t = lambda s: datetime.datetime(2020, 3, 1, 0, 0, s)
    daily = spark.createDataFrame([("merged", DAY, t(5)), ("merged", DAY, t(9))], "source string, obs_date date, time timestamp")
    days = spark.createDataFrame([("merged", DAY), ("merged", datetime.date(2020, 3, 2))], "source string, obs_date date")
    rows = writers.product_attributes(daily, days, "2024-01-01T00:00:00", {"title": "A title"}).collect()
    one = [(r.key, r.value) for r in rows if r.obs_date == DAY]
    assert len(one) == 38 and [k for k, _ in one] == sorted((k for k, _ in one), key=str.lower)
    assert dict(one)["title"] == "A title" and dict(one)["time_coverage_start"] == "2020-03-01T00:00:05Z" and dict(one)["summary"] == "" and "comment" not in dict(one)
    other = {r.key: r.value for r in rows if r.obs_date != DAY}
    assert other["comment"] == writers.NO_DATA and (other["time_coverage_start"], other["time_coverage_end"]) == ("2020-03-02T00:00:00Z", "2020-03-02T23:59:59Z")


def test_products_keep_types_fills_and_attributes(spark, tmp_path):
    t = datetime.datetime(2020, 3, 1, 5, 6, 7, 123457)
    rows = [("merged", "p1", DAY, t, 1.5, 2.25, 3, 4, 0.125, None, float("nan"), 7, 0, None, [0, None]), ("merged", "p1", DAY, None, None, None, None, None, -1e300, 0.5, 0.25, None, None, 1, None)]
    daily = spark.createDataFrame(rows, schemas.DAILY)
    products.write_products(daily, str(tmp_path), {"ssha": {"mean_sea_surface": "a mean surface"}})
    raw = spark.read.parquet(str(tmp_path))
    first = raw.where("time IS NOT NULL").first()
    assert first.time == pytest.approx(951887167.123457, abs=1e-6) and first.ssha_smoothed == first.dac == products.DOUBLE_FILL and first.median_flag == 127 and first.source_flag == [0, 127]
    kinds = dict(raw.dtypes)
    assert (kinds["latitude"], kinds["time"], kinds["pass"], kinds["quality_flag"], kinds["ssha"]) == ("float", "double", "int", "tinyint", "double")
    back = products.read_products(spark, str(tmp_path))
    got = {r.ssha: r for r in back.select(*daily.columns).collect()}
    for want in daily.collect():
        for k, v in want.asDict().items():
            assert got[want.ssha][k] == (None if isinstance(v, float) and math.isnan(v) else v), k
    listed = {(r.variable, r.key): r.value for r in products.variable_attributes(raw).collect()}
    assert listed["ssha", "mean_sea_surface"] == "a mean surface" and listed["time", "units"] == products.SINCE_1990 and listed["quality_flag", "flag_values"] == "[0, 1]"
    assert listed["cycle", "_FillValue"] == "2147483647" and ("latitude", "_FillValue") not in listed and not any(v == "source" for v, _ in listed)
    keys = [r.key for r in products.variable_attributes(raw).where("variable = 'ssha'").collect()]
    assert keys == sorted(keys, key=str.lower) and len(keys) == 10
    assert products.decoded(products.encoded(daily.where("1 = 0"))).count() == 0
    wrong = spark.createDataFrame([(300,)], "quality_flag int")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        products.encoded(wrong).collect()


def test_indicator_files_and_their_archive(spark, tmp_path):
    series = spark.createDataFrame([(1993.5, 1.0, 2.0, 3.0, 4.0, 5.0), (1993.1, 0.5, 2.5, 3.5, 4.5, 5.5)], schemas.INDICATORS)
    places = writers.write_indicators(series, str(tmp_path), DAY)
    assert "archive/GMSL/gmsl_20200301.txt" in places and "archive/ENSO/enso_20200301.mp" in places and len(places) == 1 + 4 * 4
    lines = [r.value for r in spark.read.text(str(tmp_path / "gmsl.txt")).collect()]
    assert [float(x.split()[0]) for x in lines] == [1993.1, 1993.5] and lines == [r.value for r in spark.read.text(str(tmp_path / "archive/GMSL/gmsl_20200301.txt")).collect()]
    side = spark.read.json(str(tmp_path / "gmsl.mp")).first()
    assert side.name == "gmsl.txt" and side["size"] == sum(len(x) + 1 for x in lines) and spark.read.parquet(str(tmp_path / "indicators")).count() == 2


def test_grids_polynomials_and_corrections_are_written(spark, tmp_path):
    grid = spark.createDataFrame([(DAY, 1, 2, 10.0, 20.0, 0.5, 3, 1)], schemas.GRID)
    assert [writers.write_grids(grid, str(tmp_path), s, r).removeprefix(str(tmp_path)) for s, r in ((None, None), (None, "quart"), ("merged", "quart"))] == ["/p3", "/quart", "/p2/merged"]
    back = spark.read.parquet(str(tmp_path / "p2" / "merged"))
    assert back.first().year == 2020 and dict(back.dtypes)["latitude"] == "float" and dict(back.dtypes)["ssha"] == "double"
    row = ("merged", DAY, 0, *[0.5] * 8, 4)
    writers.write_polynomials(spark.createDataFrame([row], schemas.POLYNOMIAL), str(tmp_path / "poly"))
    writers.write_corrections(spark.createDataFrame([("merged", datetime.datetime(2020, 3, 1, 5), 0.1)], schemas.CORRECTION), str(tmp_path / "oer"))
    assert (tmp_path / "poly" / "source=merged" / "date=2020-03-01").exists() and (tmp_path / "oer" / "source=merged" / "date=2020-03-01").exists()
    writers.write_float32(grid, str(tmp_path / "small"), ["grid_date"])
    assert dict(spark.read.parquet(str(tmp_path / "small")).dtypes)["ssha"] == "float"


def test_small_functions(spark, tmp_path):
    one = spark.createDataFrame([(1, -0.5, 3.0), (2, None, -3.0), (3, 0.5, None)], "k int, x double, ssha double")
    clip = one.select("k", scalars.clipped(F.col("x"), -0.25, 0.25).alias("c"), scalars.clipped(F.col("x"), low=0.0).alias("d")).orderBy("k").collect()
    assert [(r.c, r.d) for r in clip] == [(-0.25, 0.0), (None, None), (0.25, 0.5)]
    assert [r.k for r in flags.small_anomalies(one, 3.5).orderBy("k").collect()] == [1, 2]
    assert setops.stacked_tables(one.select("k"), one.select("x"), one.select("k", "x")).count() == 9
    t = spark.createDataFrame([(datetime.datetime(1990, 1, 2, 0, 0, 1),)], "t timestamp")
    assert t.select(scalars.seconds_since(F.col("t"))).first()[0] == 86401.0
    poly = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "c3 double, c2 double, c1 double, c0 double")
    assert poly.select(spline.horner(F.lit(2.0))).first()[0] == 8 + 8 + 6 + 4
    begin = datetime.datetime(2020, 3, 1, tzinfo=datetime.timezone.utc).timestamp()
    near = spark.createDataFrame([(DAY, begin + s) for s in (-7201.0, -7200.0, 0.0, 93599.0, 93600.0)], "day date, t double")
    assert spline.near_days(near, "t", "day").count() == 3
    track = readers.with_constants(readers.with_track(spark.createDataFrame([(3, 7)], "cycle int, pass int")), source="merged", n=F.lit(2)).first()
    assert (track.track, track.source, track.n) == (30007, "merged", 2)
    for day in ("20200301", "20200305"):
        one.coalesce(1).write.parquet(str(tmp_path / "named" / day))
        part = next((tmp_path / "named" / day).glob("part-*.parquet"))
        part.rename(tmp_path / "named" / f"x_{day}.parquet")
    scan = readers.named_window_scan(spark, str(tmp_path / "named"), datetime.date(2020, 3, 2), datetime.date(2020, 3, 9))
    assert {str(r.file_date) for r in scan.collect()} == {"2020-03-05"}
    assert writers.errors_as_json(one.limit(1), key=F.col("k"), fault=F.lit("x")).first().json == '{"key":1,"fault":"x"}'
    blank = spark.createDataFrame([(DAY,)], "d date").select(*[c.alias(k) for k, c in writers.empty_day_metadata(F.col("d")).items()]).first()
    assert tuple(blank) == ("2020-03-01T00:00:00Z", "2020-03-01T23:59:59Z")


def test_stages_of_empty_tables(spark):
    """No rows give no rows, with the columns of the tables that stages exchange."""
    daily = spark.createDataFrame([], schemas.DAILY)
    x = stages.crossover_table(daily)
    assert x.count() == 0 and {f.name for f in schemas.CROSSOVER} <= set(x.columns)
    polynomial, correction, p2 = stages.orbit_correction(x, daily)
    assert polynomial.count() == correction.count() == p2.count() == 0
    listed = stages.bad_pass_table(x, daily)
    assert listed.count() == 0 and stages.finalized(daily, listed).count() == 0
    cells = spark.createDataFrame([(1, 0.0, 0.0, 1, 0, 0)], "cell int, lat double, lon double, basin_id int, lat_i int, lon_i int")
    mondays = spark.createDataFrame([(DAY,)], "grid_date date")
    grids = stages.weekly_grid(daily, cells, spark.createDataFrame([(1, 1)], schemas.BASIN_LINKS), mondays)
    assert [(r.ssha, r.counts, r.deviation) for r in grids.collect()] == [(None, 0, None)]
    assert stages.weekly_grid(daily, cells, spark.createDataFrame([(1, 1)], schemas.BASIN_LINKS), mondays.limit(0)).count() == 0
    season = spark.createDataFrame([(1, 0.5, 1.0)], "cell int, at double, value double")
    trend = spark.createDataFrame([(1, 0.0, 0.0)], "cell int, slope double, offset double")
    assert stages.anomaly_grid(grids.limit(0), [(1, 1, 0.0)], 2, season, trend).count() == 0


def test_sources_do_not_meet_in_crossovers(spark):
    """Two sources in one job give what each gives alone."""
    rows = []
    for s, shift in (("a", 0.0), ("b", 0.3)):
        for n in range(4):
            for k in range(60):
                lat = (k * 0.16 - 5) * (1 if n % 2 else -1)
                rows.append((s, DAY, datetime.datetime(2020, 3, 1) + datetime.timedelta(seconds=n * 900 + k * 10), lat + shift, 10.0 + n * 2 + k * 0.16, 1, n + 1, 0.1 * n))
    daily = spark.createDataFrame(rows, "source string, obs_date date, time timestamp, latitude double, longitude double, cycle int, pass int, ssha_smoothed double")
    key = lambda df: sorted((r.source, r.pass1, r.pass2, round(r.lon, 6), round(r.lat, 6)) for r in df.collect())
    both = key(stages.crossover_table(daily))
    assert both == sorted(key(stages.crossover_table(daily.where("source = 'a'"))) + key(stages.crossover_table(daily.where("source = 'b'")))) and len({x[0] for x in both}) == 2


def test_products_are_committed_together_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "products")
    rows = lambda f, days: spark.createDataFrame([(d * f, d) for d in days], "v int, day int")
    seen = lambda n: sorted(tuple(r) for r in commits.committed(spark, root, n, rows(1, []).schema).collect())
    assert seen("p2") == [] and commits.manifest(spark, root) == {}
    assert commits.commit(root, {"p2": (rows(1, range(3)), ["day"]), "p3": (rows(10, range(3)), ["day"])}) == 1
    first = (seen("p2"), seen("p3"))
    assert first == ([(0, 0), (1, 1), (2, 2)], [(0, 0), (10, 1), (20, 2)])
    broken = rows(7, range(5)).withColumn("v", F.when(F.col("day") == 4, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):  # p2 is written by then
        commits.commit(root, {"p2": (rows(7, range(5)), ["day"]), "p3": (broken, ["day"])})
    assert (seen("p2"), seen("p3")) == first
    assert commits.swept(spark, root) >= 1 and (seen("p2"), seen("p3")) == first
    assert commits.commit(root, {"p2": (rows(5, [2, 3]), ["day"]), "p3": (rows(5, []), ["day"])}) == 2
    assert seen("p2") == [(0, 0), (1, 1), (10, 2), (15, 3)] and seen("p3") == first[1]
    with pytest.raises(RuntimeError, match="another run"):
        commits._publish(spark, root, 2, {})
    assert seen("p3") == first[1]
    odd = spark.createDataFrame([(1, "a b+c:d%20"), (2, None), (3, "ü/x")], "v int, s string")
    commits.commit(root, {"odd": (odd, ["s"])})
    assert sorted(map(str, commits.committed(spark, root, "odd", odd.schema).collect())) == sorted(map(str, odd.collect()))
