"""Kernels against independent NumPy forms, analytic truths and known values."""

import datetime
import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.compare import same
from tidewright import synth
from tidewright.functions import scalars
from tidewright.nulls import clean, holds
from tidewright.operators import crossover, flags, grid, indicators, lookups, passes, planner, polygons, rolling, segments, setops, smoothing, spline, tiles
from tidewright.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def smooth_window(window, half=9):
    """One window of the smoother, from its description."""
    w = np.exp(-((np.arange(-half, half + 1) * 5.745 / 15) ** 2))
    w /= w.sum()
    x = np.array(window, float)
    if np.isnan(x[:half]).all() and np.isnan(x[half + 1 :]).all():
        return math.nan
    known = np.flatnonzero(~np.isnan(x))
    inner = np.arange(known[0], known[-1] + 1)
    x[inner] = np.interp(inner, known, x[known])
    x[np.isnan(x[::-1])] = np.nan
    if np.isnan(x[:half]).all() and np.isnan(x[half + 1 :]).all():
        return math.nan
    ok = ~np.isnan(x)
    return (x[ok] * w[ok]).sum() / w[ok].sum()


def run_smoother(spark, values):
    rows = [(1, i, None if v is None or math.isnan(v) else float(v)) for i, v in enumerate(values)]
    df = smoothing.smoothed(spark.createDataFrame(rows, "k int, i int, v double"), "v", ["k"], ["i"])
    return [math.nan if r.smoothed is None else r.smoothed for r in df.orderBy("i").collect()]


def test_smoother_against_windows(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=400)
    v[rng.random(400) < 0.4] = np.nan
    v[100:140] = np.nan
    padded = np.concatenate([np.full(9, np.nan), v, np.full(9, np.nan)])
    want = [smooth_window(padded[i : i + 19]) for i in range(400)]
    np.testing.assert_allclose(run_smoother(spark, v), want, rtol=0, atol=1e-12, equal_nan=True)


def test_smoother_known_values(spark):
    ramp = [*range(1, 11), *range(9, 0, -1)]
    assert run_smoother(spark, ramp)[9] == pytest.approx(8.56348, abs=1e-4)
    assert run_smoother(spark, [1.0] * 19)[9] == pytest.approx(1)
    assert run_smoother(spark, [1.0] * 9 + [None] + [1.0] * 9)[9] == pytest.approx(1)
    lone = run_smoother(spark, [None] * 9 + [1.0] + [None] * 9)
    assert all(math.isnan(x) for x in lone)


def test_nan_is_unknown(spark):
    df = clean(spark.createDataFrame([(float("nan"),), (1.5,), (0.5,)], "x double"))
    assert [r.hit for r in df.select(holds(F.abs("x") > 1.2).alias("hit")).collect()] == [False, True, False]


def test_median_outliers_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=300)
    x[50] = 40
    ok = rng.random(300) < 0.8
    rows = [(1, i, float(a), bool(b)) for i, (a, b) in enumerate(zip(x, ok, strict=True))]
    out = rolling.median_outliers(spark.createDataFrame(rows, "k int, i int, x double, ok boolean"), "x", "ok", ["k"], ["i"], 0.05).orderBy("i").collect()
    sub = x[ok]
    med = np.array([np.median(sub[max(0, i - 7) : i + 8]) for i in range(len(sub))])
    sq = (sub - med) ** 2
    std = np.clip([np.sqrt(np.median(sq[max(0, i - 47) : i + 48])) for i in range(len(sub))], 0.05, None)
    n = np.arange(1, 301)
    m, s = np.interp(n, n[ok], med), np.interp(n, n[ok], std)
    np.testing.assert_allclose([r.median for r in out], m, atol=1e-12)
    assert [r.median_flag for r in out] == (np.abs(x - m) > 5 * s).tolist()


def test_nothing_passes_the_mask(spark):
    df = spark.createDataFrame([(1, 1, 2.0, False), (1, 2, None, False)], "k int, i int, x double, ok boolean")
    assert all(r.median_flag for r in rolling.median_outliers(df, "x", "ok", ["k"], ["i"], 0.05).collect())


def test_crossing_of_two_tracks(spark):
    rows = [(10001, float(t), 10.0 + t, 0.0 + t, 1.0) for t in range(11)] + [(10004, 100.0 + t, 10.0 + t, 9.0 - t, 3.0) for t in range(11)]
    pts = spark.createDataFrame(rows, "track long, t double, lon double, lat double, v double")
    pairs = crossover.candidates(crossover.track_starts(pts, "track", "t"))
    seg = crossover.segments(pts, ["track"], "lon", "lat", "t", "v", 360.0)
    got = crossover.intersections(pairs, seg).collect()
    assert len(got) == 1
    assert (got[0].x, got[0].y, got[0].t1, got[0].t2, got[0].v1, got[0].v2) == pytest.approx((14.5, 4.5, 4.5, 104.5, 1.0, 3.0))


def test_crossing_over_the_date_line(spark):
    rows = [(10001, float(t), (358.0 + t) % 360, 0.0 + t, 1.0) for t in range(5)] + [(10004, 100.0 + t, (358.0 + t) % 360, 4.25 - t, 3.0) for t in range(5)]
    pts = spark.createDataFrame(rows, "track long, t double, lon double, lat double, v double")
    seg = crossover.segments(pts, ["track"], "lon", "lat", "t", "v", 360.0)
    got = crossover.intersections(crossover.candidates(crossover.track_starts(pts, "track", "t")), seg).collect()
    assert len(got) == 1 and got[0].x % 360 == pytest.approx(0.125)


def test_lines_cross_twice_within_a_millisecond_and_crossings_are_not_dealt_again(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    flat = [(at(0.0), 1, 5.0), (at(3600.0), 1, 5.0)]
    saw = [(at(s), 4, v) for s, v in ((10.0, 0.0), (20.0, 4.999), (20.001, 5.001), (20.002, 4.999), (30.0, 0.0))]
    rows = [(k, ts.isoformat(), user, v) for k, (ts, user, v) in enumerate([*flat, *saw, *saw])]  # repeated points too
    table = spark.createDataFrame(rows, "event_id long, ts string, user_id long, value double").selectExpr("event_id", "cast(ts AS timestamp_ntz) AS ts", "user_id", "'a' AS event_type", "value", "'' AS props")
    table.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["crossover_points"](spark, str(tmp_path))
    assert [(r.track1, r.track2, r.x, r.y) for r in got.collect()] == [(1, 4, 0.0056, 5.0)] * 2
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]  # only of the starts


def test_crossovers_of_the_synthetic_orbit_agree_on_the_field(spark):
    got = crossover.crossovers(synth.ground_tracks(spark, tracks=8, points=1500, step_s=2)).toPandas()
    assert len(got) > 5
    bias = lambda p: 0.05 * np.sin((p - 1) * 0.7)
    assert np.abs((got.ssh1 - got.ssh2) - (bias(got.pass1) - bias(got.pass2))).max() < 0.02


def test_candidates_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    starts = [(int(i), float(s)) for i, s in enumerate(rng.uniform(0, 5000, 60))]
    got = {(r.track1, r.track2) for r in crossover.candidates(spark.createDataFrame(starts, "track long, start double"), 700.0).collect()}
    assert got == {(a, b) for a, s in starts for b, t in starts if 0 < t - s <= 700 and abs(a - b) > 1 and a % 2 != b % 2}


def test_spline_meets_its_constraints():
    rng = np.random.default_rng(5)
    t, tr = [], []
    for p in range(26):
        if p in (8, 15):
            continue
        x = np.sort(rng.uniform(p * 0.94, p * 0.94 + 0.9, 40))
        t.append(x)
        tr.append(np.full(40, p))
    t, tr = np.concatenate(t), np.concatenate(tr)
    d = 0.1 * np.sin(t / 3)
    brk, c = spline.fit(t, d, tr)
    w = np.diff(brk)
    value = lambda i, u: ((c[i, 0] * u + c[i, 1]) * u + c[i, 2]) * u + c[i, 3]
    slope = lambda i, u: (3 * c[i, 0] * u + 2 * c[i, 1]) * u + c[i, 2]
    curve = lambda i, u: 6 * c[i, 0] * u + 2 * c[i, 1]
    for i in range(len(w)):
        j = (i + 1) % len(w)
        for f in (value, slope, curve):
            assert f(i, w[i]) == pytest.approx(f(j, 0.0), abs=1e-6)
    assert value(len(w) - 1, w[-1]) == pytest.approx(0, abs=1e-7)
    for p in spline.gap_points(t):
        i = np.searchsorted(brk, p, side="left") - 1
        assert value(i, p - brk[i]) == pytest.approx(0, abs=1e-6)
    assert np.allclose(spline.fit(t, 0 * d, tr)[1], 0)


def test_spline_meets_its_conditions_whatever_the_number_of_samples():
    rng = np.random.default_rng(4)
    t = np.sort(rng.uniform(0, 24, 1200))
    times = np.concatenate([t + k / 3600 for k in range(60)])  # passes begin and end within a second of each other
    d = np.tile(rng.uniform(-0.3, 0.3, 1200), 60)
    brk, c = spline.fit(times, d, np.floor(times / 2).astype(int))
    w, after = np.diff(brk), np.roll(c, -1, axis=0)
    least = np.minimum(w, np.roll(w, -1))
    for k, (end, begin) in enumerate([(((c[:, 0] * w + c[:, 1]) * w + c[:, 2]) * w + c[:, 3], after[:, 3]), ((3 * c[:, 0] * w + 2 * c[:, 1]) * w + c[:, 2], after[:, 2]), (6 * c[:, 0] * w + 2 * c[:, 1], 2 * after[:, 1])]):
        assert (np.abs(end - begin) * least**k).max() < 1e-11


def test_spline_sums_are_those_of_all_samples(spark):
    rng = np.random.default_rng(8)
    at, u, d = rng.integers(0, 5, 200), rng.uniform(0, 1, 200), rng.normal(size=200)
    g = np.zeros((200, 20))
    for k in range(4):
        g[np.arange(200), 4 * at + k] = u ** (3 - k)
    gram, right = spline.gram_blocks(at, u, d, 5)
    assert np.allclose(gram, g.T @ g) and np.allclose(right, g.T @ d)
    rows = spark.createDataFrame([(int(a), float(x), float(y)) for a, x, y in zip(at, u, d, strict=True)], "i int, u double, d double")
    for r in spline.gram_sums(rows, ["i"], "u", "d").collect():
        block = [[r.n if i + j == 6 else r[f"u{6 - i - j}"] for j in range(4)] for i in range(4)]
        assert np.allclose(block, gram[4 * r.i : 4 * r.i + 4, 4 * r.i : 4 * r.i + 4]) and np.allclose([r.d3, r.d2, r.d1, r.d0], right[4 * r.i : 4 * r.i + 4])


def test_spline_conditions_see_a_jump(spark):
    rows = [("a", k, float(k), k + 1.0, 0.0, 0.0, 0.0, float(k == 1)) for k in range(3)] + [("b", k, float(k), k + 1.0, 0.0, 0.0, 0.0, 0.0) for k in range(3)]
    poly = spark.createDataFrame(rows, "s string, interval int, lo double, hi double, c3 double, c2 double, c1 double, c0 double")
    got = {r.s: (r.joined, r.periodic, r.rests) for r in spline.conditions(poly, ["s"]).collect()}
    assert got == {"a": (False, True, True), "b": (True, True, True)}


def test_spline_by_day_and_evaluation(spark):
    days = spark.createDataFrame([("a", datetime.date(2020, 1, 2)), ("a", datetime.date(2020, 1, 9))], "source string, date date")
    begin = 1577923200.0
    rows = [("a", begin + 3600 * (k + j / 20), begin + 3600 * (k + j / 20) + 40000.0, 10001 + k, 10004 + k, 0.1) for k in range(20) for j in range(18)]
    x = spark.createDataFrame(rows, "source string, time1 double, time2 double, track1 long, track2 long, d double")
    poly = spline.fit_days(spline.day_inputs(x, days), days)
    n = {str(r.date): (r.n, r.s) for r in poly.groupBy("date").agg(F.count("*").alias("n"), F.sum(F.abs("c0")).alias("s")).collect()}
    assert n["2020-01-09"] == (30, 0.0) and n["2020-01-02"][0] > 20 and n["2020-01-02"][1] > 0
    pts = spark.createDataFrame([("a", datetime.date(2020, 1, 2), 5.5), ("a", datetime.date(2020, 1, 9), 5.5)], "source string, date date, h double")
    got = {str(r.date): r.oer for r in spline.evaluated(pts, poly, ["source", "date"], "h").collect()}
    assert got["2020-01-09"] == 0 and abs(got["2020-01-02"]) > 0


def test_missing_correction_is_an_error(spark):
    daily = spark.createDataFrame([("a", 1, 1.0, 1.0), ("a", 2, 1.0, None)], "source string, time int, ssha double, ssha_smoothed double")
    one = spark.createDataFrame([("a", 1, 0.5)], "source string, time int, oer double")
    with pytest.raises(Exception, match="no orbit correction"):
        spline.corrected(daily, one, ["source", "time"]).collect()
    both = one.union(spark.createDataFrame([("a", 2, -0.5)], one.schema))
    assert sorted(r.ssha for r in spline.corrected(daily, both, ["source", "time"]).collect()) == [0.5, 1.5]


def test_places_at_the_ends_of_the_grid(spark):
    same(QUERIES["bilinear_lookup"](spark, "/root/testdata/sf0.1"), SQL["bilinear_lookup"], "/root/testdata/sf0.1")  # 10650 * 11.7 is a multiple of 355


def test_lookup_without_entry_is_an_error(spark):
    df = spark.createDataFrame([("1",), ("2",)], "id string")
    with pytest.raises(Exception, match="no entry for id 2"):
        lookups.looked_up(df, spark.createDataFrame([("1", 5)], "id string, pass int"), "id").collect()


def test_nearest_of_points_in_one_place(spark, tmp_path):
    """Points of one place are apart by rounding alone, 17 of them where 8 count."""
    keys = [k for k in range(90_000) if k % 5200 % 130 == 49]
    spark.createDataFrame([(k, 0, float(k % 997)) for k in keys], "c_custkey long, c_nationkey int, c_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/c")
    spark.createDataFrame([(k, 0) for k in range(0, 6000, 3)], "s_suppkey long, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/s")
    folder = tmp_path / "tables"
    folder.mkdir()
    for part, name in (("c", "customer"), ("s", "supplier")):
        next((tmp_path / part).glob("*.parquet")).rename(folder / f"{name}.parquet")
    (folder / "nation.parquet").symlink_to(f"{FOLDER}/nation.parquet")
    same(QUERIES["knn_gauss_grid"](spark, str(folder)), SQL["knn_gauss_grid"], str(folder))


def test_polygons_against_a_loop(spark):
    rng = np.random.default_rng(2)
    corners = [p for _, _, r in synth.RINGS for p in r[:12]]  # on corners and on sides too
    sides = [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for _, _, r in synth.RINGS for a, b in zip(r[:6], r[1:7], strict=False)]
    spots = [(float(x), float(y)) for x, y in rng.uniform([-150, -70], [150, 85], (3000, 2))] + corners + sides
    pts = [(i, x, y) for i, (x, y) in enumerate(spots)]
    shapes: dict[int, list] = {}
    for k, _, r in synth.RINGS:
        shapes.setdefault(k, []).append(r)

    def inside(rings, x, y):
        hit = False
        for (x1, y1), (x2, y2) in (e for ring in rings for e in zip(ring, [*ring[1:], ring[0]], strict=True)):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hit = not hit
        return hit

    want = {i: min([k for k, r in shapes.items() if inside(r, x, y)], default=0) for i, x, y in pts}
    odd = [(-1, None, 1.0), (-2, float("nan"), 1.0)]
    got = polygons.point_in_polygon(spark.createDataFrame(pts + odd, "i int, x double, y double"), synth.polygons(spark), "x", "y", "i")
    assert {r.i: r.basin_flag for r in got.collect()} == want | {-1: 0, -2: 0}
    leaves = polygons.cover(synth.polygons(spark)).select("feature_id", "fine", F.size("edges").alias("n")).collect()
    assert any(r.n == 0 for r in leaves) and sum(r.n for r in leaves) / len(leaves) < 20  # of 260 edges of the star


def test_shapes_of_one_feature_may_overlap(spark):
    square = [{"x": x, "y": y} for x, y in ((0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0))]
    rings = spark.createDataFrame([(s, 1, square) for s in (1, 2)], "shape int, feature_id int, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "i int, x double, y double")
    assert polygons.point_in_polygon(pts, rings, "x", "y", "i").first().basin_flag == 1
    assert polygons.point_in_polygon(pts, rings.limit(0), "x", "y", "i").first().basin_flag == 0


def test_constant_field_grids_to_itself(spark):
    cells = synth.cells(spark, 8, 16)
    pts = spark.range(2000).select(F.col("id").alias("point"), (F.col("id") * 7.7 % 170 - 85).alias("lat"), (F.col("id") * 31.3 % 360).alias("lon"), F.lit(4.5).alias("v"), (1 + F.col("id") % 2).cast("int").alias("basin"))
    links = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "basin_id int, valid_basin int")
    got = grid.gaussian_grid(cells, pts, links, reach=2e6, sigma=7e5, k=5).join(cells, "cell").toPandas()
    assert (got[got.counts > 0].value.round(9) == 4.5).all() and (got[got.basin_id == 0].counts == 0).all() and got.counts.max() == 5


def test_fill_and_diffuse_against_dense(spark):
    st = synth.stencil(6, 8)
    rng = np.random.default_rng(4)
    v = rng.normal(size=48)
    v[[3, 4, 5, 11, 12, 30]] = np.nan
    basin = np.ones(48, int)
    m = np.zeros((48, 48))
    for r, c, w in st:
        m[r, c] += w
    off = m - np.diag(np.diag(m))
    x = v.copy()
    while True:
        known = ~np.isnan(x)
        n = off @ known
        todo = ~known & (n != 0)
        if not todo.any():
            break
        x[todo] = ((off @ np.where(known, x, 0)) / np.where(n == 0, 1, n))[todo]
    for _ in range(4):
        x = x + m @ x
    rows = [(1, i, None if np.isnan(a) else float(a), int(b)) for i, (a, b) in enumerate(zip(v, basin, strict=True))]
    got = grid.fill_and_diffuse(spark.createDataFrame(rows, "grid_date int, cell int, v double, basin_id int"), st, 4).orderBy("cell").toPandas()
    np.testing.assert_allclose(got.v, x, atol=1e-12)
    once = grid.fill_once(spark.createDataFrame(rows, "grid_date int, cell int, v double, basin_id int"), spark.createDataFrame(st, "row int, col int, val double"), ["grid_date"])
    assert once.where("v IS NULL").count() < 6


def test_tiles_equal_the_whole_grid(spark):
    """Four times the resolution of the test above in either direction, two grids, one of them with a null key, land, a wide hole
    that several rounds fill, cells that no grid has and one without a stencil row."""
    n_lat, n_lon = 24, 32
    st = [(r, c, w) for r, c, w in synth.stencil(n_lat, n_lon) if r != 100]
    rng = np.random.default_rng(5)
    rows = []
    for key in (1, None):
        for cell in range(n_lat * n_lon):
            i, j = divmod(cell, n_lon)
            hole = 4 <= i < 18 and 6 <= j < 27 or rng.random() < 0.1
            land = 0 if j == 3 and i < 20 else 1001 if cell % 97 == 0 else None if cell == 55 else 1
            if cell % 61:
                rows.append((key, cell, None if hole else float("nan") if cell == 70 else float(rng.normal()), land, f"{key} {cell}"))
    df = spark.createDataFrame(rows, "grid_date int, cell int, v double, basin_id int, note string")
    by = ["note", "v"]
    for steps, side, depth in ((7, 7, 3), (4, 50, 2)):
        want = grid.fill_and_diffuse(df, st, steps).select(*by).toPandas().sort_values("note")
        done = tiles.fill_and_diffuse(df, st, steps, tiles.squares(n_lon, side), depth=depth)
        got = done.select(*by).toPandas().sort_values("note")
        assert done.columns == df.columns and got.note.tolist() == want.note.tolist()
        np.testing.assert_allclose(got.v, want.v, atol=1e-12)
    assert tiles.fill_and_diffuse(df.where("1 = 0"), st, 3, tiles.squares(n_lon, 8), depth=2).count() == 0
    loose = spark.createDataFrame([(1, None, 2.0, 1, "a"), (1, 0, 3.0, 1, "b"), (1, 1, None, 1, "c")], df.schema)
    got = {r.note: r.v for r in tiles.fill_and_diffuse(loose, st, 0, tiles.squares(n_lon, 8), depth=2).collect()}
    assert got == pytest.approx({"a": 2.0, "b": 3.0, "c": 3.0})


def test_a_halo_reaches_as_far_as_the_steps(spark):
    st = spark.createDataFrame(synth.stencil(6, 12), "row long, col long, val double")
    got = {(r.tile, r.cell): r.ring for r in tiles.halos(st, tiles.squares(12, 3), 2).collect()}
    at = lambda cell: (cell // 12, cell % 12)
    want = {}
    for tile in range(8):
        inside = [(i, j) for i in range(6) for j in range(12) if i // 3 * 4 + j // 3 == tile]
        for cell in range(72):
            i, j = at(cell)
            hops = min(abs(i - a) + min(abs(j - b), 12 - abs(j - b)) for a, b in inside)
            if 0 < hops <= 2:
                want[tile, cell] = hops
    assert got == want


def test_running_mean_shrinks_at_the_ends(spark):
    rows = [(1, datetime.datetime(2000, 1, 1) + datetime.timedelta(days=10 * k), float(k)) for k in range(10)]
    df = spark.createDataFrame(rows, "k int, t timestamp, x double")
    got = [r.m for r in df.select("t", rolling.running_mean(F.col("x"), F.col("t"), ["k"]).alias("m")).orderBy("t").collect()]
    assert got == [np.mean([j for j in range(10) if abs(j - k) <= 2]) for k in range(10)]


def test_projection_recovers_a_factor(spark):
    rows = [(1, float(p) / 1000 * 2.5 if p % 3 else None, float(p)) for p in range(1, 30)]
    got = indicators.projected(spark.createDataFrame(rows, "g int, v double, p double"), ["g"], "v", "p", "f").first()
    assert got.f == pytest.approx(2.5)


def test_planner_dates(spark):
    from tidewright.functions.scalars import last_daily_date, last_full_monday

    days = [datetime.date(2024, 1, 1) + datetime.timedelta(days=k) for k in range(21)]

    def last(today):
        m = today - datetime.timedelta(days=today.weekday())
        while m + datetime.timedelta(days=4) >= today:
            m -= datetime.timedelta(weeks=1)
        return m

    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", last_full_monday(F.col("d")).alias("m"), last_daily_date(F.col("d")).alias("e")).collect()
    assert all(r.m == last(r.d) and r.e == last(r.d) + datetime.timedelta(days=4) for r in got)
    assert planner.day_range(datetime.date(1980, 1, 1), datetime.date(2000, 1, 1), None, days[0], days[0])[0] == planner.FIRST_DAY


def test_bad_pass_limits(spark):
    rows = [(1, 0.11)] * 16 + [(2, 0.11)] * 15 + [(3, s * 0.3) for s in (-1, 1)] * 13 + [(4, s * 0.2) for s in (-1, 1)] * 20
    got = passes.bad(passes.pass_stats(spark.createDataFrame(rows, "track int, d double"), ["track"]))
    assert sorted(r.track for r in got.collect()) == [1, 3]


def test_pair_and_cross_application(spark):
    day = datetime.date(2020, 1, 1)
    daily = spark.createDataFrame([("a", day, c, p, 0, 1.0) for c in (1, 2) for p in (7, 8)], "source string, date date, cycle int, pass int, quality_flag int, ssha_smoothed double")
    listed = spark.createDataFrame([("a", day, 1, 7), ("a", day, 2, 8)], "source string, date date, cycle int, pass int")
    hits = lambda mode: passes.applied(daily, listed, mode).where("ssha_smoothed IS NULL").count()
    assert (hits("pair"), hits("cross")) == (2, 4)


def test_list_update_counts_equal_ids_once(spark):
    old = spark.createDataFrame([("a", "2020-01-01", 1, 2), ("a", "2020-01-02", 1, 3)], "source string, date string, cycle int, pass int")
    new = spark.createDataFrame([("a", "2020-01-02", "1", "3"), ("a", "2020-01-03", "1", "4")], "source string, date string, cycle string, pass string")
    gone = spark.createDataFrame([("a", datetime.date(2020, 1, 1))], "source string, date date")
    assert passes.updated_list(old, gone, new).count() == 2


def test_set_difference(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(2,), (1,)], "x int")
    assert not setops.same_rows(a, b) and setops.same_rows(a, a) and [tuple(r) for r in setops.difference(a, b).collect()] == [(1, "left")]


def test_wave_reject_corners(spark):
    rows = [(10.0, 13.0, False), (10.0, 14.5, True), (12.0, 10.5, True), (12.0, 9.0, False), (20.0, 5.0, True), (30.0, 0.5, False), (30.0, 1.5, True), (None, 1.0, False)]
    got = spark.createDataFrame(rows, "s double, h double, want boolean").select("want", flags.wave_reject(F.col("s"), F.col("h")).alias("got")).collect()
    assert all(r.got == r.want for r in got)


def test_rolling_median_of_chunks_in_any_zone(spark, monkeypatch):
    """Chunks of a series give what one frame over the whole gives, with nulls, whatever zone the session shows instants in."""
    monkeypatch.setattr(rolling, "CHUNK", 40)
    rng = random.Random(4)
    begin = datetime.datetime(2020, 1, 1)
    rows = [(k, i, begin + datetime.timedelta(seconds=i), None if rng.random() < 0.2 else rng.random()) for k in (1, 2, None) for i in range(90 if k == 1 else 200 if k else 3)]
    frame = spark.createDataFrame(rows, "k int, i int, t timestamp, x double")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Etc/UTC")
    try:
        got = rolling.rolling_median(frame, "m", F.col("x"), ["k"], ["t"], 7).orderBy("k", "i").collect()
        instants = {(r.k, r.i): r.t for r in frame.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(got) == len(rows) and all(instants[r.k, r.i] == r.t for r in got)
    for r in got:
        known = [x for k, i, _, x in rows if k == r.k and abs(i - r.i) <= 7 and x is not None]
        assert r.m == (pytest.approx(statistics.median(known)) if known else None)
    assert rolling.rolling_median(frame.limit(0), "m", F.col("x"), ["k"], ["t"], 7).count() == 0


@pytest.mark.parametrize("flags,width", [([0, 5, 4], 3), ([1023, 1], 10), ([2**17, 3], 17), ([8, 7], 3), ([1], 0), ([0], 0)])
def test_bits_by_the_data(spark, flags, width):
    got = scalars.split_flags(spark.createDataFrame([(f,) for f in flags] + [(None,)], "f int"), "f").collect()
    assert [r.bits for r in got if r.f is not None] == [[f >> k & 1 == 1 for k in range(width)] for f in flags]


def test_differences_of_multisets(spark):
    rng = random.Random(3)
    rows = lambda n: [(rng.randint(0, 9) or None, rng.choice("ab")) for _ in range(n)]
    a, b = rows(300), rows(280)
    want = {("left", *k): n for k, n in (Counter(a) - Counter(b)).items()} | {("right", *k): n for k, n in (Counter(b) - Counter(a)).items()}
    left, right = (spark.createDataFrame(x, "k int, v string") for x in (a, b))
    got = Counter((r.side, r.k, r.v) for r in setops.difference(left, right).collect())
    assert got == want and not setops.same_rows(left, right)
    assert setops.same_rows(left, left.repartition(5).select("v", "k")) and setops.difference(left, left.repartition(5)).isEmpty()
    assert setops.same_rows(left.limit(0), right.limit(0)) and not setops.same_rows(left, left.limit(0))


@pytest.mark.parametrize("rows", [20, 150, 100_000])
def test_segments_equal_windows_over_the_whole_series(spark, rows):
    rng = random.Random(6)
    data = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, float("nan"), *range(400)]), i, rng.choice([None, rng.random()])) for i in range(1500)]
    data += [(1, 77.0, 2000 + i, 0.5) for i in range(300)]  # one time many rows
    df = spark.createDataFrame([(k, None if t is None else float(t), i, v) for k, t, i, v in data], "k int, t double, i int, v double")
    series = segments.cut(df, ["k"], ["t", "i"], rows)
    per = Counter((r.k, r._seg) for r in series.collect())
    assert len(per) == 3 if rows > 10_000 else len(per) > 8 and max(n for (k, _), n in per.items()) <= 2 * rows + 320
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")) - 1)
    number = lambda x: {r.i: r.n for r in x.collect()}
    assert number(segments.numbered(series, "n", ["k"], ["t", "i"])) == number(want)
    value = lambda x: {r.i: r.f for r in x.collect()}
    spread = rolling.interpolated(series, "f", "v", "i", ["k"], ["t", "i"], spread=True)
    assert spread.columns == [*series.columns, "f"] and value(spread) == value(rolling.interpolated(df, "f", "v", "i", ["k"], ["t", "i"]))
    median = lambda x, s: value(rolling.rolling_median(x, "f", F.col("v"), ["k"], ["t", "i"], 7, spread=s))
    assert median(series, True) == median(df, False)
    assert segments.cut(df.limit(0), ["k"], ["t", "i"]).count() == 0


def test_nearest_by_brute_force_with_dense_and_repeated_places(spark):
    rng = np.random.default_rng(12)
    wide = [(float(a), float(o)) for a, o in rng.uniform([-85, 0], [85, 360], (1500, 2))]
    dense = [(10 + float(a), 20 + float(o)) for a, o in rng.normal(0, 0.4, (2500, 2))]
    places = wide + dense + [(10.0, 20.0)] * 400  # ties of distance are settled by the key
    src = [(i, a, o, i % 2) for i, (a, o) in enumerate(places)]
    tgt = [(i, float(a), float(o), i % 2) for i, (a, o) in enumerate([*rng.uniform([-89, 0], [89, 360], (60, 2)), (10.1, 20.1), (10.0, 20.0), (89.9, 0.0)])]
    s = spark.createDataFrame(src, "p int, lat double, lon double, b int")
    t = spark.createDataFrame(tgt, "c int, lat double, lon double, b int")
    xyz = lambda a, o: np.array([np.cos(np.radians(a)) * np.cos(np.radians(o)), np.cos(np.radians(a)) * np.sin(np.radians(o)), np.sin(np.radians(a))]) * lookups.EARTH_M
    at = np.array([xyz(a, o) for _, a, o, _ in src])
    for k, reach in ((40, 1.5e6), (1, 3e5), (500, 6e5)):
        got: dict = {}
        for r in lookups.nearest_within(t, s, "c", "p", reach, k, ["b"]).collect():
            got.setdefault(r.c, []).append((round(r.distance, 3), r.p))
        for c, a, o, b in tgt:
            d = np.sqrt(((at - xyz(a, o)) ** 2).sum(axis=1))
            want = sorted((round(float(x), 3), i) for i, x in enumerate(d) if x <= reach and i % 2 == b)[:k]
            assert sorted(x for x, _ in got.get(c, [])) == [x for x, _ in want]
            assert {p for x, p in got.get(c, []) if not want or x < want[-1][0]} == {p for x, p in want if x < want[-1][0]}
    met = lookups.candidates_within(t, s, "c", 6e5, 40, ["b"]).groupBy("c").count()
    assert met.where("c >= 60").agg(F.max("count")).first()[0] < 40 * 12  # of 1450 sources within reach
    assert lookups.nearest_within(t, s.limit(0), "c", "p", 6e5, 5, ["b"]).count() == 0
