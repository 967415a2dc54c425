"""Orbit error as a constrained cubic spline: knots, the fit, evaluation, and its application."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.crossover import stacked

DAY_S, MARGIN_S, MAX_DIFFERENCE = 86400.0, 7200.0, 0.3
PAD_STEP, PAD_FROM, PAD_TO = 0.3, -5.0, 29.0
SPEED_10K_KM = 3600 * 5.7 / 10000  # of 10 000 km, per hour
POLYNOMIAL = "interval int, lo double, hi double, c3 double, c2 double, c1 double, c0 double, rms_sig double, rms_res double, nint int"


def knot_stats(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """First, last, number and middle sample of the times of each pass; of an even number (over one) the upper middle one."""
    times = F.sort_array(F.collect_list(time))
    out = df.groupBy(*keys).agg(times.alias("_t"))
    middle = F.element_at("_t", F.floor(F.size("_t") / 2).cast("int") + 1)
    return out.select(*keys, F.array_min("_t").alias("t_min"), F.array_max("_t").alias("t_max"), F.size("_t").cast("long").alias("n"), middle.alias("t_mid"))


def knots(times: np.ndarray, tracks: np.ndarray) -> np.ndarray:
    """Knots of a day: each pass's first sample, its last and middle one where it is long and full enough, and one an hour
    outside; equal knots count once."""
    found = []
    for track in np.unique(tracks):
        t = np.sort(times[tracks == track])
        length = (t[-1] - t[0]) * SPEED_10K_KM
        found.append(t[0])
        if length >= 0.5 and len(t) >= 10:
            found.append(t[-1])
        if length > 1 and len(t) > 20:
            found.append(t[len(t) // 2])
    k = np.unique(found)
    return np.concatenate([[k[0] - 1], k, [k[-1] + 1]])


def gap_points(times: np.ndarray, small: float = 0.75, large: float = 1.2) -> np.ndarray:
    """Where the spline is held at zero: the middle of gaps, half an hour around the left end of large ones."""
    gap = np.diff(times)
    left = times[:-1]
    mid, wide = (gap > small) & (gap < large), gap >= large
    return np.sort(np.concatenate([left[mid] + gap[mid] / 2, left[wide] - 0.5, left[wide] + 0.5]))


def gram_sums(df: DataFrame, keys: list[str], share: str, value: str) -> DataFrame:
    """The sums behind the normal equations of a cubic in each interval (keys): n, u1 to u6, the sums of the powers of the share,
    and d0 to d3, those of the value times its powers. Their 4x4 block has u(6 - i - j) at (i, j), highest power first."""
    u, d = F.col(share), F.col(value)
    power = lambda k: F.lit(1.0) if k == 0 else power(k - 1) * u
    sums = [F.sum(power(k)).alias(f"u{k}") for k in range(1, 7)] + [F.sum(d * power(k)).alias(f"d{k}") for k in range(4)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)


def gram_blocks(at: np.ndarray, u: np.ndarray, d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The normal equations of n intervals from the same sums, without a matrix of all samples; at is a sample's interval."""
    moments = np.stack([np.bincount(at, weights=u**k, minlength=n) for k in range(7)])
    sums = np.stack([np.bincount(at, weights=d * u**k, minlength=n) for k in range(4)])
    gram = np.zeros((4 * n, 4 * n))
    for i in range(4):
        for j in range(4):
            gram[4 * np.arange(n) + i, 4 * np.arange(n) + j] = moments[6 - i - j]
    return gram, sums[::-1].T.ravel()


def conditions(polynomial: DataFrame, keys: list[str]) -> DataFrame:
    """keys with joined (value, slope and curvature go on from interval to interval), periodic (from the last to the first) and
    rests (value and slope are zero at the end): to a millionth, by what a difference moves the curve within the shorter of the two
    intervals, as a curvature says little of an interval of a second."""
    u = F.col("hi") - F.col("lo")
    ends = [horner(u), (3 * F.col("c3") * u + 2 * F.col("c2")) * u + F.col("c1"), 6 * F.col("c3") * u + 2 * F.col("c2")]
    begins = [F.col("c0"), F.col("c1"), 2 * F.col("c2")]
    line = Window.partitionBy(*keys).orderBy("interval")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.lead("interval").over(line).isNull()
    following = lambda c: F.coalesce(F.lead(c).over(line), F.first(c).over(whole))
    width = F.least(u, following(u))
    near = lambda a, b, k: F.abs(a - b) * F.pow(width, F.lit(k)) <= 1e-6
    met = [near(e, following(b), k) for k, (e, b) in enumerate(zip(ends, begins, strict=True))]
    rows = polynomial.select(*keys, last.alias("_last"), (met[0] & met[1] & met[2]).alias("_met"), (near(ends[0], F.lit(0.0), 0) & near(ends[1], F.lit(0.0), 1)).alias("_zero"))
    return rows.groupBy(*keys).agg(
        F.coalesce(F.every(F.when(~F.col("_last"), F.col("_met"))), F.lit(True)).alias("joined"),
        F.every(F.when(F.col("_last"), F.col("_met"))).alias("periodic"),
        F.every(F.when(F.col("_last"), F.col("_zero"))).alias("rests"),
    )


def fit(times: np.ndarray, values: np.ndarray, tracks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Breaks and coefficients (intervals, 4), highest power first, of the least-squares cubic in each interval, subject to
    continuity up to the second derivative, a periodic end, and zero value and slope at gap points and at the last knot."""
    order = np.argsort(times, kind="stable")
    t, d, tracks = times[order], values[order], tracks[order]
    brk = knots(t, tracks)
    n = len(brk) - 1
    at = np.clip(np.searchsorted(brk, t, side="left") - 1, 0, n - 1)
    width = np.diff(brk)  # powers are those of the share of an interval, so that short intervals are solved as well as long ones
    u = (t - brk[at]) / width[at]
    gram, right_side = gram_blocks(at, u, d, n)
    rows = []

    def row(i: int, u: float, order: int) -> np.ndarray:
        r, u = np.zeros(4 * n), u / width[i]
        r[4 * i : 4 * i + 4] = ([u**3, u * u, u, 1], [3 * u * u, 2 * u, 1, 0], [6 * u, 2, 0, 0])[order]
        return r / width[i] ** order

    for i in range(n):  # each interval meets the next, the last the first
        rows += [row(i, width[i], k) - row((i + 1) % n, 0.0, k) for k in range(3)]
    for p in gap_points(t):
        if brk[0] <= p <= brk[-1]:
            i = min(n - 1, max(0, int(np.searchsorted(brk, p, side="left")) - 1))
            rows += [row(i, p - brk[i], 0), row(i, p - brk[i], 1)]
    rows += [row(n - 1, brk[-1] - brk[-2], 0), row(n - 1, brk[-1] - brk[-2], 1)]
    c = np.array([r / np.abs(r).max() for r in rows])
    # The curves that meet all conditions first, then the best of them: however many samples there are, the conditions hold.
    _, size, base = np.linalg.svd(c)
    free = base[(size > 1e-10 * size[0]).sum() :].T
    solution = free @ np.linalg.lstsq(free.T @ gram @ free, free.T @ right_side, rcond=1e-13)[0]
    return brk, solution.reshape(n, 4) / width[:, None] ** np.arange(3, -1, -1)


def _polynomial_rows(times: np.ndarray, values: np.ndarray, brk: np.ndarray, coef: np.ndarray) -> dict:
    at = np.clip(np.searchsorted(brk, times, side="left") - 1, 0, len(coef) - 1)
    u = times - brk[at]
    fitted = ((coef[at, 0] * u + coef[at, 1]) * u + coef[at, 2]) * u + coef[at, 3]
    n = np.bincount(at, minlength=len(coef))
    mean = lambda x: np.where(n > 0, np.sqrt(np.bincount(at, weights=x, minlength=len(coef)) / np.maximum(n, 1)), np.nan)
    return {"interval": np.arange(len(coef)), "lo": brk[:-1], "hi": brk[1:], **{f"c{3 - k}": coef[:, k] for k in range(4)}, "rms_sig": mean(values * values), "rms_res": mean((values - fitted) ** 2), "nint": n}


def zero_polynomial(hours: tuple[int, int] = (-3, 27)) -> dict:
    """Hourly intervals of zero, for a day without data."""
    lo = np.arange(*hours, dtype=float)
    zero = np.zeros(len(lo))
    return {"interval": np.arange(len(lo)), "lo": lo, "hi": lo + 1, "c3": zero, "c2": zero, "c1": zero, "c0": zero, "rms_sig": zero, "rms_res": zero, "nint": zero.astype(int)}


def day_inputs(crossovers: DataFrame, days: DataFrame) -> DataFrame:
    """(source, date, track, hours, d, near) for each day of days (source, date) from crossovers of its window.

    crossovers has source, time1, time2, track1, track2 (times in seconds since 1970) and d = ssh1 - ssh2. A row goes to each
    day whose span with two hours of margin holds it; hours count from the day's midnight. near: under 0.3 m.
    """
    rows = stacked(crossovers, ["source"], (F.col("track1"), F.col("time1")), (F.col("track2"), F.col("time2")), F.col("d"))
    low, high = (F.floor((F.col("time") + s * MARGIN_S) / DAY_S).cast("int") for s in (-1, 1))
    each = rows.withColumn("date", F.explode(F.transform(F.sequence(low, high), lambda k: F.date_add(F.lit("1970-01-01").cast("date"), k))))
    each = each.join(days.select("source", "date").distinct(), ["source", "date"], "left_semi")
    return each.select("source", "date", "track", ((F.col("time") - F.unix_seconds(F.col("date").cast("timestamp"))) / 3600).alias("hours"), "d", (F.abs("d") < MAX_DIFFERENCE).alias("near"))


def fit_days(inputs: DataFrame, days: DataFrame) -> DataFrame:
    """The polynomial of each (source, date) of days: one small dense solve for each, in parallel over days.

    Data are padded with zeros every 0.3 h before the first and after the last; a day without near data gets the zero polynomial.
    """
    import pandas as pd

    def run(key, left, right):
        use = left[left["near"].fillna(False)]
        if len(use):
            t, d, k = use["hours"].to_numpy(float), use["d"].to_numpy(float), use["track"].to_numpy()
            first, last = t[k == k.min()].min(), t[k == k.max()].max()
            before = np.arange(PAD_FROM, first, PAD_STEP)
            after = np.arange(last + PAD_STEP, PAD_TO, PAD_STEP)
            t2, d2 = np.concatenate([before, t, after]), np.concatenate([np.zeros(len(before)), d, np.zeros(len(after))])
            k2 = np.concatenate([np.full(len(before), k.min() - 1), k, np.full(len(after), k.max() + 1)])
            rows = _polynomial_rows(t2, d2, *fit(t2, d2, k2))
        else:
            rows = zero_polynomial()
        out = pd.DataFrame(rows)
        out.insert(0, "date", key[1])
        out.insert(0, "source", key[0])
        return out

    each = days.select(F.col("source").alias("source"), F.col("date").alias("date")).distinct()  # columns of their own, as inputs may come from days
    return inputs.groupBy("source", "date").cogroup(each.groupBy("source", "date")).applyInPandas(run, f"source string, date date, {POLYNOMIAL}")


def horner(u: Column) -> Column:
    return ((F.col("c3") * u + F.col("c2")) * u + F.col("c1")) * u + F.col("c0")


def evaluated(points: DataFrame, polynomial: DataFrame, keys: list[str], hours: str, name: str = "oer", cut_seconds: bool = True, width: float = 1.0, reach: tuple[float, float] = (-6.0, 30.0)) -> DataFrame:
    """points with the negative of the polynomial at their hours; end intervals reach on for ever. With cut_seconds the hours
    are cut to whole seconds. Points of a key without a polynomial have none.

    Intervals run from one lo to the next and meet the points in buckets of the given width; beyond reach, where hours of a
    day do not come, all share the last bucket of either end. So a point meets the few intervals of its bucket.
    """
    h = F.floor(F.round(F.col(hours) * 3600, 6)) / 3600 if cut_seconds else F.col(hours)
    bucket = lambda x: F.floor(F.greatest(F.lit(reach[0]), F.least(F.lit(reach[1]), x)) / width)
    line = Window.partitionBy(*keys).orderBy("lo")
    pieces = polynomial.select(*keys, "lo", "c3", "c2", "c1", "c0").withColumn("_to", F.lead("lo").over(line))
    pieces = pieces.withColumn("_from", F.when(F.lag("lo").over(line).isNotNull(), F.col("lo")))
    buckets = F.sequence(bucket(F.coalesce("_from", F.lit(reach[0]))), bucket(F.coalesce("_to", F.lit(reach[1]))))
    pieces = pieces.withColumn("_bucket", F.explode(buckets))
    at = points.withColumn("_h", h).withColumn("_bucket", bucket(F.col("_h")))
    inside = (F.col("_from").isNull() | (F.col("_h") >= F.col("_from"))) & (F.col("_to").isNull() | (F.col("_h") < F.col("_to")))
    on = [at[c] == pieces[c] for c in (*keys, "_bucket")]
    joined = at.join(pieces, [*on, inside], "left").withColumn(name, -horner(F.col("_h") - F.col("lo")))
    return joined.select(*[at[c] for c in points.columns], name)


def corrected(daily: DataFrame, correction: DataFrame, keys: list[str]) -> DataFrame:
    """daily with oer added to ssha and ssha_smoothed; a row without a correction is an error when it is read."""
    joined = daily.join(correction.select(*keys, "oer"), keys, "left")
    checked = F.when(F.col("oer").isNotNull(), F.col("oer")).otherwise(F.raise_error(F.lit("no orbit correction for a row")).cast("double"))
    return joined.withColumn("oer", checked).withColumn("ssha", F.col("ssha") + F.col("oer")).withColumn("ssha_smoothed", F.col("ssha_smoothed") + F.col("oer"))


def pass_ends(df: DataFrame, keys: list[str], track: str = "track", time: str = "hours") -> DataFrame:
    """Earliest time of the least track id and latest time of the greatest: t_first, t_last."""
    first = F.min(F.struct(track, time))
    last = F.max(F.struct(track, time))
    return df.groupBy(*keys).agg(first[time].alias("t_first"), last[time].alias("t_last"))


def interval_rms(df: DataFrame, keys: list[str], signal: str, residual: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sqrt(F.avg(F.col(signal) * F.col(signal))).alias("rms_sig"), F.sqrt(F.avg(F.col(residual) * F.col(residual))).alias("rms_res"), F.count(F.lit(1)).alias("nint"))


def padding(df: DataFrame, keys: list[str], step: float = PAD_STEP, low: float = PAD_FROM, high: float = PAD_TO) -> DataFrame:
    """Zero rows (keys, hours, d) at even steps from low up to t_first and from t_last on up to high, of (keys, t_first, t_last)."""
    n_before = F.ceil((F.col("t_first") - low) / step).cast("int")
    n_after = F.ceil((F.lit(high) - F.col("t_last")) / step).cast("int") - 1
    before = F.when(n_before > 0, F.transform(F.sequence(F.lit(0), n_before - 1), lambda i: F.lit(low) + i * step)).otherwise(F.array().cast("array<double>"))
    after = F.when(n_after > 0, F.transform(F.sequence(F.lit(1), n_after), lambda i: F.col("t_last") + i * step)).otherwise(F.array().cast("array<double>"))
    return df.select(*keys, F.explode(F.concat(before, after)).alias("hours"), F.lit(0.0).alias("d"))


def near_days(df: DataFrame, time: str, day: str, margin: float = MARGIN_S) -> DataFrame:
    """Rows in [midnight - margin, midnight + a day + margin) of their day."""
    begin = F.unix_seconds(F.col(day).cast("timestamp"))
    return df.where((F.col(time) >= begin - margin) & (F.col(time) < begin + DAY_S + margin))
