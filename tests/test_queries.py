import numpy as np
import pytest

from tests.compare import same
from tidewright.plans.queries import QUERIES, SQL, spline_inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    same(QUERIES[name](spark, FOLDER), SQL[name], FOLDER)


def test_every_query_but_the_solver_has_sql():
    assert set(QUERIES) - set(SQL) == {"spline_fit"}


def solved(t, d, track):
    """Breaks and values in the middle of each interval: least squares among the curves that meet all conditions, these being
    the null space of the conditions' matrix."""
    brk = []
    for k in sorted(set(track)):
        own = sorted(x for x, j in zip(t, track, strict=True) if j == k)
        km = (own[-1] - own[0]) * 3600 * 5.7
        brk += [own[0]] + [own[-1]] * (km >= 5000 and len(own) >= 10) + [own[len(own) // 2]] * (km > 10000 and len(own) > 20)
    brk = sorted(set(brk))
    brk = [brk[0] - 1, *brk, brk[-1] + 1]
    n = len(brk) - 1
    which = lambda x: min(n - 1, max(0, sum(b < x for b in brk) - 1))

    def at(i, x, order=0):
        row = np.zeros(4 * n)
        width = brk[i + 1] - brk[i]  # powers of the share of the interval, so that short ones weigh like long ones
        row[4 * i : 4 * i + 4] = [np.polyval(np.polyder(np.eye(4)[k], order) if order else np.eye(4)[k], (x - brk[i]) / width) / width**order for k in range(4)]
        return row

    rules = [at(i, brk[i + 1], o) - at((i + 1) % n, brk[(i + 1) % n], o) for i in range(n) for o in range(3)]
    zero = [brk[-1]]
    for a, b in zip(sorted(t), sorted(t)[1:], strict=False):
        zero += [(a + b) / 2] if 0.75 < b - a < 1.2 else [a - 0.5, a + 0.5] if b - a >= 1.2 else []
    rules += [at(which(x), x, o) for x in zero if brk[0] <= x <= brk[-1] for o in (0, 1)]
    rules = np.array([r / np.abs(r).max() for r in rules])
    _, s, vt = np.linalg.svd(rules)
    free = vt[(s > 1e-10 * s[0]).sum() :].T
    fit = free @ np.linalg.lstsq(np.array([at(which(x), x) for x in t]) @ free, np.array(d), rcond=1e-12)[0]
    return brk, [float(at(i, (brk[i] + brk[i + 1]) / 2) @ fit) for i in range(n)]


def test_spline_fit_by_another_solver(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):  # few points a day, and enough
        compare_days(spark, folder)


def compare_days(spark, folder):
    inputs, days = spline_inputs(spark, folder)
    rows = inputs.where("near").toPandas()
    got = QUERIES["spline_fit"](spark, folder).toPandas()
    assert set(zip(got.source, got.date, strict=True)) == {(r.source, r.date) for r in days.collect()}
    checked = 0
    for (source, day), own in list(rows.groupby(["source", "date"]))[:25]:
        t, d, k = own.hours.tolist(), own.d.tolist(), own.track.tolist()
        first = min(x for x, j in zip(t, k, strict=True) if j == min(k))
        last = max(x for x, j in zip(t, k, strict=True) if j == max(k))
        ahead, behind = [x for x in np.arange(-5, first, 0.3)], [x for x in np.arange(last + 0.3, 29, 0.3)]
        t, d, k = [*ahead, *t, *behind], [0.0] * len(ahead) + d + [0.0] * len(behind), [min(k) - 1] * len(ahead) + k + [max(k) + 1] * len(behind)
        brk, middle = solved(t, d, k)
        one = got[(got.source == source) & (got.date == day)].sort_values("interval")
        np.testing.assert_allclose(one.lo, brk[:-1], atol=1e-6)
        np.testing.assert_allclose(one.hi, brk[1:], atol=1e-6)
        np.testing.assert_allclose(one.middle, middle, atol=3e-5)
        checked += 1
    assert checked > 5


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
