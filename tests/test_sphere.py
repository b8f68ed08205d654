"""Nearest on the sphere: brute force on whole grids, date line, poles, clusters, ties, bad stations."""

import numpy as np
import pytest

from thermogrid.operators import sphere as S


def frame(spark, rows):
    return spark.createDataFrame(rows, "pid string, lon double, lat double, v double")


def brute(rows, n, m):
    rows = sorted(rows)
    v = S.unit_vectors(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    scale = n / 180
    out = {}
    for i in range(n):
        cell = S.unit_vectors(np.arange(m) / scale - 180.0, np.full(m, 90.0 - i / scale))
        d = np.round(((cell[:, None, :] - v) ** 2).sum(axis=2), 12)
        for j, k in enumerate(d.argmin(axis=1)):
            out[i, j] = (rows[k][0], rows[k][3], d[j, k])
    return out


def check(spark, rows, n=90, m=180):
    got = {(r.r, r.c): (r.pid, r.v, r.d2) for r in S.nearest_on_sphere(frame(spark, rows), n, m).collect()}
    want = brute(rows, n, m)
    assert got.keys() == want.keys()
    for k, (pid, v, d2) in want.items():
        assert got[k][:2] == (pid, v) and abs(got[k][2] - d2) < 2e-12, (k, got[k], want[k])
    return got


@pytest.mark.parametrize("part", [7, 4096])
def test_random_and_clustered(spark, monkeypatch, part):
    monkeypatch.setattr(S, "PART", part)
    rng = np.random.default_rng(part)
    rows = [(f"s{i}", float(a), float(b), float(i)) for i, (a, b) in enumerate(zip(rng.uniform(-180, 180, 150), rng.uniform(-90, 90, 150)))]
    rows += [(f"t{i}", 10 + float(a), 50 + float(b), float(i)) for i, (a, b) in enumerate(rng.uniform(0, 0.5, (100, 2)))]
    check(spark, rows)


def test_date_line_and_poles(spark):
    got = check(spark, [("east", 179.5, 0.0, 1.0), ("west", -60.0, 0.0, 2.0), ("north", 0.0, 89.0, 3.0), ("south", 120.0, -90.0, 4.0)])
    assert got[45, 0][0] == "east"       # longitude -180
    assert {got[0, c][0] for c in range(180)} == {"north"}
    assert got[1, 90][0] == got[1, 0][0] == "north"


def test_ties_and_none(spark):
    got = check(spark, [("b", 10.0, 80.0, 1.0), ("a", -100.0, 80.0, 2.0), ("a2", -100.0, 80.0, 5.0)])
    assert got[0, 0][0] == "a"           # the pole is as far from all three
    assert S.nearest_on_sphere(frame(spark, []), 18, 36).count() == 0
    for bad in (("x", None, 1.0, 1.0), ("x", 1.0, float("nan"), 1.0), ("x", 1.0, 91.0, 1.0)):
        with pytest.raises(Exception, match="off the globe"):
            S.nearest_on_sphere(frame(spark, [("a", 0.0, 0.0, 1.0), bad]), 18, 36).count()
