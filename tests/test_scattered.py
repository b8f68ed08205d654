"""Scattered interpolation against a plain one-machine version, linear fields, smoothness, ties."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF01
from thermogrid.operators import scattered as S


def in_circle(a, b, c, d):
    """d strictly inside the circle of the counterclockwise triangle a, b, c; exact."""
    m = [[Fraction(p[0]) - Fraction(d[0]), Fraction(p[1]) - Fraction(d[1])] for p in (a, b, c)]
    for r in m:
        r.append(r[0] ** 2 + r[1] ** 2)
    return (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
            + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])) > 0


def turn(a, b, c):
    d = (Fraction(b[0]) - Fraction(a[0])) * (Fraction(c[1]) - Fraction(a[1])) - (Fraction(b[1]) - Fraction(a[1])) * (Fraction(c[0]) - Fraction(a[0]))
    return (d > 0) - (d < 0)


def plain_triangles(pts):
    """Every edge grows the triangle whose circle is empty: gift wrapping with numpy over all points."""
    xy = np.array(pts)
    done, out = set(), set()
    i = int(np.lexsort((xy[:, 1], xy[:, 0]))[0])
    d = ((xy - xy[i]) ** 2).sum(axis=1)
    d[i] = np.inf
    j = int(d.argmin())  # the nearest pair of a point is an edge
    todo = [(i, j), (j, i)]
    while todo:
        a, b = todo.pop()
        if (a, b) in done:
            continue
        done.add((a, b))
        e = xy[b] - xy[a]
        cross = e[0] * (xy[:, 1] - xy[a, 1]) - e[1] * (xy[:, 0] - xy[a, 0])
        left = np.flatnonzero(cross > 1e-12 * np.abs(e).sum())
        left = left[(left != a) & (left != b)]
        if not left.size:
            continue
        p = xy[left]
        # apex of the smallest signed centre height above the edge
        mid = (xy[a] + xy[b]) / 2
        height = ((p - mid) ** 2).sum(axis=1) - (e @ e) / 4
        c = int(left[np.argmin(height / cross[left])])
        out.add(frozenset((a, b, c)))
        todo += [(c, b), (a, c)]
    return out


def got_triangles(spark, pts, tile_points):
    df = spark.createDataFrame([(float(x), float(y), 0.0) for x, y in pts], "x double, y double, v double").checkpoint()
    where = {(float(x), float(y)): i for i, (x, y) in enumerate(pts)}
    rows = S.triangles(df, len(pts), tile_points).collect()
    assert all(turn((r.xa, r.ya), (r.xb, r.yb), (r.xc, r.yc)) > 0 for r in rows)
    return [frozenset((where[r.xa, r.ya], where[r.xb, r.yb], where[r.xc, r.yc])) for r in rows]


@pytest.mark.parametrize("tile_points", [30, 250, 5000])
def test_triangles_of_random_points(spark, tile_points):
    rng = np.random.default_rng(tile_points)
    pts = rng.uniform(-100, 100, (700, 2))
    pts[:250] = pts[:250] / 400 + 7  # a third of them in one spot
    pts[250:300, 0] = 90
    got = got_triangles(spark, pts.tolist(), tile_points)
    assert len(got) == len(set(got)) and set(got) == plain_triangles(pts.tolist())


@pytest.mark.parametrize("tile_points", [8, 60])
def test_lattice_ties(spark, tile_points):
    pts = [(i, j) for i in range(12) for j in range(9)]
    random.Random(3).shuffle(pts)
    got = got_triangles(spark, pts, tile_points)
    # all squares are circles: any diagonal will do, the same one for both halves
    assert len(got) == len(set(got)) == 2 * 11 * 8
    area = 0
    for t in got:
        a, b, c = (pts[i] for i in t)
        area += abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    assert area == 2 * 11 * 8
    for t in got:
        a, b, c = sorted(pts[i] for i in t)
        if turn(a, b, c) < 0:
            b, c = c, b
        assert not any(in_circle(a, b, c, p) for p in pts)


def plain_field(pts, v, tri, cells):
    """Gradients and Bezier patches again, triangle by triangle; checked against the definition
    of C1 pieces by solving for each patch what its edges ask."""
    xy, v = np.array(pts, float), np.array(v, float)
    sums = np.zeros((len(xy), 5))
    for t in tri:
        for a, b in itertools.permutations(t, 2):
            dx, dy = xy[b] - xy[a]
            w = 1 / (dx * dx + dy * dy)
            sums[a] += w * np.array([dx * dx, dx * dy, dy * dy, dx * (v[b] - v[a]), dy * (v[b] - v[a])])
    grad = np.zeros((len(xy), 2))
    for i, (xx, xy_, yy, xv, yv) in enumerate(sums):
        if xx * yy - xy_ ** 2 > 0:
            grad[i] = np.linalg.solve([[xx, xy_], [xy_, yy]], [xv, yv])
    out = np.full(len(cells), np.nan)
    for t in tri:
        a, b, c = (xy[i] for i in t)
        m = np.linalg.inv(np.array([[a[0], b[0], c[0]], [a[1], b[1], c[1]], [1, 1, 1]]))
        bary = np.c_[cells, np.ones(len(cells))] @ m.T
        for k in np.flatnonzero((bary >= -1e-11).all(axis=1)):
            out[k] = _patch_value(xy, v, grad, list(t), bary[k])
    return out


def _patch_value(xy, v, grad, t, bary):
    """The cubic of one patch from its conditions: 10 ordinates of three patches by de Casteljau."""
    mid = xy[t].mean(axis=0)
    k = int(np.argmin(bary))
    i, j = [n for n in range(3) if n != k]

    def normal_mid(p, q):
        """Ordinate inside the patch (p, q, mid) that makes the slope across p q linear along it."""
        e = xy[q] - xy[p]
        n = np.array([-e[1], e[0]])
        lam = np.linalg.solve(np.array([[xy[p][0], xy[q][0], mid[0]], [xy[p][1], xy[q][1], mid[1]], [1, 1, 1]]), np.array([*n, 0.0]))
        pq, qp = v[p] + e @ grad[p] / 3, v[q] - e @ grad[q] / 3
        first, last = grad[p] @ n / 3, grad[q] @ n / 3
        return ((first + last) / 2 - lam[0] * pq - lam[1] * qp) / lam[2]

    inner = {}
    for a, b in itertools.combinations(range(3), 2):
        inner[a, b] = inner[b, a] = normal_mid(t[a], t[b])
    spoke = [v[t[a]] + (mid - xy[t[a]]) @ grad[t[a]] / 3 for a in range(3)]
    ring = [(spoke[a] + sum(inner[a, b] for b in range(3) if b != a)) / 3 for a in range(3)]
    ords = {(3, 0, 0): v[t[i]], (0, 3, 0): v[t[j]], (0, 0, 3): sum(ring) / 3,
            (2, 1, 0): v[t[i]] + (xy[t[j]] - xy[t[i]]) @ grad[t[i]] / 3, (1, 2, 0): v[t[j]] + (xy[t[i]] - xy[t[j]]) @ grad[t[j]] / 3,
            (2, 0, 1): spoke[i], (0, 2, 1): spoke[j], (1, 0, 2): ring[i], (0, 1, 2): ring[j], (1, 1, 1): inner[i, j]}
    u = (bary[i] - bary[k], bary[j] - bary[k], 3 * bary[k])
    for n in (2, 1, 0):
        ords = {(a, b, n - a - b): u[0] * ords[a + 1, b, n - a - b] + u[1] * ords[a, b + 1, n - a - b] + u[2] * ords[a, b, n - a - b + 1]
                for a in range(n + 1) for b in range(n + 1 - a)}
    return ords[0, 0, 0]


def test_two_thousand_points_of_customer(spark):
    """Whole field of 2,000 random points against the plain version, for two sizes of tiles."""
    keys = [r.c_custkey for r in spark.read.parquet(f"{SF01}/customer.parquet").select("c_custkey").orderBy("c_custkey").collect()]
    rng = np.random.default_rng(11)
    pts = np.unique(np.stack([rng.uniform(0, 60, 2000), rng.uniform(0, 120, 2000)], axis=1), axis=0)
    v = [float(keys[i % len(keys)] % 37 + 0.1 * x) for i, (x, y) in enumerate(pts)]
    rows, cols = 61, 121
    cells = np.array([(r, c) for r in range(rows) for c in range(cols)], float)
    want = plain_field(pts, v, [tuple(t) for t in plain_triangles(pts.tolist())], cells)
    df = spark.createDataFrame([(f"p{i}", float(x), float(y), v[i]) for i, (x, y) in enumerate(pts)], "pid string, x double, y double, v double")
    for tile_points in (120, 400):
        got = {(r.r, r.c): r.v for r in S.interpolate_scattered(df, rows, cols, tile_points).collect()}
        assert len(got) == rows * cols
        for (r, c), w in zip(cells.astype(int).tolist(), want):
            g = got[r, c]
            assert (g is None) == bool(np.isnan(w)) and (g is None or abs(g - w) < 1e-7), (r, c, g, w)


def test_linear_fields_are_exact_and_the_rest_is_null(spark):
    rng = np.random.default_rng(2)
    xy = rng.uniform(5, 35, (300, 2))
    df = spark.createDataFrame([(str(i), x, y, 2 * x - 3 * y + 1) for i, (x, y) in enumerate(xy.tolist())], "pid string, x double, y double, v double")
    rows = S.interpolate_scattered(df, 40, 40, 40).collect()
    inside = [r for r in rows if r.v is not None]
    assert len(rows) == 1600 and 600 < len(inside) < 900
    assert max(abs(r.v - (2 * r.r - 3 * r.c + 1)) for r in inside) < 1e-9
    assert all(r.v is None for r in rows if r.r < 5 or r.c > 35)


def test_values_and_slopes_are_continuous():
    rng = np.random.default_rng(9)
    quad = np.array([[0, 0], [4, 0.5], [3.5, 4], [-0.5, 3]])
    f, g = rng.normal(size=4), rng.normal(size=(4, 2))
    tris = [(0, 1, 2), (0, 2, 3)]
    t = {}
    for k, n in zip("abc", range(3)):
        ids = [x[n] for x in tris]
        t |= {f"x{k}": quad[ids, 0], f"y{k}": quad[ids, 1], f"v{k}": f[ids], f"gx{k}": g[ids, 0], f"gy{k}": g[ids, 1]}
    at = np.linspace(0.05, 0.95, 19)[:, None] * quad[2]
    n = np.array([-quad[2][1], quad[2][0]]) / np.hypot(*quad[2])
    h = 1e-5
    value = lambda which, p: S.surface(t, np.full(len(p), which), p[:, 0], p[:, 1])[0]
    assert np.allclose(value(0, at), value(1, at), atol=1e-12)
    one = (value(0, at) - value(0, at - h * n)) / h
    two = (value(1, at + h * n) - value(1, at)) / h
    assert np.allclose(one, two, atol=1e-3)
    # across the inner edges of one triangle
    mid = quad[[0, 1, 2]].mean(axis=0)
    p = quad[0] + np.linspace(0.1, 0.9, 9)[:, None] * (mid - quad[0])
    d = np.array([1.0, -0.3])
    left, right = (value(0, p) - value(0, p - h * d)) / h, (value(0, p + h * d) - value(0, p)) / h
    assert np.allclose(left, right, atol=1e-3)


def test_few_points_and_bad_ones(spark):
    schema = "pid string, x double, y double, v double"
    bad = [("n1", None, 1.0, 1.0), ("n2", 1.0, float("nan"), 1.0), ("n3", 1.0, 1.0, None)]
    for rows in ([], bad, [("a", 1.0, 1.0, 1.0), ("b", 3.0, 3.0, 1.0)], [(str(i), float(i), 2.0 * i, 1.0) for i in range(6)]):
        out = S.interpolate_scattered(spark.createDataFrame(rows, schema), 4, 4).collect()
        assert len(out) == 16 and all(r.v is None for r in out)
    three = [("b", 0.0, 0.0, 9.0), ("a", 0.0, 0.0, 1.0), ("c", 0.0, 3.0, 1.0), ("d", 3.0, 0.0, 1.0), *bad]
    out = {(r.r, r.c): r.v for r in S.interpolate_scattered(spark.createDataFrame(three, schema), 4, 4).collect()}
    assert all((out[r, c] is not None) == (r + c <= 3) for r in range(4) for c in range(4))
    assert all(abs(v - 1) < 1e-12 for v in out.values() if v is not None)


def test_stars_of_clusters_take_few_points(monkeypatch):
    """Points in tight clusters, whose hulls see far: the same stars as among all points, from a few."""
    rng = np.random.default_rng(11)
    at = rng.uniform(0, 40, (60, 2))
    p = np.unique((at[:, None, :] + rng.integers(0, 9, (60, 25, 2)) / 64).reshape(-1, 2), axis=0)
    most, init = [], S.Site.__init__
    monkeypatch.setattr(S.Site, "__init__", lambda self, px, py, xs, ys: (most.append(xs.size), init(self, px, py, xs, ys))[1])
    around = lambda ring, closed: set(zip(ring, ring[1:] + ring[:1] if closed else ring[1:]))
    for i in range(0, len(p), 9):
        q = np.delete(p, i, axis=0)
        most.clear()
        ring, closed, _ = S.star_of(*p[i], q[:, 0], q[:, 1])
        used = max(most)
        want, shut = S.Site(*p[i], q[:, 0], q[:, 1]).star(list(range(len(q))))
        assert closed == shut and around(ring.tolist(), closed) == around(want, shut)
        assert used < 200 or not shut
