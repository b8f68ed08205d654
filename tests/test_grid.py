"""Grid operators against plain numpy loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermogrid.operators import climatology as cl
from thermogrid.operators import grid as gr


def _points(spark, xs, ys, vs):
    rows = [(f"p{i:04d}", float(x), float(y), float(v)) for i, (x, y, v) in enumerate(zip(xs, ys, vs))]
    return spark.createDataFrame(rows, "pid string, x double, y double, v double")


def _brute(rows, cols, xs, ys):
    R, C = np.mgrid[0:rows, 0:cols]
    d2 = (R[..., None] - xs) ** 2 + (C[..., None] - ys) ** 2
    return np.argmin(d2, axis=-1), d2.min(axis=-1)  # argmin takes the first index = smallest pid


@pytest.mark.parametrize("rows,cols,n,tile,seed", [
    (30, 60, 7, 4, 1), (90, 180, 150, 8, 2), (36, 72, 1, 4, 3), (45, 90, 300, 2, 4), (18, 36, 5, 64, 5)])
def test_nearest_equals_brute_force(spark, rows, cols, n, tile, seed):
    rng = np.random.default_rng(seed)
    xs = rng.uniform(0, rows, n)
    ys = rng.uniform(0, cols, n)
    if n > 4:
        xs[:3] = np.round(xs[:3])          # points on cell centres
        ys[:3] = np.round(ys[:3])
        xs[4], ys[4] = xs[3], ys[3]        # two points at one position
        xs[0], ys[0] = rows, cols          # lat = -90, lon = 180: outside the cell range
    vs = rng.normal(size=n)
    out = gr.nearest_points(_points(spark, xs, ys, vs), rows, cols, tile).toPandas()
    assert len(out) == rows * cols
    best, d2 = _brute(rows, cols, xs, ys)
    got_v = np.full((rows, cols), np.nan)
    got_v[out.r, out.c] = out.v
    got_p = np.empty((rows, cols), dtype=object)
    got_p[out.r, out.c] = out.pid
    got_d = np.full((rows, cols), np.nan)
    got_d[out.r, out.c] = out.d2
    assert np.allclose(got_v, vs[best])
    assert (got_p == np.array([f"p{i:04d}" for i in range(n)])[best]).all()
    assert np.allclose(got_d, d2)


def test_nearest_ties_go_to_smallest_pid(spark):
    # two points at equal distance from cell (0, 1): (0, 0) and (0, 2)
    pts = spark.createDataFrame([("b", 0.0, 2.0, 2.0), ("a", 0.0, 0.0, 1.0)], "pid string, x double, y double, v double")
    out = {(r.r, r.c): r.pid for r in gr.nearest_points(pts, 1, 3, 1).collect()}
    assert out == {(0, 0): "a", (0, 1): "a", (0, 2): "b"}


def test_nearest_point_value_in_own_cell(spark):
    rng = np.random.default_rng(9)
    xs, ys = rng.integers(0, 40, 30).astype(float), rng.integers(0, 80, 30).astype(float)
    vs = rng.normal(size=30)
    out = gr.nearest_points(_points(spark, xs, ys, vs), 40, 80, 8).toPandas().set_index(["r", "c"])
    for x, y in zip(xs, ys):
        assert out.loc[(int(x), int(y)), "d2"] == 0.0


def test_nearest_rejects_far_points(spark):
    pts = spark.createDataFrame([("a", 1e6, 0.0, 1.0)], "pid string, x double, y double, v double")
    with pytest.raises(Exception):
        gr.nearest_points(pts, 10, 20, 4).collect()


def _mir(i, n):
    m = i % (2 * n)
    return m if m < n else 2 * n - 1 - m


@pytest.mark.parametrize("rows,cols,sigma", [(20, 30, 2.0), (7, 11, 3.0), (12, 24, 0.7)])
def test_blur_equals_direct_sum(spark, rows, cols, sigma):
    rng = np.random.default_rng(3)
    g = rng.normal(size=(rows, cols))
    df = spark.createDataFrame([(int(r), int(c), float(g[r, c])) for r in range(rows) for c in range(cols)],
                               "r int, c int, v double")
    out = gr.gaussian_blur(df, rows, cols, sigma).toPandas()
    w = gr.gaussian_weights(sigma)
    R = (len(w) - 1) // 2
    exp = np.zeros_like(g)
    for r in range(rows):
        for c in range(cols):
            exp[r, c] = sum(w[a + R] * w[b + R] * g[_mir(r + a, rows), _mir(c + b, cols)]
                            for a in range(-R, R + 1) for b in range(-R, R + 1))
    got = np.zeros_like(g)
    got[out.r, out.c] = out.v
    assert np.abs(got - exp).max() < 1e-12


def test_blur_keeps_constants_and_total(spark):
    rows, cols = 16, 24
    df = gr.grid_cells(spark, rows, cols).withColumn("v", F.lit(3.25))
    out = gr.gaussian_blur(df, rows, cols, 2.0).toPandas()
    assert np.allclose(out.v, 3.25)
    rng = np.random.default_rng(5)
    g = rng.normal(size=(rows, cols))
    df = spark.createDataFrame([(int(r), int(c), float(g[r, c])) for r in range(rows) for c in range(cols)],
                               "r int, c int, v double")
    assert abs(gr.gaussian_blur(df, rows, cols, 1.5).toPandas().v.sum() - g.sum()) < 1e-9


def test_blur_rejects_incomplete_lines(spark):
    df = gr.grid_cells(spark, 4, 5).where("not (r = 1 and c = 2)").withColumn("v", F.lit(1.0))
    with pytest.raises(Exception):
        gr.gaussian_blur(df, 4, 5, 1.0).collect()


def test_cells_flip_mask_difference(spark):
    cells = gr.grid_cells(spark, 3, 4)
    assert cells.count() == 12
    flipped = {(r.r, r.c) for r in gr.flip_rows(cells.where("r = 0"), 3).collect()}
    assert flipped == {(2, c) for c in range(4)}
    g = cells.withColumn("v", (F.col("r") * 10 + F.col("c")).cast("double"))
    mask = cells.withColumn("land", F.col("c") < 2).where("r < 2")   # row 2 missing from the mask
    m = {(r.r, r.c): r.v for r in gr.apply_land_mask(g, mask).collect()}
    assert m[(0, 1)] == 1.0 and m[(0, 3)] is None and m[(2, 0)] is None
    d = gr.grid_difference(g, g.withColumn("v", F.when(F.col("c") == 0, None).otherwise(F.col("v") - 1)))
    dd = {(r.r, r.c): r.diff for r in d.collect()}
    assert dd[(1, 1)] == 1.0 and dd[(1, 0)] is None


def _lattice(spark, f, day=3):
    rows = [(day, i - 89.5, j - 179.5, float(f(i - 89.5, j - 179.5))) for i in range(180) for j in range(360)]
    return spark.createDataFrame(rows, "day_number int, latitude double, longitude double, climatology double")


def test_upsample_exact_at_nodes_and_linear(spark):
    lin = lambda lat, lon: 2.0 * lat - 0.5 * lon + 7.0
    clim = _lattice(spark, lin)
    # scale 2 with shift 0: row r is latitude 90 - r/2, column c is longitude c/2 - 180
    cells = gr.grid_cells(spark, 360, 720)
    out = cl.upsample_reference(clim, cells, 2.0, ref_row_shift=0).toPandas()
    lat = 90 - out.r / 2.0
    lon = out.c / 2.0 - 180
    inside = (lat >= -89.5) & (lat <= 89.5) & (lon >= -179.5) & (lon <= 179.5)
    assert out.v[~inside].isna().all()
    assert np.abs(out.v[inside] - lin(lat[inside], lon[inside])).max() < 1e-9
    assert set(out.taps[inside]) <= {16, 4, 1}


def test_upsample_falls_back_where_taps_miss(spark):
    f = lambda lat, lon: lat + lon
    clim = _lattice(spark, f).where("not (latitude = 0.5 and longitude = 0.5)")
    # scale 2, shift 0: (177, 360) is lat 1.5 / lon 0 (cubic stencil hits the hole,
    # the bilinear square does not); (179, 361) sits on the hole itself
    cells = spark.createDataFrame([(177, 360), (179, 361)], "r int, c int")
    out = cl.upsample_reference(clim, cells, 2.0, ref_row_shift=0).toPandas().set_index(["r", "c"])
    assert out.loc[(177, 360), "taps"] == 4
    assert abs(out.loc[(177, 360), "v"] - f(1.5, 0.0)) < 1e-9
    assert out.loc[(179, 361), "taps"] == 1           # nearest existing corner: (0.5, 1.5)
    assert abs(out.loc[(179, 361), "v"] - f(0.5, 1.5)) < 1e-9


@pytest.mark.parametrize("square,n", [(8, 400), (1, 200), (60, 400)])
def test_nearest_of_clustered_points(spark, square, n):
    # every point in one small square, far from most of the map
    rng = np.random.default_rng(square)
    xs, ys = 70 + rng.uniform(0, square, n), 30 + rng.uniform(0, square, n)
    out = gr.nearest_points(_points(spark, xs, ys, np.arange(n)), 90, 180, 8).toPandas()
    best, d2 = _brute(90, 180, xs, ys)
    got = np.full((90, 180), -1)
    got[out.r, out.c] = out.v.astype(int)
    assert len(out) == 90 * 180 and (got == best).all()


def test_candidates_follow_cells_and_points_when_clustered(spark):
    # each level's candidate rows stay within a small multiple of cells plus points
    rng = np.random.default_rng(5)
    n = 5000
    for square in (8, 180):
        xs, ys = rng.uniform(0, square, n), rng.uniform(0, square, n)
        cand = _points(spark, xs, ys, np.zeros(n)).selectExpr("0L tr", "0L tc", "pid", "x", "y", "v")
        for side in (64, 8):
            cand = gr._narrowed(cand, side, 180, 360).checkpoint(eager=True)
            assert cand.count() <= 4 * (n + 180 * 360 // 64)


def test_nearest_needs_coordinates(spark):
    pts = spark.createDataFrame([("a", None, 0.0, 1.0)], "pid string, x double, y double, v double")
    with pytest.raises(Exception):
        gr.nearest_points(pts, 10, 20, 4).collect()


def test_a_batch_passes_on_the_closest_rows_only():
    """10,000 candidates of one tile of 64 cells: as many rows as cells, not 640,000; ties are kept."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    n = 10_000
    x, y = rng.uniform(8, 16, n), rng.uniform(16, 24, n)
    x[:2], y[:2] = (9.5, 10.5), (18.0, 18.0)  # both as far from the cell (10, 18)
    x[2:], y[2:] = np.where(np.hypot(x[2:] - 10, y[2:] - 18) < 0.6, 15.9, x[2:]), y[2:]
    b = pa.RecordBatch.from_arrays([pa.array(np.full(n, k)) for k in (1, 2)] + [pa.array([str(i) for i in range(n)]), pa.array(x),
                                    pa.array(y), pa.array(x)], names=gr.CAND)
    got = {}
    for r, c, d2, _, take in gr._closest([b], 8, 1, 8, 90, 180):
        for k in zip(r.tolist(), c.tolist(), d2.tolist(), take.to_pylist()):
            got.setdefault(k[:2], []).append(k[2:])
    assert len(got) == 64 and sum(map(len, got.values())) == 65
    assert sorted(i for _, i in got[10, 18]) == [0, 1]
    for (r, c), best in got.items():
        d2 = (r - x) * (r - x) + (c - y) * (c - y)
        assert {i for _, i in best} == set(np.flatnonzero(d2 == d2.min()).tolist())
