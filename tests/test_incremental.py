"""Incremental refresh: after every change the state equals a full build, and only what a change can reach is touched."""

import numpy as np
import pytest

from thermogrid.operators import grid as gr
from thermogrid.plans import incremental as inc
from thermogrid.session import delete_path, list_names

ROWS, COLS, SIGMA = 180, 360, 4.0


def frame(spark, pts):
    return spark.createDataFrame([(p, float(x), float(y), float(v)) for p, (x, y, v) in sorted(pts.items())],
                                 "pid string, x double, y double, v double")


def full(spark, pts):
    near = gr.nearest_points(frame(spark, pts), ROWS, COLS).checkpoint()
    blur = gr.gaussian_blur(near, ROWS, COLS, SIGMA).withColumnRenamed("v", "s")
    return {(r.r, r.c): (r.pid, r.v, r.d2, r.s) for r in near.join(blur, ["r", "c"]).collect()}


def same(spark, path, pts):
    got = {(r.r, r.c): (r.pid, r.v, r.d2, r.s) for r in inc.read_map_state(spark, path).collect()}
    want = full(spark, pts)
    assert len(got) == ROWS * COLS and got.keys() == want.keys()
    for k, (pid, v, d2, s) in want.items():
        g = got[k]
        assert g[:3] == (pid, v, d2) and abs(g[3] - s) < 1e-9, (k, g, want[k])


def stations(n=160):
    rng = np.random.default_rng(4)
    pts = {f"s{i:03d}": (float(x), float(y), float(v)) for i, (x, y, v) in
           enumerate(zip(rng.uniform(0, ROWS, n), rng.uniform(0, COLS, n), rng.normal(10, 5, n)))}
    pts["s000"] = (90.0, 100.0, 1.0)
    pts["t000"] = (90.0, 100.0, 7.0)  # same place: s000 counts
    return pts


def test_every_kind_of_change(spark, tmp):
    path, pts = f"{tmp}/state", stations()
    assert inc.refresh_state(frame(spark, pts), path, ROWS, COLS, SIGMA).full
    same(spark, path, pts)

    def step(change):
        change(pts)
        done = inc.refresh_state(frame(spark, pts), path, ROWS, COLS, SIGMA)
        assert not done.full
        same(spark, path, pts)
        return done

    one = step(lambda p: p.update(s010=(*p["s010"][:2], p["s010"][2] + 3)))
    mine = sum(1 for v in full(spark, pts).values() if v[0] == "s010")
    assert one.cells_nearest == mine and mine < one.cells_blurred < 0.1 * ROWS * COLS
    assert len(one.written) <= 8 and len(one.searched) <= 8  # of 18 blocks
    added = step(lambda p: p.update(n1=(33.3, 44.4, 99.0)))
    assert 0 < added.cells_nearest < 0.05 * ROWS * COLS
    step(lambda p: p.pop("s020"))
    step(lambda p: p.pop("s000"))           # t000 takes its place
    step(lambda p: p.update(a0=(90.0, 100.0, -4.0)))
    nothing = step(lambda p: None)
    assert nothing.written == [] and nothing.cells_nearest == nothing.cells_blurred == 0
    far = step(lambda p: p.update({k: (*p[k][:2], 0.5) for k in ("s030", "s031", "s032")}))
    assert far.cells_nearest < 0.1 * ROWS * COLS

    def many(p):
        for k in list(p)[::2]:
            p.pop(k)
    step(many)
    # only the last two generations keep points, manifests and files of their own
    assert len(inc.generations(spark, path)) == 2 and len(list_names(spark, f"{path}/points")) == 2


def test_a_dead_refresh_changes_nothing(spark, tmp):
    path, pts = f"{tmp}/state", stations(40)
    inc.refresh_state(frame(spark, pts), path, ROWS, COLS, SIGMA)
    before = inc.read_map_state(spark, path).orderBy("r", "c").collect()
    pts["s001"] = (*pts["s001"][:2], 50.0)
    done = inc.refresh_state(frame(spark, pts), path, ROWS, COLS, SIGMA)
    delete_path(spark, f"{path}/manifest/gen={done.gen}/_SUCCESS")  # as if it had died before the end
    assert inc.read_map_state(spark, path).orderBy("r", "c").collect() == before
    again = inc.refresh_state(frame(spark, pts), path, ROWS, COLS, SIGMA)
    assert again.gen == done.gen and again.cells_nearest == done.cells_nearest
    same(spark, path, pts)


def test_no_points_and_rebuild(spark, tmp):
    path, pts = f"{tmp}/state", stations(30)
    assert inc.refresh_state(frame(spark, pts).limit(0), path, ROWS, COLS, SIGMA) is None
    with pytest.raises(FileNotFoundError):
        inc.read_map_state(spark, path)
    kinds = []
    for i in range(3):
        pts["s002"] = (*pts["s002"][:2], float(i))
        kinds.append(inc.refresh_state(frame(spark, pts), path, ROWS, COLS, SIGMA, rebuild_every=2).full)
    assert kinds == [True, False, True]
    only = {"z": (5.0, 5.0, 2.0)}  # every winner is gone
    assert inc.refresh_state(frame(spark, only), path, ROWS, COLS, SIGMA, rebuild_every=100).full
    same(spark, path, only)
