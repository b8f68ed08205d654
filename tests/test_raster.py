"""PNG tiles: pixels equal the levels, overviews, commits of dead jobs, pictures other readers accept."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermogrid.sources import raster as R

ROWS, COLS = 90, 180


def cells(spark, shift=0.0):
    r = F.expr(f"cast(id div {COLS} as int)")
    c = F.expr(f"cast(id % {COLS} as int)")
    diff = F.sin(F.col("id") / 97.0) * 12 + shift
    return spark.range(ROWS * COLS).select(r.alias("r"), c.alias("c"), F.when(F.col("id") % 7 != 0, diff).alias("diff"))


def level(d):
    return min(255, int(np.floor((min(max(d, -10), 10) + 10) / 20 * 256)))


def test_pictures_round_trip():
    rng = np.random.default_rng(0)
    full, holes = rng.integers(0, 256, (20, 30)), rng.integers(1, 257, (16, 16))
    for x in (full, holes, np.full((4, 4), R.EMPTY), np.zeros((3, 5), int)):
        assert (R.decode_png(R.encode_png(x)) == x).all()
    colours = R.palette()
    assert colours.shape == (256, 3) and colours[0][2] > colours[0][0] and colours[255][0] > colours[255][2]
    bad = bytearray(R.encode_png(full))
    bad[-20] ^= 1
    with pytest.raises(ValueError):
        R.decode_png(bytes(bad))


def test_pixels_equal_levels_at_every_depth(spark, tmp):
    R.write_map_tiles(cells(spark), tmp, ROWS, COLS, tile=64)
    told = R.read_pointer(tmp)
    assert told["levels"] == 3 and told["tile"] == 64
    got = {(r.z, r.r, r.c): r.level for r in R.read_map_tiles(spark, tmp).collect()}
    grid = np.full((ROWS, COLS), np.nan)
    for r in cells(spark).collect():
        grid[r.r, r.c] = np.nan if r.diff is None else min(max(r.diff, -10), 10)
    want = {}
    for z in (2, 1, 0):
        k = 1 << (2 - z)
        for i in range(0, ROWS, k):
            for j in range(0, COLS, k):
                block = grid[i:i + k, j:j + k]
                if not np.isnan(block).all():
                    want[z, i // k, j // k] = level(np.nanmean(block))
    assert got.keys() == want.keys()
    # level 0 shares index 1 where a tile has transparent pixels; rounding may move a mean across a border
    assert all(abs(got[k] - max(want[k], 1)) <= (1 if k[0] < 2 else 0) for k in want)
    assert sum(got[k] != max(want[k], 1) for k in want) < 5


def test_a_new_map_replaces_the_old_one(spark, tmp):
    R.write_map_tiles(cells(spark), tmp, ROWS, COLS, tile=64)
    first = R.read_pointer(tmp)["map"]
    R.write_map_tiles(cells(spark, 3.0), tmp, ROWS, COLS, tile=64)
    second = R.read_pointer(tmp)["map"]
    os.makedirs(f"{tmp}/pending-dead/2")
    assert first != second and os.path.isdir(f"{tmp}/{first}")  # readers of the old one may go on
    R.write_map_tiles(cells(spark, 4.0), tmp, ROWS, COLS, tile=64)
    left = sorted(x for x in os.listdir(tmp) if os.path.isdir(f"{tmp}/{x}"))
    assert left == sorted([second, R.read_pointer(tmp)["map"]])


def test_a_failed_job_leaves_the_served_map(spark, tmp):
    with pytest.raises(FileNotFoundError):
        R.read_map_tiles(spark, tmp)
    R.write_map_tiles(cells(spark), tmp, ROWS, COLS, tile=64)
    before = (R.read_pointer(tmp), sorted(map(tuple, R.read_map_tiles(spark, tmp).collect())))
    broken = cells(spark, 5.0).withColumn("diff", F.when(F.col("r") == 80, F.raise_error(F.lit("lost"))).otherwise(F.col("diff")))
    with pytest.raises(Exception, match="lost"):
        R.write_map_tiles(broken, tmp, ROWS, COLS, tile=64)
    assert (R.read_pointer(tmp), sorted(map(tuple, R.read_map_tiles(spark, tmp).collect()))) == before
    # a task that dies after its first tiles: nothing of it is served
    writer = R.TileWriter({"path": tmp, "tile": "64"})

    def dies():
        import pyarrow as pa
        n = 10
        yield pa.RecordBatch.from_pydict({**{k: pa.array([i % 2] * n, pa.int32()) for i, k in enumerate(("z", "tr", "tc"))},
                                          "i": pa.array(range(n), pa.int32()), "j": pa.array(range(n), pa.int32()), "level": pa.array([7] * n, pa.int32())})
        yield pa.RecordBatch.from_pydict({**{k: pa.array([3] * n, pa.int32()) for k in ("z", "tr", "tc")},
                                          "i": pa.array(range(n), pa.int32()), "j": pa.array(range(n), pa.int32()), "level": pa.array([7] * n, pa.int32())})
        raise OSError("killed")

    with pytest.raises(OSError):
        writer.write(dies())
    assert any(x.startswith("pending-") for x in os.listdir(tmp))
    assert R.read_pointer(tmp) == before[0]
    writer.abort([None])
    R.write_map_tiles(cells(spark), tmp, ROWS, COLS, tile=64)
    assert not any(x.startswith("pending-") for x in os.listdir(tmp))


def test_an_empty_map(spark, tmp):
    R.write_map_tiles(cells(spark).limit(0), tmp, ROWS, COLS, tile=64)
    assert R.read_pointer(tmp)["levels"] == 3 and R.read_map_tiles(spark, tmp).count() == 0
