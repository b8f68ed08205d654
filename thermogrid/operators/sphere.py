"""J1 on the globe: for every grid cell the nearest station by distance on the sphere.

Cells and stations are unit vectors; the squared chord between two of them orders pairs like the
distance along the surface, so the date line and the poles need no care. The grid is cut
into blocks of ``BLOCK`` x ``BLOCK`` cells, each with a box around its cells' vectors. One pass over
the stations gives each block the least bound within which some station lies from all of its
cells (a minimum per block); a second pass keeps for each block the stations whose least
distance to the box is within that bound. These are compared with the block's cells, in
parts of ``PART`` stations, and the minima of the parts meet. All tables of blocks are bounded by the grid.

Squared chords are rounded to 12 digits before they are compared, so distances that are equal
but for rounding go to the smallest ``pid`` wherever they are computed. Stations with a
null, NaN or infinite position raise an error; without stations the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.session import checkpoint_root

BLOCK = 32
PART = 4096
DIGITS = 12
SLACK = 1e-9


def unit_vectors(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    a, b = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)], axis=1)


def _cells(rows: int, cols: int, block: int):
    """Cells of a block: r, c and unit vectors."""
    across = -(-cols // BLOCK)
    r0, c0 = block // across * BLOCK, block % across * BLOCK
    r, c = (a.ravel() for a in np.meshgrid(np.arange(r0, min(r0 + BLOCK, rows)), np.arange(c0, min(c0 + BLOCK, cols)), indexing="ij"))
    scale = rows / 180.0
    return r, c, unit_vectors(c / scale - 180.0, 90.0 - r / scale)


def _boxes(rows: int, cols: int) -> np.ndarray:
    n = -(-rows // BLOCK) * -(-cols // BLOCK)
    out = np.empty((n, 2, 3))
    for b in range(n):
        v = _cells(rows, cols, b)[2]
        out[b] = v.min(axis=0), v.max(axis=0)
    return out


def _least(box: np.ndarray, v: np.ndarray) -> np.ndarray:
    d = np.maximum(np.maximum(box[0] - v, v - box[1]), 0)
    return (d * d).sum(axis=-1)


def _most(box: np.ndarray, v: np.ndarray) -> np.ndarray:
    d = np.maximum(np.abs(box[0] - v), np.abs(box[1] - v))
    return (d * d).sum(axis=-1)


STATION = "pid string, v double, x double, y double, z double"


def nearest_on_sphere(stations: DataFrame, rows: int, cols: int) -> DataFrame:
    """``r, c, pid, v, d2`` for every cell of a ``rows`` x ``cols`` grid (row 0 at the north pole,
    column 0 at longitude -180) from stations ``pid, lon, lat, v``; ``d2`` is the squared chord."""
    spark = stations.sparkSession
    checkpoint_root(spark)
    num = lambda c: F.col(c).cast("double")
    sure = F.coalesce(F.abs(num("lon")).between(0, 360) & F.abs(num("lat")).between(0, 90), F.lit(False))
    guard = F.when(sure, F.lit(True)).otherwise(F.raise_error(F.lit("nearest_on_sphere: station off the globe, or without coordinates")))
    src = stations.where(guard).select(F.col("pid").cast("string").alias("pid"), num("v").alias("v"), num("lon").alias("lon"), num("lat").alias("lat"))

    def placed(batches):
        for b in batches:
            xyz = unit_vectors(b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(xyz[:, k]) for k in range(3)]], names=["pid", "v", "x", "y", "z"])

    pts = src.mapInArrow(placed, STATION).checkpoint(eager=True)
    boxes = spark.sparkContext.broadcast(_boxes(rows, cols))  # one per block of the grid

    def vectors(batch) -> np.ndarray:
        return np.stack([batch.column(k).to_numpy() for k in (2, 3, 4)], axis=1)

    def bounds(batches):
        least = np.full(len(boxes.value), np.inf)
        for b in batches:
            v = vectors(b)
            if len(v):
                least = np.minimum(least, [_most(box, v).min() for box in boxes.value])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(least.size, dtype=np.int32)), pa.array(least)], names=["block", "reach"])

    got = pts.mapInArrow(bounds, "block int, reach double").groupBy("block").agg(F.min("reach").alias("reach")).toArrow()
    reach = np.full(len(boxes.value), np.inf)
    reach[got.column("block").to_numpy()] = got.column("reach").to_numpy()
    shared = spark.sparkContext.broadcast(reach + SLACK)

    def near(batches):
        for b in batches:
            v = vectors(b)
            for k, box in enumerate(boxes.value):
                at = np.flatnonzero(_least(box, v) <= shared.value[k])
                if at.size:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(at.size, k, np.int32)), *[c.take(pa.array(at)) for c in b.columns]],
                                                     names=["block", "pid", "v", "x", "y", "z"])

    cand = pts.mapInArrow(near, f"block int, {STATION}").checkpoint(eager=True)
    sizes = cand.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    cand = cand.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int"))

    def best(key, table):
        r, c, cell = _cells(rows, cols, key[0].as_py())
        pid = table.column("pid").to_pylist()
        order = np.array(sorted(range(len(pid)), key=lambda i: (pid[i] or "").encode()))
        v = np.stack([table.column(k).to_numpy() for k in ("x", "y", "z")], axis=1)[order]
        value = table.column("v").combine_chunks().take(pa.array(order))
        at, d2 = np.empty(r.size, np.int64), np.empty(r.size)
        step = max(1, (1 << 20) // len(v))
        for i in range(0, r.size, step):
            d = np.zeros((len(cell[i:i + step]), len(v)))
            for k in range(3):
                d += (cell[i:i + step, k, None] - v[:, k]) ** 2
            d = np.round(d, DIGITS)
            at[i:i + step] = d.argmin(axis=1)  # the first of equal ones
            d2[i:i + step] = d[np.arange(len(d)), at[i:i + step]]
        names = pa.array([pid[i] for i in order], pa.string())
        return pa.table({"r": pa.array(r.astype(np.int32)), "c": pa.array(c.astype(np.int32)), "pid": names.take(pa.array(at)),
                         "v": value.take(pa.array(at)), "d2": pa.array(d2)})

    found = cand.groupBy("block", "part").applyInArrow(best, "r int, c int, pid string, v double, d2 double")
    return (found.groupBy("r", "c").agg(F.min(F.struct("d2", "pid", "v")).alias("b"))
            .select("r", "c", "b.pid", "b.v", "b.d2"))
