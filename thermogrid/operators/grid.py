"""Grid operators: cells, flip, points, exact nearest neighbour, blur, mask, difference.

A grid is a long DataFrame ``r int, c int, v double`` with row 0 at the north
edge and column 0 at longitude -180 (``scale`` cells per degree, so 180*scale
rows and 360*scale columns). Distances are planar in grid units, as in the
reference (no wrap at +-180).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermogrid.functions.columns import grid_x, grid_y
from thermogrid.session import checkpoint_root, work_partitions


def grid_shape(scale: float) -> tuple[int, int]:
    rows, cols = int(round(180 * scale)), int(round(360 * scale))
    if rows <= 0 or abs(rows - 180 * scale) > 1e-9 or abs(cols - 360 * scale) > 1e-9:
        raise ValueError(f"scale must give whole rows and columns, got {scale}")
    return rows, cols


def grid_cells(spark: SparkSession, rows: int, cols: int) -> DataFrame:
    """Every cell ``r, c`` of a rows x cols grid (the index mesh)."""
    return spark.range(0, rows * cols).select(F.expr(f"cast(id div {cols} as int)").alias("r"),
                                              F.expr(f"cast(id % {cols} as int)").alias("c"))


def flip_rows(df: DataFrame, rows: int, r: str = "r") -> DataFrame:
    """Up-down flip, ``r -> rows-1-r`` (narrow, no shuffle)."""
    return df.withColumn(r, (F.lit(rows - 1) - F.col(r)).cast("int"))


def to_points(df: DataFrame, scale: float, pid: str = "city_and_loc", value: str = "avg_temp",
              lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Stations to grid points ``pid, x, y, v`` (x = row axis, y = column axis)."""
    return df.select(F.col(pid).cast("string").alias("pid"), grid_x(lat, scale).alias("x"),
                     grid_y(lon, scale).alias("y"), F.col(value).cast("double").alias("v"))


FAN = 8             # a tile has FAN x FAN children, one level below
LEAF_POINTS = 16384  # candidates that one task takes for all cells of their leaf, about
TASK_POINTS = 100_000  # candidates that one task hands to children, about
STEP = 1 << 20      # distances computed together
CAND = ["tr", "tc", "pid", "x", "y", "v"]


def _d2(x, y, px, py):
    return (x - px) * (x - px) + (y - py) * (y - py)


def _closest(batches, n: int, side: int, step: int, rows: int, cols: int):
    """For each tile of candidates (``CAND``) the ``n`` x ``n`` places ``side`` apart from its first corner, the tile being
    ``step`` of them wide: yields (i, j, d2, batch, rows) with the closest candidates of a piece of the rows, ties included."""
    for batch in batches:
        tr, tc, _, x, y, _ = (c if k == 2 or k == 5 else c.to_numpy(zero_copy_only=False) for k, c in enumerate(batch.columns))
        order = np.lexsort((tc, tr))
        size = max(1, STEP // (n * n))
        for lo in range(0, order.size, size):
            part = order[lo:lo + size]
            first = np.append(True, (tr[part][1:] != tr[part][:-1]) | (tc[part][1:] != tc[part][:-1]))
            i = tr[part][:, None] * step + np.arange(n)
            j = tc[part][:, None] * step + np.arange(n)
            px, py = x[part][:, None], y[part][:, None]
            dx, dy = i * side - px, j * side - py
            d2 = (dx * dx)[:, :, None] + (dy * dy)[:, None, :]
            least = np.minimum.reduceat(d2, np.flatnonzero(first), axis=0)
            hit = (d2 == least[np.cumsum(first) - 1]) & (i < rows)[:, :, None] & (j < cols)[:, None, :]
            at, u, w = np.nonzero(hit)
            yield i[at, u], j[at, w], d2[at, u, w], batch, pa.array(part[at])


def _narrowed(cand: DataFrame, side: int, rows: int, cols: int) -> DataFrame:
    """Candidates of tiles with sides ``FAN * side`` handed to their children.

    The nearest candidate of every tile corner is found by a partial aggregate.
    A child drops a point that the nearest point of one of its four corners beats
    strictly at all four: the places where a point is at least as close as
    another form a half-plane, which meets a rectangle only if it holds a
    corner. So no winner or tie of any cell is dropped, and what stays is about
    what can win somewhere in the tile, however the points lie. Tasks compare a
    batch with all corners at once and pass on the closest rows only.
    """
    nr, nc = -(-rows // side), -(-cols // side)
    kind = {f.name: f.dataType.simpleString() for f in cand.schema.fields}
    cand = cand.select(*CAND)

    def closest(batches):
        for i, j, d2, b, take in _closest(batches, FAN + 1, side, FAN, nr + 1, nc + 1):
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(d2), *(b.column(k).take(take) for k in (2, 3, 4))],
                                             names=["i", "j", "d2", "pid", "x", "y"])

    # tables of corners and tiles: at most a 1/side**2 part of the grid's cells
    first = (cand.mapInArrow(closest, f"i long, j long, d2 double, pid {kind['pid']}, x {kind['x']}, y {kind['y']}")
             .groupBy("i", "j").agg(F.min(F.struct("d2", "pid", "x", "y")).alias("p")))
    touch = first.select("p", F.explode(F.array(*[F.struct((F.col("i") - u).alias("tr"), (F.col("j") - w).alias("tc"))
                                                  for u in (0, 1) for w in (0, 1)])).alias("t"))
    best = (touch.where((F.col("t.tr") >= 0) & (F.col("t.tr") < nr) & (F.col("t.tc") >= 0) & (F.col("t.tc") < nc))
            .groupBy((F.col("t.tr") * nc + F.col("t.tc")).alias("tile"))
            .agg(F.collect_list("p.x").alias("px"), F.collect_list("p.y").alias("py")).orderBy("tile").toArrow())
    # with fewer than four corners in the grid's tiles the last one repeats
    four = lambda c: np.array([(p + p[-1:] * 3)[:4] for p in best.column(c).to_pylist()], float).reshape(-1, 4)
    shared = cand.sparkSession.sparkContext.broadcast((best.column("tile").to_numpy(), four("px"), four("py")))

    def hand(batches):
        tiles, px, py = shared.value
        corners = [(u, w) for u in (0, 1) for w in (0, 1)]
        top, left = tiles // nc, tiles % nc
        reach = np.stack([_d2(px, py, ((top + u) * side)[:, None], ((left + w) * side)[:, None]) for u, w in corners], axis=2)
        for b in batches:
            tr, tc, x, y = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3, 4))
            for k in range(FAN * FAN):
                i, j = tr * FAN + k // FAN, tc * FAN + k % FAN
                at = np.minimum(np.searchsorted(tiles, i * nc + j), max(tiles.size - 1, 0))
                rest = np.flatnonzero((i < nr) & (j < nc) & (tiles[at] == i * nc + j)) if tiles.size else np.zeros(0, np.int64)
                if not rest.size:
                    continue
                q = np.stack([_d2(x[rest], y[rest], (i[rest] + u) * side, (j[rest] + w) * side) for u, w in corners], axis=1)
                rest = rest[(q[:, None, :] <= reach[at[rest]]).any(axis=2).all(axis=1)]
                if rest.size:
                    take = pa.array(rest)
                    yield pa.RecordBatch.from_arrays([pa.array(i[rest]), pa.array(j[rest]), *(b.column(c).take(take) for c in (2, 3, 4, 5))],
                                                     names=CAND)

    return cand.mapInArrow(hand, "tr long, tc long, " + ", ".join(f"{c} {kind[c]}" for c in CAND[2:]))


def nearest_points(points: DataFrame, rows: int, cols: int, tile: int = 8) -> DataFrame:
    """For every cell the nearest point (planar), exact: ``r, c, pid, v, d2``.

    Ties go to the smallest ``pid``. Tiles are narrowed down from one that holds
    the grid: at each level a tile hands its children only the points that can
    still win in them (``_narrowed``), so the candidate rows follow the cells and
    the points, clustered or not, and no point meets a tile it cannot win in. The
    cells of the leaf tiles (``tile`` cells square) are then compared with the
    leaf's candidates, batch by batch, and the minimum of ``(d2, pid)`` per cell is an
    aggregate of the closest rows. A leaf with many candidates deals them to
    several tasks.

    Points sharing a position keep the smallest ``pid`` (the only one that can
    win). Points without coordinates raise an error, like points further than one
    grid size outside the grid.
    """
    if tile < 1 or tile & (tile - 1):
        raise ValueError("tile must be a power of two")
    x, y = F.col("x"), F.col("y")
    inside = (x >= -rows) & (x <= 2 * rows) & (y >= -cols) & (y <= 2 * cols)
    guard = F.when(F.coalesce(inside, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.lit("nearest_points: point far outside the grid, or without coordinates")))
    pts = (points.where(guard)
           .groupBy("x", "y").agg(F.min(F.struct("pid", "v")).alias("p"))
           .select(F.lit(0).cast("long").alias("tr"), F.lit(0).cast("long").alias("tc"), F.col("p.pid").alias("pid"),
                   "x", "y", F.col("p.v").alias("v")))
    # Each level reads the one above it several times. It is written to the
    # shared checkpoint folder (spark.checkpoint.dir), so nothing upstream is
    # computed again, a lost executor costs nothing, and no memory is held.
    checkpoint_root(points.sparkSession)
    cand = pts.checkpoint(eager=True)
    tasks = work_partitions(cand.count(), TASK_POINTS)
    if tasks > cand.rdd.getNumPartitions():
        cand = cand.repartition(tasks).checkpoint(eager=True)
    side = tile
    while side < max(rows, cols):
        side *= FAN
    while side > tile:
        side //= FAN
        cand = _narrowed(cand, side, rows, cols).checkpoint(eager=True)

    nlc = -(-cols // tile)
    # one row per leaf, at most a 1/tile**2 part of the cells
    parts = cand.groupBy("tr", "tc").agg(F.ceil(F.count(F.lit(1)) / LEAF_POINTS).cast("int").alias("parts"))
    nparts = max(work_partitions(rows * cols, 25_000), work_partitions(cand.count(), LEAF_POINTS))
    dealt = (cand.join(F.broadcast(parts), ["tr", "tc"])
             .withColumn("part", F.pmod(F.xxhash64("x", "y"), F.col("parts")).cast("int"))
             .withColumn("leaf", F.col("tr") * nlc + F.col("tc"))
             .repartition(nparts, "leaf", "part").select(*CAND))
    kind = {f.name: f.dataType.simpleString() for f in cand.schema.fields}

    def closest(batches):
        for r, c, d2, b, take in _closest(batches, tile, 1, tile, rows, cols):
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(d2),
                                              b.column(2).take(take), b.column(5).take(take)], names=["r", "c", "d2", "pid", "v"])

    best = (dealt.mapInArrow(closest, f"r int, c int, d2 double, pid {kind['pid']}, v {kind['v']}")
            .groupBy("r", "c").agg(F.min(F.struct("d2", "pid", "v")).alias("b")))
    return best.select("r", "c", F.col("b.pid").alias("pid"), F.col("b.v").alias("v"), F.col("b.d2").alias("d2"))


# ------------------------------------------------------------------- blur

def gaussian_weights(sigma: float, truncate: float = 4.0) -> np.ndarray:
    """Normalised 1-D Gaussian taps, radius ``int(truncate*sigma + 0.5)``."""
    radius = int(truncate * float(sigma) + 0.5)
    k = np.arange(-radius, radius + 1, dtype=np.float64)
    w = np.exp(-0.5 / (float(sigma) ** 2) * k * k)
    return w / w.sum()


def _mirror(idx: np.ndarray, n: int) -> np.ndarray:
    m = np.mod(idx, 2 * n)
    return np.where(m >= n, 2 * n - 1 - m, m)


def _line_pass(df: DataFrame, line: str, pos: str, n: int, w: np.ndarray, n_lines: int) -> DataFrame:
    radius = (len(w) - 1) // 2
    src = _mirror(np.arange(-radius, n + radius), n)

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        if len(pdf) != n or pdf[pos].iloc[0] != 0 or pdf[pos].iloc[-1] != n - 1:
            raise ValueError(f"blur: line {pdf[line].iloc[0]} has {len(pdf)} of {n} cells")
        vals = pdf["v"].to_numpy(dtype=np.float64)
        out = np.convolve(vals[src], w[::-1], mode="valid")
        return pd.DataFrame({line: pdf[line].to_numpy(), pos: pdf[pos].to_numpy(), "v": out})

    schema = T.StructType([T.StructField(line, T.IntegerType()), T.StructField(pos, T.IntegerType()),
                           T.StructField("v", T.DoubleType())])
    # one line is n cells of compute; spread lines by count, not by bytes
    nparts = work_partitions(n_lines * n, 50_000)
    return (df.select(line, pos, "v").repartition(nparts, line)
            .groupBy(line).applyInPandas(smooth, schema))


def gaussian_blur(grid: DataFrame, rows: int, cols: int, sigma: float, truncate: float = 4.0) -> DataFrame:
    """2-D Gaussian filter, same sigma on both axes, edges mirrored.

    Separable: one pass down the columns (axis 0), one along the rows (axis 1).
    Each pass groups the grid by line (bounded by the grid side, not by the
    data) and convolves one line per call with numpy on Arrow batches. A NaN /
    null spreads over its neighbourhood as it would in the reference.
    """
    w = gaussian_weights(sigma, truncate)
    g = grid.select(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"),
                    F.col("v").cast("double").alias("v"))
    down = _line_pass(g, "c", "r", rows, w, cols)
    return _line_pass(down, "r", "c", cols, w, rows).select("r", "c", "v")


# -------------------------------------------------------------- mask, diff

def apply_land_mask(df: DataFrame, mask: DataFrame, value: str = "v") -> DataFrame:
    """Non-land cells (or cells missing from the mask) become null."""
    m = mask.select("r", "c", "land")
    return (df.join(m, ["r", "c"], "left")
            .withColumn(value, F.when(F.col("land"), F.col(value)))
            .drop("land"))


def grid_difference(cur: DataFrame, ref: DataFrame, value: str = "v") -> DataFrame:
    """Cell-wise ``cur - ref``; null where either side is null or missing."""
    a = cur.select("r", "c", F.col(value).alias("cur"))
    b = ref.select("r", "c", F.col(value).alias("ref"))
    return (a.join(b, ["r", "c"], "left")
            .withColumn("diff", F.col("cur") - F.col("ref")))
