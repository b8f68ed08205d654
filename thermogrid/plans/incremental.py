"""The refresh as delta maintenance (T5): a changed station costs its surroundings, not the map.

The state is the unblurred and the blurred field in blocks of ``BLOCK`` x ``BLOCK`` cells:

    <path>/points/gen=N          the points that generation N was made of
    <path>/cells/gen=N/block=B   r, c, pid, v, d2, s   (s = blurred value)
    <path>/manifest/gen=N        block, gen, far (largest d2), wx, wy (one winner): a row per block

A generation writes only the blocks it changed; its manifest, written last, says for
each block which generation holds it. A generation without a complete manifest does not exist, so
a refresh that dies leaves the last one as it was, and the next one overwrites its files.

An update compares the points by position. A point that came, went or changed can only
matter in blocks it lies no further from than the block's largest distance to a nearest
point (the block's ``far``). Those blocks look for their nearest points again, among
the points within reach of a surviving winner; everything else keeps its rows. The
blur is linear, so the blurred difference of the changed cells is added to the old blurred field
within the blur's radius. All lists of blocks are bounded by the grid.

Rounding errors of the additions grow by about 1e-15 per update; ``rebuild_every`` starts
over from a full build after so many generations.

Edge cases: points without coordinates or value must be kept out before (the
quarantine does). Of points at one position the one with the smallest ``pid`` counts. Without
points there is no state, and the map is that of an empty input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermogrid.operators import grid as gr
from thermogrid.session import checkpoint_root, delete_path, list_names, path_exists, work_partitions

BLOCK = 64
PART = 4096        # candidate points of a block that one group compares with its cells
REBUILD = 1000     # updates between full builds
CELLS = "r int, c int, pid string, v double, d2 double, s double, block int"


@dataclass
class Refresh:
    """What a refresh did: its generation, whether it was a full build, the blocks searched again and
    those written, and the cells whose nearest point or blurred value changed."""

    gen: int
    full: bool
    searched: list[int]
    written: list[int]
    cells_nearest: int
    cells_blurred: int


def _block(rows: int, cols: int):
    across = -(-cols // BLOCK)
    return (F.floor(F.col("r") / BLOCK) * across + F.floor(F.col("c") / BLOCK)).cast("int")


def _corners(rows: int, cols: int, blocks: np.ndarray) -> np.ndarray:
    """First and last row and column of each block."""
    across = -(-cols // BLOCK)
    r0, c0 = blocks // across * BLOCK, blocks % across * BLOCK
    return np.stack([r0, np.minimum(r0 + BLOCK, rows) - 1, c0, np.minimum(c0 + BLOCK, cols) - 1], axis=1).astype(float)


def _least_d2(box: np.ndarray, x, y):
    dx = np.maximum(np.maximum(box[..., 0] - x, x - box[..., 1]), 0)
    dy = np.maximum(np.maximum(box[..., 2] - y, y - box[..., 3]), 0)
    return dx * dx + dy * dy


def _most_d2(box: np.ndarray, x, y):
    dx = np.maximum(np.abs(box[..., 0] - x), np.abs(box[..., 1] - x))
    dy = np.maximum(np.abs(box[..., 2] - y), np.abs(box[..., 3] - y))
    return dx * dx + dy * dy


# ------------------------------------------------------------------ stored state

def generations(spark: SparkSession, path: str) -> list[int]:
    """Complete generations, oldest first."""
    base = f"{path.rstrip('/')}/manifest"
    names = [n for n in list_names(spark, base) if n.startswith("gen=")]
    return sorted(int(n[4:]) for n in names if path_exists(spark, f"{base}/{n}/_SUCCESS"))


def _manifest(spark: SparkSession, path: str, gen: int) -> dict[str, np.ndarray]:
    t = spark.read.schema("block int, gen int, far double, wx double, wy double").parquet(f"{path}/manifest/gen={gen}").toArrow()
    return {n: t.column(n).to_numpy() for n in t.column_names}


def _stored(spark: SparkSession, path: str, held: dict[str, np.ndarray], blocks=None) -> DataFrame:
    some = [(int(b), int(g)) for b, g in zip(held["block"], held["gen"]) if blocks is None or int(b) in blocks]
    if not some:
        return spark.createDataFrame([], CELLS)
    files = [f"{path}/cells/gen={g}/block={b}" for b, g in some]
    return spark.read.schema(CELLS).option("basePath", f"{path}/cells").parquet(*files).drop("gen")


def read_map_state(spark: SparkSession, path: str) -> DataFrame:
    """``r, c, pid, v, d2, s`` of the newest generation; fails when there is none."""
    path = path.rstrip("/")
    gens = generations(spark, path)
    if not gens:
        raise FileNotFoundError(f"no map state at {path}")
    return _stored(spark, path, _manifest(spark, path, gens[-1])).drop("block")


def _write(cells: DataFrame, path: str, gen: int, kept: dict[str, np.ndarray] | None, points: DataFrame) -> list[int]:
    """Write the blocks of ``cells`` as generation ``gen``, the others stay where ``kept`` has them."""
    spark = cells.sparkSession
    out = f"{path}/cells/gen={gen}"
    cells.repartition("block").write.mode("overwrite").partitionBy("block").parquet(out)
    new = spark.read.schema(CELLS).parquet(out)
    # one of the winners of each block, with its place, and the largest distance: a row per block
    rows = (new.groupBy("block").agg(F.max("d2").alias("far"), F.min("pid").alias("pid"))
            .join(points.select("pid", F.col("x").alias("wx"), F.col("y").alias("wy")), "pid")
            .select("block", F.lit(gen).alias("gen"), "far", "wx", "wy"))
    names = new.select("block").distinct().toArrow().column("block").to_pylist()
    points.write.mode("overwrite").parquet(f"{path}/points/gen={gen}")
    if kept is not None:
        stay = ~np.isin(kept["block"], names)
        old = pa.table({n: pa.array(kept[n][stay]) for n in ("block", "gen", "far", "wx", "wy")})
        if old.num_rows:
            rows = rows.unionByName(spark.createDataFrame(old.to_pandas(), "block int, gen int, far double, wx double, wy double"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/gen={gen}")
    return sorted(names)


def _clean(spark: SparkSession, path: str) -> None:
    """Delete what neither of the last two generations uses."""
    gens = generations(spark, path)
    if len(gens) < 3:
        return
    used = {(int(b), int(g)) for n in gens[-2:] for m in [_manifest(spark, path, n)] for b, g in zip(m["block"], m["gen"])}
    for name in list_names(spark, f"{path}/cells"):
        if not name.startswith("gen=") or int(name[4:]) >= gens[-2]:
            continue
        left = [b for b in list_names(spark, f"{path}/cells/{name}") if b.startswith("block=")]
        gone = [b for b in left if (int(b[6:]), int(name[4:])) not in used]
        if len(gone) == len(left):
            delete_path(spark, f"{path}/cells/{name}")
        else:
            for b in gone:
                delete_path(spark, f"{path}/cells/{name}/{b}")
    for n in gens[:-2]:
        delete_path(spark, f"{path}/manifest/gen={n}")
        delete_path(spark, f"{path}/points/gen={n}")


# ------------------------------------------------------------------ refresh

def _by_position(points: DataFrame) -> DataFrame:
    return (points.groupBy("x", "y").agg(F.min(F.struct("pid", "v")).alias("p"))
            .select(F.col("p.pid").alias("pid"), "x", "y", F.col("p.v").alias("v")))


def _build(points: DataFrame, path: str, rows: int, cols: int, sigma: float, gen: int) -> Refresh:
    near = gr.nearest_points(points, rows, cols).checkpoint(eager=True)
    blurred = gr.gaussian_blur(near, rows, cols, sigma).withColumnRenamed("v", "s")
    written = _write(near.join(blurred, ["r", "c"]).withColumn("block", _block(rows, cols)), path, gen, None, points)
    return Refresh(gen, True, written, written, rows * cols, rows * cols)


def _search(points: DataFrame, rows: int, cols: int, blocks: np.ndarray, reach: np.ndarray) -> DataFrame:
    """``r, c, pid, v, d2`` for all cells of ``blocks``, from the points whose squared distance
    to the block is at most ``reach``."""
    boxes = _corners(rows, cols, blocks)
    shared = points.sparkSession.sparkContext.broadcast((blocks, boxes, reach))  # bounded by the grid

    def near(batches):
        blocks, boxes, reach = shared.value
        for b in batches:
            x, y = b.column(1).to_numpy(), b.column(2).to_numpy()
            for k in range(blocks.size):
                at = np.flatnonzero(_least_d2(boxes[k], x, y) <= reach[k])
                if at.size:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(at.size, blocks[k], np.int32)), *[c.take(pa.array(at)) for c in b.columns]],
                                                     names=["block", "pid", "x", "y", "v"])

    cand = points.select("pid", "x", "y", "v").mapInArrow(near, "block int, pid string, x double, y double, v double")
    cand = cand.checkpoint(eager=True)
    sizes = cand.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    cand = cand.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("x", "y"), F.col("parts")).cast("int"))

    def best(key, table):
        r0, r1, c0, c1 = _corners(rows, cols, np.array([key[0].as_py()]))[0].astype(int)
        pid = table.column("pid").to_pylist()
        order = sorted(range(len(pid)), key=lambda i: pid[i].encode())  # of equal distances the first
        x, y, v = (table.column(c).to_numpy()[order] for c in ("x", "y", "v"))
        names = pa.array([pid[i] for i in order], pa.string())
        r, c = (a.ravel() for a in np.meshgrid(np.arange(r0, r1 + 1), np.arange(c0, c1 + 1), indexing="ij"))
        at, d2 = np.empty(r.size, np.int64), np.empty(r.size)
        step = max(1, (1 << 20) // x.size)
        for i in range(0, r.size, step):
            s = slice(i, i + step)
            d = (r[s, None] - x) ** 2 + (c[s, None] - y) ** 2
            at[s] = d.argmin(axis=1)
            d2[s] = d[np.arange(d.shape[0]), at[s]]
        return pa.table({"r": pa.array(r.astype(np.int32)), "c": pa.array(c.astype(np.int32)), "pid": names.take(pa.array(at)),
                         "v": pa.array(v[at]), "d2": pa.array(d2)})

    rows_of = cand.groupBy("block", "part").applyInArrow(best, "r int, c int, pid string, v double, d2 double")
    return (rows_of.groupBy("r", "c").agg(F.min(F.struct("d2", "pid", "v")).alias("b"))
            .select("r", "c", "b.pid", "b.v", "b.d2"))


def _line_delta(rows: DataFrame, line: str, pos: str, n: int, w: np.ndarray) -> DataFrame:
    """One pass of the blur over a sparse field: only lines with an entry, and of those only the places
    within the radius of one."""
    radius = (len(w) - 1) // 2
    src = gr._mirror(np.arange(-radius, n + radius), n)

    def smooth(key, table):
        dense, some = np.zeros(n), np.zeros(n, bool)
        at = table.column(pos).to_numpy()
        dense[at], some[at] = table.column("v").to_numpy(), True
        near = np.cumsum(np.concatenate([[0], some[src]]))
        reach = np.flatnonzero(near[2 * radius + 1:] > near[:n])
        out = np.convolve(dense[src], w[::-1], mode="valid")[reach]
        return pa.table({line: pa.array(np.full(reach.size, key[0].as_py(), np.int32)), pos: pa.array(reach.astype(np.int32)), "v": pa.array(out)})

    parts = work_partitions(n * n, 200_000)
    return (rows.select(line, pos, "v").repartition(parts, line).groupBy(line)
            .applyInArrow(smooth, f"{line} int, {pos} int, v double"))


def refresh_state(points: DataFrame, path: str, rows: int, cols: int, sigma: float = 20.0,
                  rebuild_every: int = REBUILD) -> Refresh | None:
    """Bring the state at ``path`` to ``points`` (``pid, x, y, v`` in grid units): a full build the first time,
    later the difference to the last generation. Returns what was done, None without points."""
    spark, path = points.sparkSession, path.rstrip("/")
    checkpoint_root(spark)
    now = _by_position(points).checkpoint(eager=True)
    gens = generations(spark, path)
    gen = gens[-1] + 1 if gens else 0
    if now.isEmpty():
        return None
    if not gens or gen % rebuild_every == 0:
        done = _build(now, path, rows, cols, sigma, gen)
        _clean(spark, path)
        return done
    held = _manifest(spark, path, gens[-1])
    before = spark.read.schema(now.schema).parquet(f"{path}/points/gen={gens[-1]}")
    old, new = before.selectExpr("x", "y", "pid as p0", "v as v0"), now.selectExpr("x", "y", "pid as p1", "v as v1")
    changed = (old.join(new, ["x", "y"], "full").where(~(F.col("p0").eqNullSafe(F.col("p1")) & F.col("v0").eqNullSafe(F.col("v1"))))
               .select("x", "y", F.col("p1").isNull().alias("gone")).checkpoint(eager=True))
    order = np.argsort(held["block"])
    blocks, far = held["block"][order], held["far"][order]
    boxes = _corners(rows, cols, blocks)
    shared = spark.sparkContext.broadcast((blocks, far, boxes))

    def reached(batches):
        blocks, far, boxes = shared.value
        hit = np.zeros(blocks.size, bool)
        for b in batches:
            x, y = b.column(0).to_numpy(), b.column(1).to_numpy()
            for k in np.flatnonzero(~hit):
                hit[k] = (_least_d2(boxes[k], x, y) <= far[k]).any()
        yield pa.RecordBatch.from_arrays([pa.array(blocks[hit].astype(np.int32))], names=["block"])

    search = np.sort(changed.select("x", "y").mapInArrow(reached, "block int").distinct().toArrow().column("block").to_numpy())
    if not search.size:
        written = _write(spark.createDataFrame([], CELLS), path, gen, held, now)
        _clean(spark, path)
        return Refresh(gen, False, [], written, 0, 0)
    # every block has a point within the reach of a winner that is still there
    winners = spark.createDataFrame([(float(a), float(b)) for a, b in {(x, y) for x, y in zip(held["wx"], held["wy"])}], "x double, y double")
    left = winners.join(changed.where("gone"), ["x", "y"], "left_anti").toArrow()
    if not left.num_rows:
        done = _build(now, path, rows, cols, sigma, gen)
        _clean(spark, path)
        return done
    wx, wy = left.column("x").to_numpy(), left.column("y").to_numpy()
    reach = np.array([_most_d2(box, wx, wy).min() for box in _corners(rows, cols, search)])
    near = _search(now, rows, cols, search, reach)
    was = _stored(spark, path, held, set(search.tolist()))
    diff = (near.join(was.select("r", "c", F.col("pid").alias("p0"), F.col("v").alias("v0")), ["r", "c"])
            .where(~(F.col("pid").eqNullSafe(F.col("p0")) & F.col("v").eqNullSafe(F.col("v0"))))
            .select("r", "c", "pid", "v", "d2", (F.col("v") - F.col("v0")).alias("dv")).checkpoint(eager=True))
    w = gr.gaussian_weights(sigma)
    steps = diff.where("dv <> 0").select("r", "c", F.col("dv").alias("v"))
    blurred = _line_delta(_line_delta(steps, "c", "r", rows, w), "r", "c", cols, w).withColumnRenamed("v", "ds").checkpoint(eager=True)
    touched = set(diff.select("r", "c").union(blurred.select("r", "c")).select(_block(rows, cols).alias("b")).distinct().toArrow().column("b").to_pylist())
    counts = (diff.count(), blurred.count())
    cells = (_stored(spark, path, held, touched)
             .join(diff.select("r", "c", F.col("pid").alias("p1"), F.col("v").alias("v1"), F.col("d2").alias("e1")), ["r", "c"], "left")
             .join(blurred, ["r", "c"], "left")
             .select("r", "c", F.coalesce("p1", "pid").alias("pid"), F.coalesce("v1", "v").alias("v"), F.coalesce("e1", "d2").alias("d2"),
                     (F.col("s") + F.coalesce("ds", F.lit(0.0))).alias("s"), "block"))
    written = _write(cells, path, gen, held, now)
    _clean(spark, path)
    return Refresh(gen, False, search.tolist(), written, *counts)
