"""Composed jobs: current model (X1), reference model (X2), anomaly map (X3),
the empty-input branch (X4) and materialised reference days (X5)."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.functions.columns import heat_clip, heat_level
from thermogrid.operators import climatology as cl
from thermogrid.operators import grid as gr
from thermogrid.operators import readings as rd


def station_points(means: DataFrame, scale: float) -> DataFrame:
    """P8 + P9: per-station means to grid points ``pid, x, y, v``."""
    return gr.to_points(rd.unpack_city(means), scale)


def smoothed_model(means: DataFrame, scale: float, sigma: float, tile: int = 8) -> DataFrame:
    """Nearest-neighbour field of the station means, blurred (no mask yet)."""
    rows, cols = gr.grid_shape(scale)
    near = gr.nearest_points(station_points(means, scale), rows, cols, tile)
    return gr.gaussian_blur(near.select("r", "c", "v"), rows, cols, sigma)


def _masked(mask: DataFrame, smooth: DataFrame) -> DataFrame:
    # mask LEFT JOIN model: one join serves the land mask (J3) and the empty
    # branch (X4): when there is no point at all the model has no rows, and the
    # reference then returns zeros everywhere, unmasked.
    m = smooth.select("r", "c", F.col("v").alias("_m"), F.lit(True).alias("_has"))
    j = mask.select("r", "c", "land").join(m, ["r", "c"], "left")
    v = F.when(F.col("_has").isNull(), F.lit(0.0)).when(F.col("land"), F.col("_m"))
    return j.withColumn("cur", v).drop("_m", "_has")


def current_model(means: DataFrame, mask: DataFrame, scale: float, sigma: float = 20.0,
                  tile: int = 8) -> DataFrame:
    """Station means -> points -> nearest -> blur -> land mask: ``r, c, v``."""
    out = _masked(mask, smoothed_model(means, scale, sigma, tile))
    return out.select("r", "c", F.col("cur").alias("v"))


def reference_model(clim: DataFrame, mask: DataFrame, day: int, scale: float, ref_row_shift: int = 1,
                    check: bool = True) -> DataFrame:
    """Day check, day filter, lattice upsampling, flip (folded into the row
    formula), land mask: ``r, c, v, taps`` for every cell (null off land)."""
    if check:
        cl.require_day(clim, day)
    day_df = cl.climatology_for_day(clim, day)
    out = cl.add_reference(mask.select("r", "c", "land"), day_df, scale, ref_row_shift, out="v")
    return out.select("r", "c", "v", "taps")


def anomaly_map(means: DataFrame, clim: DataFrame, mask: DataFrame, day: int, scale: float,
                sigma: float = 20.0, tile: int = 8, ref_row_shift: int = 1, check: bool = True,
                lo: float = -10.0, hi: float = 10.0) -> DataFrame:
    """X3 (+P14): ``r, c, cur, ref, diff, clipped, level`` for every cell.

    One shuffle join (mask with the smoothed model) carries both models: the
    reference is added to the same rows through a broadcast of the lattice
    neighbourhoods, so the two grids are never joined to each other.
    """
    if check:
        cl.require_day(clim, day)
    return difference_map(smoothed_model(means, scale, sigma, tile), clim, mask, day, scale, ref_row_shift, lo, hi)


def difference_map(smooth: DataFrame, clim: DataFrame, mask: DataFrame, day: int, scale: float, ref_row_shift: int = 1,
                   lo: float = -10.0, hi: float = 10.0) -> DataFrame:
    """The map of :func:`anomaly_map` from a blurred field ``r, c, v`` that is already there."""
    cur = _masked(mask, smooth)
    both = cl.add_reference(cur, cl.climatology_for_day(clim, day), scale, ref_row_shift, out="ref")
    diff = F.col("cur") - F.col("ref")
    return both.select("r", "c", "cur", "ref", diff.alias("diff"), heat_clip(diff, lo, hi).alias("clipped"),
                       heat_level(diff, lo, hi).alias("level"))


def anomaly_map_at(means: DataFrame, clim: DataFrame, mask: DataFrame, ts, scale: float, leap: str = "error",
                   **options) -> DataFrame:
    """X3 by time: the day index (P10) of ``ts`` (a datetime, UTC) picks the climatology."""
    return anomaly_map(means, clim, mask, day_of(ts, leap), scale, **options)


def day_of(ts: datetime.datetime, leap: str = "error") -> int:
    """P10 on the driver: day of year minus one, 0..364."""
    day = ts.timetuple().tm_yday - 1
    if day > 364 and leap == "clamp":
        return 364
    if day > 364 or leap not in ("error", "clamp"):
        raise ValueError(f"day index out of range 0..364: {day} (leap={leap!r})")
    return day


def reference_models(clim: DataFrame, mask: DataFrame, days=None, scale: float = 1.0, ref_row_shift: int = 1) -> DataFrame:
    """Reference grids of several days (all days of ``clim`` by default),
    ``day_number, r, c, v, taps``.

    One pass: the land cells of each day meet that day's lattice neighbourhoods
    in one join on (day, lattice cell); other cells get null. Meant to be written
    once with ``write_reference_models`` and read back by day.
    """
    if days is None:
        days = [r.day_number for r in cl.distinct_days(clim).collect()]  # at most 366
    days = sorted({int(d) for d in days})
    if not days:
        raise ValueError("reference_models needs at least one day")
    day = F.explode(F.array(*[F.lit(d) for d in days])).alias("day_number")
    around = cl.neighbourhoods(clim.where(F.col("day_number").isin(days)), by=["day_number"])
    land = cl.cell_lattice_coords(mask.where("land").select("r", "c"), scale, ref_row_shift)
    found = cl.interpolate(land.select("*", day).join(around, ["day_number", "i0", "j0"], "left"), "v")
    sea = mask.where(~F.coalesce(F.col("land"), F.lit(False))).select(
        "r", "c", day, F.lit(None).cast("double").alias("v"), F.lit(0).alias("taps"))
    columns = ["day_number", "r", "c", "v", "taps"]
    return found.select(*columns).unionByName(sea.select(*columns))


def write_reference_models(models: DataFrame, path: str) -> None:
    """One folder per day; a day is one grid, so it is one task's output."""
    models.repartition("day_number").write.mode("overwrite").partitionBy("day_number").parquet(path)


def read_reference_model(spark, path: str, day: int) -> DataFrame:
    """X2 from the stored grids of X5: ``r, c, v, taps``; only the day's folder is read."""
    t = spark.read.schema("r int, c int, v double, taps int, day_number int").parquet(path)
    return t.where(F.col("day_number") == int(day)).drop("day_number")
