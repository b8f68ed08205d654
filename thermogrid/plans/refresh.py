"""The refresh job: current store + climatology + land mask + time -> anomaly
map -> cell table, as one call (the reference runs it in a 10 s loop)."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from thermogrid.operators import readings as rd
from thermogrid.operators.grid import grid_shape
from thermogrid.plans.anomaly import anomaly_map_at, day_of, difference_map, station_points
from thermogrid.plans.incremental import Refresh, read_map_state, refresh_state
from thermogrid.sources.current_store import read_current
from thermogrid.sources.files import write_heatmap_cells


def map_from_store(spark: SparkSession, store: str, clim: DataFrame, mask: DataFrame, ts: datetime.datetime,
                   scale: float, **options) -> DataFrame:
    """The anomaly map of the store's latest readings against the day of ``ts``.
    A store without a batch gives the empty-input map (X4)."""
    try:
        current = read_current(spark, store)
    except FileNotFoundError:
        current = spark.createDataFrame([], "city_and_loc string, time int, temperature float")
    return anomaly_map_at(rd.mean_by_city(rd.city_temperature(current)), clim, mask, ts, scale, **options)


def refresh_map(spark: SparkSession, store: str, clim: DataFrame, mask: DataFrame, out: str,
                ts: datetime.datetime | None = None, scale: float = 5.0, **options) -> None:
    """Build the map for ``ts`` (now, UTC, by default) and replace the cell table at ``out``."""
    ts = ts or datetime.datetime.now(datetime.timezone.utc)
    write_heatmap_cells(map_from_store(spark, store, clim, mask, ts, scale, **options), out)


def refresh_from_store(spark: SparkSession, store: str, state: str, scale: float = 5.0, sigma: float = 20.0,
                       **options) -> Refresh | None:
    """Bring the map state at ``state`` to the store's latest readings, at the cost of what changed."""
    rows, cols = grid_shape(scale)
    means = rd.mean_by_city(rd.city_temperature(read_current(spark, store)))
    return refresh_state(station_points(means, scale), state, rows, cols, sigma, **options)


def map_from_state(spark: SparkSession, state: str, clim: DataFrame, mask: DataFrame, ts: datetime.datetime,
                   scale: float = 5.0, leap: str = "error", **options) -> DataFrame:
    """The anomaly map of the kept state against the day of ``ts``: no nearest-point search and no blur."""
    smooth = read_map_state(spark, state).select("r", "c", "s").withColumnRenamed("s", "v")
    return difference_map(smooth, clim, mask, day_of(ts, leap), scale, **options)
