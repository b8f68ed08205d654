"""J7 while the stream runs: every reading against the climatology of its own day and cell.

A stream-static join: the reference grids of all days (``plans.anomaly.write_reference_models``) lie
in one folder per day; a reading's day comes from its own timestamp, so readings on both sides of
midnight meet their own day's grid, also when they arrive in one micro-batch or late. The static
side is read again for each micro-batch, so a day that is added to it is found by the next one. The
join keeps no state, and a restarted query repeats nothing (file sink with a checkpoint).

Readings that do not parse are left out (the ingest quarantines them). A cell without a reference
value (sea, or a day that is not stored) gives a null anomaly. Latitude -90 and longitude 180 belong to the
last row and column. Day 366 of a leap year meets the last stored day (``leap`` = clamp) or fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from thermogrid.functions.columns import day_index
from thermogrid.operators.grid import grid_shape
from thermogrid.operators.readings import decode_reading, unpack_city
from thermogrid.session import scratch_path
from thermogrid.streaming.ingest import _finish, _message_files, _trigger

COLUMNS = ("city_and_loc string, time int, timestamp timestamp, offset long, day_number int, r int, c int, "
           "temperature float, ref double, anomaly double")


def reading_anomaly(messages: DataFrame, references: DataFrame, scale: float, leap: str = "clamp") -> DataFrame:
    """Each good reading of ``messages`` (stream or batch) with ``ref`` and ``anomaly`` from ``references``
    (``day_number, r, c, v``)."""
    s = float(scale)
    rows, cols = grid_shape(scale)
    ts = F.col("timestamp").cast("timestamp")
    at = unpack_city(decode_reading(messages)).select(
        "city_and_loc", "time", ts.alias("timestamp"), F.col("offset").cast("long").alias("offset"),
        day_index(ts, leap).cast("int").alias("day_number"),
        F.least(F.lit(rows - 1), F.floor(F.lit(s) * (F.lit(90.0) - F.col("lat")))).cast("int").alias("r"),
        F.least(F.lit(cols - 1), F.floor(F.lit(s) * (F.col("lon") + F.lit(180.0)))).cast("int").alias("c"), "temperature")
    ref = references.select("day_number", "r", "c", F.col("v").alias("ref"))
    return (at.join(ref, ["day_number", "r", "c"], "left")
            .withColumn("anomaly", F.col("temperature").cast("double") - F.col("ref"))
            .select(*[c.split()[0] for c in COLUMNS.split(", ")]))


def start_reading_anomaly(messages: DataFrame, references: DataFrame, path: str, scale: float, checkpoint: str | None = None,
                          trigger: str | None = "1 second", available_now: bool = False, leap: str = "clamp") -> StreamingQuery:
    """Append the anomalies of the stream to the Parquet table at ``path``; by default the checkpoint lies in it."""
    path = path.rstrip("/")
    w = (reading_anomaly(messages, references, scale, leap).writeStream.outputMode("append").format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint or f"{path}/_checkpoint"))
    return _trigger(w, trigger, available_now).start()


def run_reading_anomaly_once(spark: SparkSession, messages: DataFrame, references: DataFrame, scale: float,
                             records_per_file: int | None = None) -> DataFrame:
    """Drive the stream end to end over ``messages`` and return its table."""
    base = scratch_path(spark, "stream-anomaly")
    _finish(start_reading_anomaly(_message_files(spark, messages, f"{base}/in", records_per_file), references, f"{base}/out",
                                  scale, available_now=True))
    return spark.read.schema(COLUMNS).parquet(f"{base}/out")
