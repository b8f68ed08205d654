"""Readings: encode, parse, decode, quarantine, latest per key, mean per station.

P1-P8, A1, A2, A5 of the blueprint. All of it is narrow projection work except
``latest_by_key`` and ``mean_by_city``, which are hash aggregates with a
map-side partial step, so a hot station never lands whole in one task before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermogrid.functions.columns import as_text, encode_key, hour_of_day

# The parts of the weather service response that are used.
WEATHER_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("main", T.StructType([T.StructField("temp", T.DoubleType())])),
    T.StructField("coord", T.StructType([T.StructField("lon", T.DoubleType()),
                                         T.StructField("lat", T.DoubleType())])),
    T.StructField("dt", T.LongType()),
])

def encode_reading(df: DataFrame, name="name", lon="lon", lat="lat", hour="hour", temp="temp",
                   as_bytes: bool = True) -> DataFrame:
    """A reading to a message key ``name:lon:lat:hour`` and value ``temp``.

    Bytes (UTF-8) by default, as a Kafka producer sends them; text with
    ``as_bytes=False``. Other columns are kept.
    """
    key = encode_key(name, lon, lat, hour)
    value = F.col(temp).cast("string")
    if as_bytes:
        key, value = F.encode(key, "UTF-8"), F.encode(value, "UTF-8")
    return df.withColumn("key", key).withColumn("value", value)


def parse_weather(df: DataFrame, body: str = "body") -> DataFrame:
    """P2+P3: fields of a weather response (JSON text) plus the hour of ``dt``."""
    j = F.from_json(F.col(body), WEATHER_SCHEMA)
    return (df.withColumn("_w", j)
            .withColumn("name", F.col("_w.name"))
            .withColumn("lon", F.col("_w.coord.lon"))
            .withColumn("lat", F.col("_w.coord.lat"))
            .withColumn("temp", F.col("_w.main.temp"))
            .withColumn("dt", F.col("_w.dt"))
            .withColumn("hour", hour_of_day("dt"))
            .drop("_w", body))


def _parsed(df: DataFrame, key: str, value: str) -> DataFrame:
    # One split per key; the last three fields are hour, lat and lon, and the
    # station key is everything before the last ':' (so names may hold ':').
    # Same rule as the anchored pattern KEY_PATTERN, without regex matching.
    x = df.withColumn("_k", as_text(key)).withColumn("_v", as_text(value))
    x = x.withColumn("_p", F.split(F.col("_k"), ":", -1))
    n = F.size("_p")
    hour_s = F.element_at("_p", -1)
    lat_s = F.element_at("_p", -2)
    lon_s = F.element_at("_p", -3)
    lon, lat = lon_s.try_cast("double"), lat_s.try_cast("double")
    sure = lambda c: F.coalesce(c, F.lit(False))
    key_ok = sure((n >= 4) & lon.isNotNull() & lat.isNotNull())
    # NaN ranks above every number, so it fails both bounds like an infinity
    coord_ok = sure(lon.between(-180, 180) & lat.between(-90, 90))
    time = F.when(n >= 4, hour_s).try_cast("int")
    temp = F.col("_v").try_cast("double")
    stored = temp.cast("float")  # as stored: a double beyond the float range is infinite
    value_ok = sure(~F.isnan(stored) & (F.abs(stored) < F.lit(float("inf"))))
    reason = (F.when(~key_ok, F.lit("key"))
              .when(~coord_ok, F.lit("coord"))
              .when(~sure(time.between(0, 23)), F.lit("hour"))
              .when(~value_ok, F.lit("value")))
    city = F.expr("substring(_k, 1, length(_k) - length(element_at(_p, -1)) - 1)")
    return (x.withColumn("city_and_loc", F.when(n >= 4, city))
            .withColumn("time", time)
            .withColumn("temperature", stored)
            .withColumn("reason", reason)
            .drop("_p"))


def decode_reading(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """P4+P5: message to ``city_and_loc, time, temperature`` (float, as stored).

    Only rows that parse are returned; see ``quarantine_bad`` for the rest. Any
    other column (timestamp, partition, offset, ...) is carried along.
    """
    return quarantine_bad(df, key, value)[0]


def quarantine_bad(df: DataFrame, key: str = "key", value: str = "value"):
    """Split messages into (good, bad).

    A key must end in ``:<lon>:<lat>:<hour>`` with numeric lon/lat inside
    [-180, 180] x [-90, 90] and an hour 0..23, and the value must be a finite
    number. Bad rows keep the raw key and value as text and a ``reason``: 'key'
    (does not parse, or null), 'coord', 'hour' or 'value'.
    """
    p = _parsed(df, key, value)
    good = (p.where(F.col("reason").isNull())
            .drop("reason", "_k", "_v", key, value))
    bad = (p.where(F.col("reason").isNotNull())
           .drop(key, value, "city_and_loc", "time", "temperature")
           .withColumnRenamed("_k", key).withColumnRenamed("_v", value))
    return good, bad


def city_temperature(current: DataFrame) -> DataFrame:
    """Keep ``city_and_loc`` and ``temperature`` (lets Parquet prune ``time``)."""
    return current.select("city_and_loc", "temperature")


def unpack_city(df: DataFrame, key: str = "city_and_loc") -> DataFrame:
    """``name:lon:lat`` to name and double lon/lat; names with ':' survive.

    The same last-fields rule as the pattern CITY_PATTERN, done with one split.
    """
    p = F.split(F.col(key), ":", -1)
    ok = F.size(p) >= 3
    lon_s = F.element_at(p, -2)
    lat_s = F.element_at(p, -1)
    name = F.expr(f"substring({key}, 1, length({key}) - length(element_at(split({key}, ':', -1), -1))"
                  f" - length(element_at(split({key}, ':', -1), -2)) - 2)")
    return (df.withColumn("name", F.when(ok, name))
            .withColumn("lon", F.when(ok, lon_s).try_cast("double"))
            .withColumn("lat", F.when(ok, lat_s).try_cast("double")))


# Digits of the packed order (38 in all): microseconds since 1970 up to the
# year 5138, partitions below 100,000, offsets below 10**16.
ORDER_DIGITS = {"timestamp": 17, "partition": 5, "offset": 16, "batch_id": 16}


def packed_order(df: DataFrame, order) -> F.Column:
    """Whole-number order columns as one decimal(38, 0), most significant
    first. A value that is null, negative or too long for its digits fails the job."""
    parts = []
    for c in order:
        n = ORDER_DIGITS[c]
        v = F.unix_micros(c) if df.schema[c].dataType.typeName().startswith("timestamp") else F.col(c).cast("long")
        if df.schema[c].dataType.typeName() == "timestamp_ntz":
            v = F.unix_micros(F.col(c).cast("timestamp"))
        text = F.when((v >= 0) & (v < F.lit(10 ** n)), F.lpad(v.cast("string"), n, "0")).otherwise(
            F.raise_error(F.concat(F.lit(f"{c} outside 0..10^{n}: "), F.coalesce(v.cast("string"), F.lit("null")))))
        parts.append(text)
    return F.concat(*parts).cast("decimal(38,0)")


def latest_by_key(df: DataFrame, keys=("city_and_loc", "time"), order=("timestamp", "partition", "offset"),
                  value: str = "temperature", packed: bool = False) -> DataFrame:
    """A2: newest value per key, last write wins (the keyed upsert).

    An ordinary aggregate with a partial (map-side) step: each task keeps one
    row per key before the shuffle, so a key holding a third of all rows costs
    no more than any other. The order is compared as a struct, which takes any
    types but makes Spark sort each task's rows; with ``packed`` it is one
    decimal (bounds in ``packed_order``; at most 38 digits), whose fixed width lets the
    hash aggregate keep the newest row in place.
    """
    order = [c for c in order if c in df.columns]
    if packed:
        newest = F.max_by(F.col(value), packed_order(df, order))
        return df.groupBy(*keys).agg(newest.alias(value))
    newest = F.max(F.struct(*[F.col(c) for c in order], F.col(value).alias("_val")))
    return (df.groupBy(*keys).agg(newest.alias("_newest"))
            .select(*keys, F.col("_newest._val").alias(value)))


def mean_by_city(current: DataFrame, key: str = "city_and_loc", value: str = "temperature") -> DataFrame:
    """A1: unweighted mean over the hour slots present, per station.

    Float values are widened to double before summing, as the reference sums
    Python floats.
    """
    return (current.groupBy(key)
            .agg(F.avg(F.col(value).cast("double")).alias("avg_temp")))


def point_stats(points: DataFrame) -> DataFrame:
    """A5: shape of a point set (what the reference logs before gridding)."""
    return points.agg(F.count(F.lit(1)).cast("bigint").alias("n_points"),
                      F.min("x").alias("min_x"), F.max("x").alias("max_x"),
                      F.min("y").alias("min_y"), F.max("y").alias("max_y"),
                      F.min("v").alias("min_v"), F.max("v").alias("max_v"))
