"""Inputs in the shapes the engine expects, derived from the given tables.

The reference ships no data; these builders turn the driver's test tables into
readings, messages, a station registry, a request log and a climatology, always
with Spark reading the tables, so every derived input grows with them. The
matching DuckDB text lives in ``fixtures.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermogrid.functions.columns import TOPIC, encode_key

# Fixed values of the derivations (see FIXTURES.md): station positions from
# multiplicative hashes of the id, climatology on a 1 degree lattice.
LON_MULT = 7919
LAT_MULT = 104729
LATTICE_ROWS = 180
LATTICE_COLS = 360


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lon(idcol):
    return (F.pmod(F.col(idcol) * LON_MULT, F.lit(3600)) - 1800) / F.lit(10.0)


def _lat(idcol):
    return (F.pmod(F.col(idcol) * LAT_MULT, F.lit(1800)) - 900) / F.lit(10.0)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts, name, lon, lat, hour, temp`` from ``events``."""
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        F.col("event_id"),
        ts.alias("ts"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("name"),
        _lon("user_id").alias("lon"),
        _lat("user_id").alias("lat"),
        F.hour(ts).cast("int").alias("hour"),
        (F.col("value") - F.lit(50)).alias("temp"),
    )


def messages(spark: SparkSession, sf_dir: str, as_bytes: bool = False) -> DataFrame:
    """Readings as topic messages: ``key, value, topic, partition, offset, timestamp``."""
    r = readings(spark, sf_dir)
    key = encode_key("name", "lon", "lat", "hour")
    value = F.col("temp").cast("string")
    if as_bytes:
        key, value = F.encode(key, "UTF-8"), F.encode(value, "UTF-8")
    return r.select(key.alias("key"), value.alias("value"), F.lit(TOPIC).alias("topic"),
                    F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                    F.col("ts").alias("timestamp"))


def bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with broken rows, by ``event_id`` modulo 50: 0 lacks the hour, 1
    has 'n/a' as value, 2 carries a ':' inside the name (still valid), 3 and 4
    have the values NaN and Infinity, 5 the longitude 999, 6 the hour 99, 7 a null
    latitude (so a null key), 8 a value beyond the float range, 9 the latitude NaN."""
    r = readings(spark, sf_dir)
    k = F.pmod(F.col("event_id"), F.lit(50))
    lon_s, lat_s, hour_s = (F.col(c).cast("string") for c in ("lon", "lat", "hour"))
    lon_s = F.when(k == 5, F.lit("999")).otherwise(lon_s)
    lat_s = F.when(k == 9, F.lit("NaN")).when(k != 7, lat_s)
    hour_s = F.when(k == 6, F.lit("99")).otherwise(hour_s)
    key = (F.when(k == 0, F.concat_ws(":", "name", lon_s, lat_s))
           .when(k == 2, F.concat_ws(":", F.lit("New"), "name", lon_s, lat_s, hour_s))
           .otherwise(encode_key("name", lon_s, lat_s, hour_s)))
    value = (F.when(k == 1, F.lit("n/a")).when(k == 3, F.lit("NaN")).when(k == 4, F.lit("Infinity"))
             .when(k == 8, F.lit("1e300")).otherwise(F.col("temp").cast("string")))
    return r.select(key.alias("key"), value.alias("value"), F.col("event_id").alias("offset"))


def weather_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather service responses as JSON text: ``event_id, body``."""
    r = readings(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")
    body = F.concat(F.lit('{"name":"'), F.col("name"), F.lit('","main":{"temp":'), s("temp"),
                    F.lit('},"coord":{"lon":'), s("lon"), F.lit(',"lat":'), s("lat"),
                    F.lit('},"dt":'), (F.lit(1704067200) + F.col("event_id") * 60).cast("string"),
                    F.lit("}"))
    return r.select("event_id", body.alias("body"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City registry ``seq, id, lon, lat`` from ``customer`` (file order = seq)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("id"),
                    _lon("c_custkey").alias("lon"), _lat("c_custkey").alias("lat"))


def scattered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scattered measurements ``pid, x, y, v`` in grid units of 1 degree from ``customer``: the registry's
    positions, shifted off their tenths, and the account balance in hundreds."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.cast("string").alias("pid"),
                    (F.lit(90.0) - _lat("c_custkey") + F.pmod(k * k * 31, F.lit(1009)) / F.lit(8072.0)).alias("x"),
                    (_lon("c_custkey") + F.lit(180.0) + F.pmod(k * k * 17, F.lit(1013)) / F.lit(8104.0)).alias("y"),
                    (F.col("c_acctbal").cast("double") / F.lit(100.0)).alias("v"))


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log ``ts, event_id, client, request_id, attempt, status`` from
    ``events``: 50 calls per second over 10 clients, 4 attempts per request."""
    ev = table(spark, sf_dir, "events")
    h = F.pmod(F.col("event_id") * 7919, F.lit(10))
    return ev.select(
        F.timestamp_seconds(F.lit(1704067200) + F.expr("event_id div 50")).alias("ts"),
        F.col("event_id"),
        F.concat(F.lit("C"), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias("client"),
        F.expr("event_id div 4").alias("request_id"),
        (F.pmod(F.col("event_id"), F.lit(4)) + 1).cast("int").alias("attempt"),
        F.when(h < 7, F.lit(200)).when(h < 9, F.lit(500)).cast("int").alias("status"),
    )


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct day indexes (day of year - 1) of the readings."""
    return (readings(spark, sf_dir)
            .select((F.dayofyear("ts") - 1).cast("int").alias("day_number")).distinct())


def climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily 1 degree climatology for the days present in the readings.

    ``day_number, latitude, longitude, climatology``; about 1 % of the lattice
    is missing (null). Each day row is expanded to its lattice with a generator,
    not a join.
    """
    days = event_days(spark, sf_dir)
    # expand in two steps (day -> lattice rows, spread over the cores -> cells)
    # so that one day is not generated in a single task
    lat_rows = days.select("day_number", F.explode(F.sequence(F.lit(0), F.lit(LATTICE_ROWS - 1))).alias("li"))
    nparts = max(1, spark.sparkContext.defaultParallelism)
    cells = (lat_rows.repartition(nparts, "day_number", "li")
             .select("day_number", "li", F.explode(F.sequence(F.lit(0), F.lit(LATTICE_COLS - 1))).alias("lj"))
             .select("day_number", (F.col("li") * LATTICE_COLS + F.col("lj")).alias("cell")))
    lat_i = F.expr(f"cast(cell div {LATTICE_COLS} as int)")
    lon_j = F.expr(f"cast(cell % {LATTICE_COLS} as int)")
    lat = lat_i - F.lit(89.5)
    val = (F.lit(28.0) - F.lit(0.006) * lat * lat
           + F.lit(0.25) * F.pmod(lat_i * 13 + lon_j * 7 + F.col("day_number"), F.lit(11)))
    return (cells
            .select("day_number", lat.alias("latitude"), (lon_j - F.lit(179.5)).alias("longitude"),
                    F.when(F.pmod(lat_i * 31 + lon_j, F.lit(97)) == 0, F.lit(None).cast("double"))
                    .otherwise(val).alias("climatology")))


def land_mask(spark: SparkSession, scale: float = 1.0) -> DataFrame:
    """Synthetic land mask ``r, c, land`` of a grid at ``scale`` cells per degree.

    A cell is land when ``(deg_row div 10)*7 + (deg_col div 10)*3`` ends in 0-5,
    with ``deg_row/deg_col`` the whole degree of the cell. It plays the part of
    the reference's mask file, which is not in its checkout.
    """
    rows, cols = int(round(180 * scale)), int(round(360 * scale))
    cells = spark.range(0, rows * cols)
    r = F.expr(f"id div {cols}")
    c = F.pmod(F.col("id"), F.lit(cols))
    dr = F.floor(r / F.lit(float(scale)))
    dc = F.floor(c / F.lit(float(scale)))
    land = F.pmod(F.floor(dr / 10) * 7 + F.floor(dc / 10) * 3, F.lit(10)) < 6
    return cells.select(r.cast("int").alias("r"), c.cast("int").alias("c"), land.alias("land"))
