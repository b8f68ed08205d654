"""Readings: encode/decode round trip, bad keys, latest per key, day index."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from thermogrid.functions.columns import day_index, hour_of_day
from thermogrid.operators import readings as rd


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame([("Austin", -97.76, 30.26, 5, 21.5), ("New:York", -74.0, 40.7, 23, -3.25)],
                               "name string, lon double, lat double, hour int, temp double")
    msg = rd.encode_reading(df)
    assert dict(msg.dtypes)["key"] == "binary"
    out = {r.city_and_loc: (r.time, r.temperature) for r in rd.decode_reading(msg).collect()}
    assert out == {"Austin:-97.76:30.26": (5, 21.5), "New:York:-74.0:40.7": (23, -3.25)}


def test_quarantine_reasons(spark):
    rows = [("A:1.0:2.0:3", "4.5"), ("A:1.0:2.0", "4.5"), ("A:1.0:2.0:x", "4.5"), ("A:1.0:2.0:3", "n/a"),
            ("A:b:2.0:3", "1"), ("A:1.0:2.0:", "1"), (None, "1"), ("A:B:1.0:2.0:7", "1e1")]
    df = spark.createDataFrame(rows, "key string, value string")
    good, bad = rd.quarantine_bad(df)
    assert sorted((r.city_and_loc, r.time, r.temperature) for r in good.collect()) == [
        ("A:1.0:2.0", 3, 4.5), ("A:B:1.0:2.0", 7, 10.0)]
    reasons = sorted((r.key or "", r.reason) for r in bad.collect())
    assert reasons == [("", "key"), ("A:1.0:2.0", "key"), ("A:1.0:2.0:", "hour"), ("A:1.0:2.0:3", "value"),
                       ("A:1.0:2.0:x", "hour"), ("A:b:2.0:3", "key")]


def test_latest_by_key_last_write_wins(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("k", 1, 1.0, t, 0, 1), ("k", 1, 2.0, t, 0, 2), ("k", 1, 0.5, t - dt.timedelta(hours=1), 0, 9),
            ("k", 2, 7.0, t, 0, 3)]
    df = spark.createDataFrame(rows, "city_and_loc string, time int, temperature float, timestamp timestamp, "
                                     "partition int, offset long")
    out = {(r.city_and_loc, r.time): r.temperature for r in rd.latest_by_key(df).collect()}
    assert out == {("k", 1): 2.0, ("k", 2): 7.0}
    means = {r.city_and_loc: r.avg_temp for r in rd.mean_by_city(rd.latest_by_key(df)).collect()}
    assert means == {"k": 4.5}


def test_unpack_city_keeps_colons(spark):
    df = spark.createDataFrame([("New:York:-74.0:40.7",)], "city_and_loc string")
    r = rd.unpack_city(df).first()
    assert (r.name, r.lon, r.lat) == ("New:York", -74.0, 40.7)


def test_parse_weather_and_hour(spark):
    body = '{"name":"X","main":{"temp":-1.5},"coord":{"lon":3.0,"lat":4.0},"dt":1704070800}'
    r = rd.parse_weather(spark.createDataFrame([(body,)], "body string")).first()
    assert (r.name, r.temp, r.lon, r.lat, r.dt, r.hour) == ("X", -1.5, 3.0, 4.0, 1704070800, 1)
    h = spark.range(1).select(hour_of_day(F.lit(1704067200 + 23 * 3600 + 59)).alias("h")).first().h
    assert h == 23


def test_day_index_leap_rule(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 31, 12),), (dt.datetime(2023, 12, 31),),
                                (dt.datetime(2024, 1, 1),)], "ts timestamp")
    assert [r.d for r in df.select(day_index("ts", "clamp").alias("d")).collect()] == [364, 364, 0]
    with pytest.raises(Exception):
        df.select(day_index("ts", "error").alias("d")).collect()
    ok = df.where(F.year("ts") == 2023).select(day_index("ts").alias("d")).first().d
    assert ok == 364
    with pytest.raises(ValueError):
        day_index("ts", "wrap")
