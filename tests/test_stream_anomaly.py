"""Anomalies while the stream runs: equal to the batch twin over midnight, restarts, days that are added later."""

import datetime as dt
import os

from paths import SF001
from fixtures import testbed as tb
from thermogrid.plans import anomaly as an
from thermogrid.sources.messages import MESSAGE_SCHEMA
from thermogrid.streaming import anomaly as sa


def references(spark, path, days):
    an.write_reference_models(an.reference_models(tb.climatology(spark, SF001), tb.land_mask(spark, 0.5), days, 0.5), path)
    return spark.read.schema("r int, c int, v double, taps int, day_number int").parquet(path)


def rows(df):
    return sorted(map(tuple, df.select("offset", "city_and_loc", "time", "day_number", "r", "c", "temperature", "ref", "anomaly").collect()), key=str)


def test_stream_equals_batch_twin(spark, tmp):
    refs = references(spark, os.path.join(tmp, "refs"), None)
    msgs = tb.messages(spark, SF001)
    got = sa.run_reading_anomaly_once(spark, msgs, refs, 0.5, records_per_file=200)
    want = rows(sa.reading_anomaly(msgs, refs, 0.5))
    assert rows(got) == want and len({w[3] for w in want}) > 20
    assert 0 < sum(w[7] is None for w in want) < len(want)


def test_midnight_restart_and_a_later_day(spark, tmp):
    path, src, out = (os.path.join(tmp, x) for x in ("refs", "in", "out"))
    days = sorted(r.day_number for r in tb.climatology(spark, SF001).select("day_number").distinct().collect())[:3]
    refs = references(spark, path, days[:2])
    first = dt.datetime(2024, 1, 1) + dt.timedelta(days=days[0])
    land = next((r.r, r.c) for r in refs.where("v is not null").orderBy("r", "c").limit(1).collect())
    key = f"A:{land[1] / 0.5 - 180.0 + 0.5}:{90.0 - land[0] / 0.5 - 0.5}:0".encode()

    def feed(name, times):
        spark.createDataFrame([(key, b"5.0", "t", 0, i, t) for i, t in times], MESSAGE_SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))

    def run():
        stream = spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true").parquet(src)
        table = spark.read.schema("r int, c int, v double, taps int, day_number int").parquet(path)
        q = sa.start_reading_anomaly(stream, table, out, 0.5, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        return {r.offset: (r.day_number, r.ref) for r in spark.read.parquet(out).collect()}

    value = {d: refs.where(f"day_number = {d} and r = {land[0]} and c = {land[1]}").first().v for d in days[:2]}
    late = first + dt.timedelta(days=days[1] - days[0])
    feed("a", [(1, first + dt.timedelta(hours=23, minutes=59)), (2, late + dt.timedelta(minutes=1))])
    assert run() == {1: (days[0], value[days[0]]), 2: (days[1], value[days[1]])}
    assert len(run()) == 2               # nothing twice
    third = first + dt.timedelta(days=days[2] - days[0], hours=5)
    feed("b", [(3, third)])
    assert run()[3] == (days[2], None)   # this day is not stored yet
    references(spark, path, days)
    feed("c", [(4, third), (5, first)])
    got = run()
    assert got[4][1] is not None and got[5] == (days[0], value[days[0]]) and len(got) == 5
