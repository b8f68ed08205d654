"""The expiring ring: stream against its batch twin, silent stations, restarts, late and repeated messages, readable state."""

import datetime as dt
import os

from fixtures import testbed as tb
from paths import SF001
from thermogrid.operators import readings as rd
from thermogrid.sources import current_store as cs
from thermogrid.sources.messages import MESSAGE_SCHEMA
from thermogrid.streaming import ring as R

T0 = dt.datetime(2024, 3, 1)


def message(city, hour, value, at, offset):
    return (f"{city}:1.0:2.0:{hour}".encode(), str(value).encode(), "t", 0, offset, T0 + dt.timedelta(hours=at))


def feed(spark, src, name, rows):
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))


def run(spark, src, store):
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    q = R.start_ring(stream, store, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    return {(r.city_and_loc[:1], r.time): r.temperature for r in cs.read_current(spark, store).collect()}


def test_stream_equals_batch_twin(spark):
    msgs = tb.messages(spark, SF001)
    want = {(r.city_and_loc, r.time): r.temperature for r in R.ring_batch(rd.decode_reading(msgs)).collect()}
    got = {(r.city_and_loc, r.time): r.temperature for r in R.run_ring_stream_once(spark, msgs).collect()}
    assert got == want and 0 < len(want) < rd.latest_by_key(rd.decode_reading(msgs)).count()


def test_silent_station_leaves_over_restarts(spark, tmp):
    src, store = os.path.join(tmp, "in"), os.path.join(tmp, "store")
    feed(spark, src, "a", [message("A", 0, 1.0, 0, 1), message("A", 1, 2.0, 1, 2), message("B", 1, 3.0, 1, 3), message("B", 1, 3.0, 1, 3)])
    assert run(spark, src, store) == {("A", 0): 1.0, ("A", 1): 2.0, ("B", 1): 3.0}
    # B goes on, A falls silent; the watermark is an hour behind
    feed(spark, src, "b", [message("B", 2, 4.0, 25, 4)])
    assert run(spark, src, store) == {("A", 1): 2.0, ("B", 1): 3.0, ("B", 2): 4.0}
    # late beyond the watermark, then a newer value for a slot and an older one for the same
    feed(spark, src, "c", [message("A", 3, 9.0, 2, 5), message("B", 1, 5.0, 25.5, 6), message("B", 1, 8.0, 25.2, 7)])
    assert run(spark, src, store) == {("A", 1): 2.0, ("B", 1): 5.0, ("B", 2): 4.0}
    feed(spark, src, "d", [message("B", 3, 6.0, 27, 8)])
    assert run(spark, src, store) == {("B", 1): 5.0, ("B", 2): 4.0, ("B", 3): 6.0}
    state = R.read_ring_state(spark, f"{store}/checkpoint/ring").collect()
    assert {(r.city_and_loc[:1], r.time): r.temperature for r in state} == {("B", 1): 5.0, ("B", 2): 4.0, ("B", 3): 6.0}
    # a fold forgets the expired slots for good
    cs.compact_current(spark, store)
    assert {r.city_and_loc[:1] for r in cs.read_current(spark, store).collect()} == {"B"}
    feed(spark, src, "e", [message("A", 1, 7.0, 28, 9)])
    assert run(spark, src, store)[("A", 1)] == 7.0


def test_one_station_with_most_messages(spark, tmp):
    src, store = os.path.join(tmp, "in"), os.path.join(tmp, "store")
    rows = [message("H", i % 24, float(i), i / 1000, i) for i in range(3000)] + [message("Q", 5, 1.5, 1, 9000)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).repartition(6).write.parquet(os.path.join(src, "a"))
    got = run(spark, src, store)
    assert got == {**{("H", h): float(2976 + h) for h in range(24)}, ("Q", 5): 1.5}


def test_incremental_map_of_a_stream(spark, tmp):
    """T5 by differences: after each micro-batch the state equals a full build from the store."""
    from thermogrid.operators import grid as gr
    from thermogrid.plans import anomaly as an
    from thermogrid.plans import incremental as inc
    from thermogrid.plans import refresh as rf
    from thermogrid.streaming import ingest as ig
    msgs = tb.messages(spark, SF001)
    src, store, state = (os.path.join(tmp, x) for x in ("in", "store", "state"))
    done = []

    def go():
        stream = spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true").parquet(src)
        q = ig.start_incremental_refresh(stream, store, state, available_now=True, scale=1.0, sigma=2.0, on_refresh=done.append)
        q.awaitTermination()
        assert q.exception() is None

    for name, part in (("a", msgs.where("offset < 990")), ("b", msgs.where("offset >= 990"))):
        (part.selectExpr("cast(key as binary) key", "cast(value as binary) value", "topic", "partition", "offset", "timestamp")
         .write.parquet(os.path.join(src, name)))
        go()
        means = rd.mean_by_city(rd.city_temperature(cs.read_current(spark, store)))
        want = {(r.r, r.c): r.v for r in an.smoothed_model(means, 1.0, 2.0).collect()}
        got = {(r.r, r.c): r.s for r in inc.read_map_state(spark, state).collect()}
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    assert [d.full for d in done] == [True, False] and 0 < done[1].cells_nearest < 0.5 * 180 * 360
    clim, mask, when = tb.climatology(spark, SF001), tb.land_mask(spark, 1.0), dt.datetime(2024, 1, 15)
    a = rf.map_from_state(spark, state, clim, mask, when, 1.0).select("r", "c", "level").collect()
    b = rf.map_from_store(spark, store, clim, mask, when, 1.0, sigma=2.0).select("r", "c", "level").collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str) and gr.grid_shape(1.0) == (180, 360)


class Handle:
    """One station's state and timers, counting what a batch asks of them."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


class Now:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def test_a_batch_asks_the_state_once_per_station():
    hour, ring, h = 3_600_000_000, R.Ring(24), Handle()
    ring.init(h)
    rows = [("A", t, None, 0, t, float(t), t * hour) for t in range(24)]
    assert len(list(ring.handleInputRows(("A",), iter(rows), Now(0)))) == 24
    assert h.calls <= 3 and h.timers == [24 * 3_600_000]
    # the first slot is renewed: its timer finds the next one, and the slots that ended go together
    h.calls = 0
    assert [r.time for r in ring.handleInputRows(("A",), iter([("A", 0, None, 0, 30, 5.0, 24 * hour)]), Now(0))] == [0]
    assert list(ring.handleExpiredTimer(("A",), Now(24 * 3_600_000), None)) == [] and h.timers[-1] == 25 * 3_600_000
    gone = list(ring.handleExpiredTimer(("A",), Now(40 * 3_600_000), None))
    assert sorted(r.time for r in gone) == list(range(1, 17)) and all(r.temperature is None for r in gone)
    assert h.calls <= 8 and h.timers[-1] == 41 * 3_600_000
    list(ring.handleExpiredTimer(("A",), Now(99 * 3_600_000), None))
    assert h.value is None
