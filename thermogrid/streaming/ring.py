"""T3 with an end: the 24 hourly readings of a station as a ring whose slots expire.

The plain latest-value stream keeps a silent station's last values for ever, and so would every mean
over "the last 24 hours". Here a slot (station, hour) holds its newest reading until the
watermark is ``keep`` past that reading; an event-time timer then drops it from the state and
sends its key without a temperature, which takes it out of the current store.

State is one row of at most 24 slots per station in RocksDB, which can be read back from the
checkpoint (:func:`read_ring_state`); a micro-batch reads and writes it once per station that it
changes, and one timer per station waits for the slot that ends first. Each task reduces its rows to the newest per slot before
they are shuffled, so a station with many messages costs no more than its slots per task.

A reading that is later than the watermark, or already ``keep`` behind it, is dropped. The
newest reading is the greatest (timestamp, partition, offset); repeated messages change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from thermogrid.operators.readings import decode_reading
from thermogrid.session import scratch_path
from thermogrid.sources.current_store import claim_checkpoint, read_current, upsert_current
from thermogrid.streaming.ingest import _finish, _maybe_compact, _message_files, _trigger

KEEP_HOURS = 24
ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
ORDER = ["timestamp", "partition", "offset"]
ROW = "city_and_loc string, time int, timestamp timestamp, partition int, offset long, temperature float"
Change = Row("city_and_loc", "time", "us", "partition", "offset", "temperature")
CHANGE = "city_and_loc string, time int, us long, partition int, offset long, temperature float"
# when the timer is due, and the slots: one list per column, in one order
STATE = "due long, time array<int>, us array<bigint>, partition array<int>, offset array<bigint>, temperature array<float>"


def _newest_per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.sort_values(ORDER, kind="stable").drop_duplicates(["city_and_loc", "time"], keep="last")


class Ring(StatefulProcessor):
    """Slots of one station: hour, time of the reading in microseconds, partition, offset, temperature."""

    def __init__(self, keep_hours: int):
        self.keep_ms = int(keep_hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getValueState("slots", STATE)

    def _ends(self, us: int) -> int:
        return -(-us // 1000) + self.keep_ms

    def _load(self) -> tuple[dict[int, tuple], int | None]:
        held = self.slots.get()
        if held is None:
            return {}, None
        due, hours, *columns = held
        return dict(zip(hours, zip(*columns))), due

    def _save(self, slots: dict[int, tuple], due: int | None, now: int) -> None:
        """The slots as they are, with a timer for the first that ends unless one that is due earlier is set."""
        if not slots:
            self.slots.clear()
            return
        first = min(self._ends(v[0]) for v in slots.values())
        if due is None or due <= now or first < due:
            self.handle.registerTimer(first)
            due = first
        self.slots.update((due, list(slots), *map(list, zip(*slots.values()))))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        newest: dict[int, tuple] = {}
        for _, time, _, part, off, temp, us in rows:
            new = (us, part, off, temp)
            if self._ends(us) > now and (time not in newest or new[:3] > newest[time][:3]):
                newest[time] = new
        if not newest:
            return
        slots, due = self._load()
        newest = {t: v for t, v in newest.items() if t not in slots or v[:3] > slots[t][:3]}
        if newest:
            self._save({**slots, **newest}, due, now)
        for time, new in newest.items():
            yield Change(key[0], time, *new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        slots, due = self._load()
        ended = {t: v for t, v in slots.items() if self._ends(v[0]) <= now}
        if ended or (due is not None and due <= now):
            self._save({t: v for t, v in slots.items() if t not in ended}, due, now)
        for time, (us, part, off, _) in ended.items():
            yield Change(key[0], time, us, part, off, None)

    def close(self) -> None:
        pass


def ring_stream(messages: DataFrame, delay: str = "1 hour", keep_hours: int = KEEP_HOURS) -> DataFrame:
    """Changes of the ring: rows with a temperature are new values of a slot, rows without one
    are slots that expired. Needs the RocksDB state store (``ROCKS``) when it is started."""
    good = decode_reading(messages).select("city_and_loc", "time", F.col("timestamp").cast("timestamp").alias("timestamp"),
                                           F.col("partition").cast("int").alias("partition"),
                                           F.col("offset").cast("long").alias("offset"), "temperature")
    changes = (good.mapInPandas(_newest_per_task, ROW).withWatermark("timestamp", delay)
               .withColumn("us", F.unix_micros("timestamp")).groupBy("city_and_loc")
               .transformWithState(Ring(keep_hours), CHANGE, "Update", "EventTime"))
    return changes.select("city_and_loc", "time", F.timestamp_micros("us").alias("timestamp"), "partition", "offset", "temperature")


def start_ring(messages: DataFrame, path: str, checkpoint: str | None = None, trigger: str | None = "1 second",
               available_now: bool = False, delay: str = "1 hour", keep_hours: int = KEEP_HOURS,
               compact_every: int | None = 600) -> StreamingQuery:
    """The ring written into the current store at ``path``, which then holds the live slots only."""
    spark = messages.sparkSession
    checkpoint = claim_checkpoint(spark, path, checkpoint, "ring")

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert_current(batch, batch_id, path)
        _maybe_compact(batch.sparkSession, path, batch_id, compact_every)

    before = {k: spark.conf.get(k, None) for k in ROCKS}
    for k, v in ROCKS.items():
        spark.conf.set(k, v)
    try:  # a query keeps the settings it was started with
        w = (ring_stream(messages, delay, keep_hours).writeStream.outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", checkpoint))
        return _trigger(w, trigger, available_now).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ring_batch(decoded: DataFrame, delay_hours: float = 1.0, keep_hours: int = KEEP_HOURS) -> DataFrame:
    """Batch twin: the newest reading per station and hour, without those that end by
    the watermark, which is ``delay_hours`` behind the newest reading of all."""
    t = F.unix_micros(F.col("timestamp").cast("timestamp"))
    newest = (decoded.groupBy("city_and_loc", "time").agg(F.max(F.struct(t.alias("us"), "partition", "offset", "temperature")).alias("n")))
    last = decoded.agg(F.max(t).alias("last")).first().last or 0
    watermark = last // 1000 - int(delay_hours * 3_600_000)
    live = F.ceil(F.col("n.us") / 1000) + keep_hours * 3_600_000 > watermark
    return newest.where(live).select("city_and_loc", "time", F.col("n.temperature").alias("temperature"))


def read_ring_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``city_and_loc, time, us, partition, offset, temperature`` as the stopped stream's state has them."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "slots").load())
    columns = ["time", "us", "partition", "offset", "temperature"]
    return (state.select(F.col("key.city_and_loc").alias("city_and_loc"), F.arrays_zip(*[f"value.{c}" for c in columns]).alias("s"))
            .select("city_and_loc", F.inline("s").alias(*columns)))


def run_ring_stream_once(spark: SparkSession, messages: DataFrame, records_per_file: int | None = None,
                         state: bool = False) -> DataFrame:
    """Drive the ring end to end over ``messages`` and return the store's live view, or the state itself."""
    base = scratch_path(spark, "stream-ring")
    stream = _message_files(spark, messages, f"{base}/in", records_per_file)
    _finish(start_ring(stream, f"{base}/store", available_now=True))
    return read_ring_state(spark, f"{base}/store/checkpoint/ring") if state else read_current(spark, f"{base}/store")
