"""Streaming: file source with availableNow, restart on one checkpoint, replay,
malformed rows, stream result = batch twin (T1-T5)."""

import os

from pyspark.sql import functions as F

from thermogrid.operators import readings as rd
from thermogrid.sources import current_store as cs
from fixtures import testbed as tb
from thermogrid.sources.messages import MESSAGE_SCHEMA, read_readings_stream, write_readings
from thermogrid.streaming import ingest as ig
from paths import SF001


def _as_bytes(df):
    return df.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                     *[c for c in ("topic", "partition", "offset", "timestamp") if c in df.columns])


def _bad_messages(spark):
    m = tb.messages(spark, SF001)
    bad = tb.bad_messages(spark, SF001).select("offset", F.col("key").alias("bkey"), F.col("value").alias("bvalue"))
    return (m.join(bad, "offset").select(F.col("bkey").alias("key"), F.col("bvalue").alias("value"), "topic",
                                         "partition", "offset", "timestamp"))


def test_ingest_restart_no_loss_no_duplicates(spark, tmp):
    msgs = _bad_messages(spark)
    src, store, ckpt = (os.path.join(tmp, x) for x in ("in", "store", "ckpt"))
    first = msgs.where("offset < 600")
    second = msgs.where("offset >= 600")
    write_readings(_as_bytes(first), "parquet", os.path.join(src, "part1"))
    stream = read_readings_stream(spark, "parquet", src, recursiveFileLookup="true")
    q = ig.start_ingest(stream, store, ckpt, available_now=True)
    q.awaitTermination()
    n1 = spark.read.parquet(os.path.join(store, "log")).count()
    q = ig.start_ingest(read_readings_stream(spark, "parquet", src, recursiveFileLookup="true"), store, ckpt,
                        available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(store, "log")).count() == n1      # nothing read twice
    write_readings(_as_bytes(second), "parquet", os.path.join(src, "part2"))
    q = ig.start_ingest(read_readings_stream(spark, "parquet", src, recursiveFileLookup="true"), store, ckpt,
                        available_now=True)
    q.awaitTermination()
    good, bad = rd.quarantine_bad(msgs)
    assert spark.read.parquet(os.path.join(store, "log")).count() == good.count()
    assert spark.read.parquet(os.path.join(store, "quarantine")).count() == bad.count()
    got = {(r.city_and_loc, r.time): r.temperature for r in cs.read_current(spark, store).collect()}
    twin = rd.latest_by_key(good.withColumn("batch_id", F.when(F.col("offset") < 600, 0).otherwise(1)),
                            order=("batch_id", "timestamp", "partition", "offset"))
    assert got == {(r.city_and_loc, r.time): r.temperature for r in twin.collect()}


def test_latest_state_stream_equals_batch(spark):
    msgs = tb.messages(spark, SF001)
    got = {(r.city_and_loc, r.time): r.temperature for r in ig.run_latest_stream_once(spark, msgs, 300).collect()}
    exp = {(r.city_and_loc, r.time): r.temperature for r in rd.latest_by_key(rd.decode_reading(msgs)).collect()}
    assert got == exp


def test_mean_last_24h_stream_equals_batch_twin(spark, tmp):
    msgs = tb.messages(spark, SF001)
    src = os.path.join(tmp, "in")
    write_readings(_as_bytes(msgs), "parquet", src)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(src)
    win = ig.mean_last_24h(rd.decode_reading(stream), watermark="365 days")
    q = win.writeStream.outputMode("update").format("memory").queryName("win24").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.city_and_loc, r.window_start): (round(r.avg_temp, 9), r.n) for r in spark.table("win24").collect()}
    twin = ig.mean_last_24h_batch(rd.decode_reading(msgs))
    exp = {(r.city_and_loc, r.window_start): (round(r.avg_temp, 9), r.n) for r in twin.collect()}
    assert got == exp


def test_chained_windows_give_the_closed_windows_of_the_twin(spark):
    msgs = tb.messages(spark, SF001)
    got = {(r.city_and_loc, r.window_start): (round(r.avg_temp, 6), r.n) for r in ig.run_windows_stream_once(spark, msgs).collect()}
    last = msgs.agg(F.max(F.unix_seconds(F.col("timestamp").cast("timestamp")))).first()[0]
    twin = ig.mean_last_24h_batch(rd.decode_reading(msgs)).where(F.col("window_start") + 86400 <= last - 3600)
    assert got == {(r.city_and_loc, r.window_start): (round(r.avg_temp, 6), r.n) for r in twin.collect()} and got


def test_late_rows_beyond_watermark_are_dropped(spark, tmp):
    import datetime as dt
    src = os.path.join(tmp, "late")
    t0 = dt.datetime(2024, 1, 10)
    rows1 = [(b"A:1.0:2.0:0", b"1.0", "t", 0, 1, t0), (b"A:1.0:2.0:0", b"3.0", "t", 0, 2, t0 + dt.timedelta(days=3))]
    rows2 = [(b"A:1.0:2.0:0", b"100.0", "t", 0, 3, t0)]                 # two days late
    spark.createDataFrame(rows1, MESSAGE_SCHEMA).write.parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    q = (ig.mean_last_24h(rd.decode_reading(stream), watermark="1 hour").writeStream.outputMode("append")
         .format("memory").queryName("late24").start())
    q.processAllAvailable()
    spark.createDataFrame(rows2, MESSAGE_SCHEMA).write.parquet(os.path.join(src, "b"))
    q.processAllAvailable()
    q.stop()
    vals = [r.avg_temp for r in spark.table("late24").collect()]
    assert vals and all(v == 1.0 for v in vals)        # the late 100.0 never entered a window


def test_map_refresh_runs_only_with_rows(spark, tmp):
    from thermogrid.operators import grid as gr
    msgs = tb.messages(spark, SF001)
    src, store, out = (os.path.join(tmp, x) for x in ("in", "store", "map"))
    write_readings(_as_bytes(msgs), "parquet", src)

    def build(sp, path):
        means = rd.mean_by_city(cs.read_current(sp, path))
        pts = gr.to_points(rd.unpack_city(means), 0.2)
        rows, cols = gr.grid_shape(0.2)
        near = gr.nearest_points(pts, rows, cols, 4)
        return gr.gaussian_blur(near, rows, cols, 1.0).withColumn("diff", F.col("v"))

    q = ig.start_map_refresh(spark.readStream.schema(MESSAGE_SCHEMA).parquet(src), store, build, out,
                             os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 36 * 72


def test_ingest_compacts_and_view_is_unchanged(spark, tmp):
    msgs = tb.messages(spark, SF001)
    src, store, ckpt = (os.path.join(tmp, x) for x in ("in", "store", "ckpt"))
    for i in range(4):   # four files -> four micro-batches
        write_readings(_as_bytes(msgs.where(F.col("offset") % 4 == i)), "parquet", os.path.join(src, f"p{i}"))
    stream = read_readings_stream(spark, "parquet", src, recursiveFileLookup="true", maxFilesPerTrigger=1)
    ig.start_ingest(stream, store, ckpt, available_now=True, compact_every=2).awaitTermination()
    assert os.path.isdir(os.path.join(store, "snapshot", "upto=2"))
    got = {(r.city_and_loc, r.time): r.temperature for r in cs.read_current(spark, store).collect()}
    log = spark.read.parquet(os.path.join(store, "log"))
    exp = {(r.city_and_loc, r.time): r.temperature
           for r in rd.latest_by_key(log, order=("batch_id", "timestamp", "partition", "offset")).collect()}
    assert got == exp and len(got) > 0


def _reading(key, value, offset):
    import datetime as dt
    return (key.encode(), value.encode(), "t", 0, offset, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=offset))


def _feed(spark, src, name, rows):
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))
    return read_readings_stream(spark, "parquet", src, recursiveFileLookup="true", maxFilesPerTrigger=1)


def test_restart_without_explicit_checkpoint_keeps_newer_readings(spark, tmp):
    src, store = os.path.join(tmp, "in"), os.path.join(tmp, "store")
    for i in range(3):
        stream = _feed(spark, src, f"p{i}", [_reading("A:1.0:2.0:0", f"{10 + i}.0", i)])
        ig.start_ingest(stream, store, available_now=True).awaitTermination()
    assert cs.compact_current(spark, store) >= 2
    ig.start_ingest(_feed(spark, src, "p9", [_reading("A:1.0:2.0:0", "99.0", 9)]), store, available_now=True).awaitTermination()
    assert [r.temperature for r in cs.read_current(spark, store).collect()] == [99.0]


def test_fresh_checkpoint_on_a_used_store_is_refused(spark, tmp):
    import pytest
    src, store = os.path.join(tmp, "in"), os.path.join(tmp, "store")
    stream = _feed(spark, src, "p0", [_reading("A:1.0:2.0:0", "1.0", 0)])
    ig.start_ingest(stream, store, available_now=True).awaitTermination()
    for start in (ig.start_ingest, ig.start_latest_state):
        with pytest.raises(ValueError):
            start(stream, store, os.path.join(tmp, "other"), available_now=True)


def test_log_without_a_good_row_folds(spark, tmp):
    src, store = os.path.join(tmp, "in"), os.path.join(tmp, "store")
    for i in range(3):
        stream = _feed(spark, src, f"p{i}", [_reading("broken", "x", i)])
        ig.start_ingest(stream, store, available_now=True, compact_every=1).awaitTermination()
    assert cs.read_current(spark, store).count() == 0
    assert cs.compact_current(spark, store) == max(cs.store_snapshots(spark, store))
    ig.start_ingest(_feed(spark, src, "p9", [_reading("A:1.0:2.0:0", "5.0", 9)]), store, available_now=True,
                    compact_every=1).awaitTermination()
    assert [r.temperature for r in cs.read_current(spark, store).collect()] == [5.0]
    assert spark.read.parquet(os.path.join(store, "quarantine")).count() == 3


def test_folded_batches_are_deleted_after_the_next_fold(spark, tmp):
    path = os.path.join(tmp, "current")
    for i in range(6):
        b = spark.createDataFrame([("k", 1, float(i)), (f"k{i}", 1, 0.0)], "city_and_loc string, time int, temperature float")
        cs.upsert_current(b, i, path)
        if i % 2:
            assert cs.compact_current(spark, path) == i
    assert cs.store_batches(spark, path) == [4, 5] and cs.store_snapshots(spark, path) == [3, 5]
    got = {r.city_and_loc: r.temperature for r in cs.read_current(spark, path).collect()}
    assert got == {"k": 5.0, **{f"k{i}": 0.0 for i in range(6)}}


def test_map_refresh_quarantines_and_folds(spark, tmp):
    src, store, out = (os.path.join(tmp, x) for x in ("in", "store", "map"))
    for i in range(3):
        _feed(spark, src, f"p{i}", [_reading("A:1.0:2.0:0", "7.0", i), _reading("A:1.0:2.0:0", "n/a", i)])
    stream = read_readings_stream(spark, "parquet", src, recursiveFileLookup="true", maxFilesPerTrigger=1)

    def build(sp, path):
        return cs.read_current(sp, path).select(F.lit(0).alias("r"), F.lit(0).alias("c"), F.col("temperature").alias("diff"))

    ig.start_map_refresh(stream, store, build, out, available_now=True, compact_every=2).awaitTermination()
    assert spark.read.parquet(os.path.join(store, "quarantine")).count() == 3
    assert cs.store_snapshots(spark, store) == [2]
    assert [r["diff"] for r in spark.read.parquet(out).collect()] == [7.0]
