"""Structured Streaming jobs.

* T1 ``start_ingest``: messages -> decode -> quarantine -> ``foreachBatch``
  upsert into the current store (last write wins, idempotent per batch id).
* T2 checkpointing: the checkpoint belongs to the store (by default a folder
  below it, the same at every start), so a restart neither loses nor repeats a
  batch; a fresh checkpoint on a store that holds batches is refused.
* T3 ``start_latest_state``: stateful newest-reading-per-key aggregate in
  update mode; the state holds at most one row per station and hour.
* T4 ``mean_last_24h``: 24 h windows sliding by 1 h with a watermark, append
  mode; ``mean_last_24h_batch`` is the batch twin.
* T5 ``start_map_refresh``: rebuild the anomaly map after each micro-batch that
  brought rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from thermogrid.operators.readings import decode_reading, quarantine_bad
from thermogrid.session import scratch_path
from thermogrid.sources.current_store import claim_checkpoint, compact_current, upsert_current


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def _maybe_compact(spark: SparkSession, path: str, batch_id: int, every: int | None) -> None:
    # A 1 s trigger adds 86,400 batch folders a day; folding them into a
    # snapshot every ``every`` batches keeps the latest view's reads short.
    if every and batch_id > 0 and batch_id % int(every) == 0:
        compact_current(spark, path)


def _ingest(batch: DataFrame, batch_id: int, path: str, compact_every: int | None) -> None:
    """One micro-batch: good rows to the log, bad rows to the quarantine (both
    per batch id, overwrite = idempotent), then the log folded when it is due."""
    good, bad = quarantine_bad(batch)
    upsert_current(good, batch_id, path)
    (bad.select("key", "value", "reason", *[c for c in ("timestamp", "partition", "offset") if c in bad.columns])
     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/quarantine/batch_id={int(batch_id)}"))
    _maybe_compact(batch.sparkSession, path, batch_id, compact_every)


def start_ingest(messages: DataFrame, path: str, checkpoint: str | None = None, trigger: str | None = "1 second",
                 available_now: bool = False, query_name: str | None = None,
                 compact_every: int | None = 600) -> StreamingQuery:
    """T1+T2: decode each micro-batch, write good rows to ``path/log`` and bad
    rows to ``path/quarantine`` (both per batch id, overwrite = idempotent);
    every ``compact_every`` batches the log is folded into a snapshot."""
    checkpoint = claim_checkpoint(messages.sparkSession, path, checkpoint, "ingest")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _ingest(batch, batch_id, path, compact_every)
        finally:
            batch.unpersist()

    w = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger, available_now).start()


def latest_state_stream(messages: DataFrame) -> DataFrame:
    """Streaming newest reading per ``(city_and_loc, time)``.

    ``max(struct(timestamp, partition, offset, temperature))`` is a stateful
    aggregate; in update mode each batch emits the keys it changed, and their
    value is always the newest seen so far.
    """
    good = decode_reading(messages)
    newest = F.max(F.struct("timestamp", "partition", "offset", "temperature"))
    return (good.groupBy("city_and_loc", "time").agg(newest.alias("_n"))
            .select("city_and_loc", "time", F.col("_n.timestamp").alias("timestamp"),
                    F.col("_n.partition").alias("partition"), F.col("_n.offset").alias("offset"),
                    F.col("_n.temperature").alias("temperature")))


def start_latest_state(messages: DataFrame, path: str, checkpoint: str | None = None,
                       trigger: str | None = "1 second", available_now: bool = False,
                       compact_every: int | None = 600) -> StreamingQuery:
    """T3 written through ``foreachBatch`` into the current store."""
    checkpoint = claim_checkpoint(messages.sparkSession, path, checkpoint, "latest")

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert_current(batch, batch_id, path)
        _maybe_compact(batch.sparkSession, path, batch_id, compact_every)

    w = (latest_state_stream(messages).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger, available_now).start()


def mean_last_24h(decoded: DataFrame, watermark: str = "1 hour", key: str = "city_and_loc",
                  ts: str = "timestamp", value: str = "temperature", chained: bool = False) -> DataFrame:
    """T4: mean per station over 24 h windows sliding by 1 h (event time).

    Rows later than the watermark are dropped; in append mode a window is
    emitted once the watermark passes its end. ``chained`` first reduces the
    readings to one row per station and hour and slides over those, so a raw row
    is not spread over 24 windows; two stateful steps run in append mode only.
    """
    t = F.col(ts).cast("timestamp")
    timed = decoded.withColumn(ts, t).withWatermark(ts, watermark)
    v = F.col(value).cast("double")
    if chained:
        hourly = (timed.groupBy(F.window(ts, "1 hour").alias("hour"), key)
                  .agg(F.sum(v).alias("_s"), F.count(F.lit(1)).alias("_n")))
        wide = (hourly.groupBy(F.window("hour", "24 hours", "1 hour"), key)
                .agg(F.sum("_s").alias("_s"), F.sum("_n").alias("n")).withColumn("avg_temp", F.col("_s") / F.col("n")))
    else:
        wide = (timed.groupBy(F.window(ts, "24 hours", "1 hour"), key)
                .agg(F.avg(v).alias("avg_temp"), F.count(F.lit(1)).alias("n")))
    return wide.select(key, F.unix_seconds(F.col("window.start")).alias("window_start"), "avg_temp", "n")


def mean_last_24h_batch(decoded: DataFrame, key: str = "city_and_loc", ts: str = "timestamp",
                        value: str = "temperature") -> DataFrame:
    """T4 batch twin: the same windows from hourly partial sums.

    Readings are first reduced to one row per station and hour (partial
    aggregate), and only those hourly rows are spread over the 24 windows
    that contain them, so the raw rows are never multiplied.
    """
    hour = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 3600)
    hourly = (decoded.groupBy(key, hour.alias("_h"))
              .agg(F.sum(F.col(value).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n")))
    spread = (hourly.select(key, "_h", "_s", "_n", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_k"))
              .withColumn("_w", F.col("_h") - F.col("_k")))
    return (spread.groupBy(key, "_w").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("n"))
            .select(key, (F.col("_w") * 3600).cast("long").alias("window_start"),
                    (F.col("_s") / F.col("n")).alias("avg_temp"), "n"))


def start_map_refresh(messages: DataFrame, path: str, build_map, out_path: str, checkpoint: str | None = None,
                      trigger: str | None = "10 seconds", available_now: bool = False,
                      compact_every: int | None = 600) -> StreamingQuery:
    """T5: ingest as T1 (quarantine and folding included), then after each batch
    that brought rows rebuild the map.

    ``build_map(spark, current_path)`` returns the map DataFrame (for example
    ``plans.refresh.map_from_store``); it is written to ``out_path``.
    """
    checkpoint = claim_checkpoint(messages.sparkSession, path, checkpoint, "refresh")
    from thermogrid.sources.files import write_heatmap_cells

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            some = batch.limit(1).count() > 0
            _ingest(batch, batch_id, path, compact_every)
            if some:
                write_heatmap_cells(build_map(batch.sparkSession, path), out_path)
        finally:
            batch.unpersist()

    w = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger, available_now).start()


def start_incremental_refresh(messages: DataFrame, path: str, state: str, checkpoint: str | None = None,
                              trigger: str | None = "10 seconds", available_now: bool = False, scale: float = 5.0,
                              sigma: float = 20.0, compact_every: int | None = 600, on_refresh=None) -> StreamingQuery:
    """T5 by differences: ingest as T1, then after each batch that brought rows bring the map state at ``state`` to
    the store, searching and blurring only what the batch changed. A batch that is replayed after a failure finds
    the same store and gives the same state. ``on_refresh`` is called with what each refresh did."""
    checkpoint = claim_checkpoint(messages.sparkSession, path, checkpoint, "incremental")
    from thermogrid.plans.refresh import refresh_from_store

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            some = batch.limit(1).count() > 0
            _ingest(batch, batch_id, path, compact_every)
            if some:
                done = refresh_from_store(batch.sparkSession, path, state, scale, sigma)
                if on_refresh:
                    on_refresh(done)
        finally:
            batch.unpersist()

    w = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger, available_now).start()


def _message_files(spark: SparkSession, messages: DataFrame, path: str, records_per_file: int | None):
    """Messages written as files, and the stream that reads them."""
    from thermogrid.sources.messages import MESSAGE_SCHEMA
    m = messages.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                        "topic", F.col("partition").cast("int").alias("partition"),
                        F.col("offset").cast("long").alias("offset"),
                        F.col("timestamp").cast("timestamp").alias("timestamp"))
    w = m.write.mode("overwrite")
    (w.option("maxRecordsPerFile", records_per_file) if records_per_file else w).parquet(path)
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    return (r.option("maxFilesPerTrigger", 1) if records_per_file else r).parquet(path)


def _finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_latest_stream_once(spark: SparkSession, messages: DataFrame, records_per_file: int | None = None) -> DataFrame:
    """Drive T3 end to end over ``messages`` (a batch DataFrame): write it below
    the checkpoint root as the scan's own partitions, stream the files with
    ``availableNow`` through the stateful aggregate into a store, and return the
    store's latest view. ``records_per_file`` cuts the files further and takes
    one micro-batch per file."""
    from thermogrid.sources.current_store import read_current

    base = scratch_path(spark, "stream-latest")
    stream = _message_files(spark, messages, f"{base}/in", records_per_file)
    _finish(start_latest_state(stream, f"{base}/store", available_now=True))
    return read_current(spark, f"{base}/store")


def run_windows_stream_once(spark: SparkSession, messages: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drive T4 end to end: messages as files through the windowed stream in
    append mode; the windows that the watermark has closed are the result."""
    base = scratch_path(spark, "stream-windows")
    stream = _message_files(spark, messages, f"{base}/in", None)
    q = (mean_last_24h(decode_reading(stream), watermark=watermark, chained=True).writeStream.outputMode("append")
         .format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    _finish(q)
    return spark.read.schema("city_and_loc string, window_start long, avg_temp double, n long").parquet(f"{base}/out")
