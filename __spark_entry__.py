"""

Every query reads the driver's test tables (or what Spark derives from them)
and runs over the whole of them. Most grid queries use scale 1 (180 x 360
cells) and sigma 2; ``nearest_full`` and ``reference_full`` are the reference's
900 x 1800 cells and ``blur_sigma20`` its sigma, all brute-forced in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import testbed as tb
from fixtures import oracle as O
from fixtures.oracle import with_fixtures as W, r6
from thermogrid.operators import climatology as cl
from thermogrid.operators import grid as gr
from thermogrid.operators import readings as rd
from thermogrid.operators import scattered as sc
from thermogrid.plans import anomaly as an

# Oracle settings (FIXTURES.md section 3): day 14, scale 1 (180 x 360) grids,
# sigma 2 for the blur, a 90 x 180 grid for the blur alone.
ORACLE_DAY = 14
SCALE = 1.0
BLUR_SCALE = 0.5
SIGMA = 2.0
FULL_SCALE = 5.0   # the reference's grid: 900 x 1800 cells, sigma 20
FULL_SIGMA = 20.0
TILE = 8


def _r6(c):
    """round6 on the Spark side (only in these checks, never in the operators)."""
    return F.round(F.col(c) + F.lit(0.00000013), 6).alias(c)


def _current(spark, sf):
    good = rd.decode_reading(tb.messages(spark, sf))
    return rd.latest_by_key(good)


# ---------------------------------------------------------------- readings

def q_readings_messages(spark, sf):
    r = tb.readings(spark, sf)
    return rd.encode_reading(r, as_bytes=True).select(
        "event_id", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def q_parse_weather(spark, sf):
    return rd.parse_weather(tb.weather_json(spark, sf))


def q_hour_of_day(spark, sf):
    w = rd.parse_weather(tb.weather_json(spark, sf))
    return w.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))


def q_decode_reading(spark, sf):
    good = rd.decode_reading(tb.bad_messages(spark, sf))
    return good.select("offset", "city_and_loc", "time", "temperature")


def q_bad_readings(spark, sf):
    _, bad = rd.quarantine_bad(tb.bad_messages(spark, sf))
    return bad.select("offset", "key", "value", "reason")


def q_latest_by_key(spark, sf):
    return rd.latest_by_key(rd.decode_reading(tb.messages(spark, sf)), packed=True)


def _through_store(spark, batches):
    """Micro-batches into a fresh store, folded once on the way, read back."""
    from thermogrid.session import scratch_path
    from thermogrid.sources import current_store as cs
    path = scratch_path(spark, "store")
    for i, batch in enumerate(batches):
        cs.upsert_current(batch, i, path)
        if i == 1:
            cs.compact_current(spark, path)
    return cs.read_current(spark, path)


def q_current_table(spark, sf):
    # a dirty feed (bad rows set aside) in three batches by offset: store, fold, read back
    good = rd.decode_reading(tb.bad_messages(spark, sf))
    top = good.agg(F.max("offset")).first()[0] or 0
    cut = [0, top // 3, 2 * top // 3, top + 1]
    return _through_store(spark, [good.where((F.col("offset") >= lo) & (F.col("offset") < hi))
                                  for lo, hi in zip(cut, cut[1:])])


def q_upsert_latest(spark, sf):
    # one batch per third of the month (by day), each overwriting what came before
    good = rd.decode_reading(tb.messages(spark, sf))
    day = F.dayofmonth("timestamp")
    return _through_store(spark, [good.where(day <= 10), good.where((day > 10) & (day <= 20)), good.where(day > 20)])


def q_city_temperature(spark, sf):
    return rd.city_temperature(_current(spark, sf))


def q_mean_by_city(spark, sf):
    return rd.mean_by_city(_current(spark, sf)).select("city_and_loc", _r6("avg_temp"))


def q_unpack_city(spark, sf):
    return rd.unpack_city(rd.mean_by_city(_current(spark, sf))).select("city_and_loc", "name", "lon", "lat")


def _means(spark, sf):
    return rd.mean_by_city(_current(spark, sf))


def _points(spark, sf, scale):
    return an.station_points(_means(spark, sf), scale)


def _near(spark, sf, scale):
    rows, cols = gr.grid_shape(scale)
    return gr.nearest_points(_points(spark, sf, scale), rows, cols, TILE)


# ---------------------------------------------------------------- grid

def q_to_grid(spark, sf):
    return _points(spark, sf, 5.0).select("pid", _r6("x"), _r6("y"))


def q_point_stats(spark, sf):
    st = rd.point_stats(_points(spark, sf, 5.0))
    return st.select("n_points", *[_r6(c) for c in st.columns if c != "n_points"])


def q_nearest_grid(spark, sf):
    return _near(spark, sf, SCALE).select("r", "c", "pid", _r6("v"), _r6("d2"))


def q_flip_rows(spark, sf):
    rows, _ = gr.grid_shape(SCALE)
    return gr.flip_rows(_near(spark, sf, SCALE), rows).select("r", "c", _r6("v"))


def q_gaussian_blur(spark, sf):
    rows, cols = gr.grid_shape(BLUR_SCALE)
    g = gr.gaussian_blur(_near(spark, sf, BLUR_SCALE), rows, cols, SIGMA)
    return g.select("r", "c", _r6("v"))


def q_land_masked(spark, sf):
    m = gr.apply_land_mask(_near(spark, sf, SCALE).select("r", "c", "v"), tb.land_mask(spark, SCALE))
    return m.select("r", "c", _r6("v"))


def q_current_model(spark, sf):
    cur = an.current_model(_means(spark, sf), tb.land_mask(spark, SCALE), SCALE, SIGMA, TILE)
    return cur.select("r", "c", _r6("v"))


def q_reference_grid(spark, sf):
    clim = cl.climatology_for_day(tb.climatology(spark, sf), ORACLE_DAY)
    out = cl.upsample_reference(clim, tb.land_mask(spark, SCALE), SCALE)
    return out.select("r", "c", _r6("v"), "taps")


def q_reference_model(spark, sf):
    ref = an.reference_model(tb.climatology(spark, sf), tb.land_mask(spark, SCALE), ORACLE_DAY, SCALE)
    return ref.select("r", "c", _r6("v"), "taps")


def q_grid_difference(spark, sf):
    mask = tb.land_mask(spark, SCALE)
    cur = an.current_model(_means(spark, sf), mask, SCALE, SIGMA, TILE)
    ref = an.reference_model(tb.climatology(spark, sf), mask, ORACLE_DAY, SCALE)
    d = gr.grid_difference(cur, ref)
    return d.select("r", "c", _r6("cur"), _r6("ref"), _r6("diff"))


def q_anomaly_map(spark, sf):
    m = an.anomaly_map(_means(spark, sf), tb.climatology(spark, sf), tb.land_mask(spark, SCALE),
                       ORACLE_DAY, SCALE, SIGMA, TILE)
    return m.select("r", "c", _r6("cur"), _r6("ref"), _r6("diff"), _r6("clipped"), "level")


def q_heatmap_cells(spark, sf):
    # the sink (S12): written, replaced once, read back
    from thermogrid.session import scratch_path
    from thermogrid.sources.files import write_heatmap_cells
    m = an.anomaly_map(_means(spark, sf), tb.climatology(spark, sf), tb.land_mask(spark, SCALE),
                       ORACLE_DAY, SCALE, SIGMA, TILE)
    path = scratch_path(spark, "heatmap")
    write_heatmap_cells(m.where("r < 10"), path)
    write_heatmap_cells(m, path)
    return spark.read.parquet(path).select("r", "c", _r6("diff"), _r6("clipped"), "level")


def q_map_tiles(spark, sf):
    # the map as PNG tiles, written and read back: the pixels of the deepest level (where a
    # tile has transparent pixels, levels 0 and 1 share an index)
    from thermogrid.session import scratch_path
    from thermogrid.sources import raster
    rows, cols = gr.grid_shape(SCALE)
    path = scratch_path(spark, "map-tiles")
    raster.write_map_tiles(q_anomaly_map(spark, sf), path, rows, cols, tile=64)
    deepest = raster.read_pointer(path)["levels"] - 1
    px = raster.read_map_tiles(spark, path).where(F.col("z") == deepest)
    return px.select("r", "c", F.greatest("level", F.lit(1)).alias("level"))


def q_refresh_job(spark, sf):
    # messages -> store -> map for a moment of the oracle's day -> cell table
    import datetime

    from thermogrid.plans.refresh import refresh_map
    from thermogrid.session import scratch_path
    from thermogrid.sources import current_store as cs
    base = scratch_path(spark, "refresh")
    cs.upsert_current(rd.decode_reading(tb.messages(spark, sf)), 0, f"{base}/store")
    ts = datetime.datetime(2024, 1, 1 + ORACLE_DAY, 13, 30, tzinfo=datetime.timezone.utc)
    refresh_map(spark, f"{base}/store", tb.climatology(spark, sf), tb.land_mask(spark, SCALE), f"{base}/map", ts,
                SCALE, sigma=SIGMA, tile=TILE)
    return spark.read.parquet(f"{base}/map").select("r", "c", _r6("diff"), _r6("clipped"), "level")


def _clustered(spark, sf):
    """Every event a point of one square of about 6 x 6 cells, by formula."""
    return tb.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("pid"),
        (F.lit(70.0) + F.pmod(F.col("event_id") * 7919, F.lit(601)) / 100.0).alias("x"),
        (F.lit(30.0) + F.pmod(F.col("event_id") * 104729, F.lit(577)) / 100.0).alias("y"),
        (F.col("value") - 50).alias("v"))


def q_nearest_clustered(spark, sf):
    rows, cols = gr.grid_shape(BLUR_SCALE)
    return gr.nearest_points(_clustered(spark, sf), rows, cols, TILE).select("r", "c", "pid", _r6("v"), _r6("d2"))


def q_nearest_full(spark, sf):
    return _near(spark, sf, FULL_SCALE).select("r", "c", "pid", _r6("v"), _r6("d2"))


def q_reference_full(spark, sf):
    ref = an.reference_model(tb.climatology(spark, sf), tb.land_mask(spark, FULL_SCALE), ORACLE_DAY, FULL_SCALE)
    return ref.select("r", "c", _r6("v"), "taps")


def q_blur_sigma20(spark, sf):
    rows, cols = gr.grid_shape(BLUR_SCALE)
    return gr.gaussian_blur(_near(spark, sf, BLUR_SCALE), rows, cols, FULL_SIGMA).select("r", "c", _r6("v"))


def q_blur_full_grid(spark, sf):
    # the reference's own job: 900 x 1800 cells, sigma 20
    rows, cols = gr.grid_shape(FULL_SCALE)
    return gr.gaussian_blur(_near(spark, sf, FULL_SCALE), rows, cols, FULL_SIGMA).select("r", "c", _r6("v"))


def q_interpolate_scattered(spark, sf):
    rows, cols = gr.grid_shape(SCALE)
    return sc.interpolate_scattered(tb.scattered(spark, sf), rows, cols).select("r", "c", _r6("v"))


def q_nearest_sphere(spark, sf):
    from thermogrid.operators.sphere import nearest_on_sphere
    rows, cols = gr.grid_shape(SCALE)
    at = rd.unpack_city(_means(spark, sf)).select(F.col("city_and_loc").alias("pid"), "lon", "lat", F.col("avg_temp").alias("v"))
    return nearest_on_sphere(at, rows, cols).select("r", "c", "pid", _r6("v"), F.round(F.col("d2") + 0.0000000001303, 9).alias("d2"))


def q_anomaly_empty(spark, sf):
    # the map as of a moment before the first reading: no station, so the
    # current model is all zeros and unmasked
    m = tb.messages(spark, sf).where(F.col("timestamp") < F.lit("2024-01-01 00:00:00").cast("timestamp"))
    means = rd.mean_by_city(rd.latest_by_key(rd.decode_reading(m)))
    out = an.anomaly_map(means, tb.climatology(spark, sf), tb.land_mask(spark, SCALE), ORACLE_DAY, SCALE,
                         SIGMA, TILE)
    return out.select("r", "c", _r6("cur"), _r6("ref"), _r6("diff"))


def q_reference_days(spark, sf):
    out = an.reference_models(tb.climatology(spark, sf), tb.land_mask(spark, BLUR_SCALE), None, BLUR_SCALE)
    return out.select("day_number", "r", "c", _r6("v"), "taps")


def q_reference_stored(spark, sf):
    # the grids of all days written once, one day read back
    from thermogrid.session import scratch_path
    path = scratch_path(spark, "reference-days")
    an.write_reference_models(an.reference_models(tb.climatology(spark, sf), tb.land_mask(spark, SCALE), None, SCALE), path)
    return an.read_reference_model(spark, path, ORACLE_DAY).select("r", "c", _r6("v"), "taps")


def q_station_anomaly(spark, sf):
    from thermogrid.operators import stations as stn
    ref = tb.climatology(spark, sf)
    st = rd.unpack_city(_means(spark, sf)).select("city_and_loc", "lon", "lat", "avg_temp")
    # each station once more on the grid's last column, southern ones at the pole
    edge = st.select(F.concat(F.lit("edge"), "city_and_loc").alias("city_and_loc"), F.lit(180.0).alias("lon"),
                     F.when(F.col("lat") < 0, F.lit(-90.0)).otherwise(F.col("lat")).alias("lat"), "avg_temp")
    out = stn.station_anomaly(st.unionByName(edge), ref, tb.land_mask(spark, SCALE), ORACLE_DAY, SCALE)
    return out.select("city_and_loc", "r", "c", _r6("avg_temp"), _r6("ref"), _r6("anomaly"))


# ---------------------------------------------------------------- climatology

def q_day_index(spark, sf):
    from thermogrid.functions.columns import day_index
    return tb.readings(spark, sf).select("event_id", day_index("ts").alias("day_number"))


def q_climatology_scan(spark, sf):
    # written by day and read back (S6, S7); missing values are not stored
    from thermogrid.session import scratch_path
    from thermogrid.sources import files as fs
    path = scratch_path(spark, "climatology")
    fs.write_climatology(tb.climatology(spark, sf), path)
    return fs.read_climatology(spark, path)


def _text(df, path, column):
    """One file, in the order of ``seq``: what a list in a file is."""
    df.orderBy("seq").select(column).coalesce(1).write.text(path)


def q_id_list(spark, sf):
    from thermogrid.session import scratch_path
    from thermogrid.sources import files as fs
    path = scratch_path(spark, "ids")
    reg = tb.registry(spark, sf)
    _text(reg.select("seq", (F.col("id") * 3).cast("string").alias("t")), path, "t")
    return fs.read_id_list(spark, path)


def q_city_registry(spark, sf):
    from thermogrid.session import scratch_path
    from thermogrid.sources import files as fs
    path = scratch_path(spark, "registry")
    reg = tb.registry(spark, sf)
    _text(reg.select("seq", F.concat_ws(":", *[F.col(c).cast("string") for c in ("id", "lon", "lat")]).alias("t")), path, "t")
    return fs.read_city_registry(spark, path)


def q_readings_written(spark, sf):
    # messages through the file sink (S2) and back as stored bytes
    from thermogrid.session import scratch_path
    from thermogrid.sources.messages import write_readings
    path = scratch_path(spark, "messages")
    write_readings(tb.messages(spark, sf, as_bytes=True), "parquet", path)
    back = spark.read.parquet(path)
    return back.select("offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic")


def q_climatology_clean(spark, sf):
    return cl.drop_missing(tb.climatology(spark, sf))


def q_climatology_day(spark, sf):
    return cl.climatology_for_day(tb.climatology(spark, sf), ORACLE_DAY)


def q_day_check(spark, sf):
    clim = cl.require_day(tb.climatology(spark, sf), ORACLE_DAY)
    return cl.distinct_days(clim)


def q_unpivot_grid(spark, sf):
    return cl.unpivot_grid(cl.to_lines(tb.climatology(spark, sf)))


# ---------------------------------------------------------------- stations

NUM_EVEN = 500
NUM_FILL = 1000
PICK_SEED = 7
RANDOM_N = 100
WORKERS = 7
KEYS = 3


def _stn():
    from thermogrid.operators import stations as stn
    return stn


def q_coord_bucket(spark, sf):
    return _stn().coord_bucket(tb.registry(spark, sf)).select("seq", "id", "lat_b", "lon_b")


def q_ids_by_bucket(spark, sf):
    return _stn().ids_by_bucket(tb.registry(spark, sf))


def q_bucket_lookup(spark, sf):
    st = _stn()
    req = st.coord_bucket(rd.unpack_city(_means(spark, sf))).select("city_and_loc", "lat_b", "lon_b")
    return st.bucket_lookup(req, tb.registry(spark, sf)).select("city_and_loc", "lat_b", "lon_b", "id", "seq")


def q_even_pick(spark, sf):
    return _stn().even_pick(tb.registry(spark, sf), NUM_EVEN)


def q_fill_pick(spark, sf):
    return _stn().pick_ids(tb.registry(spark, sf), NUM_FILL, PICK_SEED)


def q_random_pick(spark, sf):
    return _stn().random_pick(tb.registry(spark, sf), RANDOM_N, PICK_SEED)


def q_assign_chunks(spark, sf):
    return _stn().assign_chunks(tb.registry(spark, sf), WORKERS).select("seq", "id", "rn", "worker")


def q_assign_round_robin(spark, sf):
    return _stn().assign_round_robin(tb.registry(spark, sf), KEYS).select("seq", "id", "rn", "worker")


def _city_cache(spark, sf):
    """A cache file derived from the stations (S11): every third city, shifted."""
    from thermogrid.session import scratch_path
    from thermogrid.sources import files as fs
    st = rd.unpack_city(_means(spark, sf)).where(F.pmod(F.substring("name", 2, 9).cast("long"), F.lit(3)) == 0)
    one = st.groupBy().agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct("name", F.array(-F.col("lon"), -F.col("lat")))))).alias("t"))
    path = scratch_path(spark, "city-cache")
    one.write.text(path)
    return fs.read_city_cache(spark, path)


def q_city_cache(spark, sf):
    return _city_cache(spark, sf)


def _some_cities(spark, sf):
    """Stations, every second one without its own coordinates."""
    own = F.pmod(F.substring("name", 2, 9).cast("long"), F.lit(2)) == 0
    return rd.unpack_city(_means(spark, sf)).select(
        "name", F.when(own, F.col("lon")).alias("lon"), F.when(own, F.col("lat")).alias("lat"))


def q_geocode(spark, sf):
    return _stn().geocode(_some_cities(spark, sf), _city_cache(spark, sf), prefer="cache").select("name", "lon", "lat", "src")


def q_geocode_key(spark, sf):
    return _stn().geocode(_some_cities(spark, sf), _city_cache(spark, sf), prefer="key").select("name", "lon", "lat", "src")


def q_bucket_take(spark, sf):
    # every event asks its station's bucket, in order of event_id
    st = _stn()
    req = st.coord_bucket(tb.readings(spark, sf)).select("event_id", "lat_b", "lon_b")
    return st.bucket_take(req, tb.registry(spark, sf), "event_id").select("event_id", "lat_b", "lon_b", "turn", "id")


# ---------------------------------------------------------------- call log

def _cl():
    from thermogrid.operators import calllog as c
    return c


def q_ok_responses(spark, sf):
    return _cl().successful_responses(tb.call_log(spark, sf)).select(
        "event_id", "client", "request_id", "attempt", "status")


def q_calls_per_minute(spark, sf):
    return _cl().calls_per_minute(tb.call_log(spark, sf))


def q_failure_counts(spark, sf):
    return _cl().failure_counts(tb.call_log(spark, sf))


def q_quota_admission(spark, sf):
    return _cl().quota_admission(tb.call_log(spark, sf), cap=60).select(
        "event_id", "client", "minute", "rank", "admitted_minute", "delay_min")


def q_first_success(spark, sf):
    return _cl().first_success(tb.call_log(spark, sf), 3)


def q_quota_pooled(spark, sf):
    return _cl().pooled_quota(tb.call_log(spark, sf), KEYS, 60).select(
        "event_id", "minute", "rank", "admitted_minute", "delay_min")


def q_gave_up(spark, sf):
    return _cl().gave_up(tb.call_log(spark, sf), 2)  # with three tries the log has none


def q_failures_running(spark, sf):
    return _cl().running_failures(tb.call_log(spark, sf)).select("event_id", "client", "failures")


# ---------------------------------------------------------------- streaming twins

def q_stream_ring(spark, sf):
    # the stream whose slots expire, run to completion: the live slots of its store
    from thermogrid.streaming.ring import run_ring_stream_once
    return run_ring_stream_once(spark, tb.messages(spark, sf))


def q_stream_ring_state(spark, sf):
    # the same slots read from the state store of the stopped stream
    from thermogrid.streaming.ring import run_ring_stream_once
    return run_ring_stream_once(spark, tb.messages(spark, sf), state=True).select("city_and_loc", "time", "us", "partition", "offset", "temperature")


def q_ring_batch(spark, sf):
    from thermogrid.streaming.ring import ring_batch
    return ring_batch(rd.decode_reading(tb.messages(spark, sf)))


def q_incremental_refresh(spark, sf):
    # the state after three refreshes, two of them by differences
    from thermogrid.plans import incremental as inc
    from thermogrid.session import scratch_path
    rows, cols = gr.grid_shape(SCALE)
    state, m = scratch_path(spark, "map-state"), tb.messages(spark, sf)
    for end in ("2024-01-15", "2024-01-28", "2100-01-01"):
        part = m.where(F.col("timestamp") < F.lit(end).cast("timestamp"))
        means = rd.mean_by_city(rd.latest_by_key(rd.decode_reading(part)))
        inc.refresh_state(an.station_points(means, SCALE), state, rows, cols, SIGMA)
    return inc.read_map_state(spark, state).select("r", "c", "pid", _r6("v"), _r6("d2"), _r6("s"))


def q_stream_station_anomaly(spark, sf):
    # every reading of a stream against its own day's reference grid, run to completion
    from thermogrid.session import scratch_path
    from thermogrid.streaming.anomaly import run_reading_anomaly_once
    path = scratch_path(spark, "reference-days")
    an.write_reference_models(an.reference_models(tb.climatology(spark, sf), tb.land_mask(spark, BLUR_SCALE), None, BLUR_SCALE), path)
    refs = spark.read.schema("r int, c int, v double, taps int, day_number int").parquet(path)
    out = run_reading_anomaly_once(spark, tb.messages(spark, sf), refs, BLUR_SCALE)
    return out.select("offset", "city_and_loc", "time", "day_number", "r", "c", _r6("ref"), _r6("anomaly"))


def q_mean_last_24h(spark, sf):
    from thermogrid.streaming.ingest import mean_last_24h_batch
    good = rd.decode_reading(tb.messages(spark, sf))
    return mean_last_24h_batch(good).select("city_and_loc", "window_start", _r6("avg_temp"), "n")


def q_stream_windows(spark, sf):
    # the windowed stream (T4) run to completion: the windows its watermark closed
    from thermogrid.streaming.ingest import run_windows_stream_once
    out = run_windows_stream_once(spark, tb.messages(spark, sf))
    return out.select("city_and_loc", "window_start", _r6("avg_temp"), "n")


def q_stream_latest(spark, sf):
    # the stateful stream (T3) run to completion over the messages, read back
    from thermogrid.streaming.ingest import run_latest_stream_once
    return run_latest_stream_once(spark, tb.messages(spark, sf))


ORACLE: dict[str, str] = {}

ORACLE["readings_messages"] = W("""
    select event_id, concat_ws(':', name, cast(lon as varchar), cast(lat as varchar), cast(hour as varchar)) as key,
           cast(temp as varchar) as value from readings""", "readings")

ORACLE["parse_weather"] = W("""
    select event_id, body->>'$.name' as name, cast(body->'$.coord.lon' as double) as lon,
           cast(body->'$.coord.lat' as double) as lat, cast(body->'$.main.temp' as double) as temp,
           cast(body->'$.dt' as bigint) as dt, cast((cast(body->'$.dt' as bigint) % 86400) // 3600 as integer) as hour
    from weather_json""", "weather_json")

ORACLE["hour_of_day"] = W("""
    select cast((cast(body->'$.dt' as bigint) % 86400) // 3600 as integer) as hour, count(*) as n
    from weather_json group by 1""", "weather_json")

_BAD_PARSE = """
    select "offset", key, value, city_and_loc, "time", try_cast(temp as float) as temperature,
           case when not (parts and lon is not null and lat is not null) then 'key'
                when not (lon between -180 and 180 and lat between -90 and 90) then 'coord'
                when "time" is null or "time" not between 0 and 23 then 'hour'
                when temp is null or not coalesce(isfinite(try_cast(temp as float)), false) then 'value' end as reason
    from (select "offset", key, value, coalesce(regexp_full_match(key, '^(.*):([^:]*):([^:]*):([^:]*)$'), false) as parts,
                 try_cast(regexp_extract(key, '^(.*):([^:]*):([^:]*):([^:]*)$', 2) as double) as lon,
                 try_cast(regexp_extract(key, '^(.*):([^:]*):([^:]*):([^:]*)$', 3) as double) as lat,
                 try_cast(regexp_extract(key, '^(.*):([^:]*):([^:]*):([^:]*)$', 4) as integer) as "time",
                 try_cast(value as double) as temp,
                 regexp_extract(key, '^(.*):([^:]*)$', 1) as city_and_loc
          from bad_messages)"""

ORACLE["decode_reading"] = W("""
    select "offset", city_and_loc, "time", temperature from bp where reason is null""",
                             "bad_messages", extra={"bp": _BAD_PARSE})

ORACLE["bad_readings"] = W("""
    select "offset", key, value, reason from bp where reason is not null""",
                           "bad_messages", extra={"bp": _BAD_PARSE})

ORACLE["latest_by_key"] = W("select * from current", "current")

ORACLE["current_table"] = W("""
    select city_and_loc, "time", arg_max(temperature, "offset") as temperature
    from bp where reason is null group by city_and_loc, "time\"""", "bad_messages", extra={"bp": _BAD_PARSE})

ORACLE["upsert_latest"] = W("""
    select city_and_loc, "time",
           arg_max(temperature, (case when day("timestamp") <= 10 then 0 when day("timestamp") <= 20 then 1 else 2 end,
                                 "timestamp", "partition", "offset")) as temperature
    from parsed group by city_and_loc, "time\"""", "parsed")

ORACLE["city_temperature"] = W("select city_and_loc, temperature from current", "current")

ORACLE["mean_by_city"] = W(f"select city_and_loc, {r6('avg_temp')} as avg_temp from city_means", "city_means")

ORACLE["unpack_city"] = W("select city_and_loc, name, lon, lat from stations", "stations")


_PTS5 = {"pts": O.points_sql(5.0)}
_PTS1 = {"pts": O.points_sql(SCALE)}
_NEAR1 = {**_PTS1, "near": O.nearest_sql(SCALE)}
_MASK1 = {"mask": O.mask_sql(SCALE)}
_CUR1 = {**_NEAR1, **_MASK1, **O.blur_ctes("near", SCALE, SIGMA, "cb"),
         "cur": "select m.r, m.c, case when m.land then b.v end as v from mask m left join cb_out b using (r, c)"}
_REF1 = {**_MASK1, "landcells": "select r, c from mask where land",
         **O.reference_ctes(SCALE, ORACLE_DAY, "landcells"),
         "ref": "select m.r, m.c, o.val as v, coalesce(o.taps, 0) as taps from mask m left join rf_out o using (r, c)"}
_GRID = ("stations", "climatology")

ORACLE["to_grid"] = W(f"select pid, {r6('x')} as x, {r6('y')} as y from pts", "stations", extra=_PTS5)
ORACLE["point_stats"] = W(f"""
    select count(*) as n_points, {r6('min(x)')} as min_x, {r6('max(x)')} as max_x, {r6('min(y)')} as min_y,
           {r6('max(y)')} as max_y, {r6('min(v)')} as min_v, {r6('max(v)')} as max_v from pts""",
                          "stations", extra=_PTS5)
ORACLE["nearest_grid"] = W(f"select r, c, pid, {r6('v')} as v, {r6('d2')} as d2 from near", "stations",
                           extra=_NEAR1)
ORACLE["flip_rows"] = W(f"select cast({int(180 * SCALE) - 1} - r as integer) as r, c, {r6('v')} as v from near",
                        "stations", extra=_NEAR1)
ORACLE["gaussian_blur"] = W(f"select r, c, {r6('v')} as v from bb_out", "stations",
                            extra={"pts": O.points_sql(BLUR_SCALE), "near": O.nearest_sql(BLUR_SCALE),
                                   **O.blur_ctes("near", BLUR_SCALE, SIGMA, "bb")})
ORACLE["land_masked"] = W(f"""
    select n.r, n.c, {r6('case when m.land then n.v end')} as v from near n left join mask m using (r, c)""",
                          "stations", extra={**_NEAR1, **_MASK1})
ORACLE["current_model"] = W(f"select r, c, {r6('v')} as v from cur", "stations", extra=_CUR1)
ORACLE["reference_grid"] = W(f"select r, c, {r6('val')} as v, taps from rf_out", *_GRID, extra=_REF1)
ORACLE["reference_model"] = W(f"select r, c, {r6('v')} as v, taps from ref", *_GRID, extra=_REF1)
ORACLE["grid_difference"] = W(f"""
    select a.r, a.c, {r6('a.v')} as cur, {r6('b.v')} as ref, {r6('a.v - b.v')} as diff
    from cur a left join ref b using (r, c)""", *_GRID, extra={**_CUR1, **_REF1})
_MAP = f"""
    select a.r, a.c, a.v as cur, b.v as ref, a.v - b.v as diff,
           case when a.v - b.v is not null then least(greatest(a.v - b.v, -10.0), 10.0) end as clipped,
           case when a.v - b.v is not null then
             cast(least(255, floor((least(greatest(a.v - b.v, -10.0), 10.0) + 10.0) / 20.0 * 256.0)) as integer) end as level
    from cur a left join ref b using (r, c)"""
ORACLE["anomaly_map"] = W(f"""
    select r, c, {r6('cur')} as cur, {r6('ref')} as ref, {r6('diff')} as diff, {r6('clipped')} as clipped, level
    from amap""", *_GRID, extra={**_CUR1, **_REF1, "amap": _MAP})
ORACLE["heatmap_cells"] = W(f"""
    select r, c, {r6('diff')} as diff, {r6('clipped')} as clipped, level from amap""",
                            *_GRID, extra={**_CUR1, **_REF1, "amap": _MAP})
ORACLE["map_tiles"] = W("select r, c, greatest(level, 1)::int as level from amap where level is not null",
                        *_GRID, extra={**_CUR1, **_REF1, "amap": _MAP})
ORACLE["anomaly_empty"] = W(f"""
    select m.r, m.c, {r6('0.0::double')} as cur, {r6('b.v')} as ref, {r6('0.0::double - b.v')} as diff
    from mask m left join ref b using (r, c)""", *_GRID, extra=_REF1)
_REF0 = {"mask": O.mask_sql(BLUR_SCALE), "landcells": "select d.day_number, m.r, m.c from mask m cross join event_days d where m.land",
         **O.reference_ctes(BLUR_SCALE, None, "landcells")}
ORACLE["reference_days"] = W(f"""
    select d.day_number, m.r, m.c, {r6('o.val')} as v, coalesce(o.taps, 0) as taps
    from mask m cross join event_days d left join rf_out o using (day_number, r, c)""", *_GRID, extra=_REF0)
ORACLE["reference_stored"] = ORACLE["reference_model"]
ORACLE["refresh_job"] = ORACLE["heatmap_cells"]
ORACLE["nearest_clustered"] = W(f"select r, c, pid, {r6('v')} as v, {r6('d2')} as d2 from near", extra={
    "pts": """select pid, x, y, v from (
        select event_id::varchar as pid, 70.0::double + ((event_id * 7919) % 601) / 100.0::double as x,
               30.0::double + ((event_id * 104729) % 577) / 100.0::double as y, value - 50 as v from events)""",
    "near": O.nearest_sql(BLUR_SCALE)})
ORACLE["nearest_full"] = W(f"select r, c, pid, {r6('v')} as v, {r6('d2')} as d2 from near", "stations",
                           extra={"pts": O.points_sql(FULL_SCALE), "near": O.nearest_sql(FULL_SCALE)})
ORACLE["reference_full"] = W(f"select r, c, {r6('v')} as v, taps from ref", *_GRID, extra={
    "mask": O.mask_sql(FULL_SCALE), "landcells": "select r, c from mask where land",
    **O.reference_ctes(FULL_SCALE, ORACLE_DAY, "landcells"),
    "ref": "select m.r, m.c, o.val as v, coalesce(o.taps, 0) as taps from mask m left join rf_out o using (r, c)"})
ORACLE["blur_sigma20"] = W(f"select r, c, {r6('v')} as v from bs_out", "stations",
                           extra={"pts": O.points_sql(BLUR_SCALE), "near": O.nearest_sql(BLUR_SCALE),
                                  **O.blur_ctes("near", BLUR_SCALE, FULL_SIGMA, "bs")})
ORACLE["blur_full_grid"] = W(f"select r, c, {r6('v')} as v from bf_out", "stations",
                             extra={"pts": O.points_sql(FULL_SCALE), "near": O.nearest_sql(FULL_SCALE),
                                    **O.blur_lines_ctes("near", FULL_SCALE, FULL_SIGMA, "bf")})
ORACLE["interpolate_scattered"] = W("select * from field", extra={
    "spots": """select c_custkey as id, 90.0::double - ((c_custkey * 104729) % 1800 - 900) / 10.0::double
                       + ((c_custkey * c_custkey * 31) % 1009) / 8072.0::double as x,
                       ((c_custkey * 7919) % 3600 - 1800) / 10.0::double + 180.0::double
                       + ((c_custkey * c_custkey * 17) % 1013) / 8104.0::double as y,
                       c_acctbal / 100.0::double as v from customer""",
    "field": O.scattered_sql("spots", *O.grid_dims(SCALE))})
ORACLE["nearest_sphere"] = W(f"select r, c, pid, {r6('v')} as v, round(d2 + 0.0000000001303, 9) as d2 from globe", "stations",
                             extra={"globe": O.nearest_sphere_sql(*O.grid_dims(SCALE))})
ORACLE["station_anomaly"] = W(f"""
    select s.city_and_loc, s.r, s.c, {r6('s.avg_temp')} as avg_temp, {r6('f.v')} as ref,
           {r6('s.avg_temp - f.v')} as anomaly
    from (select city_and_loc, avg_temp, cast(least({int(180 * SCALE) - 1}, floor({SCALE} * (90.0 - lat))) as integer) as r,
                 cast(least({int(360 * SCALE) - 1}, floor({SCALE} * (lon + 180.0))) as integer) as c from edge_stations) s
    left join ref f using (r, c)""", *_GRID, extra={**_REF1, "edge_stations": """
    select city_and_loc, lon, lat, avg_temp from stations union all
    select 'edge' || city_and_loc, 180.0, case when lat < 0 then -90.0 else lat end, avg_temp from stations"""})

ORACLE["day_index"] = W("select event_id, cast(dayofyear(ts) - 1 as integer) as day_number from readings",
                        "readings")
ORACLE["climatology_scan"] = W(
    "select * from climatology where climatology is not null and not isnan(climatology)", "climatology")
ORACLE["id_list"] = W("select row_number() over (order by seq) - 1 as seq, id * 3 as id from registry", "registry")
ORACLE["city_registry"] = W("""
    select row_number() over (order by seq) - 1 as seq, id::varchar as id, lon, lat from registry""", "registry")
ORACLE["readings_written"] = W('select "offset", key, value, topic from messages', "messages")
ORACLE["climatology_clean"] = W(
    "select * from climatology where climatology is not null and not isnan(climatology)", "climatology")
ORACLE["climatology_day"] = W(f"select * from climatology where day_number = {ORACLE_DAY}", "climatology")
ORACLE["day_check"] = W("select distinct day_number from climatology", "climatology")
ORACLE["unpivot_grid"] = W("select * from climatology", "climatology")

_BUCK = {"bk": """select seq, id, cast(trunc(lat) as integer) as lat_b, cast(trunc(lon) as integer) as lon_b
                   from registry"""}


def _even_sql(num_ids):
    per_lat = int(num_ids / 181) + 1
    inc = int(361 / per_lat)
    return f"""
        select 1 as phase, cast(lat_b as bigint) as ord1, cast(slot as bigint) as ord2,
               arg_min(id, (lon_b, -seq)) as id, arg_min(seq, (lon_b, -seq)) as seq, lat_b, min(lon_b) as lon_b
        from (select *, cast(floor((lon_b + 180) / {inc}) as integer) as slot from bk
              where lat_b between -90 and 90 and lon_b between -180 and 180)
        group by lat_b, slot"""


def _md5(seed):
    return f"md5(cast(id as varchar) || ':' || '{seed}')"


ORACLE["coord_bucket"] = W("select * from bk", "registry", extra=_BUCK)
ORACLE["ids_by_bucket"] = W("""
    select lat_b, lon_b, row_number() over (partition by lat_b, lon_b order by seq) - 1 as pos,
           count(*) over (partition by lat_b, lon_b) as n, seq, id from bk""", "registry", extra=_BUCK)
ORACLE["bucket_lookup"] = W("""
    select s.city_and_loc, s.lat_b, s.lon_b, t.id, t.seq
    from (select city_and_loc, cast(trunc(lat) as integer) as lat_b, cast(trunc(lon) as integer) as lon_b
          from stations) s
    left join (select lat_b, lon_b, arg_max(id, seq) as id, max(seq) as seq from bk group by lat_b, lon_b) t
    using (lat_b, lon_b)""", "registry", "stations", extra=_BUCK)
ORACLE["even_pick"] = W("select * from ev", "registry", extra={**_BUCK, "ev": _even_sql(NUM_EVEN)})
ORACLE["fill_pick"] = W(f"""
    select * from ev
    union all
    select 2 as phase, cast(rnd as bigint) as ord1, cast(lat_b as bigint) as ord2, id, seq, lat_b, lon_b
    from (select *, row_number() over (order by rnd, lat_b) as pos
          from (select *, row_number() over (partition by lat_b order by {_md5(PICK_SEED)}, seq) as rnd
                from bk where lat_b between -90 and 89 and lon_b between -180 and 180
                  and seq not in (select seq from ev)))
    where pos <= {NUM_FILL} - (select count(*) from ev)""", "registry", extra={**_BUCK, "ev": _even_sql(NUM_FILL)})
ORACLE["random_pick"] = W(f"""
    select id from (select id from registry order by {_md5(PICK_SEED)}, id limit {RANDOM_N - 1})
    union all select cast(6255152 as bigint) as id""", "registry")
ORACLE["assign_chunks"] = W(f"""
    select seq, id, rn, cast(rn // (n // {WORKERS} + 1) as integer) as worker
    from (select seq, id, row_number() over (order by seq) - 1 as rn, count(*) over () as n from registry)""",
                            "registry")
ORACLE["assign_round_robin"] = W(f"""
    select seq, id, rn, cast(rn % {KEYS} as integer) as worker
    from (select seq, id, row_number() over (order by seq) - 1 as rn from registry)""", "registry")
_CACHE = {"cache": """
    select name as city, -lon as lon, -lat as lat from stations where cast(substr(name, 2) as bigint) % 3 = 0""",
          "cities": """
    select name, case when cast(substr(name, 2) as bigint) % 2 = 0 then lon end as lon,
           case when cast(substr(name, 2) as bigint) % 2 = 0 then lat end as lat from stations"""}
ORACLE["city_cache"] = W("select city, lon, lat from cache", "stations", extra=_CACHE)
ORACLE["geocode"] = W("""
    select s.name, coalesce(c.lon, s.lon) as lon, coalesce(c.lat, s.lat) as lat,
           case when c.lon is not null then 'cache' when s.lon is not null then 'key' end as src
    from cities s left join cache c on s.name = c.city""", "stations", extra=_CACHE)
ORACLE["geocode_key"] = W("""
    select s.name, coalesce(s.lon, c.lon) as lon, coalesce(s.lat, c.lat) as lat,
           case when s.lon is not null then 'key' when c.lon is not null then 'cache' end as src
    from cities s left join cache c on s.name = c.city""", "stations", extra=_CACHE)
ORACLE["bucket_take"] = W("""
    select q.event_id, q.lat_b, q.lon_b, q.turn, i.id
    from (select event_id, lat_b, lon_b, row_number() over (partition by lat_b, lon_b order by event_id) - 1 as turn
          from (select event_id, cast(trunc(lat) as integer) as lat_b, cast(trunc(lon) as integer) as lon_b from readings)) q
    left join (select lat_b, lon_b, id, row_number() over (partition by lat_b, lon_b order by seq desc) - 1 as turn
               from bk) i using (lat_b, lon_b, turn)""", "registry", "readings", extra=_BUCK)
ORACLE["station_anomaly"] = ORACLE.pop("station_anomaly")

ORACLE["ok_responses"] = W("""
    select event_id, client, request_id, attempt, status from call_log where status = 200""", "call_log")
ORACLE["calls_per_minute"] = W("""
    select client, epoch_ms(date_trunc('minute', ts)) // 1000 as minute_start, count(*) as n
    from call_log group by 1, 2""", "call_log")
ORACLE["failure_counts"] = W("""
    select client, count(*) as calls, count(*) filter (where status is null) as failed,
           count(*) filter (where status = 200) as ok
    from call_log group by client""", "call_log")
ORACLE["quota_admission"] = W("""
    select event_id, client, minute, rank, cast((rank + cm) // 60 as bigint) as admitted_minute,
           cast((rank + cm) // 60 - minute as bigint) as delay_min
    from (select *, max(minute * 60 - rank) over (partition by client order by ts, event_id
                                                 rows between unbounded preceding and current row) as cm
          from (select event_id, client, ts, epoch_ms(ts) // 60000 as minute,
                       row_number() over (partition by client order by ts, event_id) - 1 as rank
                from call_log))""", "call_log")
ORACLE["first_success"] = W("""
    select request_id, min(attempt) as attempt, arg_min(event_id, (attempt, event_id)) as event_id,
           arg_min(client, (attempt, event_id)) as client
    from call_log where status = 200 and attempt <= 3 group by request_id""", "call_log")

ORACLE["quota_pooled"] = W(f"""
    select event_id, minute, rank, cast((rank + cm) // {60 * KEYS} as bigint) as admitted_minute,
           cast((rank + cm) // {60 * KEYS} - minute as bigint) as delay_min
    from (select *, max(minute * {60 * KEYS} - rank) over (order by ts, event_id
                                                 rows between unbounded preceding and current row) as cm
          from (select event_id, ts, epoch_ms(ts) // 60000 as minute,
                       row_number() over (order by ts, event_id) - 1 as rank from call_log))""", "call_log")
ORACLE["gave_up"] = W("""
    select request_id, count(*) as tries, count(*) filter (where status is null) as unanswered
    from call_log where attempt <= 2 group by request_id
    having count(*) >= 2 and count(*) filter (where status = 200) = 0""", "call_log")
ORACLE["failures_running"] = W("""
    select event_id, client, cast(sum(case when status is null then 1 else 0 end) over (
             partition by client order by ts, event_id rows between unbounded preceding and current row) as bigint) as failures
    from call_log""", "call_log")
ORACLE["stream_windows"] = W(f"""
    select city_and_loc, window_start, {r6('avg(cast(temperature as double))')} as avg_temp, count(*) as n
    from (select *, cast((epoch_ms("timestamp") // 3600000 - k) * 3600 as bigint) as window_start
          from parsed cross join range(0, 24) t(k))
    where window_start + 86400 <= (select max(epoch_ms("timestamp")) // 1000 - 3600 from parsed)
    group by 1, 2""", "parsed")

ORACLE["mean_last_24h"] = W(f"""
    select city_and_loc, cast((h - k) * 3600 as bigint) as window_start,
           {r6('avg(cast(temperature as double))')} as avg_temp, count(*) as n
    from (select *, epoch_ms("timestamp") // 3600000 as h from parsed) p cross join range(0, 24) t(k)
    group by 1, 2""", "parsed")
ORACLE["stream_latest"] = W("select * from current", "current")

_LIVE = """(select *, row_number() over (partition by city_and_loc, "time" order by "timestamp" desc, "partition" desc, "offset" desc) as k
    from parsed) where k = 1 and epoch_ms("timestamp") + 86400000 > (select max(epoch_ms("timestamp")) - 3600000 from parsed)"""
ORACLE["stream_ring"] = ORACLE["ring_batch"] = W(f'select city_and_loc, "time", temperature from {_LIVE}', "parsed")
ORACLE["stream_ring_state"] = W(f"""
    select city_and_loc, "time", epoch_us("timestamp") as us, "partition"::int as "partition", "offset"::bigint as "offset", temperature
    from {_LIVE}""", "parsed")
ORACLE["incremental_refresh"] = W(f"""
    select n.r, n.c, n.pid, {r6('n.v')} as v, {r6('n.d2')} as d2, {r6('b.v')} as s
    from near n join ir_out b on b.r = n.r and b.c = n.c""", "stations",
    extra={"pts": O.points_sql(SCALE), "near": O.nearest_sql(SCALE), **O.blur_lines_ctes("near", SCALE, SIGMA, "ir")})

ORACLE["stream_station_anomaly"] = W(f"""
    select p."offset"::bigint as "offset", p.city_and_loc, p."time", p.day_number, p.r, p.c, {r6('o.val')} as ref,
           {r6('p.temperature::double - o.val')} as anomaly
    from spot p left join mask m on m.r = p.r and m.c = p.c
    left join rf_out o on m.land and o.day_number = p.day_number and o.r = p.r and o.c = p.c""", *_GRID, "parsed", extra={**_REF0, "spot": f"""
    select *, cast(dayofyear("timestamp") - 1 as integer) as day_number,
           cast(least({int(180 * BLUR_SCALE) - 1}, floor({BLUR_SCALE} * (90.0 - split_part(city_and_loc, ':', 3)::double))) as integer) as r,
           cast(least({int(360 * BLUR_SCALE) - 1}, floor({BLUR_SCALE} * (split_part(city_and_loc, ':', 2)::double + 180.0))) as integer) as c
    from parsed"""})

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "readings_messages": q_readings_messages,
    "parse_weather": q_parse_weather,
    "hour_of_day": q_hour_of_day,
    "decode_reading": q_decode_reading,
    "bad_readings": q_bad_readings,
    "latest_by_key": q_latest_by_key,
    "current_table": q_current_table,
    "upsert_latest": q_upsert_latest,
    "city_temperature": q_city_temperature,
    "mean_by_city": q_mean_by_city,
    "unpack_city": q_unpack_city,
    "to_grid": q_to_grid,
    "point_stats": q_point_stats,
    "nearest_grid": q_nearest_grid,
    "flip_rows": q_flip_rows,
    "gaussian_blur": q_gaussian_blur,
    "land_masked": q_land_masked,
    "current_model": q_current_model,
    "reference_grid": q_reference_grid,
    "reference_model": q_reference_model,
    "grid_difference": q_grid_difference,
    "anomaly_map": q_anomaly_map,
    "heatmap_cells": q_heatmap_cells,
    "refresh_job": q_refresh_job,
    "map_tiles": q_map_tiles,
    "nearest_clustered": q_nearest_clustered,
    "nearest_full": q_nearest_full,
    "reference_full": q_reference_full,
    "blur_sigma20": q_blur_sigma20,
    "blur_full_grid": q_blur_full_grid,
    "interpolate_scattered": q_interpolate_scattered,
    "nearest_sphere": q_nearest_sphere,
    "reference_stored": q_reference_stored,
    "id_list": q_id_list,
    "city_registry": q_city_registry,
    "city_cache": q_city_cache,
    "geocode_key": q_geocode_key,
    "readings_written": q_readings_written,
    "bucket_take": q_bucket_take,
    "quota_pooled": q_quota_pooled,
    "gave_up": q_gave_up,
    "failures_running": q_failures_running,
    "stream_windows": q_stream_windows,
    "anomaly_empty": q_anomaly_empty,
    "reference_days": q_reference_days,
    "day_index": q_day_index,
    "climatology_scan": q_climatology_scan,
    "climatology_clean": q_climatology_clean,
    "climatology_day": q_climatology_day,
    "day_check": q_day_check,
    "unpivot_grid": q_unpivot_grid,
    "station_anomaly": q_station_anomaly,
    "coord_bucket": q_coord_bucket,
    "ids_by_bucket": q_ids_by_bucket,
    "bucket_lookup": q_bucket_lookup,
    "even_pick": q_even_pick,
    "fill_pick": q_fill_pick,
    "random_pick": q_random_pick,
    "assign_chunks": q_assign_chunks,
    "assign_round_robin": q_assign_round_robin,
    "geocode": q_geocode,
    "ok_responses": q_ok_responses,
    "calls_per_minute": q_calls_per_minute,
    "failure_counts": q_failure_counts,
    "quota_admission": q_quota_admission,
    "first_success": q_first_success,
    "mean_last_24h": q_mean_last_24h,
    "stream_latest": q_stream_latest,
    "stream_ring": q_stream_ring,
    "stream_station_anomaly": q_stream_station_anomaly,
    "stream_ring_state": q_stream_ring_state,
    "ring_batch": q_ring_batch,
    "incremental_refresh": q_incremental_refresh,
}

CORE = tuple(QUERIES)  # the engine's own operators, each with an oracle

# The corpus operators and the pipeline are an optional part: without their
# folder the other queries stand alone.
try:
    from thermogrid.llm import queries as _corpus
except ImportError:
    pass
else:
    QUERIES.update(_corpus.QUERIES)
    ORACLE.update(_corpus.ORACLE)
try:
    import corpus_pipeline as _pipeline
except ImportError:
    pass
else:
    QUERIES["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL:
        ORACLE["pipeline"] = _pipeline.ORACLE_SQL


def _utc(spark: SparkSession) -> None:
    # hours, days and epoch minutes are defined in UTC (FIXTURES.md section 3),
    # whatever session the caller brings
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _pinned(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _utc(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: the anomaly map (messages -> latest -> means ->
    nearest -> blur -> mask, climatology -> lattice cubic, difference)."""
    _utc(spark)
    return q_anomaly_map(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _pinned(v) for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
