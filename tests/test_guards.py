"""Unusable input, plan shapes of the newest-per-key aggregates, used-up buckets,
pooled quota, request outcomes, off-lattice climatology, days and map by time."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from fixtures import testbed as tb
from thermogrid.functions.columns import encode_key, heat_clip, heat_level
from thermogrid.operators import calllog as cg
from thermogrid.operators import climatology as cl
from thermogrid.operators import readings as rd
from thermogrid.operators import stations as st
from thermogrid.plans import anomaly as an
from thermogrid.session import work_partitions
from paths import SF001


def test_reasons_of_bad_readings(spark):
    rows = [("A:1.0:2.0:3", "4.5", None), ("A:1.0:3", "1", "key"), (None, "1", "key"), ("A:x:2.0:3", "1", "key"),
            ("A:999:2.0:3", "1", "coord"), ("A:1.0:NaN:3", "1", "coord"), ("A:-180.0:90.0:0", "1", None),
            ("A:1.0:2.0:99", "1", "hour"), ("A:1.0:2.0:-1", "1", "hour"), ("A:1.0:2.0:x", "1", "hour"),
            ("A:1.0:2.0:3", "NaN", "value"), ("A:1.0:2.0:3", "Infinity", "value"), ("A:1.0:2.0:3", "1e300", "value"),
            ("A:1.0:2.0:3", None, "value"), ("A:B:1.0:2.0:3", "7", None)]
    df = spark.createDataFrame([(i, k, v) for i, (k, v, _) in enumerate(rows)], "offset long, key string, value string")
    good, bad = rd.quarantine_bad(df)
    got = {r.offset: r.reason for r in bad.collect()} | {r.offset: None for r in good.collect()}
    assert got == {i: r for i, (_, _, r) in enumerate(rows)}


def test_null_part_gives_a_null_key(spark):
    df = spark.createDataFrame([("A", None, 2.0, 3), ("A", 1.0, 2.0, 3)], "n string, lon double, lat double, h int")
    assert [r.k for r in df.select(encode_key("n", "lon", "lat", "h").alias("k")).collect()] == [None, "A:1.0:2.0:3"]


def test_no_value_has_no_heat_level(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-20.0,), (0.0,), (10.0,)], "d double")
    got = [(r.c, r.l) for r in df.select(heat_clip("d").alias("c"), heat_level("d").alias("l")).collect()]
    assert got == [(None, None), (None, None), (-10.0, 0), (0.0, 128), (10.0, 255)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_per_key_does_not_sort_raw_rows(spark):
    good = rd.decode_reading(tb.messages(spark, SF001))
    for df in (rd.latest_by_key(good, packed=True), cg.first_success(tb.call_log(spark, SF001)).select("request_id")):
        plan = _plan(df)
        assert "HashAggregate" in plan and "SortAggregate" not in plan
    # nothing is shuffled before the first partial aggregate
    below = _plan(rd.latest_by_key(good, packed=True)).split("partial_max_by")[1]
    assert "Exchange" not in below


def test_packed_order_equals_struct_order(spark):
    good = rd.decode_reading(tb.messages(spark, SF001))
    a = {(r.city_and_loc, r.time): r.temperature for r in rd.latest_by_key(good).collect()}
    assert a == {(r.city_and_loc, r.time): r.temperature for r in rd.latest_by_key(good, packed=True).collect()}
    far = good.withColumn("offset", F.lit(10 ** 16))
    with pytest.raises(Exception):
        rd.latest_by_key(far, packed=True).collect()


def test_no_window_over_the_whole_table(spark):
    for df in (st.bucket_take(st.coord_bucket(tb.readings(spark, SF001)).select("event_id", "lat_b", "lon_b"),
                              tb.registry(spark, SF001), "event_id"), cg.running_failures(tb.call_log(spark, SF001))):
        assert "SinglePartition" not in _plan(df)


def test_bucket_ids_are_used_up(spark):
    reg = spark.createDataFrame([(0, 10, 1.2, 2.2), (1, 11, 1.7, 2.9), (2, 12, 5.0, 5.0)], "seq long, id long, lon double, lat double")
    req = spark.createDataFrame([(i, 2, 1) for i in range(4)] + [(4, 5, 5), (5, 9, 9)], "seq long, lat_b int, lon_b int")
    got = {r.seq: r.id for r in st.bucket_take(req, reg).collect()}
    assert got == {0: 11, 1: 10, 2: None, 3: None, 4: 12, 5: None}


def _log(spark, rows):
    t0 = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(t0 + datetime.timedelta(seconds=s), i, c, r, a, x) for i, (s, c, r, a, x) in enumerate(rows)],
                                 "ts timestamp, event_id long, client string, request_id long, attempt int, status int")


def test_pooled_quota_queues_all_keys_together(spark):
    log = _log(spark, [(i % 50, f"C{i % 5}", i, 1, 200) for i in range(300)])
    out = cg.pooled_quota(log, keys=2, cap=60).orderBy("rank").collect()
    order = sorted(range(300), key=lambda i: (i % 50, i))
    first = log.first().ts.replace(tzinfo=datetime.timezone.utc).timestamp() // 60
    assert [r.event_id for r in out] == order
    assert [r.admitted_minute - first for r in out] == [k // 120 for k in range(300)]


def test_gave_up_and_running_failures(spark):
    log = _log(spark, [(0, "a", 1, 1, None), (1, "a", 1, 2, 500), (2, "a", 1, 3, None), (3, "b", 2, 1, None), (3, "b", 2, 2, 200),
                       (4, "a", 3, 1, None), (4, "a", 3, 2, None)])
    assert [(r.request_id, r.tries, r.unanswered) for r in cg.gave_up(log).collect()] == [(1, 3, 2)]
    run = {r.event_id: r.failures for r in cg.running_failures(log).collect()}
    assert run == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1, 5: 3, 6: 4}
    first = {r.request_id: (r.attempt, r.event_id, r.client) for r in cg.first_success(log).collect()}
    assert first == {2: (2, 4, "b")}


def _lattice(spark, shift=0.0, wrap=False):
    lat, lon = F.expr("cast(id div 360 as int) - 89.5D"), F.expr("cast(id % 360 as int) - 179.5D")
    lon = F.when((lon < 0) & F.lit(wrap), lon + 360).otherwise(lon) + F.lit(shift)
    return spark.range(0, 64800).select(F.lit(3).alias("day_number"), lat.alias("latitude"), lon.alias("longitude"),
                                        F.col("id").cast("double").alias("climatology"))


def test_longitudes_are_wrapped_and_strays_refused(spark):
    a = {(r.i, r.j): r.val for r in cl.lattice_points(_lattice(spark)).collect()}
    assert len(a) == 64800 and a == {(r.i, r.j): r.val for r in cl.lattice_points(_lattice(spark, wrap=True)).collect()}
    for bad in (_lattice(spark, shift=0.4), _lattice(spark).union(_lattice(spark).limit(1))):
        with pytest.raises(Exception):
            cl.lattice_points(bad).collect()


def test_days_and_map_by_time(spark):
    assert an.day_of(datetime.datetime(2024, 1, 15, 23)) == 14 and an.day_of(datetime.datetime(2023, 12, 31)) == 364
    with pytest.raises(ValueError):
        an.day_of(datetime.datetime(2024, 12, 31))
    assert an.day_of(datetime.datetime(2024, 12, 31), "clamp") == 364
    with pytest.raises(ValueError):
        cl.require_day(_lattice(spark), 365)


def test_reference_models_equal_the_single_days(spark, tmp):
    clim, mask = tb.climatology(spark, SF001).where("day_number in (0, 14)"), tb.land_mask(spark, 0.5)
    an.write_reference_models(an.reference_models(clim, mask, None, 0.5), tmp + "/ref")
    for day in (0, 14):
        got = an.read_reference_model(spark, tmp + "/ref", day)
        assert re.search(r"PartitionFilters: \[.*day_number", _plan(got))
        want = an.reference_model(clim, mask, day, 0.5)
        assert {(r.r, r.c): (r.v, r.taps) for r in got.collect()} == {(r.r, r.c): (r.v, r.taps) for r in want.collect()}


def test_edge_station_has_an_anomaly(spark):
    s = spark.createDataFrame([("A", 180.0, 10.0, 5.0), ("B", 20.0, -90.0, 5.0)], "city_and_loc string, lon double, lat double, avg_temp double")
    mask = tb.land_mask(spark, 1.0).withColumn("land", F.lit(True))
    got = {r.city_and_loc: (r.r, r.c) for r in st.station_anomaly(s, _lattice(spark), mask, 3, 1.0).collect()}
    assert got == {"A": (80, 359), "B": (179, 200)}


def test_partitions_follow_the_work():
    assert work_partitions(10 ** 9, 25_000) == 40_000 and work_partitions(0, 10) == 1
