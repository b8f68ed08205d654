"""Plan shape of every registered query: no cross product, no nested-loop join,
no row-at-a-time Python UDF; column pruning reaches the Parquet scans; and the
edge cases of SURVEY section 5 (empty input, truncating buckets)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from thermogrid.operators import grid as gr
from thermogrid.operators import stations as st
from thermogrid.plans import anomaly as an
from fixtures import testbed as tb
from paths import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.CORE if n != "stream_latest"))
def test_no_cross_products_or_row_udfs(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["mean_by_city"](spark, SF001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan
    for s in schemas:
        cols = {c.split(":")[0] for c in s.split(",")}
        assert cols <= {"event_id", "ts", "user_id", "value"}, s
        assert "props" not in cols and "event_type" not in cols


def test_day_filter_reaches_the_scan(spark):
    plan = _plan(E.queries()["climatology_day"](spark, SF001))
    assert "dayofyear" in plan and "PushedFilters" in plan


def test_reference_does_not_shuffle_cells(spark):
    # the cell table only meets the (bounded) lattice neighbourhoods through a broadcast
    mask = tb.land_mask(spark, 1.0)
    ref = an.reference_model(tb.climatology(spark, SF001), mask, 14, 1.0)
    plan = _plan(ref)
    assert "BroadcastHashJoin" in plan
    top = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning(r" not in top


def test_empty_input_gives_unmasked_zeros(spark):
    # No station at all -> the current model is 0 everywhere, land or not
    means = spark.createDataFrame([], "city_and_loc string, avg_temp double")
    mask = tb.land_mask(spark, 0.5)
    cur = an.current_model(means, mask, 0.5, 1.0).toPandas()
    assert len(cur) == 90 * 180 and (cur.v == 0.0).all()


def test_points_on_the_edges_still_count(spark):
    # lat = -90 and lon = 180 fall outside the cell range, yet are the nearest there
    means = spark.createDataFrame([("A:180.0:-90.0", 5.0), ("B:-170.0:80.0", -5.0)], "city_and_loc string, avg_temp double")
    pts = an.station_points(means, 1.0)
    near = {(r.r, r.c): r.pid for r in gr.nearest_points(pts, 180, 360, 8).collect()}
    assert near[(179, 359)] == "A:180.0:-90.0" and near[(0, 0)] == "B:-170.0:80.0"


def test_buckets_truncate_toward_zero(spark):
    # Q12: -0.7 goes to bucket 0, -1.2 to -1
    df = spark.createDataFrame([(1, 1, -0.7, -1.2), (2, 2, 0.7, 1.9)], "seq long, id long, lon double, lat double")
    got = {r.id: (r.lat_b, r.lon_b) for r in st.coord_bucket(df).collect()}
    assert got == {1: (-1, 0), 2: (1, 0)}
    assert F is not None
