"""Request-log jobs: W7 against a sequential queue, W8, A7, A8."""

import datetime as dt

import numpy as np

from thermogrid.operators import calllog as cl
from fixtures import testbed as tb
from paths import SF01


def _queue(minutes, cap):
    out, last_slot = [], -1
    for m in minutes:
        slot = max(m * cap, last_slot + 1)
        out.append(slot // cap)
        last_slot = slot
    return out


def test_quota_equals_sequential_queue(spark):
    rng = np.random.default_rng(4)
    base = dt.datetime(2024, 3, 1)
    rows = []
    for client, n in (("a", 300), ("b", 40)):
        secs = np.sort(rng.integers(0, 900, n))
        for i, s in enumerate(secs):
            rows.append((base + dt.timedelta(seconds=int(s), microseconds=int(rng.integers(0, 1000))),
                         len(rows), client))
    df = spark.createDataFrame(rows, "ts timestamp, event_id long, client string")
    got = cl.quota_admission(df, cap=7).toPandas()
    for client, g in got.groupby("client"):
        g = g.sort_values(["rank"])
        src = sorted((r for r in rows if r[2] == client), key=lambda r: (r[0], r[1]))
        minutes = [int((r[0] - dt.datetime(1970, 1, 1)).total_seconds() // 60) for r in src]
        assert g.event_id.tolist() == [r[1] for r in src]
        assert g.admitted_minute.tolist() == _queue(minutes, 7)
        assert (g.delay_min >= 0).all()


def test_quota_on_log_fixture(spark):
    log = tb.call_log(spark, SF01)
    got = cl.quota_admission(log, cap=60).toPandas()
    for client, g in got.groupby("client"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(len(g)))
        assert g.admitted_minute.tolist() == _queue(g.minute.tolist(), 60)
        assert g.groupby("admitted_minute").size().max() <= 60


def test_first_success_and_counts(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(t, 1, "c", 10, 1, None), (t, 2, "c", 10, 2, 500), (t, 3, "c", 10, 3, 200), (t, 4, "c", 11, 1, 200),
            (t, 5, "d", 12, 4, 200), (t, 6, "d", 12, 1, 500)]
    df = spark.createDataFrame(rows, "ts timestamp, event_id long, client string, request_id long, attempt int, "
                                     "status int")
    fs = {r.request_id: (r.attempt, r.event_id) for r in cl.first_success(df).collect()}
    assert fs == {10: (3, 3), 11: (1, 4)}          # request 12 only succeeded on a 4th try
    fc = {r.client: (r.calls, r.failed, r.ok) for r in cl.failure_counts(df).collect()}
    assert fc == {"c": (4, 1, 2), "d": (2, 0, 1)}
    assert cl.successful_responses(df).count() == 3
    cpm = cl.calls_per_minute(df).collect()
    assert sorted((r.client, r.n) for r in cpm) == [("c", 4), ("d", 2)]
