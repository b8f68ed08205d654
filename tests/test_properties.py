"""Property tests: skew-safe positions and quota admission on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from thermogrid.operators.calllog import quota_admission
from thermogrid.operators.ranking import positions

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5000, 5000)), min_size=0, max_size=300, unique_by=lambda t: t),
       st.sampled_from([2, 7, 64]))
def test_positions_are_dense_ranks(spark, rows, width):
    df = spark.createDataFrame(rows, "g int, k long") if rows else spark.createDataFrame([], "g int, k long")
    got = positions(df, "k", groups=["g"], width=width, out="pos", size="n").toPandas()
    assert len(got) == len(rows)
    for g, part in got.groupby("g"):
        part = part.sort_values("k")
        assert part.pos.tolist() == list(range(len(part)))
        assert (part.n == len(part)).all()


def _queue(minutes, cap):
    out, last = [], -1
    for m in minutes:
        last = max(m * cap, last + 1)
        out.append(last // cap)
    return out


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 600), st.integers(0, 999)),
                min_size=1, max_size=200),
       st.integers(1, 9))
def test_quota_matches_queue(spark, calls, cap):
    base = dt.datetime(2024, 5, 1)
    rows = [(base + dt.timedelta(seconds=s, microseconds=us), i, c) for i, (c, s, us) in enumerate(calls)]
    df = spark.createDataFrame(rows, "ts timestamp, event_id long, client string")
    got = quota_admission(df, cap=cap).toPandas()
    for c, part in got.groupby("client"):
        part = part.sort_values("rank")
        src = sorted((r for r in rows if r[2] == c), key=lambda r: (r[0], r[1]))
        assert part.event_id.tolist() == [r[1] for r in src]
        mins = [int((r[0] - dt.datetime(1970, 1, 1)).total_seconds() // 60) for r in src]
        assert part.admitted_minute.tolist() == _queue(mins, cap)


def test_hashed_keys_leave_no_wide_window(spark):
    """64-bit hashes as keys: dense positions, and at no level more bins below one parent than ``width``."""
    from pyspark.sql import functions as F

    from thermogrid.operators.ranking import key_levels
    width = 64
    df = spark.range(20000).select(F.xxhash64("id").alias("k"), (F.col("id") % 3 == 0).alias("g"))
    keys = [r.k for r in df.select("k").collect()]
    shifts = key_levels(min(keys), max(keys), width)
    assert len(shifts) > 8
    for low, high in zip(shifts, [*shifts[1:], 64]):
        below = {}
        for b in {k >> low for k in keys}:
            below.setdefault(b >> (high - low), set()).add(b)
        assert max(map(len, below.values())) <= width + 2
    assert max(len([k for k in keys if k >> shifts[0] == b]) for b in {keys[0] >> shifts[0], min(keys) >> shifts[0]}) <= width
    for groups in ([], ["g"]):
        got = positions(df, "k", groups, width=width, out="pos", size="n").collect()
        for g in {tuple(r[x] for x in groups) for r in got}:
            mine = sorted((r.k, r.pos) for r in got if tuple(r[x] for x in groups) == g)
            assert [p for _, p in mine] == list(range(len(mine))) and all(r.n == len(mine) for r in got if tuple(r[x] for x in groups) == g)
