"""Station selection against plain loops (W1 walk, W2 rules, W5/W6 splits, J4)."""

import numpy as np
import pytest

from thermogrid.operators import stations as st
from fixtures import testbed as tb
from paths import SF01


def _walk_even(reg_rows, num_ids):
    """Brute-force statement of the even pick: for every latitude -90..90 and
    every longitude window [start, start+inc) with start = -180, -180+inc, ...
    <= 180, the window's lowest-longitude bucket with ids gives its id of
    highest file order; results ordered by latitude, then window."""
    inc = int(361 / (int(num_ids / 181) + 1))
    rows = [(int(lat), int(lon), seq, id_) for seq, id_, lon, lat in reg_rows]
    out = []
    for lat in range(-90, 91):
        at_lat = [r for r in rows if r[0] == lat]
        start = -180
        while start <= 180:
            window = [r for r in at_lat if start <= r[1] < start + inc]
            if window:
                lo = min(r[1] for r in window)
                out.append(max((r for r in window if r[1] == lo), key=lambda r: r[2])[3])
            start += inc
    return out


@pytest.mark.parametrize("num_ids", [200, 500, 1000, 5000])
def test_even_pick_equals_walk(spark, num_ids):
    reg = tb.registry(spark, SF01)
    rows = [tuple(r) for r in reg.select("seq", "id", "lon", "lat").collect()]
    got = st.even_pick(reg, num_ids).orderBy("phase", "ord1", "ord2").select("id").toPandas().id.tolist()
    assert got == _walk_even(rows, num_ids)


def test_even_pick_rejects_huge_counts(spark):
    with pytest.raises(ValueError):
        st.even_pick(tb.registry(spark, SF01), 65341)


def test_fill_pick_rules(spark):
    reg = tb.registry(spark, SF01)
    n_even = st.even_pick(reg, 1400).count()
    out = st.pick_ids(reg, 1400, seed=3).toPandas()
    assert n_even < 1400 and len(out) == max(1400, n_even)   # the even pick is never cut
    assert out.seq.is_unique
    fill = out[out.phase == 2]
    assert fill.lat_b.max() <= 89
    assert not fill.groupby(["ord1", "ord2"]).size().gt(1).any()   # one id per latitude and round
    # rounds are filled in order: no later round starts before every latitude with ids left got one
    assert (fill.groupby("ord1").size().sort_index().diff().fillna(0) <= 0).all()


def test_random_pick_appends_fixed_id(spark):
    ids = spark.range(0, 50).select("id")
    out = st.random_pick(ids, 10, seed=1).toPandas().id.tolist()
    assert len(out) == 10 and st.FIXED_ID in out
    assert len(set(out) - {st.FIXED_ID}) == 9
    assert out.count(st.FIXED_ID) == 1


@pytest.mark.parametrize("n_rows,n", [(0, 3), (1, 3), (2, 3), (3, 3), (4, 3), (10, 1), (23, 7)])
def test_assign_chunks_matches_slices(spark, n_rows, n):
    df = spark.range(0, n_rows).selectExpr("id * 3 + 5 as seq", "id")
    out = st.assign_chunks(df, n).orderBy("seq").toPandas()
    per = int(n_rows / n) + 1
    exp = []
    for w in range(n):
        exp += [w] * len(range(n_rows)[per * w:min(n_rows, (w + 1) * per)])
    assert out.worker.tolist() == exp
    assert out.rn.tolist() == list(range(n_rows))


def test_round_robin_and_positions_under_skew(spark):
    # one bucket holds most rows; positions stay dense and ordered
    df = spark.range(0, 5000).selectExpr("id as seq", "id", "case when id % 10 < 8 then 1.5 else id / 100.0 end as lon",
                                         "2.5 as lat")
    b = st.ids_by_bucket(df).toPandas()
    for _, g in b.groupby(["lat_b", "lon_b"]):
        g = g.sort_values("seq")
        assert g.pos.tolist() == list(range(len(g)))
        assert (g.n == len(g)).all()
    rr = st.assign_round_robin(df, 4).toPandas().sort_values("seq")
    assert rr.worker.tolist() == [i % 4 for i in range(5000)]


def test_bucket_lookup_takes_last_appended(spark):
    reg = spark.createDataFrame([(1, 11, 0.5, 0.5), (2, 12, 0.9, -0.3), (3, 13, 5.0, 5.0)],
                                "seq long, id long, lon double, lat double")
    req = spark.createDataFrame([(0, 0), (5, 5), (9, 9)], "lat_b int, lon_b int")
    out = {(r.lat_b, r.lon_b): r.id for r in st.bucket_lookup(req, reg).collect()}
    assert out == {(0, 0): 12, (5, 5): 13, (9, 9): None}


def test_geocode_prefers(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0), ("B", None, None), ("C", None, None)],
                               "name string, lon double, lat double")
    cache = spark.createDataFrame([("A", 9.0, 9.0), ("B", 3.0, 4.0)], "city string, lon double, lat double")
    key = {r.name: (r.lon, r.lat, r.src) for r in st.geocode(df, cache).collect()}
    assert key == {"A": (1.0, 2.0, "key"), "B": (3.0, 4.0, "cache"), "C": (None, None, None)}
    cfirst = {r.name: r.src for r in st.geocode(df, cache, prefer="cache").collect()}
    assert cfirst == {"A": "cache", "B": "cache", "C": None}
    assert np.isclose(st.geocode(df, cache, prefer="cache").where("name = 'A'").first().lon, 9.0)
