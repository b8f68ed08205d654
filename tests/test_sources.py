"""Sources and sinks: npy grid, id list, registry, city cache, climatology
round trip, current store (idempotent upsert, compaction), table DDL."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermogrid.sources import current_store as cs
from thermogrid.sources import files as fs
from fixtures import testbed as tb
from thermogrid.sources.npy_source import read_npy_grid
from paths import SF001


def test_npy_grid_source(spark, tmp):
    mask = np.zeros((37, 20), dtype=bool)
    mask[3:9, 2:15] = True
    p = os.path.join(tmp, "mask.npy")
    np.save(p, mask)
    df = read_npy_grid(spark, p, rows_per_partition=8)
    assert df.rdd.getNumPartitions() == 5
    assert df.count() == 37 * 20
    assert df.where("land").count() == int(mask.sum())
    assert {(r.r, r.c) for r in df.where("land").collect()} == set(zip(*np.nonzero(mask)))
    vals = np.arange(12, dtype=np.float64).reshape(3, 4)
    vals[1, 1] = np.nan
    p2 = os.path.join(tmp, "v.npy")
    np.save(p2, vals)
    v = read_npy_grid(spark, p2).where("r = 1 and c = 1").first().v
    assert v is None


def test_npy_grid_through_spark_files(spark, tmp):
    from thermogrid.sources import npy_source as ns
    vals = np.arange(35, dtype=np.float64).reshape(7, 5)
    vals[2, 3] = np.nan
    p = os.path.join(tmp, "v.npy")
    np.save(p, vals)
    rows = {(r.r, r.c): r.v for r in ns._read_binary(spark, "file://" + p, None, 2).collect()}
    assert rows == {(r.r, r.c): r.v for r in read_npy_grid(spark, "file:" + p).collect()}
    assert len(rows) == 35 and rows[(2, 3)] is None and rows[(6, 4)] == 34.0


def test_id_list_and_registry_keep_file_order(spark, tmp):
    ids = [int(x) for x in np.random.default_rng(1).integers(0, 10**6, 3000)]
    p = os.path.join(tmp, "ids.txt")
    with open(p, "w") as f:
        f.write("\n".join(str(i) for i in ids) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")   # many splits of one file
    try:
        got = fs.read_id_list(spark, p).orderBy("seq").toPandas()
        reg_p = os.path.join(tmp, "reg.txt")
        with open(reg_p, "w") as f:
            for i, x in enumerate(ids):
                f.write(f"{x}:{(i % 360) - 180}.5:{(i % 180) - 90}.25\n")
        reg = fs.read_city_registry(spark, reg_p).orderBy("seq").toPandas()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got.id.tolist() == ids and got.seq.tolist() == list(range(len(ids)))
    assert reg.id.tolist() == [str(i) for i in ids]
    assert reg.lon.iloc[1] == -179.5 and reg.lat.iloc[1] == -89.25


def test_bad_id_line_fails(spark, tmp):
    p = os.path.join(tmp, "bad.txt")
    with open(p, "w") as f:
        f.write("1\nx2\n")
    with pytest.raises(Exception):
        fs.read_id_list(spark, p).collect()
    with open(p, "w") as f:
        f.write("1\n\n2\n")
    with pytest.raises(Exception):
        fs.read_id_list(spark, p).collect()


def test_city_cache(spark, tmp):
    p = os.path.join(tmp, "cache.json")
    with open(p, "w") as f:
        f.write('{"Alpha": [1.5, -2.0], "Beta": [100.25, 45.0]}')
    got = {r.city: (r.lon, r.lat) for r in fs.read_city_cache(spark, p).collect()}
    assert got == {"Alpha": (1.5, -2.0), "Beta": (100.25, 45.0)}


def test_climatology_round_trip_and_pruning(spark, tmp):
    clim = tb.climatology(spark, SF001).where(F.col("day_number").isin(0, 14))
    p = os.path.join(tmp, "clim")
    fs.write_climatology(clim, p)
    back = fs.read_climatology(spark, p)
    assert back.count() == clim.where("climatology is not null").count()
    day = back.where("day_number = 14")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day_number" in plan
    pc = os.path.join(tmp, "clim_csv")
    fs.write_climatology(clim, pc, fmt="csv")
    assert fs.read_climatology(spark, pc, fmt="csv").where("day_number = 0").count() == \
        clim.where("day_number = 0 and climatology is not null").count()


def test_current_store_idempotent_and_compaction(spark, tmp):
    path = os.path.join(tmp, "current")
    b0 = spark.createDataFrame([("k1", 1, 1.0), ("k2", 1, 2.0)], "city_and_loc string, time int, temperature float")
    b1 = spark.createDataFrame([("k1", 1, 5.0)], "city_and_loc string, time int, temperature float")
    cs.upsert_current(b0, 0, path)
    cs.upsert_current(b1, 1, path)
    cs.upsert_current(b1, 1, path)            # a replayed batch rewrites, never adds
    cur = {(r.city_and_loc, r.time): r.temperature for r in cs.read_current(spark, path).collect()}
    assert cur == {("k1", 1): 5.0, ("k2", 1): 2.0}
    assert cs.compact_current(spark, path) == 1
    b2 = spark.createDataFrame([("k2", 1, 9.0)], "city_and_loc string, time int, temperature float")
    cs.upsert_current(b2, 2, path)
    cur = {(r.city_and_loc, r.time): r.temperature for r in cs.read_current(spark, path).collect()}
    assert cur == {("k1", 1): 5.0, ("k2", 1): 9.0}


def test_ensure_current_table(spark):
    name = cs.ensure_current_table(spark, "current_t", database="tg_test")
    cs.ensure_current_table(spark, "current_t", database="tg_test")
    assert [f.name for f in spark.table(name).schema.fields] == ["city_and_loc", "time", "temperature"]
    spark.sql("DROP TABLE tg_test.current_t")


def test_heatmap_cells_sink(spark, tmp):
    df = spark.range(0, 12).selectExpr("cast(id div 4 as int) r", "cast(id % 4 as int) c", "cast(id as double) diff",
                                       "cast(id as double) clipped", "cast(id as int) level")
    p = os.path.join(tmp, "heat")
    fs.write_heatmap_cells(df, p)
    assert spark.read.parquet(p).count() == 12
