"""Station registry jobs: coordinate buckets, lookups, even and random picks,
work splitting, geocoding and per-station anomaly (P17, A3, J4, J6, J7, W1-W6).

The registry is ``seq, id, lon, lat``: ``seq`` is the file order, which the
reference's in-memory lists keep implicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermogrid.functions.columns import trunc_int
from thermogrid.operators import climatology as cl
from thermogrid.operators.grid import grid_shape
from thermogrid.operators.ranking import positions

# Fixed values of the selection jobs, equal to the reference's: latitudes run
# -90..90 (181 buckets), longitudes -180..180 (361), and a random pick always
# appends the id 6255152.
MIN_LAT, MAX_LAT = -90, 90
MIN_LON, MAX_LON = -180, 180
FIXED_ID = 6255152


def coord_bucket(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Integer buckets, truncating toward zero (bucket 0 spans (-1, 1))."""
    return df.withColumn("lat_b", trunc_int(lat)).withColumn("lon_b", trunc_int(lon))


def ids_by_bucket(registry: DataFrame) -> DataFrame:
    """A3: ids grouped by (lat_b, lon_b) in file order, as long rows.

    ``pos`` is the position inside the bucket by ``seq`` and ``n`` the bucket
    size; a bucket is never gathered into one list or one task.
    """
    b = coord_bucket(registry)
    return positions(b, "seq", groups=["lat_b", "lon_b"], out="pos", size="n").select(
        "lat_b", "lon_b", "pos", "n", "seq", "id")


def bucket_tops(registry: DataFrame) -> DataFrame:
    """The id a bucket hands out first: the last one appended (highest seq)."""
    b = coord_bucket(registry)
    return (b.groupBy("lat_b", "lon_b").agg(F.max(F.struct("seq", "id")).alias("_t"))
            .select("lat_b", "lon_b", F.col("_t.id").alias("id"), F.col("_t.seq").alias("seq")))


def bucket_lookup(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Each request (``lat_b, lon_b``) gets its bucket's top id, or null."""
    return requests.join(bucket_tops(registry), ["lat_b", "lon_b"], "left")


def bucket_take(requests: DataFrame, registry: DataFrame, order: str = "seq") -> DataFrame:
    """J4, consuming: requests (``lat_b, lon_b`` and an integer ``order``, unique)
    take ids out of their bucket, the last appended first; a request that finds
    its bucket used up, or no bucket, gets null.

    The k-th request of a bucket meets the k-th id from the end: both sides are
    numbered without gathering a bucket in one task, then joined.
    """
    ids = ids_by_bucket(registry).select("lat_b", "lon_b", (F.col("n") - 1 - F.col("pos")).alias("turn"), "id",
                                         F.col("seq").alias("id_seq"))
    turns = positions(requests, order, groups=["lat_b", "lon_b"], out="turn")
    return turns.join(ids, ["lat_b", "lon_b", "turn"], "left")


def _lon_increment(num_ids: int) -> int:
    per_lat = int(num_ids / (MAX_LAT - MIN_LAT + 1)) + 1
    inc = int((MAX_LON - MIN_LON + 1) / per_lat)
    if inc <= 0:
        raise ValueError(f"num_ids={num_ids} leaves no longitude step (must be below 65341)")
    return inc


def even_pick(registry: DataFrame, num_ids: int = 5000) -> DataFrame:
    """One id per latitude and longitude slot, from the slot's first
    non-empty bucket (lowest longitude), taking its last id (highest seq).

    Slots are disjoint, so no bucket is touched twice and the walk becomes one
    grouped minimum (partial aggregate, skew-safe). Output ``phase=1, ord1 =
    lat_b, ord2 = slot``: the reference's list order is
    ``(phase, ord1, ord2)``. No cut at ``num_ids``, as in the reference.
    """
    inc = _lon_increment(num_ids)
    b = coord_bucket(registry).where(F.col("lat_b").between(MIN_LAT, MAX_LAT)
                                     & F.col("lon_b").between(MIN_LON, MAX_LON))
    slot = F.floor((F.col("lon_b") - MIN_LON) / F.lit(inc)).cast("int")
    first = F.min(F.struct(F.col("lon_b"), (-F.col("seq")).alias("nseq"), "id", "seq"))
    return (b.withColumn("slot", slot).groupBy("lat_b", "slot").agg(first.alias("_f"))
            .select(F.lit(1).alias("phase"), F.col("lat_b").cast("long").alias("ord1"),
                    F.col("slot").cast("long").alias("ord2"), F.col("_f.id").alias("id"),
                    F.col("_f.seq").alias("seq"), "lat_b", F.col("_f.lon_b").alias("lon_b")))


def _hash_order(id_col: str, seed) -> F.Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"), F.lit(str(seed))))


def fill_pick(registry: DataFrame, picked: DataFrame, num_ids: int = 5000, seed=0,
              salts: int = 32) -> DataFrame:
    """Fill the even pick up to ``num_ids``.

    Rounds over latitudes -90..89 (90 is skipped, as in the reference); in each
    round a latitude gives one id not yet picked, chosen by a seeded hash.
    Rows are ranked per latitude in two salted steps (top ``k`` per salt, then
    per latitude over at most ``k * salts`` rows), so a crowded latitude never
    sorts in one task. The fill is the first ``k`` by (round, latitude).
    """
    have = picked.count()
    k = int(num_ids) - int(have)
    if k <= 0:
        return picked
    b = coord_bucket(registry).where(F.col("lat_b").between(MIN_LAT, MAX_LAT - 1)
                                     & F.col("lon_b").between(MIN_LON, MAX_LON))
    rest = b.join(picked.select("seq"), ["seq"], "left_anti").withColumn("_h", _hash_order("id", seed))
    rest = rest.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(int(salts))))
    w1 = Window.partitionBy("lat_b", "_salt").orderBy("_h", "seq")
    top = rest.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy("lat_b").orderBy("_h", "seq")
    ranked = top.withColumn("round", F.row_number().over(w2)).where(F.col("round") <= k)
    fill = (ranked.orderBy("round", "lat_b").limit(k)
            .select(F.lit(2).alias("phase"), F.col("round").cast("long").alias("ord1"),
                    F.col("lat_b").cast("long").alias("ord2"), "id", "seq", "lat_b", "lon_b"))
    return picked.unionByName(fill)


def pick_ids(registry: DataFrame, num_ids: int = 5000, seed=0) -> DataFrame:
    """W1 + W2: the reference's evenly distributed id list."""
    return fill_pick(registry, even_pick(registry, num_ids), num_ids, seed)


def random_pick(ids: DataFrame, n: int = 100, seed=0, fixed_id: int = FIXED_ID) -> DataFrame:
    """W3+W4: ``n-1`` ids without replacement (seeded hash order) plus the fixed
    id, which may repeat one of the sample (as in the reference)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    sample = ids.orderBy(_hash_order("id", seed), "id").limit(n - 1).select("id")
    return append_fixed_id(sample, fixed_id)


def append_fixed_id(df: DataFrame, fixed_id: int = FIXED_ID) -> DataFrame:
    """Append one id (UNION ALL, duplicates kept)."""
    one = df.sparkSession.range(1).select(F.lit(int(fixed_id)).cast(df.schema["id"].dataType).alias("id"))
    return df.select("id").unionByName(one)


def assign_chunks(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """Contiguous slices of ``int(N/n) + 1`` rows in ``order``; the last
    workers get shorter or empty slices. Adds ``rn`` and ``worker``."""
    if n < 1:
        raise ValueError("n must be >= 1")
    x = positions(df, order, out="rn", size="_n")
    chunk = (F.col("_n") / F.lit(int(n))).cast("long") + 1
    return x.withColumn("worker", (F.col("rn") / chunk).cast("long").cast("int")).drop("_n")


def assign_round_robin(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """Row ``rn`` goes to worker ``rn mod n`` (key / city cycling)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    x = positions(df, order, out="rn")
    return x.withColumn("worker", F.pmod(F.col("rn"), F.lit(int(n))).cast("int"))


def geocode(df: DataFrame, cache: DataFrame, name: str = "name", prefer: str = "key") -> DataFrame:
    """Fill coordinates from the city cache ``city, lon, lat``.

    ``prefer='key'`` keeps the row's own coordinates and uses the cache only
    where they are missing (what the reference's code does); ``prefer='cache'``
    takes the cache first (what its docstring describes). ``src`` says which
    one was used. Cache keys are made unique first, so rows are never
    multiplied; the cache is small by nature (one row per city name) and the
    planner broadcasts it when its statistics say so.
    """
    if prefer not in ("key", "cache"):
        raise ValueError("prefer must be 'key' or 'cache'")
    c = (cache.groupBy("city").agg(F.first("lon", ignorenulls=True).alias("_clon"),
                                   F.first("lat", ignorenulls=True).alias("_clat")))
    j = df.join(c, df[name] == c["city"], "left")
    has_key = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    has_cache = F.col("_clon").isNotNull() & F.col("_clat").isNotNull()
    if prefer == "key":
        src = F.when(has_key, F.lit("key")).when(has_cache, F.lit("cache"))
    else:
        src = F.when(has_cache, F.lit("cache")).when(has_key, F.lit("key"))
    lon = F.when(src == "cache", F.col("_clon")).when(src == "key", F.col("lon"))
    lat = F.when(src == "cache", F.col("_clat")).when(src == "key", F.col("lat"))
    return (j.withColumn("src", src).withColumn("lon", lon).withColumn("lat", lat)
            .drop("city", "_clon", "_clat"))


def station_anomaly(stations: DataFrame, clim: DataFrame, mask: DataFrame, day: int, scale: float,
                    ref_row_shift: int = 1, value: str = "avg_temp") -> DataFrame:
    """Each station's mean minus the reference value of its grid cell.

    Only the stations' cells are interpolated (broadcast lattice); the mask
    join is keyed on the cell. Latitude -90 and longitude 180 belong to the last
    row and column.
    """
    s = float(scale)
    rows, cols = grid_shape(scale)
    st = stations.select("city_and_loc", value,
                         F.least(F.lit(rows - 1), F.floor(F.lit(s) * (F.lit(90.0) - F.col("lat")))).cast("int").alias("r"),
                         F.least(F.lit(cols - 1), F.floor(F.lit(s) * (F.col("lon") + F.lit(180.0)))).cast("int").alias("c"))
    st = st.join(mask.select("r", "c", "land"), ["r", "c"], "left")
    out = cl.add_reference(st, cl.climatology_for_day(clim, day), scale, ref_row_shift, out="ref")
    return out.withColumn("anomaly", F.col(value) - F.col("ref")).drop("land", "taps")
