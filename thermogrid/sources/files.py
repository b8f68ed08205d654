"""File sources and sinks: climatology, id lists, city registry, city cache,
heat-map cells (S6, S7, S9, S10, S11, S12).

All readers use explicit schemas (no inference) so that a scan is one pass and
filters reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermogrid.session import replace_path

CLIMATOLOGY_SCHEMA = T.StructType([
    T.StructField("day_number", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("climatology", T.DoubleType()),
])


def read_climatology(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The climatology table, from Parquet (partitioned by ``day_number``,
    so a day filter prunes files) or from CSV with a header."""
    if fmt == "parquet":
        return spark.read.schema(CLIMATOLOGY_SCHEMA).parquet(path)
    if fmt == "csv":
        return spark.read.schema(CLIMATOLOGY_SCHEMA).option("header", True).csv(path)
    raise ValueError(f"unknown format {fmt!r}")


def write_climatology(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write the non-missing climatology, one folder per day."""
    from thermogrid.operators.climatology import drop_missing
    out = drop_missing(df).select(*[f.name for f in CLIMATOLOGY_SCHEMA.fields])
    w = out.repartition("day_number").write.mode(mode).partitionBy("day_number")
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def file_order(df: DataFrame, out: str = "seq") -> DataFrame:
    """Number the rows of a freshly read text/CSV source in file order.

    Rows of one file split are read in order and sit together in one task, so
    ``monotonically_increasing_id`` minus the split's first id is the line
    within the split. Per split counts (one row per split) give the offsets.
    The scan is deterministic, so both uses of it agree, also on a retry.
    """
    x = (df.withColumn("_f", F.col("_metadata.file_path"))
         .withColumn("_s", F.col("_metadata.file_block_start"))
         .withColumn("_id", F.monotonically_increasing_id()))
    splits = x.groupBy("_f", "_s").agg(F.min("_id").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, 0)
    splits = splits.withColumn("_off", F.sum("_n").over(w) - F.col("_n"))
    # one row per file split (a hundred thousand for some ten TB); the planner
    # broadcasts them when their size allows
    return (x.join(splits.select("_f", "_s", "_m0", "_off"), ["_f", "_s"])
            .withColumn(out, (F.col("_off") + F.col("_id") - F.col("_m0")).cast("long"))
            .drop("_f", "_s", "_id", "_m0", "_off"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One integer id per line -> ``seq, id``; a line that is not an
    integer fails the job (as ``int(line)`` does), a blank one too."""
    t = spark.read.text(path)
    v = F.trim(F.col("value")).try_cast("long")
    bad = F.raise_error(F.concat(F.lit("not an id: "), F.col("value"))).cast("long")
    ids = t.select(F.when(v.isNotNull(), v).otherwise(bad).alias("id"), "_metadata")
    return file_order(ids).select("seq", "id")


REGISTRY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
])


def read_city_registry(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``id:lon:lat`` -> ``seq, id, lon, lat`` (seq = file order).

    Ids stay text, as in the reference; ``cast('long')`` them where numbers
    are needed. A malformed line fails the job.
    """
    r = (spark.read.schema(REGISTRY_SCHEMA).option("sep", ":").option("mode", "FAILFAST")
         .csv(path).select("id", "lon", "lat", "_metadata"))
    return file_order(r).select("seq", "id", "lon", "lat")


def _cache_rows(text_col) -> F.Column:
    return F.explode(F.from_json(text_col, "map<string,array<double>>"))


def read_city_cache(spark: SparkSession, path: str) -> DataFrame:
    """JSON object ``name -> [lon, lat]`` -> ``city, lon, lat``.

    A file is one object and so one row of one task: for caches of up to some
    hundred MB each (a city name and two numbers are about 50 bytes)."""
    t = spark.read.option("wholetext", True).text(path)
    return (t.select(_cache_rows(F.col("value")).alias("city", "xy"))
            .select("city", F.col("xy")[0].alias("lon"), F.col("xy")[1].alias("lat")))


def city_cache_from_text(spark: SparkSession, text: str) -> DataFrame:
    """S11 on a JSON text already at hand."""
    t = spark.range(1).select(F.lit(text).alias("value"))
    return (t.select(_cache_rows(F.col("value")).alias("city", "xy"))
            .select("city", F.col("xy")[0].alias("lon"), F.col("xy")[1].alias("lat")))


MAP_BAND = 32  # map rows per file


def write_heatmap_cells(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The difference map as a cell table (the reference draws a picture).

    Bands of ``MAP_BAND`` map rows stay together, so a reader of a band of
    latitudes touches few files. An overwrite is written beside the served
    folder, which it then replaces: readers never see a half-written map.
    """
    cols = [c for c in ("r", "c", "cur", "ref", "diff", "clipped", "level") if c in df.columns]
    bands = df.select(*cols).repartition(F.floor(F.col("r") / MAP_BAND))
    if mode != "overwrite":
        bands.write.mode(mode).parquet(path)
        return
    beside = f"{path.rstrip('/')}.next"
    bands.write.mode("overwrite").parquet(beside)
    replace_path(df.sparkSession, beside, path)
