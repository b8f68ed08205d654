"""Reading messages in and out.

A message is ``key, value`` bytes plus the usual topic metadata. Kafka is used
when its connector is on the class path; any file format works the same way
(the tests and local runs use Parquet or JSON folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from thermogrid.functions.columns import TOPIC

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def read_readings_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                         topic: str = TOPIC, servers: str | None = None, schema=None, **opts) -> DataFrame:
    """Streaming DataFrame of messages.

    ``fmt='kafka'`` subscribes to ``topic`` (``startingOffsets=latest`` unless
    given); any other format reads new files under ``path`` with a fixed schema
    (``MESSAGE_SCHEMA`` unless given; key/value may also be strings).
    """
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("subscribe", topic)
        if servers:
            r = r.option("kafka.bootstrap.servers", servers)
        opts.setdefault("startingOffsets", "latest")
        for k, v in opts.items():
            r = r.option(k, v)
        try:
            return r.load()
        except Exception as e:  # noqa: BLE001
            if "kafka" in str(e).lower() and ("not find" in str(e).lower() or "failed to find" in str(e).lower()):
                raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the class path; "
                                   "use a file format (fmt='parquet' or 'json') otherwise") from e
            raise
    if not path:
        raise ValueError("a file source needs a path")
    r = spark.readStream.format(fmt).schema(schema or MESSAGE_SCHEMA)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


def write_readings(df: DataFrame, fmt: str = "kafka", path: str | None = None, topic: str = TOPIC,
                   servers: str | None = None, mode: str = "append", **opts) -> None:
    """Write messages (batch). For Kafka only ``key`` and ``value`` are sent."""
    if fmt == "kafka":
        w = df.select("key", "value").write.format("kafka").option("topic", topic)
        if servers:
            w = w.option("kafka.bootstrap.servers", servers)
        for k, v in opts.items():
            w = w.option(k, v)
        w.save()
        return
    if not path:
        raise ValueError("a file sink needs a path")
    w = df.write.mode(mode).format(fmt)
    for k, v in opts.items():
        w = w.option(k, v)
    w.save(path)
