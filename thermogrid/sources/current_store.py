"""The keyed ``current`` table as an append log with a latest view.

The reference upserts into a keyed store (primary key ``city_and_loc, time``,
last write wins). Here each micro-batch is written to its own folder
``log/batch_id=N`` with mode overwrite, so replaying a batch after a failure
rewrites the same folder instead of adding rows (idempotent); readers see the
newest row per key. ``compact_current`` folds the log into a snapshot
``snapshot/upto=N``; reads take the newest complete snapshot and the batches
behind it, by name, so neither a read nor a fold lists or scans folded data.
A row without a temperature says that the key's value has expired: the key has no
row until a newer one comes (the streams write none otherwise, bad values are quarantined).
Folders that the last but one snapshot has folded are deleted.

Batch ids must keep growing over the life of a store: a stream that starts on
a fresh checkpoint counts from 0 again and would be taken for folded batches.
``claim_checkpoint`` derives the checkpoint from the store and refuses that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermogrid.operators.readings import latest_by_key
from thermogrid.session import delete_path, list_names, path_exists

LOG_ORDER = ("batch_id", "timestamp", "partition", "offset")


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/log"


def _snapshots(path: str) -> str:
    return f"{path.rstrip('/')}/snapshot"


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    names = [n for n in list_names(spark, path) if n.startswith(prefix)]
    return sorted(int(n[len(prefix):]) for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def store_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the complete batch folders."""
    return _numbers(spark, _log(path), "batch_id=")


def store_snapshots(spark: SparkSession, path: str) -> list[int]:
    return _numbers(spark, _snapshots(path), "upto=")


def claim_checkpoint(spark: SparkSession, path: str, checkpoint: str | None, name: str) -> str:
    """The checkpoint folder of a stream into the store at ``path``: the given
    one, or ``path/checkpoint/name``, the same at every start. Fails if it is
    new while the store already holds batches."""
    checkpoint = (checkpoint or f"{path.rstrip('/')}/checkpoint/{name}").rstrip("/")
    fresh = not path_exists(spark, f"{checkpoint}/metadata")
    if fresh and (store_batches(spark, path) or store_snapshots(spark, path)):
        raise ValueError(f"{path} holds batches, but {checkpoint} is a new checkpoint: its batch ids would begin "
                         "at 0 again and newer readings would be taken for folded ones; use the store's checkpoint")
    return checkpoint


def upsert_current(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write one decoded micro-batch (``foreachBatch`` body)."""
    cols = [c for c in ("city_and_loc", "time", "temperature", "timestamp", "partition", "offset")
            if c in batch.columns]
    (batch.select(*cols).write.mode("overwrite")
     .parquet(f"{_log(path)}/batch_id={int(batch_id)}"))


def _rows(spark: SparkSession, path: str, snapshot: int | None, batches: list[int]) -> DataFrame:
    parts = []
    if snapshot is not None:
        parts.append(spark.read.parquet(f"{_snapshots(path)}/upto={snapshot}"))
    if batches:
        parts.append(spark.read.option("basePath", _log(path)).option("mergeSchema", "true")
                     .parquet(*[f"{_log(path)}/batch_id={n}" for n in batches])
                     .withColumn("batch_id", F.col("batch_id").cast("long")))
    if not parts:
        raise FileNotFoundError(f"no current table at {path}")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows


def _newest(rows: DataFrame) -> DataFrame:
    order = [c for c in LOG_ORDER if c in rows.columns]
    newest = F.max(F.struct(*order, "temperature"))
    return (rows.groupBy("city_and_loc", "time").agg(newest.alias("_n"))
            .select("city_and_loc", "time", *[F.col(f"_n.{c}").alias(c) for c in order],
                    F.col("_n.temperature").alias("temperature")).where(F.col("temperature").isNotNull()))


def read_current(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    """S3: newest row per ``(city_and_loc, time)`` over snapshot + log."""
    upto = max(store_snapshots(spark, path), default=None)
    batches = [n for n in store_batches(spark, path) if upto is None or n > upto]
    rows = _rows(spark, path, upto, batches)
    if with_order:
        return _newest(rows)
    newest = latest_by_key(rows, order=tuple(c for c in LOG_ORDER if c in rows.columns))
    return newest.where(F.col("temperature").isNotNull())


def compact_current(spark: SparkSession, path: str, clean: bool = True) -> int:
    """Fold snapshot + log into a new snapshot ``snapshot/upto=N`` (N = newest
    batch, also one without a good row). Returns N, or -1 when there is nothing
    to fold. With ``clean``, batches and snapshots that the previous snapshot
    already covered are deleted; readers that still use that one keep its files."""
    before = max(store_snapshots(spark, path), default=None)
    all_batches = store_batches(spark, path)
    batches = [n for n in all_batches if before is None or n > before]
    if not batches:
        return -1 if before is None else before
    upto = batches[-1]
    cur = _newest(_rows(spark, path, before, batches))
    if "batch_id" in cur.columns:
        cur = cur.withColumn("batch_id", F.col("batch_id").cast(T.LongType()))
    cur.write.mode("overwrite").parquet(f"{_snapshots(path)}/upto={upto}")
    if clean and before is not None:
        for n in all_batches:
            if n <= before:
                delete_path(spark, f"{_log(path)}/batch_id={n}")
        for n in store_snapshots(spark, path):
            if n < before:
                delete_path(spark, f"{_snapshots(path)}/upto={n}")
    return upto


def ensure_current_table(spark: SparkSession, name: str = "current", database: str | None = None) -> str:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` with the fixed schema."""
    full = f"{database}.{name}" if database else name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} "
              "(city_and_loc STRING, time INT, temperature FLOAT) USING parquet")
    return full
