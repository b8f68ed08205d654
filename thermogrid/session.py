"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine depends on for correct results, not for speed:
# UTC so that hour-of-day and day-of-year do not move with the host zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that shape the plans: AQE re-plans joins and coalesces partitions at
# run time, and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not JIT-compile methods above 8000 bytes of bytecode; a
    # fused stage beyond that runs interpreted (several times slower). Above
    # this size Spark keeps per-operator generated code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    # remove checkpoint files once the DataFrame that wrote them is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "thermogrid",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``master`` is only set when given, so that a cluster submit keeps its own.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only a local master may
    leave it unset: then a fresh folder is created and registered. On a cluster
    a folder of the driver's machine would be useless to the executors.
    """
    sc = spark.sparkContext
    d = sc._jsc.sc().getCheckpointDir()
    if d.isDefined():
        return d.get()
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not str(sc.master).startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="thermogrid-ckpt-")
    sc.setCheckpointDir(d)
    got = sc._jsc.sc().getCheckpointDir()
    return got.get() if got.isDefined() else d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub folder below the checkpoint root (never reused)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def work_partitions(units: int, per_partition: int) -> int:
    """Partitions for compute-heavy work of ``units`` items (cells, lines).

    Byte-size based coalescing (AQE) would put a small-but-expensive input in
    one task; this count follows the work instead.
    """
    return max(1, -(-int(units) // max(1, int(per_partition))))


# ------------------------------------------------------------ folders

def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any Hadoop file system; [] when it is missing."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    return [str(x.getPath().getName()) for x in fs.listStatus(p)]


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)
    if not fs.rename(_file_system(spark, new)[1], p):
        raise OSError(f"could not move {new} to {path}")
