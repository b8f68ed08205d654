"""A 2-D ``.npy`` array (the land mask) as a Spark data source.

Python Data Source API: the array header is read once on the driver (shape
and dtype only); each input partition is a block of rows that an executor
memory-maps and turns into Arrow batches ``r, c, <column>``. The file must be
on storage that every executor can read. An array in a store that only Spark
reads (any other URI scheme) comes through Spark's binary file source instead:
one row and task, for arrays of a grid's size.
"""

from __future__ import annotations

import io
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class RowBlock(InputPartition):
    def __init__(self, start: int, stop: int):
        super().__init__((start, stop))
        self.start = start
        self.stop = stop


def _header(path: str):
    arr = np.load(path, mmap_mode="r", allow_pickle=False)
    if arr.ndim != 2:
        raise ValueError(f"{path}: expected a 2-D array, got shape {arr.shape}")
    return arr.shape, arr.dtype


def _spark_type(dtype) -> str:
    if dtype == np.bool_:
        return "boolean"
    if np.issubdtype(dtype, np.integer):
        return "bigint"
    return "double"


class NpyGridDataSource(DataSource):
    """Options: ``path`` (required), ``column`` (default ``land`` for boolean
    arrays, ``v`` otherwise), ``rowsPerPartition`` (default 64)."""

    @classmethod
    def name(cls):
        return "npygrid"

    def _column(self, dtype) -> str:
        return self.options.get("column") or ("land" if dtype == np.bool_ else "v")

    def schema(self):
        _, dtype = _header(self.options["path"])
        return f"r int, c int, {self._column(dtype)} {_spark_type(dtype)}"

    def reader(self, schema):
        return NpyGridReader(self.options, self._column(_header(self.options["path"])[1]))


class NpyGridReader(DataSourceReader):
    def __init__(self, options, column: str):
        self.path = options["path"]
        self.rows_per_part = int(options.get("rowsPerPartition", 64))
        self.column = column

    def partitions(self):
        (rows, _), _ = _header(self.path)
        step = max(1, self.rows_per_part)
        return [RowBlock(s, min(rows, s + step)) for s in range(0, rows, step)]

    def read(self, partition):
        arr = np.load(self.path, mmap_mode="r", allow_pickle=False)
        yield _rows(arr, partition.start, partition.stop, self.column)


def _rows(arr: np.ndarray, start: int, stop: int, column: str) -> pa.RecordBatch:
    cols = arr.shape[1]
    block = np.asarray(arr[start:stop])
    n = block.shape[0]
    r = np.repeat(np.arange(start, start + n, dtype=np.int32), cols)
    c = np.tile(np.arange(cols, dtype=np.int32), n)
    vals = block.reshape(-1)
    if vals.dtype == np.bool_:
        v = pa.array(vals, type=pa.bool_())
    elif np.issubdtype(vals.dtype, np.integer):
        v = pa.array(vals.astype(np.int64))
    else:
        f = vals.astype(np.float64)
        v = pa.array(f, mask=np.isnan(f))  # NaN means "no data": null
    return pa.RecordBatch.from_arrays([pa.array(r), pa.array(c), v], names=["r", "c", column])


def _read_binary(spark: SparkSession, path: str, column: str | None, rows_per_batch: int) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    head = files.select(files.content.substr(1, 4096).alias("h")).first().h  # the array's header
    version = np.lib.format.read_magic(f := io.BytesIO(bytes(head)))
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, _, dtype = read(f)
    if len(shape) != 2:
        raise ValueError(f"{path}: expected a 2-D array, got shape {shape}")
    name = column or ("land" if dtype == np.bool_ else "v")

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                arr = np.load(io.BytesIO(content.as_py()), allow_pickle=False)
                for s in range(0, arr.shape[0], rows_per_batch):
                    yield _rows(arr, s, s + rows_per_batch, name)

    return files.select("content").mapInArrow(run, f"r int, c int, {name} {_spark_type(dtype)}")


def read_npy_grid(spark: SparkSession, path: str, column: str | None = None,
                  rows_per_partition: int = 64) -> DataFrame:
    """Load a 2-D array as ``r, c, <column>`` rows."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme and scheme[1].lower() != "file":
        return _read_binary(spark, path, column, rows_per_partition)
    path = re.sub(r"^file:/*(?=/)", "", path)
    spark.dataSource.register(NpyGridDataSource)
    r = spark.read.format("npygrid").option("path", path).option("rowsPerPartition", str(rows_per_partition))
    if column:
        r = r.option("column", column)
    return r.load()
