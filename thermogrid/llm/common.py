"""Helpers shared by the corpus operators."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermogrid.session import delete_path, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of text that one vectorised step takes. A longer single text is still
# processed whole; this only bounds the numpy temporaries for ordinary ones.
CHUNK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of one Arrow batch: a row may hold a long text, and a batch stands in
# memory several times on its way through a Python worker.
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
# While a step is written: its shuffle files go when its table is complete.
STEP_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows from here on in this session;
    a smaller setting stays."""
    if not 0 < int(spark.conf.get(BATCH_KEY, "10000")) <= BATCH_ROWS:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, and the files outlive any executor."""
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    before = {k: spark.conf.get(k, None) for k in STEP_CONF}
    for k, v in STEP_CONF.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    for made in _SCOPES:
        made.append(path)
    return out


# Lists that the paths of tables written by :func:`stored` are added to.
_SCOPES: list[list[str]] = []


@contextmanager
def intermediates():
    """The list of paths that :func:`stored` writes inside the ``with`` block."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES[:] = [x for x in _SCOPES if x is not made]


def discard_paths(spark: SparkSession, paths: list[str], reader: DataFrame | None = None) -> list[str]:
    """Delete those of ``paths`` that ``reader`` does not read. Returns the others."""
    files = reader.inputFiles() if reader is not None else []
    kept = [p for p in paths if any(f"/{p.rstrip('/').rsplit('/', 1)[-1]}/" in f for f in files)]
    for p in set(paths) - set(kept):
        delete_path(spark, p)
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete the files of :func:`stored` tables that nothing will read again; other
    DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "stored_path", None) if "stored_path" in vars(df) else None
        if path:
            delete_path(df.sparkSession, path)


def lower_ascii(c):
    """A-Z to a-z, all other characters unchanged."""
    return F.translate(c, UPPER, LOWER)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A number for every row, equal texts and repeated ids included. Call
    :func:`stored` on the result before using it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def filled(col: pa.Array) -> pa.Array:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col, "") if col.null_count else col


def text_chunks(col: pa.Array, limit: int = CHUNK_BYTES):
    """Walk a string column in pieces of about ``limit`` bytes. Yields (first
    row, rows, bytes of these rows as uint8, offsets into them); null is empty."""
    col = filled(col)
    n = len(col)
    if not n:
        return
    bufs = col.buffers()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j - i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def flat_ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges [start, start + len)."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


class KeyTable:
    """Open-addressing hash table from uint64 keys to int32 values, filled and
    probed with whole arrays. Keys are distinct; ``EMPTY`` is not a key."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, self.EMPTY, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)
        keys, values = keys.astype(np.uint64), values.astype(np.int32)
        slot = self._slot(keys)
        while keys.size:
            _, first = np.unique(slot, return_index=True)
            take = np.zeros(keys.size, bool)
            take[first] = True
            take &= self.keys[slot] == self.EMPTY
            self.keys[slot[take]], self.values[slot[take]] = keys[take], values[take]
            keys, values, slot = keys[~take], values[~take], (slot[~take] + 1) & self.mask

    def _slot(self, keys):
        return ((keys * self.MULT) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        out = np.full(keys.size, missing, np.int32)
        slot = self._slot(keys)
        k = self.keys[slot]
        hit = k == keys
        out[hit] = self.values[slot[hit]]
        rest = np.flatnonzero(~hit & (k != self.EMPTY))
        slot = (slot[rest] + 1) & self.mask
        while rest.size:
            k = self.keys[slot]
            hit = k == keys[rest]
            out[rest[hit]] = self.values[slot[hit]]
            go = ~hit & (k != self.EMPTY)
            rest, slot = rest[go], (slot[go] + 1) & self.mask
        return out


class SpanHash:
    """64-bit hash of any byte range after one pass: prefix sums of
    table[byte] * base**i modulo 2**64, shifted back by the inverse of base**start."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rng.integers(1 << 61)) * 8 + 5) % (1 << 64)  # 5 mod 8: full period, invertible
        self.inverse = pow(self.base, -1, 1 << 64)
        self.pow = np.ones(1, np.uint64)
        self.inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while self.pow.size <= n:
            m = self.pow.size
            with np.errstate(over="ignore"):
                self.pow = np.concatenate([self.pow, self.pow * np.uint64(pow(self.base, m, 1 << 64))])
                self.inv = np.concatenate([self.inv, self.inv * np.uint64(pow(self.inverse, m, 1 << 64))])

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(data.size + 1)
        out = np.zeros(data.size + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.table[data] * self.pow[:data.size], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each pair. The low bits of a product
        modulo 2**64 are weak, so the result is mixed once more."""
        with np.errstate(over="ignore"):
            h = (prefix[ends] - prefix[starts]) * self.inv[starts]
            return mix(h)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))
