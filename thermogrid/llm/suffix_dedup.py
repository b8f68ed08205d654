"""Removal of repeated 200-byte strings by a sparse difference-cover suffix order.

A suffix order over every byte would write some fifty bytes per byte of text. Only
equality of prefixes of ``WIDTH`` bytes matters here, so the sample is sparse: the
positions whose ``GRAM``-byte string has the least hash among the starts of a
window. It is a difference cover for this purpose: two positions that begin
equal windows have a sample at the same distance ahead, and one position in
about 80 is sampled. Around it the difference-cover steps are:

1. Sampled strings are named by a triple: what stands before the sample, its gram and
   what stands behind it, as far as the windows that belong to the sample reach. Equal
   triples settle all their windows at once; a gram that stands alone settles them too.
2. The rest recurses on names: a sample's windows fall into bands of ``BAND`` distances
   from it. Each band is named by the bytes that all its windows share, and by all its bytes.
3. The remaining suffixes are merged in: the single windows of bands still open are named
   by gram, distance and their own bytes. Rows with equal names are neighbours in this
   order; two neighbours with equal names share a prefix of ``WIDTH`` bytes.

Names are pairs of 64-bit hashes, so a level is a grouped count with partial sums and a
join back, both of which split when one name holds many of the rows.

Edge cases: null is empty; a text below ``WIDTH`` bytes loses nothing; overlapping
occurrences inside one text count; every copy of a repeated string goes, the first
included. Texts beyond ``PIECE`` bytes are read in overlapping pieces, whole. Rows
with equal ids are rows. ``docs`` is read once, rows are
numbered in a written table. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import (SpanHash, discard, discard_paths, flat_ranges, intermediates, mix, stored, text_chunks,
                                   with_row_id)

# Bytes of text per vectorised step: its arrays of 8 bytes per byte stay in the cache.
STEP = 1 << 18

WIDTH = 200
GRAM = 64
BAND = 13
PIECE = 1 << 22

_GRAMS, _NAMES = SpanHash(31), SpanHash(32)
_TOP = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def samples(x: np.ndarray, ends: np.ndarray):
    """For the windows of a run of texts ``x`` that end at ``ends``: the samples
    with gram hash, first and last window start, and name of the whole context."""
    reach = WIDTH - GRAM + 1  # starts of grams inside a window
    n = x.size - GRAM + 1
    prefix = _GRAMS.prefix(x)
    at = np.arange(n)
    gram = _GRAMS.spans(prefix, at, at + GRAM)
    # hash above, place below: the least is the leftmost of equal hashes
    value = np.full(-(-n // reach) * reach, _FULL)
    value[:n] = (gram & _TOP) | at.astype(np.uint64)
    rows = value.reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - reach + 1
    best = (np.minimum(behind[:m], ahead[reach - 1:reach - 1 + m]) & _LOW).astype(np.int64)
    # windows do not cross the end of a text
    p = at[:m]
    of = np.repeat(np.arange(ends.size), np.diff(np.concatenate([[0], ends])))[:m]
    inside = p + WIDTH <= ends[of]
    p, best, of = p[inside], best[inside], of[inside]
    if not p.size:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    new = np.ones(p.size, bool)
    new[1:] = (best[1:] != best[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], p.size) - 1
    a, lo, hi = best[first], p[first], p[last]
    return a, lo, hi, gram[a], _named(_NAMES, _NAMES.prefix(x), a, lo, hi)


def _named(hashes: SpanHash, prefix: np.ndarray, a, lo, hi) -> np.ndarray:
    """Name of the bytes of the windows lo..hi and their place around the sample."""
    with np.errstate(over="ignore"):
        return mix(hashes.spans(prefix, lo, hi + WIDTH) + ((a - lo) * 4096 + (hi - lo)).astype(np.uint64))


SAMPLES = "sid long, row long, a int, lo int, hi int, gram long, name long"


def _sampled(src: DataFrame) -> DataFrame:
    """All samples of ``src`` (_row, text); places are bytes of the text."""
    def run(batches):
        sid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, rows, raw, offsets in text_chunks(batch.column(1), STEP):
                ident = batch.column(0).slice(i, rows).to_numpy()
                step = max(PIECE, WIDTH) if rows == 1 else raw.size
                for base in range(0, max(raw.size, 1), step):
                    x = raw[base:base + step + WIDTH - 1]
                    if x.size < WIDTH:
                        continue
                    ends = offsets[1:] if rows > 1 else np.array([x.size])
                    a, lo, hi, gram, name = samples(x, ends)
                    of = np.searchsorted(ends, lo, side="right")
                    shift = base - offsets[of]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(sid, sid + a.size)), pa.array(ident[of]),
                         *[pa.array((v + shift).astype(np.int32)) for v in (a, lo, hi)],
                         pa.array(gram.view(np.int64)), pa.array(name.view(np.int64))],
                        names=["sid", "row", "a", "lo", "hi", "gram", "name"])
                    sid += a.size

    return src.select("_row", "text").mapInArrow(run, SAMPLES)


def settled(rows: DataFrame, group: list[str], name: str, count, label: str):
    """One level. ``rows`` carry a group, a name and how many strings they stand for.
    Returns (repeated, open, tables): rows whose name occurs twice, one row per name of
    groups with several names, with ``total`` strings, for the next level, and the
    written tables that both read."""
    keys = stored(rows.groupBy(*group).agg(F.sum(count).alias("t"), F.min(name).alias("x"), F.max(name).alias("y"))
                  .where("t > 1"), label)
    met = stored(rows.join(keys, group), label)
    discard(keys)
    one = met.where("x = y").drop("t", "x", "y")
    many = met.where("x <> y").drop("t", "x", "y")
    names = stored(many.groupBy(*group, name).agg(F.sum(count).alias("total"), F.min("sid").alias("head")), label)
    several = stored(many.join(names, [*group, name]), label)
    discard(names)
    columns = one.columns
    return (one.unionByName(several.where("total > 1").select(*columns)),
            several.where("sid = head").select(*columns, "total"), (met, several))


def _contexts(src: DataFrame, open_: DataFrame) -> DataFrame:
    """``open_`` with the bytes of each sample's windows."""
    lists = open_.groupBy("row").agg(F.collect_list(F.struct("sid", "a", "lo", "hi", "gram", "total")).alias("s"))
    both = src.join(lists.withColumnRenamed("row", "_row"), "_row").select("_row", "text", "s")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                lists = part.column(2)
                of = np.repeat(np.arange(part.num_rows), [len(x) for x in lists])
                s = lists.flatten().flatten()
                lo, hi = s[2].to_numpy().tolist(), (s[3].to_numpy() + WIDTH).tolist()
                raws = [(t or "").encode() for t in part.column(1).to_pylist()]
                data = pa.array([raws[i][b:e] for i, b, e in zip(of.tolist(), lo, hi)], pa.binary())
                yield pa.RecordBatch.from_arrays([s[0], part.column(0).take(pa.array(of)), *s[1:], data],
                                                 names=["sid", "row", "a", "lo", "hi", "gram", "total", "data"])

    return both.mapInArrow(run, "sid long, row long, a int, lo int, hi int, gram long, total long, data binary")


def _joined_data(col: pa.Array):
    """Bytes of a binary column and the place of each value."""
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    return np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]], off[:-1] - off[0]


BANDS = "sid long, row long, a int, lo int, hi int, gram long, total long, band int, core long, name long"


def _bands(contexts: DataFrame) -> DataFrame:
    """The windows of each context by band of distances from the sample."""
    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                a, lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in (2, 3, 4))
                x, place = _joined_data(batch.column(7))
                near, far = (a - hi) // BAND, (a - lo) // BAND
                of = np.repeat(np.arange(a.size), far - near + 1)
                band = flat_ranges(near, far - near + 1)
                first = np.maximum(lo[of], a[of] - (band * BAND + BAND - 1))
                last = np.minimum(hi[of], a[of] - band * BAND)
                shift = place[of] - lo[of]
                prefix = _NAMES.prefix(x)
                # the bytes that all windows of the band share, whatever part of it the sample has
                core = _NAMES.spans(prefix, a[of] - band * BAND + shift,
                                    a[of] - (band * BAND + BAND - 1) + WIDTH + shift)
                name = _named(_NAMES, prefix, a[of] + shift, first + shift, last + shift)
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take),
                     pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), batch.column(5).take(take),
                     batch.column(6).take(take), pa.array(band.astype(np.int32)), pa.array(core.view(np.int64)),
                     pa.array(name.view(np.int64))],
                    names=["sid", "row", "a", "lo", "hi", "gram", "total", "band", "core", "name"])

    return contexts.mapInArrow(run, BANDS)


def _windows(open_: DataFrame, contexts: DataFrame) -> DataFrame:
    """The single windows of the bands still open."""
    held = contexts.select("sid", F.col("lo").alias("from"), "data")
    rows = open_.select("sid", "row", "a", "lo", "hi", "gram", "total").join(held, "sid")

    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                a, lo, hi, start = (batch.column(c).to_numpy().astype(np.int64) for c in (2, 3, 4, 7))
                x, place = _joined_data(batch.column(8))
                of = np.repeat(np.arange(a.size), hi - lo + 1)
                p = flat_ranges(lo, hi - lo + 1)
                at = p - start[of] + place[of]
                name = _NAMES.spans(_NAMES.prefix(x), at, at + WIDTH)
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(take), pa.array(p.astype(np.int32)), batch.column(5).take(take),
                     pa.array((a[of] - p).astype(np.int32)), batch.column(6).take(take), pa.array(name.view(np.int64))],
                    names=["row", "lo", "gram", "distance", "total", "name"])

    return rows.mapInArrow(run, "row long, lo int, gram long, distance int, total long, name long")


def repeated_windows(src: DataFrame) -> DataFrame:
    """(row, lo, hi): runs of starts of repeated windows, for ``src`` (_row, text)."""
    level1 = stored(_sampled(src), "samples")
    same, open1, held = settled(level1.withColumn("one", F.lit(1)), ["gram"], "name", F.col("one"), "names")
    discard(level1)
    first = stored(same.select("row", "lo", "hi"), "runs")
    contexts = stored(_contexts(src, open1), "contexts")
    discard(*held)
    same2, open2, held = settled(_bands(contexts).withColumnRenamed("total", "n"), ["gram", "band", "core"], "name", F.col("n"), "band-names")
    # what stands for several equal contexts is settled above; it is only compared with
    second = stored(same2.where("n = 1").select("row", "lo", "hi"), "runs")
    last = stored(_windows(open2.drop("n"), contexts), "windows")
    discard(contexts, *held)
    twice = stored(last.groupBy("gram", "distance", "name").agg(F.sum("total").alias("t")).where("t > 1"), "window-names")
    third = stored(last.where("total = 1").join(twice, ["gram", "distance", "name"])
                   .select("row", "lo", F.col("lo").alias("hi")), "runs")
    discard(last, twice)
    return first.unionByName(second).unionByName(third)


def merged(lo: np.ndarray, hi: np.ndarray):
    """Maximal runs of bytes covered by the windows that start in lo..hi."""
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], hi[order] + WIDTH
    far = np.maximum.accumulate(end)
    new = np.ones(lo.size, bool)
    new[1:] = lo[1:] > far[:-1]
    first = np.flatnonzero(new)
    return lo[first], far[np.append(first[1:], lo.size) - 1]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans array<struct<start,end>> of removed bytes, kept binary),
    one row per row of ``docs``."""
    src = stored(with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "_row"), "numbered")
    runs = (repeated_windows(src.select("_row", "text")).groupBy(F.col("row").alias("_row"))
            .agg(F.collect_list(F.struct("lo", "hi")).alias("runs")))
    both = src.join(stored(runs, "removed-runs"), "_row", "left").select("doc_id", "text", "runs")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 200):
                batch = whole.slice(k, 200)
                size, spans, kept = [], [], []
                for text, runs in zip(batch.column(1), batch.column(2)):
                    raw = (text.as_py() or "").encode()
                    size.append(len(raw))
                    if not runs.is_valid:
                        spans.append([])
                        kept.append(raw)
                        continue
                    lo, hi = (v.to_numpy().astype(np.int64) for v in runs.values.flatten())
                    s, e = merged(lo, hi)
                    spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())])
                    edges = [0, *np.stack([s, e], axis=1).ravel().tolist(), len(raw)]
                    kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(run, f"doc_id {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary") \
        .withColumnRenamed("doc_id", id_col)


def op3_suffix_dedup(docs: DataFrame) -> DataFrame:
    with intermediates() as made:
        got = remove_repeats(docs)
        out = stored(got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                                F.size("spans").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256")),
                     "kept-digests")
    discard_paths(docs.sparkSession, made, out)
    return out
