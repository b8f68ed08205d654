"""Benchmark decontamination.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond
ASCII. A benchmark item gives the windows of its ``WINDOW`` consecutive words;
an item with fewer words, but not none, is one window. The windows' hashes
are broadcast as a sorted set and every text is scanned whole for them,
vectorised over the bytes of a batch; each hash hit is verified by
comparing the bytes of the words. A word inside any verified occurrence is hit.

The windows are built once, as arrays on the driver, and broadcast: at most those of
``max_broadcast_bytes`` of benchmark text at a time. A larger benchmark is scanned in
blocks of that size, and the hits of all blocks add up.

Edge cases: null, empty and word-less texts have no words and no hits; items
without words have no windows; repeated items and repeated rows count as often
as they stand there, but equal item_ids are listed once; a null item_id is listed
as the empty text. Other columns are not read, except that ``documents``
mode returns them as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import SpanHash, filled, flat_ranges, small_batches, text_chunks

WINDOW = 10
MAX_BROADCAST_BYTES = 16 << 20  # of text; its windows take about seven times as much

# byte -> itself for word characters (lower-cased), else a space
_WORD = np.full(256, 32, np.uint8)
_WORD[0x30:0x3A] = np.arange(0x30, 0x3A)
_WORD[0x61:0x7B] = np.arange(0x61, 0x7B)
_WORD[0x41:0x5B] = np.arange(0x61, 0x7B)
_WORD[0x80:] = np.arange(0x80, 0x100)


class Words:
    """Words of a run of texts: ``data`` is their bytes, one space behind each
    word, with the place of each word in ``data`` and in the original bytes; ``table``
    maps a byte to itself or lower case if it is of a word, else to a space."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = _WORD):
        x = table[raw]
        inside = x != 32
        # a text's end is the end of its last word
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < x.size)]
        start[cut] |= inside[cut]
        last[cut - 1] |= inside[cut - 1]
        self.raw_start, self.raw_end = np.flatnonzero(start), np.flatnonzero(last) + 1
        lens = self.raw_end - self.raw_start
        self.count = lens.size
        self.start = np.cumsum(lens + 1) - (lens + 1)
        self.end = self.start + lens
        self.data = np.full(int((lens + 1).sum()), 32, np.uint8)
        spot = np.ones(self.data.size, bool)
        spot[self.end] = False
        self.data[spot] = x[inside]
        self.of = np.searchsorted(offsets, self.raw_start, side="right") - 1


class Windows:
    """The benchmark's windows, by number of words, as arrays over one buffer of bytes: sorted
    hashes of the distinct windows, their places, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.hash = SpanHash(20)
        self.ids = [i for i, _ in items]
        raws = [(t or "").encode() for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
        w = Words(np.frombuffer(b"".join(raws), np.uint8), offsets)
        self.data, prefix = w.data, self.hash.prefix(w.data)
        count = np.bincount(w.of, minlength=len(items)) if len(items) else np.zeros(0, np.int64)
        first = np.cumsum(count) - count
        size = np.minimum(count, width)
        self.sets = []
        for n in np.unique(size[size > 0]).tolist():
            mine = np.flatnonzero(size == n)
            many = count[mine] - n + 1
            at, item = flat_ranges(first[mine], many), np.repeat(mine, many)
            self.sets.append(self._set(n, self.hash.spans(prefix, w.start[at], w.end[at + n - 1]), w.start[at], w.end[at + n - 1], item))
        self.hash = SpanHash(20)  # without the powers that it grew here

    def _set(self, n, h, start, end, item):
        order = np.lexsort((item, h))
        h, start, end, item = h[order], start[order], end[order], item[order]
        new = np.ones(h.size, bool)
        new[1:] = h[1:] != h[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        # the same window, not only the same hash, as the first of the run
        same = (end - start) == (end - start)[head]
        some = np.flatnonzero(same & ~new)
        lens = (end - start)[some]
        differ = self.data[flat_ranges(start[some], lens)] != self.data[flat_ranges(start[head[some]], lens)]
        same[some[np.unique(np.repeat(np.arange(some.size), lens)[differ])]] = False
        if not same.all():  # windows that share a hash: order these by their bytes
            odd = np.isin(h, h[~same])
            rank = {t: k for k, t in enumerate(sorted({self.data[a:b].tobytes() for a, b in zip(start[odd], end[odd])}))}
            kind = np.zeros(h.size, np.int64)
            kind[odd] = [rank[self.data[a:b].tobytes()] for a, b in zip(start[odd], end[odd])]
            order = np.lexsort((item, kind, h))
            h, start, end, item, kind = h[order], start[order], end[order], item[order], kind[order]
            new[1:] = (h[1:] != h[:-1]) | (kind[1:] != kind[:-1])
            new[0] = True
        at = np.flatnonzero(new)
        quick = np.zeros(1 << 16, bool)
        quick[h[at] >> np.uint64(48)] = True
        return n, h[at], quick, start[at], end[at], np.append(at, h.size), item

    def scan(self, w: Words):
        """(first word, words, item ids) of each verified occurrence."""
        if not w.count:
            return
        prefix = self.hash.prefix(w.data)
        for n, hashes, quick, start, end, first, item in self.sets:
            m = w.count - n + 1
            if m <= 0:
                continue
            h = self.hash.spans(prefix, w.start[:m], w.end[n - 1:])
            maybe = np.flatnonzero(quick[h >> np.uint64(48)] & (w.of[:m] == w.of[n - 1:]))
            at = np.searchsorted(hashes, h[maybe], side="left")
            same = hashes[np.minimum(at, hashes.size - 1)] == h[maybe]
            maybe, at = maybe[same], at[same]
            order = np.argsort(at, kind="stable")
            maybe, at = maybe[order], at[order]
            lows = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if at.size else at
            for i, j in zip(lows.tolist(), [*lows[1:].tolist(), at.size]):
                k, places = int(at[i]), maybe[i:j]
                while k < hashes.size and places.size:  # equal hashes stand together
                    text = self.data[start[k]:end[k]]
                    length = text.size
                    fit = places[w.end[places + n - 1] - w.start[places] == length]
                    step = max(1, (1 << 22) // length)
                    for q in range(0, fit.size, step):
                        part = fit[q:q + step]
                        equal = (w.data[w.start[part][:, None] + np.arange(length)] == text).all(axis=1)
                        yield part[equal], n, sorted({self.ids[x] for x in item[first[k]:first[k + 1]]})
                    if k + 1 >= hashes.size or hashes[k + 1] != hashes[k]:
                        break
                    k += 1


def benchmark_blocks(benchmark: DataFrame, max_bytes: int) -> list[list[tuple[str, str]]]:
    """The items, in lists of at most about ``max_bytes`` of text each; fetched
    one list at a time by a hash of the text when there is more than one."""
    small_batches(benchmark.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // max_bytes))
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == b)
        yield [(r.item_id, r.text) for r in part.toLocalIterator()]


def _marks(batch_col: pa.Array, windows: Windows, before, ids_before):
    """Per text: number of words, hit words, ids, spans of bytes; ``before`` are
    word ranges found by earlier blocks."""
    for i, rows, raw, offsets in text_chunks(batch_col):
        w = Words(raw, offsets)
        first = np.searchsorted(w.of, np.arange(rows + 1))
        delta = np.zeros(w.count + 1, np.int64)
        ids: list[set[str]] = [set(ids_before[i + j] or ()) for j in range(rows)]
        for j in range(rows):
            for s, e in zip(*[iter(before[i + j] or ())] * 2):
                delta[first[j] + s] += 1
                delta[first[j] + e] -= 1
        for places, n, items in windows.scan(w):
            np.add.at(delta, places, 1)
            np.add.at(delta, places + n, -1)
            for j in np.unique(w.of[places]).tolist():
                ids[j].update(items)
        hit = np.cumsum(delta)[:w.count] > 0
        edge = hit.copy()
        edge[1:] &= ~(hit[:-1] & (w.of[1:] == w.of[:-1]))
        tail = hit.copy()
        tail[:-1] &= ~(hit[1:] & (w.of[1:] == w.of[:-1]))
        s, e = np.flatnonzero(edge), np.flatnonzero(tail)
        own = np.searchsorted(w.of[s], np.arange(rows + 1))
        total = np.concatenate([[0], np.cumsum(hit)])
        for j in range(rows):
            a, b = own[j], own[j + 1]
            ranges = np.stack([s[a:b] - first[j], e[a:b] + 1 - first[j]], axis=1).ravel().tolist()
            places = np.stack([w.raw_start[s[a:b]], w.raw_end[e[a:b]]], axis=1) - offsets[j]
            yield (int(first[j + 1] - first[j]), int(total[first[j + 1]] - total[first[j]]), sorted(ids[j]),
                   ranges, places.tolist())


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           width: int = WINDOW, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(id, n_words, n_hit, items array<string> sorted, spans array of UTF-8
    byte ranges [start, end) of the hit words), one row per row of ``docs``."""
    cur = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      F.array().cast("array<int>").alias("ranges"), F.array().cast("array<string>").alias("items"))
    kind = cur.schema["doc_id"].dataType.simpleString()
    blocks = benchmark_blocks(benchmark, max_broadcast_bytes)
    ahead = next(blocks)
    while ahead is not None:
        shared, ahead = docs.sparkSession.sparkContext.broadcast(Windows(ahead, width)), next(blocks, None)
        cur = _scan(cur, kind, shared, last=ahead is None)
    return cur.withColumnRenamed("doc_id", id_col)


def _scan(cur: DataFrame, kind: str, shared, last: bool) -> DataFrame:
    def run(batches):
        windows = shared.value
        for batch in batches:
            rows = list(_marks(batch.column(1), windows, batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            n, hit, ids, ranges, spans = zip(*rows) if rows else ((),) * 5
            if last:
                spans = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans],
                                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(hit, pa.int64()),
                     pa.array(ids, pa.list_(pa.string())), spans], names=["doc_id", "n_words", "n_hit", "items", "spans"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(ranges, pa.list_(pa.int32())),
                     pa.array(ids, pa.list_(pa.string()))], names=["doc_id", "text", "ranges", "items"])

    return cur.mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, items array<string>, "
                               "spans array<struct<start:int,end:int>>" if last else
                          f"doc_id {kind}, text string, ranges array<int>, items array<string>")


def cut_spans(raw: bytes, spans) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join(out) + raw[at:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text",
                  width: int = WINDOW, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` with all its columns, without the rows that hold a window
    (``documents``) or without the hit words (``spans``; untouched texts stay as
    they are, null included). Rows and columns are passed through the scan whole."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode {mode!r}")
    at, cur = docs.columns.index(text_col), docs
    for items in benchmark_blocks(benchmark, max_broadcast_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Windows(items, width))

        def run(batches, shared=shared):
            windows = shared.value
            for batch in batches:
                col = filled(batch.column(at))
                rows = list(_marks(col, windows, [()] * len(col), [()] * len(col)))
                if mode == "documents":
                    yield batch.filter(pa.array([r[1] == 0 for r in rows], pa.bool_()))
                    continue
                texts = batch.column(at).to_pylist()
                for i, r in enumerate(rows):
                    if r[1]:
                        texts[i] = cut_spans(texts[i].encode(), r[4]).decode()
                yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

        cur = cur.mapInArrow(run, docs.schema)
    return cur


def op2_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    got = report(docs, benchmark)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
with low as (
  select 'd' as kind, doc_id::varchar as id, text as t, row_number() over () as r from documents union all
  select 'i', coalesce(item_id::varchar, ''), text, -row_number() over () from benchmark),
toks as (
  select kind, id, r, regexp_extract_all(translate(coalesce(t, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from low),
items as (
  select id, w, least(len(w), 10) as n from toks where kind = 'i' and len(w) > 0),
wins as (
  select distinct id, n, array_to_string(w[k:k + n - 1], ' ') as win
  from (select id, w, n, unnest(range(1, len(w) - n + 2)) as k from items)),
sizes as (select distinct n from wins),
grams as (
  select r, k, n, array_to_string(w[k:k + n - 1], ' ') as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k
        from toks, sizes where kind = 'd' and len(w) >= n)),
hits as (select g.r, g.k, g.n, wins.id as item from grams g join wins on g.n = wins.n and g.win = wins.win),
words as (select r, count(distinct p) as n_hit
          from (select r, unnest(range(k, k + n)) as p from (select distinct r, k, n from hits)) group by r),
found as (select r, count(*) as n_items, string_agg(item, ',' order by item) as ids
          from (select distinct r, item from hits) group by r)
select t.id::bigint as doc_id, len(t.w)::bigint as n_words, coalesce(words.n_hit, 0)::bigint as n_hit,
       coalesce(found.n_items, 0)::bigint as n_items, sha256(coalesce(found.ids, '')) as items_sha256,
       coalesce(words.n_hit, 0) > 0 as contaminated
from toks t left join words using (r) left join found using (r) where t.kind = 'd'
"""
