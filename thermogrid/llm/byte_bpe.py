"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

Texts are cut by the tokenizer's pattern; every distinct piece is encoded once
per worker. Pieces become rows of padded numpy matrices, one matrix for each
length class; in every round each row merges its leftmost pair of least rank,
found through a hashed pair table, and the row closes the gap.

Edge cases: a null or empty text has no ids and decodes to no bytes; a piece
that is itself in the vocabulary is one id; a piece longer than the widest
matrix is merged with a heap, in the same order. Equal rows give equal results
and no row is dropped; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import heapq
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import KeyTable, filled, flat_ranges, small_batches

WIDEST = 2048          # longest piece in bytes that goes into a matrix
CELLS = 1 << 20        # cells of one matrix
KEEP = 400_000         # pieces that a worker remembers before it starts anew
TEXT_STEP = 1 << 21    # characters of text per step
NO_MERGE = np.int32(2**31 - 1)
FIRST = np.uint64(32)

# The letters, numbers and white space of Latin-1, for texts that hold no other
# character: the default pattern's classes as plain ranges, which the standard
# library scans faster than Unicode properties.
LATIN = {"L": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "N": "0-9\xb2\xb3\xb9\xbc-\xbe", "S": "\t-\r \x85\xa0"}


def latin_pattern(pattern: str):
    """The default pattern over Latin-1; None for another pattern."""
    import public_tokenizers as P
    if pattern != P.PATTERN:
        return None
    c = LATIN
    return re.compile(f" ?[{c['L']}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{c['N']}]+| ?[^{c['S']}{c['L']}{c['N']}]+"
                      f"|[{c['S']}]+(?![^{c['S']}])|[{c['S']}]+")


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Vocabulary:
    """Ranks, the bytes of each id and the pair table."""

    def __init__(self, raw: bytes, pattern: str):
        self.bytes_of = tokens(raw)
        self.rank = {token: r for r, token in enumerate(self.bytes_of) if token}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        keys, merged = [], []
        for token, r in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(r)
        self.pairs = KeyTable(np.array(keys, np.uint64), np.array(merged, np.int32))
        self.pair: dict[int, int] | None = None  # the same pairs, for pieces beyond the widest matrix
        # Whitespace is Unicode White_Space; the information separators
        # U+001C..U+001F are not in it.
        self.pattern = regex.compile(pattern)
        self.latin = latin_pattern(pattern)
        self.clear()

    def clear(self) -> None:
        self.known = Numbering()
        self.start, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    # ------------------------------------------------------------ merging

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.uint64) << FIRST) | right.astype(np.uint64)
        out = self.pairs.get(key, int(NO_MERGE))
        out[(left < 0) | (right < 0)] = NO_MERGE
        return out

    def _merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """ids: rows of token ids padded with -1; merged in place."""
        n, width = ids.shape
        done, where = np.full((n, width), -1, np.int32), np.arange(n)
        rank = self._ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        cols = np.arange(width)
        while True:
            at = rank.argmin(axis=1)  # the first of equal minima: the leftmost pair
            least = rank[np.arange(len(ids)), at]
            over = least == NO_MERGE
            if over.any():
                done[where[over], :ids.shape[1]] = ids[over]
                live = ~over
                ids, rank, where, at, least = ids[live], rank[live], where[live], at[live], least[live]
            if not len(ids):
                return done
            r = np.arange(len(ids))
            ids[r, at] = least
            # close the gap behind the merged pair
            width = ids.shape[1] - 1
            move = cols[:width][None, :] + (cols[:width][None, :] > at[:, None])
            ids = np.take_along_axis(ids, move, axis=1)
            if width == 1:
                done[where, :1] = ids
                return done
            pair = cols[:width - 1][None, :] + (cols[:width - 1][None, :] > at[:, None])
            rank = np.take_along_axis(rank, pair, axis=1)
            before = at > 0
            rank[r[before], at[before] - 1] = self._ranks(ids[r[before], at[before] - 1], ids[r[before], at[before]])
            after = at < width - 1
            rank[r[after], at[after]] = self._ranks(ids[r[after], at[after]], ids[r[after], at[after] + 1])

    def _merge_long(self, piece: bytes) -> list[int]:
        if self.pair is None:
            used = self.pairs.keys != KeyTable.EMPTY
            self.pair = dict(zip(self.pairs.keys[used].tolist(), self.pairs.values[used].tolist()))
        ids = [int(self.byte_id[b]) for b in piece]
        n = len(ids)
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = []

        def offer(i):
            if i >= 0 and right[i] < n:
                r = self.pair.get(ids[i] << 32 | ids[right[i]])
                if r is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[right[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], alive[j], right[i] = r, False, right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [ids[i] for i in range(n) if alive[i]]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and the concatenated ids, in the order of the pieces."""
        n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, n)
        ends = np.cumsum(size)
        data = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        whole = np.fromiter((self.rank.get(p, -1) for p in pieces), np.int64, n)
        got = np.where(whole >= 0, 1, 0)
        found = [(np.flatnonzero(whole >= 0), whole[whole >= 0].astype(np.int32))]  # pieces, their ids in order
        for i in np.flatnonzero((whole < 0) & (size > WIDEST)).tolist():
            ids = self._merge_long(pieces[i])
            got[i] = len(ids)
            found.append((np.array([i]), np.array(ids, np.int32)))
        low, high = 0, 2
        while low < WIDEST:
            members = np.flatnonzero((whole < 0) & (size > low) & (size <= high))
            step = max(1, CELLS // high)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                inside = np.arange(high)[None, :] < size[part][:, None]
                ids = np.full((len(part), high), -1, np.int32)
                ids[inside] = data[flat_ranges(ends[part] - size[part], size[part])]
                merged = self._merge_rows(ids)
                used = merged >= 0
                got[part] = used.sum(axis=1)
                found.append((part, merged[used]))
            low, high = high, 2 * high
        first = np.cumsum(got) - got
        flat = np.zeros(int(got.sum()), np.int32)
        for part, ids in found:
            flat[flat_ranges(first[part], got[part])] = ids
        return got, flat

    # ------------------------------------------------------------ texts

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text and all ids."""
        if len(self.known) > KEEP:
            self.clear()
        number = self.known.__getitem__
        parts, counts = [], []
        for t in texts:
            got = (self.latin if self.latin and is_latin(t) else self.pattern).findall(t)
            counts.append(len(got))
            parts.append(np.fromiter(map(number, got), np.int64, len(got)))
        if self.known.new:
            lens, flat = self.encode_pieces([p.encode() for p in self.known.new])
            base = self.flat.size
            self.start = np.concatenate([self.start, base + np.cumsum(lens) - lens])
            self.length = np.concatenate([self.length, lens])
            self.flat = np.concatenate([self.flat, flat])
            self.known.new.clear()
        which = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        lens = self.length[which]
        ends = np.concatenate([[0], np.cumsum(lens)])
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return np.diff(ends[bounds]), self.flat[flat_ranges(self.start[which], lens)]

    def decode_ids(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def tokens(raw: bytes) -> list[bytes]:
    """The bytes of each id (empty for an id that the file lacks)."""
    rank = {int(r): base64.b64decode(t) for t, r in map(bytes.split, filter(None, raw.splitlines()))}
    return [rank.get(i, b"") for i in range(max(rank) + 1)]


class Numbering(dict):
    """Numbers pieces in the order they are met."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece):
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """One vocabulary per worker process."""
    raw, pattern = shared.value
    key = hash((raw, pattern))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(raw, pattern)
    return _LOADED[key]


def _shared(df: DataFrame, ranks_path: str | None, pattern: str | None):
    """The rank file (a fixed file of under 1 MB) and the pattern, broadcast."""
    import public_tokenizers as P
    small_batches(df.sparkSession)
    with open(ranks_path or P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        raw = f.read()
    return df.sparkSession.sparkContext.broadcast((raw, pattern or P.PATTERN))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """One row (id, ids array<int>) for each row of ``docs``; with ``decoded`` also
    the bytes that the ids decode to (the round trip in one pass)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = _shared(docs, ranks_path, pattern)

    def run(batches):
        voc = _vocabulary(shared)
        for batch in batches:
            texts, ident = filled(batch.column(1)).to_pylist(), batch.column(0)
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= TEXT_STEP):
                    size += len(texts[j])
                    j += 1
                lens, ids = voc.encode_texts(texts[i:j])
                offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                out = {"doc_id": ident.slice(i, j - i),
                       "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))}
                if decoded:
                    flat = ids.tolist()
                    out["decoded"] = pa.array([voc.decode_ids(flat[x:y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())],
                                              pa.binary())
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
                i = j
        # the worker process lives on, for other work
        voc.clear()
        pa.default_memory_pool().release_unused()

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded) \
        .withColumnRenamed("doc_id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", ranks_path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """The rows of ``encoded`` (its first column and ``ids_col``) with ``decoded`` binary.
    A null list of ids decodes to no bytes."""
    key = encoded.columns[0]
    src = encoded.select(key, ids_col)
    shared = _shared(encoded, ranks_path, pattern)

    def run(batches):
        piece = tokens(shared.value[0]).__getitem__
        for batch in batches:
            lists = batch.column(1)
            out = [b"".join(map(piece, x.values.to_pylist())) if x.is_valid else b"" for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(out, pa.binary())],
                                             names=[key, ids_col, "decoded"])

    kind = src.schema[key].dataType.simpleString()
    return src.mapInArrow(run, f"`{key}` {kind}, `{ids_col}` array<int>, decoded binary")


def op10_byte_bpe(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = encode(docs, decoded=True)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
