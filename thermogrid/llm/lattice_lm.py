"""Language-model scores from a subword lattice.

The pieces of an existing public vocabulary weigh every segmentation of a word;
the forward recursion in log space sums them to the word's marginal probability, and
a text's score is the sum over its words and its end. Words do not share pieces, so
each distinct word is worked out once per table of words, not once per text. The weights
start from the vocabulary's own ranks (Zipf's law) and are re-estimated by one step of
expectation-maximisation over the words of all training texts.

Beside it stands the base score, a smoothed unigram over whole words, from
counts over all training texts.

Texts are read in blocks of up to ``BLOCK_TOKENS`` words. A block sends its distinct words
to the word shuffle, where their counts meet, and gets counts and
log probabilities back by number; its texts wait as compressed lists of such numbers. No
table of words is ever whole in one place.

Edge cases: null and empty texts are one end token. Words of any length and any
bytes have a probability (single bytes are pieces). Rows with equal ids are rows; a null
id counts as the empty text when dealing training and hold-out. With no training text all
counts are zero and the weights stay at their start. ``docs`` is read once, and the
numbered blocks are a written table. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermogrid.llm.common import KeyTable, filled, mix, stored
from thermogrid.llm.lang_id import held_out

BLOCK_TOKENS = 6_000_000
WORDS_AT_ONCE = 200_000
CELLS = 1 << 18
LONG_WORD = 64        # bytes with the word mark; longer words go one by one
MARK = "▁".encode()
ZIPF_SHIFT = 10
PIECE_PRIOR = 0.1     # added to each piece's expected count
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Byte strings of the vocabulary with their starting log weights."""

    def __init__(self, path: str | None = None):
        import public_tokenizers as P
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path or P.path("piece_bpe_32k.model"))
        text: dict[bytes, float] = {}
        single: dict[bytes, float] = {}
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            weight = -np.log(ZIPF_SHIFT + max(0.0, -sp.get_score(i)))
            if sp.is_byte(i):
                single[bytes([int(sp.id_to_piece(i)[3:-1], 16)])] = -np.log(ZIPF_SHIFT + sp.get_piece_size())
            else:
                piece = sp.id_to_piece(i).encode()
                if piece.rfind(MARK) <= 0:  # the mark stands at a word's start only
                    text[piece] = weight
        for b in range(256):
            single.setdefault(bytes([b]), -np.log(ZIPF_SHIFT + sp.get_piece_size()))
        for b, w in single.items():
            text.setdefault(b, w)
        self.bytes = sorted(text)
        weights = np.array([text[p] for p in self.bytes] + [-np.log(100.0)])  # the last one is the end of a text
        self.start = weights - np.log(np.exp(weights).sum())


class Lattice:
    """Forward and backward recursions over batches of words."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray):
        self.weights = weights
        self.index = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        self.power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(LONG_WORD + 1)], np.uint64)
        keys = np.array([self._hash(np.frombuffer(p, np.uint8)[None, :])[0, -1] for p in pieces], np.uint64)
        keys = mix(keys)
        self.table = KeyTable(keys, np.arange(len(pieces)))
        self.some = np.zeros(1 << 20, bool)  # leading bits of the pieces: most substrings stop here
        self.some[keys >> np.uint64(44)] = True
        self.end = float(weights[-1])

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        """Prefix hashes of rows of bytes."""
        out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(rows.shape[1]):
                out[:, i + 1] = out[:, i] * _BASE + rows[:, i].astype(np.uint64) + np.uint64(1)
        return out

    def _edges(self, rows: np.ndarray):
        """Starts, ends, and the piece of each row on each edge (-1: none)."""
        width = rows.shape[1]
        s, e = zip(*[(i, j) for j in range(1, width + 1) for i in range(max(0, j - self.longest), j)])
        s, e = np.array(s), np.array(e)
        h = self._hash(rows)
        with np.errstate(over="ignore"):
            key = mix((h[:, e] - h[:, s] * self.power[e - s]).ravel())
        piece = np.full(key.size, -1, np.int32)
        maybe = np.flatnonzero(self.some[key >> np.uint64(44)])
        piece[maybe] = self.table.get(key[maybe], -1)
        return s, e, piece.reshape(len(rows), s.size)

    def _forward(self, rows, s, e, piece):
        w = np.append(self.weights, -np.inf)[piece]
        alpha = np.full((len(rows), rows.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0
        bounds = np.searchsorted(e, np.arange(1, rows.shape[1] + 2))
        for j in range(1, rows.shape[1] + 1):
            a, b = bounds[j - 1], bounds[j]
            x = alpha[:, s[a]:s[a] + b - a] + w[:, a:b]
            top = x.max(axis=1)
            alpha[:, j] = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
        return alpha, w

    def _groups(self, words: list[bytes]):
        """(places, rows of bytes) for words of one length; long words come alone."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + len(MARK)
        data = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size - len(MARK)) - (size - len(MARK))
        for width in np.unique(size).tolist():
            if width > LONG_WORD:
                continue
            at = np.flatnonzero(size == width)
            step = max(1, CELLS // (width * min(width, self.longest)))
            for k in range(0, at.size, step):
                part = at[k:k + step]
                rows = np.empty((part.size, width), np.uint8)
                rows[:, :len(MARK)] = np.frombuffer(MARK, np.uint8)
                rows[:, len(MARK):] = data[first[part][:, None] + np.arange(width - len(MARK))]
                yield part, rows
        self.long = np.flatnonzero(size > LONG_WORD).tolist()

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural log marginal of each word; the empty word is the end of a text."""
        out = np.zeros(len(words))
        for at, rows in self._groups(words):
            if rows.shape[1] == len(MARK):
                out[at] = self.end
            else:
                out[at] = self._forward(rows, *self._edges(rows))[0][:, -1]
        for i in self.long:
            out[i] = self._long(MARK + words[i])[0][-1]
        return out

    def _long(self, word: bytes):
        alpha = [0.0]
        edges = []
        for j in range(1, len(word) + 1):
            x = []
            for i in range(max(0, j - self.longest), j):
                p = self.index.get(word[i:j])
                if p is not None:
                    x.append((alpha[i] + float(self.weights[p]), i, p))
            top = max(x)[0]
            alpha.append(top + float(np.log(sum(np.exp(v - top) for v, _, _ in x))))
            edges.append(x)
        return alpha, edges

    def expected(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """Expected number of each piece (the end last) over the words."""
        out = np.zeros(self.weights.size)
        tiny = []
        for at, rows in self._groups(words):
            if rows.shape[1] == len(MARK):
                out[-1] += times[at].sum()
                continue
            # Sums of products here, not of logs: a word of up to LONG_WORD bytes
            # mostly stays far from underflow, and the others are done in logs below.
            s, e, piece = self._edges(rows)
            w = np.append(np.exp(self.weights), 0.0)[piece]
            width = rows.shape[1]
            alpha, beta = np.zeros((len(rows), width + 1)), np.zeros((len(rows), width + 1))
            alpha[:, 0] = beta[:, width] = 1
            ends = np.searchsorted(e, np.arange(1, width + 2))
            for j in range(1, width + 1):
                a, b = ends[j - 1], ends[j]
                alpha[:, j] = np.einsum("ij,ij->i", alpha[:, s[a]:s[a] + b - a], w[:, a:b])
            order = np.lexsort((e, s))
            starts = np.searchsorted(s[order], np.arange(width + 1))
            for i in range(width - 1, -1, -1):
                k = order[starts[i]:starts[i + 1]]
                beta[:, i] = np.einsum("ij,ij->i", beta[:, i + 1:i + 1 + k.size], w[:, k])
            total = alpha[:, -1]
            low = total < 1e-200
            tiny += at[low].tolist()
            share = alpha[:, s] * w * beta[:, e] * (times[at] * ~low / np.where(low, 1, total))[:, None]
            used = piece >= 0
            out += np.bincount(piece[used], weights=share[used], minlength=out.size)
        for i in (*tiny, *self.long):
            alpha, edges = self._long(MARK + words[i])
            beta = [-np.inf] * len(alpha)
            beta[-1] = 0.0
            for j in range(len(edges), 0, -1):
                for v, k, p in edges[j - 1]:
                    x = v - alpha[k] + beta[j]
                    beta[k] = float(np.logaddexp(beta[k], x))
                    out[p] += times[i] * np.exp(v + beta[j] - alpha[-1])
        return out


class Counter(dict):
    """Numbers words in the order they are met."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _blocks(batches, most: int):
    """Per block: its number, the ids, hold-out flags, tokens per text, the
    number of each token and the distinct words. A word's number is its
    rank by frequency, then by bytes."""
    serial, task = 0, TaskContext.get().partitionId() << 24
    known, ids, held, counts, parts, total = Counter(), [], [], [], [], 0

    def close():
        which = np.concatenate(parts)
        words = np.array(list(known), dtype=object)
        freq = np.bincount(which, minlength=words.size)
        order = np.lexsort((np.argsort(np.argsort(words)), -freq))
        rank = np.empty(words.size, np.int64)
        rank[order] = np.arange(words.size)
        return task + serial, pa.concat_arrays(ids), np.concatenate(held), np.array(counts), rank[which], words[order].tolist()

    for batch in batches:
        texts = filled(batch.column(2)).to_pylist()
        flags = batch.column(1).to_numpy(zero_copy_only=False)
        begin = 0
        for i, t in enumerate(texts):
            got = t.encode().lower().split()  # white space of ASCII, 0x20 and 0x09-0x0D
            got.append(b"")
            parts.append(np.fromiter(map(known.__getitem__, got), np.int64, len(got)))
            counts.append(len(got))
            total += len(got)
            if total >= most or i + 1 == len(texts):
                ids.append(batch.column(0).slice(begin, i + 1 - begin))
                held.append(flags[begin:i + 1])
                begin = i + 1
                if total >= most:
                    yield close()
                    known, ids, held, counts, parts, total = Counter(), [], [], [], [], 0
                    serial += 1
    if parts:
        yield close()


WORDS = ["block", "word", "number", "n", "expected"]
TEXTS = ["block", "doc_id", "held_out", "n", "numbers"]


def _numbered(src: DataFrame, kind: str, pieces: Pieces, most: int) -> DataFrame:
    """Three kinds of rows from one pass, as a second pass could make other blocks.
    With numbers: the texts as compressed lists of word numbers, sorted, as differences
    (``TEXTS``). Without: a row for each distinct word of each block with its training
    count; and rows without a word: the pieces' expected counts (number is the piece)."""
    columns = {"block": pa.int64(), "word": pa.binary(), "number": pa.int32(), "n": pa.int64(), "expected": pa.float64(),
               "doc_id": None, "held_out": pa.bool_(), "numbers": pa.binary()}
    shared = src.sparkSession.sparkContext.broadcast((pieces.bytes, pieces.start))  # one public vocabulary

    def run(batches):
        lattice = Lattice(*shared.value)
        pack = zstandard.ZstdCompressor(level=1)

        def rows(id_type, m, **given):
            return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(m, t or id_type) for c, t in columns.items()],
                                              names=list(columns))

        for block, ids, held, counts, which, words in _blocks(batches, most):
            train = np.repeat(~held, counts)
            n = np.bincount(which[train], minlength=len(words))
            for i in range(0, len(words), WORDS_AT_ONCE):
                part = words[i:i + WORDS_AT_ONCE]
                m = len(part)
                yield rows(ids.type, m, block=pa.array(np.full(m, block)), word=pa.array(part, pa.binary()),
                           number=pa.array(np.arange(i, i + m, dtype=np.int32)), n=pa.array(n[i:i + m]))
            seen = np.flatnonzero(n)
            if seen.size:
                x = lattice.expected([words[i] for i in seen], n[seen].astype(float))
                at = np.flatnonzero(x)
                yield rows(ids.type, at.size, block=pa.array(np.full(at.size, block)), number=pa.array(at.astype(np.int32)),
                           n=pa.array(np.zeros(at.size, np.int64)), expected=pa.array(x[at]))
            ends = np.cumsum(counts)
            for i in range(0, len(counts), 4096):
                numbers = []
                for a, b in zip((ends - counts)[i:i + 4096].tolist(), ends[i:i + 4096].tolist()):
                    x = np.sort(which[a:b])
                    x[1:] -= x[:-1].copy()
                    numbers.append(pack.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))
                m = len(numbers)
                yield rows(ids.type, m, block=pa.array(np.full(m, block)), doc_id=ids.slice(i, m), held_out=pa.array(held[i:i + m]),
                           n=pa.array(counts[i:i + m]), numbers=pa.array(numbers, pa.binary()))

    return src.mapInArrow(run, f"block long, word binary, number int, n long, expected double, doc_id {kind}, "
                               "held_out boolean, numbers binary")


def weights(words: DataFrame, pieces: Pieces) -> np.ndarray:
    """Log weights after the step of expectation-maximisation."""
    sums = words.where("word is null").groupBy("number").agg(F.sum("expected").alias("x")).collect()  # one per piece
    if not sums:
        return pieces.start
    x = np.full(pieces.start.size, PIECE_PRIOR)
    for r in sorted(sums):
        x[r.number] += r.x
    return np.log(x / x.sum())


TOTAL = -1  # block number of the rows that carry counts of distinct training words


def _looked_up(words: DataFrame, pieces: Pieces, logw: np.ndarray) -> DataFrame:
    """(block, number, c, logp) for every word row, and TOTAL rows."""
    shared = words.sparkSession.sparkContext.broadcast((pieces.bytes, logw))
    same = Window.partitionBy("word")
    met = words.where("word is not null").select("block", "word", "number", F.sum("n").over(same).alias("c"))

    def scored(lattice, batches):
        word = pa.chunked_array([b.column(1) for b in batches]).combine_chunks()
        w = word.to_pylist()
        new = np.array([i == 0 or w[i] != w[i - 1] for i in range(len(w))])
        logp = lattice.log_probabilities([w[i] for i in np.flatnonzero(new)])[np.cumsum(new) - 1]
        c = np.concatenate([b.column(3).to_numpy() for b in batches])
        return w, new, c, pa.RecordBatch.from_arrays(
            [pa.chunked_array([b.column(0) for b in batches]).combine_chunks(),
             pa.chunked_array([b.column(2) for b in batches]).combine_chunks(), pa.array(c), pa.array(logp)],
            names=["block", "number", "c", "logp"])

    def run(batches):
        lattice, held, rows, distinct, last = Lattice(*shared.value), [], 0, 0, None
        for batch in _with_end(batches):
            if batch is not None and batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if held and (batch is None or rows >= WORDS_AT_ONCE):
                w, new, c, out = scored(lattice, held)
                new[0] &= w[0] != last  # equal words stand together, also across these steps
                distinct += int((new & (c > 0)).sum())
                last, held, rows = w[-1], [], 0
                yield out
        yield pa.RecordBatch.from_arrays([pa.array([TOTAL], pa.int64()), pa.array([0], pa.int32()),
                                          pa.array([distinct], pa.int64()), pa.array([0.0])],
                                         names=["block", "number", "c", "logp"])

    return met.mapInArrow(run, "block long, number int, c long, logp double")


def _with_end(batches):
    yield from batches
    yield None


def _block_scores(found: pa.Table, texts: pa.Table, id_type) -> pa.Table:
    """Sums per text of one block; the TOTAL block gives one row with the sum."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "distinct"]
    if not texts.num_rows:
        return pa.Table.from_arrays(
            [pa.nulls(1, id_type), pa.nulls(1, pa.bool_()), *[pa.nulls(1, pa.int64())] * 2, *[pa.nulls(1, pa.float64())] * 2,
             pa.array([sum(found.column("c").to_pylist())], pa.int64())], names=names)
    number = found.column("number").to_numpy()
    c, logp = np.zeros(number.size, np.int64), np.zeros(number.size)
    c[number], logp[number] = found.column("c").to_numpy(), found.column("logp").to_numpy()
    part, logp = np.log10(c + 0.1), logp / np.log(10)
    unpack = zstandard.ZstdDecompressor()
    known, base, score = [], [], []
    for n, raw in zip(texts.column("n").to_pylist(), texts.column("numbers").to_pylist()):
        x = np.frombuffer(unpack.decompress(raw, max_output_size=4 * n), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
        x = np.cumsum(x, dtype=np.int64)
        known.append(int((c[x] > 0).sum()))
        base.append(float(part[x].sum()))
        score.append(float(logp[x].sum()))
    m = texts.num_rows
    return pa.Table.from_arrays(
        [texts.column("doc_id"), texts.column("held_out"), texts.column("n"), pa.array(known, pa.int64()), pa.array(base),
         pa.array(score), pa.nulls(m, pa.int64())], names=names)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
           mod: int = 10, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(mod, id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType
    pieces = Pieces(vocabulary)
    blocks = stored(_numbered(src, kind.simpleString(), pieces, block_tokens), "lm-blocks")
    words, texts = blocks.where("numbers is null").select(*WORDS), blocks.where("numbers is not null").select(*TEXTS)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = _looked_up(words, pieces, weights(words, pieces))
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(kind)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _block_scores(left, right, id_type)

    out = stored(found.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(
        run, f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, score double, "
             "distinct long"), "lm-scores")
    distinct = out.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    per_token = F.lit(float(np.log10(total + 0.1 * (distinct + 1))))
    return out.where("distinct is null").select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * per_token).alias("base_score"), "score")


def op8_lm_scoring(docs: DataFrame, **options) -> DataFrame:
    return scores(docs, **options)
