"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model counts the 1- to 3-grams of every training text into ``BUCKETS``
hashed features per language (partial counts per task, then one sum), and is a
matrix of log probabilities, broadcast in blocks of ``LANGS`` languages: more languages
are scored block by block, with the best one and the sum of all probabilities carried on. Texts are scored in numpy over whole batches: the matrix
rows of all n-grams are gathered and added up per text.

Characters are folded to lower case and all but letters become one space. A text
that is null, empty or without a letter is ``und`` with score 0; so is every
text when there is nothing to learn from. Rows with a null language do not train
but are predicted. Equal scores go to the language that sorts first. Very
long texts are taken whole. ``doc_id``, ``source`` and ``lang`` are never
inputs of a prediction; ``doc_id`` only deals rows to training or hold-out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import filled, small_batches, stored

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTH = 0.05
LANGS = 256          # languages of one broadcast matrix
STEP = 1 << 19   # characters per vectorised step
SPACE = 32

_FOLD: list[np.ndarray] = []


def fold() -> np.ndarray:
    """Code point -> lower-case letter, or space. Built once per process."""
    if not _FOLD:
        t = np.full(0x110000, SPACE, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(t)
    return _FOLD[0]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of the texts: bucket, number of the text, and for each
    text whether it has a letter."""
    n = len(texts)
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, n)
    x = fold()[np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)]
    of = np.repeat(np.arange(n), lens)
    keep = np.ones(x.size, bool)
    keep[1:] = (x[1:] != SPACE) | (x[:-1] != SPACE) | (of[1:] != of[:-1])
    x, of = x[keep].astype(np.uint64), of[keep]
    letter = x != SPACE
    has = np.zeros(n, bool)
    has[of[letter]] = True
    buckets, owners = [], []
    with np.errstate(over="ignore"):
        for k in ORDERS:
            m = x.size - k + 1
            if m <= 0:
                continue
            h = np.full(m, k, np.uint64)
            some = np.zeros(m, bool)
            for j in range(k):
                h = (h + x[j:j + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                some |= letter[j:j + m]
            some &= of[:m] == of[k - 1:k - 1 + m]  # no n-gram crosses a text
            buckets.append((h >> np.uint64(48)).astype(np.int64)[some] % BUCKETS)
            owners.append(of[:m][some])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    return np.concatenate(buckets), np.concatenate(owners), has


def steps(texts: list[str]):
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= STEP):
            size += len(texts[j]) + 1
            j += 1
        yield i, texts[i:j]
        i = j


class Model:
    """Log probabilities (buckets x languages) and log priors of a block of languages;
    ``rows`` is the number of training texts of all languages."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray, rows: float | None = None):
        self.langs = langs
        total = counts.sum(axis=1, keepdims=True)
        self.logp = np.log((counts + SMOOTH) / (total + SMOOTH * BUCKETS)).T.astype(np.float32).copy()
        self.prior = np.log(docs / (docs.sum() if rows is None else rows)) if len(langs) else np.zeros(0)

    def scores(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Best language of the block and its log probability, and the sum of the block's
        probabilities in units of the best; ``und`` for texts without a letter."""
        out, best, total = ["und"] * len(texts), np.full(len(texts), -np.inf), np.ones(len(texts))
        if not self.langs:
            return out, best, total
        for i, part in steps(texts):
            bucket, of, has = features(part)
            logs = np.zeros((len(part), len(self.langs)))
            for k in range(len(self.langs)):
                logs[:, k] = np.bincount(of, weights=self.logp[bucket, k], minlength=len(part)) + self.prior[k]
            at = logs.argmax(axis=1)
            most = logs.max(axis=1)
            share = np.exp(np.maximum(logs - most[:, None], -700)).sum(axis=1)
            for j in np.flatnonzero(has).tolist():
                out[i + j], best[i + j], total[i + j] = self.langs[at[j]], most[j], share[j]
        return out, best, total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, best, total = self.scores(texts)
        return langs, np.where(np.isinf(best), 0.0, 1.0 / total)


class Models:
    """The blocks of languages, in order; each is fetched when it is used."""

    def __init__(self, table: DataFrame, size: int = LANGS):
        self.table = table
        # one row per language
        got = table.where("bucket = -1").select("lang", "n").toArrow()
        rows = dict(zip(got.column("lang").to_pylist(), got.column("n").to_pylist()))
        self.langs, self.rows = sorted(rows), rows
        self.parts = [self.langs[i:i + size] for i in range(0, len(self.langs), size)]

    def block(self, langs: list[str]) -> Model:
        got = self.table.where(F.col("lang").isin(langs)).where("bucket >= 0").toArrow()
        number = {x: k for k, x in enumerate(langs)}
        counts = np.zeros((len(langs), BUCKETS))
        names = got.column("lang").combine_chunks().dictionary_encode()
        if len(got):
            of = np.array([number[x] for x in names.dictionary.to_pylist()])[names.indices.to_numpy(zero_copy_only=False)]
            counts[of, got.column("bucket").to_numpy()] = got.column("n").to_numpy()
        return Model(langs, counts, np.array([self.rows[x] for x in langs], float), float(sum(self.rows.values())))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = LANGS) -> Models:
    """Counts over all rows with a language, in a written table (lang, bucket, n); bucket -1 counts
    the texts."""
    small_batches(docs.sparkSession)
    src = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            texts, langs = filled(batch.column(0)).to_pylist(), batch.column(1).to_pylist()
            for i, part in steps(texts):
                bucket, of, _ = features(part)
                names = sorted(set(langs[i:i + len(part)]))
                number = {x: k for k, x in enumerate(names)}
                label = np.array([number[x] for x in langs[i:i + len(part)]])
                both = np.bincount(label[of] * BUCKETS + bucket, minlength=len(names) * BUCKETS) if of.size \
                    else np.zeros(len(names) * BUCKETS, np.int64)
                for k, x in enumerate(names):
                    sums[x] = sums.get(x, 0) + both[k * BUCKETS:(k + 1) * BUCKETS]
                    rows[x] = rows.get(x, 0) + int((label == k).sum())
        for x, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(  # bucket -1: the number of texts
                [pa.array([x] * (at.size + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()),
                 pa.array(np.append(c[at], rows[x]), pa.int64())], names=["lang", "bucket", "n"])

    parts = src.mapInArrow(run, "lang string, bucket int, n long")
    return Models(stored(parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts"), size)


def predict(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row. With several blocks of languages the texts
    travel from pass to pass, each of which holds one block."""
    small_batches(docs.sparkSession)
    cur = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit("und").alias("lang_pred"),
                      F.lit(float("-inf")).alias("best"), F.lit(1.0).alias("total"))
    kind = cur.schema["doc_id"].dataType.simpleString()
    for k, langs in enumerate(models.parts):
        shared = docs.sparkSession.sparkContext.broadcast(models.block(langs))  # LANGS x BUCKETS floats at most

        last = k + 1 == len(models.parts)

        def run(batches, shared=shared, last=last):
            for batch in batches:
                found, best, total = shared.value.scores(filled(batch.column(1)).to_pylist())
                was, sums = batch.column(3).to_numpy(), batch.column(4).to_numpy()
                more = best > was  # equal scores stay with the language that sorts first
                top = np.maximum(best, was)
                with np.errstate(invalid="ignore"):
                    part = [np.where(np.isinf(a), 0.0, s * np.exp(np.maximum(a - top, -700))) for a, s in ((was, sums), (best, total))]
                names = [f if m else old for f, m, old in zip(found, more.tolist(), batch.column(2).to_pylist())]
                out = [("doc_id", batch.column(0)), ("lang_pred", pa.array(names, pa.string())), ("best", pa.array(top)),
                       ("total", pa.array(np.where(np.isinf(top), 1.0, part[0] + part[1])))]
                if not last:
                    out.insert(1, ("text", batch.column(1)))
                yield pa.RecordBatch.from_arrays([c for _, c in out], names=[n for n, _ in out])

        cur = cur.mapInArrow(run, f"doc_id {kind}, {'' if last else 'text string, '}lang_pred string, best double, total double")
        if not last:
            cur = stored(cur, "language-scores")
    sure = F.when(F.col("best") == F.lit(float("-inf")), 0.0).otherwise(1.0 / F.col("total"))
    return cur.select(F.col("doc_id").alias(id_col), "lang_pred", sure.alias("score"))


def held_out(mod: int, id_col: str = "doc_id"):
    """crc32 of the id as text is divisible by ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod == 0


def op7_language_id(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out(5)))
    return predict(docs, model).select("doc_id", held_out(5).alias("held_out"), "lang_pred", "score")
