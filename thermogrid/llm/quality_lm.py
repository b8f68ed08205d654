"""Quality classifier: interpolated modified Kneser-Ney over characters.

Trusted texts (label quality 1, not toxic) train a character ``ORDER``-gram
model. Counting is partial per task; the counts stay tables dealt out by n-gram,
and the smoothing is joins between them: an n-gram with its context's totals and with
its lower-order probability. Every text is then scored whole; its perplexity per
character is compared with its language's limit, the ``QUANTILE`` of the
perplexities of trusted texts of that language that did not train, times
``MARGIN``. A text is rejected only if its log probability misses that limit by
``EVIDENCE`` nats in all, so a text of n symbols has the threshold limit *
exp(EVIDENCE / n): a few rare letters do not condemn a short text.

Every trusted row that is not held out trains, and the limits take all trusted hold-out
rows; up to ``MAX_TRUSTED`` ids are broadcast, more are joined by a shuffle. A model of at most ``MAX_GRAMS`` n-grams of
all orders is broadcast; a larger one stays in its tables, and the n-grams of the texts
are joined with them. Both score with every n-gram.

Edge cases: a null or empty text has no perplexity and is kept; so is every text
when there is no trusted text. A language without trusted hold-out texts takes the
highest threshold of the others; null is a language of its own here. Characters
beyond U+FFFF count as one symbol. Rows with equal ids are rows; an id that is
labelled more than once is trusted if all its labels say so. Null ids are never
trusted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermogrid.llm.common import KeyTable, filled, small_batches, stored, with_row_id

ORDER = 4
QUANTILE = 0.99
MARGIN = 1.25
EVIDENCE = 40.0
MAX_TRUSTED = 400_000
MAX_GRAMS = 2_000_000
BEGIN, END, ASTRAL = 0x02, 0x03, 0xFFFE   # symbols of 16 bits
STEP = 1 << 19       # characters per vectorised step


def packed(texts: list[str]):
    """ORDER-grams that end at each character and at the end of each text, as
    16-bit symbols packed in a long, and the number of them per text."""
    n = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    lead = chr(BEGIN) * (ORDER - 1)
    x = np.frombuffer("".join(lead + t + chr(END) for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.where(x > 0xFFFD, ASTRAL, x).astype(np.uint64)
    key = np.zeros(x.size - ORDER + 1 if x.size else 0, np.uint64)
    for j in range(ORDER):
        key = (key << np.uint64(16)) | x[j:j + key.size]
    first = np.cumsum(n + ORDER - 1) - (n + ORDER - 1)
    keep = np.zeros(key.size + ORDER, bool)
    step = np.zeros(key.size + ORDER, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + n, -1)
    keep = np.cumsum(step)[:key.size] > 0
    return key[keep], n


def steps(texts: list[str]):
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= STEP):
            size += len(texts[j]) + ORDER
            j += 1
        yield i, texts[i:j]
        i = j


def gram_counts(texts: DataFrame) -> DataFrame:
    """(g, c): counts of ORDER-grams of the column ``text``; empty texts add nothing."""
    def run(batches):
        keys, counts, held = [], [], 0
        for batch in batches:
            for _, part in steps([t for t in filled(batch.column(0)).to_pylist() if t]):
                k, c = np.unique(packed(part)[0], return_counts=True)
                keys.append(k)
                counts.append(c)
                held += k.size
                if held > 1 << 21:
                    keys, counts = [[x] for x in _summed(keys, counts)]
                    held = keys[0].size
                    if held > 1 << 20:  # partial counts: a task holds no more n-grams, however many it meets
                        yield _counted(keys[0], counts[0])
                        keys, counts, held = [], [], 0
        if keys:
            yield _counted(*_summed(keys, counts))

    return texts.select("text").mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _counted(k: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["g", "c"])


def _summed(keys, counts):
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def smoothed(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order 1..ORDER: (g, p) and (context, gamma) tables."""
    by_order = {ORDER: stored(counts, "grams")}
    for k in range(ORDER - 1, 0, -1):
        # continuation counts: the number of different symbols seen before
        suffix = F.col("g").bitwiseAND(F.lit((1 << 16 * k) - 1))
        by_order[k] = stored(by_order[k + 1].groupBy(suffix.alias("g")).agg(F.count(F.lit(1)).alias("c")), "grams")
    symbols = by_order[1].count() + 1  # and the unknown one
    out = []
    lower = None
    for k in range(1, ORDER + 1):
        t = by_order[k].withColumn("context", F.shiftrightunsigned("g", 16) if k > 1 else F.lit(0).cast("long"))
        n = {r.n: r.m for r in t.groupBy(F.least("c", F.lit(5)).alias("n")).agg(F.count(F.lit(1)).alias("m")).collect()}
        n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        discount = [max(0.0, min(i, i - (i + 1) * y * b / a)) if a else i * 0.5
                    for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        d = F.when(F.col("c") == 1, discount[0]).when(F.col("c") == 2, discount[1]).otherwise(discount[2])
        totals = stored(t.groupBy("context").agg(F.sum("c").alias("total"), (F.sum(d) / F.sum("c")).alias("gamma")), "contexts")
        if k == 1:  # one context, the empty one
            one = totals.first()
            total, gamma = (one.total, one.gamma) if one else (1, 0.0)
            p = t.select("g", ((F.col("c") - d) / total + gamma / symbols).alias("p"))
        else:
            own = t.join(totals, "context").select("g", "gamma", ((F.col("c") - d) / F.col("total")).alias("own"))
            below = lower.withColumnsRenamed({"g": "short", "p": "q"})
            p = (own.withColumn("short", F.col("g").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))).join(below, "short")
                 .select("g", (F.col("own") + F.col("gamma") * F.col("q")).alias("p")))
        lower = stored(p, "probabilities")
        out.append((lower, totals.select("context", "gamma")))
    return out


class Model:
    """Log probabilities by n-gram and log back-off weights by context."""

    def __init__(self, orders: list[tuple[np.ndarray, ...]]):
        self.raw, self.ready = orders, None

    def tables(self):
        if self.ready is None:
            self.ready = []
            for g, p, context, gamma in self.raw:
                self.ready.append((KeyTable(g.view(np.uint64), np.arange(g.size)), np.append(np.log(p), 0.0),
                                   KeyTable(context.view(np.uint64), np.arange(context.size)),
                                   np.append(np.log(np.maximum(gamma, 1e-300)), 0.0)))
        return self.ready

    def __getstate__(self):
        return self.raw

    def __setstate__(self, raw):
        self.raw, self.ready = raw, None

    def log_probabilities(self, key: np.ndarray) -> np.ndarray:
        """Natural log probability of the last symbol of each ORDER-gram."""
        tables = self.tables()
        unknown = -np.log(len(self.raw[0][0]) + 1)
        out = np.zeros(key.size)
        rest = np.arange(key.size)
        for k in range(ORDER, 0, -1):
            grams, logp, contexts, gamma = tables[k - 1]
            g = key[rest] & np.uint64((1 << 16 * k) - 1)
            at = grams.get(g, -1)
            seen = at >= 0
            out[rest[seen]] += logp[at[seen]]
            rest, g = rest[~seen], g[~seen]
            if not rest.size:
                return out
            # an unseen context has weight one: index -1 is the appended 0
            out[rest] += gamma[contexts.get(g >> np.uint64(16) if k > 1 else np.zeros(g.size, np.uint64), -1)]
        out[rest] += unknown
        return out


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All trusted ids."""
    return (labels.where("doc_id is not null").groupBy("doc_id")
            .agg((F.min(F.coalesce(F.col("quality") == 1, F.lit(False)) & F.coalesce(F.col("toxic") == 0, F.lit(False)))).alias("ok"))
            .where("ok").select("doc_id"))


class Dealt:
    """A model that stays in its tables: (g, p) and (context, gamma) by order."""

    def __init__(self, orders: list[tuple[DataFrame, DataFrame]], symbols: int):
        self.orders, self.unknown = orders, -float(np.log(symbols + 1))

    def log_probabilities(self, grams: DataFrame) -> DataFrame:
        """(g, logp) for the distinct ORDER-grams ``grams`` (g)."""
        out, logp = grams, F.lit(self.unknown)
        for k, (p, gamma) in enumerate(self.orders, 1):
            short = F.col("g").bitwiseAND(F.lit(-1 if k == ORDER else (1 << 16 * k) - 1))
            context = F.shiftrightunsigned(short, 16) if k > 1 else F.lit(0).cast("long")
            out = (out.withColumn("short", short).withColumn("context", context)
                   .join(p.withColumnsRenamed({"g": "short", "p": f"p{k}"}), "short", "left")
                   .join(gamma.withColumnRenamed("gamma", f"gamma{k}"), "context", "left").drop("short", "context"))
            # an unseen context has weight one
            seen = F.col(f"gamma{k}")
            less = F.when(seen.isNull(), 0.0).otherwise(F.log(F.greatest(seen, F.lit(1e-300))))
            logp = F.coalesce(F.log(f"p{k}"), less + logp)
        return out.select("g", logp.alias("logp"))


def train(docs: DataFrame, labels: DataFrame) -> Model | Dealt | None:
    """The model of the trusted documents that are not held out."""
    small_batches(docs.sparkSession)
    ids = trusted_ids(labels).where(~_held(F.col("doc_id")))
    ids = F.broadcast(ids) if ids.count() <= MAX_TRUSTED else ids.hint("shuffle_merge")
    orders = smoothed(gram_counts(docs.select("doc_id", "text").join(ids, "doc_id")))
    sizes = [p.count() for p, _ in orders]
    if not sizes[0]:
        return None
    if sum(sizes) > MAX_GRAMS:
        return Dealt(orders, sizes[0])
    arrays = []
    for p, gamma in orders:  # at most MAX_GRAMS n-grams, and no more contexts than n-grams
        a, b = p.toArrow(), gamma.toArrow()
        arrays.append((a.column("g").to_numpy(), a.column("p").to_numpy(),
                       b.column("context").to_numpy(), b.column("gamma").to_numpy()))
    return Model(arrays)


def _held(ident):
    return F.pmod(F.xxhash64(ident, F.lit(4)), F.lit(10)) < 2


def dealt_totals(texts: DataFrame, model: Dealt) -> DataFrame:
    """(_row, total): log probability of each text of ``texts`` (_row, text) that is not empty."""
    def run(batches):
        for batch in batches:
            for i, part in steps(filled(batch.column(1)).to_pylist()):
                key, m = packed(part)
                owner = np.repeat(np.arange(len(part)), m)
                some = np.repeat(m > 1, m)  # an empty text has its end only
                key, owner = key[some], owner[some]
                order = np.lexsort((key, owner))
                key, owner = key[order], owner[order]
                new = np.ones(key.size, bool)
                new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, key.size))
                for k in range(0, at.size, 1 << 16):
                    piece = at[k:k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(owner[piece] + i)), pa.array(key[piece].view(np.int64)),
                         pa.array(count[k:k + (1 << 16)])], names=["_row", "g", "c"])

    grams = stored(texts.select("_row", "text").mapInArrow(run, "_row long, g long, c long"), "text-grams")
    logs = stored(model.log_probabilities(grams.select("g").distinct()), "gram-logs")
    return grams.join(logs, "g").groupBy("_row").agg(F.sum(F.col("c") * F.col("logp")).alias("total"))


def dealt_perplexities(rows: DataFrame, model: Dealt) -> DataFrame:
    """(_row, doc_id, lang, n_symbols, perplexity) for the written table ``rows`` (_row, doc_id, lang, text)."""
    # code points as Python counts them; an empty text has no symbols
    n = F.when(F.length("text") > 0, F.length("text") + 1).otherwise(0).cast("long")
    return (rows.select("_row", "doc_id", "lang", F.coalesce(n, F.lit(0)).alias("n_symbols"))
            .join(dealt_totals(rows, model), "_row", "left")
            .select("_row", "doc_id", "lang", "n_symbols", F.exp(-F.col("total") / F.col("n_symbols")).alias("perplexity")))


def perplexities(docs: DataFrame, model: Model | Dealt | None) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity), one row per row of ``docs``."""
    src = docs.select("doc_id", "lang", "text")
    if isinstance(model, Dealt):
        return dealt_perplexities(stored(with_row_id(src, "_row"), "numbered"), model).drop("_row")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_GRAMS n-grams

    def run(batches):
        for batch in batches:
            texts = filled(batch.column(2)).to_pylist()
            total, n = np.zeros(len(texts)), np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
            if shared.value is not None:
                for i, part in steps(texts):
                    key, m = packed(part)
                    total[i:i + len(part)] = np.bincount(np.repeat(np.arange(len(part)), m),
                                                         weights=shared.value.log_probabilities(key), minlength=len(part))
            none = (n == 0) | (shared.value is None)
            ppl = np.exp(-total / np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(ppl, mask=none)],
                                             names=["doc_id", "lang", "n_symbols", "perplexity"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, lang string, n_symbols long, perplexity double")


def thresholds(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, limit): the quantile over all trusted hold-out texts, to a thousandth
    of the log, times the margin."""
    ids = trusted_ids(labels).where(_held(F.col("doc_id")))
    bins = (scores.where("perplexity is not null").join(ids, "doc_id")
            .groupBy("lang", F.ceil(F.log("perplexity") * 1000).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("lang")
    run = bins.withColumn("upto", F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("all", F.sum("n").over(w))
    return (run.where(F.col("upto") >= F.ceil(F.col("all") * QUANTILE)).groupBy("lang")
            .agg((F.exp(F.min("bin") / 1000) * MARGIN).alias("limit")))


def verdicts(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """``scores`` with threshold and keep."""
    limits = stored(thresholds(scores, labels), "thresholds")
    top = limits.agg(F.max("limit")).first()[0]
    joined = scores.join(limits.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left")
    limit = F.coalesce("limit", F.lit(top).cast("double")) * F.exp(EVIDENCE / F.nullif("n_symbols", F.lit(0)))
    return joined.select(*scores.columns, limit.alias("threshold"),
                         F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("keep"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity, threshold, keep), one row per row of ``docs``."""
    return verdicts(stored(perplexities(docs, train(docs, labels)), "perplexities"), labels)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without the rows above their language's threshold."""
    model = train(docs, labels)
    if isinstance(model, Dealt):
        name = "_row"
        while name in docs.columns:
            name += "_"
        rows = stored(with_row_id(docs, name), "numbered")
        tried = stored(dealt_perplexities(rows.select(F.col(name).alias("_row"), "doc_id", "lang", "text"), model), "perplexities")
        gone = verdicts(tried, labels).where("not keep").select(F.col("_row").alias(name))
        return rows.join(gone, name, "left_anti").select(*docs.columns)
    held = trusted_ids(labels).where(_held(F.col("doc_id")))
    tried = perplexities(docs.select("doc_id", "lang", "text").join(held, "doc_id"), model)
    limits = {r.lang: float(np.log(r.limit)) for r in thresholds(tried, labels).collect()}
    if model is None or not limits:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model, limits))  # one number per language
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        model, limits = shared.value
        top = max(limits.values())
        for batch in batches:
            texts, langs = filled(batch.column(text)).to_pylist(), batch.column(lang).to_pylist()
            keep = np.ones(len(texts), bool)
            for i, part in steps(texts):
                key, m = packed(part)
                total = np.bincount(np.repeat(np.arange(len(part)), m), weights=model.log_probabilities(key),
                                    minlength=len(part))
                limit = np.array([limits.get(x, top) for x in langs[i:i + len(part)]])
                keep[i:i + len(part)] = (-total <= limit * m + EVIDENCE) | (m == 1)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op4_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, labels)
