"""Source divergence audit: how far the term use of the sources of a language lies apart.

Terms are runs of ASCII letters (lower-cased) and characters beyond ASCII. Each language
keeps the terms of at least ``MIN_DOCS`` of its documents. A group (language, source)
and a language give each kept term a smoothed share p in units of ``1 / UNIT``; the
divergence of two shares is floor((p - q)**2 / q), in whole numbers throughout.

Strings are materialised late. Counting moves fixed-width digests of terms only, through
a partial aggregate per task. One dictionary of the distinct terms gives the minimum and
maximum string of each digest; where they differ the digest is split: its strings are
numbered and counted again by themselves. Only the terms that are returned get their text.

The pairs of sources are summed in tiles: a bucket of terms x two blocks of at most about
``BLOCK`` sources, so that a task never holds all terms, all sources or all pairs. Terms
that occur in neither block have constant shares and are added by their number.

Edge cases: null text, language and source are the empty string. A group without terms
is compared like any other; a language without kept terms has divergence 0. Equal rows
are separate documents. Equal values are ranked by the item's UTF-8 bytes. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermogrid.llm.common import CHUNK_BYTES, SpanHash, flat_ranges, lower_ascii, small_batches, stored, text_chunks
from thermogrid.llm.decontam import Words

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
UNIT = 1_000_000_000
TOP = 200
BLOCK = 64
BUCKET_ROWS = 500_000
DIGEST_BITS = 64
TASK_ROWS = 1_000_000   # counts that a task sums up before it sends them

_HASH = SpanHash(131)
# byte -> itself for letters (lower-cased) and bytes of characters beyond ASCII, else a space
_LETTER = np.full(256, 32, np.uint8)
_LETTER[0x61:0x7B] = _LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kept)); decimals, as the product leaves 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(UNIT).cast("decimal(11,0)") * wide(count + 1)
    return F.when(kept > 0, F.lit(1) + F.call_function("div", top, wide(F.greatest(total + kept, F.lit(1))))).cast("long")


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _digests(raw: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[Words, np.ndarray]:
    w = Words(raw, offsets, _LETTER)
    h = _HASH.spans(_HASH.prefix(w.data), w.start, w.end) if w.count else np.zeros(0, np.uint64)
    return w, h >> np.uint64(64 - bits)


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal values together, and the number of each place's value."""
    order = np.argsort(h)  # not stable, which numpy does several times faster
    h = h[order]
    new = np.ones(h.size, bool)
    new[1:] = h[1:] != h[:-1]
    return order, np.cumsum(new) - 1


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    """Columns (group, digest, occurrences, documents), one for each group and digest."""
    x = np.concatenate(parts, axis=1)
    if not x.shape[1]:
        return x
    order, value = _runs(x[1])
    both = value * (int(x[0].max()) + 1) + x[0, order]
    again = np.argsort(both)
    both, order = both[again], order[again]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    return np.concatenate([x[:2, order[first]], np.stack([np.add.reduceat(x[k, order], first) for k in (2, 3)])])


def digest_counts(docs: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """(lang, source, digest, c, d): occurrences of each term and documents with it,
    summed within each task already."""
    small_batches(docs.sparkSession)

    def run(batches):
        groups: dict[tuple[str, str], int] = {}
        held: list[np.ndarray] = []
        rows = 0

        def out(x: np.ndarray):
            names = list(groups)
            for i in range(0, x.shape[1], 1 << 16):
                part = x[:, i:i + (1 << 16)]
                number, of = np.unique(part[0], return_inverse=True)
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([names[k][j] for k in number.tolist()], pa.string()).take(take) for j in (0, 1)],
                     *[pa.array(part[k]) for k in (1, 2, 3)]], names=["lang", "source", "digest", "c", "d"])

        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            group = np.fromiter((groups.setdefault(k, len(groups)) for k in keys), np.int64, len(keys))
            for i, _, raw, offsets in text_chunks(batch.column(0)):
                w, h = _digests(raw, offsets, bits)
                if not h.size:
                    continue
                order, value = _runs(h)
                distinct = h[order][np.concatenate([[True], value[1:] != value[:-1]])].view(np.int64)
                both = np.sort(value * offsets.size + w.of[order])  # (digest, document)
                first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
                value, of = np.divmod(both[first], offsets.size)
                held.append(np.stack([group[i + of], distinct[value], np.diff(np.append(first, h.size)),
                                      np.ones(first.size, np.int64)]))
                rows += first.size
                if rows > TASK_ROWS:
                    held = [_summed(held)]
                    rows = held[0].shape[1]
                    if rows > TASK_ROWS // 2:
                        yield from out(held[0])
                        held, rows = [], 0
        if held:
            yield from out(_summed(held))

    # dealt by (lang, digest), which serves the sums over a language as well
    return (docs.select("text", "lang", "source").mapInArrow(run, "lang string, source string, digest long, c long, d long")
            .repartition("lang", "digest").groupBy("lang", "source", "digest").agg(F.sum("c").alias("c"), F.sum("d").alias("d")))


def dictionary(docs: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """(term, digest) of the distinct terms. A task sends one string per digest of a run of
    texts, and each one whose bytes differ from that."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch.column(0), 4 * CHUNK_BYTES):
                w, h = _digests(raw, offsets, bits)
                if not h.size:
                    continue
                order, value = _runs(h)
                first = order[np.concatenate([[True], value[1:] != value[:-1]])]
                head = np.empty(h.size, np.int64)
                head[order] = first[value]
                lens = w.end - w.start
                send = lens != lens[head]
                send[first] = True
                same = np.flatnonzero(~send)
                differ = w.data[flat_ranges(w.start[same], lens[same])] != w.data[flat_ranges(w.start[head[same]], lens[same])]
                if differ.any():
                    send[same[np.unique(np.repeat(np.arange(same.size), lens[same])[differ])]] = True
                at = np.flatnonzero(send)
                ends = np.concatenate([[0], np.cumsum(lens[at])]).astype(np.int32)
                data = w.data[flat_ranges(w.start[at], lens[at])]
                yield pa.RecordBatch.from_arrays(
                    [pa.StringArray.from_buffers(at.size, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())),
                     pa.array(h[at].view(np.int64))], names=["term", "digest"])

    return docs.select("text").mapInArrow(run, "term string, digest long").distinct()


def term_counts(docs: DataFrame, min_docs: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, digest, part, c, all) of the kept terms, ``all`` over the language, and
    the dictionary (term, digest, part); ``part`` is 0 unless several strings share a digest."""
    words = stored(dictionary(docs, bits), "terms")
    split = stored(words.groupBy("digest").agg(F.min("term").alias("lo"), F.max("term").alias("hi"))
                   .where("lo <> hi").select("digest"), "split-digests")
    names = words.withColumn("part", F.lit(0))
    counts = digest_counts(docs, bits).withColumn("part", F.lit(0))
    if not split.isEmpty():
        numbered = stored(words.join(split, "digest").withColumn(
            "part", F.row_number().over(Window.partitionBy("digest").orderBy("term"))), "split-terms")
        names = names.join(split, "digest", "left_anti").unionByName(numbered)
        found = docs.select("lang", "source", F.regexp_extract_all(lower_ascii("text"), F.lit(TERM), F.lit(0)).alias("t"))
        each = lambda t, new: found.select("lang", "source", F.explode(t).alias("term"), F.lit(new).alias("d"))
        again = (each(F.col("t"), 0).unionByName(each(F.array_distinct("t"), 1)).join(numbered, "term")
                 .groupBy("lang", "source", "digest", "part").agg(F.sum(1 - F.col("d")).alias("c"), F.sum("d").alias("d")))
        counts = counts.join(split, "digest", "left_anti").unionByName(again)
    same = Window.partitionBy("lang", "digest", "part")
    kept = (counts.withColumn("docs", F.sum("d").over(same)).withColumn("all", F.sum("c").over(same))
            .where(F.col("docs") >= min_docs).select("lang", "source", "digest", "part", "c", "all"))
    return stored(kept, "kept-counts"), names


def _sums(batch: pa.Table, block: int, other: int):
    """The tile of one bucket of terms: for each two sources the sum of the
    divergences of the bucket's terms, and their number."""
    col = {n: batch.column(n).combine_chunks() for n in ("source", "digest", "part", "p", "zero", "block")}
    sources = col["source"].dictionary_encode()
    names, of = sources.dictionary.to_pylist(), sources.indices.to_numpy(zero_copy_only=False)
    real = col["digest"].is_valid().to_numpy(zero_copy_only=False)
    zero = np.zeros(len(names), np.int64)
    zero[of] = col["zero"].to_numpy()
    side = np.zeros(len(names), np.int64)
    side[of] = col["block"].to_numpy()
    key = np.stack([col["digest"].fill_null(0).to_numpy()[real], col["part"].fill_null(0).to_numpy()[real].astype(np.int64)])
    order = np.lexsort(key)
    new = np.ones(order.size, bool)
    new[1:] = (np.diff(key[:, order], axis=1) != 0).any(axis=0)
    term = np.empty(order.size, np.int64)
    term[order] = np.cumsum(new) - 1
    n = int(new.sum())
    p = np.repeat(zero[:, None], n, axis=1)
    p[of[real], term] = col["p"].to_numpy(zero_copy_only=False)[real]
    left, right = np.flatnonzero(side == block), np.flatnonzero(side == other)
    out = []
    for i in left.tolist():
        for j in right.tolist():
            if i == j or (block == other and i > j):
                continue
            apart = (p[i] - p[j]) ** 2
            out.append((names[i], names[j], int((apart // p[j]).sum()), n))
            out.append((names[j], names[i], int((apart // p[i]).sum()), n))
    return out


def _pairs(shares: DataFrame, groups: DataFrame, block_size: int, bucket_rows: int) -> DataFrame:
    """(lang, source, item, value): every two sources of a language."""
    buckets = max(1, -(-shares.count() // bucket_rows))
    blocks = F.greatest(F.ceil(F.col("sources") / block_size), F.lit(1))
    sides = stored(groups.withColumn("blocks", blocks.cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")), "source-blocks")
    # one row per source and bucket without a term: its share of terms it does not have
    empty = sides.select("lang", "source", "block", "blocks", "zero", F.lit(None).cast("long").alias("digest"),
                         F.lit(None).cast("int").alias("part"), F.lit(None).cast("long").alias("p"),
                         F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    full = (shares.join(sides.select("lang", "source", "block", "blocks"), ["lang", "source"])
            .withColumn("bucket", F.pmod(F.xxhash64("digest", "part"), F.lit(buckets)).cast("int")).select(*empty.columns))
    tiles = (full.unionByName(empty).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("one", F.least("block", "o")).withColumn("two", F.greatest("block", "o"))
             .select("lang", "bucket", "one", "two", "source", "digest", "part", "p", "zero", "block"))

    def tile(key, table):
        lang, _, one, two = (k.as_py() for k in key)
        out = _sums(table, one, two)
        a, b, v, n = zip(*out) if out else ((),) * 4
        return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(a, pa.string()),
                         "item": pa.array(b, pa.string()), "value": pa.array(v, pa.int64()), "n": pa.array(n, pa.int64())})

    sums = (tiles.groupBy("lang", "bucket", "one", "two")
            .applyInArrow(tile, "lang string, source string, item string, value long, n long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("n").alias("n")))
    mine = groups.select("lang", "source", F.col("zero").alias("p"), "kept")
    their = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("q"))
    rest = (F.col("kept") - F.col("n")) * _apart(F.col("p"), F.col("q"))
    return (sums.join(mine, ["lang", "source"]).join(their, ["lang", "item"])
            .select("lang", "source", "item", (F.col("value") + F.when(F.col("kept") > 0, rest).otherwise(0)).alias("value")))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, bucket_rows: int = BUCKET_ROWS,
               digest_bits: int = DIGEST_BITS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources
    of the language by divergence, part ``term`` the ``top`` terms that the source uses
    more than its language does."""
    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                        for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    kept, names = term_counts(src, min_docs, digest_bits)
    langs = kept.groupBy("lang").agg(F.count_distinct("digest", "part").alias("kept"), F.sum("c").alias("total"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    occurring = src.select("lang", "source").distinct()
    groups = (occurring.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .join(occurring.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")), "lang")
              .select("lang", "source", "sources", none("n"), none("kept"), none("total")))
    # a language without kept terms has no shares; 1 stands for them
    zero = F.coalesce(_share(F.lit(0), F.col("n"), F.col("kept")), F.lit(1))
    groups = stored(groups.withColumn("zero", zero), "groups")
    shares = stored(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "digest", "part", "zero", _share(F.col("c"), F.col("n"), F.col("kept")).alias("p"),
        _share(F.col("all"), F.col("total"), F.col("kept")).alias("q")), "shares")

    pairs = _pairs(shares.drop("q"), groups, block, bucket_rows)
    by_pair = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                          F.row_number().over(by_pair).alias("rank"))

    more = shares.where("p > q").select("lang", "source", "digest", "part", _apart(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # equal values at the end all stay until their texts are known
    first = stored(more.withColumn("r", F.rank().over(by_value)).where(F.col("r") <= top).drop("r"), "top-digests")
    terms = (first.join(names, ["digest", "part"]).withColumnRenamed("term", "item")
             .withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= top)
             .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return ranked.unionByName(terms)


def op13_source_divergence(docs: DataFrame) -> DataFrame:
    return divergence(docs)


OP13_SQL = r"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[a-z\x{80}-\x{10FFFF}]+') as w from documents),
toks as (select r, lang, source, unnest(w) as term from docs),
kept as (select lang, term, count(*) as call from toks group by all having count(distinct r) >= 3),
langs as (select lang, count(*) as v, sum(call) as nl from kept group by lang),
grp as (select distinct lang, source from docs),
cnt as (select t.lang, t.source, t.term, count(*) as c from toks t join kept using (lang, term) group by all),
tot as (select lang, source, sum(c) as n from cnt group by all),
shr as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c,
         1 + (1000000000::hugeint * (coalesce(c.c, 0) + 1)) // (coalesce(t.n, 0) + l.v) as p,
         1 + (1000000000::hugeint * (k.call + 1)) // (l.nl + l.v) as q
  from grp g join kept k using (lang) join langs l using (lang)
  left join cnt c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join tot t on t.lang = g.lang and t.source = g.source),
sums as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from shr a join shr b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (
  select lang, source, 'term' as part, term as item, (((p - q) * (p - q)) // q)::bigint as value
  from shr where c > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 200
"""
