"""Near-duplicate documents by Order MinHash, verified by banded alignment.

k-mers are ``SHINGLE`` consecutive words, each labelled with its occurrence
number in the text. A sketch takes the ``PICK`` labelled k-mers of least hash and
keeps them in text order; ``SKETCHES`` independent sketches make a signature, so two
texts agree in a sketch about as often as their shared k-mers stand in the same
order. Two texts are near duplicates if their longest common subsequence of
k-mers, over the k-mers of both, is at least ``SIMILARITY``: an aligned Jaccard
similarity, sensitive to order.

Equal word sequences are one class before the search. In every bucket of a sketch each
member is compared with one representative of another component, chosen in ``HEADS`` ways
in turn, so candidate pairs grow with the rows, no bucket is paired out and a
group of copies meets about ``HEADS`` representatives, not one per sketch; pairs whose
lengths alone rule them out are dropped before any text moves. Candidates are verified on
their whole texts, a representative's members in parts of ``PART``. Texts in buckets that
then hold several components (texts of a template) are joined by the prefix filter over
their labelled k-mers, for all pairs of different components, so no pair that shares a
bucket is left out. Texts with a k-mer that more than ``FEW`` prefixes hold are compared with one
pivot and joined by what they differ in from it, of which unlinked texts share little; only
texts that hold the pivot's k-mers in another order meet all that are near to it. Without ``exact`` they get
``RARE`` further sketches instead, which prefer k-mers that are rare among these texts and
may miss a pair. Components of all verified links are the classes.

Edge cases: null, empty and word-less texts are classes of their own; texts with
fewer words than a k-mer are one k-mer. Rows with the same id or text are rows.
Rows are numbered once, in a written table that every later step reads, so
``docs`` may give its rows in another order when it is read again. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import SpanHash, discard, flat_ranges, mix, small_batches, stored, text_chunks, with_row_id
from thermogrid.llm.components import components
from thermogrid.llm.decontam import Words

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 16
PICK = 2
RARE = 32           # sketches of rare k-mers, for texts of mixed buckets
HEADS = 3           # ways to choose a bucket's representative, in turn: so many in a group of copies
PART = 64           # members of one representative that a group verifies
FEW = 8             # texts with a k-mer in their prefix that are paired directly
SLOTS_BITS = 20     # counters of k-mers, shared by hash; they say which k-mers are rare

_HASH, _HASH2 = SpanHash(101), SpanHash(102)
_SEEDS = np.random.default_rng(103).integers(0, 1 << 63, RARE, dtype=np.uint64)
# Masks that make each sketch prefer other representatives; below 2**63, so ids stay positive.
_MASKS = [int(x) for x in np.random.default_rng(104).integers(0, 1 << 62, RARE)]
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(raw: np.ndarray, offsets: np.ndarray):
    """k-mer hashes of a run of texts, their number per text, and two hashes of
    each text's whole word sequence."""
    w = Words(raw, offsets)
    rows = offsets.size - 1
    first = np.searchsorted(w.of, np.arange(rows + 1))
    words = np.diff(first)
    n = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    at = flat_ranges(first[:-1], n)
    last = np.minimum(at + SHINGLE - 1, np.repeat(first[1:] - 1, n))
    prefix, prefix2 = _HASH.prefix(w.data), _HASH2.prefix(w.data)
    h = _HASH.spans(prefix, w.start[at], w.end[last]) if at.size else np.zeros(0, np.uint64)
    some = words > 0
    s, e = w.start[first[:-1][some]], w.end[first[1:][some] - 1]
    sig = np.zeros((2, rows), np.uint64)
    sig[0, some], sig[1, some] = _HASH.spans(prefix, s, e), _HASH2.spans(prefix2, s, e)
    return h, n, sig


def labelled(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """k-mer hashes with their occurrence number in the text."""
    with np.errstate(over="ignore"):
        key = mix(h + np.repeat(np.arange(n.size, dtype=np.uint64), n) * _GOLD)
        order = np.argsort(key, kind="stable")
        run = np.ones(h.size, bool)
        run[1:] = key[order][1:] != key[order][:-1]
        begin = np.flatnonzero(run)
        count = np.arange(h.size) - np.repeat(begin, np.diff(np.append(begin, h.size)))
        occurrence = np.zeros(h.size, np.uint64)
        occurrence[order] = count.astype(np.uint64)
        return mix(h + occurrence * _GOLD)


def sketches(h: np.ndarray, n: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """(SKETCHES, texts) sketch values; 0 for texts without k-mers. With ``counts`` of k-mers
    there are ``RARE``, in which a k-mer comes earlier the rarer it is."""
    many = SKETCHES if counts is None else RARE
    out = np.zeros((many, n.size), np.uint64)
    if not h.size:
        return out
    full = np.flatnonzero(n)
    size = n[full]
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(full.size), size)
    lab = labelled(h, n)
    weight = None if counts is None else counts[_slots(lab)].astype(np.float64)
    with np.errstate(over="ignore"):
        for t in range(many):
            x, last = mix(lab ^ _SEEDS[t]), _LAST
            if weight is not None:
                # exponential times: the least is a k-mer with odds of one to its count
                x, last = -np.log1p(-((x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53)) * weight, np.inf
            places = np.empty((PICK, full.size), np.int64)
            for k in range(PICK):
                least = np.minimum.reduceat(x, begin)
                at = np.flatnonzero(x == least[owner])
                at = at[np.searchsorted(owner[at], np.arange(full.size))]
                # a text with fewer k-mers than PICK repeats its last one
                places[k] = np.where(size > k, at, places[k - 1] if k else at)
                x[at] = last
            places.sort(axis=0)
            value = np.full(full.size, t + 1, np.uint64)
            for k in range(PICK):
                value = mix(value * _GOLD + lab[places[k]])
            out[t, full] = value
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, n, sig0, sig1, s0...) for ``docs`` (_row, doc_id, text)."""
    small_batches(docs.sparkSession)
    names = [f"s{t}" for t in range(SKETCHES)]

    def run(batches):
        for batch in batches:
            for i, rows, raw, offsets in text_chunks(batch.column(2)):
                h, n, sig = shingles(raw, offsets)
                values = sketches(h, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, rows), batch.column(1).slice(i, rows), pa.array(n.astype(np.int64)),
                     *[pa.array(x.view(np.int64)) for x in (*sig, *values)]],
                    names=["_row", "doc_id", "n", "sig0", "sig1", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_row long, doc_id {kind}, n long, sig0 long, sig1 long, "
                                + ", ".join(f"{s} long" for s in names))


def buckets(classes: DataFrame, which) -> DataFrame:
    """(id, n, component, t, v) of ``classes`` (id, n, component, s0...): its buckets of
    the sketches ``which``."""
    keys = [F.struct(F.lit(t).alias("t"), F.col(f"s{t}").alias("v")) for t in which]
    return classes.select("id", "n", "component", F.explode(F.array(*keys)).alias("k")).select("id", "n", "component", "k.t", "k.v")


def candidates(rows: DataFrame, least: float, heads_of: int = HEADS) -> DataFrame:
    """Distinct (member, rep) pairs of the buckets of ``rows``, each member with the
    bucket's representative if that is of another component and may be long enough."""
    mask = F.element_at(F.array(*[F.lit(m) for m in _MASKS[:heads_of]]), F.col("t") % heads_of + 1)
    own = F.col("id").bitwiseXOR(mask)
    heads = (rows.groupBy("t", "v").agg(F.min(own).alias("head"), F.min_by("n", own).alias("hn"),
                                        F.min_by("component", own).alias("hc"), F.min("component").alias("lo"),
                                        F.max("component").alias("hi"))
             .where("lo < hi").select("t", "v", "hn", "hc", F.col("head").bitwiseXOR(mask).alias("head")))
    heads = stored(heads, "heads")
    # a common subsequence is no longer than the shorter text
    near = F.least("n", "hn") >= least * F.greatest("n", "hn") - 1e-9
    pairs = stored(rows.hint("shuffle_merge").join(heads, ["t", "v"]).where((F.col("component") != F.col("hc")) & near)
                   .select(F.least("id", "head").alias("rep"), F.greatest("id", "head").alias("member")).distinct(), "candidates")
    discard(heads)
    return pairs


def mixed(rows: DataFrame) -> DataFrame:
    """The distinct ids of ``rows`` in buckets that hold several components."""
    many = rows.groupBy("t", "v").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("t", "v")
    return rows.hint("shuffle_merge").join(many, ["t", "v"]).select("id").distinct()


def regrouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the components that the ``links`` (a, b) between ids make."""
    of = classes.select("id", "component")
    ends = (links.join(of.select(F.col("id").alias("a"), F.col("component").alias("x")), "a")
            .join(of.select(F.col("id").alias("b"), F.col("component").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = components(ends)
    tops = found.select(F.col("id").alias("component"), F.col("component").alias("top"))
    new = stored(classes.join(tops, "component", "left").withColumn("component", F.coalesce("top", "component"))
                 .select(*classes.columns), "components")
    discard(found)
    return new


def linked(classes: DataFrame, texts: DataFrame, many: int, least: float, heads_of: int = HEADS) -> DataFrame:
    """The (a, b) between ids of ``classes`` that its ``many`` sketches lead to."""
    pairs = candidates(buckets(classes, range(many)), least, heads_of)
    links = stored(verified(pairs, texts, least), "links")
    discard(pairs)
    return links


def _slots(lab: np.ndarray) -> np.ndarray:
    return (lab >> np.uint64(64 - SLOTS_BITS)).astype(np.int64)


def slot_counts(texts: DataFrame) -> np.ndarray:
    """Number of k-mers per counter, for the column ``text``."""
    def run(batches):
        sums = np.zeros(1 << SLOTS_BITS, np.int64)
        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch.column(0)):
                h, n, _ = shingles(raw, offsets)
                sums += np.bincount(_slots(labelled(h, n)), minlength=sums.size)
        at = np.flatnonzero(sums)
        for i in range(0, at.size, 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[part])], names=["slot", "c"])

    got = (texts.select("text").mapInArrow(run, "slot long, c long").groupBy("slot")
           .agg(F.sum("c").alias("c")).toArrow())  # at most 1 << SLOTS_BITS rows
    out = np.zeros(1 << SLOTS_BITS, np.int64)
    out[got.column("slot").to_numpy()] = got.column("c").to_numpy()
    return out


PREFIX = "gram long, id long, component long, n long, place long, short boolean"


def prefixes(texts: DataFrame, least: float, shared) -> DataFrame:
    """For ``texts`` (id, component, text) the first labelled k-mers of each,
    rarest first by the broadcast counters ``shared``: as many as can hold the first one
    shared with a shorter text, ``short`` if it can also be the first one shared with a longer text."""
    def run(batches):
        counts = shared.value
        for batch in batches:
            for i, rows, raw, offsets in text_chunks(batch.column(2)):
                h, n, _ = shingles(raw, offsets)
                lab = labelled(h, n)
                owner = np.repeat(np.arange(rows), n)
                order = np.lexsort((lab, counts[_slots(lab)], owner))
                place = np.arange(lab.size) - np.repeat(np.cumsum(n) - n, n)
                size = n[owner]
                free = size - place  # k-mers from this one on
                keep = free >= least * size - 1e-9
                own = pa.array(owner[keep])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lab[order][keep].view(np.int64)), batch.column(0).slice(i, rows).take(own),
                     batch.column(1).slice(i, rows).take(own), pa.array(size[keep]), pa.array(place[keep]),
                     pa.array((free >= 2 * least * size / (1 + least) - 1e-9)[keep])],
                    names=["gram", "id", "component", "n", "place", "short"])

    return texts.select("id", "component", "text").mapInArrow(run, PREFIX)


def deviations(pivots: DataFrame, texts: DataFrame, least: float, shared) -> DataFrame:
    """Each text of ``pivots`` (pivot, id) against its pivot; ``texts`` is (id, text).
    ``size`` labelled k-mers stand in one of the two only, ``grams`` are the first of these, rarest
    first: the pivot's by how many lack them. ``far``: their Jaccard similarity is below
    ``least``; ``linked``: the texts are similar. The first ``shorts`` of ``grams`` can be the first
    one shared with a far text."""
    apart = (1 - least) / (1 + least)  # two texts at ``least`` differ by this share of their k-mers

    def run(batches):
        counts, head = shared.value, None
        for batch in batches:
            side, out = batch.column(2).to_numpy(), []
            for i, n, raw, offsets in text_chunks(batch.column(4)):
                h, count, _ = shingles(raw, offsets)
                lab, ends = labelled(h, count), np.cumsum(count)
                for j in range(n):
                    own = slice(ends[j] - count[j], ends[j])
                    if side[i + j] == 0:
                        head = h[own].copy(), lab[own].copy(), counts[_slots(lab[own])]
                        continue
                    new = lab[own][~np.isin(lab[own], head[1])]
                    gone = ~np.isin(head[1], lab[own])
                    grams = np.concatenate([new, head[1][gone]])
                    rare = np.concatenate([counts[_slots(new)], head[2].max() - head[2][gone]])
                    size, words, others = grams.size, own.stop - own.start, head[0].size
                    far = size > apart * (words + others) + 1e-9
                    most = min(size, int((1 - least) / least * words + 1e-9) + 1)
                    shorts = min(most, int((size + apart * (words - others)) / 2 + 1e-9) + 1)
                    out.append((i + j, words, size, shorts, far, not far and similar(head[0], h[own], least),
                                grams[np.lexsort((grams, rare))][:most if far else shorts].view(np.int64)))
            if not out:
                continue
            at, words, size, shorts, far, near, grams = zip(*out)
            ends = np.cumsum([0, *map(len, grams)])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(at)) for c in (0, 1, 3)], *[pa.array(x, pa.int64()) for x in (words, size, shorts)],
                 pa.array(far, pa.bool_()), pa.array(near, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), np.concatenate(grams))],
                names=["pivot", "salt", "id", "n", "size", "shorts", "far", "linked", "grams"])

    pairs = pivots.where("pivot <> id").select(F.col("id").alias("member"), F.col("pivot").alias("rep"))
    return dealt(pairs, texts.select(F.col("id").alias("_row"), "text")).mapInArrow(
        run, "pivot long, salt int, id long, n long, size long, shorts long, far boolean, linked boolean, grams array<long>")


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.greatest("x.id", "y.id").alias("member"), F.least("x.id", "y.id").alias("rep"))


def around_pivots(away: DataFrame, least: float) -> DataFrame:
    """The (member, rep) of different components in ``away`` (:func:`deviations` and
    component) that share a pivot and may have a Jaccard similarity of ``least``. What two texts
    differ by is what their differences from the pivot differ by; so a far text and one like it
    share more than half of the other's difference, and the prefix filter holds for differences."""
    x, y = F.col("x.n"), F.col("y.n")
    other = (F.col("x.component") != F.col("y.component")) & (F.least(x, y) >= least * F.greatest(x, y) - 1e-9)
    spread = stored(away.select("pivot", "id", "component", "n", "size", "shorts", "far", F.posexplode("grams").alias("place", "gram"))
                    .withColumn("short", F.col("place") < F.col("shorts")).drop("shorts"), "deviations")
    met = (spread.groupBy("pivot", "gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                               F.max("far").alias("f"), F.max("short").alias("s"))
           .where("lo < hi and f and s").select("pivot", "gram"))
    rows = stored(spread.join(met, ["pivot", "gram"]), "shared-deviations")
    discard(spread)
    # the part of both differences that two texts at ``least`` have in common
    need = (F.col("x.size") + F.col("y.size") - (1 - least) / (1 + least) * (x + y)) / 2 - 1e-9
    far = (rows.where("far").alias("x").join(rows.where("short").alias("y"), [F.col("x.pivot") == F.col("y.pivot"), F.col("x.gram") == F.col("y.gram")])
           .where(other & (~F.col("y.far") | (F.struct("y.size", "y.id") < F.struct("x.size", "x.id")))
                  & (F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place")) >= need)))
    # texts as near to the pivot but in another order may be like any near one
    near = away.where("not far").select("pivot", "salt", "id", "component", "n")
    odd = away.where("not far and not linked").select("pivot", "id", "component", "n").join(near.select("pivot", "salt").distinct(), "pivot")
    moved = odd.alias("x").join(near.alias("y"), [F.col("x.pivot") == F.col("y.pivot"), F.col("x.salt") == F.col("y.salt")]).where(other)
    found = stored(_pairs(far).union(_pairs(moved)).distinct(), "pivot-candidates")
    discard(rows)
    return found


def unlinked(texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that join all similar texts of different components of ``texts``
    (id, component, text), as a written table. Candidates are the pairs whose labelled k-mers have a Jaccard
    similarity of ``least``, by the prefix filter: pairs of a k-mer in up to ``FEW`` prefixes; of
    others the pairs with one pivot, the text that it leads, and then those that
    :func:`around_pivots` leaves between the components that are still apart."""
    shared = texts.sparkSession.sparkContext.broadcast(slot_counts(texts))
    every = stored(prefixes(texts, least, shared), "prefixes")
    first = F.struct(F.col("place") / F.col("n"), F.col("id"))
    met = (every.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("short").alias("s"),
                                     F.min_by("id", first).alias("pivot"), F.count(F.lit(1)).alias("many"))
           .where("lo < hi and s").select("gram", "pivot", (F.col("many") > FEW).alias("large")))
    rows = stored(every.join(met, "gram"), "shared-prefixes")
    discard(every)
    away = stored(deviations(rows.where("large").select("pivot", "id").distinct(), texts, least, shared), "pivots")
    links = stored(away.where("linked").select(F.col("pivot").alias("a"), F.col("id").alias("b")), "links")
    now = regrouped(texts.select("id", "component"), links)
    few = rows.where("not large").drop("component").join(now, "id")
    x, y = few.alias("x"), few.where("short").alias("y")
    # at the first shared k-mer what follows in both texts must hold all that is needed
    need = least * (F.col("x.n") + F.col("y.n")) / (1 + least) - 1e-9
    on = ((F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") != F.col("y.component"))
          & ((F.col("y.n") < F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.id") < F.col("x.id"))))
          & (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= need))
    around = around_pivots(away.join(now, "id"), least)
    pairs = stored(_pairs(x.join(y, on)).union(around).distinct(), "mixed-candidates")
    discard(rows, away, around, now)
    more = stored(links.union(verified(pairs, texts.select(F.col("id").alias("_row"), "text"), least)), "links")
    discard(pairs, links)
    return more


def common_length(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Length of the longest common subsequence if it is at least ``need``, else
    any smaller number: an alignment within the band that ``need`` leaves."""
    la, lb = labelled(a, np.array([a.size])), labelled(b, np.array([b.size]))
    ka, kb = np.isin(la, lb), np.isin(lb, la)
    shared = int(ka.sum())  # the most that can be aligned
    if shared < need or (la[ka] == lb[kb]).all():
        return shared if shared >= need else -1
    a, b = a[np.isin(a, b)], b[np.isin(b, a)]
    m = min(a.size, b.size)
    differ = np.flatnonzero(a[:m] != b[:m])
    head = int(differ[0]) if differ.size else m
    a, b = a[head:], b[head:]
    m = min(a.size, b.size)
    differ = np.flatnonzero(a[::-1][:m] != b[::-1][:m])
    tail = int(differ[0]) if differ.size else m
    a, b, need = a[:a.size - tail], b[:b.size - tail], need - head - tail
    band = a.size + b.size - 2 * max(need, 0)  # unmatched k-mers that may remain
    if band < 0:
        return -1
    best = np.zeros(b.size + 1, np.int32)
    for i in range(a.size):
        lo, hi = max(0, i - band), min(b.size, i + band + 1)
        if lo >= hi:
            break
        row = np.maximum(best[lo + 1:hi + 1], best[lo:hi] + (b[lo:hi] == a[i]))
        # outside the band stand values of earlier rows, which are lower bounds
        row[0] = max(row[0], best[lo])
        best[lo + 1:hi + 1] = np.maximum.accumulate(row)
    return head + tail + int(best.max(initial=0))


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Aligned Jaccard similarity of two k-mer sequences is at least ``least``."""
    both = a.size + b.size
    need = int(np.ceil(least * both / (1 + least) - 1e-9))
    if min(a.size, b.size) < need:
        return False
    got = common_length(a, b, need)
    return got >= need and got >= least * (both - got) - 1e-9


def dealt(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, salt, side, _row, text) of ``pairs`` (member, rep) and ``docs`` (_row, text): each
    rep in front of up to about ``PART`` of its members, in one task."""
    sizes = pairs.groupBy("rep").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    salt = F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")
    members = pairs.join(sizes, "rep").select(F.col("member").alias("_row"), "rep", salt.alias("salt"), F.lit(1).alias("side"))
    heads = members.select(F.col("rep").alias("_row"), "rep", "salt", F.lit(0).alias("side")).distinct()
    rows = docs.hint("shuffle_merge").join(members.union(heads), "_row").select("rep", "salt", "side", "_row", "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "rep", "salt").sortWithinPartitions("rep", "salt", "side")


def verified(pairs: DataFrame, docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The (a, b) of ``pairs`` (member, rep) whose texts are similar; ``docs`` is (_row, text)."""
    def run(batches):
        head = None
        for batch in batches:
            side, ident = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            a, b = [], []
            for i, n, raw, offsets in text_chunks(batch.column(4)):
                h, count, _ = shingles(raw, offsets)
                ends = np.cumsum(count)
                for j in range(n):
                    own = h[ends[j] - count[j]:ends[j]]
                    if side[i + j] == 0:
                        head = (ident[i + j], own.copy())
                    elif similar(head[1], own, least):
                        a.append(head[0])
                        b.append(ident[i + j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt(pairs, docs).mapInArrow(run, "a long, b long")


def _resketched(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``classes`` (id, n, component) of ``texts`` (_row, text) with the sketches that
    prefer rare k-mers."""
    shared = texts.sparkSession.sparkContext.broadcast(np.maximum(slot_counts(texts), 1))
    names = [f"s{t}" for t in range(RARE)]

    def run(batches):
        for batch in batches:
            for i, rows, raw, offsets in text_chunks(batch.column(1)):
                h, n, _ = shingles(raw, offsets)
                values = sketches(h, n, shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, rows), *[pa.array(x.view(np.int64)) for x in values]],
                                                 names=["id", *names])

    new = texts.select("_row", "text").mapInArrow(run, "id long, " + ", ".join(f"{x} long" for x in names))
    return stored(classes.select("id", "n", "component").join(new, "id"), "resketched")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least: float = SIMILARITY, exact: bool = True) -> DataFrame:
    """(_row, doc_id, group): for each row of ``docs`` its row number and the least
    row number of its class. The result is a written table."""
    src = stored(with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "_row"), "numbered")
    out = numbered_classes(src, least, exact)
    discard(src)
    return out


def numbered_classes(src: DataFrame, least: float = SIMILARITY, exact: bool = True) -> DataFrame:
    """:func:`near_classes` of a written table (_row, doc_id, text)."""
    texts = src.select("_row", "text")
    marks = stored(signatures(src.select("_row", "doc_id", "text")), "signatures")
    keys = ["n", "sig0", "sig1"]
    whole = stored(marks.where("n > 0").groupBy(*keys)
                   .agg(F.min("_row").alias("rep"), *[F.min(f"s{t}").alias(f"s{t}") for t in range(SKETCHES)]), "classes")
    columns = [f"s{t}" for t in range(SKETCHES)]
    classes = whole.select(F.col("rep").alias("id"), "n", F.col("rep").alias("component"), *columns)
    links = linked(classes, texts, SKETCHES, least)
    classes = regrouped(classes, links)
    left = stored(mixed(buckets(classes, range(SKETCHES))).withColumnRenamed("id", "_row"), "mixed")
    some = stored(texts.hint("shuffle_merge").join(left, "_row"), "mixed-texts")
    if exact:
        apart = some.join(classes.select(F.col("id").alias("_row"), "component"), "_row").withColumnRenamed("_row", "id")
        more = unlinked(apart, least)
    else:
        again = _resketched(some, classes)
        more = linked(again, some, RARE, least, RARE)
        discard(again)
    whole_classes, classes = classes, regrouped(classes, more)
    named = stored(whole.join(classes.select(F.col("id").alias("rep"), F.col("component").alias("group")), "rep")
                   .select(*keys, "group"), "class-groups")
    of = marks.where("n > 0").select("_row", "doc_id", *keys).join(named, keys).select("_row", "doc_id", "group")
    alone = marks.where("n = 0").select("_row", "doc_id", F.col("_row").alias("group"))
    out = stored(of.union(alone), "document-groups")
    discard(marks, whole, whole_classes, classes, named, left, some, links, more)
    return out


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with all its columns, the first row of each class only."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    rows = stored(with_row_id(docs, name), "numbered")
    src = rows.select(F.col(name).alias("_row"), F.col(docs.columns[0]).alias("doc_id"), F.col(text_col).alias("text"))
    groups = numbered_classes(src, least)
    gone = stored(groups.where("_row <> group").select("_row"), "later-copies")
    discard(groups)
    return rows.join(gone.withColumnRenamed("_row", name), name, "left_anti").select(*docs.columns)


def op1_minhash_neardup(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_size, kept."""
    rows = near_classes(docs)
    named = stored(rows.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")),
                   "class-names")
    return rows.join(named, "group").select(
        "doc_id", "class_id", F.col("class_size").cast("long").alias("class_size"), (F.col("_row") == F.col("group")).alias("kept"))
