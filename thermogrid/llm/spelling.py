"""Spelling variants: words one edit apart, each led to its far more frequent form.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point. The vocabulary is scanned as a sorted list: a word's edit matrix against the
words behind it keeps, for each depth, the three cells around the diagonal. What the
next word shares with the last one (their longest common prefix) needs no new rows, and
when no cell of a row is within one edit, all words with that prefix are skipped. The
scans of all words of a list advance together, one row per step, in numpy.

Lists are short by construction. Words that agree beyond their first ``PREFIX`` code points
meet in the list of their prefix. Pairs that differ inside it agree in all that follows, and
meet in the list of that ending and of the shorter word's length. A prefix with more than
``MAX_LIST`` words is not one list: its words go on to the lists of a prefix ``DEEPER``
code points longer, and the pairs that differ inside these code points to lists of what
stands around them. Each pair is found in one list; a list of endings is bounded by
the alphabet.

Edge cases: null and empty texts have no words; equal rows count as often as they stand
there; a null id is the empty text. Words of any length are compared whole. Among near
words of equal count the first in code-point order is the form. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import flat_ranges, lower_ascii, stored

RUN = "[a-zÀ-ÿ]"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10       # a form occurs at least so many times as often as the word
TYPO = 31        # of so many runs, one loses a code point
PREFIX = 3
DEEPER = 2
MAX_LIST = 16384
STEP_ROWS = 50_000          # words scanned together; a longer list is taken whole
STACK_CELLS = 4_000_000     # rows of edit matrices held at once


# ------------------------------------------------------------------ the sorted list

def _prefix_lengths(flat: np.ndarray, off: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Code points that each word shares with the one before it; -1 for the first word
    of a list and behind the last one."""
    n = off.size - 1
    lcp = np.full(n + 1, -1, np.int64)
    at = np.flatnonzero(~first)
    shortest = np.minimum(off[at + 1] - off[at], off[at] - off[at - 1])
    lcp[at] = 0
    while at.size:
        d = lcp[at]
        more = d < shortest
        at, shortest, d = at[more], shortest[more], d[more]
        same = flat[off[at] + d] == flat[off[at - 1] + d]
        at, shortest = at[same], shortest[same]
        lcp[at] += 1
    return lcp


def _next_smaller(lcp: np.ndarray) -> np.ndarray:
    """For each place the next one whose prefix is shorter."""
    last = lcp.size - 1
    after = np.minimum(np.arange(1, last + 2), last)
    while True:
        go = np.flatnonzero((lcp[after] >= lcp) & (after < last))
        if not go.size:
            return after
        after[go] = after[after[go]]


def near_pairs(flat: np.ndarray, off: np.ndarray, first: np.ndarray):
    """(a, b, shared) for all words a before b of one list that are one edit apart, with
    the length of their common prefix. Words are ``flat[off[i]:off[i + 1]]``, sorted within
    each list; ``first`` marks where a list begins."""
    lcp = _prefix_lengths(flat, off, first)
    after = _next_smaller(lcp)
    lens = np.diff(off)
    begins = np.flatnonzero(lcp[1:] >= 0)  # words with a word behind them
    order = begins[np.argsort(lens[begins], kind="stable")]
    found = []
    i = 0
    while i < order.size:
        # longest word last: as many as the room for their rows allows
        size = (lens[order[i:]] + 3) * np.arange(1, order.size - i + 1)
        j = i + max(1, int(np.searchsorted(size, STACK_CELLS, side="right")))
        found.append(_scan(flat, off, lens, lcp, after, order[i:j]))
        i = j
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _scan(flat, off, lens, lcp, after, mine):
    """The pairs whose first word is one of ``mine``."""
    width = int(lens[mine].max()) + 3
    # row d of a word against its own prefix: 0 on the diagonal, 1 beside it
    rows = np.empty((mine.size, width, 3), np.int8)
    rows[:] = np.array([1, 0, 1], np.int8)
    # code points of the scanning words, with a mark on either side that equals nothing
    own = np.full((mine.size, width + 2), -1, np.int32)
    owner = np.repeat(np.arange(mine.size), lens[mine])
    own[owner, flat_ranges(np.ones(mine.size, np.int64), lens[mine])] = flat[flat_ranges(off[mine], lens[mine])]
    q = np.arange(mine.size)
    cur = mine + 1
    depth = lcp[cur].copy()
    shared = depth.copy()
    out = []
    while q.size:
        ended = depth == lens[cur]
        e = np.flatnonzero(ended)
        if e.size:
            cell = lens[mine[q[e]]] - depth[e] + 1
            inside = (cell >= 0) & (cell <= 2)
            hit = e[inside][rows[q[e[inside]], depth[e[inside]], cell[inside]] == 1]
            out.append((mine[q[hit]], cur[hit], shared[hit]))
        g = np.flatnonzero(~ended)
        d = depth[g]
        w = flat[off[cur[g]] + d]
        qg = q[g]
        prev = rows[qg, d]
        a = np.minimum(prev[:, 0] + (own[qg, d] != w), prev[:, 1] + 1)
        b = np.minimum(np.minimum(prev[:, 1] + (own[qg, d + 1] != w), prev[:, 2] + 1), a + 1)
        c = np.minimum(prev[:, 2] + (own[qg, d + 2] != w), b + 1)
        alive = np.minimum(np.minimum(a, b), c) <= 1
        alive &= d + 1 < width
        k = g[alive]
        rows[q[k], depth[k] + 1] = np.stack([a, b, c], axis=1)[alive].astype(np.int8)
        depth[k] += 1
        # the others leave this prefix: on to the next word that does not have it
        move = ended
        move[g[~alive]] = True
        m = np.flatnonzero(move)
        nxt = cur[m] + 1
        over = np.flatnonzero(lcp[nxt] > depth[m])
        while over.size:
            nxt[over] = after[nxt[over]]
            over = over[lcp[nxt[over]] > depth[m[over]]]
        cur[m] = nxt
        depth[m] = lcp[nxt]
        shared[m] = np.minimum(shared[m], depth[m])
        if (depth[m] < 0).any():
            keep = depth >= 0
            q, cur, depth, shared = q[keep], cur[keep], depth[keep], shared[keep]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


# ------------------------------------------------------------------ lists as Spark groups

def _lists(words: DataFrame, low: int, high: int | None) -> DataFrame:
    """(list, short, word, n): the lists of pairs whose common prefix has ``low`` to
    ``high`` - 1 code points; without ``high`` the lists of the prefix ``low``."""
    word = F.col("word")
    head = word.substr(1, low) if low else F.lit("")
    if high is None:
        return words.select(F.xxhash64(head).alias("list"), F.lit(-1).alias("short"), "word", "n")
    # what follows the code points in question, for the shorter word of a pair
    short = F.explode(F.array(F.length(word), F.length(word) - 1))
    rows = words.select("word", "n", short.alias("short")).where(F.col("short") >= MIN_LENGTH - 1)
    rest = F.greatest(F.col("short") - high, F.lit(0))
    ending = F.when(rest > 0, F.expr(f"right(word, greatest(short - {high}, 0))")).otherwise("")
    return rows.select(F.xxhash64(head, ending, "short").alias("list"), "short", "word", "n")


NEAR = "word string, near long, best_n long, best string"


def _near(lists: DataFrame, low: int, high: int | None) -> DataFrame:
    """Per word and list: its near words, the most frequent one and its count."""
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lists.repartition(parts, "list").sortWithinPartitions("list", "word")
    top = high if high is not None else 1 << 62

    def solve(table: pa.Table):
        key, short, n = (table.column(c).to_numpy() for c in (0, 1, 3))
        col = table.column(2).combine_chunks()
        words = col.to_pylist()
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
        first = np.ones(key.size, bool)
        first[1:] = key[1:] != key[:-1]
        a, b, shared = near_pairs(flat, off, first)
        lens = np.diff(off)
        ok = (shared >= low) & (shared < top)
        if high is not None:  # two words of the longer length meet in their own list
            ok &= (short[a] == short[b]) & (np.minimum(lens[a], lens[b]) == short[a])
        a, b = np.concatenate([a[ok], b[ok]]), np.concatenate([b[ok], a[ok]])
        order = np.lexsort((b, -n[b], a))  # places are in code-point order
        a, b = a[order], b[order]
        new = np.ones(a.size, bool)
        new[1:] = a[1:] != a[:-1]
        f = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays(
            [col.take(pa.array(a[f])), pa.array(np.diff(np.append(f, a.size))), pa.array(n[b[f]]),
             col.take(pa.array(b[f]))], names=["word", "near", "best_n", "best"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= STEP_ROWS:
                # whole lists only; the one that may go on stays
                table = pa.Table.from_batches(held).combine_chunks()
                key = table.column(0).to_numpy()
                cut = int(np.searchsorted(key, key[-1], side="left"))
                if cut:
                    yield solve(table.slice(0, cut))
                    held, rows = table.slice(cut).to_batches(), table.num_rows - cut
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield solve(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, NEAR)


def near_words(words: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """(word, near, best_n, best) of the distinct words (word, n) that have a near one."""
    parts = [_near(_lists(words, 0, PREFIX), 0, PREFIX)]
    left, depth = words, PREFIX
    while True:
        head = F.col("word").substr(1, depth)
        sizes = left.groupBy(head.alias("head")).agg(F.count(F.lit(1)).alias("k"))
        full = stored(sizes.where(F.col("k") > max_list).select("head"), "full-lists")
        hot = None if full.isEmpty() else stored(left.join(full, head == full["head"], "left_semi"), "full-words")
        small = left if hot is None else left.join(full, head == full["head"], "left_anti")
        parts.append(_near(_lists(small, depth, None), depth, None))
        if hot is None:
            break
        parts.append(_near(_lists(hot, depth, depth + DEEPER), depth, depth + DEEPER))
        left, depth = hot, depth + DEEPER
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return (found.groupBy("word").agg(F.sum("near").alias("near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
            .select("word", "near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


# ------------------------------------------------------------------ words and their forms

def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int = TYPO) -> DataFrame:
    """(word, n) of runs of letters with at least ``MIN_LENGTH`` code points and ``MIN_COUNT``
    occurrences, after the deletion of one code point in every ``typo``-th run by hash."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(f"{RUN}{{{MIN_LENGTH},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    run = F.col("run")
    place = (F.col("h") % F.length(run)).cast("int")
    cut: Column = F.concat(run.substr(F.lit(1), place), run.substr(place + 2, F.length(run)))
    word = F.when(F.col("h") % typo == 0, cut).otherwise(run)
    return (runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT))


def roots(forms: DataFrame) -> DataFrame:
    """(form, root) for every distinct form of (word, form): the last word of its chain. A
    round doubles the steps taken; counts grow along a chain, so it ends."""
    steps = stored(forms.select("form").distinct().join(
        forms.select(F.col("word").alias("form"), F.col("form").alias("next")), "form", "left")
        .select("form", F.coalesce("next", "form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("form").alias("root"), F.col("root").alias("top"))
        new = stored(steps.join(ahead, "root").select("form", F.col("top").alias("root"),
                                                      (F.col("top") != F.col("root")).alias("moved")), "roots")
        steps = new.drop("moved")
        if new.where("moved").isEmpty():
            return steps


def variants(words: DataFrame, ratio: int = RATIO, max_list: int = MAX_LIST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the distinct words (word, n)."""
    near = near_words(words, max_list)
    rows = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n")), "forms")
    led = rows.where("form is not null")
    ended = led.join(roots(led.select("word", "form")), "form").select("word", "form", "root", "n", "n_near", "form_n")
    alone = rows.where("form is null").select("word", "form", F.col("word").alias("root"), "n", "n_near", "form_n")
    return ended.unionByName(alone)


def op11_spelling_variants(docs: DataFrame) -> DataFrame:
    return variants(stored(word_counts(docs), "words"))
