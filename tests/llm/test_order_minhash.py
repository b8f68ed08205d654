"""Order MinHash classes against all pairs, and the banded alignment against a plain one."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from thermogrid.llm import order_minhash as M
from thermogrid.llm.common import table, text_chunks

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def kmers(text):
    w = words(text)
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        was = row[:]
        for j, y in enumerate(b):
            row[j + 1] = was[j] + 1 if x == y else max(row[j], was[j + 1])
    return row[-1]


def alike(a, b):
    shared = sum((Counter(a) & Counter(b)).values())
    if not shared or shared < 0.8 * (len(a) + len(b) - shared) - 1e-9:
        return False
    n = lcs(a, b)
    return n >= 0.8 * (len(a) + len(b) - n) - 1e-9


def brute(texts):
    """Index of the first text of each text's class."""
    k = [kmers(t) for t in texts]
    of = {}
    for i, x in enumerate(k):
        for g in set(x):
            of.setdefault(g, []).append(i)
    top = list(range(len(texts)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    done = set()
    for group in of.values():
        for p, i in enumerate(group):
            for j in group[p + 1:]:
                if (i, j) not in done:
                    done.add((i, j))
                    if alike(k[i], k[j]):
                        a, b = sorted((find(i), find(j)))
                        top[b] = a
    return [find(i) for i in range(len(texts))]


def test_alignment():
    rng = np.random.default_rng(1)
    for _ in range(400):
        a = rng.integers(0, 40, rng.integers(1, 60)).astype(np.uint64)
        b = a.copy()
        for _ in range(rng.integers(0, 6)):
            i = int(rng.integers(0, b.size))
            change = rng.integers(0, 3)
            if change == 0 and b.size > 1:
                b = np.delete(b, i)
            elif change == 1:
                b = np.insert(b, i, rng.integers(0, 40))
            else:
                b = np.roll(b, 3)
        n = lcs(a.tolist(), b.tolist())
        assert M.similar(a, b) == (n >= 0.8 * (a.size + b.size - n) - 1e-9)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_documents(spark, sf):
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    top = brute([r.text for r in rows])
    want = {r.doc_id: rows[t].doc_id for r, t in zip(rows, top)}
    got = {r.doc_id: r.class_id for r in M.op1_minhash_neardup(docs).collect()}
    assert got == want


def made():
    base = "one two three four five six seven eight nine ten eleven twelve".split()
    long = [f"w{i}" for i in range(400)]
    edit = long[:200] + ["changed"] + long[201:]
    back = long[200:] + long[:200]
    cut = [" ".join(long[:k] + [f"e{k}"] + long[k + 1:]) for k in range(0, 400, 7)]
    return [None, "", "!!!", "short", "Short.", "short text", " ".join(base), " ".join(base).upper(), " ".join(base[:9]),
            " ".join(long), " ".join(edit), " ".join(back), "x y " * 600, "x y " * 601, " ".join(long), *cut]


def test_made_texts_and_clashing_columns(spark):
    texts = made()
    docs = spark.createDataFrame([(i, t, "a", 1, 2) for i, t in enumerate(texts)],
                                 "doc_id long, text string, _row string, group int, rep int")
    got = {r.doc_id: (r.class_id, r.kept) for r in M.op1_minhash_neardup(docs).collect()}
    assert got == {i: (t, t == i) for i, t in enumerate(brute(texts))}
    kept = M.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({t for t in brute(texts)})


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    assert sorted((r.class_id, r.class_size, r.kept) for r in M.op1_minhash_neardup(docs).collect()) == \
        [(1, 3, False), (1, 3, False), (1, 3, True)]
    assert M.op1_minhash_neardup(docs.limit(0)).count() == 0
    assert M.drop_near_duplicates(docs).count() == 1


def templated(n_others=1500, n_pairs=60, words_own=36, template=170):
    """Texts of one template; pairs of them that are alike, hidden among others that are not."""
    rng = np.random.default_rng(7)
    body = [f"t{i}" for i in range(template)]
    texts, serial = [], 0
    for i in range(n_others + n_pairs):
        own = [f"o{serial + j}" for j in range(words_own)]
        serial += words_own
        texts.append(" ".join(body + own))
        if i < n_pairs:
            k = int(rng.integers(8, words_own - 8))
            texts.append(" ".join(body + own[:k] + [f"c{i}", f"d{i}", f"e{i}"] + own[k + 3:]))
    order = rng.permutation(len(texts))
    return [texts[i] for i in order]


def test_texts_of_one_template(spark):
    texts = templated()
    k = [set(kmers(t)) for t in texts]
    tops = list(range(len(texts)))
    own = {}  # texts that share a word of their own; others share the template alone, below 0.8
    for i, t in enumerate(texts):
        own.setdefault(t.split()[170], []).append(i)
    assert len(k[0] & k[1]) / len(k[0] | k[1]) < 0.8
    for same in own.values():
        if len(same) == 2:
            assert alike(kmers(texts[same[0]]), kmers(texts[same[1]]))
            tops[same[1]] = same[0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in M.op1_minhash_neardup(docs).collect()}
    assert got == dict(enumerate(tops))


def test_no_pair_of_a_bucket_is_left_out(spark):
    """Pairs just above the threshold among texts of one template just below it."""
    body, texts = [f"t{i}" for i in range(164)], []
    for i in range(200):
        own = [f"o{i}-{j}".replace("-", "x") for j in range(22)]
        texts.append(" ".join(body + own))
        if i < 20:
            texts.append(" ".join(body + own[:3] + [f"c{i}x{j}" for j in range(19)]))
    k = [kmers(t) for t in texts]
    assert alike(k[0], k[1]) and not alike(k[0], k[2]) and not alike(k[0], k[3]) and not alike(k[-1], k[-2])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in M.op1_minhash_neardup(docs).collect()}
    assert got == {i: i - i % 2 if i < 40 else i for i in range(len(texts))}
    assert M.drop_near_duplicates(docs).count() == 200


def edited(rng, base, edits, serial):
    out = list(base)
    for e, at in enumerate(sorted(rng.choice(len(base) // 6, edits, replace=False) * 6, reverse=True)):
        out[at:at + 1] = [[], [f"n{serial}x{e}"], [f"n{serial}x{e}", out[at]]][int(rng.integers(0, 3))]
    return out


def near_copies(n):
    """Copies of one text: like it, almost like it, twins of these, and some in another order."""
    rng = np.random.default_rng(11)
    base, texts = [f"b{i}" for i in range(120)], []
    for i in range(n):
        own = edited(rng, base, int(rng.integers(1, 5) if i % 2 else rng.integers(5, 7)), i)
        texts.append(own)
        if i % 10 == 4:
            texts.append(edited(rng, own, 2, f"t{i}"))
        if i in (0, 20):
            cut = 20 + i % 80
            texts += [base[cut:] + base[:cut], edited(rng, base[cut:] + base[:cut], 1, f"m{i}")]
    return [" ".join(texts[i]) for i in rng.permutation(len(texts))]


def test_pairs_of_a_group_of_near_copies(spark, monkeypatch):
    """Every link inside the group, from pairs that grow with its texts and not with their square."""
    pairs = []
    verified = M.verified

    def counted(found, *others):
        pairs[-1] += found.count()
        return verified(found, *others)

    monkeypatch.setattr(M, "verified", counted)
    for n in (40, 240):
        texts = near_copies(n)
        docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, component long, text string")
        pairs.append(0)
        links = M.unlinked(docs, M.SIMILARITY)
        if links.columns == ["member", "rep"]:
            pairs[-1] = links.count()
        else:
            got = M.regrouped(docs.select("id", "component"), links)
            if n == 40:
                assert {r.id: r.component for r in got.collect()} == dict(enumerate(brute(texts)))
    assert pairs[1] < 10 * len(texts), pairs


def test_links_of_random_groups(spark):
    """Texts of several bases of different lengths, one of them part of another, in one search."""
    rng = np.random.default_rng(12)
    long = [f"l{i}" for i in range(150)]
    bases = [long, long[:124], long[:60] + [f"k{i}" for i in range(80)], ["same"] * 20 + [f"s{i}" for i in range(90)]]
    texts = [" ".join(edited(rng, bases[i % 4], int(rng.integers(0, 9)), i)) for i in range(48)]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, component long, text string")
    got = M.regrouped(docs.select("id", "component"), M.unlinked(docs, M.SIMILARITY))
    assert {r.id: r.component for r in got.collect()} == dict(enumerate(brute(texts)))


def test_memory_of_a_batch():
    """Signatures of 8 MB of text take a bounded part of it at a time."""
    rng = np.random.default_rng(13)
    texts = pa.array([" ".join(f"w{x}" for x in rng.integers(0, 10_000, 300)) for _ in range(5000)])
    tracemalloc.start()
    try:
        for _, _, raw, offsets in text_chunks(texts):
            h, n, _ = M.shingles(raw, offsets)
            M.sketches(h, n)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20, peak
