"""Decontamination against a plain scan; the query also has an SQL oracle."""

import hashlib
import re

import numpy as np
import pytest

from thermogrid.llm import decontam as D
from thermogrid.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    wins = []
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        wins += [("" if i is None else str(i), tuple(w[k:k + n])) for k in range(len(w) - n + 1) if n]
    out = []
    for t in texts:
        w = words(t)
        hit, ids = set(), set()
        for i, win in wins:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    ids.add(i)
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short item"), (3, "Été, À l'ÉCOLE"),
         (10, "one TWO"), (None, "null id here"), (4, None), (5, "!!!"), (1, "another text of item one"),
         (6, "one two three four five six seven eight nine ten")]
TEXTS = [None, "", "!!!", "one two three four five six seven eight nine ten", "ONE-two,three four five six seven eight nine ten eleven",
         "x two three four five six seven eight nine ten eleven twelve y", "short item short item", "short. ITEM", "shortitem",
         "a été, à l'École b", "Été à l École", "null id here", "short", "item", "word " * 50000 + "short item " + "word " * 10,
         "short\x00item", "short\x7fitem", "shorté item"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, items string, n_hit int").repartition(1)
    return docs, spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")


def rows(df):
    return [(r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.orderBy("doc_id").collect()]


def test_made_texts(tables):
    assert rows(D.op2_decontamination(*tables)) == brute(TEXTS, ITEMS)


def test_blocks_give_the_same(tables):
    a = sorted(map(str, D.report(*tables).collect()))
    b = sorted(map(str, D.report(*tables, max_broadcast_bytes=40).collect()))
    assert a == b


def test_documents(spark):
    docs, bench = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    texts = [r.text for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    fast = {}
    for i, t in items:  # the plain scan is slow: keep texts and items that share a word run
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1):
            fast.setdefault(tuple(w[k:k + n]), []).append(i)
    got = rows(D.op2_decontamination(docs, bench))
    for t, g in zip(texts, got):
        w = words(t)
        near = {i for n in {len(k) for k in fast} for k in range(len(w) - n + 1) for i in fast.get(tuple(w[k:k + n]), ())}
        assert g == brute([t], [x for x in items if x[0] in near])[0]


def test_modes(tables):
    docs, bench = tables
    want = brute(TEXTS, ITEMS)
    kept = D.decontaminate(docs, bench, "documents")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, w in enumerate(want) if not w[4]]
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, bench, "spans").collect()}
    assert cut[0] is None and cut[7] == "" and cut[8] == "shortitem" and cut[6] == ""
    for i, t in enumerate(TEXTS):
        assert len(words(cut[i])) == want[i][0] - want[i][1]


def test_empty_tables(tables):
    docs, bench = tables
    assert D.op2_decontamination(docs.limit(0), bench).count() == 0
    assert all(not r.contaminated for r in D.op2_decontamination(docs, bench.limit(0)).collect())


def test_a_large_benchmark_is_built_in_arrays():
    """4 MB of items: seconds, and no more than some multiple of the text."""
    import pickle
    import time
    rng = np.random.default_rng(1)
    words = [f"w{i:05d}" for i in range(20000)]
    items = [(str(i), " ".join(words[k] for k in rng.integers(0, 20000, 120))) for i in range(4800)] + [("x", "short item"), ("y", "short item")]
    t = time.time()
    built = D.Windows(items, 10)
    size = len(pickle.dumps(built))
    text = sum(len(x) for _, x in items)
    assert text > 4_000_000 and time.time() - t < 20 and size < 10 * text


def test_windows_that_share_a_hash(monkeypatch):
    """With every hash equal, bytes alone decide."""
    monkeypatch.setattr(D.SpanHash, "spans", lambda self, prefix, a, b: np.full(len(a), 7 << 48, np.uint64))
    items = [("1", "a b c"), ("2", "b c d"), ("3", "a b c"), ("4", "q")]
    built = D.Windows(items, 3)
    raw = np.frombuffer(b"z a b c d q", np.uint8)
    got = sorted((int(p), n, tuple(ids)) for places, n, ids in built.scan(D.Words(raw, np.array([0, raw.size]))) for p in places)
    assert got == [(1, 3, ("1", "3")), (2, 3, ("2",)), (5, 1, ("4",))]
