"""Repeated 200-byte strings against counting every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from thermogrid.llm import suffix_dedup as S
from thermogrid.llm.common import table


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if seen[r[i:i + 200]] > 1:
                gone[i:i + 200] = b"\x01" * 200
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.orderBy("doc_id").collect()]


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = brute([r.text for r in docs.select("doc_id", "text").orderBy("doc_id").collect()])
    assert sum(w[1] for w in want) > 0
    assert rows(S.op3_suffix_dedup(docs)) == want


def made(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(1, 9)))
    text = lambda n: "".join(word() for _ in range(n))
    base = [text(150) for _ in range(4)]
    texts = [None, "", "x" * 199, "x" * 200, "x" * 201, "y" * 1000, "ab" * 300, "short", *base, base[0]]
    for _ in range(40):
        a, b = rnd.choice(base), rnd.choice(base)
        i, j = rnd.randint(0, len(a)), rnd.randint(0, len(b))
        n = rnd.choice([198, 199, 200, 201, 230, 330, 500])
        texts.append(text(rnd.randint(0, 30)) + a[i:i + n] + text(rnd.randint(0, 20)) + b[j:j + rnd.randint(150, 400)])
    common = text(60)[:260]
    texts += [text(rnd.randint(5, 20)) + common + text(rnd.randint(5, 20)) for _ in range(30)]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts(spark, seed):
    texts = made(seed)
    docs = spark.createDataFrame([(i, t, "a", 1, 2) for i, t in enumerate(texts)],
                                 "doc_id long, text string, row string, lo int, name int").repartition(5, "doc_id")
    held = docs.cache()
    assert rows(S.op3_suffix_dedup(held)) == brute(texts)
    held.unpersist()


def test_long_text_in_pieces():
    """A text cut into overlapping pieces names the same windows as a whole one."""
    rnd = np.random.default_rng(4)
    x = rnd.integers(97, 101, 5000).astype(np.uint8)
    a, lo, hi, _, _ = S.samples(x, np.array([x.size]))
    whole = {p: s for s, b, e in zip(a, lo, hi) for p in range(b, e + 1)}
    parts = {}
    for base in range(0, 5000, 700):
        y = x[base:base + 700 + 199]
        if y.size >= 200:
            a, lo, hi, _, _ = S.samples(y, np.array([y.size]))
            parts |= {p + base: s + base for s, b, e in zip(a, lo, hi) for p in range(b, e + 1)}
    assert parts == whole and sorted(whole) == list(range(4801))


def test_repeated_and_empty(spark):
    t = "".join(chr(97 + i * i % 23) for i in range(400))
    docs = spark.createDataFrame([(1, t), (1, t), (None, t[:200])], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed) for r in S.op3_suffix_dedup(docs).collect()) == [(200, 200), (400, 400), (400, 400)]
    assert S.op3_suffix_dedup(docs.limit(0)).count() == 0
