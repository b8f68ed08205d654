"""Lattice scores against a word-by-word sum over segmentations, base scores against plain counting."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from thermogrid.llm import lattice_lm as L
from thermogrid.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pieces():
    return L.Pieces()


def marginal(word, index, weights):
    """Sum over all segmentations, by definition."""
    s = L.MARK + word

    def total(i):
        return 1.0 if i == len(s) else sum(math.exp(weights[index[s[i:j]]]) * total(j)
                                           for j in range(i + 1, len(s) + 1) if s[i:j] in index)
    return total(0)


def test_forward_sums_all_segmentations(pieces):
    lat = L.Lattice(pieces.bytes, pieces.start)
    words = [b"a", b"the", b"thing,", "é".encode(), b"\xff\x00", b"x***y"]
    got = lat.log_probabilities([*words, b"", b"the" * 50])
    for w, x in zip(words, got):
        assert math.isclose(math.exp(x), marginal(w, lat.index, pieces.start), rel_tol=1e-9)
    assert math.isclose(got[len(words)], pieces.start[-1])
    assert math.isclose(np.exp(pieces.start).sum(), 1.0)


def test_long_words_agree_with_rows(pieces):
    lat = L.Lattice(pieces.bytes, pieces.start)
    words = [b"thingofthe", b"a" * 40, b"zz-top!"]
    by_rows = lat.log_probabilities(words)
    one = [lat._long(L.MARK + w)[0][-1] for w in words]
    assert np.allclose(by_rows, one)
    times = np.array([2.0, 1.0, 3.0])
    e = lat.expected(words, times)
    old, L.LONG_WORD = L.LONG_WORD, 0
    try:
        assert np.allclose(e, lat.expected(words, times))
    finally:
        L.LONG_WORD = old
    # expected pieces cover the words' bytes
    size = sum(x * len(p) for x, p in zip(e, pieces.bytes))
    assert math.isclose(size, sum(t * (len(w) + 3) for t, w in zip(times, words)), rel_tol=1e-9)


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, lattice):
    toks = [tokens(t) for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(x for t, h in zip(toks, held) if not h for x in t)
    n, v = sum(c.values()), len(c)
    out = []
    for t, h in zip(toks, held):
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        score = lattice.log_probabilities([(x or "").encode() for x in t]).sum() / math.log(10)
        out.append((h, len(t), sum(c[x] > 0 for x in t), n, base, score))
    return out, c


def model(c, pieces):
    start = L.Lattice(pieces.bytes, pieces.start)
    words = list(c)
    x = L.PIECE_PRIOR + start.expected([(w or "").encode() for w in words], np.array([c[w] for w in words], float))
    return L.Lattice(pieces.bytes, np.log(x / x.sum()))


def compare(docs, pieces, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    c = brute(rows, L.Lattice(pieces.bytes, pieces.start))[1]
    want, _ = brute(rows, model(c, pieces) if c else L.Lattice(pieces.bytes, pieces.start))
    got = L.op8_lm_scoring(docs, **options).collect()
    key = lambda x: (str(x[0]), *map(float, x[1]))
    a = sorted(((r[0], r[1:]) for r in got), key=key)
    b = sorted(((i, w) for (i, _), w in zip(rows, want)), key=key)
    assert [(i, x[:4]) for i, x in a] == [(i, x[:4]) for i, x in b]
    assert np.allclose([x[4:] for _, x in a], [x[4:] for _, x in b], rtol=1e-6)


def test_documents(spark, pieces):
    compare(table(spark, SF, "documents"), pieces)


def test_small_blocks(spark, pieces):
    rows = [(i, t, "x", 1) for i, t in enumerate(["a b a", None, "", "A\tb\x0bc\x1cd", "z" * 3000, "b b b", "é É", "a b a"])]
    docs = spark.createDataFrame([*rows, (None, "a", "", 0), (0, "a b", "", 0)],
                                 "doc_id long, text string, word string, block int")
    compare(docs, pieces, block_tokens=3)
    assert L.op8_lm_scoring(docs.limit(0)).count() == 0
