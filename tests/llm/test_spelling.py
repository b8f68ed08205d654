"""Spelling variants: against all pairs in plain Python, long lists, random words, edge rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from thermogrid.llm import spelling as P
from thermogrid.llm.common import table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    out = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def neighbours(words):
    """Near words by the deletion of one code point."""
    by = {}
    for w in words:
        for x in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by.setdefault(x, set()).add(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            for b in group:
                if a != b and (abs(len(a) - len(b)) == 1 or len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1):
                    near[a].add(b)
    return near


def plain(n):
    near = neighbours(n)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = plain(counts([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert len(want) > 1000 and any(r[1] for r in want)
    assert got(P.op11_spelling_variants(docs)) == want


@pytest.mark.parametrize("limit", [1, 5, 60, 10 ** 6])
def test_full_lists_go_deeper(spark, limit):
    rng = random.Random(limit)
    words = {}
    while len(words) < 700:
        w = rng.choice(["", "", "pre", "prefixed"]) + "".join(rng.choice("abé") for _ in range(rng.randint(7, 10)))
        words[w] = rng.choice([2, 3, 25, 400, 5000])
    df = spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(3)
    assert got(P.variants(df, max_list=limit)) == plain(words)


def test_scan_of_one_list():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(400)})
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    first = np.zeros(len(words), bool)
    first[[0, 150]] = True
    a, b, shared = P.near_pairs(flat, off, first)
    near = neighbours(words)
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if words[j] in near[words[i]] and (i < 150) == (j < 150)}
    assert len(a) == len(want) and set(zip(a.tolist(), b.tolist())) == want
    for i, j, s in zip(a, b, shared):
        k = 0
        while k < min(len(words[i]), len(words[j])) and words[i][k] == words[j][k]:
            k += 1
        assert k == s


def test_edge_rows(spark):
    long = "abcdefghij" * 200
    rows = [(1, None), (2, ""), (3, "short words on"), (4, "Straßen straßen STRAßEN strassen strasen"), (4, "Straßen strassen"),
            (None, "kitchen kitchen kitten"), (5, f"{long} {long}x"), (6, f"{long} {long}x"), (7, "recieve9recieve receive×recieve recieves recieves receeive receeive"),
            *[(10 + i, "receive receive receive receive") for i in range(12)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' as word", "1 as n", "2 as list", "3 as short")
    want = plain(counts(rows))
    assert any(r[1] for r in want) and got(P.op11_spelling_variants(docs)) == want
    assert P.op11_spelling_variants(docs.limit(0)).count() == 0
