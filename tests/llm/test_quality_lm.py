"""Kneser-Ney probabilities against a dictionary version; verdicts on labelled texts."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from thermogrid.llm import quality_lm as Q
from thermogrid.llm.common import table

N = Q.ORDER


class Plain:
    """Interpolated modified Kneser-Ney by its definition."""

    def __init__(self, texts):
        c = Counter()
        for t in texts:
            if t:
                s = "\x02" * (N - 1) + t + "\x03"
                c.update(s[i:i + N] for i in range(len(s) - N + 1))
        self.c = {N: c}
        for k in range(N - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d, self.ctx = {}, {}
        for k in range(1, N + 1):
            n = Counter(min(v, 5) for v in self.c[k].values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
            self.d[k] = [max(0.0, min(i, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] else i * 0.5 for i in (1, 2, 3)]
            t, g = defaultdict(int), defaultdict(float)
            for gram, v in self.c[k].items():
                t[gram[:-1]] += v
                g[gram[:-1]] += self.d[k][min(v, 3) - 1]
            self.ctx[k] = (t, g)

    def p(self, gram):
        if not gram:
            return 1 / (len(self.c[1]) + 1)
        k, (t, g) = len(gram), self.ctx[len(gram)]
        low = self.p(gram[1:])
        if gram[:-1] not in t:
            return low
        v = self.c[k].get(gram, 0)
        return max(v - (self.d[k][min(v, 3) - 1] if v else 0), 0) / t[gram[:-1]] + g[gram[:-1]] / t[gram[:-1]] * low

    def perplexity(self, text):
        s = "\x02" * (N - 1) + text + "\x03"
        return math.exp(-sum(math.log(self.p(s[i:i + N])) for i in range(len(s) - N + 1)) / (len(text) + 1))


TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "été à la mer", "", None, "the the the", "\U0001f600 ok"]


def test_perplexity_by_definition(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")
    held = {r.doc_id for r in docs.where(Q._held("doc_id")).collect()}
    plain = Plain([t.replace("\U0001f600", "￾") for i, t in enumerate(TEXTS) if i not in held and t])
    got = {r.doc_id: r.perplexity for r in Q.perplexities(docs, Q.train(docs, labels)).collect()}
    for i, t in enumerate(TEXTS):
        if not t:
            assert got[i] is None
        else:
            assert math.isclose(got[i], plain.perplexity(t.replace("\U0001f600", "￾")), rel_tol=1e-9)


def test_probabilities_sum_to_one():
    plain = Plain(["abcab", "abba", "cab"])
    for ctx in ("abc", "zzz", "\x02\x02\x02", "bca"):
        total = sum(plain.p(ctx + x) for x in plain.c[1]) + plain.p(ctx + "?")
        assert math.isclose(total, 1.0, rel_tol=1e-9)


@pytest.fixture(scope="module")
def tables(spark):
    return (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))


def test_verdicts_on_labelled_documents(spark, tables):
    docs, labels = tables
    rows = {r.doc_id: r for r in Q.op4_quality_classifier(docs, labels).collect()}
    assert len(rows) == docs.count()
    good = [rows[r.doc_id].keep for r in labels.where("quality = 1").collect()]
    bad = [rows[r.doc_id].keep for r in labels.where("quality = 0").collect()]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.4
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.keep}


def test_edge_tables(spark):
    docs = spark.createDataFrame([(1, None, "en", "x", 1.0), (1, "", None, "x", 1.0), (None, "abc", "en", "x", 1.0), (2, "abc" * 50000, "en", "x", 1.0)],
                                 "doc_id long, text string, lang string, g string, perplexity double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(2, 1, 0), (2, None, 0), (None, 1, 0)], none.schema)):
        rows = Q.op4_quality_classifier(docs, labels).collect()
        assert len(rows) == 4 and all(r.keep for r in rows)
        assert sorted(Q.keep_good(docs, labels).columns) == sorted(docs.columns) and Q.keep_good(docs, labels).count() == 4
    assert Q.op4_quality_classifier(docs.limit(0), none).count() == 0


def test_thresholds_take_all_held_out_ids(spark):
    n = Q.MAX_TRUSTED + 200_000
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    # 60 rare languages of one held-out text each
    rare = [r.id for r in spark.range(n).where(Q._held("id")).limit(60).collect()]
    scores = spark.createDataFrame([(i, f"l{i}", 2.0) for i in rare], "doc_id long, lang string, perplexity double")
    assert {r.lang for r in Q.thresholds(scores, labels).collect()} == {f"l{i}" for i in rare}


def test_model_beyond_the_broadcast_scores_the_same(spark, monkeypatch):
    texts = TEXTS + ["the mat sat on the cat", "zzz qqq", None, ""]
    docs = spark.createDataFrame([(i, t, "en", i) for i, t in enumerate(texts)], "doc_id long, text string, lang string, _row int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")
    want = {r.doc_id: r for r in Q.op4_quality_classifier(docs, labels).collect()}
    kept = {r.doc_id for r in Q.keep_good(docs, labels).collect()}
    monkeypatch.setattr(Q, "MAX_GRAMS", 20)
    got = {r.doc_id: r for r in Q.op4_quality_classifier(docs, labels).collect()}
    assert got.keys() == want.keys()
    for i, r in want.items():
        assert (got[i].n_symbols, got[i].keep) == (r.n_symbols, r.keep)
        assert got[i].perplexity == r.perplexity or math.isclose(got[i].perplexity, r.perplexity, rel_tol=1e-9)
    assert {r.doc_id for r in Q.keep_good(docs, labels).collect()} == kept


def test_every_trusted_text_trains(spark, monkeypatch):
    texts = [f"text {chr(0x4e00 + i)} of its own" for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(Q, "MAX_TRUSTED", 5)
    held = {r.doc_id for r in docs.where(Q._held("doc_id")).collect()}
    plain = Plain([t for i, t in enumerate(texts) if i not in held])
    got = {r.doc_id: r.perplexity for r in Q.perplexities(docs, Q.train(docs, labels)).collect()}
    assert 0 < len(held) < 50 and all(math.isclose(got[i], plain.perplexity(t), rel_tol=1e-9) for i, t in enumerate(texts))
