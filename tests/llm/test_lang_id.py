"""Language identification: held-out accuracy, and the model against plain counting."""

import math
import zlib
from collections import Counter

import numpy as np

from thermogrid.llm import lang_id as G
from thermogrid.llm.common import table


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = G.op7_language_id(docs).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_features_are_the_texts_ngrams():
    a, of, has = G.features(["Ab, c", "", "1 2", "éÉ"])
    assert has.tolist() == [True, False, False, True]
    # "ab c ": 1-grams a b c, 2-grams ab "b " " c" "c ", 3-grams "ab " "b c" " c "
    assert Counter(of.tolist()) == {0: 3 + 4 + 3, 3: 2 + 2 + 1}
    alone = [G.features([t])[0] for t in ["Ab, c", "éÉ"]]
    assert sorted(a.tolist()) == sorted(np.concatenate(alone).tolist())


def test_posterior_by_hand(spark):
    docs = spark.createDataFrame([(1, "aaa bbb", "x"), (2, "ccc", "y"), (3, "ccc ddd", "y"), (4, "zzz", None)],
                                 "doc_id long, text string, lang string")
    models = G.train(docs)
    assert models.langs == ["x", "y"]
    m = models.block(models.langs)
    seen = {"x": G.features(["aaa bbb"])[0], "y": np.concatenate([G.features([t])[0] for t in ("ccc", "ccc ddd")])}
    q = G.features(["cca"])[0]
    logs = [math.log(n / 3) + sum(math.log(((seen[k] == b).sum() + G.SMOOTH) / (seen[k].size + G.SMOOTH * G.BUCKETS)) for b in q)
            for k, n in (("x", 1), ("y", 2))]
    want = 1 / (1 + math.exp(min(logs) - max(logs)))
    langs, score = m.predict(["cca"])
    assert langs == ["x" if logs[0] > logs[1] else "y"] and abs(score[0] - want) < 1e-5


def test_edge_rows(spark):
    rows = [(1, None, "x", 1.0), (2, "", "x", 1.0), (3, "12 !!", "x", 1.0), (None, "abc", "y", 1.0), (5, "abc", None, 1.0),
            (6, "q" * 300000, "x", 2.0), (6, "q" * 300000, "x", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = sorted(((r.doc_id or 0), r.held_out, r.lang_pred) for r in G.op7_language_id(docs).collect())
    assert [g[2] for g in got if g[0] in (1, 2, 3)] == ["und"] * 3
    assert got[0][1] is True and len(got) == 7
    assert G.op7_language_id(docs.limit(0)).count() == 0
    none = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert G.op7_language_id(none).collect()[0].lang_pred == "und"


def test_more_languages_than_a_block_holds(spark):
    """Block by block the same as at once."""
    rows = [(i, f"{chr(97 + i % 23)}{chr(97 + i % 19)} {chr(97 + i % 17) * 3} word", f"l{i % 40:02d}") for i in range(200)] + [(900, None, "l00"), (901, "9", "l00")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in G.predict(docs, G.train(docs, size=n)).collect()} for n in (256, 7))
    assert a == b and len({x for x, _ in a.values()}) > 20 and a[900] == a[901] == ("und", 0.0)
