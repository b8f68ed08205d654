"""Toxicity grammar: held-out labels, the composed table against step-by-step rules, edge rows."""

import random
import zlib

import numpy as np

from thermogrid.llm import toxicity as T
from thermogrid.llm.common import table


def test_held_out_labels(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    truth = {r.doc_id: (r.toxic, r.quality) for r in labels.collect()}
    rows = T.op12_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.predicted, *truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    # labels of junk documents (quality 0) are partly noise
    good = [p for p, toxic, quality in held if toxic and quality]
    assert np.mean(good) > 0.97 and np.mean([p for p, toxic, _ in held if toxic]) > 0.88
    assert np.mean([p for p, toxic, _ in held if not toxic]) < 0.01


def test_held_out_labels_are_not_used(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", T.F.when(T.held_out(5), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    other = docs.withColumn("lang", T.F.lit("q")).withColumn("source", T.F.lit(None).cast("string"))
    a, b = ({r.doc_id: r.score for r in T.op12_toxicity(d, x).collect()} for d, x in ((docs, labels), (other, flipped)))
    assert a == b


def rule(symbols):
    """The grammar said in words."""
    out = []
    quoted = False
    words = [i for i, s in enumerate(symbols) if s != T.QUOTE]
    for i, s in enumerate(symbols):
        before = [symbols[j] for j in words if j < i]
        x = s
        if s in (T.INSULT, T.THREAT):
            if T.NEG in before[-T.NEAR:]:
                x |= T.NEGATED
            if T.REPORT in before or quoted:
                x |= T.REPORTED
            if T.TARGET in before[-T.NEAR:]:
                x |= T.AIMED
        if s == T.TARGET and {T.INSULT, T.THREAT} & set(before[-T.NEAR:]):
            x = T.LATE
        if s == T.QUOTE:
            quoted = not quoted
        out.append(x)
    return out


def test_composed_grammar_follows_its_rules():
    rng = random.Random(4)
    rows = [[rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6]) for _ in range(rng.randint(1, 14))] for _ in range(400)]
    got = T.Model._run(np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows))
    assert got.tolist() == [x for r in rows for x in rule(r)]


def test_clauses_not_words():
    m = T.Model([("idiot", True, 1.0), ("vermi", False, 1.0)])

    def weight(text):
        return round(float(m.clauses([text])[3].sum()), 3)

    plain = weight("some words idiot and more")
    assert plain == 1.0 and weight("a vermicious thing") == 1.0 and weight("idiotic thing") == 0
    assert weight("you are an idiot") == 1.5 and weight("idiot, all of you") > plain
    assert weight("this is not an idiot") < plain and weight("no. idiot") == plain
    assert weight('she said he was an idiot') < weight("he was an idiot")
    assert weight('the word "idiot" was used') < plain
    assert weight("kill time slowly") == 0 and weight("i will kill you") > 0
    assert weight("you " + "word " * 50 + "idiot") == weight("idiot") == plain
    long = "not an idiot " + "word " * 5000 + "idiot"
    assert weight(long) == plain + weight("not an idiot")


def test_spans_are_code_points(spark):
    m = T.Model([("idiot", True, 1.0)])
    text = "Éa \U0001F600 ok. So ÜBER idiot dort! Nothing"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.clauses for r in T.matched_clauses(docs, m).collect()}
    assert [text[c.start:c.end] for c in got[1]] == ["So ÜBER idiot dort"] and got[2] == []


def test_new_beginnings_are_learned(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, marks = [], []
    for i in range(400):
        bad = i % 5 == 0
        words = [word() for _ in range(30)]
        if bad:
            words[10], words[20] = (f"zorkl{word()}" for _ in range(2))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = T.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert ("zorkl", False) in {e[:2] for e in model.entries}
    fresh = spark.createDataFrame([(1, "abc zorklnew, abcde"), (2, "abc abcde")], "doc_id long, text string")
    assert [r.score > 0.5 for r in T.score(fresh, model).orderBy("doc_id").collect()] == [True, False]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "12 !! \n"), (None, "you idiot"), (4, "word " * 200000 + "you idiot. " * 50), (4, "you idiot"), (4, "you idiot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as score", "1 as toxic", "2 as row", "3 as y")
    marks = spark.createDataFrame([(1, 0), (3, None), (4, 1), (4, 0), (None, 1)], "doc_id long, toxic int")
    got = [(r.doc_id, r.held_out, r.score, r.predicted) for r in T.op12_toxicity(docs, marks).collect()]
    assert len(got) == len(rows) and all(0 <= r[2] <= 1 for r in got)
    assert len({r[2] for r in got if r[0] in (1, 2, 3)}) == 1
    for labels in (marks.limit(0), marks.where("toxic = 0"), marks.where("toxic = 1")):
        fixed = {r.doc_id: r.predicted for r in T.op12_toxicity(docs, labels).collect()}
        assert fixed[1] == fixed[2] == 0 and fixed[4] == 1
    assert T.op12_toxicity(docs.limit(0), marks).count() == 0
