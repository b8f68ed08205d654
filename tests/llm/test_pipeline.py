"""The pipeline stage by stage against plain versions of each stage's decision."""

import re

import corpus_pipeline as P
from test_decontam import brute as hits
from test_order_minhash import brute as classes
from test_secrets_scan import brute as spans
from thermogrid.llm import quality_lm
from thermogrid.llm.common import stored, table
from thermogrid.llm.secrets_scan import MASK

SF = "/root/testdata/sf0.001"


def mask(text):
    cut = sorted(tuple(map(int, x.split(":")[1:])) for x in spans(text)[4].split(",") if x)
    out, at = [], 0
    runs = []
    for s, e in cut:
        if runs and s < runs[-1][1]:
            runs[-1][1] = max(e, runs[-1][1])
        else:
            runs.append([s, e])
    for s, e in runs:
        out += [text[at:s], MASK]
        at = e
    return "".join(out) + text[at:]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in P.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"]
    at, out = docs, []
    for _, stage in P.STAGES:
        at = stored(stage(spark, at, SF), "pipeline-test")
        out.append(at)
    assert all(x.columns == columns for x in out[:-1])
    every = {r.doc_id: tuple(r) for r in docs.collect()}

    keep = {r.doc_id for r in quality_lm.judged(docs, table(spark, SF, "labels")).where("keep").collect()}
    good = [every[r.doc_id] for r in out[0].collect()]
    assert sorted(good) == sorted(every[i] for i in keep) and len(keep) < len(every)

    text = columns.index("text")
    order = [tuple(r) for r in out[0].collect()]
    top = classes([r[text] for r in order])
    assert rows(out[1]) == sorted(order[i] for i in {*top})

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    grams = {g for _, t in items for g in re.findall(r"\w+ \w+ \w+", t.lower())}
    kept = []
    for r in out[1].collect():
        near = any(g in r.text.lower() for g in grams)  # the plain scan is slow: only texts that share words
        if not near or not hits([r.text], items)[0][4]:
            kept.append(tuple(r))
    assert rows(out[2]) == sorted(kept)

    clean = []
    for r in kept:
        t = mask(r[text])
        new = list(r)
        if t != r[text]:
            new[text], new[columns.index("n_chars")] = t, len(t)
        clean.append(tuple(new))
    assert rows(out[3]) == sorted(clean)
    assert {r.doc_id for r in out[4].collect()} == {r[0] for r in clean}


def test_run_gives_the_last_stage(spark):
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and got.count() > 0


def edge_tables(folder, spark):
    """documents, labels and benchmark with null, empty, very long and repeated texts and
    columns whose names the stages use inside."""
    words = [f"w{i}" for i in range(150)]
    plain = " ".join(words)
    item = " ".join(f"b{i}" for i in range(12))
    secret = "password = hunter2222 and more"
    texts = [None, "", "!!!", plain, plain, plain.replace("w75", "changed"), "z " * 500_000, f"x {item} y", secret, secret + " again",
             "ab cd ef"]
    rows = [(i, t, "en", "s", len(t or ""), f"r{i}", [i], f"c{i}", i, f"g{i}") for i, t in enumerate(texts)]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string, "
                                       "_parts array<int>, _cut string, _m0 int, `group` string")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (None, 1, 0), (8, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, texts


def test_edge_rows_through_all_stages(spark, tmp):
    docs, texts = edge_tables(tmp, spark)
    at, out = table(spark, tmp, "documents"), []
    for _, stage in P.STAGES:
        at = stored(stage(spark, at, tmp), "pipeline-test")
        out.append(at)
    assert all(x.columns == docs.columns for x in out[:-1])
    # nothing is bad enough to go, or too little is known of it
    kept = [r.doc_id for r in out[0].collect()]
    near = {r.doc_id: r for r in out[1].collect()}
    assert sorted(near) == sorted(i for i in set(kept) if i not in (4, 5)) and len(kept) == len(texts) + 1
    assert {r.doc_id for r in out[2].collect()} == set(near) - {7}
    for r in out[3].collect():
        was = near[r.doc_id]
        assert (r._row, r._parts, r._cut, r._m0, r.group) == (f"r{r.doc_id}", [r.doc_id], f"c{r.doc_id}", r.doc_id, f"g{r.doc_id}")
        assert ("hunter" in (was.text or "")) == (r.text != was.text)
        assert r.n_chars == len(r.text or "")
    assert out[4].count() == out[3].count() == P.run(spark, tmp).count()


def test_empty_tables(spark, tmp):
    docs, _ = edge_tables(tmp, spark)
    empty = f"{tmp}/empty"
    for name in ("documents", "labels", "benchmark"):
        table(spark, tmp, name).limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert P.run(spark, empty).count() == 0


def test_a_stage_keeps_what_its_docs_read(spark):
    """Stages chained without writing: no table goes that is still read."""
    docs = table(spark, SF, "documents")
    at = docs
    for _, stage in P.STAGES[:4]:
        at = stage(spark, at, SF)
    assert at.count() == P.run(spark, SF).count()
