"""Operators that number rows, on a source that gives its rows in another order at every read."""

import os
import random

import pyarrow as pa

from thermogrid.llm import lattice_lm, order_minhash, suffix_dedup


def restless(df):
    def run(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        random.Random(os.urandom(8)).shuffle(rows)
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))

    return df.coalesce(1).mapInArrow(run, "doc_id long, text string")


def made(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) + (f" {passage}" if i % 3 == 0 else "") for i in range(60)]
    texts += [t.replace(f"w{i}x30", "changed") for i, t in enumerate(texts)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), len(texts)


def test_near_duplicates(spark):
    docs, n = made(spark)
    got = {r.doc_id: r.class_id for r in order_minhash.op1_minhash_neardup(restless(docs)).collect()}
    assert got == {i: i % (n // 2) for i in range(n)}
    kept = [r.doc_id % (n // 2) for r in order_minhash.drop_near_duplicates(restless(docs)).collect()]
    assert sorted(kept) == list(range(n // 2))


def test_repeats(spark):
    docs, _ = made(spark)
    kept = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = sorted(suffix_dedup.op3_suffix_dedup(docs.coalesce(1)).select("doc_id", "n_bytes").collect())
    rows = suffix_dedup.op3_suffix_dedup(restless(docs)).select(*kept).collect()
    assert sorted((r.doc_id, r.n_bytes) for r in rows) == [tuple(r) for r in want]
    # the passage has one first copy, every other one is removed from a text that holds it
    assert all(r.n_removed <= r.n_bytes for r in rows) and sum(r.n_removed >= 200 for r in rows if r.doc_id % 60 % 3 == 0) >= 39


def test_blocks(spark):
    docs, n = made(spark)
    def scores(df):
        return {r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
                for r in lattice_lm.op8_lm_scoring(df, block_tokens=500).collect()}
    assert scores(restless(docs)) == scores(docs.coalesce(1))
