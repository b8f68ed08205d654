"""Source divergence: against the definition in plain Python, split digests and edge rows."""

import re
from collections import Counter, defaultdict

import pytest

from thermogrid.llm import source_audit as S
from thermogrid.llm.common import table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string"


def plain(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", re.findall(S.TERM, (text or "").translate(LOW))) for _, text, lang, source in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        seen[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    groups = sorted({d[:2] for d in docs})
    for lang in {d[0] for d in docs}:
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        share = {}
        mine = [s for x, s in groups if x == lang]
        for s in [*mine, None]:
            c = count[lang, s] if s is not None else sum((count[lang, x] for x in mine), Counter())
            n = sum(c[t] for t in kept)
            share[s] = {t: 1 + 1000000000 * (c[t] + 1) // (n + len(kept)) for t in kept}
        apart = lambda p, q: (p - q) * (p - q) // q
        for s in mine:
            pairs = [(-sum(apart(share[s][t], share[o][t]) for t in kept), o.encode(), o) for o in mine if o != s]
            terms = [(-apart(share[s][t], share[None][t]), t.encode(), t) for t in kept
                     if count[lang, s][t] and share[s][t] > share[None][t]]
            out += [(lang, s, "pair", x[2], -x[0], i + 1) for i, x in enumerate(sorted(pairs))]
            out += [(lang, s, "term", x[2], -x[0], i + 1) for i, x in enumerate(sorted(terms)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_definition_on_a_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang", "source")
    assert got(S.op13_source_divergence(docs)) == plain([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("options", [{"digest_bits": 5}, {"block": 2}, {"bucket_rows": 300, "block": 3, "top": 7}])
def test_split_digests_and_tiles(spark, options):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang", "source").limit(120)
    assert got(S.divergence(docs, **options)) == plain([tuple(r) for r in docs.collect()], top=options.get("top", 200))


def test_edge_rows(spark):
    rows = [(1, None, None, None), (2, "", "x", "a"), (3, "Éa éa A-b 12", "x", "b"), (3, "Éa éa A-b 12", "x", "b"),
            (4, "éa b " * 30000, "x", "c"), (5, "b", "x", None), (6, "solo", "y", "a"), (7, "ABC abc Abc", "z", "s"),
            (8, "abc", "z", "t"), (9, "abc", "z", "u"), (None, "q", None, "s"), (10, "q q", "", "s"), (11, "q", "", "t")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as digest", "2 as part", "3 as value", "4 as rank", "5 as item", "6 as block")
    assert got(S.op13_source_divergence(docs)) == plain(rows)
    assert S.op13_source_divergence(docs.limit(0)).count() == 0
