"""The registered corpus queries: every operator once, their SQL oracles, and the
engine without this part."""

import re

import pytest

import __spark_entry__ as E
from oracle_check import digest, duck
from thermogrid.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in Q.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(Q.QUERIES) <= set(E.queries()) and not set(E.CORE) & set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_its_sql(spark, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF).execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want)
    assert digest(rows, df.columns)[0] == digest(want, columns)[0]


def test_contract_types(spark):
    want = {
        "op1_minhash_neardup": "doc_id bigint, class_id bigint, class_size bigint, kept boolean",
        "op2_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
        "op3_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        "op5_secret_scans": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
        "op6_url_filters": "page_id bigint, host string, path string, rule string, verdict string",
        "op7_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op8_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        "op9_embedding_neardup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
        "op10_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op11_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
        "op12_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op13_source_divergence": "lang string, source string, part string, item string, value bigint, rank int",
    }
    for name, columns in want.items():
        assert ", ".join(f"{c} {t}" for c, t in Q.QUERIES[name](spark, SF).dtypes) == columns
