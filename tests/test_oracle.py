"""Every registered query against its DuckDB oracle (rows, columns, values),
at sf0.001 here; ``python tests/oracle_check.py`` runs the same at sf0.01."""

import pytest

import __spark_entry__ as E
from oracle_check import digest, duck
from paths import SF001

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(E.CORE) <= set(ORACLE) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(E.CORE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns)[0] == digest(drows, dcols)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["r", "c", "cur", "ref", "diff", "clipped", "level"]
    assert df.count() == 180 * 360
