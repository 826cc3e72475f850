"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from helpers import norm

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "TX_AMOUNT_LAST3_MEAN" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted(tuple(norm(r[i]) for i in idx) for r in cur.fetchall())
    assert len(srows) == len(drows)
    assert srows == drows
