"""Registered queries against their DuckDB oracle SQL on sf0.01."""

import math

import pytest

import __spark_entry__ as entry
from rankbeam.plans import oracle
from rankbeam.plans import testdata as td

SF = "/root/testdata/sf0.01"
ORACLE = sorted(set(td.QUERIES) & set(oracle.oracle_sql()))


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple("∅" if v is None else (round(v, 5) if isinstance(v, float) and not math.isnan(v)
                                                 else v) for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    srows = [tuple(r[c] for c in ocols) for r in sdf.collect()]
    assert _norm(srows) == _norm(orows)


def test_every_query_has_sql():
    sql = entry.oracle_sql()
    assert set(td.QUERIES) <= set(entry.queries())
    assert set(td.QUERIES) <= set(sql)



def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "split" in df.columns
