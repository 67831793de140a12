"""Every query with a twin in SQL against DuckDB over the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from debenture.plans import catalog, oracles

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def key(row):
    return tuple(round(float(v), 9) if isinstance(v, float) else None if v is None else str(v) if not isinstance(v, int) else v for v in row)


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(SQL)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, db, name):
    d = catalog.queries()[name](spark, SF)
    cols = sorted(d.columns)
    r = db.execute(SQL[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    theirs = Counter(key(row[names.index(c)] for c in cols) for row in r.fetchall())
    assert Counter(key(row[c] for c in cols) for row in d.collect()) == theirs
