"""Every query that has SQL gives the SQL's rows on the smallest tables."""

import math

import duckdb
import pytest

from zonalis.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def rows(data, names):
    at = [names.index(c) for c in sorted(names)]
    shown = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else f"{v + 0.0:.5g}" if isinstance(v, float) else str(v)
    return sorted(tuple(shown(r[i]) for i in at) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, db, name):
    df = QUERIES[name](spark, small)
    cur = db.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    got, want = rows([tuple(r) for r in df.collect()], df.columns), rows(cur.fetchall(), names)
    assert len(got) == len(want)
    differing = sum(a != b for a, b in zip(got, want))
    assert differing <= len(want) // 200  # a float at a rounding tie may fall either way


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
