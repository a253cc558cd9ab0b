"""Every query of the library against the SQL that gives the same rows, on small tables."""

import math
import os

import pytest

from rosterline.plans.queries import QUERIES, SQL

DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    rows, names = df.collect(), df.columns
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(names)
    got = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in rows)
    order = [columns.index(c) for c in sorted(columns)]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in want.fetchall())


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL) and len(SQL) > 120
