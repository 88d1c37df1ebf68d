"""Every query with SQL gives the same rows as the SQL, on the smallest data folder."""

import glob
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

from fieldloom.plans import problems, reference  # noqa: E402

QUERIES, SQL = {**reference.QUERIES, **problems.QUERIES}, {**reference.SQL, **problems.SQL}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = con.execute(SQL[name])
    named = [c[0] for c in cursor.description]
    assert sorted(named) == columns
    want = sorted((tuple(plain(dict(zip(named, r))[c]) for c in columns) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-5 * max(1, abs(x))) for x, y in zip(a, b)), (a, b)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
