"""Every core query with SQL gives the rows that DuckDB gives for it."""

import glob
import os

import duckdb
import pytest

from quaymark.plans.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if v is None:
        return "∅"
    return f"{float(v):.9g}" if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
