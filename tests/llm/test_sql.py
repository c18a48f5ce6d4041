"""The operators with SQL give the rows that DuckDB gives for it."""

import duckdb
import pytest

pytest.importorskip("quaymark.llm")
from quaymark.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(found.fetchall()) == sorted(tuple(r[c] for c in columns) for r in df.collect())
