"""Text queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from nightledger.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    want = con.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    rows = want.select(*columns).fetchall()
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, rows))
