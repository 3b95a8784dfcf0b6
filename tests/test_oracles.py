"""Every registered query against its DuckDB oracle on the smallest data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as se  # noqa: E402
from nightledger.plans.catalog import ORACLES, QUERIES  # noqa: E402
from tools.check_oracles import TABLES, digest  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_small):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    # other queries may be registered beside these
    assert set(QUERIES) <= set(se.queries()) and set(ORACLES) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = se.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(se.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0
