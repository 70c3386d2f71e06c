"""Every registered key against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, digest
from tests.conftest import SF_SMALL

QS, SQLS = E.queries(), E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(SQLS))
def test_key_matches_oracle(spark, con, key):
    df = QS[key](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(SQLS[key])
    dcols, drows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, cols) == digest(drows, dcols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "avg_order_value" in df.columns
