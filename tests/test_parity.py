"""Every registered query against its DuckDB oracle on sf0.001 (the driver
does the same at sf0.01)."""
import pytest
from conftest import SF001
from parity import compare, duck

import __spark_entry__ as E

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "years_to_close" in df.columns
