"""Every registered query against its DuckDB oracle (the driver's gate, on sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

# The training-data queries have tests of their own; some of them SQL cannot express.
NAMES = sorted(n for n in entry.queries() if n in entry.registered.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r.get("match"), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "activity_date"
    assert df.count() > 0
