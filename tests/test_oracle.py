"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import pytest

from tintero_checks.compare import connect, differences
from tintero_checks.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLES[name], SF_DIR) == []


def test_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["year_month", "term", "count"]
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert set(QUERIES) <= set(contract.queries())
