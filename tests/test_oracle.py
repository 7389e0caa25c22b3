"""Every registered query equals its DuckDB oracle on the sf0.001 test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, duck  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from salaria.catalog import QUERIES  # noqa: E402
from salaria.oracle import ORACLE_SQL  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_contract_keys_match():
    # Optional parts may add queries that SQL cannot express.
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_DIR)
    assert ok, msg


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["employee_id", "full_name", "department", "month", "total_pay", "max_pay"]
    assert df.count() > 0
