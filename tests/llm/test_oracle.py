"""The queries that SQL can express, against their DuckDB statements at sf0.01."""

import pytest

from tablesmith.llm.oracle import ORACLE
from tablesmith.llm.queries import QUERIES
from tools.check_oracle import compare, duck

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    r = compare(spark, SF01, key, QUERIES[key], ORACLE[key], con)
    assert r["status"] == "ok", r
