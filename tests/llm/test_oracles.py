"""The queries that SQL can express against their DuckDB oracles, on whole small tables."""

import pytest

from tests.oracle_compare import compare, duck
from wardwatch.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_key(spark, con, key):
    r = compare(spark, key, SF, con=con)
    assert r["status"] == "match", r


def test_keys():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 13
