"""Every registered query of the monitor domain against its DuckDB oracle on the smallest driver tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from monitor_queries import QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key(spark, con, key):
    r = compare(spark, key, SF, con=con)
    assert r["status"] == "match", r


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "patient_risk_level" in df.columns
