"""The readings fixture reproduces the counts stated in FIXTURES.md."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import monitor_queries as C
from wardwatch.operators import marts

# scale: raw rows, staged rows, patients, ward-hours, newest reading
EXPECTED = {
    "0.001": (1_000, 971, 15, 854, dt.datetime(2024, 1, 30, 23, 26, 16, 220708)),
    "0.01": (10_000, 9_709, 150, 3_855, dt.datetime(2024, 1, 30, 23, 57, 12, 194062)),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_fixture_counts(spark, sf):
    d = f"/root/testdata/sf{sf}"
    raw_n, staged_n, patients, ward_hours, newest = EXPECTED[sf]
    stg = C.staged(spark, d)
    assert C.raw(spark, d).count() == raw_n
    got = stg.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("patient_id").alias("p"),
                  F.max("reading_timestamp").alias("m")).first()
    assert (got["n"], got["p"], got["m"]) == (staged_n, patients, newest)
    assert marts.ward_hourly(stg).count() == ward_hours


def test_status_counts_sf001(spark):
    stg = C.staged(spark, "/root/testdata/sf0.01")
    def counts(col):
        return {r[col]: r["count"] for r in stg.groupBy(col).count().collect()}
    assert counts("heart_rate_status") == {"NORMAL": 6737, "TACHYCARDIA": 1953, "BRADYCARDIA": 1019}
    assert counts("bp_status") == {"NORMAL": 6178, "HIGH": 2773, "LOW": 601, "HYPERTENSIVE_CRISIS": 157}
    assert counts("spo2_status") == {"NORMAL": 6788, "LOW": 2022, "CRITICAL_LOW": 899}
    assert counts("temperature_status") == {"NORMAL": 7978, "FEVER": 1168, "HYPOTHERMIA": 563}
    assert counts("has_alert") == {False: 4656, True: 5053}
