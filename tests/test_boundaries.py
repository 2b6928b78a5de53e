"""Boundary rows: every threshold edge of cleaning, status, alert, risk and count."""

import pytest

from tests.helpers import raw_rows
from wardwatch.operators import marts, staging

HR, SYS, DIA, SPO2, TEMP, RESP, AGE = ("heart_rate_bpm", "systolic_bp_mmhg", "diastolic_bp_mmhg",
                                       "spo2_pct", "temperature_celsius", "respiratory_rate", "age")
STATUS = {HR: "heart_rate_status", SYS: "bp_status", SPO2: "spo2_status", TEMP: "temperature_status"}

# (changes, cleaned values (None = NULL, "kept" = unchanged), changed statuses, alert, risk, abnormal)
CASES = [
    ({}, {}, {}, False, "STABLE", 0),
    ({HR: 60}, {HR: "kept"}, {}, False, "STABLE", 0),
    ({HR: 100}, {HR: "kept"}, {}, False, "STABLE", 0),
    ({HR: 101}, {HR: "kept"}, {HR: "TACHYCARDIA"}, True, "WARNING", 1),
    ({HR: 130}, {HR: "kept"}, {HR: "TACHYCARDIA"}, True, "WARNING", 1),
    ({HR: 59}, {HR: "kept"}, {HR: "BRADYCARDIA"}, True, "WARNING", 1),
    ({HR: 40}, {HR: "kept"}, {HR: "BRADYCARDIA"}, True, "WARNING", 1),
    ({HR: 39}, {HR: "kept"}, {HR: "BRADYCARDIA"}, True, "CRITICAL", 1),
    ({HR: 0}, {HR: "kept"}, {HR: "BRADYCARDIA"}, True, "CRITICAL", 1),
    ({HR: 131}, {HR: "kept"}, {HR: "TACHYCARDIA"}, True, "CRITICAL", 1),
    ({HR: 300}, {HR: "kept"}, {HR: "TACHYCARDIA"}, True, "CRITICAL", 1),
    ({HR: 301}, {HR: None}, {HR: "TACHYCARDIA"}, True, "WARNING", 1),
    ({HR: -1}, {HR: None}, {HR: "BRADYCARDIA"}, True, "WARNING", 1),
    ({SYS: 129}, {SYS: "kept"}, {}, False, "STABLE", 0),
    ({SYS: 90}, {SYS: "kept"}, {}, False, "STABLE", 0),
    ({SYS: 130}, {SYS: "kept"}, {SYS: "HIGH"}, False, "STABLE", 1),
    ({SYS: 180}, {SYS: "kept"}, {SYS: "HYPERTENSIVE_CRISIS"}, True, "CRITICAL", 1),
    ({SYS: 250}, {SYS: "kept"}, {SYS: "HYPERTENSIVE_CRISIS"}, True, "CRITICAL", 1),
    ({SYS: 251}, {SYS: None}, {SYS: "HYPERTENSIVE_CRISIS"}, True, "WARNING", 1),
    ({SYS: 89}, {SYS: "kept"}, {SYS: "LOW"}, True, "WARNING", 1),
    ({SYS: 80}, {SYS: "kept"}, {SYS: "LOW"}, True, "WARNING", 1),
    ({SYS: 79}, {SYS: "kept"}, {SYS: "LOW"}, True, "CRITICAL", 1),
    ({SYS: 49}, {SYS: None}, {SYS: "LOW"}, True, "WARNING", 1),
    ({SPO2: 95}, {SPO2: "kept"}, {}, False, "STABLE", 0),
    ({SPO2: 94}, {SPO2: "kept"}, {SPO2: "LOW"}, True, "WARNING", 1),
    ({SPO2: 90}, {SPO2: "kept"}, {SPO2: "LOW"}, True, "WARNING", 1),
    ({SPO2: 89}, {SPO2: "kept"}, {SPO2: "CRITICAL_LOW"}, True, "CRITICAL", 1),
    ({SPO2: 50}, {SPO2: "kept"}, {SPO2: "CRITICAL_LOW"}, True, "CRITICAL", 1),
    ({SPO2: 49}, {SPO2: None}, {SPO2: "CRITICAL_LOW"}, True, "WARNING", 1),
    ({SPO2: 101}, {SPO2: None}, {}, False, "STABLE", 0),
    ({TEMP: 37.96}, {TEMP: 38.0}, {}, False, "STABLE", 0),
    ({TEMP: 38.0}, {TEMP: "kept"}, {TEMP: "FEVER"}, True, "WARNING", 1),
    ({TEMP: 36.0}, {TEMP: "kept"}, {}, False, "STABLE", 0),
    ({TEMP: 35.9}, {TEMP: "kept"}, {TEMP: "HYPOTHERMIA"}, False, "STABLE", 1),
    ({TEMP: 45.1}, {TEMP: None}, {TEMP: "FEVER"}, True, "WARNING", 1),
    ({TEMP: 29.9}, {TEMP: None}, {TEMP: "HYPOTHERMIA"}, False, "STABLE", 1),
    ({DIA: 151, RESP: 61, AGE: 121}, {DIA: None, RESP: None, AGE: None}, {}, False, "STABLE", 0),
    ({DIA: 150, RESP: 60, AGE: 120}, {DIA: "kept", RESP: "kept", AGE: "kept"}, {}, False, "STABLE", 0),
    ({HR: None, SYS: None, DIA: None, SPO2: None, TEMP: None, RESP: None},
     {HR: None, SYS: None, DIA: None, SPO2: None, TEMP: None, RESP: None}, {}, False, "STABLE", 0),
    ({HR: 110, SYS: 140, SPO2: 88, TEMP: 39.0}, {HR: "kept", SYS: "kept", SPO2: "kept", TEMP: "kept"},
     {HR: "TACHYCARDIA", SYS: "HIGH", SPO2: "CRITICAL_LOW", TEMP: "FEVER"}, True, "CRITICAL", 4),
]


@pytest.fixture(scope="module")
def results(spark):
    changes = [dict(c[0], patient_id=f"PAT-{i:04d}") for i, c in enumerate(CASES)]
    raw = raw_rows(spark, changes)
    stg = staging.stage(raw, carry=("kafka_offset",))
    summary = marts.patient_summary(marts.latest_per_patient(stg), "2024-01-30 11:00:00")
    s_rows = {r["patient_id"]: r for r in stg.collect()}
    m_rows = {r["patient_id"]: r for r in summary.collect()}
    return s_rows, m_rows


@pytest.mark.parametrize("i", range(len(CASES)))
def test_boundary_case(results, i):
    changes, values, statuses, alert, risk, abnormal = CASES[i]
    s, m = results[0][f"PAT-{i:04d}"], results[1][f"PAT-{i:04d}"]
    for col, expect in values.items():
        want = changes[col] if expect == "kept" else expect
        assert s[col] == want, (col, s[col], want)
    for col, status_col in STATUS.items():
        assert s[status_col] == statuses.get(col, "NORMAL"), (status_col, s[status_col])
    assert s["has_alert"] is alert
    assert m["patient_risk_level"] == risk
    assert m["abnormal_vitals_count"] == abnormal


def test_row_filter(spark):
    raw = raw_rows(spark, [
        {"patient_id": None}, {"patient_id": ""}, {"patient_id": "  "},
        {"patient_id": "PAT-0002", "reading_timestamp": None}, {"patient_id": " PAT-0001 "},
    ])
    rows = staging.stage(raw).collect()
    assert [r["patient_id"] for r in rows] == ["PAT-0001"]


def test_single_select_reads_raw_vitals(spark):
    """A nulled impossible value still flags its status (same-select semantics)."""
    rows = staging.stage(raw_rows(spark, [{HR: 350}])).collect()
    assert rows[0][HR] is None and rows[0]["heart_rate_status"] == "TACHYCARDIA" and rows[0]["has_alert"]
