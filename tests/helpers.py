"""Small builders for hand-made raw readings."""

from __future__ import annotations

import datetime as dt

from wardwatch.schemas import RAW_SCHEMA

BASE = dict(
    patient_id="PAT-0001", patient_name="Test Patient", age=40, ward="ICU", condition="Stable",
    doctor_id="DR-001", heart_rate_bpm=80, systolic_bp_mmhg=120, diastolic_bp_mmhg=80, spo2_pct=98,
    temperature_celsius=36.6, respiratory_rate=16,
    reading_timestamp=dt.datetime(2024, 1, 30, 10, 0, 0), device_id="MONITOR-PAT-0001",
    hospital_id="HOSP-001", data_source="simulated_patient_monitor",
    ingested_at=dt.datetime(2024, 1, 30, 10, 0, 5), kafka_partition=0, kafka_offset=0,
)


def raw_rows(spark, changes: list[dict]):
    rows = []
    for i, ch in enumerate(changes):
        r = dict(BASE, kafka_offset=i)
        r.update(ch)
        rows.append(tuple(r[f] for f in RAW_SCHEMA.fieldNames()))
    return spark.createDataFrame(rows, RAW_SCHEMA)
