"""Schemas: one explicit StructType is the source of truth, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# message fields in producer order, with their typed form
MESSAGE_FIELDS: tuple[tuple[str, T.DataType], ...] = (
    ("patient_id", T.StringType()),
    ("patient_name", T.StringType()),
    ("age", T.IntegerType()),
    ("ward", T.StringType()),
    ("condition", T.StringType()),
    ("doctor_id", T.StringType()),
    ("heart_rate_bpm", T.IntegerType()),
    ("systolic_bp_mmhg", T.IntegerType()),
    ("diastolic_bp_mmhg", T.IntegerType()),
    ("spo2_pct", T.IntegerType()),
    ("temperature_celsius", T.DoubleType()),
    ("respiratory_rate", T.IntegerType()),
    ("reading_timestamp", T.TimestampNTZType()),
    ("device_id", T.StringType()),
    ("hospital_id", T.StringType()),
    ("data_source", T.StringType()),
)
MESSAGE_COLUMNS = tuple(name for name, _ in MESSAGE_FIELDS)

# ingest audit columns appended by the loader
AUDIT_FIELDS: tuple[tuple[str, T.DataType], ...] = (
    ("ingested_at", T.TimestampNTZType()),
    ("kafka_partition", T.IntegerType()),
    ("kafka_offset", T.LongType()),
)

# all nullable: a NULL patient id is kept out of the raw table by the loader
# (quarantine), not by the schema, so that staging can be fed any raw rows
RAW_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in MESSAGE_FIELDS]
    + [T.StructField(n, t, True) for n, t in AUDIT_FIELDS]
)
RAW_COLUMNS = tuple(RAW_SCHEMA.fieldNames())

# a message decoded with every field as text: numbers keep their literal
# spelling so that the typed cast, not the JSON reader, decides validity
MESSAGE_TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in MESSAGE_COLUMNS])
MESSAGE_TEXT_ARRAY = T.ArrayType(MESSAGE_TEXT_SCHEMA)

# record envelope of a topic source (Kafka column layout, value as text)
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("raw", T.StringType(), True),
    T.StructField("reason", T.StringType(), False),
    T.StructField("ingested_at", T.TimestampNTZType(), True),
    T.StructField("kafka_partition", T.IntegerType(), True),
    T.StructField("kafka_offset", T.LongType(), True),
])

STAGING_COLUMNS = (
    "patient_id", "patient_name", "age", "ward", "patient_condition", "doctor_id",
    "heart_rate_bpm", "systolic_bp_mmhg", "diastolic_bp_mmhg", "spo2_pct",
    "temperature_celsius", "respiratory_rate",
    "heart_rate_status", "bp_status", "spo2_status", "temperature_status", "has_alert",
    "reading_timestamp", "reading_hour", "reading_date", "ingested_at",
    "ingestion_lag_seconds", "device_id", "hospital_id", "data_source",
)
