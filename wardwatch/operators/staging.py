"""Staging: drop unusable readings, clean values, classify vitals.

Everything is ONE ``select`` over the raw relation. That matters: the status
flags must read the *raw* vital while the cleaned column of the same name
is being defined (a heart rate of 350 is nulled as a value yet flags
TACHYCARDIA). A chain of ``withColumn`` would overwrite the raw column
first and change the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.config import DEFAULT_BOUNDS, DEFAULT_THRESHOLDS, Bounds, Thresholds
from wardwatch.functions import clinical as C
from wardwatch.functions.cache import per_context
from wardwatch.functions.time import boundaries_between, trunc_ntz
from wardwatch.sources.tables import PARTITION_COLUMN


def keep_reading() -> Column:
    """Row filter: a patient id that is not blank and a reading time."""
    pid = F.col("patient_id")
    return pid.isNotNull() & (F.trim(pid) != "") & F.col("reading_timestamp").isNotNull()


def filter_valid(raw: DataFrame) -> DataFrame:
    return raw.where(keep_reading())


def cleaned_columns(bounds: Bounds = DEFAULT_BOUNDS) -> list[Column]:
    """Range-validated values (NULL outside the inclusive bounds)."""
    b = bounds
    t_lo, t_hi = b.temperature_celsius
    temp = F.col("temperature_celsius")
    return [
        F.trim("patient_id").alias("patient_id"),
        F.trim("patient_name").alias("patient_name"),
        C.in_range_or_null("age", *b.age).alias("age"),
        F.trim("ward").alias("ward"),
        F.trim("condition").alias("patient_condition"),
        F.trim("doctor_id").alias("doctor_id"),
        C.in_range_or_null("heart_rate_bpm", *b.heart_rate_bpm).alias("heart_rate_bpm"),
        C.in_range_or_null("systolic_bp_mmhg", *b.systolic_bp_mmhg).alias("systolic_bp_mmhg"),
        C.in_range_or_null("diastolic_bp_mmhg", *b.diastolic_bp_mmhg).alias("diastolic_bp_mmhg"),
        C.in_range_or_null("spo2_pct", *b.spo2_pct).alias("spo2_pct"),
        F.when(temp.between(t_lo, t_hi), F.round(temp, 1)).alias("temperature_celsius"),
        C.in_range_or_null("respiratory_rate", *b.respiratory_rate).alias("respiratory_rate"),
    ]


def flag_columns(th: Thresholds = DEFAULT_THRESHOLDS) -> list[Column]:
    """Status flags and the alert flag, on the raw (unvalidated) readings."""
    hr, sys_, spo2, temp = "heart_rate_bpm", "systolic_bp_mmhg", "spo2_pct", "temperature_celsius"
    return [
        C.heart_rate_status(hr, th).alias("heart_rate_status"),
        C.bp_status(sys_, th).alias("bp_status"),
        C.spo2_status(spo2, th).alias("spo2_status"),
        C.temperature_status(temp, th).alias("temperature_status"),
        C.has_alert(hr, sys_, spo2, temp, th).alias("has_alert"),
    ]


def time_columns() -> list[Column]:
    ts = F.col("reading_timestamp")
    return [
        ts.alias("reading_timestamp"),
        trunc_ntz("hour", ts).alias("reading_hour"),
        trunc_ntz("day", ts).alias("reading_date"),
        F.col("ingested_at").alias("ingested_at"),
        boundaries_between("second", ts, F.col("ingested_at")).alias("ingestion_lag_seconds"),
    ]


def metadata_columns() -> list[Column]:
    return [F.col("device_id"), F.col("hospital_id"), F.col("data_source")]


def staged_columns(th: Thresholds = DEFAULT_THRESHOLDS, bounds: Bounds = DEFAULT_BOUNDS) -> list[Column]:
    """The 25 staging columns, in order, as expressions over the raw relation."""
    return list(_staged_columns(th, bounds))


@per_context
def _staged_columns(th: Thresholds, bounds: Bounds) -> tuple[Column, ...]:
    return (*cleaned_columns(bounds), *flag_columns(th), *time_columns(), *metadata_columns())


def stage(raw: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS, bounds: Bounds = DEFAULT_BOUNDS,
          carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw readings -> ``stg_patient_vitals`` (25 columns, + ``carry`` columns).

    ``carry`` passes raw columns through unchanged, e.g. ``kafka_offset`` as
    the tie-break of the latest-reading window. The ``reading_day`` partition
    column of a stored raw table is always carried, so that later time-range
    filters prune folders.
    """
    carry = tuple(carry) + tuple(c for c in (PARTITION_COLUMN,) if c in raw.columns and c not in carry)
    return raw.where(_keep()).select(*staged_columns(th, bounds), *[F.col(c) for c in carry])


@per_context
def _keep() -> Column:
    return keep_reading()
