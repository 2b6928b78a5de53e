"""Load monitoring over the raw table: volume, freshness, newest and abnormal readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardwatch.config import DEFAULT_THRESHOLDS, Thresholds
from wardwatch.functions.time import boundaries_between
from wardwatch.operators.marts import as_of_column

LAST_INGEST = "last_ingest"


def load_status(raw: DataFrame) -> DataFrame:
    """Rows loaded and the newest load time (one row)."""
    return raw.agg(F.count(F.lit(1)).cast("long").alias("row_count"),
                   F.max("ingested_at").alias("last_ingested_at"))


def ingest_lag(raw: DataFrame, as_of=None) -> DataFrame:
    """Seconds (boundary count) from the newest reading to ``as_of``.

    ``as_of=None`` is the session clock; ``"last_ingest"`` measures against
    the newest load time, which makes the figure reproducible.
    """
    agg = raw.agg(F.max("reading_timestamp").alias("latest_reading_at"),
                  F.max("ingested_at").alias("last_ingested_at"))
    now = F.col("last_ingested_at") if as_of == LAST_INGEST else as_of_column(as_of)
    return agg.select("latest_reading_at", "last_ingested_at",
                      boundaries_between("second", F.col("latest_reading_at"), now).alias("lag_seconds"))


def latest_readings(raw: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest raw readings; a reading without a time sorts first.

    A top-k: Spark plans it as ``TakeOrderedAndProject`` (k rows per task,
    merged on the driver), no full sort.
    """
    return (raw.select("patient_id", "ward", "heart_rate_bpm", "spo2_pct", "reading_timestamp", "kafka_offset")
            .orderBy(F.col("reading_timestamp").desc_nulls_first(), F.col("kafka_offset").desc())
            .limit(n))


def abnormal_readings(raw: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Raw readings with an abnormal heart rate or SpO2, newest first."""
    hr, spo2 = F.col("heart_rate_bpm"), F.col("spo2_pct")
    return (raw.where((hr < th.hr_low) | (hr > th.hr_high) | (spo2 < th.spo2_low))
            .select("patient_id", "ward", "condition", "heart_rate_bpm", "spo2_pct",
                    "systolic_bp_mmhg", "reading_timestamp", "kafka_offset")
            .orderBy(F.col("reading_timestamp").desc_nulls_first(), F.col("kafka_offset").desc()))
