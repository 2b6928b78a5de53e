"""Marts: current row per patient, ward x hour rollup, triage table.

Shuffles: one by patient (latest reading; ``WindowGroupLimit`` keeps one row
per patient per map partition before the exchange, so a hot patient costs
nothing extra), one by ward-hour for the rollup (partial aggregation map
side). The ward context has at most one row per ward; Spark picks the join by
its size in bytes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardwatch.config import DEFAULT_THRESHOLDS, LOOKBACK_HOURS, Thresholds
from wardwatch.functions import clinical as C
from wardwatch.functions.cache import per_context
from wardwatch.functions.rounding import half_up_div, rounded_mean
from wardwatch.functions.time import boundaries_between, ntz_literal, trunc_ntz
from wardwatch.sources.tables import PARTITION_COLUMN

LATEST_COLUMNS = (
    "patient_id", "patient_name", "age", "ward", "patient_condition", "doctor_id",
    "heart_rate_bpm", "systolic_bp_mmhg", "diastolic_bp_mmhg", "spo2_pct",
    "temperature_celsius", "respiratory_rate",
    "heart_rate_status", "bp_status", "spo2_status", "temperature_status",
    "has_alert", "reading_timestamp",
)

SUMMARY_COLUMNS = (
    "patient_id", "patient_name", "age", "ward", "patient_condition", "doctor_id",
    "current_heart_rate_bpm", "current_systolic_bp", "current_diastolic_bp",
    "current_spo2_pct", "current_temperature", "current_respiratory_rate",
    "heart_rate_status", "bp_status", "spo2_status", "temperature_status",
    "patient_risk_level", "abnormal_vitals_count", "last_reading_at",
    "minutes_since_last_reading",
)

WARD_CONTEXT_COLUMNS = (
    "ward_readings_this_hour", "ward_alert_rate_pct", "ward_avg_heart_rate", "ward_avg_spo2",
)


def as_of_column(as_of: str | _dt.datetime | Column | None) -> Column:
    """The clock of a run: a literal for replays/tests, else the session's now."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return ntz_literal(as_of)


def in_time_range(df: DataFrame, start: Column | None, end: Column | None,
                  end_inclusive: bool = False) -> DataFrame:
    """Rows with ``start <= reading_timestamp < end`` (``<= end`` if inclusive).

    On a raw table laid out by reading day the same bounds are also applied
    to ``reading_day``, which Spark turns into partition filters.
    """
    ts = F.col("reading_timestamp")
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= start)
    if end is not None:
        cond = cond & ((ts <= end) if end_inclusive else (ts < end))
    if PARTITION_COLUMN in df.columns:
        day = F.col(PARTITION_COLUMN)
        if start is not None:
            cond = cond & (day >= F.to_date(start))
        if end is not None:
            cond = cond & (day <= F.to_date(end))
    return df.where(cond)


def max_reading_time(staged: DataFrame) -> _dt.datetime | None:
    """The newest reading time (one scalar; partial max per partition)."""
    return staged.agg(F.max("reading_timestamp").alias("m")).first()["m"]


def latest_per_patient(staged: DataFrame, tie_break: str | None = "kafka_offset",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """The newest reading of each patient (``ROW_NUMBER() = 1``).

    Ties on the reading time are broken by ``tie_break`` descending (the
    source offset: the later delivery wins) so the result is deterministic.
    ``keep`` adds columns to the 18 output columns.
    """
    order = [F.col("reading_timestamp").desc()]
    if tie_break and tie_break in staged.columns:
        order.append(F.col(tie_break).desc())
    w = Window.partitionBy("patient_id").orderBy(*order)
    return (staged.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select(*LATEST_COLUMNS, *keep))


def patient_summary(latest: DataFrame, as_of=None, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Current vitals, statuses, risk level and staleness of each patient."""
    now = as_of_column(as_of)
    return latest.select(
        "patient_id", "patient_name", "age", "ward", "patient_condition", "doctor_id",
        F.col("heart_rate_bpm").alias("current_heart_rate_bpm"),
        F.col("systolic_bp_mmhg").alias("current_systolic_bp"),
        F.col("diastolic_bp_mmhg").alias("current_diastolic_bp"),
        F.col("spo2_pct").alias("current_spo2_pct"),
        F.col("temperature_celsius").alias("current_temperature"),
        F.col("respiratory_rate").alias("current_respiratory_rate"),
        "heart_rate_status", "bp_status", "spo2_status", "temperature_status",
        C.risk_level("heart_rate_bpm", "systolic_bp_mmhg", "spo2_pct", "has_alert", th)
        .alias("patient_risk_level"),
        C.abnormal_vitals_count("heart_rate_status", "bp_status", "spo2_status", "temperature_status")
        .alias("abnormal_vitals_count"),
        F.col("reading_timestamp").alias("last_reading_at"),
        boundaries_between("minute", F.col("reading_timestamp"), now).alias("minutes_since_last_reading"),
    )


def ward_hour_partials() -> list[Column]:
    """Algebraic per-group sums that the ward-hour figures are derived from."""
    return list(_ward_hour_partials())


@per_context
def _ward_hour_partials() -> tuple[Column, ...]:
    temp_tenths = F.round(F.col("temperature_celsius") * 10).cast("long")
    return (
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if("has_alert").alias("total_alerts"),
        F.count_if(F.col("heart_rate_status") == "TACHYCARDIA").alias("tachycardia_count"),
        F.count_if(F.col("heart_rate_status") == "BRADYCARDIA").alias("bradycardia_count"),
        F.count_if(F.col("spo2_status") == "CRITICAL_LOW").alias("critical_spo2_count"),
        F.count_if(F.col("bp_status") == "HYPERTENSIVE_CRISIS").alias("hypertensive_crisis_count"),
        F.sum("heart_rate_bpm").cast("long").alias("_hr_sum"),
        F.count("heart_rate_bpm").alias("_hr_n"),
        F.sum("systolic_bp_mmhg").cast("long").alias("_sys_sum"),
        F.count("systolic_bp_mmhg").alias("_sys_n"),
        F.sum("spo2_pct").cast("long").alias("_spo2_sum"),
        F.count("spo2_pct").alias("_spo2_n"),
        F.sum(temp_tenths).alias("_temp_sum"),
        F.count(temp_tenths).alias("_temp_n"),
        F.max("reading_timestamp").alias("latest_reading_at"),
        F.min("reading_timestamp").alias("earliest_reading_at"),
    )


def ward_hour_figures(unique_patients: str) -> list[Column]:
    """Final ward-hour columns from the partial sums (exact half-up rounding).

    ``unique_patients`` names the column holding the distinct patient count.
    """
    return list(_ward_hour_figures(unique_patients))


@per_context
def _ward_hour_figures(unique_patients: str) -> tuple[Column, ...]:
    n = F.col("total_readings")
    return (
        n.cast("long").alias("total_readings"),
        F.col(unique_patients).cast("long").alias("unique_patients"),
        F.col("total_alerts").cast("long").alias("total_alerts"),
        (half_up_div(F.col("total_alerts") * 1000, n).cast("double") / 10).alias("alert_rate_pct"),
        F.col("tachycardia_count").cast("long").alias("tachycardia_count"),
        F.col("bradycardia_count").cast("long").alias("bradycardia_count"),
        F.col("critical_spo2_count").cast("long").alias("critical_spo2_count"),
        F.col("hypertensive_crisis_count").cast("long").alias("hypertensive_crisis_count"),
        rounded_mean(F.col("_hr_sum"), F.col("_hr_n"), 0, 1).alias("avg_heart_rate"),
        rounded_mean(F.col("_sys_sum"), F.col("_sys_n"), 0, 1).alias("avg_systolic_bp"),
        rounded_mean(F.col("_spo2_sum"), F.col("_spo2_n"), 0, 1).alias("avg_spo2"),
        rounded_mean(F.col("_temp_sum"), F.col("_temp_n"), 1, 2).alias("avg_temperature"),
        F.col("latest_reading_at"),
        F.col("earliest_reading_at"),
    )


def ward_hourly(staged: DataFrame) -> DataFrame:
    """Readings, alerts and mean vitals per ward and hour (16 columns)."""
    agg = staged.groupBy("ward", "reading_hour").agg(
        *ward_hour_partials(),
        F.count_distinct("patient_id").alias("_patients"),
    )
    return agg.select("ward", "reading_hour", *ward_hour_figures("_patients"))


# a micro-batch's share of the rollup: sums per (ward, hour, patient bucket), and the bucket's patients as a bitmap
_PARTIAL_KEYS = ("ward", "reading_hour", "_bucket", "_other_id")
# ids of the usual form stand for their number, one id a number; any other id has a row of its own
_NUMBERED_ID = r"^PAT-([0-9]{4}|[1-9][0-9]{4,17})$"


def ward_partials(staged: DataFrame) -> DataFrame:
    """The rollup's sums per ward, hour and bucket of 32,768 patients, with the exact set of those patients.

    The number of rows does not grow with the number of patients but by their
    buckets. Patients whose id is not of the usual form are kept by their id.
    """
    number = F.when(F.rlike("patient_id", F.lit(_NUMBERED_ID)), F.substring("patient_id", 5, 18).try_cast("long"))
    coded = staged.withColumn("_number", number)
    return coded.groupBy("ward", "reading_hour", F.bitmap_bucket_number("_number").alias("_bucket"),
                         F.when(F.col("_number").isNull(), F.col("patient_id")).alias("_other_id")).agg(
        *ward_hour_partials(), F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("_patients"))


def _added_up() -> list[Column]:
    sums = [F.sum(c).cast("long").alias(c) for c in (
        "total_readings", "total_alerts", "tachycardia_count", "bradycardia_count", "critical_spo2_count",
        "hypertensive_crisis_count", "_hr_sum", "_hr_n", "_sys_sum", "_sys_n", "_spo2_sum", "_spo2_n",
        "_temp_sum", "_temp_n")]
    return [*sums, F.max("latest_reading_at").alias("latest_reading_at"), F.min("earliest_reading_at").alias("earliest_reading_at")]


def merge_ward_partials(partials: DataFrame) -> DataFrame:
    """Sums of several batches added up and their patient sets united, one row per ward, hour and bucket."""
    return partials.groupBy(*_PARTIAL_KEYS).agg(*_added_up(), F.bitmap_or_agg("_patients").alias("_patients"))


def ward_hourly_of(partials: DataFrame) -> DataFrame:
    """The ward-hour figures (as :func:`ward_hourly`) of merged sums."""
    there = F.when(F.col("_other_id").isNotNull(), 1).otherwise(F.bitmap_count("_patients"))
    agg = partials.groupBy("ward", "reading_hour").agg(*_added_up(), F.sum(there).alias("_patients"))
    return agg.select("ward", "reading_hour", *ward_hour_figures("_patients"))


def ward_context(staged: DataFrame, hour_start: Column) -> DataFrame:
    """The ward rollup of one hour, renamed for the patient join.

    The hour is a range on the reading time (not a function of it), so a raw
    table's scan can skip row groups; only four figures survive pruning.
    """
    hour_end = hour_start + F.expr("INTERVAL 1 HOUR")
    one_hour = in_time_range(staged, hour_start, hour_end)
    return ward_hourly(one_hour).select(
        "ward",
        F.col("total_readings").alias("ward_readings_this_hour"),
        F.col("alert_rate_pct").alias("ward_alert_rate_pct"),
        F.col("avg_heart_rate").alias("ward_avg_heart_rate"),
        F.col("avg_spo2").alias("ward_avg_spo2"),
    )


def health_summary(staged: DataFrame, as_of=None, th: Thresholds = DEFAULT_THRESHOLDS,
                   cut_at_as_of: bool = False, ward_readings: DataFrame | None = None) -> DataFrame:
    """The patient health summary mart (24 columns).

    Each patient's current row, joined (left) to its ward's figures for the
    hour of ``as_of``. With ``cut_at_as_of`` readings after ``as_of`` are
    ignored, so that a past moment replays exactly. The ward figures come from
    ``ward_readings`` (default: the same readings).
    """
    now = as_of_column(as_of)
    if cut_at_as_of:
        staged = in_time_range(staged, None, now, end_inclusive=True)
    summary = patient_summary(latest_per_patient(staged), now, th)
    context = ward_context(staged if ward_readings is None else ward_readings, trunc_ntz("hour", now))
    return summary.join(context, on="ward", how="left").select(*SUMMARY_COLUMNS, *WARD_CONTEXT_COLUMNS)


def triage_ranked(summary: DataFrame) -> DataFrame:
    """The summary in triage order: risk rank, then most abnormal vitals.

    ``risk_rank`` is published so that the order survives storage; the
    patient id makes the order total. This is a distributed range sort.
    """
    return (summary.withColumn("risk_rank", C.risk_rank("patient_risk_level"))
            .orderBy(F.col("risk_rank").asc(), F.col("abnormal_vitals_count").desc(),
                     F.col("patient_id").asc()))


def lookback(staged: DataFrame, as_of, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Readings from the ``hours`` before ``as_of`` (the incremental window)."""
    now = as_of_column(as_of)
    start = now - F.make_dt_interval(hours=F.lit(hours))
    return in_time_range(staged, start, now, end_inclusive=True)


def loaded_since(readings: DataFrame, as_of, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Readings loaded in the ``hours`` before ``as_of``: everything that arrived, however late."""
    now = as_of_column(as_of)
    start = now - F.make_dt_interval(hours=F.lit(hours))
    return readings.where((F.col("ingested_at") >= start) & (F.col("ingested_at") <= now))


def silent_monitors(summary: DataFrame, max_minutes: int = 60) -> DataFrame:
    """Patients whose newest reading is more than ``max_minutes`` old."""
    return (summary.where(F.col("minutes_since_last_reading") > max_minutes)
            .select("patient_id", "ward", "doctor_id", "last_reading_at", "minutes_since_last_reading"))
