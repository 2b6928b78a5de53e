"""Clinical classification rules as Column expressions.

Status flags read the column they are given; staging passes the *raw*
reading, so an impossible heart rate of 350 is nulled as a value yet still
flags TACHYCARDIA. A NULL reading falls through to NORMAL / no alert.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardwatch.config import DEFAULT_THRESHOLDS, RISK_RANKS, Thresholds


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_range_or_null(c: Column | str, lo, hi) -> Column:
    """The value if ``lo <= c <= hi`` (inclusive), else NULL."""
    c = _c(c)
    return F.when(c.between(lo, hi), c)


def heart_rate_status(hr: Column | str, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    hr = _c(hr)
    return (F.when(hr > th.hr_high, "TACHYCARDIA")
            .when(hr < th.hr_low, "BRADYCARDIA")
            .otherwise("NORMAL"))


def bp_status(systolic: Column | str, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    s = _c(systolic)
    return (F.when(s >= th.bp_crisis, "HYPERTENSIVE_CRISIS")
            .when(s >= th.bp_high, "HIGH")
            .when(s < th.bp_low, "LOW")
            .otherwise("NORMAL"))


def spo2_status(spo2: Column | str, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    s = _c(spo2)
    return (F.when(s < th.spo2_critical, "CRITICAL_LOW")
            .when(s < th.spo2_low, "LOW")
            .otherwise("NORMAL"))


def temperature_status(temp: Column | str, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    t = _c(temp)
    return (F.when(t >= th.temp_fever, "FEVER")
            .when(t < th.temp_hypo, "HYPOTHERMIA")
            .otherwise("NORMAL"))


def has_alert(hr, systolic, spo2, temp, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """TRUE when any alerting vital is abnormal; never NULL.

    BP HIGH and HYPOTHERMIA do not alert (they still count as abnormal).
    """
    hr, systolic, spo2, temp = map(_c, (hr, systolic, spo2, temp))
    return (F.when((hr > th.hr_high) | (hr < th.hr_low), True)
            .when((systolic >= th.bp_crisis) | (systolic < th.bp_low), True)
            .when(spo2 < th.spo2_low, True)
            .when(temp >= th.temp_fever, True)
            .otherwise(False))


def risk_level(hr, systolic, spo2, alert, th: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    """CRITICAL / WARNING / STABLE from *validated* vitals and the alert flag."""
    hr, systolic, spo2, alert = map(_c, (hr, systolic, spo2, alert))
    critical = ((spo2 < th.risk_spo2)
                | ((hr < th.risk_hr_low) | (hr > th.risk_hr_high))
                | (systolic >= th.risk_bp_high)
                | (systolic < th.risk_bp_low))
    return (F.when(critical, "CRITICAL")
            .when(alert == F.lit(True), "WARNING")
            .otherwise("STABLE"))


def abnormal_vitals_count(*statuses: Column | str) -> Column:
    """Number of status columns that are not NORMAL (INT, 0..len(statuses))."""
    total = F.lit(0)
    for s in statuses:
        total = total + F.when(_c(s) != "NORMAL", 1).otherwise(0)
    return total.cast("int")


def risk_rank(level: Column | str) -> Column:
    """Sort rank of a risk level: CRITICAL 1, WARNING 2, STABLE 3, else 4."""
    level = _c(level)
    rank = None
    for name, r in RISK_RANKS.items():
        rank = F.when(level == name, r) if rank is None else rank.when(level == name, r)
    return rank.otherwise(len(RISK_RANKS) + 1).cast("int")
