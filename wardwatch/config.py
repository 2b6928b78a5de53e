"""Thresholds, validity bounds and fixed domain values.

The defaults reproduce the clinical rules of the pipeline this library
re-expresses; every rule reads its numbers from these frozen dataclasses so a
caller can run the same plan with other limits (the thresholds are declared as
variables there, while its SQL repeats the literals).
"""

from __future__ import annotations

from dataclasses import dataclass


# --- fixed values: default thresholds and bounds (equal to the original rules) ---
@dataclass(frozen=True)
class Thresholds:
    """Limits for the per-reading status flags and the patient risk level.

    Status flags and ``has_alert`` read the *raw* reading; the risk level
    reads the *validated* (range-cleaned) value.
    """

    hr_high: int = 100          # > : TACHYCARDIA
    hr_low: int = 60            # < : BRADYCARDIA
    bp_crisis: int = 180        # >=: HYPERTENSIVE_CRISIS
    bp_high: int = 130          # >=: HIGH
    bp_low: int = 90            # < : LOW
    spo2_critical: int = 90     # < : CRITICAL_LOW
    spo2_low: int = 95          # < : LOW
    temp_fever: float = 38.0    # >=: FEVER
    temp_hypo: float = 36.0     # < : HYPOTHERMIA
    # patient risk level (CRITICAL), on validated values
    risk_spo2: int = 90         # <
    risk_hr_low: int = 40       # <
    risk_hr_high: int = 130     # >
    risk_bp_high: int = 180     # >=
    risk_bp_low: int = 80       # <


@dataclass(frozen=True)
class Bounds:
    """Inclusive validity ranges; a value outside becomes NULL in staging."""

    age: tuple[int, int] = (0, 120)
    heart_rate_bpm: tuple[int, int] = (0, 300)
    systolic_bp_mmhg: tuple[int, int] = (50, 250)
    diastolic_bp_mmhg: tuple[int, int] = (30, 150)
    spo2_pct: tuple[int, int] = (50, 100)
    temperature_celsius: tuple[float, float] = (30.0, 45.0)
    respiratory_rate: tuple[int, int] = (0, 60)
# --- end of fixed values ---


DEFAULT_THRESHOLDS = Thresholds()
DEFAULT_BOUNDS = Bounds()

# --- fixed values (must equal the original pipeline's for equal results) ---
WARDS = ("ICU", "Emergency", "Cardiology", "General Ward A", "General Ward B", "Pediatrics")
CONDITIONS = ("Stable", "Critical", "Recovering", "Under Observation")
HEART_RATE_STATUSES = ("NORMAL", "TACHYCARDIA", "BRADYCARDIA")
BP_STATUSES = ("NORMAL", "HIGH", "LOW", "HYPERTENSIVE_CRISIS")
SPO2_STATUSES = ("NORMAL", "LOW", "CRITICAL_LOW")
TEMPERATURE_STATUSES = ("NORMAL", "FEVER", "HYPOTHERMIA")
RISK_LEVELS = ("CRITICAL", "WARNING", "STABLE")
# risk level -> sort rank of the triage table; anything else ranks 4
RISK_RANKS = {"CRITICAL": 1, "WARNING": 2, "STABLE": 3}
HOSPITAL_ID = "HOSP-001"
DATA_SOURCE = "simulated_patient_monitor"
TOPIC = "patient-vitals"
# maximum string lengths of the raw table (load-time check)
MAX_LENGTHS = {
    "patient_id": 20,
    "patient_name": 100,
    "ward": 50,
    "condition": 50,
    "doctor_id": 20,
    "device_id": 50,
    "hospital_id": 20,
    "data_source": 50,
}
# --- end of fixed values ---

# incremental lookback window (hours), declared but not applied by default
LOOKBACK_HOURS = 24
