"""wardwatch: bedside-monitor telemetry analytics on Spark.

Batch and streaming operators over vital-sign readings: decode and
quarantine messages, clean and classify readings, keep the current row of
every patient, roll readings up by ward and hour, join both into a triage
table, and gate publishing on data-quality checks. Every rule is a native
DataFrame expression so Catalyst plans the whole job.
"""

__version__ = "0.1.0"
