"""Silent-monitor alerts on a stream: sessions of event time, native to Spark.

The readings of a patient that follow each other within ``limit`` minutes form
a session. Once the watermark has passed the end of a session (its last
reading + the limit), the monitor has been silent for the limit: one alert.
Which alerts exist is a matter of the readings' own times, not of how they were
cut into micro-batches. A reading older than the watermark at its arrival
cannot change alerts that are out; such readings are listed by a second query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardwatch.functions.time import from_event_time, to_event_time
from wardwatch.operators import staging
from wardwatch.operators.upsert import MergedTable
from wardwatch.streaming import jobs

DELAY_MINUTES = 120


def silent_sessions(staged: DataFrame, limit_minutes: int = 60, delay_minutes: int = DELAY_MINUTES) -> DataFrame:
    """(patient_id, ward, last_reading_at, silent_after): one row per closed session."""
    ev = (staged.withColumn("event_time", to_event_time("reading_timestamp"))
          .withWatermark("event_time", f"{delay_minutes} minutes"))
    closed = (ev.groupBy("patient_id", F.session_window("event_time", f"{limit_minutes} minutes").alias("s"))
              .agg(F.max_by("ward", "event_time").alias("ward"), F.max("reading_timestamp").alias("last_reading_at")))
    return closed.select("patient_id", "ward", "last_reading_at", from_event_time(F.col("s.end")).alias("silent_after"))


def start_silent(records: DataFrame, path: str, checkpoint: str, limit_minutes: int = 60,
                 delay_minutes: int = DELAY_MINUTES, stamp: Column | None = None, available_now: bool = True,
                 processing_time: str = "30 seconds") -> StreamingQuery:
    """Alerts, appended once the session is closed; see :func:`start_too_late` for the rest of the input."""
    w = (silent_sessions(jobs.staged_stream(records, stamp), limit_minutes, delay_minutes)
         .writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append"))
    return jobs.with_trigger(w, available_now, processing_time).start(path)


def start_too_late(records: DataFrame, path: str, checkpoint: str, limit_minutes: int = 60,
                   delay_minutes: int = DELAY_MINUTES, stamp: Column | None = None, available_now: bool = True,
                   processing_time: str = "30 seconds", quarantine_path: str | None = None) -> StreamingQuery:
    """List the readings whose session had closed before they came, and set bad records aside.

    Run it on the same source with the same trigger as :func:`start_silent`:
    the watermark of a batch is the newest reading of the batches before it,
    less the delay. ``<path>_newest`` holds that newest reading.
    """
    newest = MergedTable(records.sparkSession, f"{path}_newest", lambda rows: rows.agg(F.max("newest").alias("newest")))
    allowance = F.make_dt_interval(mins=F.lit(limit_minutes + delay_minutes))

    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        staged = staging.stage(rows, carry=("kafka_offset",))
        seen = newest.read_before(source, batch_id)
        late = staged.select("patient_id", "ward", "reading_timestamp", "kafka_offset")
        late = late.where(F.lit(False)) if seen is None else late.where(
            F.col("reading_timestamp") + allowance <= F.lit(seen.first()["newest"].isoformat(sep=" ")).cast("timestamp_ntz"))
        late.write.mode("overwrite").parquet(jobs.batch_folder(path, source, batch_id))
        newest.add(staged.agg(F.max("reading_timestamp").alias("newest")), source, batch_id)

    return jobs.start(records, job, path, checkpoint, stamp, quarantine_path,
                      available_now=available_now, processing_time=processing_time)
