"""Silent-monitor alerts by timers: raised by the clock, also if nobody sends any more.

The stream keeps one small state for each patient (``transformWithState``): the
newest reading and a processing-time timer at its time plus the limit. A newer
reading moves the timer; a timer that expires raises the alert, without any further
input, since a query with processing-time timers runs a batch at every
trigger. There is no watermark: a reading that comes late changes the state
if it is the newest of its patient, and nothing otherwise, so no reading is
dropped and the open alerts do not depend on how arrivals are cut into batches.

The output is a log of events: ``silent`` when a timer expires, ``resumed`` when a
patient with an alert is heard from in time again. The state remembers that an alert
is out and is restored with the checkpoint; the file sink commits each batch once: a
restart raises nothing twice. :func:`open_alerts` gives the alerts that stand.

A patient with very many readings in a batch is read as one stream of rows by
one task and never held as a group.
"""

from __future__ import annotations

import datetime as _dt
import sys
import time
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wardwatch.functions.time import boundaries_between, from_event_time, to_event_time
from wardwatch.operators.marts import as_of_column
from wardwatch.streaming import jobs

# the processor travels to the Python workers by value: executors need not have the library installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "ward string, doctor_id string, at long, position long, due long, raised boolean"
EVENTS = "patient_id string, ward string, doctor_id string, at long, event string"


class SilenceProcessor(StatefulProcessor):
    """One timer a patient, at the newest reading plus the limit; ``ahead_ms``: how far the readings' clock is ahead of this one."""

    def __init__(self, limit_ms: int, ahead_ms: int = 0):
        self.limit_ms, self.ahead_ms = limit_ms, ahead_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.newest.get()
        best = None if known is None else (known[2], known[3])
        found = None
        for row in rows:
            here = (row["at"], row["position"])
            if best is None or here > best:
                best, found = here, row
        if found is None:
            return
        # micro- to milliseconds, rounded up: never before the limit is over
        due = -(-found["at"] // 1000) + self.limit_ms - self.ahead_ms
        raised = known is not None and known[5]
        if known is not None and not raised:
            self.handle.deleteTimer(known[4])
        if raised and due > timerValues.getCurrentProcessingTimeInMs():
            yield Row(patient_id=key[0], ward=found["ward"], doctor_id=found["doctor_id"], at=found["at"], event="resumed")
        self.handle.registerTimer(due)
        self.newest.update((found["ward"], found["doctor_id"], found["at"], found["position"], due, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.newest.get()
        if known is None or known[5] or known[4] != expiredTimerInfo.getExpiryTimeInMs():
            return
        self.newest.update((*known[:5], True))
        yield Row(patient_id=key[0], ward=known[0], doctor_id=known[1], at=known[2], event="silent")

    def close(self) -> None:
        pass


def timer_session(spark: SparkSession, drain: bool = False) -> SparkSession:
    """A session whose streams may hold timers (their state store is RocksDB), beside ``spark`` and with its settings.

    With ``drain`` for queries that stop at the end of their input (``availableNow``): a query with timers would go on with
    batches without input for ever, so that these are switched off; what is due by then is raised with the last input.
    """
    beside = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        beside.conf.set(k, spark.conf.get(k))
    beside.conf.set(PROVIDER, ROCKSDB)
    beside.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(not drain).lower())
    return beside


def silence_events(staged: DataFrame, limit_seconds: int = 3600, ahead_seconds: float = 0) -> DataFrame:
    """(patient_id, ward, doctor_id, last_reading_at, silent_after, event) of a staged stream (with ``kafka_offset``)."""
    heard = staged.select("patient_id", "ward", "doctor_id", F.unix_micros(to_event_time("reading_timestamp")).alias("at"),
                          F.coalesce("kafka_offset", F.lit(-1)).alias("position"))
    events = heard.groupBy("patient_id").transformWithState(
        SilenceProcessor(int(limit_seconds * 1000), int(ahead_seconds * 1000)), EVENTS, "append", "ProcessingTime")
    at = from_event_time(F.timestamp_micros("at"))
    return events.select("patient_id", "ward", "doctor_id", at.alias("last_reading_at"),
                         (at + F.make_dt_interval(secs=F.lit(limit_seconds))).alias("silent_after"), "event")


def start_silence(records: DataFrame, path: str, checkpoint: str, limit_seconds: int = 3600, as_of: _dt.datetime | None = None,
                  stamp: Column | None = None, available_now: bool = False, processing_time: str = "30 seconds") -> StreamingQuery:
    """Write the events of a record stream of :func:`timer_session` below ``path``; ``available_now`` needs its ``drain``.

    ``as_of`` replays: the run starts as if the clock stood there (UTC). The bad records of the stream are those that
    the ingest job of the same source sets aside.
    """
    ahead = 0.0 if as_of is None else as_of.replace(tzinfo=_dt.timezone.utc).timestamp() - time.time()
    w = (silence_events(jobs.staged_stream(records, stamp), limit_seconds, ahead)
         .writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append"))
    return jobs.with_trigger(w, available_now, processing_time).start(path)


def open_alerts(events: DataFrame, as_of=None) -> DataFrame:
    """(patient_id, ward, doctor_id, last_reading_at, silent_after): patients that are silent at ``as_of`` (default: the session clock)."""
    newest = Window.partitionBy("patient_id").orderBy(F.desc("last_reading_at"), F.desc(F.col("event") == "silent"))
    return (events.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1 AND event = 'silent'")
            .where(F.col("silent_after") <= as_of_column(as_of))
            .select("patient_id", "ward", "doctor_id", "last_reading_at", "silent_after"))


def silent_now(events: DataFrame, as_of=None, max_minutes: int = 60) -> DataFrame:
    """The open alerts in the form of the batch list (:func:`marts.silent_monitors`), by its count of minute boundaries."""
    now = as_of_column(as_of)
    minutes = boundaries_between("minute", "last_reading_at", now)
    return (open_alerts(events, now).withColumn("minutes_since_last_reading", minutes)
            .where(F.col("minutes_since_last_reading") > max_minutes)
            .select("patient_id", "ward", "doctor_id", "last_reading_at", "minutes_since_last_reading"))
