"""Silence by timers: the clock raises the alert, once, whatever the batches."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import raw_rows
from tests.test_streaming import T0, _land
from wardwatch.operators import marts, staging
from wardwatch.streaming import jobs, timers
from wardwatch.streaming.landing import read_landing


def utc_now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def wait_for(condition, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.5)
    return False


def test_alert_without_further_input_and_not_twice_after_a_restart(spark, workdir):
    land, out = f"{workdir}/landing", f"{workdir}/events"

    def start():
        src = read_landing(timers.timer_session(spark), land)
        return timers.start_silence(src, out, f"{workdir}/chk", limit_seconds=6, processing_time="1 second")

    def events():
        spark.catalog.refreshByPath(out)
        try:
            rows = spark.read.schema("patient_id string, last_reading_at timestamp_ntz, event string").parquet(out).collect()
        except Exception:       # nothing written yet
            return []
        return sorted((r["patient_id"], r["event"]) for r in rows)

    _land(spark, raw_rows(spark, [{"patient_id": "A", "reading_timestamp": utc_now()}]), land)
    q = start()
    try:
        assert wait_for(lambda: events() == [("A", "silent")])          # no record came after the first
    finally:
        q.stop()
    q = start()
    try:
        time.sleep(5)
        assert events() == [("A", "silent")]
        _land(spark, raw_rows(spark, [{"patient_id": "A", "reading_timestamp": utc_now() + dt.timedelta(seconds=4), "kafka_offset": 9},
                                      {"patient_id": "A", "reading_timestamp": T0, "kafka_offset": 10}]), land)
        assert wait_for(lambda: ("A", "resumed") in events())
        assert timers.open_alerts(spark.read.parquet(out)).count() == 0
        assert wait_for(lambda: events() == [("A", "resumed"), ("A", "silent"), ("A", "silent")])
        assert timers.open_alerts(spark.read.parquet(out), utc_now()).count() == 1
    finally:
        q.stop()


@pytest.mark.parametrize("files", [1, 3, 8])
def test_open_alerts_equal_the_batch_list(spark, workdir, files):
    """Late and repeated readings included; readings in the last hour are not silent."""
    hours = lambda h, m=0: T0 + dt.timedelta(hours=h, minutes=m)
    appends = [[("A", 0), ("B", 0)], [("A", 1), ("C", 2, 30)], [("B", 4, 10)], [("A", 3, 20)], [("C", 1), ("B", 0)], [("D", 4, 30), ("E", 0, 5)]]
    rows = []
    for k, some in enumerate(appends):
        batch = [{"patient_id": p, "reading_timestamp": hours(*at), "kafka_offset": 10 * k + i} for i, (p, *at) in enumerate(some)]
        rows += batch
        _land(spark, raw_rows(spark, batch), f"{workdir}/landing")
    _land(spark, raw_rows(spark, [{"patient_id": None}, {"patient_id": "F", "reading_timestamp": None}]), f"{workdir}/landing")
    as_of = hours(4, 30)
    src = read_landing(timers.timer_session(spark, drain=True), f"{workdir}/landing", max_files_per_trigger=files)
    jobs.run_to_end(timers.start_silence(src, f"{workdir}/events", f"{workdir}/chk", 3600, as_of, stamp=F.col("timestamp"), available_now=True))
    got = sorted(map(tuple, timers.silent_now(spark.read.parquet(f"{workdir}/events"), as_of).collect()))
    stg = staging.stage(raw_rows(spark, rows), carry=("kafka_offset",))
    want = marts.silent_monitors(marts.patient_summary(marts.latest_per_patient(stg), as_of), 60)
    assert got == sorted(map(tuple, want.collect())) and [g[0] for g in got] == ["A", "C", "E"]


def test_the_given_session_is_left_as_it_is(spark):
    plain = spark.newSession()
    plain.conf.set(timers.PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    plain.conf.set("spark.sql.shuffle.partitions", "3")
    beside = timers.timer_session(plain, drain=True)
    assert beside.conf.get(timers.PROVIDER) == timers.ROCKSDB != plain.conf.get(timers.PROVIDER)
    assert beside.conf.get("spark.sql.shuffle.partitions") == "3"
