"""Streaming jobs on hand-made landed records."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from pyspark.sql import functions as F

from tests.helpers import raw_rows
from wardwatch.streaming import jobs
from wardwatch.streaming.landing import JSON_OPTIONS, read_landing
from wardwatch.sources import messages

T0 = dt.datetime(2024, 1, 30, 10, 0, 0)


def _land(spark, raw, path):
    rec = messages.encode(raw, keep=("kafka_partition", "kafka_offset", "ingested_at")).select(
        "key", "value", F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"), F.col("ingested_at").alias("timestamp"))
    rec.coalesce(1).write.mode("append").options(**JSON_OPTIONS).json(path)


def test_ward_hours_count_open_and_late_readings(spark, workdir):
    """The current hour is there at once, and a reading that comes days late still counts."""
    hour = [{"reading_timestamp": T0 + dt.timedelta(minutes=m)} for m in range(0, 50, 7)]
    open_hour = [{"reading_timestamp": T0 + dt.timedelta(hours=3)}]
    late = [{"reading_timestamp": T0 - dt.timedelta(days=9), "patient_id": "PAT-0002"}, {"reading_timestamp": T0}]
    for rows in (hour, open_hour, late):
        _land(spark, raw_rows(spark, rows), f"{workdir}/landing")
    for k, every in enumerate((None, 1, 2)):        # without, with, and between compactions
        src = read_landing(spark, f"{workdir}/landing", max_files_per_trigger=1)
        jobs.run_to_end(jobs.start_ward_hourly(src, f"{workdir}/out{k}", f"{workdir}/chk{k}", stamp=F.col("timestamp"),
                                               compact_every=every))
        rows = jobs.read_ward_hourly(spark, f"{workdir}/out{k}").orderBy("reading_hour").collect()
        assert [(r["reading_hour"], r["total_readings"], r["unique_patients"]) for r in rows] == [
            (T0 - dt.timedelta(days=9), 1, 1), (T0, 9, 1), (T0 + dt.timedelta(hours=3), 1, 1)]


def test_second_stream_on_a_fresh_checkpoint_adds(spark, workdir):
    """Batch numbers start again with a new checkpoint; what was written before stays."""
    for k in range(2):
        _land(spark, raw_rows(spark, [{"patient_id": f"PAT-000{k}", "kafka_offset": k}]), f"{workdir}/landing{k}")
        src = read_landing(spark, f"{workdir}/landing{k}")
        jobs.run_to_end(jobs.start_ward_hourly(src, f"{workdir}/hours", f"{workdir}/chk{k}", stamp=F.col("timestamp"), compact_every=1))
        src = read_landing(spark, f"{workdir}/landing{k}")
        jobs.run_to_end(jobs.start_latest(src, f"{workdir}/mart", f"{workdir}/chk-mart{k}", stamp=F.col("timestamp"), compact_every=1))
    assert jobs.read_ward_hourly(spark, f"{workdir}/hours").first()["unique_patients"] == 2
    assert sorted(r["patient_id"] for r in jobs.latest_table(spark, f"{workdir}/mart").read().collect()) == ["PAT-0000", "PAT-0001"]


def test_redelivery_dropped_across_batches(spark, workdir):
    first = raw_rows(spark, [{"patient_id": "PAT-0001", "kafka_offset": 1}, {"patient_id": "PAT-0002", "kafka_offset": 2}])
    late = raw_rows(spark, [{"patient_id": "PAT-0003", "kafka_offset": 3, "reading_timestamp": T0 - dt.timedelta(days=30)},
                            {"patient_id": "PAT-0001", "kafka_offset": 4, "heart_rate_bpm": 99}])
    _land(spark, first, f"{workdir}/landing")
    _land(spark, first.where(F.col("patient_id") == "PAT-0001"), f"{workdir}/landing")   # sent again
    _land(spark, late, f"{workdir}/landing")             # first deliveries, one a month late, one of a known reading time
    src = read_landing(spark, f"{workdir}/landing", max_files_per_trigger=1)
    jobs.run_to_end(jobs.start_dedup(src, f"{workdir}/out", f"{workdir}/chk", stamp=F.col("timestamp")))
    got = sorted((r["patient_id"], r["kafka_offset"]) for r in jobs.read_batches(spark, f"{workdir}/out").collect())
    assert got == [("PAT-0001", 1), ("PAT-0001", 4), ("PAT-0002", 2), ("PAT-0003", 3)]


def test_stream_latest_keeps_newer_row(spark, workdir):
    newer = raw_rows(spark, [{"heart_rate_bpm": 90, "reading_timestamp": T0 + dt.timedelta(hours=1)}])
    older = raw_rows(spark, [{"heart_rate_bpm": 70, "reading_timestamp": T0}])
    _land(spark, newer, f"{workdir}/landing")
    _land(spark, older, f"{workdir}/landing")
    src = read_landing(spark, f"{workdir}/landing", max_files_per_trigger=1)
    jobs.run_to_end(jobs.start_latest(src, f"{workdir}/mart", f"{workdir}/chk", stamp=F.col("timestamp"), compact_every=None))
    table = jobs.latest_table(spark, f"{workdir}/mart")
    assert [r["heart_rate_bpm"] for r in table.read().collect()] == [90]
    source = spark.read.parquet(f"{workdir}/mart/batches").first()["source"]
    assert table.compact(source, 1) == 1 and table.snapshot.read().count() == 1
    assert [r["heart_rate_bpm"] for r in table.read().collect()] == [90]


def test_latest_writes_only_the_patients_of_the_batch(spark, workdir):
    _land(spark, raw_rows(spark, [{"patient_id": f"PAT-{i:04d}"} for i in range(1, 31)]), f"{workdir}/landing")
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0007", "reading_timestamp": T0 + dt.timedelta(hours=2)}]), f"{workdir}/landing")
    src = read_landing(spark, f"{workdir}/landing", max_files_per_trigger=1)
    jobs.run_to_end(jobs.start_latest(src, f"{workdir}/mart", f"{workdir}/chk", stamp=F.col("timestamp")))
    batches = spark.read.parquet(f"{workdir}/mart/batches")
    assert {r["batch_id"]: r["count"] for r in batches.groupBy("batch_id").count().collect()} == {0: 30, 1: 1}
    assert jobs.latest_table(spark, f"{workdir}/mart").read().count() == 30


@pytest.mark.parametrize("files", [1, 2, 8])
def test_silent_alerts_do_not_depend_on_the_batches(spark, workdir, files):
    from wardwatch.streaming.silent import start_silent, start_too_late
    for h in range(0, 8):       # whole appends in time order
        rows = [{"patient_id": p, "reading_timestamp": T0 + dt.timedelta(hours=h, minutes=m)} for p, m, hours in
                (("A", 0, (0, 1, 2, 5)), ("B", 5, range(8)), ("B", 50, range(8)), ("C", 30, (3,))) if h in hours]
        _land(spark, raw_rows(spark, rows), f"{workdir}/landing")
    late = raw_rows(spark, [{"patient_id": "D", "reading_timestamp": T0, "kafka_offset": 77}, {"patient_id": None}])
    _land(spark, late, f"{workdir}/landing")
    for start, name in ((start_silent, "alerts"), (start_too_late, "late")):
        src = read_landing(spark, f"{workdir}/landing", max_files_per_trigger=files)
        jobs.run_to_end(start(src, f"{workdir}/{name}", f"{workdir}/chk-{name}", limit_minutes=60, delay_minutes=30, stamp=F.col("timestamp")))
    got = sorted((r["patient_id"], r["last_reading_at"], r["silent_after"]) for r in spark.read.parquet(f"{workdir}/alerts").collect())
    hours = lambda h, m=0: T0 + dt.timedelta(hours=h, minutes=m)
    want = [("A", hours(h), hours(h + 1)) for h in (2, 5)] + [("C", hours(3, 30), hours(4, 30))]
    assert [g for g in got if g[0] != "D"] == want
    # a reading that came after its session had closed is listed
    listed = [r["kafka_offset"] for r in jobs.read_batches(spark, f"{workdir}/late").collect()]
    assert listed == [77]
    assert jobs.read_batches(spark, f"{workdir}/late_quarantine").first()["reason"] == "null_patient_id"


def test_silent_monitor_session(spark, workdir):
    from wardwatch.streaming.silent import start_silent
    _land(spark, raw_rows(spark, [{"patient_id": "A", "reading_timestamp": T0},
                                  {"patient_id": "B", "reading_timestamp": T0}]), f"{workdir}/landing")
    _land(spark, raw_rows(spark, [{"patient_id": "B", "reading_timestamp": T0 + dt.timedelta(hours=2)},
                                  {"patient_id": "C", "reading_timestamp": T0 + dt.timedelta(hours=4)}]),
          f"{workdir}/landing")
    src = read_landing(spark, f"{workdir}/landing", max_files_per_trigger=1)
    jobs.run_to_end(start_silent(src, f"{workdir}/out", f"{workdir}/chk", limit_minutes=60,
                                 delay_minutes=10, stamp=F.col("timestamp")))
    got = sorted((r["patient_id"], r["last_reading_at"], r["silent_after"])
                 for r in spark.read.parquet(f"{workdir}/out").collect())
    assert got == [("A", T0, T0 + dt.timedelta(hours=1)), ("B", T0, T0 + dt.timedelta(hours=1)),
                   ("B", T0 + dt.timedelta(hours=2), T0 + dt.timedelta(hours=3))]


def test_staging_stream_counts_quality_and_keeps_bad_records(spark, workdir):
    _land(spark, raw_rows(spark, [{"ward": "Morgue"}, {"patient_id": "PAT-0002"}, {"patient_id": None}]), f"{workdir}/landing")
    q = jobs.start_staging(read_landing(spark, f"{workdir}/landing"), f"{workdir}/out", f"{workdir}/chk",
                           stamp=F.col("timestamp"))
    jobs.run_to_end(q)
    assert jobs.read_batches(spark, f"{workdir}/out").count() == 2
    seen = {(r["column_name"], r["test"]): r["failing_rows"] for r in spark.read.parquet(f"{workdir}/out_checks").collect()}
    assert seen["ward", "accepted_values"] == 1 and seen["ward", "not_null"] == 0
    assert [r["reason"] for r in spark.read.parquet(f"{workdir}/out_quarantine").collect()] == ["null_patient_id"]


def test_ingest_stream_load_log(spark, workdir):
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0001"}, {"patient_id": None}]), f"{workdir}/landing")
    q = jobs.start_ingest(read_landing(spark, f"{workdir}/landing"), f"{workdir}/raw", f"{workdir}/quarantine",
                          f"{workdir}/chk", stamp=F.col("timestamp"), log_path=f"{workdir}/log")
    jobs.run_to_end(q)
    log = spark.read.parquet(f"{workdir}/log").first()
    assert (log["messages_received"], log["rows_loaded"], log["rows_quarantined"]) == (2, 1, 1)
    assert jobs.read_raw(spark, f"{workdir}/raw").count() == 1
    assert spark.read.parquet(f"{workdir}/quarantine").first()["reason"] == "null_patient_id"


def test_ingest_resumes_from_checkpoint_and_replays_idempotently(spark, workdir):
    """A batch that fails after writing is replayed on restart without duplicates;
    a restarted query reads only files it has not committed."""
    land, chk = f"{workdir}/landing", f"{workdir}/chk"
    raw_path, quar = f"{workdir}/raw", f"{workdir}/quarantine"
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0001", "kafka_offset": 1}]), land)
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0002", "kafka_offset": 2}]), land)
    good = jobs.ingest_batch_writer(raw_path, quar, F.col("timestamp"))

    def crash_in_second_batch(batch, batch_id):
        good(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("executor lost after the write")

    q = (read_landing(spark, land, max_files_per_trigger=1).writeStream
         .foreachBatch(crash_in_second_batch).option("checkpointLocation", chk)
         .trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)
    # restart on the same checkpoint: batch 1 is replayed, then a new file arrives
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0003", "kafka_offset": 3}]), land)
    jobs.run_to_end(jobs.start_ingest(read_landing(spark, land, max_files_per_trigger=1), raw_path, quar, chk,
                                      stamp=F.col("timestamp")))
    got = sorted(r["kafka_offset"] for r in jobs.read_raw(spark, raw_path).collect())
    assert got == [1, 2, 3]


def test_ingest_on_a_timer(spark, workdir):
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0001"}]), f"{workdir}/landing")
    q = jobs.start_ingest(read_landing(spark, f"{workdir}/landing"), f"{workdir}/raw", f"{workdir}/q",
                          f"{workdir}/chk", stamp=F.col("timestamp"), available_now=False,
                          processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert jobs.read_raw(spark, f"{workdir}/raw").count() == 1


def test_gated_staging_stops_on_bad_batch(spark, workdir):
    land = f"{workdir}/landing"
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0001"}]), land)
    _land(spark, raw_rows(spark, [{"patient_id": "PAT-0002", "ward": "Morgue"}]), land)
    q = jobs.start_staging(read_landing(spark, land, max_files_per_trigger=1), f"{workdir}/out",
                           f"{workdir}/chk", stamp=F.col("timestamp"), gate=True)
    with pytest.raises(StreamingQueryException, match="data-quality gate failed"):
        q.awaitTermination(120)
    published = spark.read.parquet(f"{workdir}/out").collect()
    assert [r["patient_id"] for r in published] == ["PAT-0001"]


def test_streamed_raw_prunes_reading_days(spark, workdir):
    from wardwatch.operators import marts, staging
    days = [{"reading_timestamp": T0 - dt.timedelta(days=d), "kafka_offset": d} for d in range(5)]
    _land(spark, raw_rows(spark, days), f"{workdir}/landing")
    jobs.run_to_end(jobs.start_ingest(read_landing(spark, f"{workdir}/landing"), f"{workdir}/raw", f"{workdir}/q",
                                      f"{workdir}/chk", stamp=F.col("timestamp")))
    jobs.compact_raw(spark, f"{workdir}/raw", f"{workdir}/raw-compacted")
    for path in (f"{workdir}/raw", f"{workdir}/raw-compacted"):
        recent = marts.lookback(staging.stage(jobs.read_raw(spark, path)), T0, hours=24)
        plan = recent._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "reading_day" in filters and ">= 2024-01-29" in filters
        assert recent.count() == 2 and jobs.read_raw(spark, path).count() == 5
