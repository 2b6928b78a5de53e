"""Merged tables with several writers, patient sets as bitmaps, enrichment that waits, observed progress."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import raw_rows
from tests.test_streaming import T0, _land
from wardwatch.operators import marts, quality, staging
from wardwatch.operators.upsert import MergedTable
from wardwatch.streaming import enrichment, jobs, progress
from wardwatch.streaming.landing import read_landing


def sums(spark, path, every=None):
    return MergedTable(spark, path, lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), every)


def test_a_batch_that_comes_during_compaction_is_counted_once(spark, workdir):
    """Another stream adds a batch after the snapshot's contents are fixed, and before it is published."""
    one = spark.createDataFrame([("x", 1)], "k string, n long")
    table = sums(spark, f"{workdir}/t")
    table.add(one, "a", 0)
    table.add(one, "b", 0)
    publish = table.snapshot.publish

    def meanwhile(rows, through, **kw):
        table.add(one, "b", 1)
        table.add(one, "a", 1)
        return publish(rows, through, **kw)

    table.snapshot.publish = meanwhile
    assert table.compact("a", 0) == 1
    table.snapshot.publish = publish
    assert table.snapshot.through() == {"a": 0} and table.snapshot.read().first()["n"] == 1
    assert table.read().collect() == [("x", 4)]
    assert table.compact("b", 1) == 2 and table.read().collect() == [("x", 4)]
    assert table.compact("a", 1) == 3 and table.snapshot.read().collect() == [("x", 4)]
    table.add(one, "a", 1)                                  # replayed after it was folded in
    assert table.read().collect() == [("x", 4)]
    assert table.read_before("a", 1).collect() == [("x", 3)] and table.read_before("a", 2).collect() == [("x", 4)]


def test_two_streams_that_publish_at_once_lose_nothing(spark, workdir):
    one = spark.createDataFrame([("x", 1)], "k string, n long")
    table, other = sums(spark, f"{workdir}/t"), sums(spark, f"{workdir}/t")
    for source in "ab":
        table.add(one, source, 0)
    publish = table.snapshot.publish

    def meanwhile(rows, through, **kw):
        assert other.compact("b", 0) == 1
        return publish(rows, through, **kw)

    table.snapshot.publish = meanwhile
    assert table.compact("a", 0) is None                    # the other was first; the next compaction folds it in
    table.snapshot.publish = publish
    assert table.read().collect() == [("x", 2)] and table.compact("a", 0) == 2 and table.read().collect() == [("x", 2)]


def test_an_unfinished_batch_is_not_read(spark, workdir):
    one = spark.createDataFrame([("x", 1)], "k string, n long")
    table = sums(spark, f"{workdir}/t")
    table.add(one, "a", 0)
    (one.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .parquet(f"{workdir}/t/batches/source=a/batch_id=1"))
    assert table.read().collect() == [("x", 1)]


def test_patient_sets_are_exact_and_rows_do_not_grow_with_patients(spark):
    ids = [f"PAT-{k:04d}" for k in range(0, 3000)] + ["PAT-1", "PAT-00001", "PAT-40000", "pat-0001", "X", "PAT-123456789012345678"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").crossJoin(raw_rows(spark, [{}])).withColumn("patient_id", F.col("id")).drop("id")
    staged = staging.stage(rows)
    first, again = marts.ward_partials(staged), marts.ward_partials(staged.where("length(patient_id) = 8"))
    assert first.count() == 4 + 4                # number buckets 0, 1, 2 and a far one; four ids without a number
    merged = marts.merge_ward_partials(marts.merge_ward_partials(first.unionByName(again)).unionByName(again))
    got = marts.ward_hourly_of(merged).first()
    assert got["unique_patients"] == len(ids) and got["total_readings"] == len(ids) + 2 * 3001


REGISTRY = "patient_id string, patient_name string, age int, ward string, condition string, doctor_id string, entered int"


def test_enrichment_waits_for_the_registry(spark, workdir):
    readings = lambda *p: raw_rows(spark, [{"patient_id": i, "kafka_offset": o, "reading_timestamp": T0} for i, o in p]).select(
        "patient_id", "heart_rate_bpm", "systolic_bp_mmhg", "diastolic_bp_mmhg", "spo2_pct", "temperature_celsius", "respiratory_rate",
        "reading_timestamp", "kafka_offset")
    schema = readings(("A", 0)).schema

    def register(*entries):
        (spark.createDataFrame([(p, f"Name {p}", 50, ward, "Stable", "DR-001", n) for p, ward, n in entries], REGISTRY)
         .write.mode("append").parquet(f"{workdir}/registry"))

    def run():
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{workdir}/readings")
        jobs.run_to_end(enrichment.start_enrich(src, lambda s: enrichment.current_registry(s, f"{workdir}/registry", "entered"),
                                                f"{workdir}/out", f"{workdir}/chk"))
        got = sorted((r["patient_id"], r["kafka_offset"], r["ward"]) for r in enrichment.read_enriched(spark, f"{workdir}/out").collect())
        return got, sorted(r["kafka_offset"] for r in enrichment.read_waiting(spark, f"{workdir}/out").collect())

    def send(*p):
        readings(*p).coalesce(1).write.mode("append").parquet(f"{workdir}/readings")

    register(("A", "ICU", 1))
    send(("A", 0), ("B", 1), (None, 2))
    send(("B", 3), ("C", 4))
    assert run() == ([("A", 0, "ICU")], [1, 2, 3, 4])
    register(("B", "Pediatrics", 1), ("A", "Cardiology", 2))         # B is registered, A has moved
    send(("A", 5))
    assert run() == ([("A", 0, "ICU"), ("A", 5, "Cardiology"), ("B", 1, "Pediatrics"), ("B", 3, "Pediatrics")], [2, 4])
    register(("C", "ICU", 1))
    send(("D", 6))
    assert run()[1] == [2, 6]


def test_progress_is_observed_and_gated(spark, workdir):
    log = progress.ProgressLog(spark, f"{workdir}/progress", "ward-a")
    spark.streams.addListener(log)

    def run(rows):
        _land(spark, raw_rows(spark, rows), f"{workdir}/landing")
        q = progress.start_observed_staging(read_landing(spark, f"{workdir}/landing", 1), f"{workdir}/out", f"{workdir}/chk", "ward-a", stamp=F.col("timestamp"))
        jobs.run_to_end(q)
        log.wait_for(q)
        return progress.read_progress(spark, f"{workdir}/progress")

    try:
        seen = run([{"patient_id": "PAT-0001", "heart_rate_bpm": None}, {"patient_id": None}])
        values = {(r["batch_id"], r["metric"]): r["value"] for r in seen.collect()}
        assert values[0, "messages_received"] == 2 and values[0, "rows_loaded"] == values[0, "rows"] == values[0, "rows_quarantined"] == 1
        assert [r["metric"] for r in progress.enforce_progress(seen)] == ["heart_rate_bpm.missing"]        # a warning only
        seen = run([{"ward": "Morgue"}])
        with pytest.raises(quality.QualityGateError, match="ward.accepted_values: 1 from batch 1 on"):
            progress.enforce_progress(seen)
        assert {r["metric"]: r["total"] for r in progress.totals(seen).collect()}["messages_received"] == 3
    finally:
        spark.streams.removeListener(log)
