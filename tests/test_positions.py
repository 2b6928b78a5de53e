"""Source positions: intervals against sets, redelivery, loss, positions of files."""

import datetime as dt
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.helpers import raw_rows
from tests.test_streaming import T0, _land
from wardwatch.operators import offsets
from wardwatch.sources import messages
from wardwatch.streaming import jobs
from wardwatch.streaming.landing import read_landing, read_message_files, start_file_load

POSITIONS = "kafka_partition int, kafka_offset long"


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(offsets, "BLOCK", 8)


def stretches(found):
    out = []
    for p, o in sorted(found):
        if out and out[-1][0] == p and out[-1][2] == o - 1:
            out[-1][2] = o
        else:
            out.append([p, o, o])
    return [tuple(x) for x in out]


def test_islands_merge_and_gaps_equal_sets(spark, small_blocks):
    rng = random.Random(3)
    batches = [[(rng.randrange(2), rng.randrange(60)) for _ in range(25)] for _ in range(3)] + [[(1, 2), (1, 2), (None, 5), (0, None), (5, 10**12), (5, 10**12 + 30)]]
    parts = [offsets.islands(spark.createDataFrame(b, POSITIONS)) for b in batches]
    merged = offsets.merge_intervals(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))
    merged = offsets.merge_intervals(merged)                 # may be applied to its own output
    got = merged.collect()
    there = {x for b in batches for x in b if None not in x}
    assert {(r["kafka_partition"], o) for r in got for o in range(r["first"], r["last"] + 1)} == there
    assert all(r["first"] // 8 == r["last"] // 8 == r["block"] for r in got)
    blocks = stretches({(p, o) for p, o in there})
    assert len(got) == sum(last // 8 - first // 8 + 1 for _, first, last in blocks)
    missing = []
    for (p, _, last), (q, first, _) in zip(blocks, blocks[1:]):
        if p == q:
            missing.append((p, last + 1, first - 1, first - last - 1))
    assert sorted(map(tuple, offsets.gaps(merged).collect())) == missing


def test_first_deliveries(spark, small_blocks):
    known = offsets.islands(spark.createDataFrame([(0, k) for k in range(5, 20)] + [(1, 3)], POSITIONS))
    rows = [(0, 4, "a"), (0, 5, "b"), (0, 19, "c"), (0, 20, "d"), (0, 20, "d"), (1, 5, "e"), (None, 7, "f"), (0, None, "g"), (0, None, "g"), (2, 6, "h")]
    records = spark.createDataFrame(rows, "partition int, offset long, value string")
    got = lambda known: sorted(r["value"] for r in offsets.first_deliveries(records, known, "partition", "offset").collect())
    assert got(known) == ["a", "d", "e", "f", "g", "g", "h"]
    assert got(None) == ["a", "b", "c", "d", "e", "f", "g", "g", "h"]


def test_all_elements_of_an_array_record_are_kept_once(spark, workdir):
    values = messages.encode(raw_rows(spark, [{"patient_id": f"PAT-000{k}"} for k in range(2)])).agg(F.collect_list("value").alias("v"))
    record = values.select(F.lit("k").alias("key"), F.concat(F.lit("["), F.array_join("v", ","), F.lit("]")).alias("value"),
                           F.lit(0).alias("partition"), F.lit(1).cast("long").alias("offset"), F.lit(T0).cast("timestamp_ntz").alias("timestamp"))
    from wardwatch.streaming.landing import JSON_OPTIONS
    for _ in range(2):
        record.write.mode("append").options(**JSON_OPTIONS).json(f"{workdir}/landing")
    jobs.run_to_end(jobs.start_dedup(read_landing(spark, f"{workdir}/landing", 1), f"{workdir}/out", f"{workdir}/chk", stamp=F.col("timestamp")))
    assert sorted(r["patient_id"] for r in jobs.read_batches(spark, f"{workdir}/out").collect()) == ["PAT-0000", "PAT-0001"]


def test_loss_is_reported_until_the_records_come(spark, workdir):
    def run():
        jobs.run_to_end(jobs.start_dedup(read_landing(spark, f"{workdir}/landing", 1), f"{workdir}/out", f"{workdir}/chk",
                                         stamp=F.col("timestamp"), compact_every=2))
        return sorted(map(tuple, jobs.offset_gaps(spark, f"{workdir}/out_received").collect()))

    # a record that does not load was received all the same
    _land(spark, raw_rows(spark, [{"kafka_offset": 1}, {"kafka_offset": 2, "patient_id": None}]), f"{workdir}/landing")
    _land(spark, raw_rows(spark, [{"kafka_offset": 6}, {"kafka_offset": 200_000}]), f"{workdir}/landing")
    assert run() == [(0, 3, 5, 3), (0, 7, 199_999, 199_993)]
    _land(spark, raw_rows(spark, [{"kafka_offset": 4, "reading_timestamp": T0 - dt.timedelta(days=3000)}]), f"{workdir}/landing")
    _land(spark, raw_rows(spark, [{"kafka_offset": 4, "reading_timestamp": T0 - dt.timedelta(days=3000)}, {"kafka_offset": 1}]), f"{workdir}/landing")
    assert run() == [(0, 3, 3, 1), (0, 5, 5, 1), (0, 7, 199_999, 199_993)]
    assert sorted(r["kafka_offset"] for r in jobs.read_batches(spark, f"{workdir}/out").collect()) == [1, 4, 6, 200_000]


def test_a_replayed_batch_is_not_taken_for_a_redelivery(spark, workdir):
    """The batch fails after its rows and intervals are written; its second try writes the same rows again."""
    land, out = f"{workdir}/landing", f"{workdir}/out"
    _land(spark, raw_rows(spark, [{"kafka_offset": 1}]), land)
    _land(spark, raw_rows(spark, [{"kafka_offset": 2}, {"kafka_offset": 1}]), land)
    table = jobs.received_intervals(spark, f"{out}_received", 2)       # the failing batch is folded into a snapshot as well
    body = jobs.first_delivery_writer(jobs.batch_writer(jobs.deduplicated_job(out), f"{out}_quarantine", F.col("timestamp")), table)

    def crash(batch, batch_id):
        body(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after the write")

    q = (read_landing(spark, land, 1).writeStream.foreachBatch(crash).option("checkpointLocation", f"{workdir}/chk")
         .trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)
    jobs.run_to_end(jobs.start_dedup(read_landing(spark, land, 1), out, f"{workdir}/chk", stamp=F.col("timestamp"), compact_every=2))
    assert sorted(r["kafka_offset"] for r in jobs.read_batches(spark, out).collect()) == [1, 2]


def test_file_loads_know_their_file_and_archive_it(spark, workdir):
    land = f"{workdir}/landing"

    def send(name, *patients):
        rows = messages.encode(raw_rows(spark, [{"patient_id": p} for p in patients])).select("value")
        rows.coalesce(1).write.mode("append").text(f"{land}/{name}")

    def run():
        files = read_message_files(spark, f"{land}/*", f"{workdir}/archive", max_files_per_trigger=1)
        jobs.run_to_end(start_file_load(files, f"{workdir}/raw", f"{workdir}/chk", stamp=F.lit(T0)))
        return sorted((r["patient_id"], r["source_file"].split("/")[-2], r["source_block"]) for r in jobs.read_batches(spark, f"{workdir}/raw").collect())

    send("a", "PAT-0001", None)
    send("b", "PAT-0002")
    assert run() == [("PAT-0001", "a", 0), ("PAT-0002", "b", 0)]
    send("c", "PAT-0003")
    assert run() == [("PAT-0001", "a", 0), ("PAT-0002", "b", 0), ("PAT-0003", "c", 0)]
    bad = spark.read.parquet(f"{workdir}/raw_quarantine").collect()
    assert [(r["reason"], r["source_file"].split("/")[-2]) for r in bad] == [("null_patient_id", "a")]
    local = lambda p: p.removeprefix("file:")
    moved = [f for d, _, names in os.walk(local(f"{workdir}/archive")) for f in names if f.endswith(".txt")]
    assert moved, "a file that is loaded leaves the landing folder"
    send("d", "PAT-0004")
    assert [g[1] for g in run()] == ["a", "b", "c", "d"]


def test_too_many_repaired_records_stop_the_load(spark, workdir):
    good = messages.encode(raw_rows(spark, [{"kafka_offset": k} for k in range(4)]), keep=("kafka_partition", "kafka_offset")).select(
        F.encode("value", "UTF-8").alias("value"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))
    bad = good.where("offset = 0").select(F.concat(F.unhex(F.lit("FF")), "value").alias("value"), "partition", F.lit(9).cast("long").alias("offset"))
    counted = messages.utf8_counts(good.unionByName(bad))
    assert [tuple(r) for r in counted.collect()] == [(0, 5, 1, 20.0)]
    messages.enforce_utf8(counted, 20)
    with pytest.raises(messages.EncodingError, match="1 of 5 in partition 0"):
        messages.enforce_utf8(counted, 19.9)
    body = jobs.batch_writer(jobs.raw_job(f"{workdir}/raw"), f"{workdir}/q", F.lit(T0), most_repaired_pct=5)
    body(good, 0)
    with pytest.raises(messages.EncodingError):
        body(good.unionByName(bad), 1)
    assert jobs.read_raw(spark, f"{workdir}/raw").count() == 4
