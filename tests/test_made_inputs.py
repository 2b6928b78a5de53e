"""Hand-made inputs per operator (one behaviour each)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import raw_rows
from wardwatch.functions.time import boundaries_between
from wardwatch.operators import marts, monitoring, quality, staging, upsert
from wardwatch.schemas import ENVELOPE_SCHEMA
from wardwatch.sources import messages

T0 = dt.datetime(2024, 1, 30, 10, 0, 0)


def test_latest_tie_broken_by_offset(spark):
    raw = raw_rows(spark, [{"heart_rate_bpm": 70, "kafka_offset": 1}, {"heart_rate_bpm": 90, "kafka_offset": 2}])
    rows = marts.latest_per_patient(staging.stage(raw, carry=("kafka_offset",))).collect()
    assert len(rows) == 1 and rows[0]["heart_rate_bpm"] == 90


def test_minute_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(boundaries_between("minute", "a", "b").alias("boundary"),
                  F.timestamp_diff("MINUTE", "a", "b").alias("elapsed")).first()
    assert (r["boundary"], r["elapsed"]) == (1, 0)


def test_average_temperature_tie_rounds_half_up(spark):
    temps = [36.6, 36.7, 36.8, 37.0]
    raw = raw_rows(spark, [{"temperature_celsius": t, "reading_timestamp": T0 + dt.timedelta(minutes=i)}
                           for i, t in enumerate(temps)])
    row = marts.ward_hourly(staging.stage(raw)).first()
    assert row["avg_temperature"] == 36.78
    assert row["total_readings"] == 4 and row["unique_patients"] == 1


def _records(spark, values):
    rows = [(None, v, 0, i, T0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_decode_cases(spark):
    ok = '{"patient_id":"PAT-0001","age":40,"reading_timestamp":"2024-01-30T10:00:00.000001"}'
    recs = _records(spark, [
        ok,
        '{bad',
        '{"patient_id":"PAT-0002","age":98.6}',
        '{"patient_id":"PAT-0003","heart_rate_bpm":"12"}',
        '{"patient_id":"PAT-0004"}',
        '[{"patient_id":"PAT-0005"},{"patient_id":"PAT-0006"}]',
    ])
    dec = {(r["kafka_offset"], r["patient_id"]): r for r in messages.decode(recs, stamp=F.lit(T0)).collect()}
    assert dec[(0, "PAT-0001")]["_reason"] is None
    assert dec[(0, "PAT-0001")]["reading_timestamp"] == dt.datetime(2024, 1, 30, 10, 0, 0, 1)
    assert dec[(1, None)]["_reason"] == "malformed_json"
    assert dec[(2, "PAT-0002")]["_reason"] == "bad_value:age"
    assert dec[(3, "PAT-0003")]["heart_rate_bpm"] == 12 and dec[(3, "PAT-0003")]["_reason"] is None
    assert dec[(4, "PAT-0004")]["age"] is None and dec[(4, "PAT-0004")]["_reason"] is None
    assert {k for k in dec if k[0] == 5} == {(5, "PAT-0005"), (5, "PAT-0006")}
    counts = messages.counts(messages.decode(recs, stamp=F.lit(T0))).first()
    assert counts["messages_received"] == 6 and counts["records_decoded"] == 7
    assert counts["rows_loaded"] == 5 and counts["rows_quarantined"] == 2


def test_decode_invalid_utf8(spark):
    recs = spark.createDataFrame(
        [(None, b'{"patient_id":"PAT-0001","patient_name":"a\xffb"}', 0, 0, T0)],
        "key string, value binary, partition int, offset long, timestamp timestamp_ntz")
    r = messages.decode(recs, stamp=F.lit(T0)).first()
    assert r["patient_name"] == "a�b" and r["_reason"] is None


def test_quarantine_reasons(spark):
    recs = _records(spark, ['{"age":40}', '{"patient_id":"' + "P" * 21 + '"}'])
    q = {r["kafka_offset"]: r for r in messages.quarantined(messages.decode(recs, stamp=F.lit(T0))).collect()}
    assert q[0]["reason"] == "null_patient_id" and q[1]["reason"] == "too_long:patient_id"
    assert q[0]["raw"] == '{"age":40}'


def _summary(spark, rows):
    return spark.createDataFrame(rows, "patient_id string, last_reading_at timestamp_ntz, v int")


def test_upsert_newer_wins(spark, workdir):
    table = upsert.VersionedTable(spark, workdir)
    table.upsert(_summary(spark, [("A", T0, 1), ("B", T0, 2)]), batch=1)
    table.upsert(_summary(spark, [("A", T0 + dt.timedelta(hours=1), 3), ("C", T0, 4)]), batch=2)
    table.upsert(_summary(spark, [("A", T0 - dt.timedelta(hours=1), 5)]), batch=3)
    got = {r["patient_id"]: r["v"] for r in table.read().collect()}
    assert got == {"A": 3, "B": 2, "C": 4}
    # a batch that is already in is a replay: no new version, nothing changed
    assert table.upsert(_summary(spark, [("A", T0 + dt.timedelta(hours=9), 9)]), batch=2) == 3 == table.latest()
    assert {r["patient_id"]: r["v"] for r in table.read(2).collect()} == {"A": 3, "B": 2, "C": 4}


def test_schema_sync(spark):
    target = _summary(spark, [("A", T0, 1), ("B", T0, 2)])
    more = spark.createDataFrame([("A", T0 + dt.timedelta(hours=1), 3, "x")],
                                 "patient_id string, last_reading_at timestamp_ntz, v int, extra string")
    step1 = upsert.upsert_by_key(target, more, sync_schema=True)
    rows = {r["patient_id"]: r for r in step1.collect()}
    assert step1.columns == ["patient_id", "last_reading_at", "v", "extra"]
    assert rows["A"]["extra"] == "x" and rows["B"]["extra"] is None
    fewer = spark.createDataFrame([("B", T0 + dt.timedelta(hours=1))], "patient_id string, last_reading_at timestamp_ntz")
    step2 = upsert.upsert_by_key(step1, fewer, sync_schema=True)
    assert step2.columns == ["patient_id", "last_reading_at"] and step2.count() == 2


def test_quality_counts(spark):
    raw = raw_rows(spark, [{"ward": None}, {"ward": "Morgue", "patient_id": "PAT-0002"},
                           {"patient_id": "PAT-0003"}])
    stg = staging.stage(raw, carry=("kafka_offset",))
    mart = marts.patient_summary(marts.latest_per_patient(stg), T0)
    dup = mart.unionByName(mart.where(F.col("patient_id") == "PAT-0003"))
    checks = [c for c in quality.default_checks()
              if (c.relation, c.column, c.test) in {
                  (quality.STAGING, "ward", "not_null"), (quality.STAGING, "ward", "accepted_values"),
                  (quality.MART, "patient_id", "unique")}]
    rep = {(r["column_name"], r["test"]): r["failing_rows"] for r in quality.report(raw, dup, checks).collect()}
    assert rep == {("ward", "not_null"): 1, ("ward", "accepted_values"): 1, ("patient_id", "unique"): 1}
    with pytest.raises(quality.QualityGateError):
        quality.enforce(quality.report(raw, dup, checks))


def test_latest20_null_time_first(spark):
    raw = raw_rows(spark, [{"reading_timestamp": T0}, {"reading_timestamp": None},
                           {"reading_timestamp": T0 + dt.timedelta(hours=1)}])
    rows = monitoring.latest_readings(raw, 2).collect()
    assert rows[0]["reading_timestamp"] is None and rows[1]["reading_timestamp"] == T0 + dt.timedelta(hours=1)


def test_keyed_sink_splits_hot_key(spark, workdir):
    from wardwatch.sources.sinks import read_keyed_json, write_keyed_json
    raw = raw_rows(spark, [{"kafka_offset": i} for i in range(10)])   # one patient only
    write_keyed_json(raw, f"{workdir}/out", partitions=4, block_rows=3)
    back = read_keyed_json(spark, f"{workdir}/out")
    assert back.count() == 10 and back.select("key").distinct().count() == 1
    files = back.select(F.input_file_name().alias("f")).distinct().count()
    assert files >= 2          # four blocks of at most 3 offsets, not one task


def test_versions_are_immutable(spark, workdir):
    """No attempt, failed or not, and no restart touches what an older version holds."""
    table = upsert.VersionedTable(spark, workdir)
    for v in range(1, 5):
        table.upsert(_summary(spark, [(f"K{v}", T0, v)]), batch=v, source="first stream")

    def refuse(written):
        raise ValueError("audit")

    with pytest.raises(ValueError):
        table.upsert(_summary(spark, [("K1", T0 + dt.timedelta(hours=1), 999)]), batch=5, source="first stream", audit=refuse)
    assert table.latest() == 4 and {r["v"] for r in table.read(1).collect()} == {1}
    assert {r["v"] for r in table.read().collect()} == {1, 2, 3, 4}
    # a stream on a fresh checkpoint counts its batches from 0 again
    again = upsert.VersionedTable(spark, workdir)
    assert again.upsert(_summary(spark, [("K9", T0, 9)]), batch=0, source="second stream") == 5
    for reader in (table, again, upsert.VersionedTable(spark, workdir)):
        assert {r["v"] for r in reader.read().collect()} == {1, 2, 3, 4, 9}
        assert {r["v"] for r in reader.read(2).collect()} == {1, 2}
    with pytest.raises(FileNotFoundError):
        table.read(99)


def test_first_version_has_one_row_per_key(spark, workdir):
    table = upsert.VersionedTable(spark, workdir)
    table.upsert(_summary(spark, [("A", T0, 1), ("A", T0 + dt.timedelta(hours=1), 2)]), batch=0)
    assert [r["v"] for r in table.read().collect()] == [2]


def test_only_a_missing_path_reads_as_empty(spark, workdir):
    assert upsert.read_if_there(spark, f"{workdir}/none") is None
    spark.createDataFrame([("x",)], "a string").write.text(f"{workdir}/text")
    with pytest.raises(Exception):
        upsert.read_if_there(spark, f"{workdir}/text").count()


def test_everything_received_is_loaded_or_set_aside(spark):
    recs = _records(spark, [
        '{"patient_id":"A"}', '[{"patient_id":"B"},null,5,"{q",{"patient_id":"C"}]', "[]", '{"patient_id":"D"}{"patient_id":"E"}',
        '{"patient_id":"F"} tail', '[{"patient_id":"G"}] tail', "null", "5", "", None, '{"patient_id":"H"},{"patient_id":"I"}', "[[]]",
        '{"patient_id":"J","reading_timestamp":"2024-01-30T10:00:00+05:30"}', '{"patient_id":"K","reading_timestamp":"2024-01-30T10:00:00Z"}',
        '{"patient_id":"L","reading_timestamp":"2024-01-30"}', '{"patient_id":"M","reading_timestamp":"10 o\'clock"}'])
    dec = messages.decode(recs, stamp=F.lit(T0))
    rows = dec.collect()
    assert {r["kafka_offset"] for r in rows} == set(range(16))
    why = {}
    for r in rows:
        why.setdefault(r["kafka_offset"], []).append(r["_reason"])
    assert why == {0: [None], 1: [None, "null_element", "not_an_object", "malformed_json", None], 2: ["empty_array"], 3: ["malformed_json"],
                   4: ["malformed_json"], 5: ["malformed_json"], 6: ["not_an_object"], 7: ["malformed_json"], 8: ["malformed_json"],
                   9: ["malformed_json"], 10: ["malformed_json"], 11: ["not_an_object"], 12: [None], 13: [None], 14: [None],
                   15: ["bad_value:reading_timestamp"]}
    at = {r["patient_id"]: r["reading_timestamp"] for r in rows}
    assert (at["J"], at["K"], at["L"]) == (dt.datetime(2024, 1, 30, 4, 30), dt.datetime(2024, 1, 30, 10), dt.datetime(2024, 1, 30))
    n = messages.counts(dec).first()
    assert n["messages_received"] == 16 and n["rows_loaded"] + n["rows_quarantined"] == n["records_decoded"] == 20
