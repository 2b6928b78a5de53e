"""Write-audit-publish batch run, idempotent setup."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import raw_rows
from wardwatch.operators import quality
from wardwatch.operators.upsert import VersionedTable
from wardwatch.plans.pipeline import run_batch
from wardwatch.sources.tables import create_layers

T0 = dt.datetime(2024, 1, 30, 10, 0, 0)


def test_publish_when_checks_pass(spark, workdir):
    raw = raw_rows(spark, [{"patient_id": "PAT-0001"}, {"patient_id": "PAT-0002", "ward": "Cardiology"}])
    table = VersionedTable(spark, workdir)
    run_batch(spark, raw, table, batch=1, as_of=T0)
    out = table.read()
    assert out.count() == 2 and "risk_rank" in out.columns


def test_gate_blocks_publish(spark, workdir):
    table = VersionedTable(spark, workdir)
    run_batch(spark, raw_rows(spark, [{"patient_id": "PAT-0001"}]), table, batch=1, as_of=T0)
    bad = raw_rows(spark, [{"patient_id": "PAT-0001", "ward": "Morgue"}])
    with pytest.raises(quality.QualityGateError):
        run_batch(spark, bad, table, batch=2, as_of=T0)
    assert table.latest() == 1
    assert table.read().first()["ward"] == "ICU" == table.read(1).first()["ward"]
    # once the cause is fixed the same batch publishes, and the old version is still what it was
    run_batch(spark, raw_rows(spark, [{"patient_id": "PAT-0001", "ward": "Cardiology", "reading_timestamp": T0 + dt.timedelta(hours=1)}]),
              table, batch=2, as_of=T0)
    assert table.latest() == 2 and table.read(1).first()["ward"] == "ICU" and table.read().first()["ward"] == "Cardiology"


def test_source_checks_can_be_left_out_of_gate(spark, workdir):
    raw = raw_rows(spark, [{"patient_id": "PAT-0001"}, {"patient_id": None}])
    table = VersionedTable(spark, workdir)
    with pytest.raises(quality.QualityGateError):
        run_batch(spark, raw, table, batch=1, as_of=T0)
    run_batch(spark, raw, table, batch=1, as_of=T0,
              gate_relations=(quality.STAGING, quality.MART))
    assert table.read().count() == 1


def test_create_layers_twice(spark, workdir):
    create_layers(spark, workdir)
    create_layers(spark, workdir)
    cols = spark.table("vitals_raw.raw_patient_vitals").columns
    assert cols[0] == "patient_id" and cols[-3:] == ["kafka_offset", "load_id", "reading_day"]
    raw_rows(spark, [{}]).selectExpr("*", "'one'", "to_date(reading_timestamp)").write.insertInto("vitals_raw.raw_patient_vitals")
    assert spark.table("vitals_raw.raw_patient_vitals").where(F.col("patient_id") == "PAT-0001").count() == 1


def test_time_ranges_prune_reading_days(spark, workdir):
    from wardwatch.operators import marts, staging
    from wardwatch.sources.tables import read_raw, write_raw
    days = [T0 - dt.timedelta(days=d) for d in range(5)]
    write_raw(raw_rows(spark, [{"reading_timestamp": t} for t in days]), f"{workdir}/raw")
    stg = staging.stage(read_raw(spark, f"{workdir}/raw"), carry=("kafka_offset",))
    recent = marts.lookback(stg, T0, hours=24)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "(reading_day" in filters and ">= 2024-01-29" in filters
    assert recent.count() == 2


def test_incremental_run_merges_what_was_loaded_in_the_window(spark, workdir):
    """A reading that arrives days late is merged (and checked) by the run after its arrival."""
    from wardwatch.sources.tables import read_raw, write_raw
    then, now = T0 - dt.timedelta(days=3), T0 - dt.timedelta(minutes=5)
    old = [{"patient_id": p, "reading_timestamp": then, "ingested_at": then, "heart_rate_bpm": h} for p, h in (("PAT-0001", 70), ("PAT-0002", 71))]
    new = [{"patient_id": "PAT-0002", "reading_timestamp": T0 - dt.timedelta(hours=1), "ingested_at": now, "heart_rate_bpm": 90},
           {"patient_id": "PAT-0003", "reading_timestamp": then, "ingested_at": now, "heart_rate_bpm": 72},
           {"patient_id": "PAT-0001", "reading_timestamp": then - dt.timedelta(days=1), "ingested_at": now, "heart_rate_bpm": 60}]
    write_raw(raw_rows(spark, old), f"{workdir}/raw")
    table = VersionedTable(spark, f"{workdir}/mart")
    run_batch(spark, read_raw(spark, f"{workdir}/raw"), table, batch=1, as_of=T0 - dt.timedelta(days=2))
    write_raw(raw_rows(spark, new), f"{workdir}/raw")
    raw = read_raw(spark, f"{workdir}/raw")
    run_batch(spark, raw, table, batch=2, as_of=T0, lookback_hours=24)
    got = {r["patient_id"]: r["current_heart_rate_bpm"] for r in table.read().collect()}
    assert got == {"PAT-0001": 70, "PAT-0002": 90, "PAT-0003": 72}


def test_published_mart_follows_the_schema(spark, workdir):
    table = VersionedTable(spark, workdir)
    run_batch(spark, raw_rows(spark, [{"patient_id": "PAT-0009"}]), table, batch=1, as_of=T0)
    table.publish(table.read().drop("risk_rank").withColumn("gone", F.lit(1)))
    run_batch(spark, raw_rows(spark, [{"patient_id": "PAT-0001"}]), table, batch=2, as_of=T0)
    out = table.read()
    assert "gone" not in out.columns and "risk_rank" in out.columns and out.count() == 2


def test_load_and_publish_the_layers(spark, workdir):
    from wardwatch.operators import marts, staging
    from wardwatch.sources import messages
    from wardwatch.sources.tables import load_tables, publish_tables, read_raw_table
    layers = ("t_raw", "t_staging", "t_marts")
    create_layers(spark, workdir, layers)

    def load(load_id, *days):
        rows = raw_rows(spark, [{"patient_id": "PAT-0001", "reading_timestamp": T0 - dt.timedelta(days=d)} for d in days] + [{"patient_id": None}])
        records = messages.encode(rows).select("value", F.lit(0).alias("partition"), F.lit(1).alias("offset"))
        load_tables(messages.decode(records, stamp=F.lit(T0)), load_id, layers)

    for load_id, *days in (("one", 0, 1), ("two", 1, 3), ("two", 1, 3), ("one", 0, 1)):      # both are run twice
        load(load_id, *days)
    raw = read_raw_table(spark, layers)
    assert raw.count() == 4 and spark.table("t_raw.raw_patient_vitals_quarantine").count() == 2
    staged = staging.stage(raw, carry=("kafka_offset",))
    for _ in range(2):
        publish_tables(staging.stage(raw), marts.health_summary(staged, T0), layers)
    published = spark.table("t_staging.stg_patient_vitals")
    assert published.count() == 4
    assert spark.table("t_marts.mart_patient_health_summary").first()["patient_id"] == "PAT-0001"
    for rows in (marts.in_time_range(published, F.lit(T0 - dt.timedelta(hours=30)), None), marts.lookback(staging.stage(raw), T0, hours=30)):
        assert rows.count() == 3
        filters = rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
        assert "reading_day" in filters and ">= 2024-01-29" in filters


def test_keyed_sink_keeps_readings_without_a_key(spark, workdir):
    from wardwatch.sources.sinks import read_keyed_json, write_keyed_json
    write_keyed_json(raw_rows(spark, [{"patient_id": "PAT-0001"}, {"patient_id": None}]), f"{workdir}/out")
    assert [r["key"] for r in read_keyed_json(spark, f"{workdir}/out").collect()] == ["PAT-0001"]
    assert spark.read.text(f"{workdir}/out_unkeyed").count() == 1
