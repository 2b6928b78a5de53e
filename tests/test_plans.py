"""Physical-plan properties the design relies on at scale."""

import re

import pytest

import monitor_queries as C
from wardwatch.operators import marts, monitoring, quality, staging
from wardwatch.sources.tables import read_raw, write_raw

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_reduces_before_the_shuffle(spark):
    p = plan(marts.latest_per_patient(C.staged(spark, SF)))
    exchange = p.index("Exchange hashpartitioning(patient_id")
    assert "WindowGroupLimit" in p[exchange:], "partial limit must sit below the exchange"
    assert p.count("Exchange") == 1


def test_ward_context_is_broadcast_patients_not_shuffled_by_ward(spark):
    stg = C.staged(spark, SF)
    p = plan(marts.health_summary(stg, marts.max_reading_time(stg)))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert not re.search(r"Exchange hashpartitioning\(ward#\d+, \d+\)", p.split("BroadcastExchange")[0])


def test_ward_hourly_aggregates_partially_before_each_shuffle(spark):
    p = plan(marts.ward_hourly(C.staged(spark, SF)))
    assert p.count("Exchange hashpartitioning") == 2
    assert "partial_count" in p


def test_mart_unique_check_reuses_patient_partitioning(spark):
    stg = C.staged(spark, SF)
    mart = marts.health_summary(stg, marts.max_reading_time(stg))
    checks = [c for c in quality.default_checks() if c.relation == quality.MART]
    p = plan(quality.evaluate(mart, checks))
    assert len(re.findall(r"Exchange hashpartitioning\(patient_id", p)) == 1   # the window's only


def test_source_and_staging_checks_share_one_scan(spark):
    rep = quality.report(C.raw(spark, SF), None)
    assert plan(rep).count("FileScan parquet") == 1


def test_latest20_is_a_top_k(spark):
    p = plan(monitoring.latest_readings(C.raw(spark, SF), 20))
    assert "TakeOrderedAndProject" in p and "Exchange rangepartitioning" not in p


def test_scan_prunes_columns_and_pushes_filters(spark, workdir):
    write_raw(C.raw(spark, SF), f"{workdir}/raw")
    stg = staging.stage(read_raw(spark, f"{workdir}/raw"))
    p = plan(stg.select("patient_id", "ward"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"patient_id", "ward", "reading_timestamp"}
    assert "IsNotNull(patient_id)" in p and "IsNotNull(reading_timestamp)" in p


def test_no_python_udfs_in_batch_plans(spark):
    for key in ("stg_patient_vitals", "ward_hourly", "dq_report", "ingest_decode"):
        p = plan(C.QUERIES[key](spark, SF))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, key


def test_enrichment_beyond_the_broadcast_size_same_rows(spark):
    """Beyond Spark's byte limit the join is a shuffle join, with the same result."""
    from wardwatch.operators import enrich
    import monitor_fixtures as fixtures
    from wardwatch.sources.tables import read_table
    events = read_table(spark, SF, "events")
    small = enrich.enrich(fixtures.monitor_readings(events), fixtures.registry(events))
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = enrich.enrich(fixtures.monitor_readings(events), fixtures.registry(events))
        p = plan(big)
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_ward_context_beyond_the_broadcast_size(spark):
    stg = C.staged(spark, SF)
    as_of = marts.max_reading_time(stg)
    want = sorted(map(tuple, marts.health_summary(stg, as_of).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = marts.health_summary(stg, as_of)
        assert "SortMergeJoin" in plan(df)
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_batch_queries_run_at_most_one_job_before_their_own(spark):
    """Building a query may read one scalar (the newest reading time), nothing more."""
    sc = spark.sparkContext
    for key in ("stg_patient_vitals", "latest_per_patient", "ward_hourly", "patient_health_summary", "patient_health_asof",
                "triage_ranked", "enrich_registry", "dq_range", "dq_report", "ingest_decode", "mon_abnormal"):
        sc.setJobGroup(f"build-{key}", key)
        C.QUERIES[key](spark, SF)
        scalar = 1 if key in ("patient_health_summary", "triage_ranked", "dq_report") else 0
        # one job reads the parquet footer for the schema; a scalar is one job, or two where
        # adaptive execution runs its shuffle as a job of its own
        assert len(sc.statusTracker().getJobIdsForGroup(f"build-{key}")) <= 1 + 2 * scalar, key
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_queries_change_no_setting(spark):
    before = dict(spark.conf.getAll)
    C.QUERIES["patient_health_summary"](spark, SF).collect()
    assert dict(spark.conf.getAll) == before
