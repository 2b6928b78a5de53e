"""Registered queries: key -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or data Spark derives from them) in
full. Keys follow the checklist of the design notes; the matching DuckDB
SQL lives in ``oracles.py`` at the repository root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.config import Thresholds
from wardwatch.functions.time import ntz_literal
from wardwatch.operators import enrich, marts, monitoring, quality, staging, upsert
from wardwatch.schemas import MESSAGE_COLUMNS, RAW_COLUMNS
from wardwatch.session import new_work_dir
import monitor_fixtures as fixtures
from wardwatch.sources import messages, sinks, tables
from wardwatch.sources.tables import read_table
from wardwatch.streaming import jobs
from wardwatch.streaming.landing import land, read_landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# past moment replayed by ``patient_health_asof`` (one ward has no reading in its hour at sf0.01)
REPLAY_AS_OF = "2024-01-30 22:30:00"
# non-default thresholds exercised by ``stg_flags_custom``
CUSTOM_THRESHOLDS = Thresholds(hr_high=110, hr_low=50, spo2_critical=88, spo2_low=92, bp_crisis=170)
SILENT_MINUTES = 60
# upsert demo: readings up to this moment form the first batch, later ones the second
UPSERT_SPLIT = "2024-01-15 00:00:00"
# streams: records land in this many time-ordered appends; a micro-batch takes one append
STREAM_CHUNKS = 4
# redelivered records (``stream_dedup``): offsets with this remainder are sent twice
REDELIVER_MODULUS = 7
# late delivery (``stream_ward_hourly_late``): the second append comes last
LATE_ORDER = [0, 2, 3, 1]
# late readings (``stream_late``): loaded more than this many seconds after they were taken
LATE_SECONDS = 30
# the days of staging that ``layer_tables`` reads back
LAYER_SINCE = "2024-01-20 00:00:00"
# one load stamp for a whole batch (``ingest_stamp``)
BATCH_STAMP = "2024-02-01 00:00:00"


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_readings(read_table(spark, sf_dir, "events"))


def staged(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return staging.stage(raw(spark, sf_dir), carry=("kafka_offset",), **kw)


# ---------------------------------------------------------------- step 1: staging
@register("stg_filter")
def q_stg_filter(spark, sf_dir):
    return staging.filter_valid(raw(spark, sf_dir))


@register("stg_clean")
def q_stg_clean(spark, sf_dir):
    return staging.filter_valid(raw(spark, sf_dir)).select(*staging.cleaned_columns(), "kafka_offset")


@register("stg_flags")
def q_stg_flags(spark, sf_dir):
    return staging.filter_valid(raw(spark, sf_dir)).select(
        F.trim("patient_id").alias("patient_id"), *staging.flag_columns(), "kafka_offset")


@register("stg_time")
def q_stg_time(spark, sf_dir):
    return staging.filter_valid(raw(spark, sf_dir)).select(
        F.trim("patient_id").alias("patient_id"), *staging.time_columns(),
        *staging.metadata_columns(), "kafka_offset")


@register("stg_patient_vitals")
def q_stg_patient_vitals(spark, sf_dir):
    return staging.stage(raw(spark, sf_dir))


@register("latest_per_patient")
def q_latest(spark, sf_dir):
    return marts.latest_per_patient(staged(spark, sf_dir))


@register("patient_summary")
def q_patient_summary(spark, sf_dir):
    stg = staged(spark, sf_dir)
    return marts.patient_summary(marts.latest_per_patient(stg), marts.max_reading_time(stg))


# ---------------------------------------------------------------- step 2: marts
@register("ward_hourly")
def q_ward_hourly(spark, sf_dir):
    return marts.ward_hourly(staged(spark, sf_dir))


@register("patient_health_summary")
def q_health_summary(spark, sf_dir):
    stg = staged(spark, sf_dir)
    return marts.health_summary(stg, marts.max_reading_time(stg))


@register("patient_health_asof")
def q_health_asof(spark, sf_dir):
    return marts.health_summary(staged(spark, sf_dir), REPLAY_AS_OF, cut_at_as_of=True)


@register("triage_ranked")
def q_triage(spark, sf_dir):
    return marts.triage_ranked(q_health_summary(spark, sf_dir))


# ---------------------------------------------------------------- step 5 (batch parts)
@register("mart_lookback")
def q_lookback(spark, sf_dir):
    stg = staged(spark, sf_dir)
    as_of = marts.max_reading_time(stg)
    recent = marts.lookback(stg, as_of)
    return marts.patient_summary(marts.latest_per_patient(recent), as_of)


def _summary_batches(spark, sf_dir):
    stg = staged(spark, sf_dir)
    as_of = marts.max_reading_time(stg)
    split = ntz_literal(UPSERT_SPLIT)
    early = marts.patient_summary(marts.latest_per_patient(stg.where(F.col("reading_timestamp") <= split)), as_of)
    late = marts.patient_summary(marts.latest_per_patient(stg.where(F.col("reading_timestamp") > split)), as_of)
    return early, late


@register("mart_upsert")
def q_mart_upsert(spark, sf_dir):
    """Batch 1 (early readings), batch 2 (later ones), then batch 1 again out of order."""
    early, late = _summary_batches(spark, sf_dir)
    table = upsert.VersionedTable(spark, new_work_dir(spark, "mart-upsert"))
    first = table.upsert(early, batch=1)
    table.upsert(late, batch=2)
    table.upsert(table.read(first), batch=3)        # an older redelivery must not replace newer rows
    return table.read()


@register("mart_schema_sync")
def q_mart_schema_sync(spark, sf_dir):
    """The second batch adds ``hospital_id`` and no longer has ``data_source``."""
    early, late = _summary_batches(spark, sf_dir)
    table = upsert.VersionedTable(spark, new_work_dir(spark, "mart-sync"))
    table.upsert(early.withColumn("data_source", F.lit("batch-1")), batch=1)
    table.upsert(late.withColumn("hospital_id", F.lit("HOSP-001")), batch=2)
    return table.read()


@register("stg_flags_custom")
def q_flags_custom(spark, sf_dir):
    return staging.filter_valid(raw(spark, sf_dir)).select(
        F.trim("patient_id").alias("patient_id"), *staging.flag_columns(CUSTOM_THRESHOLDS), "kafka_offset")


@register("silent_monitors")
def q_silent(spark, sf_dir):
    return marts.silent_monitors(q_patient_summary(spark, sf_dir), SILENT_MINUTES)


# ---------------------------------------------------------------- step 3: ingest
def decoded(spark: SparkSession, sf_dir: str, stamp=None) -> DataFrame:
    envs = fixtures.envelopes(raw(spark, sf_dir), faults=True)
    return messages.decode(envs, stamp=F.col("timestamp") if stamp is None else stamp)


@register("ingest_decode")
def q_ingest_decode(spark, sf_dir):
    return messages.loaded(decoded(spark, sf_dir)).select(*MESSAGE_COLUMNS, "kafka_offset")


@register("ingest_explode_array")
def q_ingest_explode(spark, sf_dir):
    envs = fixtures.array_envelopes(raw(spark, sf_dir))
    return messages.loaded(messages.decode(envs, stamp=F.col("timestamp"))).select(*MESSAGE_COLUMNS, "kafka_offset")


@register("ingest_array_quarantine")
def q_ingest_array_quarantine(spark, sf_dir):
    envs = fixtures.array_envelopes(raw(spark, sf_dir))
    return (messages.quarantined(messages.decode(envs, stamp=F.col("timestamp")))
            .select("reason", "kafka_offset"))


@register("ingest_utf8")
def q_ingest_utf8(spark, sf_dir):
    envs = fixtures.binary_envelopes(raw(spark, sf_dir))
    dec = messages.loaded(messages.decode(envs, stamp=F.col("timestamp")))
    return dec.select("kafka_offset", "patient_name",
                      F.col("patient_name").contains("\ufffd").alias("name_repaired"))


@register("ingest_quarantine")
def q_ingest_quarantine(spark, sf_dir):
    return messages.quarantined(decoded(spark, sf_dir)).select(
        "reason", "ingested_at", "kafka_partition", "kafka_offset")


@register("ingest_stamp")
def q_ingest_stamp(spark, sf_dir):
    dec = decoded(spark, sf_dir, stamp=ntz_literal(BATCH_STAMP))
    return messages.loaded(dec).select("patient_id", "ingested_at", "kafka_partition", "kafka_offset")


@register("ingest_counts")
def q_ingest_counts(spark, sf_dir):
    return messages.counts(decoded(spark, sf_dir))


@register("ingest_utf8_counts")
def q_ingest_utf8_counts(spark, sf_dir):
    return messages.utf8_counts(fixtures.binary_envelopes(raw(spark, sf_dir)))


@register("layer_tables")
def q_layer_tables(spark, sf_dir):
    """Two loads into catalog tables, the second run twice; staging and mart published; the last days of staging read by name."""
    work = new_work_dir(spark, "layers")
    layers = tuple(f"{name}_{work.rsplit('-', 1)[1]}" for name in tables.LAYERS)
    tables.create_layers(spark, work, layers)
    records, split = fixtures.envelopes(raw(spark, sf_dir), faults=True), ntz_literal(UPSERT_SPLIT)
    early = F.col("timestamp") <= split
    for load_id, some in (("early", early), ("late", ~early), ("late", ~early)):
        tables.load_tables(messages.decode(records.where(some), stamp=F.col("timestamp")), load_id, layers)
    stg = staging.stage(tables.read_raw_table(spark, layers), carry=("kafka_offset",))
    tables.publish_tables(stg, marts.health_summary(stg, marts.max_reading_time(stg)), layers)
    published = spark.table(f"{layers[1]}.{tables.STAGING_TABLE}")
    recent = marts.in_time_range(published, ntz_literal(LAYER_SINCE), None)
    mart = spark.table(f"{layers[2]}.{tables.MART_TABLE}").select("patient_id", "patient_risk_level", "last_reading_at")
    return (recent.select("patient_id", "ward", "reading_timestamp", "has_alert", "kafka_offset")
            .join(mart, "patient_id"))


@register("enrich_registry")
def q_enrich(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return enrich.enrich(fixtures.monitor_readings(events), fixtures.registry(events))


@register("sink_keyed_json")
def q_sink(spark, sf_dir):
    path = new_work_dir(spark, "keyed-json")
    sinks.write_keyed_json(raw(spark, sf_dir), path)
    return sinks.read_keyed_json(spark, path)


# ---------------------------------------------------------------- step 6: streaming
def _landed(spark, sf_dir, name, order=None, redeliver_mod=None):
    """Land the fixture records in a fresh shared folder; return it and a stream over it."""
    work = new_work_dir(spark, name)
    recs = fixtures.envelopes(raw(spark, sf_dir), faults=True)
    again = recs.where(F.col("offset") % redeliver_mod == 0) if redeliver_mod else None
    _, files = land(recs, f"{work}/landing", STREAM_CHUNKS, order=order, redeliver=again)
    return work, read_landing(spark, f"{work}/landing", files)


SOURCE_STAMP = "timestamp"     # streams stamp rows with the record time -> comparable with batch


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    work, src = _landed(spark, sf_dir, "stream-ingest")
    jobs.run_to_end(jobs.start_ingest(src, f"{work}/raw", f"{work}/quarantine", f"{work}/checkpoint",
                                      stamp=F.col(SOURCE_STAMP), log_path=f"{work}/load_log"))
    return jobs.read_raw(spark, f"{work}/raw").select(*RAW_COLUMNS)


@register("ingest_file_position")
def q_ingest_file_position(spark, sf_dir):
    """Messages as files, a folder for each sender; every row knows its file. The folder of the file stands for it here."""
    from wardwatch.streaming.landing import read_message_files, start_file_load
    work = new_work_dir(spark, "message-files")
    sent = fixtures.envelopes(raw(spark, sf_dir), faults=True)
    sent.select("value", F.concat(F.lit("sender-"), "partition").alias("sender")).write.partitionBy("sender").text(f"{work}/landing")
    files = read_message_files(spark, f"{work}/landing/*", f"{work}/archive")
    jobs.run_to_end(start_file_load(files, f"{work}/raw", f"{work}/checkpoint", stamp=ntz_literal(BATCH_STAMP)))
    folder = F.regexp_extract("source_file", "sender=([^/]+)/[^/]+$", 1).alias("sender")
    return jobs.read_batches(spark, f"{work}/raw").select("patient_id", "reading_timestamp", "heart_rate_bpm", folder, "source_block")


@register("stream_staging")
def q_stream_staging(spark, sf_dir):
    work, src = _landed(spark, sf_dir, "stream-staging")
    jobs.run_to_end(jobs.start_staging(src, f"{work}/stg", f"{work}/checkpoint", stamp=F.col(SOURCE_STAMP)))
    return jobs.read_batches(spark, f"{work}/stg")


@register("stream_staging_quarantine")
def q_stream_staging_quarantine(spark, sf_dir):
    """The other side of ``stream_staging``: what the same stream could not load."""
    work, src = _landed(spark, sf_dir, "stream-staging")
    jobs.run_to_end(jobs.start_staging(src, f"{work}/stg", f"{work}/checkpoint", stamp=F.col(SOURCE_STAMP)))
    return (jobs.read_batches(spark, f"{work}/stg_quarantine")
            .select("reason", "ingested_at", "kafka_partition", "kafka_offset"))


def _stream_ward_hourly(spark, sf_dir, order=None):
    work, src = _landed(spark, sf_dir, "stream-ward-hourly", order=order)
    jobs.run_to_end(jobs.start_ward_hourly(src, f"{work}/ward_hourly", f"{work}/checkpoint", stamp=F.col(SOURCE_STAMP),
                                           compact_every=2))
    return jobs.read_ward_hourly(spark, f"{work}/ward_hourly")


@register("stream_ward_hourly")
def q_stream_ward_hourly(spark, sf_dir):
    return _stream_ward_hourly(spark, sf_dir)


@register("stream_ward_hourly_late")
def q_stream_ward_hourly_late(spark, sf_dir):
    """A quarter of the records comes last, days late."""
    return _stream_ward_hourly(spark, sf_dir, LATE_ORDER)


@register("stream_latest")
def q_stream_latest(spark, sf_dir):
    work, src = _landed(spark, sf_dir, "stream-latest")
    jobs.run_to_end(jobs.start_latest(src, f"{work}/mart", f"{work}/checkpoint", stamp=F.col(SOURCE_STAMP), compact_every=3))
    latest = jobs.latest_table(spark, f"{work}/mart").read()
    return jobs.summary_from_latest(latest, marts.max_reading_time(latest))


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    work, src = _landed(spark, sf_dir, "stream-dedup", redeliver_mod=REDELIVER_MODULUS)
    jobs.run_to_end(jobs.start_dedup(src, f"{work}/dedup", f"{work}/checkpoint", stamp=F.col(SOURCE_STAMP)))
    return jobs.read_batches(spark, f"{work}/dedup").drop("kafka_partition", "reading_day")


# lost records (``stream_offset_gaps``): this stretch of every so many offsets of a partition, and a block's worth once
LOST_MODULUS, LOST_FROM, LOST_TO = 300, 40, 46


@register("stream_offset_gaps")
def q_stream_offset_gaps(spark, sf_dir):
    """Records with dense offsets in three partitions, of which some are lost, some sent twice, some late."""
    work = new_work_dir(spark, "stream-offsets")
    event = F.col("event_id")
    recs = read_table(spark, sf_dir, "events").select(
        F.lit(None).cast("string").alias("key"), F.lit("{}").alias("value"), (event % 3).cast("int").alias("partition"),
        F.floor(event / 3).alias("offset"), F.col("ts").alias("timestamp"))
    here = recs.where(~(F.col("offset") % LOST_MODULUS).between(LOST_FROM, LOST_TO))
    _, files = land(here, f"{work}/landing", STREAM_CHUNKS, order=LATE_ORDER, redeliver=here.where(F.col("offset") % REDELIVER_MODULUS == 0))
    jobs.run_to_end(jobs.start_offset_log(read_landing(spark, f"{work}/landing", files), f"{work}/received", f"{work}/checkpoint",
                                          compact_every=2))
    return jobs.offset_gaps(spark, f"{work}/received")


# the registry of ``stream_enrich``: users that are registered from the start, and between two runs; others never are
REGISTERED_LATER, NEVER_REGISTERED = 3, 7


def _stream_enrich(spark, sf_dir) -> str:
    from wardwatch.streaming.enrichment import current_registry, start_enrich
    work = new_work_dir(spark, "stream-enrich")
    events = read_table(spark, sf_dir, "events")
    user = F.col("user_id")
    later = user % REGISTERED_LATER == 0
    readings, split = fixtures.monitor_readings(events), ntz_literal(UPSERT_SPLIT)
    now = F.col("reading_timestamp") <= split
    for some, known in ((now, ~later), (~now, later & (user % NEVER_REGISTERED != 0))):
        fixtures.registry(events.where(known)).write.mode("append").parquet(f"{work}/registry")
        readings.where(some).write.mode("append").parquet(f"{work}/readings")
        src = spark.readStream.schema(readings.schema).parquet(f"{work}/readings")
        jobs.run_to_end(start_enrich(src, lambda s: current_registry(s, f"{work}/registry"), f"{work}/messages", f"{work}/checkpoint"))
    return f"{work}/messages"


@register("stream_progress")
def q_stream_progress(spark, sf_dir):
    """Load counts and failing rows of the staging checks, observed by the batches that wrote the rows, over all batches."""
    from wardwatch.streaming import progress
    work, src = _landed(spark, sf_dir, "stream-progress")
    log = progress.ProgressLog(spark, f"{work}/progress", work)
    spark.streams.addListener(log)
    try:
        query = progress.start_observed_staging(src, f"{work}/stg", f"{work}/checkpoint", work, stamp=F.col(SOURCE_STAMP))
        jobs.run_to_end(query)
        log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    return progress.totals(progress.read_progress(spark, f"{work}/progress"))


@register("stream_enrich")
def q_stream_enrich(spark, sf_dir):
    """Half of the readings come before a third of the patients is registered; those are matched by the next batch."""
    from wardwatch.streaming.enrichment import read_enriched
    return read_enriched(spark, _stream_enrich(spark, sf_dir))


@register("stream_enrich_waiting")
def q_stream_enrich_waiting(spark, sf_dir):
    """The other side of ``stream_enrich``: readings of patients that nobody has registered."""
    from wardwatch.streaming.enrichment import read_waiting
    return read_waiting(spark, _stream_enrich(spark, sf_dir))


@register("stream_silent_timers")
def q_stream_silent_timers(spark, sf_dir):
    """Alerts raised by timers, the clock standing at the newest reading when the stream starts."""
    from wardwatch.streaming import timers
    beside = timers.timer_session(spark, drain=True)
    work, _ = _landed(spark, sf_dir, "stream-silent-timers", order=LATE_ORDER)
    as_of = marts.max_reading_time(jobs.loaded_stream(fixtures.envelopes(raw(spark, sf_dir), faults=True)))
    src = read_landing(beside, f"{work}/landing")
    jobs.run_to_end(timers.start_silence(src, f"{work}/events", f"{work}/checkpoint", SILENT_MINUTES * 60, as_of,
                                         stamp=F.col(SOURCE_STAMP), available_now=True))
    return timers.silent_now(spark.read.parquet(f"{work}/events"), as_of, SILENT_MINUTES)


@register("stream_silent_monitors")
def q_stream_silent(spark, sf_dir):
    from wardwatch.streaming.silent import start_silent
    work, src = _landed(spark, sf_dir, "stream-silent")
    jobs.run_to_end(start_silent(src, f"{work}/alerts", f"{work}/checkpoint", SILENT_MINUTES,
                                 stamp=F.col(SOURCE_STAMP)))
    return spark.read.parquet(f"{work}/alerts")


@register("stream_late")
def q_stream_late(spark, sf_dir):
    work, src = _landed(spark, sf_dir, "stream-late")
    jobs.run_to_end(jobs.start_late(src, f"{work}/late", f"{work}/checkpoint", LATE_SECONDS, stamp=F.col(SOURCE_STAMP)))
    return jobs.read_batches(spark, f"{work}/late")


# ---------------------------------------------------------------- step 4: quality, monitoring
def mart_of(readings: DataFrame) -> DataFrame:
    stg = staging.stage(readings, carry=("kafka_offset",))
    return marts.health_summary(stg, marts.max_reading_time(stg))


def _dq(spark, sf_dir, tests: tuple[str, ...]):
    checks = [c for c in quality.default_checks() if c.test in tests]
    of_mart = any(c.relation == quality.MART for c in checks)
    readings = raw(spark, sf_dir)
    return quality.report(readings, mart_of(readings) if of_mart else None, checks)


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    return _dq(spark, sf_dir, ("not_null",))


@register("dq_accepted_values")
def q_dq_accepted(spark, sf_dir):
    return _dq(spark, sf_dir, ("accepted_values",))


@register("dq_unique")
def q_dq_unique(spark, sf_dir):
    return _dq(spark, sf_dir, ("unique",))


@register("dq_range")
def q_dq_range(spark, sf_dir):
    return _dq(spark, sf_dir, ("range",))


@register("dq_report")
def q_dq_report(spark, sf_dir):
    return _dq(spark, sf_dir, quality.TESTS)


@register("mon_load")
def q_mon_load(spark, sf_dir):
    return monitoring.load_status(raw(spark, sf_dir))


@register("mon_lag")
def q_mon_lag(spark, sf_dir):
    return monitoring.ingest_lag(raw(spark, sf_dir), monitoring.LAST_INGEST)


@register("mon_latest20")
def q_mon_latest20(spark, sf_dir):
    return monitoring.latest_readings(raw(spark, sf_dir), 20)


@register("mon_abnormal")
def q_mon_abnormal(spark, sf_dir):
    return monitoring.abnormal_readings(raw(spark, sf_dir))

