"""Streaming jobs: ingest, staging, ward-hour rollup, current row, dedup, late readings.

All jobs read topic records and write in ``foreachBatch``, by one shared
writer: a micro-batch is decoded once, its good rows go to the job, its bad
records to the job's quarantine. Every output of a batch is a folder named by
the stream and the batch number, so a replayed batch replaces its own rows and
nothing else. No job drops a row for being late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardwatch.config import DEFAULT_THRESHOLDS, Thresholds
from wardwatch.operators import marts, offsets, quality, staging
from wardwatch.operators.upsert import MergedTable, newest_by_key
from wardwatch.sources import messages, tables
from wardwatch.sources.tables import PARTITION_COLUMN, with_reading_day


def with_trigger(writer, available_now: bool = True, processing_time: str = "30 seconds"):
    """``availableNow`` (drain what is there, then stop) or a processing-time timer."""
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query to drain and stop; re-raise its failure."""
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    return query


def loaded_stream(records: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Records -> rows that load (raw table layout); the caller keeps the others, see :func:`batch_writer`."""
    return messages.loaded(messages.decode(records, stamp=stamp))


def staged_stream(records: DataFrame, stamp: Column | None = None,
                  th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Records -> staging rows (+ ``kafka_offset``), stateless; the caller keeps the bad records."""
    return staging.stage(loaded_stream(records, stamp), th, carry=("kafka_offset",))


def source_of(batch: DataFrame) -> str:
    """The id of the query that runs this micro-batch; it lives as long as the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def batch_folder(path: str, source: str, batch_id: int) -> str:
    return f"{path}/source={source}/batch_id={batch_id}"


def batch_writer(job: Callable[[DataFrame, str, int], None], quarantine_path: str, stamp: Column | None = None,
                 log_path: str | None = None, carry: tuple[str, ...] = (),
                 most_repaired_pct: float | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: decode once, hand the rows that load to ``job(rows, source, batch id)``,
    keep the bad records under ``quarantine_path`` and, with ``log_path``, the batch's load counts.

    With ``most_repaired_pct`` a batch in which a source partition has a greater share of records that are not valid
    UTF-8 raises :class:`messages.EncodingError` before anything is written."""
    def write(batch: DataFrame, batch_id: int) -> None:
        source = source_of(batch)
        if most_repaired_pct is not None:
            messages.enforce_utf8(messages.utf8_counts(batch), most_repaired_pct)
        dec = messages.decode(batch, stamp=stamp, carry=carry).persist()
        try:
            job(messages.loaded(dec, carry), source, batch_id)
            messages.quarantined(dec, carry).write.mode("overwrite").parquet(batch_folder(quarantine_path, source, batch_id))
            if log_path:
                messages.counts(dec).write.mode("overwrite").parquet(batch_folder(log_path, source, batch_id))
        finally:
            dec.unpersist()
    return write


def start(records: DataFrame, job: Callable[[DataFrame, str, int], None], path: str, checkpoint: str,
          stamp: Column | None = None, quarantine_path: str | None = None, log_path: str | None = None,
          available_now: bool = True, processing_time: str = "30 seconds") -> StreamingQuery:
    """Run ``job`` on every micro-batch; bad records go to ``quarantine_path`` (default: beside ``path``)."""
    body = batch_writer(job, quarantine_path or f"{path}_quarantine", stamp, log_path)
    w = records.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return with_trigger(w, available_now, processing_time).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows that a job's batches hold."""
    return spark.read.parquet(path).drop("source", "batch_id")


# ---------------------------------------------------------------- ingest with quarantine
def raw_job(raw_path: str) -> Callable[[DataFrame, str, int], None]:
    """Append the rows that load, laid out by reading day."""
    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        (with_reading_day(rows).write.mode("overwrite").partitionBy(PARTITION_COLUMN)
         .parquet(batch_folder(raw_path, source, batch_id)))
    return job


def ingest_batch_writer(raw_path: str, quarantine_path: str, stamp: Column | None = None,
                        log_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of :func:`start_ingest`."""
    return batch_writer(raw_job(raw_path), quarantine_path, stamp, log_path)


def start_ingest(records: DataFrame, raw_path: str, quarantine_path: str, checkpoint: str,
                 stamp: Column | None = None, available_now: bool = True,
                 processing_time: str = "30 seconds", log_path: str | None = None) -> StreamingQuery:
    """Load records into the raw table; drain and stop (``availableNow``) or run on a timer.

    A timer trigger with the source's ``maxOffsetsPerTrigger`` /
    ``maxFilesPerTrigger`` replaces the size-or-timeout batching of a
    hand-written consumer loop.
    """
    return start(records, raw_job(raw_path), raw_path, checkpoint, stamp, quarantine_path, log_path,
                 available_now, processing_time)


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """The streamed raw table, ``reading_day`` kept, so that time ranges prune folders."""
    return tables.read_raw(spark, raw_path).drop("source", "batch_id")


def compact_raw(spark: SparkSession, raw_path: str, to_path: str, files_per_day: int = 1) -> None:
    """Rewrite a streamed raw table into a new one of few files for each reading day.

    The old folder stays as it is; point readers and the stream at the new one between two runs.
    """
    rows = read_raw(spark, raw_path)
    part = F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(files_per_day))
    (rows.repartition(PARTITION_COLUMN, part).write.partitionBy(PARTITION_COLUMN)
     .parquet(batch_folder(to_path, "compacted", 0)))


# ---------------------------------------------------------------- staging
def staging_job(path: str, gate: bool = False, th: Thresholds = DEFAULT_THRESHOLDS) -> Callable[[DataFrame, str, int], None]:
    """Stage a micro-batch and write it with its check counts under ``<path>_checks``.

    With ``gate`` an error-level failure raises
    :class:`quality.QualityGateError` before anything is written: the query
    stops, and a restart replays the batch once the cause is fixed. The
    checks and the write share one staged, persisted batch.
    """
    checks = [c for c in quality.default_checks() if c.relation == quality.STAGING]

    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        staged = staging.stage(rows, th, carry=("kafka_offset",)).persist()
        try:
            report = quality.evaluate(staged, checks)
            if gate:
                quality.enforce(report)
            staged.write.mode("overwrite").parquet(batch_folder(path, source, batch_id))
            report.write.mode("overwrite").parquet(batch_folder(f"{path}_checks", source, batch_id))
        finally:
            staged.unpersist()
    return job


def start_staging(records: DataFrame, path: str, checkpoint: str, stamp: Column | None = None,
                  gate: bool = False, available_now: bool = True, processing_time: str = "30 seconds",
                  quarantine_path: str | None = None) -> StreamingQuery:
    """Continuous cleaning with the staging quality checks, counted (or enforced) per micro-batch."""
    return start(records, staging_job(path, gate), path, checkpoint, stamp, quarantine_path,
                 available_now=available_now, processing_time=processing_time)


# ---------------------------------------------------------------- ward x hour rollup
# A micro-batch writes sums per (ward, hour, bucket of patients) of its own rows, and the
# bucket's patients as a bitmap; the ward-hour view adds up and unites when read. No state and no watermark: a reading
# counts whenever it comes, and the current hour is there at once.
def ward_hours(spark: SparkSession, path: str, compact_every: int | None = 50) -> MergedTable:
    """The sums and patient sets per (ward, hour, bucket) that the stream has written."""
    return MergedTable(spark, path, marts.merge_ward_partials, compact_every)


def start_ward_hourly(records: DataFrame, path: str, checkpoint: str, stamp: Column | None = None,
                      available_now: bool = True, processing_time: str = "30 seconds",
                      quarantine_path: str | None = None, compact_every: int | None = 50) -> StreamingQuery:
    table = ward_hours(records.sparkSession, path, compact_every)

    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        table.add(marts.ward_partials(staging.stage(rows)), source, batch_id)

    return start(records, job, path, checkpoint, stamp, quarantine_path,
                 available_now=available_now, processing_time=processing_time)


def read_ward_hourly(spark: SparkSession, path: str) -> DataFrame:
    """The ward-hour figures of every reading written so far, open hours included."""
    return marts.ward_hourly_of(ward_hours(spark, path).read())


# ---------------------------------------------------------------- current row per patient
# Each micro-batch writes its newest reading per patient; the newest of those
# is the current row. Compaction folds batches into a snapshot.
LATEST_ORDER = ("reading_timestamp", "kafka_offset")


def latest_table(spark: SparkSession, path: str, compact_every: int | None = 50) -> MergedTable:
    """The current rows that the stream has written."""
    return MergedTable(spark, path, lambda rows: newest_by_key(rows, "patient_id", LATEST_ORDER), compact_every)


def start_latest(records: DataFrame, path: str, checkpoint: str, stamp: Column | None = None,
                 available_now: bool = True, processing_time: str = "30 seconds",
                 quarantine_path: str | None = None, compact_every: int | None = 50,
                 th: Thresholds = DEFAULT_THRESHOLDS) -> StreamingQuery:
    """Keep the newest reading of each patient; a trigger writes only the patients it heard from."""
    table = latest_table(records.sparkSession, path, compact_every)

    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        staged = staging.stage(rows, th, carry=("kafka_offset",))
        table.add(marts.latest_per_patient(staged, keep=("kafka_offset",)), source, batch_id)

    return start(records, job, path, checkpoint, stamp, quarantine_path,
                 available_now=available_now, processing_time=processing_time)


def summary_from_latest(latest: DataFrame, as_of=None, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Patient summary from the streamed current rows as of ``as_of`` (default: the session clock)."""
    return marts.patient_summary(latest.select(*marts.LATEST_COLUMNS), as_of, th)


# ---------------------------------------------------------------- source positions: redelivery, loss
def received_intervals(spark: SparkSession, path: str, compact_every: int | None = 50) -> MergedTable:
    """The intervals of source positions that a stream has received, whether the records load or not."""
    return MergedTable(spark, path, offsets.merge_intervals, compact_every)


def first_delivery_writer(body: Callable[[DataFrame, int], None], intervals: MergedTable) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that hands ``body`` only the records whose source position was not received before.

    What was received is known by intervals of offsets, a row for each block of a stream without gaps: no row of the
    stream's output is read. A record sent again is known by its position, however late it comes; a first delivery
    is never dropped. The batch's own positions are written when ``body`` is done, so that a replay finds what
    it found the first time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        source = source_of(batch)
        batch = batch.persist()
        try:
            known = intervals.read_before(source, batch_id)
            body(offsets.first_deliveries(batch, known, "partition", "offset"), batch_id)
            intervals.add(offsets.islands(positions_of(batch)), source, batch_id)
        finally:
            batch.unpersist()
    return write


def positions_of(records: DataFrame) -> DataFrame:
    """The source positions of topic records."""
    return records.select(F.col("partition").cast("int").alias("kafka_partition"), F.col("offset").cast("long").alias("kafka_offset"))


def deduplicated_job(path: str) -> Callable[[DataFrame, str, int], None]:
    """Write the staged rows of first deliveries by reading day."""
    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        staged = (staging.stage(rows, carry=offsets.POSITION).withColumn(PARTITION_COLUMN, F.to_date("reading_timestamp")))
        staged.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(batch_folder(path, source, batch_id))
    return job


def start_dedup(records: DataFrame, path: str, checkpoint: str, stamp: Column | None = None,
                available_now: bool = True, processing_time: str = "30 seconds",
                quarantine_path: str | None = None, compact_every: int | None = 50) -> StreamingQuery:
    """Staged readings of the first delivery of each source position; ``<path>_received`` holds what was received."""
    body = first_delivery_writer(batch_writer(deduplicated_job(path), quarantine_path or f"{path}_quarantine", stamp),
                                 received_intervals(records.sparkSession, f"{path}_received", compact_every))
    w = records.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return with_trigger(w, available_now, processing_time).start()


def start_offset_log(records: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                     processing_time: str = "30 seconds", compact_every: int | None = 50) -> StreamingQuery:
    """Keep the intervals of received source positions, for :func:`offset_gaps` of a source whose readings go elsewhere."""
    table = received_intervals(records.sparkSession, path, compact_every)

    def body(batch: DataFrame, batch_id: int) -> None:
        table.add(offsets.islands(positions_of(batch)), source_of(batch), batch_id)

    w = records.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return with_trigger(w, available_now, processing_time).start()


def offset_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Offsets that a stream has not received though later ones of their partition came: lost, or still under way."""
    return offsets.gaps(received_intervals(spark, path).read())


# ---------------------------------------------------------------- late readings
def late_readings(staged: DataFrame, delay_seconds: int = 3600) -> DataFrame:
    """Readings that were loaded more than ``delay_seconds`` after they were taken.

    Lateness is a property of the row (reading time against load time), so
    the list does not depend on how arrivals are cut into batches.
    """
    late = F.col("ingested_at") > F.col("reading_timestamp") + F.make_dt_interval(secs=F.lit(delay_seconds))
    return staged.where(late).select("patient_id", "ward", "reading_timestamp", "ingested_at", "kafka_offset")


def start_late(records: DataFrame, late_path: str, checkpoint: str, delay_seconds: int = 3600,
               stamp: Column | None = None, available_now: bool = True, processing_time: str = "30 seconds",
               quarantine_path: str | None = None) -> StreamingQuery:
    """Side-list late readings."""
    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        late = late_readings(staging.stage(rows, carry=("kafka_offset",)), delay_seconds)
        late.write.mode("overwrite").parquet(batch_folder(late_path, source, batch_id))

    return start(records, job, late_path, checkpoint, stamp, quarantine_path,
                 available_now=available_now, processing_time=processing_time)
