"""Landing-file source: topic records as JSON lines in a shared folder.

Stands in for the topic when no broker is reachable: each line holds one
record in the Kafka source layout (``key``, ``value``, ``partition``,
``offset``, ``timestamp``), so the same decode function serves both. Files
are picked up once each, oldest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.schemas import ENVELOPE_SCHEMA

JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


ROWS_PER_FILE = 1_000_000


def land(records: DataFrame, landing_dir: str, chunks: int = 4, files_per_chunk: int | None = None,
         order: list[int] | None = None, redeliver: DataFrame | None = None) -> tuple[int, int]:
    """Write ``records`` in ``chunks`` appends by time range, as they would arrive.

    Each chunk is its own write job, so its files are newer than those of
    the chunks before it and a file source reads them in that order.
    ``order`` permutes the chunks (to deliver some late); ``redeliver`` is
    appended last, as records sent again after a consumer restart. A chunk has
    as many files as its rows need. Returns the number of appends and of
    files in each. One scalar job finds the time span and the row count.
    """
    span = records.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count("*").alias("n")).first()
    files = files_per_chunk or max(2, -(-span["n"] // (chunks * ROWS_PER_FILE)))
    if span["lo"] is None:
        return 0, files
    lo, hi = span["lo"], span["hi"]
    width = max((hi - lo).total_seconds() / chunks, 1e-6)
    secs = F.timestamp_diff("MICROSECOND", F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz"),
                            F.col("timestamp")) / 1e6
    chunk = F.least(F.floor(secs / width), F.lit(chunks - 1))
    tagged = records.withColumn("_chunk", chunk)
    for k in (order or list(range(chunks))):
        (tagged.where(F.col("_chunk") == k).drop("_chunk")
         .repartition(files)
         .write.mode("append").options(**JSON_OPTIONS).json(landing_dir))
    if redeliver is not None:
        redeliver.repartition(files).write.mode("append").options(**JSON_OPTIONS).json(landing_dir)
        return chunks + 1, files
    return chunks, files


def read_landing(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of landed records (explicit schema, never inferred)."""
    r = spark.readStream.schema(ENVELOPE_SCHEMA).options(**JSON_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(landing_dir)


# where a record of a landed file was read: the file, and the place in it at which the part that a task read begins
FILE_POSITION = ("source_file", "source_block")


def read_message_files(spark: SparkSession, landing_dir: str, archive_dir: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of message files (a JSON message a line, as a stage delivers them), with their position.

    The files carry no topic position: ``partition`` and ``offset`` are NULL, and the file stands in for them
    (``source_file``, ``source_block``, from the source's hidden metadata). With ``archive_dir`` a file that a
    committed batch has read is moved there, so that the folder lists only what is still to come.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.text(landing_dir).select(
        "value", F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset"),
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_block"))


def start_file_load(files: DataFrame, path: str, checkpoint: str, stamp=None, available_now: bool = True,
                    processing_time: str = "30 seconds"):
    """Load a stream of :func:`read_message_files`: raw rows below ``path``, bad records beside it, both with their file."""
    from wardwatch.streaming import jobs

    def job(rows: DataFrame, source: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(jobs.batch_folder(path, source, batch_id))

    body = jobs.batch_writer(job, f"{path}_quarantine", stamp, carry=FILE_POSITION)
    w = files.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return jobs.with_trigger(w, available_now, processing_time).start()
