"""Enrichment of a stream of readings with a registry that grows while the stream runs.

A micro-batch joins its readings, and those that are still waiting, with the
registry as it is at that moment. Readings whose patient has no entry wait, and are
joined again by every later batch until the patient is registered. The join is written
once, matched and waiting rows side by side in the folder of the batch, so
that a reading is always in exactly one of the two, also if the registry changes
between two tries of a batch. The readings that wait after a batch are all that the
next one reads of earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardwatch.operators.enrich import REGISTRY_COLUMNS, message_columns
from wardwatch.operators.upsert import newest_by_key, read_if_there
from wardwatch.schemas import MESSAGE_COLUMNS
from wardwatch.streaming import jobs


def current_registry(spark: SparkSession, path: str, order: str | None = None) -> DataFrame:
    """The registry's files as they are now; with ``order`` the newest entry of each patient."""
    entries = spark.read.parquet(path)
    return entries if order is None else newest_by_key(entries, "patient_id", (order,))


def enrichment_body(registry: Callable[[SparkSession], DataFrame], path: str,
                    keep: tuple[str, ...] = ("kafka_offset",)) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: readings and waiting ones x registry, split by ``matched``; ``registry`` has one row a patient."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, source = batch.sparkSession, jobs.source_of(batch)
        before = read_if_there(spark, f"{jobs.batch_folder(path, source, batch_id - 1)}/matched=false")
        rows = batch if before is None else batch.unionByName(before.select(*batch.columns))
        entries = registry(spark).select("patient_id", *REGISTRY_COLUMNS, F.lit(True).alias("_known"))
        joined = rows.join(entries, "patient_id", "left")
        (joined.select(*message_columns(), *keep, F.coalesce("_known", F.lit(False)).alias("matched"))
         .write.mode("overwrite").partitionBy("matched").parquet(jobs.batch_folder(path, source, batch_id)))
    return write


def start_enrich(readings: DataFrame, registry: Callable[[SparkSession], DataFrame], path: str, checkpoint: str,
                 keep: tuple[str, ...] = ("kafka_offset",), available_now: bool = True,
                 processing_time: str = "30 seconds") -> StreamingQuery:
    """Messages of a stream of readings; ``registry`` is called for every micro-batch."""
    w = (readings.writeStream.foreachBatch(enrichment_body(registry, path, keep))
         .option("checkpointLocation", checkpoint))
    return jobs.with_trigger(w, available_now, processing_time).start()


def read_enriched(spark: SparkSession, path: str, keep: tuple[str, ...] = ("kafka_offset",)) -> DataFrame:
    """The messages written so far."""
    return spark.read.parquet(path).where("matched = 'true'").select(*MESSAGE_COLUMNS, *keep)


def read_waiting(spark: SparkSession, path: str, keep: tuple[str, ...] = ("kafka_offset",)) -> DataFrame:
    """The readings that no entry has matched yet: those left by the last batch of each stream."""
    rows = spark.read.parquet(path)
    last = rows.groupBy("source").agg(F.max("batch_id").alias("batch_id"))
    return rows.where("matched = 'false'").join(last, ["source", "batch_id"], "left_semi").select(*MESSAGE_COLUMNS, *keep).drop(
        *REGISTRY_COLUMNS, "device_id", "hospital_id", "data_source")
