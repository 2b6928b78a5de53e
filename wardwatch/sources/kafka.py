"""Topic source and sink (Kafka connector).

The connector jar (``spark-sql-kafka``) must be on the classpath; these
functions only declare the plan. Both sides use the same record layout as
the landing-file stand-in (``key``, ``value``, ``partition``, ``offset``,
``timestamp``), so :func:`wardwatch.sources.messages.decode` serves both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.config import TOPIC
from wardwatch.sources.messages import encode


def read_topic(spark: SparkSession, bootstrap: str, topic: str = TOPIC, group: str | None = None,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to ``topic``; start at the earliest offset when no checkpoint exists.

    Progress is kept in the query's checkpoint (not in consumer-group commits),
    which gives exactly-once input with an idempotent sink.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", "earliest")
         .option("failOnDataLoss", "true"))
    if group:
        r = r.option("kafka.group.id", group)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(
        F.col("key").cast("string").alias("key"), F.col("value"),
        "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def sink_options(bootstrap: str, topic: str = TOPIC) -> dict[str, str]:
    """All-replica acknowledgement, 3 retries, 10 ms linger, as the producer does."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all", "kafka.retries": "3",
            "kafka.linger.ms": "10"}


def write_topic(rows: DataFrame, bootstrap: str, topic: str = TOPIC) -> None:
    """Publish readings keyed by patient id (a patient stays in one partition)."""
    encode(rows).write.format("kafka").options(**sink_options(bootstrap, topic)).save()


def stream_writer(rows: DataFrame, bootstrap: str, checkpoint: str, topic: str = TOPIC):
    """The writer that publishes a stream of readings keyed by patient id; call ``start()`` on it."""
    return (encode(rows).writeStream.format("kafka").options(**sink_options(bootstrap, topic))
            .option("checkpointLocation", checkpoint).outputMode("append"))
