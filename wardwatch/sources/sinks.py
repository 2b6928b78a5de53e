"""File sinks standing in for a topic: keyed JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.schemas import ENVELOPE_SCHEMA
from wardwatch.sources.messages import encode


# records of one key per output task at most (the hot-key split)
BLOCK_ROWS = 1_000_000


def write_keyed_json(rows: DataFrame, path: str, partitions: int | None = None,
                     keep: tuple[str, ...] = (), order_col: str | None = "kafka_offset",
                     block_rows: int = BLOCK_ROWS) -> None:
    """Write readings as ``{"key", "value"}`` JSON lines, partitioned by key.

    Like a keyed topic, the records of one patient go to the same output
    task, in blocks of ``block_rows`` consecutive ``order_col`` values: a
    patient that holds a third of all readings is spread over many tasks
    instead of one. So a patient's records are together and in order within a
    block, not over all blocks. Readings without a key go to ``<path>_unkeyed``.
    ``partitions`` defaults to the session's shuffle partitions.
    """
    encode(rows.where(F.col("patient_id").isNull())).write.mode("overwrite").json(f"{path}_unkeyed")
    rows = rows.where(F.col("patient_id").isNotNull())
    rec = encode(rows, keep=tuple(keep) + ((order_col,) if order_col and order_col not in keep else ()))
    keys = [F.col("key")]
    if order_col:
        keys.append(F.floor(F.col(order_col) / block_rows))
    rec = rec.repartition(partitions, *keys) if partitions else rec.repartition(*keys)
    if order_col:
        rec = rec.sortWithinPartitions("key", order_col)
        if order_col not in keep:
            rec = rec.drop(order_col)
    rec.write.mode("overwrite").json(path)


def read_keyed_json(spark: SparkSession, path: str) -> DataFrame:
    fields = [f for f in ENVELOPE_SCHEMA.fields if f.name in ("key", "value")]
    from pyspark.sql import types as T
    return spark.read.schema(T.StructType(fields)).json(path)
