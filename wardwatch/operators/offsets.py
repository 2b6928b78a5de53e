"""Source positions as intervals: what was received, what came twice, what is missing.

A position is (``kafka_partition``, ``kafka_offset``). The positions of a batch become
intervals of consecutive offsets (gaps and islands), cut at blocks of ``BLOCK``
offsets: a stream without gaps needs one row for each block, whatever the number of
records. All windows run inside a block, so that a partition that holds most
records spreads over as many tasks as it has blocks; only one row a block is
looked at in a window over a whole partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16
POSITION = ("kafka_partition", "kafka_offset")


def _block(offset: Column | str) -> Column:
    return F.floor((F.col(offset) if isinstance(offset, str) else offset) / BLOCK)


def islands(positions: DataFrame) -> DataFrame:
    """(kafka_partition, block, first, last): the maximal stretches of offsets within a block; rows without a position are left out."""
    there = positions.where(F.col("kafka_partition").isNotNull() & F.col("kafka_offset").isNotNull()).select(*POSITION).distinct()
    there = there.withColumn("block", _block("kafka_offset"))
    w = Window.partitionBy("kafka_partition", "block").orderBy("kafka_offset")
    return (there.withColumn("island", F.col("kafka_offset") - F.row_number().over(w))
            .groupBy("kafka_partition", "block", "island").agg(F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last"))
            .drop("island"))


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals of several batches: overlapping and adjacent ones of a block become one."""
    w = Window.partitionBy("kafka_partition", "block").orderBy("first", "last")
    reach = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = intervals.withColumn("_new", F.when(F.col("first") <= reach + 1, 0).otherwise(1))
    return (starts.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("kafka_partition", "block", "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .drop("_island"))


def gaps(intervals: DataFrame) -> DataFrame:
    """(kafka_partition, first_missing, last_missing, n_missing): offsets between the least and the greatest received that never came.

    ``intervals`` are merged. A gap that spans blocks is one row.
    """
    inside = Window.partitionBy("kafka_partition", "block").orderBy("first")
    within = intervals.withColumn("_before", F.lag("last").over(inside)).where(F.col("first") > F.col("_before") + 1)
    blocks = intervals.groupBy("kafka_partition", "block").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    between = (blocks.withColumn("_before", F.lag("last").over(Window.partitionBy("kafka_partition").orderBy("block")))
               .where(F.col("first") > F.col("_before") + 1))
    found = [g.select("kafka_partition", (F.col("_before") + 1).alias("first_missing"), (F.col("first") - 1).alias("last_missing"))
             for g in (within, between)]
    return found[0].unionByName(found[1]).withColumn("n_missing", F.col("last_missing") - F.col("first_missing") + 1)


def first_deliveries(records: DataFrame, known: DataFrame | None, partition: str = "kafka_partition",
                     offset: str = "kafka_offset") -> DataFrame:
    """One of the records of each position that no interval of ``known`` holds; records without a position are all kept.

    A sweep over each block in the order of the offsets: the greatest end of what came before tells whether a
    position is covered. Of ``known`` only the blocks that the records touch are read into the sweep.
    """
    whole = records.select(F.col(partition).alias("kafka_partition"), F.col(offset).cast("long").alias("first"), F.struct("*").alias("_r"))
    placed = F.col("kafka_partition").isNotNull() & F.col("first").isNotNull()
    asked = whole.where(placed).withColumn("block", _block("first")).select("kafka_partition", "block", "first", F.col("first").alias("last"), "_r")
    swept = asked
    if known is not None:
        touched = asked.select("kafka_partition", "block").distinct()
        covered = known.select("kafka_partition", "block", "first", "last").join(touched, ["kafka_partition", "block"], "left_semi")
        swept = covered.withColumn("_r", F.lit(None).cast(asked.schema["_r"].dataType)).unionByName(asked)
    w = (Window.partitionBy("kafka_partition", "block").orderBy("first", F.col("_r").isNotNull())
         .rowsBetween(Window.unboundedPreceding, -1))
    fresh = (swept.withColumn("_reach", F.max("last").over(w))
             .where(F.col("_r").isNotNull() & (F.col("_reach").isNull() | (F.col("_reach") < F.col("first")))))
    return fresh.select("_r.*").unionByName(whole.where(~placed).select("_r.*"))
