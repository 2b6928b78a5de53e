"""Sharding by a two-pass external shuffle, in DataFrame functions only.

First pass: every record goes to a bucket by a seeded hash. Buckets are as many
as keep each within ``bucket_bytes`` of text: a shard has a bucket for each
``bucket_bytes`` that it holds, so that a shard which an id repeated very often
makes large has many buckets of the usual size, not a large one. Second pass:
each bucket, one array that fits a task, is put in the order of the hash, shuffled by
Fisher and Yates' method (``shuffle`` of an array, seeded) and written.

The law is ``key``: an id and the number of shards decide the shard (the shard
whose hash with the id is the greatest), so that one more shard takes records
only into itself. A record's slot is its place in its bucket after the records of
the shard's earlier buckets.

Results: a NULL id is an id like any other; a NULL text has no bytes; empty and
very long texts are records like any other (a text beyond ``bucket_bytes`` has a
large bucket to itself and what else falls there); ties and repeated rows are
records of their own, dealt out by their place in the input; an empty table gives
no files and reads back empty. All columns travel inside the struct ``doc``,
so no name can clash.

The hash of a record takes in the place of its row in the input. A task that is
run again gives its rows the same places as long as the input's partitions keep
their order, as those of a table do; pass a table, or write the rows first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.upsert import read_if_there

SEED = 20_240_131
BUCKET_BYTES = 32 << 20


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """struct(h, shard): the shard whose hash with ``key`` is the greatest."""
    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                                   lambda k: F.struct(F.xxhash64(F.lit(seed), key, k).alias("h"), k.alias("shard"))))


def _records(docs: DataFrame, id_col: str, text_col: str, shards: int, seed: int) -> DataFrame:
    """Each row as ``doc`` with its size, checksum, shard, shard if there were one more, and hash."""
    text = F.coalesce(F.col(f"doc.{text_col}").cast("string"), F.lit(""))
    key = F.col(f"doc.{id_col}")
    records = docs.select(F.struct("*").alias("doc")).select(
        "doc", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, shards, seed).alias("best"), F.xxhash64(F.lit(seed), key, F.lit(shards)).alias("next"),
        F.monotonically_increasing_id().alias("row"))
    return records.select(
        "doc", "size", "text_crc32", F.col("best.shard").alias("shard"),
        F.when(F.struct("next", F.lit(shards)) > F.struct("best.h", "best.shard"), shards).otherwise(F.col("best.shard")).alias("grown_shard"),
        F.xxhash64(F.lit(seed + 1), key, "text_crc32", "row").alias("scatter"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every row of ``docs`` below ``path`` (a new, shared folder): ``shard=k/`` folders of shuffled buckets, and their index."""
    records = _records(docs, id_col, text_col, shards, seed)
    held = {r["shard"]: r["bytes"] for r in records.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}    # a row a shard
    if not held:
        return
    buckets = [-(-held.get(k, 0) // bucket_bytes) for k in range(shards)]
    first = [sum(buckets[:k]) for k in range(shards)]
    bucket = (F.get(F.lit(first), F.col("shard"))
              + F.pmod("scatter", F.get(F.lit(buckets), F.col("shard")).cast("long")).cast("int"))
    scattered = (records.withColumn("bucket", bucket).repartitionById(sum(buckets), "bucket")
                 .sortWithinPartitions("bucket", "scatter"))
    whole = scattered.groupBy("shard", "bucket").agg(
        F.collect_list(F.struct("size", "text_crc32", "grown_shard", "doc")).alias("records"))
    dealt = whole.select("shard", "bucket", F.posexplode(F.shuffle("records", F.lit(seed))).alias("place", "r"))
    dealt.select("shard", "bucket", "place", "r.*").write.partitionBy("shard").parquet(f"{path}/data")
    data = docs.sparkSession.read.parquet(f"{path}/data")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = data.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    counts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0))).write.parquet(f"{path}/index")


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """(shard, slot, size, text_crc32, grown_shard, doc) of every record below ``path``; ``like`` has the columns of the rows that were written."""
    data = read_if_there(spark, f"{path}/data")
    if data is None:        # an empty table was written
        data = (like.limit(0).select(F.struct("*").alias("doc"))
                .selectExpr("0 AS shard", "0L AS slot", "0L AS size", "0L AS text_crc32", "0 AS grown_shard", "doc"))
        return data
    index = spark.read.parquet(f"{path}/index").select("bucket", "start")
    return data.join(index, "bucket").select("shard", (F.col("start") + F.col("place")).alias("slot"), "size", "text_crc32", "grown_shard", "doc")
