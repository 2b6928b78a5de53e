"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_root

# A-Z and a-z: only ASCII letters are folded where a rule says so
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Survives lost executors; the lineage of an iteration ends here.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def drawn(col: str, share: float) -> Column:
    """True for about ``share`` of the values of ``col``, by a 64-bit hash: as few as asked for, however many there are."""
    return F.xxhash64(col) <= F.lit(min(2 ** 63 - 1, int(share * 2 ** 64) - 2 ** 63))


def beside(rows: DataFrame, totals: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """``rows`` joined with the one row of ``totals`` of their ``keys``; a key may hold any share of the rows.

    Rows are dealt by the key and a part of it, told by a hash of column ``spread``. The
    totals are joined first with the parts that there are, of which a key has at most as
    many as the session has shuffle partitions. Rows with a null key are left out.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(spread), F.lit(shuffle_partitions(rows.sparkSession))))
    told = dealt.select(*keys, "part").distinct().join(totals, keys)
    return dealt.join(told, [*keys, "part"]).drop("part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
