"""URL filters: a sort-merge range join of pages with nested host and path rules.

A rule is a host and a path prefix; it fits its host, all subdomains, and
urls whose path starts with the rule's path. With the labels of the host
reversed, ``example.net`` + ``/en/`` becomes the key ``net.example//en/``, and
the urls that a rule fits are one interval of keys: those that start with the
rule's key. A url has one key for each of its host's ancestors that some rule
could name. Keys and rules are dealt out by key range; a rule goes to every
range that its interval meets. Each range is sorted once and swept with a
stack of the rules that are open at the current key; intervals of prefixes
nest or are disjoint, so the top of the stack is the longest rule that fits.

Scale: one shuffle of (id, host, path) by range and one by row id; no column
of the page other than its id and url is read. Equal keys carry a hash of the
row, so that a host or a url with a third of all pages is split over many
ranges. The driver holds the range bounds only (one string for each shuffle
partition, from a sample that serves for the bounds alone).
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, drawn, shuffle_partitions

SAMPLES_PER_RANGE = 30
SWEPT = "uid long, page_id long, host string, path string, rule string, verdict string, size int, host_size int"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; '' without ``://``."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, depth: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.slice(labels, 1, depth), "."), F.lit("/"), path)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    ``rules``: host, path, verdict. ``rule`` is the longest fitting rule's host
    and path without the path's first slash (``example.net/en/``), null if none
    fits; then the verdict is ``default``. Longest: host and path together,
    then the host. Two rules of the same host and path: the later verdict in
    text order (block over allow). Rules with a null are ignored. No pages give
    no rows. A null url,
    or one without ``://``, has an empty host and path, which no rule fits. Null
    and repeated ids keep their rows. Other columns are not read.
    """
    spark = pages.sparkSession
    n = shuffle_partitions(spark)
    rules = (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").dropna()
             .where("host <> ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    depths = sorted(r[0] for r in rules.select(F.size(F.split("host", r"\."))).distinct().collect())

    url = F.coalesce(F.col(url_col), F.lit(""))
    one = (pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
           .withColumn("uid", F.monotonically_increasing_id()))
    labels = _labels(F.col("host"))
    own = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda d: d <= F.size(labels))
    keys = F.transform(own, lambda d: _key(labels, d, F.col("path")))
    salt = F.concat(F.lit("\0"), F.hex(F.xxhash64("uid")))
    swept = one.withColumn("key", F.explode(F.when(F.size(keys) > 0, keys).otherwise(F.array(F.lit("")))))
    swept = swept.withColumn("at", F.concat("key", salt))

    total = one.count()
    share = min(1.0, SAMPLES_PER_RANGE * n / max(total, 1))
    sample = swept.where(drawn("at", share)).select("at")
    points = sorted(r[0] for r in sample.collect())
    bounds = sorted({points[len(points) * i // n] for i in range(1, n)}) if points else []

    @F.pandas_udf("int")
    def part(at: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(bounds, x) for x in at], dtype="int32")

    @F.pandas_udf("array<int>")
    def parts(key: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect.bisect_right(bounds, k),
                                     bisect.bisect_right(bounds, k, key=lambda b: b[:len(k)]) + 1)) for k in key])

    empty = lambda kind, name: F.lit(None).cast(kind).alias(name)
    left = swept.select(part("at").alias("part"), "at", F.lit(1).alias("kind"), "key", "uid", "page_id", "host", "path",
                        empty("string", "verdict"))
    key = _key(_labels(F.col("host")), F.size(_labels(F.col("host"))), F.col("path"))
    right = rules.withColumn("key", key).select(
        F.explode(parts("key")).alias("part"), F.col("key").alias("at"), F.lit(0).alias("kind"), "key",
        empty("long", "uid"), empty("long", "page_id"), "host", "path", "verdict")
    found = (left.union(right).repartitionById(n, F.col("part")).sortWithinPartitions("at", "kind")
             .mapInArrow(_sweep, SWEPT))
    best = F.max(F.struct("size", "host_size", "rule", "verdict"))
    return (found.groupBy("uid").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"),
                                     F.first("path").alias("path"), best.alias("best"))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in key order: rules open and close, pages take the longest open rule."""
    schema = pa.schema([("uid", pa.int64()), ("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("rule", pa.string()), ("verdict", pa.string()), ("size", pa.int32()), ("host_size", pa.int32())])
    stack: list[tuple[str, tuple]] = []     # at most as deep as a key is long
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                for c in ("at", "kind", "key", "uid", "page_id", "host", "path", "verdict")]
        out = []
        for at, kind, key, uid, page_id, host, path, verdict in zip(*cols):
            while stack and not at.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, (host + "/" + path.removeprefix("/"), verdict, len(host) + len(path), len(host))))
            else:
                rule = next((r for k, r in reversed(stack) if key.startswith(k)), (None, None, None, None))
                out.append((uid, page_id, host, path, *rule))
        columns = list(zip(*out)) or [()] * len(schema)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
