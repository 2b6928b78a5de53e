"""Keyed upsert ("incremental merge by unique key") without MERGE INTO.

``upsert_by_key`` unions the target and the new rows and keeps, per key, the
row with the greatest order value (the newer reading wins; on a tie the new
row wins). One shuffle by key; ``WindowGroupLimit`` keeps one row per key
per map partition before the exchange, so a key that dominates the batch
costs no more than any other.

``VersionedTable`` publishes immutable snapshots: a version is a new folder
that nothing ever writes to again, visible once its commit is recorded.
``MergedTable`` is a snapshot plus the small batches written since; a
micro-batch adds only its own rows, and a reader merges the finished ones.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT_SCHEMA = "version long, folder string, through map<string,long>, committed_at timestamp_ntz"


def read_if_there(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The parquet files under ``path``; None if the path does not exist (any other error is raised)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def sync_columns(target: DataFrame, schema: T.StructType) -> DataFrame:
    """Target rows in ``schema``: vanished columns dropped, new ones NULL, types cast."""
    have = set(target.columns)
    return target.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def newest_by_key(df: DataFrame, key: str | list[str], order: tuple[str, ...]) -> DataFrame:
    """The row of each key with the greatest ``order``."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert_by_key(target: DataFrame | None, updates: DataFrame, key: str | list[str] = "patient_id",
                  order: tuple[str, ...] = ("last_reading_at",), sync_schema: bool = True) -> DataFrame:
    """Merge ``updates`` into ``target`` by ``key``; the newer row (by ``order``) wins.

    Keys absent from ``updates`` keep their old row. With ``sync_schema`` the
    result takes the columns of ``updates`` (added columns are NULL for old
    rows, dropped columns disappear); otherwise the target's columns. Without
    a target, several updates of one key still become one row.
    """
    if target is None:
        return newest_by_key(updates, key, order)
    if sync_schema:
        target = sync_columns(target, updates.schema)
    else:
        updates = sync_columns(updates, target.schema)
    both = (target.withColumn("_src", F.lit(0))
            .unionByName(updates.withColumn("_src", F.lit(1))))
    return newest_by_key(both, key, (*order, "_src")).drop("_src")


class VersionedTable:
    """A table published as immutable versions below ``base`` (a shared folder); one writer at a time.

    A version's data go to a folder with a name of its own, so neither a
    failed attempt nor a restart can touch data that a reader may hold. The
    commit names the folder; a version that exists is never written again.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _commits(self) -> DataFrame | None:
        return read_if_there(self.spark, f"{self.base}/commits", COMMIT_SCHEMA)

    def commit(self, version: int | None = None):
        """The commit of ``version``, or the newest; one bounded row."""
        commits = self._commits()
        if commits is None:
            return None
        if version is not None:
            return commits.where(F.col("version") == version).first()
        return commits.orderBy(F.col("version").desc()).first()

    def latest(self) -> int | None:
        """The newest committed version."""
        commit = self.commit()
        return None if commit is None else commit["version"]

    def through(self) -> dict[str, int]:
        """The newest batch of each source that the newest version contains."""
        commit = self.commit()
        return {} if commit is None else dict(commit["through"] or {})

    def read(self, version: int | None = None) -> DataFrame:
        commit = self.commit(version)
        if commit is None:
            raise FileNotFoundError(f"no committed version {version or ''} below {self.base}")
        return self.spark.read.parquet(f"{self.base}/data/{commit['folder']}")

    def publish(self, df: DataFrame, through: dict[str, int] | None = None,
                audit: Callable[[DataFrame], object] | None = None, after: int | None = None) -> int | None:
        """Write ``df`` as the next version and commit it.

        ``audit`` runs on the written, not yet committed rows and may raise to
        stop the publish: readers keep seeing the versions that they saw.
        ``after``: the version that ``df`` was made from; if it is no longer the
        newest, nothing is committed and None returned.
        """
        version = (self.latest() or 0 if after is None else after) + 1
        folder = f"v={version:012d}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.base}/data/{folder}")
        if audit is not None:
            audit(self.spark.read.parquet(f"{self.base}/data/{folder}"))
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        if after is not None and (self.latest() or 0) != after:
            return None
        try:        # fails if another writer has committed this version meanwhile
            (self.spark.createDataFrame([(version, folder, through or {}, now)], COMMIT_SCHEMA).coalesce(1)
             .write.mode("error").parquet(f"{self.base}/commits/v={version:012d}"))
        except AnalysisException as e:
            if after is None or e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            return None
        return version

    def upsert(self, updates: DataFrame, batch: int | None = None, source: str = "", key="patient_id",
               order: tuple[str, ...] = ("last_reading_at",), sync_schema: bool = True,
               audit: Callable[[DataFrame], object] | None = None) -> int:
        """Merge ``updates`` into the newest version and publish the next one.

        ``batch`` numbers the updates of one ``source``, ascending: one that the
        table already contains is a replay and changes nothing.
        """
        commit = self.commit()
        through = {} if commit is None else dict(commit["through"] or {})
        if batch is not None and batch <= through.get(source, -1):
            return commit["version"]
        if batch is not None:
            through[source] = batch
        target = None if commit is None else self.read(commit["version"])
        return self.publish(upsert_by_key(target, updates, key, order, sync_schema), through, audit)


class MergedTable:
    """A snapshot and the batches written since, merged by ``merge`` when read.

    ``merge`` maps rows to rows of the same columns and may be applied again to
    its own output (newest row per key; sums per group). A batch is a folder
    named by its stream and number, so a replay replaces its own rows, and a
    stream on a new checkpoint (another source) adds to what is there. Only
    finished batches are read, and a snapshot holds exactly the batches that its
    commit names: a stream folds in its own batches up to the one that it has
    just written, never another stream's.
    """

    def __init__(self, spark: SparkSession, base: str, merge: Callable[[DataFrame], DataFrame],
                 compact_every: int | None = 50):
        self.spark, self.merge, self.compact_every = spark, merge, compact_every
        self.base = base.rstrip("/")
        self.snapshot = VersionedTable(spark, f"{self.base}/snapshot")

    def add(self, rows: DataFrame, source: str, batch: int) -> None:
        """Write one batch (already merged within itself); fold this stream's batches in now and then."""
        rows.write.mode("overwrite").parquet(self._folder(source, batch))
        if self.compact_every and batch % self.compact_every == self.compact_every - 1:
            self.compact(source, batch)

    def _folder(self, source: str, batch: int) -> str:
        return f"{self.base}/batches/source={source}/batch_id={batch}"

    def _finished(self) -> list[tuple[str, int]]:
        """(source, batch) of every batch folder whose write job has committed; the driver lists folder names only."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/batches/source=*/batch_id=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        parts = [re.search(r"/source=([^/]*)/batch_id=(\d+)/_SUCCESS$", str(f.getPath())) for f in found]
        return sorted((m[1], int(m[2])) for m in parts if m)

    def _rows(self, batches: list[tuple[str, int]]) -> list[DataFrame]:
        if not batches:
            return []
        paths = [self._folder(*b) for b in batches]
        return [self.spark.read.option("basePath", f"{self.base}/batches").parquet(*paths).drop("source", "batch_id")]

    def _parts(self, commit, wanted: Callable[[str, int], bool] = lambda source, batch: True) -> list[DataFrame]:
        """The snapshot of ``commit`` and the finished batches beyond it that are wanted."""
        through = {} if commit is None else dict(commit["through"] or {})
        base = [] if commit is None else [self.snapshot.read(commit["version"])]
        return base + self._rows([b for b in self._finished() if b[1] > through.get(b[0], -1) and wanted(*b)])

    def _merged(self, parts: list[DataFrame]) -> DataFrame:
        return self.merge(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))

    def read(self) -> DataFrame:
        parts = self._parts(self.snapshot.commit())
        if not parts:
            raise FileNotFoundError(f"nothing written below {self.base}")
        return self._merged(parts)

    def read_before(self, source: str, batch: int) -> DataFrame | None:
        """The merged rows without this batch and later ones of its source (a replay has written some); None if there are none.

        A snapshot that holds the batch already (it was folded in, then replayed) is passed over for the last one before it.
        """
        commit = self.snapshot.commit()
        while commit is not None and (commit["through"] or {}).get(source, -1) >= batch:
            commit = self.snapshot.commit(commit["version"] - 1) if commit["version"] > 1 else None
        parts = self._parts(commit, lambda s, b: s != source or b < batch)
        return self._merged(parts) if parts else None

    def compact(self, source: str, batch: int) -> int | None:
        """Publish a snapshot with this stream's batches up to ``batch`` folded in; None if another stream published meanwhile."""
        commit = self.snapshot.commit()
        through = {} if commit is None else dict(commit["through"] or {})
        if through.get(source, -1) >= batch:
            return commit["version"]
        rows = self._merged(self._parts(commit, lambda s, b: s == source and b <= batch))
        return self.snapshot.publish(rows, through | {source: batch}, after=0 if commit is None else commit["version"])
