"""Settings of the library's own sessions, and the shared work folder.

Queries change no setting of a session that they are given. Jobs that write
intermediate tables (stream checkpoints, landed files, mart versions) put them
below the shared folder named by ``spark.checkpoint.dir``; without that setting
a folder of this machine is made if the master is local, else an error raised.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# settings of sessions made by build_session (no query depends on them for its rows)
SESSION_SETTINGS = {
    # the session clock is taken as UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small shuffles, split skewed partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the fused staging stage generates one Java method larger than HotSpot
    # will JIT-compile (8000 bytes); past that limit Spark runs the operators
    # with their own (compiled) projections instead: 3-4x faster here
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # stream state off the JVM heap (large state at scale)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "wardwatch",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the library settings.

    On a cluster leave ``master`` unset; ``shuffle_partitions`` should be sized
    so that one shuffle partition holds roughly 128-256 MB.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in SESSION_SETTINGS.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables (``spark.checkpoint.dir``).

    Where the setting is unset: on a local master a fresh temporary folder,
    recorded as the checkpoint folder of this session; else an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app)
        if root is None:
            root = tempfile.mkdtemp(prefix="wardwatch-")
            spark.sparkContext.setCheckpointDir(root)
            _LOCAL_ROOTS[app] = root
    return root.rstrip("/")


_LOCAL_ROOTS: dict[str, str] = {}


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder below the shared root for one run."""
    return f"{shared_root(spark)}/wardwatch/{name}-{uuid.uuid4().hex[:12]}"

