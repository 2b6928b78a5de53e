"""Load counts and quality checks of a stream, observed while it writes.

The decoded and the staged rows carry observed metrics (one count each), so that
a micro-batch counts what it received, loaded and set aside, and the failing rows of
every staging check, in the pass that writes its rows: no second job reads them. A
listener writes the counts of each batch to a progress table, a folder a batch, which
a replayed batch replaces; the gate of a publish reads that table.

Spark adds the counts up from the tasks of the writing job; a batch is one job of the
file sink. As with all observed metrics a task that ran twice is counted once if
it failed, but rows that a lost executor's task had already reported stay counted.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wardwatch.operators import quality, staging
from wardwatch.operators.upsert import read_if_there
from wardwatch.sources import messages
from wardwatch.streaming import jobs

LOAD_METRICS, QUALITY_METRICS = "load", "staging_quality"
PROGRESS = "metric_set string, metric string, value long, input_rows long"


def observe_load(decoded: DataFrame) -> DataFrame:
    """Decoded records with the load counts (as :func:`messages.counts`) attached as observed metrics."""
    return decoded.observe(LOAD_METRICS, *messages.count_columns())


def observe_quality(staged: DataFrame) -> DataFrame:
    """Staged rows with the failing rows of each staging check attached as observed metrics, named ``column.test``."""
    checks = [c for c in quality.default_checks() if c.relation == quality.STAGING]
    return staged.observe(QUALITY_METRICS, F.count(F.lit(1)).alias("rows"),
                          *[F.expr(f"count_if({c.failing_sql()})").alias(f"{c.column}.{c.test}") for c in checks])


class ProgressLog(StreamingQueryListener):
    """Writes the observed metrics of the batches of the queries named ``name`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or not p.observedMetrics:
            return
        rows = [(kind, metric, int(value or 0), int(p.numInputRows))
                for kind, values in p.observedMetrics.items() for metric, value in values.asDict().items()]
        (self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("overwrite")
         .parquet(jobs.batch_folder(self.path, str(p.id), p.batchId)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Return when the table holds the query's last batch; events reach a listener a little after the batch."""
        last = [p for p in query.recentProgress if p["observedMetrics"]]
        end = time.time() + seconds
        while last and time.time() < end:
            if read_if_there(self.spark, jobs.batch_folder(self.path, str(query.id), last[-1]["batchId"]) + "/*.parquet") is not None:
                return
            time.sleep(0.2)
        if last:
            raise TimeoutError(f"no progress of batch {last[-1]['batchId']} below {self.path}")


def start_observed_staging(records: DataFrame, path: str, checkpoint: str, name: str, stamp: Column | None = None,
                           available_now: bool = True, processing_time: str = "30 seconds") -> StreamingQuery:
    """Continuous cleaning in one pass a batch, counts and checks observed; add a :class:`ProgressLog` of that name first.

    The bad records of the source are those that its ingest job sets aside.
    """
    decoded = observe_load(messages.decode(records, stamp=stamp))
    staged = observe_quality(staging.stage(messages.loaded(decoded), carry=("kafka_offset",)))
    w = staged.writeStream.format("parquet").queryName(name).option("checkpointLocation", checkpoint).outputMode("append")
    return jobs.with_trigger(w, available_now, processing_time).start(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """(source, batch_id, metric_set, metric, value, input_rows) of every batch."""
    return spark.read.parquet(path)


def totals(progress: DataFrame) -> DataFrame:
    """(metric_set, metric, total) over all batches."""
    return progress.groupBy("metric_set", "metric").agg(F.sum("value").alias("total"))


def enforce_progress(progress: DataFrame) -> list:
    """The gate on observed checks: raises :class:`quality.QualityGateError` naming the batches where an error-level check failed.

    Returns the failing warning-level rows.
    """
    severity = {f"{c.column}.{c.test}": c.severity for c in quality.default_checks() if c.relation == quality.STAGING}
    failed = progress.where((F.col("metric_set") == QUALITY_METRICS) & (F.col("metric") != "rows") & (F.col("value") > 0))
    per_check = failed.groupBy("metric").agg(F.sum("value").alias("value"), F.min("batch_id").alias("first_batch")).collect()   # a row a check
    errors = [r for r in per_check if severity.get(r["metric"]) == "error"]
    if errors:
        detail = ", ".join(f"{r['metric']}: {r['value']} from batch {r['first_batch']} on" for r in errors)
        raise quality.QualityGateError(f"data-quality gate failed: {detail}")
    return [r for r in per_check if severity.get(r["metric"]) != "error"]
