"""Check results by event-time window, as a stream goes on.

Every micro-batch appends its own counts for each window and check status, by a step that is named by the
batch: a repeated batch is there once. The watermark of a batch is the latest event of the batches before it
less the allowed delay, so rows of windows that had closed by then are told apart as late instead of
being dropped; it does not depend on how files were dealt to tasks. Windows are summed up when they are read, so no
state has to be held in memory between batches.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratiform.errors import ConfigError
from stratiform.operators import bronze, landing, publish
from stratiform.streaming.files import query_identity, refreshed, stream_options, triggered


def _seconds(interval: str) -> Column:
    """Length of an interval of days and smaller units, as in '10 minutes'."""
    return F.expr(f"unix_seconds(timestamp'1970-01-02' + interval {interval}) - unix_seconds(timestamp'1970-01-02')")


def batch_counts(
    rows: DataFrame, checks: Mapping[str, Any], event_time: str, window: str, delay: str, seen: Any = None
) -> DataFrame:
    """Counts of one batch: window_start, status, failed_check, is_late, n, latest (event).

    ``seen`` is the latest event time of earlier batches. Rows without event time are in no window: their
    window_start is NULL, and they are never late.
    """
    time = F.col(event_time).cast("timestamp")
    start = F.window(time, window)["start"]
    placed = bronze.annotate(rows, checks).withColumn("__time", time)
    kept = placed.where(F.col("__time").isNotNull()).withColumn("window_start", start)
    parts = kept.unionByName(placed.where(F.col("__time").isNull()).withColumn("window_start", F.lit(None).cast("timestamp")))
    closed = F.unix_seconds("window_start") + _seconds(window) <= F.unix_seconds(F.lit(seen).cast("timestamp")) - _seconds(delay)
    return parts.groupBy(
        "window_start", F.col("bronze_dq_status").alias("status"), F.col("bronze_dq_failed_check").alias("failed_check"),
        F.coalesce(closed, F.lit(False)).alias("is_late"),
    ).agg(F.count(F.lit(1)).alias("n"), F.max("__time").alias("latest"))


def stream_window_counts(
    frame: DataFrame, table: str, checkpoint: str, checks: Mapping[str, Any], event_time: str, window: str = "10 minutes",
    delay: str = "30 minutes", options: Mapping[str, Any] | None = None, path: str | None = None,
) -> StreamingQuery:
    """Run the checks on a stream and append the counts of each micro-batch to ``table``."""
    landing.checked_table(table)
    problems = bronze.config_errors(checks)
    if problems:
        raise ConfigError(f"invalid check configuration: {problems}")

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        name, seen = f"{query_identity(spark, checkpoint)}-{number}", None
        if spark.catalog.tableExists(table):
            # Batches before this one only: a repeated batch must not see itself.
            seen = spark.table(table).where(F.col("batch") < number).agg(F.max("latest")).first()[0]
        counts = batch_counts(rows, checks, event_time, window, delay, seen).withColumn("batch", F.lit(number).cast("bigint"))
        publish.append(counts.coalesce(1), table, path=path, load=name, again=True)
        publish.compact(spark, table)

    writer = frame.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    query = triggered(writer, stream_options(options)).start()
    query.awaitTermination()
    refreshed(frame.sparkSession, table)
    return query


def window_counts(spark: SparkSession, table: str) -> DataFrame:
    """Counts of all batches: window_start, status, failed_check, is_late, n."""
    keys = ["window_start", "status", "failed_check", "is_late"]
    return spark.table(table).groupBy(*keys).agg(F.sum("n").alias("n"))
