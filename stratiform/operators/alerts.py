"""Alerts and performance metrics derived set-wise from audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default thresholds.
DQ_WARN_PERCENT = 10.0
DQ_CRITICAL_PERCENT = 50.0
BASELINE_SECONDS = 300.0
SLOW_FACTOR = 2.0
SLOW_QUERY_SECONDS = 30.0
ERROR_PREFIX = 100
MIN_SECONDS = 0.001
BYTES_PER_MB = 1024.0 * 1024.0


# Titles and messages of alerts, by which readers of the alert table know them.
RATE_TITLE, RATE_MESSAGE = "High DQ failure rate: %.1f%%", "%d of %d rows failed DQ checks"
RETRY_TITLE, RETRY_MESSAGE = "Retries exhausted for %s", "Failed after %d retries. Last error: %s"
SLOW_TITLE, SLOW_MESSAGE = "Slow load: %.1fs (baseline: %.1fs)", "Load took %.1fx longer than expected"


def _alert(df: DataFrame, kind: str, severity: Column, title: Column, message: Column, metadata: Column) -> DataFrame:
    """Alert rows; ``df`` carries product_name, source keys, load_id and timestamp."""
    alert_id = F.concat_ws("_", "source_system", "source_entity", "load_id", F.lit(kind))
    return df.select(
        alert_id.alias("alert_id"),
        severity.alias("severity"),
        F.lit(kind).alias("alert_type"),
        title.alias("title"),
        message.alias("message"),
        "product_name",
        "source_system",
        "source_entity",
        "load_id",
        "timestamp",
        F.to_json(metadata).alias("metadata"),
    )


def dq_failure_rate(loads: DataFrame, warn_percent: float = DQ_WARN_PERCENT) -> DataFrame:
    """Loads with too large a share of failed rows (columns total_rows, failed_rows)."""
    rate = 100.0 * F.col("failed_rows") / F.col("total_rows")
    rated = loads.filter(F.col("total_rows") > 0).withColumn("failure_rate", rate)
    bad = rated.filter(F.col("failure_rate") > warn_percent)
    return _alert(
        bad,
        "DQ_FAILURE_RATE",
        F.when(F.col("failure_rate") > DQ_CRITICAL_PERCENT, "CRITICAL").otherwise("WARNING"),
        F.format_string(RATE_TITLE, "failure_rate"),
        F.format_string(RATE_MESSAGE, "failed_rows", "total_rows"),
        F.struct("total_rows", "failed_rows", "failure_rate", F.lit(warn_percent).alias("threshold")),
    )


def retry_exhaustion(loads: DataFrame) -> DataFrame:
    """Loads that used up their retries (columns retry_count, max_retries, error)."""
    return _alert(
        loads.filter(F.col("retry_count") >= F.col("max_retries")),
        "RETRY_EXHAUSTION",
        F.lit("CRITICAL"),
        F.format_string(RETRY_TITLE, "source_entity"),
        F.format_string(
            RETRY_MESSAGE,
            F.col("max_retries"),
            F.substring("error", 1, ERROR_PREFIX),
        ),
        F.struct("retry_count", "max_retries", "error"),
    )


def slow_loads(loads: DataFrame, baseline_seconds: float = BASELINE_SECONDS) -> DataFrame:
    """Loads slower than twice the baseline (column duration_seconds)."""
    base = F.lit(float(baseline_seconds))
    times = F.col("duration_seconds") / base
    return _alert(
        loads.filter(F.col("duration_seconds") > baseline_seconds * SLOW_FACTOR),
        "PERFORMANCE_DEGRADATION",
        F.lit("WARNING"),
        F.format_string(SLOW_TITLE, F.col("duration_seconds"), base),
        F.format_string(SLOW_MESSAGE, times),
        F.struct("duration_seconds", base.alias("baseline_seconds"), times.alias("multiplier")),
    )


def with_severity(alerts: DataFrame, severity: str | None = None) -> DataFrame:
    return alerts if severity is None else alerts.filter(F.col("severity") == severity)


def any_critical(alerts: DataFrame) -> DataFrame:
    critical = F.bool_or(F.col("severity") == "CRITICAL")
    return alerts.agg(F.coalesce(critical, F.lit(False)).alias("has_critical"))


def performance(executions: DataFrame) -> DataFrame:
    """Add throughput in MB per second to execution rows."""
    seconds = F.greatest(F.col("duration_seconds"), F.lit(MIN_SECONDS))
    return executions.withColumn(
        "throughput_mbps", F.col("bytes_processed") / F.lit(BYTES_PER_MB) / seconds
    )


def slow_executions(metrics: DataFrame, limit_seconds: float = SLOW_QUERY_SECONDS) -> DataFrame:
    return metrics.filter(F.col("duration_seconds") > limit_seconds)
