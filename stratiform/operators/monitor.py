"""Monitoring reports over the audit tables.

Every report takes its point in time as ``as_of``: the window bound is then a constant that
prunes the scan, and a report can be repeated. Thresholds and windows of the defaults are the
documented ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.columns import since, truncated

SOURCE = ["source_system", "source_entity"]


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _is(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def run_health(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    recent = runs.filter(since(runs, "run_ts", as_of, days=days))
    return recent.groupBy(
        truncated(runs, "run_ts", "hour").alias("run_hour"), *SOURCE, "status"
    ).agg(
        _n("run_count"), F.sum("rows_in").alias("total_rows_in"), F.sum("rows_out").alias("total_rows_out")
    )


def failed_runs(runs: DataFrame, count: int = 100) -> DataFrame:
    columns = ["run_ts", "run_id", *SOURCE, "status", "error_message"]
    bad = runs.filter(F.col("status") == "FAILED").select(*columns)
    return bad.orderBy(F.desc("run_ts"), "run_id").limit(count)


def failed_loads(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    bad = runs.filter((F.col("status") == "FAILED") & since(runs, "run_ts", as_of, days=days))
    return bad.select(
        F.col("run_id").alias("load_id"),
        *SOURCE,
        "status",
        "error_message",
        "rows_in",
        (F.col("rows_in") - F.col("rows_out")).alias("rows_rejected"),
        "run_ts",
    )


def fail_rate(results: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    recent = results.filter(since(results, "run_ts", as_of, days=days))

    def rows(status: str) -> Column:
        return F.sum(F.when(F.col("dq_status") == status, F.col("row_count")).otherwise(0))

    total = F.col("pass_rows") + F.col("fail_rows")
    return (
        recent.groupBy("run_id", *SOURCE)
        .agg(rows("PASS").alias("pass_rows"), rows("FAIL").alias("fail_rows"))
        .withColumn("fail_rate", F.when(total == 0, F.lit(0.0)).otherwise(F.col("fail_rows") / total))
    )


def top_rules(results: DataFrame) -> DataFrame:
    bad = results.filter(F.col("dq_status") == "FAIL")
    return bad.groupBy(*SOURCE, "dq_failed_rule").agg(
        F.sum("row_count").alias("failed_rows"), F.max("run_ts").alias("last_seen_ts")
    )


def check_status(checks: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    recent = checks.filter(since(checks, "timestamp", as_of, days=days))
    hour = truncated(checks, "timestamp", "hour").alias("event_hour")
    return recent.groupBy(hour, *SOURCE, "validation_type", "validation_status").agg(_n("checks"))


def check_failures(checks: DataFrame, count: int = 200) -> DataFrame:
    columns = [
        "timestamp", "run_id", *SOURCE, "validation_type", "validation_status", "error_details",
    ]
    bad = checks.filter(F.col("validation_status") == "FAIL").select(*columns)
    return bad.orderBy(F.desc("timestamp"), "run_id", "validation_type").limit(count)


def timeline(events: DataFrame, as_of: str, days: int = 3) -> DataFrame:
    recent = events.filter(since(events, "event_ts", as_of, days=days))
    return recent.select(
        "event_ts", "run_id", *SOURCE, "event_name", "event_status", "event_payload"
    )


def reject_trend(rejects: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    recent = rejects.filter(since(rejects, "rejected_ts", as_of, days=days))
    hour = truncated(rejects, "rejected_ts", "hour").alias("reject_hour")
    return recent.groupBy(hour, *SOURCE).agg(_n("reject_rows"))


def quality_gate(runs: DataFrame, results: DataFrame, checks: DataFrame) -> DataFrame:
    """PASS or FAIL per run, from its own status, its failed rows and its failed checks.

    Both sides are aggregated to run level before the joins; all three share the run key, so the
    partitioning of the first join serves the second.
    """
    run = ["run_id", *SOURCE]
    dq = results.groupBy(*run).agg(
        F.sum(F.when(F.col("dq_status") == "FAIL", F.col("row_count")).otherwise(0)).alias("bad_rows")
    )
    bronze = checks.groupBy(*run).agg(_is("validation_status", "FAIL").alias("bad_checks"))
    rows = F.coalesce("bad_rows", F.lit(0).cast("bigint"))
    failing = F.coalesce("bad_checks", F.lit(0).cast("bigint"))
    bad = (F.col("status") == "FAILED") | (rows > 0) | (failing > 0)
    return (
        runs.join(dq, run, "left")
        .join(bronze, run, "left")
        .select(
            "run_ts",
            *run,
            F.col("status").alias("pipeline_status"),
            rows.alias("dq_fail_rows"),
            failing.alias("bronze_fail_checks"),
            F.when(bad, "FAIL").otherwise("PASS").alias("overall_quality_gate"),
        )
    )


def run_summary(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    recent = runs.filter(since(runs, "run_ts", as_of, days=days))
    return recent.groupBy("pipeline_name", *SOURCE).agg(
        _n("total_runs"),
        _is("status", "SUCCESS").alias("successful_runs"),
        _is("status", "FAILED").alias("failed_runs"),
        F.avg("rows_in").alias("avg_rows_ingested"),
        F.max("run_ts").alias("last_run"),
    )


def dq_failure_rate(results: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Failure share per rule combination, only where something failed."""
    recent = results.filter(since(results, "run_ts", as_of, hours=hours))
    bad = F.col("failed_checks")
    return (
        recent.groupBy(*SOURCE, "dq_failed_rule")
        .agg(
            _n("total_checks"),
            _is("dq_status", "FAIL").alias("failed_checks"),
            F.sum(F.when(F.col("dq_status") == "FAIL", F.col("row_count")).otherwise(0)).alias(
                "total_failed_rows"
            ),
        )
        .filter(bad > 0)
        .withColumn("failure_rate_pct", F.round(100.0 * bad / F.col("total_checks"), 2))
    )


def critical_alerts(alerts: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    wanted = F.col("severity").isin("CRITICAL", "ERROR") & since(alerts, "timestamp", as_of, days=days)
    return alerts.filter(wanted).select(
        "alert_id", "severity", "alert_type", "title", *SOURCE, "timestamp", "message"
    )


def retry_exhaustion(alerts: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    wanted = (F.col("alert_type") == "RETRY_EXHAUSTION") & since(alerts, "timestamp", as_of, days=days)
    return alerts.filter(wanted).select("alert_id", "title", *SOURCE, "timestamp", "message")


def slow_queries(metrics: DataFrame, as_of: str, days: int = 7, limit_seconds: float = 30.0) -> DataFrame:
    recent = metrics.filter(since(metrics, "recorded_at", as_of, days=days))
    return (
        recent.groupBy("query_name")
        .agg(
            _n("executions"),
            F.min("duration_seconds").alias("min_seconds"),
            F.avg("duration_seconds").alias("avg_seconds"),
            F.max("duration_seconds").alias("max_seconds"),
            F.avg("throughput_mbps").alias("avg_throughput_mbps"),
            F.max("recorded_at").alias("last_recorded"),
        )
        .filter(F.col("avg_seconds") > limit_seconds)
    )


def rejections(rejects: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    recent = rejects.filter(since(rejects, "rejected_ts", as_of, days=days))
    return recent.groupBy(*SOURCE, F.col("dq_failed_rule").alias("rejection_reason")).agg(
        _n("rejected_count"),
        F.max("rejected_ts").alias("most_recent"),
        F.min("rejected_ts").alias("oldest"),
    )


def success_rate(runs: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    recent = runs.filter(since(runs, "run_ts", as_of, days=days))
    return (
        recent.groupBy(*SOURCE, F.to_date("run_ts").alias("run_date"))
        .agg(_n("runs"), _is("status", "SUCCESS").alias("successful"))
        .withColumn("success_rate_pct", F.round(100.0 * F.col("successful") / F.col("runs"), 1))
    )


def volume_trend(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*SOURCE).agg(
        F.max("rows_in").alias("current_row_count"),
        F.sum("rows_in").alias("cumulative_ingested"),
        _n("total_loads"),
        F.max("run_ts").alias("last_load_time"),
    )


def alert_distribution(alerts: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    recent = alerts.filter(since(alerts, "timestamp", as_of, days=days))
    return recent.groupBy("severity", F.to_date("timestamp").alias("alert_date")).agg(_n("alert_count"))
