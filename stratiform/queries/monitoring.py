"""Monitoring reports, alerts, metrics, verification and layout advice."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.operators import advisor, alerts, monitor, verify
from stratiform.queries.inputs import AS_OF_EVENTS, AS_OF_LINES, ctes, derive
from stratiform.queries.registry import query, table

_E = f"TIMESTAMP '{AS_OF_EVENTS}'"
_L = f"TIMESTAMP '{AS_OF_LINES}'"
_RUNS, _RESULTS, _CHECKS, _REJECTS = (ctes(n) for n in ("runs", "results", "checks", "rejects"))


def _big(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


@query(
    "mon_run_health",
    f"""{_RUNS} SELECT date_trunc('hour', run_ts) AS run_hour, source_system, source_entity, status,
  count(*) AS run_count, {_big('sum(rows_in)')} AS total_rows_in, {_big('sum(rows_out)')} AS total_rows_out
FROM runs WHERE run_ts >= {_E} - INTERVAL 7 DAY GROUP BY ALL""",
)
def mon_run_health(spark, sf_dir):
    return monitor.run_health(derive(spark, sf_dir, "runs"), AS_OF_EVENTS)


@query(
    "mon_failed_runs",
    f"""{_RUNS} SELECT run_ts, run_id, source_system, source_entity, status, error_message FROM runs
WHERE status = 'FAILED' ORDER BY run_ts DESC, run_id LIMIT 100""",
)
def mon_failed_runs(spark, sf_dir):
    return monitor.failed_runs(derive(spark, sf_dir, "runs"))


@query(
    "mon_failed_loads",
    f"""{_RUNS} SELECT run_id AS load_id, source_system, source_entity, status, error_message, rows_in,
  rows_in - rows_out AS rows_rejected, run_ts FROM runs
WHERE status = 'FAILED' AND run_ts >= {_E} - INTERVAL 7 DAY""",
)
def mon_failed_loads(spark, sf_dir):
    return monitor.failed_loads(derive(spark, sf_dir, "runs"), AS_OF_EVENTS)


@query(
    "mon_fail_rate",
    f"""{_RESULTS}, d AS (SELECT run_id, source_system, source_entity,
  {_big("sum(CASE WHEN dq_status = 'PASS' THEN row_count ELSE 0 END)")} AS pass_rows,
  {_big("sum(CASE WHEN dq_status = 'FAIL' THEN row_count ELSE 0 END)")} AS fail_rows
  FROM results WHERE run_ts >= {_E} - INTERVAL 7 DAY GROUP BY ALL)
SELECT *, CASE WHEN pass_rows + fail_rows = 0 THEN 0.0::DOUBLE
  ELSE fail_rows / (pass_rows + fail_rows) END AS fail_rate FROM d""",
)
def mon_fail_rate(spark, sf_dir):
    return monitor.fail_rate(derive(spark, sf_dir, "results"), AS_OF_EVENTS)


@query(
    "mon_top_rules",
    f"""{_RESULTS} SELECT source_system, source_entity, dq_failed_rule, {_big('sum(row_count)')}
  AS failed_rows, max(run_ts) AS last_seen_ts FROM results WHERE dq_status = 'FAIL' GROUP BY ALL""",
)
def mon_top_rules(spark, sf_dir):
    return monitor.top_rules(derive(spark, sf_dir, "results"))


@query(
    "mon_check_status",
    f"""{_CHECKS} SELECT date_trunc('hour', timestamp) AS event_hour, source_system, source_entity,
  validation_type, validation_status, count(*) AS checks FROM checks
WHERE timestamp >= {_E} - INTERVAL 7 DAY GROUP BY ALL""",
)
def mon_check_status(spark, sf_dir):
    return monitor.check_status(derive(spark, sf_dir, "checks"), AS_OF_EVENTS)


@query(
    "mon_check_failures",
    f"""{_CHECKS} SELECT timestamp, run_id, source_system, source_entity, validation_type,
  validation_status, error_details FROM checks WHERE validation_status = 'FAIL'
ORDER BY timestamp DESC, run_id, validation_type LIMIT 200""",
)
def mon_check_failures(spark, sf_dir):
    return monitor.check_failures(derive(spark, sf_dir, "checks"))


@query(
    "mon_timeline",
    f"""{ctes('stage_log')} SELECT event_ts, run_id, source_system, source_entity, event_name,
  event_status, event_payload FROM stage_log WHERE event_ts >= {_E} - INTERVAL 3 DAY""",
)
def mon_timeline(spark, sf_dir):
    return monitor.timeline(derive(spark, sf_dir, "stage_log"), AS_OF_EVENTS)


@query(
    "mon_reject_trend",
    f"""{_REJECTS} SELECT date_trunc('hour', rejected_ts) AS reject_hour, source_system, source_entity,
  count(*) AS reject_rows FROM rejects WHERE rejected_ts >= {_L} - INTERVAL 7 DAY GROUP BY ALL""",
)
def mon_reject_trend(spark, sf_dir):
    return monitor.reject_trend(derive(spark, sf_dir, "rejects"), AS_OF_LINES)


@query(
    "gate_by_run",
    f"""{ctes('runs', 'results', 'checks')},
d AS (SELECT run_id, source_system, source_entity, sum(row_count) AS n FROM results
  WHERE dq_status = 'FAIL' GROUP BY ALL),
b AS (SELECT run_id, source_system, source_entity, count(*) AS n FROM checks
  WHERE validation_status = 'FAIL' GROUP BY ALL)
SELECT r.run_ts, r.run_id, r.source_system, r.source_entity, r.status AS pipeline_status,
  {_big('coalesce(d.n, 0)')} AS dq_fail_rows, {_big('coalesce(b.n, 0)')} AS bronze_fail_checks,
  CASE WHEN r.status = 'FAILED' OR coalesce(d.n, 0) > 0 OR coalesce(b.n, 0) > 0 THEN 'FAIL' ELSE 'PASS'
  END AS overall_quality_gate
FROM runs r LEFT JOIN d USING (run_id, source_system, source_entity)
LEFT JOIN b USING (run_id, source_system, source_entity)""",
)
def gate_by_run(spark, sf_dir):
    return monitor.quality_gate(*(derive(spark, sf_dir, n) for n in ("runs", "results", "checks")))


@query(
    "mon_run_summary",
    f"""{_RUNS} SELECT pipeline_name, source_system, source_entity, count(*) AS total_runs,
  count(*) FILTER (status = 'SUCCESS') AS successful_runs,
  count(*) FILTER (status = 'FAILED') AS failed_runs, avg(rows_in) AS avg_rows_ingested,
  max(run_ts) AS last_run FROM runs WHERE run_ts >= {_E} - INTERVAL 7 DAY GROUP BY ALL""",
)
def mon_run_summary(spark, sf_dir):
    return monitor.run_summary(derive(spark, sf_dir, "runs"), AS_OF_EVENTS)


@query(
    "mon_dq_failure_rate",
    f"""{_RESULTS}, g AS (SELECT source_system, source_entity, dq_failed_rule, count(*) AS total_checks,
  count(*) FILTER (dq_status = 'FAIL') AS failed_checks,
  {_big("sum(CASE WHEN dq_status = 'FAIL' THEN row_count ELSE 0 END)")} AS total_failed_rows
  FROM results WHERE run_ts >= {_E} - INTERVAL 24 HOUR GROUP BY ALL)
SELECT *, round(100.0 * failed_checks::DOUBLE / total_checks, 2) AS failure_rate_pct FROM g
WHERE failed_checks > 0""",
)
def mon_dq_failure_rate(spark, sf_dir):
    report = monitor.dq_failure_rate(derive(spark, sf_dir, "results"), AS_OF_EVENTS)
    return report.withColumn("failure_rate_pct", F.col("failure_rate_pct").cast("double"))


@query(
    "mon_slow_queries",
    f"""{ctes('executions')} SELECT query_name, count(*) AS executions, min(duration_seconds) AS min_seconds,
  round(avg(duration_seconds), 9) AS avg_seconds, max(duration_seconds) AS max_seconds,
  round(avg(bytes_processed / (1024.0::DOUBLE * 1024.0) / greatest(duration_seconds, 0.001)), 9)
    AS avg_throughput_mbps, max(recorded_at) AS last_recorded
FROM executions WHERE recorded_at >= {_E} - INTERVAL 7 DAY GROUP BY query_name
HAVING avg(duration_seconds) > 30""",
)
def mon_slow_queries(spark, sf_dir):
    report = monitor.slow_queries(alerts.performance(derive(spark, sf_dir, "executions")), AS_OF_EVENTS)
    rounded = {c: F.round(c, 9) for c in ("avg_seconds", "avg_throughput_mbps")}
    return report.withColumns(rounded)


@query(
    "mon_rejections",
    f"""{_REJECTS} SELECT source_system, source_entity, dq_failed_rule AS rejection_reason,
  count(*) AS rejected_count, max(rejected_ts) AS most_recent, min(rejected_ts) AS oldest
FROM rejects WHERE rejected_ts >= {_L} - INTERVAL 7 DAY GROUP BY ALL""",
)
def mon_rejections(spark, sf_dir):
    return monitor.rejections(derive(spark, sf_dir, "rejects"), AS_OF_LINES)


@query(
    "mon_success_rate",
    f"""{_RUNS}, g AS (SELECT source_system, source_entity, CAST(run_ts AS DATE) AS run_date,
  count(*) AS runs, count(*) FILTER (status = 'SUCCESS') AS successful FROM runs
  WHERE run_ts >= {_E} - INTERVAL 30 DAY GROUP BY ALL)
SELECT *, round(100.0::DOUBLE * successful / runs, 1) AS success_rate_pct FROM g""",
)
def mon_success_rate(spark, sf_dir):
    report = monitor.success_rate(derive(spark, sf_dir, "runs"), AS_OF_EVENTS)
    return report.withColumn("success_rate_pct", F.col("success_rate_pct").cast("double"))


@query(
    "mon_volume_trend",
    f"""{_RUNS} SELECT source_system, source_entity, max(rows_in) AS current_row_count,
  {_big('sum(rows_in)')} AS cumulative_ingested, count(*) AS total_loads, max(run_ts) AS last_load_time
FROM runs GROUP BY ALL""",
)
def mon_volume_trend(spark, sf_dir):
    return monitor.volume_trend(derive(spark, sf_dir, "runs"))


_META = "product_name, source_system, source_entity, load_id, timestamp"
_ALERTS = {
    "dq": f"""SELECT source_system || '_' || source_entity || '_' || load_id || '_DQ_FAILURE_RATE' AS alert_id,
  CASE WHEN rate > 50 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, 'DQ_FAILURE_RATE' AS alert_type,
  'High DQ failure rate: ' || printf('%.1f', round(rate, 1)) || '%' AS title,
  failed_rows || ' of ' || total_rows || ' rows failed DQ checks' AS message, {_META}
FROM (SELECT *, 100.0::DOUBLE * failed_rows / total_rows AS rate FROM line_loads) WHERE rate > 10""",
    "retry": f"""SELECT source_system || '_' || source_entity || '_' || load_id || '_RETRY_EXHAUSTION' AS alert_id,
  'CRITICAL' AS severity, 'RETRY_EXHAUSTION' AS alert_type,
  'Retries exhausted for ' || source_entity AS title,
  'Failed after ' || max_retries || ' retries. Last error: ' || substr(error, 1, 100) AS message, {_META}
FROM event_loads WHERE retry_count >= max_retries""",
    "slow": f"""SELECT source_system || '_' || source_entity || '_' || load_id || '_PERFORMANCE_DEGRADATION'
    AS alert_id, 'WARNING' AS severity, 'PERFORMANCE_DEGRADATION' AS alert_type,
  'Slow load: ' || printf('%.1f', round(duration_seconds, 1)) || 's (baseline: 300.0s)' AS title,
  'Load took ' || printf('%.1f', round(duration_seconds / 300, 1)) || 'x longer than expected' AS message,
  {_META} FROM event_loads WHERE duration_seconds > 600""",
}


def _shown(frame):
    return frame.drop("metadata")


@query("alert_dq_rate", ctes("line_loads") + _ALERTS["dq"])
def alert_dq_rate(spark, sf_dir):
    return _shown(alerts.dq_failure_rate(derive(spark, sf_dir, "line_loads")))


@query("alert_retry", ctes("event_loads") + _ALERTS["retry"])
def alert_retry(spark, sf_dir):
    return _shown(alerts.retry_exhaustion(derive(spark, sf_dir, "event_loads")))


@query("alert_slow", ctes("event_loads") + _ALERTS["slow"])
def alert_slow(spark, sf_dir):
    return _shown(alerts.slow_loads(derive(spark, sf_dir, "event_loads")))


def _all_alerts(spark, sf_dir):
    loads = derive(spark, sf_dir, "event_loads")
    return (
        alerts.dq_failure_rate(derive(spark, sf_dir, "line_loads"))
        .unionAll(alerts.retry_exhaustion(loads))
        .unionAll(alerts.slow_loads(loads))
    )


_UNION = (
    ctes("line_loads", "event_loads")
    + f", alerts AS ({_ALERTS['dq']} UNION ALL {_ALERTS['retry']} UNION ALL {_ALERTS['slow']})\n"
)


@query(
    "mon_critical_alerts",
    f"""{_UNION} SELECT alert_id, severity, alert_type, title, source_system, source_entity, timestamp,
  message FROM alerts WHERE severity IN ('CRITICAL', 'ERROR') AND timestamp >= {_L} - INTERVAL 7 DAY""",
)
def mon_critical_alerts(spark, sf_dir):
    return monitor.critical_alerts(_all_alerts(spark, sf_dir), AS_OF_LINES)


@query(
    "mon_retry_exhaustion",
    f"""{_UNION} SELECT alert_id, title, source_system, source_entity, timestamp, message FROM alerts
WHERE alert_type = 'RETRY_EXHAUSTION' AND timestamp >= {_E} - INTERVAL 7 DAY""",
)
def mon_retry_exhaustion(spark, sf_dir):
    return monitor.retry_exhaustion(_all_alerts(spark, sf_dir), AS_OF_EVENTS)


@query(
    "mon_alert_distribution",
    f"""{_UNION} SELECT severity, CAST(timestamp AS DATE) AS alert_date, count(*) AS alert_count FROM alerts
WHERE timestamp >= {_L} - INTERVAL 30 DAY GROUP BY ALL""",
)
def mon_alert_distribution(spark, sf_dir):
    return monitor.alert_distribution(_all_alerts(spark, sf_dir), AS_OF_LINES)


@query(
    "alert_any_critical",
    f"{_UNION} SELECT coalesce(bool_or(severity = 'CRITICAL'), false) AS has_critical FROM alerts",
)
def alert_any_critical(spark, sf_dir):
    return alerts.any_critical(_all_alerts(spark, sf_dir))


@query(
    "perf_metrics",
    f"""{ctes('executions')} SELECT query_name, duration_seconds, rows_processed, bytes_processed, recorded_at,
  bytes_processed / (1024.0::DOUBLE * 1024.0) / greatest(duration_seconds, 0.001) AS throughput_mbps
FROM executions WHERE duration_seconds > 30""",
)
def perf_metrics(spark, sf_dir):
    metrics = alerts.performance(derive(spark, sf_dir, "executions"))
    return alerts.slow_executions(metrics)


@query(
    "verify_latest_runs",
    f"""{_RUNS} SELECT run_id, source_system, source_entity, status, rows_in, rows_out, run_ts FROM runs
ORDER BY run_ts DESC, run_id LIMIT 50""",
)
def verify_latest_runs(spark, sf_dir):
    return verify.latest_runs(derive(spark, sf_dir, "runs"))


@query(
    "verify_latest_results",
    f"{_RESULTS} SELECT * FROM results ORDER BY run_ts DESC, run_id, dq_status, dq_failed_rule LIMIT 100",
)
def verify_latest_results(spark, sf_dir):
    return verify.latest_rule_results(derive(spark, sf_dir, "results"))


@query(
    "verify_latest_lifecycle",
    """SELECT 'web.' || user_id AS entity_id, event_type, ts AS event_ts FROM events
ORDER BY ts DESC, entity_id LIMIT 50""",
)
def verify_latest_lifecycle(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.concat(F.lit("web."), F.col("user_id").cast("string")).alias("entity_id"),
        "event_type",
        F.col("ts").alias("event_ts"),
    )
    return verify.latest_lifecycle(log)


@query(
    "verify_distinct_files",
    "SELECT count(DISTINCT url) AS distinct_files_picked FROM pages WHERE url LIKE '%/en/%'",
)
def verify_distinct_files(spark, sf_dir):
    return verify.distinct_files(table(spark, sf_dir, "pages"), "%/en/%", "url")


@query(
    "verify_rows_per_file",
    "SELECT url, count(*) AS rows_per_file FROM pages WHERE url LIKE '%/en/%' GROUP BY url",
)
def verify_rows_per_file(spark, sf_dir):
    return verify.rows_per_file(table(spark, sf_dir, "pages"), "%/en/%", "url")


@query(
    "advise_layout",
    """WITH n AS (SELECT 0 AS position, 'o_orderkey' AS c, count(DISTINCT o_orderkey) AS d FROM orders
UNION ALL SELECT 1, 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 2, 'o_totalprice', count(DISTINCT o_totalprice) FROM orders
UNION ALL SELECT 3, 'o_orderdate', count(DISTINCT o_orderdate) FROM orders
UNION ALL SELECT 4, 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders),
p AS (SELECT first(c ORDER BY position) AS c FROM n WHERE d BETWEEN 2 AND 1000),
z AS (SELECT array_to_string(list(c ORDER BY position)[1:3], ',') AS c FROM n WHERE d > 1000)
SELECT 'main.silver.orders' AS table_name, 'PARTITIONING' AS recommendation_type, c AS columns,
  'HIGH' AS priority FROM p WHERE c IS NOT NULL
UNION ALL SELECT 'main.silver.orders', 'Z_ORDER', c, 'MEDIUM' FROM z WHERE c <> ''
UNION ALL SELECT 'main.silver.orders', 'STATISTICS', NULL, 'MEDIUM'""",
)
def advise_layout(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return advisor.advise(orders, "main.silver.orders", columns).drop("implementation")
