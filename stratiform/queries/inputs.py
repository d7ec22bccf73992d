"""Control and audit tables derived from the given tables.

Each text is plain SQL that both engines understand: the query runs it as a frame, its oracle as
a common table expression, so both start from the same rows.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from stratiform.queries.registry import table

AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_LINES = "2001-06-01 00:00:00"

SQL = {
    "runs": """
SELECT 'nightly' AS pipeline_name, CAST(event_id AS STRING) AS run_id,
  'sys' || CAST(user_id % 5 AS STRING) AS source_system,
  'entity' || CAST(user_id AS STRING) AS source_entity,
  CAST(floor(value * 10) AS BIGINT) AS rows_in,
  CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT)
       ELSE CAST(floor(value * 10) AS BIGINT) - CAST(floor(value) AS BIGINT) END AS rows_out,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN event_type = 'error' THEN 'step failed with ' || props END AS error_message,
  ts AS run_ts
FROM {events}""",
    "results": """
SELECT CAST(event_id AS STRING) AS run_id, 'sys' || CAST(user_id % 5 AS STRING) AS source_system,
  'entity' || CAST(user_id AS STRING) AS source_entity, 'PASS' AS dq_status,
  CAST(NULL AS STRING) AS dq_failed_rule, CAST(floor(value * 10) AS BIGINT) AS row_count, ts AS run_ts
FROM {events}
UNION ALL
SELECT CAST(event_id AS STRING), 'sys' || CAST(user_id % 5 AS STRING),
  'entity' || CAST(user_id AS STRING), 'FAIL',
  CASE event_type WHEN 'click' THEN 'amount_positive'
    WHEN 'purchase' THEN 'amount_positive,status_known' ELSE 'primary_key_unique' END,
  CASE WHEN event_type IN ('error', 'signup') THEN CAST(0 AS BIGINT) ELSE CAST(floor(value) AS BIGINT) END, ts
FROM {events}""",
    "checks": """
SELECT CAST(event_id AS STRING) AS run_id, 'sys' || CAST(user_id % 5 AS STRING) AS source_system,
  'entity' || CAST(user_id AS STRING) AS source_entity,
  CASE WHEN event_type IN ('view', 'click') THEN 'null_threshold:value' ELSE 'volume' END
    AS validation_type,
  CASE WHEN value > 100 THEN 'FAIL' ELSE 'PASS' END AS validation_status,
  props AS error_details, ts AS timestamp
FROM {events}""",
    "stage_log": """
SELECT CAST(event_id AS STRING) AS run_id, 'sys' || CAST(user_id % 5 AS STRING) AS source_system,
  'entity' || CAST(user_id AS STRING) AS source_entity, event_type AS event_name,
  CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS event_status,
  props AS event_payload, ts AS event_ts
FROM {events}""",
    "rejects": """
SELECT CAST(l_orderkey AS STRING) AS run_id, 'line' || l_linestatus AS source_system,
  'flag' || l_returnflag AS source_entity, l_shipdate AS rejected_ts, 'FAIL' AS dq_status,
  CASE WHEN l_discount > 0.05 AND l_quantity > 40 THEN 'discount_limit,quantity_limit'
       WHEN l_discount > 0.05 THEN 'discount_limit' ELSE 'quantity_limit' END AS dq_failed_rule
FROM {lineitem} WHERE l_discount > 0.05 OR l_quantity > 40""",
    "line_loads": """
SELECT 'orders' AS product_name, 'erp' AS source_system,
  'order' || CAST(l_orderkey AS STRING) AS source_entity, CAST(l_orderkey AS STRING) AS load_id,
  count(*) AS total_rows,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS failed_rows,
  max(l_shipdate) AS timestamp
FROM {lineitem} GROUP BY l_orderkey""",
    "event_loads": """
SELECT 'clicks' AS product_name, 'web' AS source_system,
  'entity' || CAST(user_id AS STRING) AS source_entity, CAST(event_id AS STRING) AS load_id,
  CAST(floor(value / 50) AS INT) AS retry_count, 3 AS max_retries,
  'request failed with ' || props || repeat(' and again', 12) AS error,
  value * 10 AS duration_seconds, ts AS timestamp
FROM {events}""",
    "executions": """
SELECT event_type || '-' || CAST(user_id AS STRING) AS query_name, value AS duration_seconds,
  event_id AS rows_processed, event_id * 4096 AS bytes_processed, ts AS recorded_at
FROM {events}""",
    "stages": """
SELECT CAST(l_orderkey AS STRING) AS run_id, l_linenumber AS stage_sequence,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'CHECKPOINT_SAVED'
    WHEN l_returnflag = 'A' THEN 'SUCCESS' WHEN l_returnflag = 'N' THEN 'IN_PROGRESS' ELSE 'FAILED' END AS state,
  l_shipdate AS event_ts
FROM {lineitem}""",
    "registry": """
SELECT 'tenant' || CAST(c_nationkey AS STRING) AS tenant, 'brand' AS brand,
  lower(c_mktsegment) AS product_name, 'sys' || CAST(c_custkey % 7 AS STRING) AS source_system,
  c_name AS source_entity,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'FILE' WHEN 'BUILDING' THEN 'JDBC'
    WHEN 'FURNITURE' THEN 'API' WHEN 'HOUSEHOLD' THEN 'custom' ELSE 'FTP' END AS source_type,
  CASE WHEN c_acctbal < 1000 THEN '' WHEN c_acctbal < 1500 THEN '/mnt/raw/' || c_name
    ELSE 's3://raw/' || c_name END AS source_path,
  CASE WHEN c_acctbal < 0 THEN '' ELSE 'dbo.' || c_name END AS jdbc_table,
  CASE WHEN c_acctbal < 500 THEN ' ' ELSE '/v1/' || c_name END AS api_endpoint,
  CASE WHEN c_acctbal < 0 THEN 'delta' WHEN c_acctbal < 4000 THEN 'full' ELSE 'Incremental' END
    AS load_type,
  'main.bronze.' || replace(c_name, '#', '_') || '_landing' AS landing_table,
  'main.bronze.' || replace(c_name, '#', '_') AS conformance_table,
  'main.silver.' || replace(c_name, '#', '_') AS silver_table,
  CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 10 THEN 'id' ELSE 'id, line ,id' END
    AS primary_key,
  CASE WHEN c_acctbal > 9500 THEN 'replace' WHEN c_acctbal > 5000 THEN 'merge' ELSE 'append' END
    AS publish_mode,
  CASE WHEN c_acctbal > 9000 THEN 'maybe' WHEN c_acctbal > 1000 THEN 'TRUE' ELSE 'false' END
    AS is_active,
  CASE WHEN c_nationkey = 3 THEN '[1]' WHEN c_nationkey = 4 THEN '{{oops'
    WHEN c_nationkey = 5 THEN '' ELSE '{{"header":true}}' END AS source_options_json,
  CASE WHEN c_nationkey < 3 THEN 'External' WHEN c_nationkey = 10 THEN 'view' ELSE '' END
    AS silver_table_type,
  CASE WHEN c_nationkey = 1 THEN 's3://silver/t' WHEN c_nationkey = 2 THEN 'dbfs:/mnt/t' ELSE ''
    END AS silver_table_path,
  'pub' || CAST(c_nationkey AS STRING) AS publisher_name,
  CASE WHEN c_acctbal > 8000 THEN 'object_' || c_name ELSE ' ' END AS silver_object_name,
  CASE WHEN c_acctbal > 7000 THEN 'file_' || c_name END AS silver_file_name
FROM {customer}""",
    "publishers": """
SELECT CASE n_regionkey WHEN 0 THEN 'other' ELSE 'pub' END || CAST(n_nationkey AS STRING) AS publisher_name,
  CASE WHEN n_regionkey > 1 THEN 'region' || CAST(n_regionkey AS STRING) ELSE '' END
    AS silver_catalog_name,
  CASE WHEN n_regionkey > 2 THEN lower(n_name) END AS silver_db_name
FROM {nation}""",
    "mappings": """
SELECT 'sys' || CAST((o_custkey + 100) % 7 AS STRING) AS source_system,
  'Customer#' || lpad(CAST(o_custkey + 100 AS STRING), 9, '0') AS source_entity,
  CASE WHEN o_totalprice < 20000 THEN '' ELSE 'src_' || o_orderstatus END AS transform_expression,
  lower(o_orderpriority) AS conformance_column,
  CASE o_orderstatus WHEN 'P' THEN 'false' ELSE 'true' END AS is_active
FROM {orders}""",
    "rules": """
SELECT 'sys' || CAST(l_partkey % 7 AS STRING) AS source_system,
  'Customer#' || lpad(CAST(l_partkey AS STRING), 9, '0') AS source_entity,
  'rule_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_suppkey AS STRING) AS rule_name,
  CASE WHEN l_quantity < 2 THEN ' ' ELSE 'qty > 0' END AS rule_expression,
  CASE l_returnflag WHEN 'A' THEN 'high' WHEN 'N' THEN 'WARN' ELSE 'fatal' END AS severity,
  CASE l_linestatus WHEN 'F' THEN 'true' ELSE 'FALSE' END AS is_active
FROM {lineitem}""",
    "publish": """
SELECT o_orderkey AS ordinal, 'sys' || CAST(o_custkey % 7 AS STRING) AS source_system,
  'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS source_entity,
  CASE o_orderstatus WHEN 'F' THEN 'Merge' WHEN 'O' THEN 'append' ELSE '' END AS publish_mode,
  CASE WHEN o_totalprice < 250000 THEN '' ELSE 'order_id' END AS merge_key,
  CASE o_orderpriority WHEN '1-URGENT' THEN '["id"]' WHEN '2-HIGH' THEN '[]'
    WHEN '3-MEDIUM' THEN 'id,name' WHEN '5-LOW' THEN '{{"a":1}}' ELSE '' END AS optimize_zorder_json,
  CASE o_orderpriority WHEN '5-LOW' THEN '["day","region"]' ELSE '' END AS partition_columns_json
FROM {orders}""",
    "bodies": """
SELECT event_id, CASE event_type
  WHEN 'click' THEN '[{{"id":' || CAST(event_id AS STRING) || ',"v":"a"}},{{"id":'
    || CAST(user_id AS STRING) || ',"v":"b"}}]'
  WHEN 'view' THEN '{{"data":"none","items":[{{"id":' || CAST(user_id AS STRING) || ',"v":"c"}}]}}'
  WHEN 'purchase' THEN '{{"id":' || CAST(event_id AS STRING) || ',"v":"solo"}}'
  WHEN 'signup' THEN '{{"data":[' || CAST(event_id AS STRING) || ',' || CAST(user_id AS STRING) || ']}}'
  ELSE 'error ' || props END AS body, event_type, user_id
FROM {events}""",
    "json_files": """
SELECT c_nationkey, CASE WHEN c_acctbal < 3000
    THEN '[{{"id":' || CAST(c_custkey AS STRING) || ',"name":"' || c_name || '"}},' || chr(10)
      || '{{"id":-1}}]'
  WHEN c_acctbal < 6000 THEN '{{"id":' || CAST(c_custkey AS STRING) || ',' || chr(10) || '"name":"' || c_name
      || '"}}'
  ELSE '{{"id":' || CAST(c_custkey AS STRING) || ',"name":"' || c_name || '"}}' || chr(10) || chr(10)
      || '{{"id":-2,"name":"' || c_mktsegment || '"}}' || chr(10) END AS body, c_custkey, c_name,
  c_mktsegment, c_acctbal
FROM {customer}""",
    "json_shapes": """
SELECT c_custkey, CASE pmod(c_custkey, 7)
  WHEN 0 THEN '[{{"id":' || CAST(c_custkey AS STRING) || ',"name":"' || c_name || '"}},' || chr(10) || '{{"id":-1}}]'
  WHEN 1 THEN '{{"id":' || CAST(c_custkey AS STRING) || ',' || chr(10) || ' "name":"' || c_name || '"' || chr(10) || '}}'
  WHEN 2 THEN '{{"id":' || CAST(c_custkey AS STRING) || '}}{{"id":-2,"name":"' || c_name || '"}}'
  WHEN 3 THEN CAST(c_custkey AS STRING)
  WHEN 4 THEN '{{"id":' || CAST(c_custkey AS STRING) || ',"name":"' || c_name
  WHEN 5 THEN '{{"id":' || CAST(c_custkey AS STRING) || ',"x":{{"y":[{{}},"}}]{{"]}},"name":"' || c_mktsegment || '"}}'
  ELSE '[{{"id":' || CAST(c_custkey AS STRING) || '}},{{"id":-3}},{{"id":-4,"name":"a"}}]' END AS body
FROM {customer}""",
    "json_lines": """
SELECT '{{"event_id":' || CAST(event_id AS STRING) || ',"event_type":"' || event_type || '",'
  || substr(props, 2) AS line
FROM {events}""",
    "api_pages": """
SELECT CAST(l_orderkey AS STRING) AS source_id, CAST(l_linenumber AS BIGINT) AS page_offset,
  CASE WHEN l_quantity < 3 THEN 0 ELSE 1 END AS page_records, CAST(l_suppkey AS STRING) AS next_token
FROM {lineitem}""",
}


def _tables(name: str) -> list[str]:
    return sorted({f for _, f, _, _ in string.Formatter().parse(SQL[name]) if f})


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    frames = {t: table(spark, sf_dir, t) for t in _tables(name)}
    return spark.sql(SQL[name], **frames)


def ctes(*names: str) -> str:
    """``WITH`` clause that defines the inputs for an oracle."""
    parts = [f"{n} AS ({SQL[n].format(**{t: t for t in _tables(n)})})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
