"""Schemas of the control and audit tables, and the column names the layers add."""

# Column names and types of the control tables.
SOURCE_REGISTRY = """
tenant string, brand string, region string, product_area string, product_name string,
source_system string, source_entity string, source_type string, source_format string,
source_path string, jdbc_profile string, jdbc_table string, api_profile string,
api_endpoint string, api_method string, api_query_params_json string, load_type string,
watermark_column string, landing_table string, conformance_table string, silver_table string,
primary_key string, publish_mode string, is_active boolean, source_options_json string,
pre_landing_transform_notebook string, post_conformance_transform_notebook string,
custom_publish_notebook string, scheduler_name string, schedule_cron string,
retention_days int, sttm_profile string, landing_table_type string, landing_table_path string,
conformance_table_type string, conformance_table_path string, silver_table_type string,
silver_table_path string
"""

COLUMN_MAPPING = """
tenant string, brand string, product_name string, source_system string, source_entity string,
source_column string, landing_column string, conformance_column string, silver_column string,
source_type_name string, target_type_name string, nullable_flag boolean, default_value string,
transform_expression string, is_active boolean
"""

DQ_RULES = """
tenant string, brand string, product_name string, source_system string, source_entity string,
column_name string, rule_name string, rule_type string, rule_expression string,
severity string, on_violation string, is_active boolean
"""

PUBLISH_RULES = """
tenant string, brand string, product_name string, source_system string, source_entity string,
silver_table string, publish_mode string, merge_key string, sequence_column string,
delete_handling string, schema_evolution_flag boolean, optimize_zorder_json string,
partition_columns_json string
"""

CONTROL_TABLES = {
    "source_registry": SOURCE_REGISTRY,
    "column_mapping": COLUMN_MAPPING,
    "dq_rules": DQ_RULES,
    "publish_rules": PUBLISH_RULES,
}

# Column names and types of the audit tables.
PIPELINE_RUNS = """
pipeline_name string, run_id string, source_system string, source_entity string,
rows_in bigint, rows_out bigint, status string, error_message string, run_ts timestamp
"""

DQ_RULE_RESULTS = """
run_id string, source_system string, source_entity string, dq_status string,
dq_failed_rule string, row_count bigint, run_ts timestamp
"""

BRONZE_DQ_RESULTS = """
run_id string, source_system string, source_entity string, validation_type string,
validation_status string, error_details string, timestamp timestamp
"""

VALIDATION_EVENTS = """
run_id string, source_system string, source_entity string, event_name string,
event_status string, event_payload string, event_ts timestamp
"""

REJECTS = """
run_id string, source_system string, source_entity string, rejected_ts timestamp,
dq_status string, dq_failed_rule string, payload_json string
"""

ENTITY_LIFECYCLE_LOG = """
entity_id string, event_type string, event_details string, user string, event_ts timestamp
"""

ALERTS = """
alert_id string, severity string, alert_type string, title string, message string,
product_name string, source_system string, source_entity string, load_id string,
timestamp timestamp, metadata string
"""

PERFORMANCE_METRICS = """
query_name string, duration_seconds double, rows_processed bigint, bytes_processed bigint,
throughput_mbps double
"""

AUDIT_TABLES = {
    "pipeline_runs": PIPELINE_RUNS,
    "dq_rule_results": DQ_RULE_RESULTS,
    "bronze_dq_results": BRONZE_DQ_RESULTS,
    "validation_events": VALIDATION_EVENTS,
    "rejects": REJECTS,
    "entity_lifecycle_log": ENTITY_LIFECYCLE_LOG,
    "alerts": ALERTS,
    "performance_metrics": PERFORMANCE_METRICS,
}

# Headers each control file must carry.
REQUIRED_HEADERS = {
    "source_registry": [
        "tenant", "brand", "product_name", "source_system", "source_entity", "source_type",
        "load_type", "landing_table", "conformance_table", "silver_table", "publish_mode",
        "is_active",
    ],
    "column_mapping": [
        "tenant", "brand", "product_name", "source_system", "source_entity",
        "conformance_column", "transform_expression", "is_active",
    ],
    "dq_rules": [
        "tenant", "brand", "product_name", "source_system", "source_entity", "rule_name",
        "rule_expression", "is_active",
    ],
    "publish_rules": [
        "tenant", "brand", "product_name", "source_system", "source_entity", "publish_mode",
        "silver_table",
    ],
}

# Columns the layers add to the data.
BRONZE_COLUMNS = ["bronze_dq_status", "bronze_dq_failed_check"]
RULE_COLUMNS = ["dq_status", "dq_failed_rule", "dq_warn_rule"]
LANDING_COLUMNS = ["source_system", "source_entity", "load_id", "ingest_ts"]
FRAMEWORK_COLUMNS = [
    "source_system", "source_entity", "load_id", "ingest_ts", "bronze_dq_status",
    "bronze_dq_failed_check", "dq_status", "dq_failed_rule",
]
STREAM_COLUMNS = [
    "_ingestion_ts", "_source_file", "_source_path", "_source_id", "_source_format",
    "_autoloader_format", "_metadata_source_name",
]
