"""Control metadata: selection, validation and per-source plans."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stratiform.operators import verify
from stratiform.plans import control
from stratiform.queries.inputs import ctes, derive
from stratiform.queries.registry import query
from stratiform.session import new_folder


def _frames(spark, sf_dir, *names):
    return [derive(spark, sf_dir, n) for n in names]


@query(
    "control_active_sources",
    f"""{ctes('registry')} SELECT product_name, source_system, source_entity FROM registry
WHERE lower(is_active) = 'true' AND product_name = 'building' AND source_system = 'sys3'""",
)
def control_active_sources(spark, sf_dir):
    registry = derive(spark, sf_dir, "registry")
    chosen = control.select_sources(registry, product_name=" Building ", source_system="SYS3", source_entity="")
    return chosen.select("product_name", "source_system", "source_entity")


_META = f"""{ctes('registry', 'mappings', 'rules', 'publish')},
m AS (SELECT source_system, source_entity, count(*) AS n FROM mappings WHERE lower(is_active) = 'true'
  GROUP BY ALL),
r AS (SELECT source_system, source_entity, count(*) AS n FROM rules WHERE lower(is_active) = 'true'
  GROUP BY ALL),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_system, source_entity
  ORDER BY ordinal) AS rn FROM publish) WHERE rn = 1),
a AS (SELECT * FROM registry WHERE lower(is_active) = 'true')
"""
_ON = "USING (source_system, source_entity)"


@query(
    "control_entity_metadata",
    f"""{_META} SELECT a.product_name, source_system, source_entity, coalesce(m.n, 0) AS mapping_count,
  coalesce(r.n, 0) AS dq_rule_count, p.ordinal IS NOT NULL AS publish_rule_found,
  p.publish_mode AS publish_rule_mode FROM a LEFT JOIN m {_ON} LEFT JOIN r {_ON} LEFT JOIN p {_ON}""",
)
def control_entity_metadata(spark, sf_dir):
    return control.entity_metadata(*_frames(spark, sf_dir, "registry", "mappings", "rules", "publish"))


@query(
    "control_row_counts",
    f"""{ctes('registry', 'mappings', 'rules', 'publish')}
SELECT 'source_registry' AS table_name, count(*) AS row_count FROM registry
UNION ALL SELECT 'column_mapping', count(*) FROM mappings
UNION ALL SELECT 'dq_rules', count(*) FROM rules UNION ALL SELECT 'publish_rules', count(*) FROM publish""",
)
def control_row_counts(spark, sf_dir):
    names = ["source_registry", "column_mapping", "dq_rules", "publish_rules"]
    frames = _frames(spark, sf_dir, "registry", "mappings", "rules", "publish")
    return verify.table_counts(dict(zip(names, frames)))


@query(
    "control_bootstrap",
    f"""{ctes('registry', 'mappings', 'rules', 'publish')}
SELECT 'source_registry' AS table_name, count(*) AS row_count FROM registry
UNION ALL SELECT 'column_mapping', count(*) FROM mappings
UNION ALL SELECT 'dq_rules', count(*) FROM rules UNION ALL SELECT 'publish_rules', count(*) FROM publish""",
)
def control_bootstrap(spark, sf_dir):
    """Control files are written, tables made from them, and these are counted."""
    folder, schema = new_folder(spark, "control-files"), f"control_{uuid.uuid4().hex}"
    names = ["source_registry", "column_mapping", "dq_rules", "publish_rules"]
    for name, frame in zip(names, _frames(spark, sf_dir, "registry", "mappings", "rules", "publish")):
        frame.write.options(header="true", escape='"').csv(f"{folder}/{name}.csv")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{new_folder(spark, 'control-tables')}'")
    control.bootstrap(spark, folder, f"spark_catalog.{schema}")
    return verify.table_counts({name: spark.table(f"spark_catalog.{schema}.{name}") for name in names})


@query(
    "control_missing_headers",
    f"""{ctes('registry', 'rules')} SELECT 'source_registry' AS table_name, unnest(['is_active', 'load_type']) AS missing,
  (SELECT count(*) FROM registry) AS row_count
UNION ALL SELECT 'dq_rules', unnest(['brand', 'product_name', 'rule_name', 'tenant']), (SELECT count(*) FROM rules)""",
)
def control_missing_headers(spark, sf_dir):
    """Headers that control files lack, with the number of rows that this concerns. The derived rules
    hold no tenant, brand and product; the other headers are taken away here."""
    registry, rules = _frames(spark, sf_dir, "registry", "rules")
    report = None
    for name, frame in (("source_registry", registry.drop("is_active", "load_type")), ("dq_rules", rules.drop("rule_name"))):
        lost = F.explode(F.array(*[F.lit(h) for h in control.missing_headers(frame, name)])).alias("missing")
        part = frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), lost, "row_count")
        report = part if report is None else report.unionByName(part)
    return report


def _error_sql(source: str, tests: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {bad} THEN '{text}' END" for bad, text in tests)
    return f"""SELECT source_system, source_entity, error FROM (
  SELECT source_system, source_entity, unnest([{cases}]) AS error FROM {source}) WHERE error IS NOT NULL"""


_TYPE = "coalesce(nullif(lower(silver_table_type), ''), 'managed')"
_OPTIONS = "source_options_json"
_REGISTRY_TESTS = [
    ("lower(is_active) NOT IN ('true', 'false')", "is_active must be true|false"),
    ("upper(source_type) NOT IN ('FILE', 'JDBC', 'API', 'CUSTOM')",
     "source_type must be FILE|JDBC|API|CUSTOM"),
    ("lower(load_type) NOT IN ('full', 'incremental')", "load_type must be full|incremental"),
    ("lower(publish_mode) NOT IN ('append', 'merge')", "publish_mode must be append|merge"),
    (f"{_TYPE} NOT IN ('managed', 'external')", "silver_table_type must be managed|external"),
    (f"{_TYPE} = 'external' AND silver_table_path = ''",
     "silver_table_path is required for external tables"),
    (f"{_TYPE} = 'external' AND starts_with(silver_table_path, 'dbfs:/mnt/')",
     "silver_table_path must not be a legacy mount path"),
    ("source_type = 'FILE' AND source_path = ''", "source_path is required for FILE sources"),
    ("source_type = 'JDBC' AND jdbc_table = ''", "jdbc_table is required for JDBC sources"),
    ("source_type = 'API' AND trim(api_endpoint) = ''", "api_endpoint is required for API sources"),
    ("source_type = 'FILE' AND starts_with(source_path, '/mnt/')",
     "source_path must not be a legacy mount path"),
    (f"{_OPTIONS} <> '' AND NOT json_valid({_OPTIONS})", f"invalid {_OPTIONS}"),
    (f"{_OPTIONS} <> '' AND json_valid({_OPTIONS}) AND json_type(try_cast({_OPTIONS} AS JSON)) <> 'OBJECT'",
     f"{_OPTIONS} must be a JSON object"),
]


@query("validate_registry", ctes("registry") + _error_sql("registry", _REGISTRY_TESTS))
def validate_registry(spark, sf_dir):
    return control.registry_errors(derive(spark, sf_dir, "registry"))


def _list_tests(cell: str) -> list[tuple[str, str]]:
    return [
        (f"{cell} <> '' AND NOT json_valid({cell})", f"invalid {cell}"),
        (f"{cell} <> '' AND json_valid({cell}) AND json_type(try_cast({cell} AS JSON)) <> 'ARRAY'",
         f"{cell} must be a JSON array"),
    ]


@query(
    "validate_publish",
    ctes("publish")
    + _error_sql(
        "publish",
        [
            ("lower(publish_mode) NOT IN ('append', 'merge')", "publish_mode must be append|merge"),
            ("lower(publish_mode) = 'merge' AND merge_key = ''",
             "merge_key is required when publish_mode=merge"),
            *_list_tests("optimize_zorder_json"),
            *_list_tests("partition_columns_json"),
        ],
    ),
)
def validate_publish(spark, sf_dir):
    return control.publish_errors(derive(spark, sf_dir, "publish"))


@query(
    "validate_rules",
    ctes("rules")
    + ", live AS (SELECT * FROM rules WHERE lower(is_active) = 'true')\n"
    + _error_sql(
        "live",
        [
            ("trim(rule_name) = ''", "rule_name is required"),
            ("trim(rule_expression) = ''", "rule_expression is required"),
            ("lower(severity) NOT IN ('high', 'warn')", "severity must be ERROR|WARN"),
        ],
    )
    + """ UNION ALL SELECT source_system, source_entity, 'duplicate rule_name: ' || rule_name FROM live
GROUP BY source_system, source_entity, rule_name HAVING count(*) > 1""",
)
def validate_rules(spark, sf_dir):
    return control.rule_errors(derive(spark, sf_dir, "rules"))


@query(
    "validate_mappings",
    ctes("mappings")
    + ", live AS (SELECT * FROM mappings WHERE lower(is_active) = 'true')\n"
    + _error_sql(
        "live",
        [
            ("transform_expression = ''", "transform_expression is required"),
            ("conformance_column = ''", "conformance_column is required"),
        ],
    )
    + """ UNION ALL SELECT source_system, source_entity,
  'duplicate conformance_column: ' || conformance_column FROM live
GROUP BY source_system, source_entity, conformance_column HAVING count(*) > 1""",
)
def validate_mappings(spark, sf_dir):
    return control.mapping_errors(derive(spark, sf_dir, "mappings"))


def _lost(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS table_name, source_system, source_entity, count(*) AS row_count
FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.source_system = s.source_system
  AND r.source_entity = s.source_entity) GROUP BY source_system, source_entity"""


@query(
    "validate_references",
    ctes("registry", "mappings", "rules", "publish")
    + " UNION ALL ".join(
        [_lost("column_mapping", "mappings"), _lost("dq_rules", "rules"), _lost("publish_rules", "publish")]
    ),
)
def validate_references(spark, sf_dir):
    registry, mappings, rules, publish = _frames(
        spark, sf_dir, "registry", "mappings", "rules", "publish"
    )
    return control.reference_errors(
        registry, column_mapping=mappings, dq_rules=rules, publish_rules=publish
    )


@query(
    "target_resolution",
    f"""{ctes('registry', 'publishers')} SELECT source_system, source_entity,
  coalesce(nullif(trim(silver_catalog_name), ''), 'main') || '.'
  || coalesce(nullif(trim(silver_db_name), ''), 'silver') || '.'
  || coalesce(nullif(trim(silver_object_name), ''), nullif(trim(silver_file_name), ''),
     replace(source_entity, '#', '_')) AS silver_target
FROM registry LEFT JOIN publishers USING (publisher_name)""",
)
def target_resolution(spark, sf_dir):
    registry, publishers = _frames(spark, sf_dir, "registry", "publishers")
    return control.target_table(registry, publishers).select(
        "source_system", "source_entity", "silver_target"
    )


@query(
    "publish_plan",
    f"""{_META}, q AS (SELECT source_system, source_entity,
  lower(coalesce(nullif(p.publish_mode, ''), a.publish_mode)) AS mode,
  coalesce(nullif(p.merge_key, ''), nullif(a.primary_key, '')) AS mkey,
  CASE WHEN json_type(try_cast(nullif(partition_columns_json, '') AS JSON)) = 'ARRAY'
    THEN 'day,region' ELSE '' END AS parts,
  CASE WHEN optimize_zorder_json = '["id"]' THEN 'id' ELSE '' END AS zorder
  FROM a LEFT JOIN p {_ON})
SELECT source_system, source_entity, mode AS publish_mode, CASE WHEN mode = 'merge' THEN mkey END
  AS merge_key, parts AS partition_columns, zorder AS zorder_columns,
  CASE WHEN mode NOT IN ('append', 'merge') THEN 'unsupported publish mode: ' || mode
    WHEN mode = 'merge' AND mkey IS NULL THEN 'missing merge key' END AS plan_error FROM q""",
)
def publish_plan(spark, sf_dir):
    plan = control.publish_plan(*_frames(spark, sf_dir, "registry", "publish"))
    lists = {c: F.array_join(c, ",") for c in ("partition_columns", "zorder_columns")}
    return plan.withColumns(lists)


@query(
    "dry_run_plan",
    f"""{_META} SELECT source_system || '.' || source_entity AS source,
  concat_ws(' > ', 'ingest via ' || source_type, 'write landing ' || landing_table,
    'apply ' || coalesce(m.n, 0) || ' mappings', 'apply ' || coalesce(r.n, 0) || ' dq rules',
    'publish ' || a.publish_mode || ' to ' || silver_table) AS steps,
  CASE a.primary_key WHEN 'id, line ,id' THEN 'id,line' ELSE a.primary_key END AS primary_key_columns,
  a.primary_key <> '' AS primary_key_configured FROM a LEFT JOIN m {_ON} LEFT JOIN r {_ON}""",
)
def dry_run_plan(spark, sf_dir):
    plan = control.dry_run(*_frames(spark, sf_dir, "registry", "mappings", "rules", "publish"))
    return plan.withColumns(
        {
            "steps": F.array_join("steps", " > "),
            "primary_key_columns": F.array_join("primary_key_columns", ","),
        }
    )
