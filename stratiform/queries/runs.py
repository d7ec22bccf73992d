"""Whole-source runs and their audit rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stratiform.operators import audit, bronze, conform, landing, rules
from stratiform.plans import flow, resume
from stratiform.plans.flow import SourceSpec
from stratiform.queries.inputs import ctes, derive
from stratiform.queries.registry import query, table
from stratiform.sources import jdbc
from stratiform.session import new_folder
from stratiform.streaming import files as streams

TS = "2024-02-01 00:00:00"
RUN = audit.RunKey("run-1", "erp", "orders", TS)


def _no_reader(_):
    raise RuntimeError("the frame is given")


def _spec(system: str, entity: str, **more) -> SourceSpec:
    return SourceSpec(
        system, entity, _no_reader, "main.bronze.landing", "main.bronze.conformed", "main.silver.t", **more
    )


ORDERS = _spec(
    "erp",
    "orders",
    checks={
        "non_nullable_columns": ["o_custkey"],
        "allowed_values": {"o_orderstatus": ["O", "F"]},
        "regex_patterns": {"o_orderpriority": "^[1-5]-"},
        "range_constraints": {"o_totalprice": {"min": 1500}},
    },
    mappings=[
        {"transform_expression": "o_orderkey", "conformance_column": "order_id"},
        {"transform_expression": "o_custkey", "conformance_column": "customer_id"},
        {"transform_expression": "lower(trim(o_orderstatus))", "conformance_column": "status"},
        {"transform_expression": "cast(o_totalprice as decimal(12,2))", "conformance_column": "amount"},
        {"transform_expression": "to_date(o_orderdate)", "conformance_column": "order_day"},
        {"transform_expression": "o_orderpriority", "conformance_column": "priority"},
    ],
    rules=[
        {"rule_name": "amount_limit", "rule_expression": "amount <= 400000", "severity": "high"},
        {"rule_name": "urgent_is_open", "rule_expression": "priority <> '1-URGENT' OR status = 'o'",
         "severity": "medium"},
        {"rule_name": "recent", "rule_expression": "order_day >= date'1996-01-01'", "severity": "low"},
    ],
    primary_key="customer_id, order_day",
)
_FLOW = """raw AS (SELECT *, o_orderstatus NOT IN ('O', 'F') OR o_totalprice < 1500 AS bad FROM orders),
conformed AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, lower(trim(o_orderstatus)) AS status,
  CAST(o_totalprice AS DECIMAL(12, 2)) AS amount, CAST(o_orderdate AS DATE) AS order_day,
  o_orderpriority AS priority FROM raw WHERE NOT bad),
named AS (SELECT *, nullif(concat_ws(',',
    CASE WHEN count(*) OVER (PARTITION BY customer_id, order_day) > 1 THEN 'primary_key_unique' END,
    CASE WHEN amount > 400000 THEN 'amount_limit' END,
    CASE WHEN NOT (priority <> '1-URGENT' OR status = 'o') THEN 'urgent_is_open' END), '')
    AS dq_failed_rule,
  CASE WHEN order_day < DATE '1996-01-01' THEN 'recent' END AS dq_warn_rule FROM conformed),
checked AS (SELECT *, CASE WHEN dq_failed_rule IS NULL THEN 'PASS' ELSE 'FAIL' END AS dq_status FROM named)
"""


@query(
    "flow_orders",
    f"""WITH {_FLOW} SELECT 'run-1' AS run_id, 'erp' AS source_system, 'orders' AS source_entity, dq_status,
  dq_failed_rule, count(*) AS row_count, TIMESTAMP '{TS}' AS run_ts FROM checked
GROUP BY dq_status, dq_failed_rule""",
)
def flow_orders(spark, sf_dir):
    """Flagship: raw checks, mapping, key and business rules, summarized for the audit table."""
    return flow.summarize(table(spark, sf_dir, "orders"), ORDERS, RUN)


@query(
    "flow_rows",
    f"""WITH {_FLOW} SELECT order_id, customer_id, status, amount, order_day, priority, dq_status,
  dq_failed_rule, dq_warn_rule FROM checked""",
)
def flow_rows(spark, sf_dir):
    return flow.checked_frame(table(spark, sf_dir, "orders"), ORDERS)


LINE_RULES = [
    {"rule_name": "quantity_limit", "rule_expression": "l_quantity <= 40"},
    {"rule_name": "discount_limit", "rule_expression": "l_discount <= 0.05"},
]
_LINES = """named AS (SELECT *, nullif(concat_ws(',', CASE WHEN l_quantity > 40 THEN 'quantity_limit' END,
    CASE WHEN l_discount > 0.05 THEN 'discount_limit' END), '') AS dq_failed_rule FROM lineitem),
checked AS (SELECT *, CASE WHEN dq_failed_rule IS NULL THEN 'PASS' ELSE 'FAIL' END AS dq_status FROM named)
"""


@query(
    "dq_rule_summary",
    f"""WITH {_LINES} SELECT 'run-1' AS run_id, 'erp' AS source_system, 'orders' AS source_entity,
  dq_status, dq_failed_rule, count(*) AS row_count, TIMESTAMP '{TS}' AS run_ts FROM checked
GROUP BY dq_status, dq_failed_rule""",
)
def dq_rule_summary(spark, sf_dir):
    return audit.rule_summary(rules.apply(table(spark, sf_dir, "lineitem"), LINE_RULES), RUN)


@query(
    "reject_envelope",
    f"""WITH {_LINES} SELECT 'run-1' AS run_id, 'erp' AS source_system, 'orders' AS source_entity,
  TIMESTAMP '{TS}' AS rejected_ts, dq_status, dq_failed_rule, '{{"l_orderkey":' || l_orderkey
  || ',"l_linenumber":' || l_linenumber || ',"l_returnflag":"' || l_returnflag || '"}}' AS payload_json
FROM checked WHERE dq_status = 'FAIL'""",
)
def reject_envelope(spark, sf_dir):
    checked = rules.apply(table(spark, sf_dir, "lineitem"), LINE_RULES)
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "dq_status", "dq_failed_rule"]
    return audit.rejects(rules.failed(checked).select(*columns), RUN)


def _flow_counts(spark, sf_dir, appends: int = 1):
    """Layer counts of the orders flow, each counted in what was really written; silver is appended to
    ``appends`` times, as a run that is not guarded against repeats would."""
    raw = table(spark, sf_dir, "orders")
    place = new_folder(spark, "flow-counts")
    landing.add_metadata(bronze.annotate(raw, ORDERS.checks), "erp", "orders", "run-1", TS).write.parquet(f"{place}/landed")
    landed = spark.read.parquet(f"{place}/landed")
    conformed = conform.apply(bronze.passed(landed), ORDERS.mappings)
    rules.apply(conformed, ORDERS.rules, ORDERS.primary_key).write.parquet(f"{place}/checked")
    checked = spark.read.parquet(f"{place}/checked")
    for _ in range(appends):
        rules.passed(checked).write.mode("append").parquet(f"{place}/silver")
    n = F.count(F.lit(1))
    parts = [
        raw.agg(n.alias("raw_rows")),
        landed.agg(
            n.alias("landing_rows"),
            F.count_if(F.col("bronze_dq_status") == "PASS").alias("bronze_valid_rows"),
            F.count_if(F.col("bronze_dq_status") == "FAIL").alias("bronze_reject_rows"),
        ),
        checked.agg(
            n.alias("conformance_rows"),
            F.count_if(F.col("dq_status") == "PASS").alias("valid_rows"),
            F.count_if(F.col("dq_status") == "FAIL").alias("reject_rows"),
        ),
        spark.read.parquet(f"{place}/silver").agg(n.alias("silver_after")),
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("silver_before", F.lit(0).cast("bigint"))


_APPENDS = {"once": 1, "twice": 2}


@query(
    "reconcile_counts",
    f"""WITH {_FLOW}, r AS (SELECT count(*) AS raw_rows, count(*) FILTER (bad) AS bad_rows,
  count(*) FILTER (NOT bad) AS good_rows FROM raw),
c AS (SELECT count(*) AS rows, count(*) FILTER (dq_status = 'PASS') AS valid,
  count(*) FILTER (dq_status = 'FAIL') AS rejected FROM checked),
runs AS (SELECT * FROM (VALUES ('once', 1), ('twice', 2)) v(appended, times))
SELECT appended, 'landing_equals_ingestion_for_batch' AS check_name,
  CASE WHEN good_rows + bad_rows = raw_rows THEN 'PASS' ELSE 'FAIL' END AS status FROM r, runs
UNION ALL SELECT appended, 'bronze_valid_plus_bronze_reject_equals_ingestion',
  CASE WHEN rows + bad_rows = raw_rows THEN 'PASS' ELSE 'FAIL' END FROM r, c, runs
UNION ALL SELECT appended, 'valid_plus_reject_equals_conformance',
  CASE WHEN valid + rejected = rows THEN 'PASS' ELSE 'FAIL' END FROM c, runs
UNION ALL SELECT appended, 'append_expected_silver_increase_equals_valid',
  CASE WHEN times * valid = valid THEN 'PASS' ELSE 'FAIL' END FROM c, runs""",
)
def reconcile_counts(spark, sf_dir):
    """A run that appends once balances; one that appends its rows twice does not."""
    report = None
    for name, times in _APPENDS.items():
        part = audit.reconcile(_flow_counts(spark, sf_dir, times)).withColumn("appended", F.lit(name))
        report = part if report is None else report.unionByName(part)
    return report


_ERROR = "executor lost\n" + "x" * 600


@query(
    "audit_run_row",
    f"""WITH {_FLOW} SELECT 'nightly' AS pipeline_name, 'run-1' AS run_id, 'erp' AS source_system,
  'orders' AS source_entity, (SELECT count(*) FROM raw) AS rows_in,
  (SELECT count(*) FROM checked WHERE dq_status = 'PASS') AS rows_out, 'SUCCESS' AS status,
  CAST(NULL AS VARCHAR) AS error_message, TIMESTAMP '{TS}' AS run_ts
UNION ALL SELECT 'nightly', 'run-1', 'erp', 'orders', 0, 0, 'FAILED', substr('executor lost ' || repeat('x', 600), 1, 500),
  TIMESTAMP '{TS}'""",
)
def audit_run_row(spark, sf_dir):
    """The row of a run that succeeds, and of one that fails: no rows, and a short error text."""
    counts = _flow_counts(spark, sf_dir)
    metrics = counts.select(F.col("landing_rows").alias("rows_in"), F.col("valid_rows").alias("rows_out"))
    return audit.run_row(metrics, "nightly", RUN).unionByName(audit.run_row(metrics, "nightly", RUN, "FAILED", _ERROR))


@query(
    "audit_lifecycle",
    f"""WITH {_FLOW} SELECT 'erp.orders' AS entity_id, 'onboarded' AS event_type, '{{"landing_table": "main.bronze.landing"}}'
  AS event_details, 'system' AS user, TIMESTAMP '{TS}' AS event_ts
UNION ALL SELECT 'erp.orders', 'checked', '{{"rows": ' || count(*) || ', "rejected": ' || count(*) FILTER (dq_status = 'FAIL')
  || '}}', 'system', TIMESTAMP '{TS}' FROM checked""",
)
def audit_lifecycle(spark, sf_dir):
    """Lifecycle rows of an entity, one of them with what its rules found."""
    found = flow.checked_frame(table(spark, sf_dir, "orders"), ORDERS).agg(
        F.count("*").alias("rows"), F.count_if(F.col("dq_status") == "FAIL").alias("rejected")
    ).first()
    events = [("onboarded", {"landing_table": ORDERS.landing_table}), ("checked", found.asDict())]
    return audit.lifecycle(spark, ORDERS.name, events, "system", TS)


@query(
    "stream_full_flow",
    """SELECT product, event_id, 1 AS copies FROM events, (VALUES ('p1'), ('p2')) v(product) WHERE value > 10
UNION ALL SELECT 'p3', event_id, 2 FROM events WHERE value > 10""",
)
def stream_full_flow(spark, sf_dir):
    """Whole flows per micro-batch. Two products share system and entity, and each takes its two batches;
    a third is started again with a new checkpoint and takes all files once more."""
    events = table(spark, sf_dir, "events").select("event_id", "value")
    tables = flow.AuditTables(pipeline_runs=f"spark_catalog.default.runs_{uuid.uuid4().hex}")
    report = None
    for product, checkpoints in (("p1", 1), ("p2", 1), ("p3", 2)):
        path, tag = new_folder(spark, "stream-flow"), f"spark_catalog.default.{product}_{uuid.uuid4().hex}"
        spec = SourceSpec(
            "web", "events", _no_reader, f"{tag}_l", f"{tag}_c", f"{tag}_s", product=product,
            mappings=[{"transform_expression": c, "conformance_column": c} for c in ("event_id", "value")],
            rules=[{"rule_name": "large", "rule_expression": "value > 10"}],
            paths={layer: new_folder(spark, f"stream-{layer}") for layer in ("landing", "conformance", "silver")},
        )
        states = [new_folder(spark, "stream-state") for _ in range(checkpoints)]
        for part in (0, 1):
            events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(path)
            for state in states if part else states[:1]:
                frame = streams.read_stream(spark, path, "parquet", "web", "events", {"add_metadata_columns": False}, events.schema)
                streams.run_stream(frame, spec, state, tables)
        silver = spark.table(spec.silver_table).groupBy("event_id").agg(F.count("*").cast("int").alias("copies"))
        part_report = silver.select(F.lit(product).alias("product"), "event_id", "copies")
        report = part_report if report is None else report.unionByName(part_report)
    return report


@query(
    "layer_counts",
    f"""WITH {_FLOW} SELECT 'orders' AS source_name, (SELECT count(*) FROM raw) AS landing_count,
  (SELECT count(*) FROM conformed) AS conformance_count,
  (SELECT count(*) FROM checked WHERE dq_status = 'PASS') AS silver_count, 'MATCHED' AS status
UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), NULL, NULL, 'INCOMPLETE'""",
)
def layer_counts(spark, sf_dir):
    raw = table(spark, sf_dir, "orders")
    annotated = bronze.annotate(raw, ORDERS.checks)
    conformed = conform.apply(bronze.passed(annotated), ORDERS.mappings)
    silver = rules.passed(flow.checked_frame(raw, ORDERS))
    complete = audit.layer_counts("orders", annotated, conformed, silver)
    return complete.unionAll(audit.layer_counts("lineitem", table(spark, sf_dir, "lineitem"), None, None))


def _built(*columns: str) -> str:
    names = ", ".join(f"'{c}'" for c in columns)
    return f"""CASE WHEN (SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders'
  AND column_name IN ({names})) = {len(columns)} THEN 'PASS' ELSE 'FAIL' END"""


@query(
    "stage_events",
    f"""WITH r AS (SELECT count(*) AS n FROM orders)
SELECT 'run-1' AS run_id, 'erp' AS source_system, 'orders' AS source_entity, 'landing_raw' AS event_name,
  {_built('o_orderkey', 'o_custkey', 'o_orderdate')} AS event_status, TIMESTAMP '{TS}' AS event_ts, n AS raw_row_count FROM r
UNION ALL SELECT 'run-1', 'erp', 'orders', 'conformance_engine', {_built('o_orderkey', 'o_totalprice')}, TIMESTAMP '{TS}', NULL
UNION ALL SELECT 'run-1', 'erp', 'orders', 'landing_raw', {_built('o_orderkey', 'load_id')}, TIMESTAMP '{TS}', NULL
UNION ALL SELECT 'run-1', 'erp', 'orders', 'conformance_engine', {_built('o_orderkey', 'not_built')}, TIMESTAMP '{TS}', NULL""",
)
def stage_events(spark, sf_dir):
    """Structure of the layers: once as it should be, once without technical columns and a mapped one."""
    raw = table(spark, sf_dir, "orders")
    landed = landing.add_metadata(bronze.annotate(raw, ORDERS.checks), "erp", "orders", "run-1", TS)
    conformed = conform.apply(landed, [])

    def wanted(*names):
        return [{"transform_expression": n, "conformance_column": n} for n in names]

    good = audit.structure_events(raw.columns, landed.columns, conformed.columns, wanted("o_orderkey", "o_totalprice"))
    good[0]["payload"]["raw_row_count"] = landed.count()
    bad = audit.structure_events(raw.columns, raw.columns, conformed.columns, wanted("o_orderkey", "not_built"))
    rows = audit.events(spark, RUN, good + bad)
    counted = F.get_json_object("event_payload", "$.raw_row_count").cast("bigint")
    return rows.withColumn("raw_row_count", counted).drop("event_payload")


@query(
    "multi_source_summary",
    f"""WITH {_FLOW}
SELECT 'run-1' AS run_id, 'erp' AS source_system, 'orders' AS source_entity, dq_status, dq_failed_rule,
  count(*) AS row_count, TIMESTAMP '{TS}' AS run_ts FROM checked GROUP BY ALL
UNION ALL SELECT 'run-1', 'crm', 'customer', s, r, count(*), TIMESTAMP '{TS}' FROM (
  SELECT CASE WHEN c_acctbal < 0 THEN 'FAIL' ELSE 'PASS' END AS s,
    CASE WHEN c_acctbal < 0 THEN 'no_debt' END AS r FROM customer) GROUP BY s, r
UNION ALL SELECT 'run-1', 'web', 'events', s, r, count(*), TIMESTAMP '{TS}' FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS s,
    CASE WHEN event_type = 'error' THEN 'no_error' END AS r FROM events) GROUP BY s, r""",
)
def multi_source_summary(spark, sf_dir):
    customer = _spec(
        "crm", "customer", rules=[{"rule_name": "no_debt", "rule_expression": "c_acctbal >= 0"}],
        primary_key="c_custkey",
    )
    events = _spec(
        "web", "events", rules=[{"rule_name": "no_error", "rule_expression": "event_type <> 'error'"}]
    )
    sources = [
        (table(spark, sf_dir, "orders"), ORDERS),
        (table(spark, sf_dir, "customer"), customer),
        (table(spark, sf_dir, "events"), events),
    ]
    return flow.summarize_all(sources, "run-1", TS)


_POINTS = f"""{ctes('stages')}, last AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY run_id, stage_sequence ORDER BY event_ts DESC, state DESC) AS rn FROM stages) WHERE rn = 1),
points AS (SELECT run_id, coalesce(max(CASE WHEN state IN ('CHECKPOINT_SAVED', 'SUCCESS') THEN stage_sequence END), 0)
    AS last_completed_stage, count(*) FILTER (state = 'FAILED') AS failed_stages,
  max(event_ts) AS last_event_ts FROM last GROUP BY run_id)"""


@query("resume_point", f"{_POINTS} SELECT * FROM points")
def resume_point(spark, sf_dir):
    return resume.resume_point(derive(spark, sf_dir, "stages"))


@query(
    "kept_runs",
    f"""{_POINTS} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY last_completed_stage
  ORDER BY last_event_ts DESC, run_id) AS rn FROM points) WHERE rn <= 5""",
)
def kept_runs(spark, sf_dir):
    points = resume.resume_point(derive(spark, sf_dir, "stages"))
    return resume.newest_runs(points, within=["last_completed_stage"])


@query(
    "watermark_products",
    """SELECT product, CAST(o_orderdate AS DATE) AS order_day, count(*) AS loaded FROM orders,
  (VALUES ('p1', DATE '1996-01-01'), ('p2', DATE '1999-01-01')) AS p(product, first_end) GROUP BY ALL""",
)
def watermark_products(spark, sf_dir):
    """Two products load one source from their own marks on, each in two starts. Each ends with every row once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    tables = flow.AuditTables(validation_events=f"spark_catalog.default.marks_{uuid.uuid4().hex}")
    report = None
    for product, first_end in (("p1", "1996-01-01 00:00:00"), ("p2", "1999-01-01 00:00:00")):
        tag = f"spark_catalog.default.{product}_{uuid.uuid4().hex}"
        spec = SourceSpec(
            "erp", "orders", _no_reader, f"{tag}_l", f"{tag}_c", f"{tag}_s", product=product, watermark_column="o_orderdate",
            paths={layer: new_folder(spark, f"marks-{layer}") for layer in ("landing", "conformance", "silver")},
        )
        for number, there in enumerate((orders.where(F.col("o_orderdate") < F.lit(first_end).cast("timestamp_ntz")), orders)):
            mark = flow.last_watermark(spark, tables, "erp", "orders", product=product)
            new = there if mark is None else jdbc.beyond(there, "o_orderdate", mark)
            flow.run_source(spark, flow.with_rules(spec, read=lambda _, rows=new: rows), tables, load_id=f"{product}-{number}")
        loaded = spark.table(spec.silver_table).groupBy(F.to_date("o_orderdate").alias("order_day")).agg(F.count("*").alias("loaded"))
        part = loaded.select(F.lit(product).alias("product"), "order_day", "loaded")
        report = part if report is None else report.unionByName(part)
    return report


def _written_flow(spark, sf_dir, *sinks: str):
    """The orders flow through stored layers, as a run writes them."""
    tag = f"spark_catalog.default.written_{uuid.uuid4().hex}"
    layers = {layer: f"{tag}_{layer}" for layer in ("landing", "conformance", "silver")}
    spec = flow.with_rules(
        ORDERS, read=lambda s: table(s, sf_dir, "orders"), product="shop",
        paths={layer: new_folder(spark, f"written-{layer}") for layer in layers}, **{f"{k}_table": v for k, v in layers.items()},
    )
    tables = flow.AuditTables(**{name: f"{tag}_{name}" for name in sinks})
    flow.run_source(spark, spec, tables, load_id="run-1")
    return spec, tables


@query(
    "conformance_write",
    f"""WITH {_FLOW} SELECT order_id, customer_id, status, amount, order_day, priority, 'run-1' AS load_id FROM conformed""",
)
def conformance_write(spark, sf_dir):
    """What a run stored as its conformance layer: every mapped row, passed or not by the rules after it."""
    spec, _ = _written_flow(spark, sf_dir)
    return spark.table(spec.conformance_table).select("order_id", "customer_id", "status", "amount", "order_day", "priority", "load_id")


@query(
    "alert_sink",
    f"""WITH {_FLOW}, n AS (SELECT (SELECT count(*) FROM raw) AS total,
  (SELECT count(*) FROM raw WHERE bad) + (SELECT count(*) FROM checked WHERE dq_status = 'FAIL') AS failed)
SELECT 'DQ_FAILURE_RATE' AS alert_type, 'shop' AS product_name, 'run-1' AS load_id,
  CASE WHEN 100.0 * failed / total > 50 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, failed || ' of ' || total || ' rows failed DQ checks' AS message
FROM n WHERE 100.0 * failed / total > 10
UNION ALL SELECT 'METRIC', 'shop', 'run-1', 'INFO', CAST(total AS VARCHAR) FROM n""",
)
def alert_sink(spark, sf_dir):
    """Rows that a run stored in its alert table, and the row count of its performance row."""
    _, tables = _written_flow(spark, sf_dir, "alerts", "performance_metrics")
    found = spark.table(tables.alerts).where("alert_type = 'DQ_FAILURE_RATE'").select("alert_type", "product_name", "load_id", "severity", "message")
    metric = spark.table(tables.performance_metrics).select(
        F.lit("METRIC").alias("alert_type"), F.lit("shop").alias("product_name"), F.substring_index("query_name", ":", -1).alias("load_id"),
        F.lit("INFO").alias("severity"), F.col("rows_processed").cast("string").alias("message"),
    )
    return found.unionByName(metric)
