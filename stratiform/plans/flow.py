"""One source from raw data to silver, with its audit rows.

Every stage is written once and the next one reads what was written: the source is scanned a
single time, metrics ride on the writes, and a lost executor repeats only the stage at hand.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.errors import ConfigError
from stratiform.operators import alerts, audit, bronze, conform, content, key_history, landing, publish, rules
from stratiform.session import drop_folder, new_folder

RESULT_SCHEMA = """source string, load_id string, status string, rows_in bigint, valid_rows bigint,
reject_rows bigint, publish_mode string, error string"""


@dataclass(frozen=True)
class AuditTables:
    """Target tables of the audit rows; those left out are not written."""

    pipeline_runs: str | None = None
    dq_rule_results: str | None = None
    bronze_dq_results: str | None = None
    validation_events: str | None = None
    rejects: str | None = None
    entity_lifecycle_log: str | None = None
    alerts: str | None = None
    performance_metrics: str | None = None


@dataclass(frozen=True)
class SourceSpec:
    """Everything a run needs to know about one source."""

    source_system: str
    source_entity: str
    read: Callable[[SparkSession], DataFrame]
    landing_table: str
    conformance_table: str
    silver_table: str
    checks: Mapping[str, Any] = field(default_factory=dict)
    mappings: Sequence[Mapping[str, Any]] = ()
    rules: Sequence[Mapping[str, Any]] = ()
    primary_key: str = ""
    publish_mode: str = "append"
    merge_key: str = ""
    sequence: str | None = None
    soft_delete: str | None = None
    tenant: str = ""
    product: str = ""
    watermark_column: str = ""
    partition_by: Sequence[str] = ()
    zorder_by: Sequence[str] = ()
    paths: Mapping[str, str] = field(default_factory=dict)
    archive_table: str | None = None
    archive_hours: int | None = None
    typed: bool = False
    keep_dq_columns: bool = True
    optimize: bool = False
    ansi: bool | None = None
    stream: Callable[[SparkSession], DataFrame] | None = None
    stream_options: Mapping[str, Any] = field(default_factory=dict)
    checkpoint: str | None = None
    as_of: str | None = None
    key_history: str | None = None
    verify_content: bool = False
    before_landing: Callable[[DataFrame], DataFrame] | None = None
    after_conformance: Callable[[DataFrame], DataFrame] | None = None

    @property
    def name(self) -> str:
        return f"{self.source_system}.{self.source_entity}"


@dataclass(frozen=True)
class RunResult:
    source: str
    load_id: str
    status: str
    rows_in: int = 0
    valid_rows: int = 0
    reject_rows: int = 0
    publish_mode: str = ""
    error: str | None = None
    counts: Mapping[str, int] = field(default_factory=dict)
    events: Sequence[Mapping[str, Any]] = ()


def checked_frame(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """The whole row-wise part of the flow as one lazy frame: checks, mapping, rules."""
    valid = bronze.passed(bronze.annotate(raw, spec.checks))
    conformed = conform.apply(valid, spec.mappings, typed=spec.typed)
    if spec.after_conformance:
        conformed = spec.after_conformance(conformed)
    return rules.apply(conformed, spec.rules, spec.primary_key)


def summarize(raw: DataFrame, spec: SourceSpec, run: audit.RunKey) -> DataFrame:
    """Rule summary of a source without writing anything."""
    return audit.rule_summary(checked_frame(raw, spec), run)


def _observed(df: DataFrame, *metrics) -> tuple[DataFrame, Observation]:
    """Metrics of a frame that is written right after. They belong to the last stage of the
    write, whose tasks are counted once each even when some have to run again."""
    seen = Observation(uuid.uuid4().hex)
    return df.observe(seen, *metrics), seen


def _land(spark: SparkSession, spec: SourceSpec, load_id: str) -> tuple[dict, list[str], list[str]]:
    """Annotate and land the raw rows; dataset metrics are collected by the write itself."""
    raw = spec.read(spark)
    if spec.before_landing:
        raw = spec.before_landing(raw)
    errors = bronze.config_errors(spec.checks)
    annotated = bronze.annotate(raw, spec.checks)
    landed = landing.add_metadata(annotated, spec.source_system, spec.source_entity, load_id)
    metrics = bronze.metric_columns(annotated, {} if errors else spec.checks)
    observed, seen = _observed(landed, *metrics)
    landing.replace_load(observed, spec.landing_table, load_id, spec.paths.get("landing"))
    return dict(seen.get), errors, raw.columns


def _check_results(
    stored: DataFrame, spec: SourceSpec, metrics: dict, errors: list[str]
) -> DataFrame | None:
    """Result rows of all checks; row and volume metrics were seen while landing."""
    spark = stored.sparkSession
    if errors:
        return None
    columns = bronze.metric_columns(stored, spec.checks)
    row = spark.createDataFrame([tuple(metrics.values())], stored.limit(0).agg(*columns).schema)
    row = row.coalesce(1)
    raw = stored.drop(*schemas.LANDING_COLUMNS, *schemas.BRONZE_COLUMNS)
    report = bronze.schema_checks(raw, spec.checks).unionAll(
        bronze.metric_results(row, stored, spec.checks, spec.as_of)
    )
    for frame in bronze.uniqueness_results(stored, spec.checks):
        report = report.unionAll(frame)
    return report


def _stage(conformed: DataFrame, spec: SourceSpec, path: str, load_id: str) -> tuple[DataFrame, dict]:
    """Apply the rules and store the outcome, from which all later stages read."""
    spark = conformed.sparkSession
    checked = rules.apply(conformed, spec.rules, spec.primary_key)
    if spec.key_history:
        checked = key_history.fail_seen(checked, rules.key_columns(spec.primary_key), spec.key_history, load_id)
    observed, seen = _observed(
        checked,
        F.count(F.lit(1)).alias("conformance_rows"),
        F.count_if(F.col("dq_status") == "PASS").alias("valid_rows"),
        *rules.key_failure_columns(),
    )
    observed.write.parquet(path)
    return spark.read.schema(checked.schema).parquet(path), dict(seen.get)


def _publish(valid: DataFrame, spec: SourceSpec, load_id: str, resume: bool) -> tuple[str, int | None]:
    """Publish and say how; for an append also how many rows were written, by this attempt or an earlier one."""
    mode = (spec.publish_mode or "append").lower()
    spark = valid.sparkSession
    rows = valid if spec.keep_dq_columns else valid.drop(*schemas.RULE_COLUMNS)
    path = spec.paths.get("silver")
    if mode == "merge":
        keys = rules.key_columns(spec.merge_key or spec.primary_key)
        if not keys:
            raise ConfigError(f"missing merge key for {spec.name}")
        deleted = F.expr(spec.soft_delete) if spec.soft_delete else None
        publish.merge(rows, spec.silver_table, keys, spec.partition_by, path, spec.sequence, spec.zorder_by, deleted)
        return mode, None
    if mode != "append":
        raise ConfigError(f"unsupported publish mode: {mode}")
    load = f"{spec.name}:{load_id}"
    written = publish.appended(spark, spec.silver_table, load) if resume else None
    if written is None:
        written = publish.append(rows, spec.silver_table, spec.partition_by, path, spec.zorder_by, load=load, again=resume)
    return mode, written


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def _event(name: str, status: str = "PASS", **payload: Any) -> dict[str, Any]:
    return {"event": name, "status": status, "payload": payload}


class _Log:
    """Audit rows of one run; events are written in batches, at the points that matter."""

    def __init__(self, spark, spec: SourceSpec, tables: AuditTables, run: audit.RunKey, pipeline, user, resume=False):
        self.spark, self.spec, self.tables, self.run = spark, spec, tables, run
        self.pipeline, self.user, self.resume = pipeline, user, resume
        self.started = time.monotonic()
        self.events: list[dict[str, Any]] = []
        self._written = 0

    def add(self, name: str, status: str = "PASS", **payload: Any) -> None:
        self.events.append(_event(name, status, **payload))

    def flush(self) -> None:
        fresh = self.events[self._written :]
        if self.tables.validation_events and fresh:
            frame = audit.events(self.spark, self.run, fresh)
            audit.store(frame, self.tables.validation_events, "validation_events")
        self._written = len(self.events)

    def payload(self, name: str) -> dict[str, Any] | None:
        """Latest payload of an event that an earlier attempt of this load logged as passed."""
        table = self.tables.validation_events
        if not table or not self.spark.catalog.tableExists(table):
            return None
        mine = (F.col("run_id") == self.run.run_id) & (F.col("event_name") == name)
        passed = self.spark.table(table).filter(mine & (F.col("event_status") == "PASS"))
        last = passed.agg(F.max_by("event_payload", "event_ts")).first()[0]
        return None if last is None else json.loads(last)

    def store_once(self, frame: DataFrame, table: str, kind: str, key: str = "run_id", value: str | None = None) -> None:
        """Append audit rows unless an earlier attempt of this load already did, in one commit."""
        if self.resume and self.spark.catalog.tableExists(table):
            if not self.spark.table(table).filter(F.col(key) == (value or self.run.run_id)).isEmpty():
                return
        audit.store(frame, table, kind)

    def lifecycle(self, *entries: tuple[str, Any]) -> None:
        if self.tables.entity_lifecycle_log:
            rows = audit.lifecycle(self.spark, self.spec.name, entries, self.user)
            audit.store(rows, self.tables.entity_lifecycle_log, "entity_lifecycle_log")

    def _succeeded_before(self) -> bool:
        table = self.tables.pipeline_runs
        if not self.resume or not self.spark.catalog.tableExists(table):
            return False
        return not self.spark.table(table).filter((F.col("run_id") == self.run.run_id) & (F.col("status") == "SUCCESS")).isEmpty()

    def finish(self, status: str, rows_in: int, rows_out: int, error: str | None) -> None:
        self.flush()
        if self.tables.pipeline_runs and not (status == "SUCCESS" and self._succeeded_before()):
            metrics = self.spark.range(1, numPartitions=1).select(
                F.lit(rows_in).cast("bigint").alias("rows_in"),
                F.lit(rows_out).cast("bigint").alias("rows_out"),
            )
            row = audit.run_row(metrics, self.pipeline, self.run, status, error)
            audit.store(row, self.tables.pipeline_runs, "pipeline_runs")


def _landed(spark: SparkSession, spec: SourceSpec, load_id: str) -> DataFrame:
    """This load's rows; the partition filter keeps other loads unread."""
    return spark.table(spec.landing_table).filter(F.col("load_id") == load_id)


def _metrics_of(stored: DataFrame, spec: SourceSpec) -> tuple[dict, list[str], list[str]]:
    """What landing would have reported, from a load that is already there."""
    errors = bronze.config_errors(spec.checks)
    row = stored.agg(*bronze.metric_columns(stored, {} if errors else spec.checks)).first()
    return row.asDict(), errors, [c for c in stored.columns if c not in schemas.FRAMEWORK_COLUMNS]


def _balance(spark: SparkSession, counts: Mapping[str, int | None]) -> dict[str, str]:
    schema = ", ".join(f"{k} bigint" for k in counts)
    frame = spark.createDataFrame([tuple(counts.values())], schema).coalesce(1)
    return {r.check_name: r.status for r in audit.reconcile(frame).collect()}


def _run_stages(spark: SparkSession, spec: SourceSpec, log: _Log, resume: bool, scratch: str) -> RunResult:
    load_id, tables = log.run.run_id, log.tables
    if resume and _has_load(spark, spec.landing_table, load_id):
        metrics, errors, raw_columns = _metrics_of(_landed(spark, spec, load_id), spec)
    else:
        metrics, errors, raw_columns = _land(spark, spec, load_id)
    stored = _landed(spark, spec, load_id)
    landing_rows = stored.count()
    log.add("bronze_dq_engine", "FAIL" if errors else "PASS", config_errors=errors)

    conformed = conform.apply(bronze.passed(stored), spec.mappings, typed=spec.typed)
    if spec.after_conformance:
        conformed = spec.after_conformance(conformed)
    checked, seen = _stage(conformed, spec, scratch, load_id)
    log.events += audit.structure_events(raw_columns, stored.columns, checked.columns, spec.mappings)
    log.add("dq_engine", **{k: seen[k] for k in (rules.PK_NOT_NULL, rules.PK_UNIQUE)})

    written = None
    mode = (spec.publish_mode or "append").lower()
    published = log.payload("silver_publish") if resume else None
    if published:
        written = published.get("rows")
    else:
        # These two replace the load's own partition, so a repeat does not add to them.
        if spec.archive_table:
            landing.archive(stored, spec.archive_table, hours=spec.archive_hours, load_id=load_id)
        landing.replace_load(
            checked.drop(*schemas.RULE_COLUMNS), spec.conformance_table, load_id, spec.paths.get("conformance")
        )
        mode, written = _publish(rules.passed(checked), spec, load_id, resume)
        log.add("silver_publish", publish_mode=mode, target=spec.silver_table, rows=written)
        log.flush()
        if spec.key_history:
            key_history.record(rules.passed(checked), rules.key_columns(spec.primary_key), spec.key_history, load_id)
        if spec.verify_content and spec.archive_table:
            kept = spark.table(spec.archive_table).filter(F.col("load_id") == load_id)
            same = content.same_content(stored, kept, stored.columns)
            log.add("content_verification", "PASS" if same else "FAIL", landing=spec.landing_table, archive=spec.archive_table)
        if spec.optimize:
            packed = publish.compact(spark, spec.silver_table, spec.zorder_by)
            log.add("silver_optimize", files=packed)
        if spec.archive_table and spec.archive_hours:
            gone = landing.purge_loads(spark, spec.archive_table, spec.archive_hours, spec.as_of or _now())
            log.add("archive_retention", purged_loads=gone)

    counts = {
        "raw_rows": metrics["total_rows"],
        "landing_rows": landing_rows,
        "bronze_valid_rows": metrics["total_rows"] - metrics["failed_rows"],
        "bronze_reject_rows": metrics["failed_rows"],
        "conformance_rows": seen["conformance_rows"],
        "valid_rows": seen["valid_rows"],
        "reject_rows": seen["conformance_rows"] - seen["valid_rows"],
        # What the append itself wrote; the rest of the table is not counted.
        "silver_before": None if written is None else 0,
        "silver_after": written,
    }
    outcome = _balance(spark, counts)
    balanced = set(outcome.values()) == {"PASS"}
    log.add("verification_summary", "PASS" if balanced else "FAIL", counts=counts, checks=outcome)
    if tables.bronze_dq_results:
        results = _check_results(stored, spec, metrics, errors)
        rows = audit.check_rows(spark, results, log.run, errors).coalesce(1)
        log.store_once(rows, tables.bronze_dq_results, "bronze_dq_results")
    if tables.dq_rule_results:
        log.store_once(audit.rule_summary(checked, log.run), tables.dq_rule_results, "dq_rule_results")
    if tables.rejects and counts["reject_rows"]:
        rejected = audit.rejects(rules.failed(checked), log.run)
        log.store_once(rejected, tables.rejects, "rejects")
    _store_alerts(spark, spec, log, stored, counts)
    if spec.watermark_column:
        mark = stored.agg(F.max(F.col(spec.watermark_column)).cast("string")).first()[0]
        if mark is not None:
            log.add("watermark", column=spec.watermark_column, value=mark, tenant=spec.tenant, product=spec.product)
    log.finish("SUCCESS", landing_rows, counts["valid_rows"], None)
    return RunResult(
        spec.name, load_id, "SUCCESS", landing_rows, counts["valid_rows"], counts["reject_rows"],
        mode, None, counts, log.events,
    )


def _store_alerts(spark: SparkSession, spec: SourceSpec, log: _Log, stored: DataFrame, counts: Mapping[str, Any]) -> None:
    """Alerts and the performance row of this load, where tables for them are given."""
    tables, seconds = log.tables, time.monotonic() - log.started
    failed = counts["bronze_reject_rows"] + counts["reject_rows"]
    if tables.alerts:
        row = (spec.product, spec.source_system, spec.source_entity, log.run.run_id, counts["landing_rows"], failed, seconds)
        schema = """product_name string, source_system string, source_entity string, load_id string,
          total_rows bigint, failed_rows bigint, duration_seconds double"""
        load = spark.createDataFrame([row], schema).withColumn("timestamp", F.current_timestamp())
        found = alerts.dq_failure_rate(load).unionByName(alerts.slow_loads(load)).coalesce(1)
        log.store_once(found, tables.alerts, "alerts", "load_id")
    if tables.performance_metrics:
        name = f"{spec.name}:{log.run.run_id}"
        files = stored.select(F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size")).distinct()
        done = files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes_processed")).select(
            F.lit(name).alias("query_name"), F.lit(seconds).alias("duration_seconds"),
            F.lit(counts["landing_rows"]).cast("bigint").alias("rows_processed"), "bytes_processed",
        )
        log.store_once(alerts.performance(done), tables.performance_metrics, "performance_metrics", "query_name", name)


def last_watermark(
    spark: SparkSession, tables: AuditTables, system: str, entity: str, tenant: str = "", product: str = ""
) -> str | None:
    """Where the latest finished load of a source ended, known from its validation events.

    A source is named by tenant, product, system and entity: no product starts at the mark of another.
    """
    table = tables.validation_events
    if not table or not spark.catalog.tableExists(table):
        return None
    mine = (F.col("source_system") == system) & (F.col("source_entity") == entity) & (F.col("event_name") == "watermark")
    for name, value in (("tenant", tenant), ("product", product)):
        mine = mine & (F.coalesce(F.get_json_object("event_payload", f"$.{name}"), F.lit("")) == (value or ""))
    last = spark.table(table).filter(mine).agg(F.max_by("event_payload", "event_ts")).first()[0]
    return None if last is None else json.loads(last)["value"]


def run_source(
    spark: SparkSession,
    spec: SourceSpec,
    tables: AuditTables = AuditTables(),
    pipeline: str = "",
    user: str = "system",
    load_id: str | None = None,
    resume: bool = False,
    fail_fast: bool = True,
) -> RunResult:
    """Run all stages of a source.

    With ``resume`` a load that already landed is not read again, and whatever an earlier attempt has
    stored of it is there once at the end, wherever that attempt failed: landing, archive and conformance
    are partitions of the load, audit rows are looked up by run, and files are appended to silver by a
    step that is named by the load and can be repeated, even if it moved only some of them.
    """
    load_id = load_id or uuid.uuid4().hex
    run = audit.RunKey(load_id, spec.source_system, spec.source_entity)
    log = _Log(spark, spec, tables, run, pipeline, user, resume)
    scratch = new_folder(spark, "checked")
    try:
        found = {"mappings": len(spec.mappings), "rules": len(spec.rules)}
        log.lifecycle(
            ("onboarded", {"landing_table": spec.landing_table}), ("metadata_resolved", found)
        )
        log.add("source_start", load_id=load_id)
        log.add("metadata_resolved", **found)
        with _ansi(spark, spec.ansi):
            return _run_stages(spark, spec, log, resume, scratch)
    except Exception as exc:
        text = " ".join(str(exc).split())[:500]
        log.lifecycle(("failed", text))
        log.add("source_failed", "FAIL", error=text)
        log.finish("FAILED", 0, 0, str(exc))
        if fail_fast:
            raise
        return RunResult(spec.name, load_id, "FAILED", error=text, events=log.events)
    finally:
        drop_folder(spark, scratch)


@contextmanager
def _ansi(spark: SparkSession, wanted: bool | None) -> Iterator[None]:
    """ANSI mode of one run; metadata expressions that cast badly give NULL when it is off."""
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    if wanted is not None:
        spark.conf.set(key, str(wanted).lower())
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _has_load(spark: SparkSession, table: str, load_id: str) -> bool:
    if not spark.catalog.tableExists(table):
        return False
    return not spark.table(table).filter(F.col("load_id") == load_id).isEmpty()


def run_all(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    tables: AuditTables = AuditTables(),
    pipeline: str = "",
    fail_fast: bool = False,
) -> DataFrame:
    """Run sources one after the other; each is a distributed job. One report row per load: a
    streaming source has one for every micro-batch it found."""
    results: list[RunResult] = []
    for spec in specs:
        if spec.stream is None:
            results.append(run_source(spark, spec, tables, pipeline, fail_fast=fail_fast))
        else:
            results += _run_streaming(spark, spec, tables, fail_fast)
    rows = [
        (r.source, r.load_id, r.status, r.rows_in, r.valid_rows, r.reject_rows, r.publish_mode, r.error)
        for r in results
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def _run_streaming(
    spark: SparkSession, spec: SourceSpec, tables: AuditTables, fail_fast: bool
) -> list[RunResult]:
    from stratiform.streaming.files import run_stream

    found: list[RunResult] = []
    try:
        if not spec.checkpoint:
            raise ConfigError(f"streaming source {spec.name} needs a checkpoint folder")
        run_stream(spec.stream(spark), spec, spec.checkpoint, tables, spec.stream_options, found.append)
    except Exception as exc:
        if fail_fast:
            raise
        found.append(RunResult(spec.name, "", "FAILED", error=" ".join(str(exc).split())[:500]))
    return found


def summarize_all(sources: Sequence[tuple[DataFrame, SourceSpec]], run_id: str, ts: str | None = None) -> DataFrame:
    """Rule summaries of several sources in one frame; one plan, so Spark runs them side by side."""
    report = None
    for raw, spec in sources:
        part = summarize(raw, spec, audit.RunKey(run_id, spec.source_system, spec.source_entity, ts))
        report = part if report is None else report.unionAll(part)
    return report


def with_rules(spec: SourceSpec, **changes: Any) -> SourceSpec:
    return replace(spec, **changes)
