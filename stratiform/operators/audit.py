"""Audit rows of a run: rule summaries, rejects, check results, events, reconciliation."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.functions.columns import few_rows, short_text
from stratiform.operators.landing import write_table


@dataclass(frozen=True)
class RunKey:
    """What every audit row carries; ``ts`` is fixed in tests and the current time otherwise."""

    run_id: str
    source_system: str
    source_entity: str
    ts: str | None = None

    def columns(self) -> list[Column]:
        return [
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.source_system).alias("source_system"),
            F.lit(self.source_entity).alias("source_entity"),
        ]

    def when(self, name: str) -> Column:
        now = F.current_timestamp() if self.ts is None else F.to_timestamp_ntz(F.lit(self.ts))
        return now.alias(name)


def rule_summary(df: DataFrame, run: RunKey) -> DataFrame:
    """Rows per status and failed-rule combination."""
    counted = df.groupBy("dq_status", "dq_failed_rule").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        *run.columns(), "dq_status", "dq_failed_rule", "row_count", run.when("run_ts")
    )


def rejects(df: DataFrame, run: RunKey) -> DataFrame:
    """Rejected rows in a fixed envelope; source columns travel as one JSON text."""
    payload = [c for c in df.columns if c not in schemas.FRAMEWORK_COLUMNS]
    return df.select(
        *run.columns(),
        run.when("rejected_ts"),
        "dq_status",
        "dq_failed_rule",
        F.to_json(F.struct(*[F.col(c) for c in payload])).alias("payload_json"),
    )


def check_rows(
    spark: SparkSession, results: DataFrame | None, run: RunKey, errors: Sequence[str] = ()
) -> DataFrame:
    """Check results and configuration errors as audit rows; one PASS row when there is neither."""
    name = "bronze_dq_config"
    extra = [(name, "FAIL", json.dumps({"error": e}, separators=(",", ":"))) for e in errors]
    if results is None and not extra:
        extra = [(name, "PASS", '{"message":"No bronze DQ checks configured"}')]
    rows = few_rows(spark, extra, ["check_name", "status", "details"])
    if results is not None:
        rows = results.select(*rows.columns) if not extra else results.select(*rows.columns).unionAll(rows)
    return rows.select(
        *run.columns(),
        F.col("check_name").alias("validation_type"),
        F.col("status").alias("validation_status"),
        F.col("details").alias("error_details"),
        run.when("timestamp"),
    )


def events(spark: SparkSession, run: RunKey, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Validation events (event, status, payload) of a run."""
    listed = [
        (
            str(r.get("event", "UNKNOWN")),
            str(r.get("status", "INFO")),
            json.dumps(r.get("payload", {}), default=str),
        )
        for r in rows
    ]
    frame = few_rows(spark, listed, ["event_name", "event_status", "event_payload"])
    return frame.select(*run.columns(), *frame.columns, run.when("event_ts"))


def lifecycle(
    spark: SparkSession,
    entity_id: str,
    events: Sequence[tuple[str, Any]],
    user: str,
    ts: str | None = None,
) -> DataFrame:
    """Lifecycle rows of an entity from (event type, details) pairs."""
    rows = [
        (entity_id, kind, d if isinstance(d, str) else json.dumps(d, default=str), user)
        for kind, d in events
    ]
    frame = few_rows(spark, rows, ["entity_id", "event_type", "event_details", "user"])
    return frame.select("*", RunKey("", "", "", ts).when("event_ts"))


def run_row(
    metrics: DataFrame,
    pipeline: str,
    run: RunKey,
    status: str = "SUCCESS",
    error: str | None = None,
) -> DataFrame:
    """Pipeline run row. ``metrics`` has one row with rows_in and rows_out."""
    done = status == "SUCCESS"
    zero = F.lit(0).cast("bigint")
    return metrics.select(
        F.lit(pipeline).alias("pipeline_name"),
        *run.columns(),
        (F.col("rows_in") if done else zero).alias("rows_in"),
        (F.col("rows_out") if done else zero).alias("rows_out"),
        F.lit(status).alias("status"),
        short_text(F.lit(error).cast("string")).alias("error_message"),
        run.when("run_ts"),
    )


def reconcile(counts: DataFrame) -> DataFrame:
    """Conservation checks over the one row of layer counts.

    Columns: raw_rows, landing_rows, bronze_valid_rows, bronze_reject_rows, conformance_rows,
    valid_rows, reject_rows, silver_before, silver_after (both NULL unless appended).
    """
    grown = F.col("silver_after") - F.col("silver_before")
    checks = {
        "landing_equals_ingestion_for_batch": F.col("landing_rows") == F.col("raw_rows"),
        "bronze_valid_plus_bronze_reject_equals_ingestion": (
            F.col("bronze_valid_rows") + F.col("bronze_reject_rows") == F.col("raw_rows")
        ),
        "valid_plus_reject_equals_conformance": (
            F.col("valid_rows") + F.col("reject_rows") == F.col("conformance_rows")
        ),
        "append_expected_silver_increase_equals_valid": F.coalesce(
            grown == F.col("valid_rows"), F.lit(True)
        ),
    }
    rows = [
        F.struct(
            F.lit(name).alias("check_name"), F.when(ok, "PASS").otherwise("FAIL").alias("status")
        )
        for name, ok in checks.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def layer_counts(
    name: str,
    landing: DataFrame | None,
    conformance: DataFrame | None,
    silver: DataFrame | None,
    at_expected_location: bool = True,
) -> DataFrame:
    """Rows per layer of one source and whether all layers are there."""
    present = {"landing": landing, "conformance": conformance, "silver": silver}
    spark = next(f for f in present.values() if f is not None).sparkSession
    counted = spark.createDataFrame([], "layer string, n bigint")
    for layer, frame in present.items():
        if frame is not None:
            counted = counted.unionAll(
                frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), "n")
            )
    complete = all(f is not None for f in present.values())
    status = "INCOMPLETE"
    if complete:
        status = "MATCHED" if at_expected_location else "ROW_COUNTS_OK_LOCATION_DIFFERS"
    return counted.agg(
        *[F.max(F.when(F.col("layer") == k, F.col("n"))).alias(f"{k}_count") for k in present]
    ).select(F.lit(name).alias("source_name"), "*", F.lit(status).alias("status"))


def structure_events(
    raw: Sequence[str],
    landed: Sequence[str],
    conformed: Sequence[str],
    mappings: Sequence[Mapping[str, Any]],
) -> list[dict[str, Any]]:
    """Verification of the layers by their column names, as events."""
    kept = set(raw) <= set(landed)
    technical = set(schemas.LANDING_COLUMNS) <= set(landed)
    expected = [m["conformance_column"] for m in mappings if m.get("conformance_column")]
    missing = [c for c in expected if c not in conformed]
    return [
        {
            "event": "landing_raw",
            "status": "PASS" if technical else "FAIL",
            "payload": {
                "raw_columns_preserved": kept,
                "landing_technical_columns_present": technical,
            },
        },
        {
            "event": "conformance_engine",
            "status": "FAIL" if missing else "PASS",
            "payload": {
                "expected_conformance_columns": expected,
                "missing_conformance_columns": missing,
            },
        },
    ]


def store(df: DataFrame, table: str, kind: str) -> None:
    """Append audit rows under the schema registered for ``kind``."""
    target = df.sparkSession.createDataFrame([], schemas.AUDIT_TABLES[kind]).schema
    ready = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target])
    write_table(ready, table, merge_schema=False)
