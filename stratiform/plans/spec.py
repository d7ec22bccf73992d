"""From control rows to a source spec: options per consumer, readers by source type."""

from __future__ import annotations

import json
import logging
import os
import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.errors import ConfigError
from stratiform.operators.landing import EXTERNAL_PREFIXES, checked_path
from stratiform.operators.landing import retention_hours
from stratiform.plans import control
from stratiform.plans.flow import SourceSpec
from stratiform.sources import files, jdbc, options as opt, payload

logger = logging.getLogger(__name__)

STREAM_MODE = "autoloader"  # fixed value: the file_ingest_mode of incremental file sources

_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::([^${}]*))?\}")


def substitute(text: str, values: Mapping[str, str] | None = None) -> str:
    """Replace ``${NAME}`` and ``${NAME:default}``, innermost first, from values or environment."""
    known = os.environ if values is None else values
    while True:
        done = _VARIABLE.sub(lambda m: known.get(m.group(1)) or m.group(2) or "", text)
        if done == text:
            return done
        text = done


def json_object(cell: Any) -> dict[str, Any]:
    """Object of a JSON cell; anything else counts as empty."""
    try:
        value = json.loads(cell) if cell else {}
    except (TypeError, ValueError):
        return {}
    return value if isinstance(value, dict) else {}


def json_list(cell: Any) -> list[str]:
    try:
        value = json.loads(cell) if cell else []
    except (TypeError, ValueError):
        return []
    return [str(v) for v in value if str(v).strip()] if isinstance(value, list) else []


def _file_reader(row: Mapping[str, Any], given: dict[str, Any]) -> Callable[[SparkSession], DataFrame]:
    kind = str(row.get("source_format") or "").strip().lower()
    path = substitute(str(row.get("source_path") or ""))
    if _is_mixed(row, given):
        record = files.without_corrupt(given["schema_ddl"])
        return lambda spark: files.read_mixed_json(spark, path, record, files.CORRUPT)
    ddl = given.pop("schema_ddl", None)
    wanted = {k: v for k, v in given.items() if not k.startswith("cloudFiles.")}
    load_type = str(row.get("load_type") or "incremental").strip().lower()
    return lambda spark: files.read_files(spark, path, kind, wanted, load_type, schema=ddl)


def _stream_reader(
    row: Mapping[str, Any], given: Mapping[str, Any], schema_location: str | None
) -> Callable[[SparkSession], DataFrame]:
    from stratiform.streaming.files import read_stream, stream_of_files

    path = substitute(str(row.get("source_path") or ""))
    kind = str(row.get("source_format") or "")
    if _is_mixed(row, given):
        return lambda spark: stream_of_files(spark, path, given)
    return lambda spark: read_stream(
        spark, path, kind, row["source_system"], row["source_entity"], given, schema_location=schema_location
    )


def _is_mixed(row: Mapping[str, Any], given: Mapping[str, Any]) -> bool:
    return str(row.get("source_format") or "").strip().lower() == "json_jsonl_mixed" and bool(given.get("schema_ddl"))


def _mixed_batches(row: Mapping[str, Any], given: Mapping[str, Any]) -> Callable[[DataFrame], DataFrame]:
    """Records of the files of a micro-batch, read split by split like those of a batch load."""
    from stratiform.streaming.files import mixed_batch

    return lambda found: mixed_batch(
        found, substitute(str(row.get("source_path") or "")), row["source_system"], row["source_entity"], given
    )


def _no_batch_reader(_: SparkSession) -> DataFrame:
    raise ConfigError("a streaming source is read by its stream")


def _jdbc_reader(row, given, start, profiles) -> Callable[[SparkSession], DataFrame]:
    profile = (profiles or {}).get(str(row.get("jdbc_profile") or ""))
    if not profile:
        raise ConfigError(f"unknown JDBC profile {row.get('jdbc_profile')!r}")
    column = str(row.get("watermark_column") or "").strip()
    incremental = str(row.get("load_type") or "").strip().lower() == "incremental"
    mark = (column, start) if incremental and column and start else None
    return lambda spark: jdbc.read_jdbc(spark, profile, str(row.get("jdbc_table") or ""), given, mark)


def _page_reader(row, given) -> Callable[[SparkSession], DataFrame]:
    """API sources are read from the table in which their pages landed (column ``body``)."""
    table = str(row.get("api_endpoint") or "").strip()
    envelope = given.get("response_data_key")
    return lambda spark: payload.explode_records(spark.table(table), "body", envelope)


def build(
    row: Mapping[str, Any],
    mappings: Sequence[Mapping[str, Any]] = (),
    rules: Sequence[Mapping[str, Any]] = (),
    publish_rule: Mapping[str, Any] | None = None,
    jdbc_profiles: Mapping[str, Mapping[str, Any]] | None = None,
    custom: Mapping[str, Callable[[SparkSession], DataFrame]] | None = None,
    prefixes: Sequence[str] = EXTERNAL_PREFIXES,
    checkpoint_root: str | None = None,
    start: Callable[[Mapping[str, Any]], str | None] | None = None,
    target: str | None = None,
    optimize: bool = True,
) -> SourceSpec:
    """Spec of one registry row. ``start`` gives where the last load of a registry row ended, else the row's
    own start value counts; ``target`` is the silver table that a publisher sets. ``custom`` holds readers of CUSTOM sources by entity; a file source
    in streaming mode keeps its state below ``checkpoint_root``."""
    needed = ("source_system", "source_entity", "source_type", "landing_table",
              "conformance_table", "silver_table", "publish_mode")
    missing = [k for k in needed if not str(row.get(k) or "").strip()]
    if missing:
        raise ConfigError(f"source row lacks {missing}")
    flow_options, given = opt.by_consumer(json_object(row.get("source_options_json")))
    kind = str(row["source_type"]).strip().upper()
    mode = str(given.get("file_ingest_mode") or "batch").strip().lower()
    stream = checkpoint = expand = None
    if kind == "FILE" and mode == STREAM_MODE:
        reader = _no_batch_reader
        if checkpoint_root:
            names = [row.get(k) or "" for k in ("tenant", "product_name", "source_system", "source_entity")]
            checkpoint = "/".join([checkpoint_root.rstrip("/"), *[n for n in names if n]])
        # Beside the checkpoint, as folders inside it belong to the query.
        stream = _stream_reader(row, given, checkpoint and f"{checkpoint}-schema")
        if _is_mixed(row, given):
            expand = _mixed_batches(row, given)
    elif kind == "FILE":
        reader = _file_reader(row, given)
    elif kind == "JDBC":
        begin = start and start(row)
        reader = _jdbc_reader(row, given, begin or flow_options.get("incremental_start_value"), jdbc_profiles)
    elif kind == "API":
        reader = _page_reader(row, given)
    elif kind == "CUSTOM" and row["source_entity"] in (custom or {}):
        reader = custom[row["source_entity"]]
    else:
        raise ConfigError(f"no reader for source type {row['source_type']!r}")
    paths = {}
    for layer in ("landing", "conformance", "silver"):
        path = checked_path(row.get(f"{layer}_table_type"), row.get(f"{layer}_table_path"), prefixes)
        if path:
            paths[layer] = path
    rule = publish_rule or {}
    return SourceSpec(
        source_system=row["source_system"],
        source_entity=row["source_entity"],
        tenant=str(row.get("tenant") or ""),
        product=str(row.get("product_name") or ""),
        read=reader,
        landing_table=substitute(row["landing_table"]),
        conformance_table=substitute(row["conformance_table"]),
        silver_table=target or substitute(row["silver_table"]),
        checks=flow_options.get("bronze_dq") or {},
        mappings=list(mappings),
        rules=list(rules),
        primary_key=str(row.get("primary_key") or ""),
        publish_mode=str(rule.get("publish_mode") or row["publish_mode"]),
        merge_key=str(rule.get("merge_key") or ""),
        watermark_column=str(row.get("watermark_column") or "").strip() if kind == "JDBC" else "",
        sequence=str(rule.get("sequence_column") or "").strip() or None,
        partition_by=json_list(rule.get("partition_columns_json")),
        zorder_by=json_list(rule.get("optimize_zorder_json")),
        optimize=optimize,
        paths=paths,
        stream=stream,
        before_landing=expand,
        stream_options=given if stream else {},
        checkpoint=checkpoint,
        archive_table=flow_options.get("archive_table"),
        archive_hours=retention_hours(
            flow_options.get("archive_retention_days"), flow_options.get("archive_retention_hours")
        ),
    )


def from_control(
    spark: SparkSession,
    registry: DataFrame,
    mappings: DataFrame,
    rules: DataFrame,
    publish: DataFrame,
    product_name: str | None = None,
    source_system: str | None = None,
    source_entity: str | None = None,
    publishers: DataFrame | None = None,
    **options: Any,
) -> list[SourceSpec]:
    """Specs of the selected active sources. ``publishers`` may override catalog and schema of their
    silver tables (see ``control.target_table``).

    Plans are built on the driver, so the control rows of the chosen sources come there; they
    describe columns and rules, never data. File order of the rows is kept.
    """
    chosen = control.select_sources(registry, product_name, source_system, source_entity)
    if publishers is not None:
        named = ("publisher_name", "silver_object_name", "silver_file_name")
        lacking = {c: F.lit("") for c in named if c not in chosen.columns}
        chosen = control.target_table(chosen.withColumns(lacking) if lacking else chosen, publishers)
    sources = [r.asDict() for r in chosen.collect()]
    if not sources:
        known = control.active(registry).select(F.concat_ws(".", *control.ENTITY)).collect()
        logger.warning("no active source matches; available: %s", [r[0] for r in known])
        return []
    keys = sorted({f"{r['source_system']}.{r['source_entity']}".lower() for r in sources})

    def rows_of(frame: DataFrame) -> dict[tuple[str, str], list[dict[str, Any]]]:
        kept = control.active(frame).where(F.lower(F.concat_ws(".", *control.ENTITY)).isin(keys))
        found: dict[tuple[str, str], list[dict[str, Any]]] = {}
        for row in kept.collect():
            key = (row.source_system.lower(), row.source_entity.lower())
            found.setdefault(key, []).append(row.asDict())
        return found

    mapped, ruled, published = rows_of(mappings), rows_of(rules), rows_of(publish)
    specs = []
    for row in sources:
        key = (row["source_system"].lower(), row["source_entity"].lower())

        def of_product(rows: list[dict[str, Any]], product=row.get("product_name", "")) -> list[dict[str, Any]]:
            wanted = (product or "").lower()
            return [r for r in rows if not wanted or (r.get("product_name") or "").lower() == wanted]

        first = of_product(published.get(key, []))
        specs.append(
            build(
                row, of_product(mapped.get(key, [])), of_product(ruled.get(key, [])),
                first[0] if first else None, target=row.get("silver_target"), **options,
            )
        )
    return specs
