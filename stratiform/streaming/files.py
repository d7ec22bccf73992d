"""Incremental file ingestion with Structured Streaming."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratiform.errors import ConfigError
from stratiform.operators import publish
from stratiform.operators.landing import add_metadata, widen
from stratiform.plans.flow import AuditTables, RunResult, SourceSpec, run_source
from stratiform.sources import options as opt
from stratiform.sources.files import CORRUPT, fixed_width_fields, glob_into_path, mixed_records, read_mixed_json, without_corrupt
from stratiform.sources.rescue import parse_lines, widened_schema

OUTPUT_MODES = ("append", "complete", "update")


@dataclass(frozen=True)
class StreamOptions:
    """Options of a streaming source, split by what they steer."""

    reader: Mapping[str, str]
    schema_ddl: str | None
    evolution: str
    metadata: bool
    metadata_name: str | None
    query_name: str | None
    output_mode: str
    once: bool
    available_now: bool
    merge_schema: bool


def _flag(value: Any, default: bool) -> bool:
    if value is None:
        return default
    return value.strip().lower() == "true" if isinstance(value, str) else bool(value)


def stream_options(options: Mapping[str, Any] | None, evolution: str = "addNewColumns") -> StreamOptions:
    given = {k: v for k, v in (options or {}).items() if v is not None}
    dead = [k for k in opt.UNSUPPORTED_READER_OPTIONS if k in given]
    if dead:
        raise ConfigError(f"options without a meaning for the file source: {dead}")
    known = (
        opt.STREAM_READER_OPTIONS + opt.STREAM_WRITE_OPTIONS + opt.STREAM_CONTROL_OPTIONS
        + list(opt.INCREMENTAL_READER_OPTIONS)
    )
    opt.reject_unknown(given, known, "stream")
    reader = opt.chosen(given, opt.STREAM_READER_OPTIONS)
    extra = {
        target: given[name]
        for name, target in opt.INCREMENTAL_READER_OPTIONS.items()
        if target and name in given
    }
    for name in ("maxFilesPerTrigger", "maxBytesPerTrigger"):
        if name in extra:
            reader[name] = opt.spark_text(extra[name])
    if not _flag(extra.get("include_existing"), True):
        # Only files that appear from now on; the file source has no such switch of its own.
        reader["modifiedAfter"] = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    ddl = given.get("schema_ddl")
    if extra.get("schema_hints"):
        ddl = merged_ddl(ddl, str(extra["schema_hints"]))
    mode = str(extra.get("evolution", evolution))
    if mode not in opt.EVOLUTION_MODES:
        raise ConfigError(f"schema evolution mode must be one of {opt.EVOLUTION_MODES}, got {mode!r}")
    once = _flag(given.get("trigger_once"), False)
    now = _flag(given.get("trigger_available_now"), not once)
    if once and now:
        raise ConfigError("choose one of trigger_once and trigger_available_now")
    output = str(given.get("outputMode", "append")).strip()
    if output not in OUTPUT_MODES:
        raise ConfigError(f"output mode must be one of {OUTPUT_MODES}, got {output!r}")
    return StreamOptions(
        reader, ddl, mode, _flag(given.get("add_metadata_columns"), True),
        given.get("metadata_source_name"), given.get("queryName"), output, once, now,
        _flag(given.get("mergeSchema"), True),
    )


def merged_ddl(ddl: str | None, hints: str) -> str:
    """Schema in which hinted columns take the hinted type, new ones come last."""
    base = {f.name: f for f in T.StructType.fromDDL(ddl).fields} if ddl else {}
    base.update({f.name: f for f in T.StructType.fromDDL(hints).fields})
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.values())


def read_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    system: str,
    entity: str,
    options: Mapping[str, Any] | None = None,
    schema: T.StructType | str | None = None,
    schema_location: str | None = None,
) -> DataFrame:
    """Lazy stream over new files.

    JSON lines are read as text and parsed under the schema, so that unknown keys can be told from
    known ones. In *addNewColumns* mode the schema first learns the keys of the files that are there,
    and is kept in ``schema_location``; a key that turns up while the query runs stops it, and the next
    start knows it. Without ``schema_location`` every start looks through all files for keys.
    """
    if not str(path or "").strip():
        raise ConfigError("source path is required")
    parsed = stream_options(options)
    kind = opt.resolve_format(fmt, opt.STREAM_FORMATS)
    target = opt.STREAM_FORMATS[kind]
    wanted = schema if schema is not None else parsed.schema_ddl
    given = dict(parsed.reader)
    where = glob_into_path(path, given)
    whole_files = str(given.get("multiLine", "")).lower() == "true"
    by_line = target == "json" and parsed.evolution != "none" and wanted and not whole_files
    if by_line and parsed.evolution == "addNewColumns":
        wanted = evolved_schema(spark, where, given, wanted, schema_location)
    mixed = kind == "json_jsonl_mixed"
    if mixed:
        given["wholetext"] = "true"
    reader = spark.readStream.format("text" if by_line else target).options(**given)
    if wanted is not None and not by_line and target not in ("text", "binaryFile"):
        reader = reader.schema(wanted)
    frame = reader.load(where)
    if parsed.metadata:
        frame = frame.withColumns(source_columns(parsed, F.col("_metadata.file_path"), path, system, entity, kind))
    if by_line:
        late = "failOnNewColumns" if parsed.evolution == "addNewColumns" else parsed.evolution
        frame = parse_lines(frame, "value", wanted, late)
    elif mixed and wanted is not None:
        frame = mixed_records(frame, "value", wanted)
    elif kind in ("fixed-width", "fixed_width") and wanted is not None:
        frame = fixed_width_fields(frame, wanted)
    return frame


def source_columns(parsed: StreamOptions, file: Column, path: str, system: str, entity: str, kind: str) -> dict[str, Column]:
    source_id = f"{system}.{entity}"
    return {
        "_ingestion_ts": F.current_timestamp(),
        "_source_file": file,
        "_source_path": F.lit(path),
        "_source_id": F.lit(source_id),
        "_source_format": F.lit(kind),
        "_autoloader_format": F.lit(opt.STREAM_FORMATS[kind]),
        "_metadata_source_name": F.lit(parsed.metadata_name or source_id),
    }


def stream_of_files(spark: SparkSession, path: str, options: Mapping[str, Any] | None = None) -> DataFrame:
    """New files as rows (path, modificationTime, length); contents are not read. See ``mixed_batch``."""
    given = {k: v for k, v in stream_options(options).reader.items() if k in (*_FILE_CHOICE, *_BATCH_SIZE)}
    where = glob_into_path(path, given)
    entry = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(entry).options(**given).load(where).select("path", "modificationTime", "length")


def mixed_batch(found: DataFrame, path: str, system: str, entity: str, options: Mapping[str, Any]) -> DataFrame:
    """Records of the mixed JSON files that a micro-batch of ``stream_of_files`` names.

    The files are read split by split, so none has to fit a task. Their names come to the driver, where
    the file source has listed them before.
    """
    parsed = stream_options(options)
    names = [r.path for r in found.select("path").collect()]
    record = without_corrupt(parsed.schema_ddl)
    read = read_mixed_json(found.sparkSession, names, record, CORRUPT, file="_source_file")
    if not parsed.metadata:
        return read.drop("_source_file")
    return read.withColumns(source_columns(parsed, F.col("_source_file"), path, system, entity, "json_jsonl_mixed"))


def evolved_schema(
    spark: SparkSession, path: str, reader: Mapping[str, str], schema: T.StructType | str, location: str | None
) -> T.StructType:
    """The schema with all keys of the files so far; what ``location`` holds spares older files a look.

    Each start adds one line there: the schema, and the day from which files have to be looked at by
    the next start. A day, as the clocks of writers and readers differ.
    """
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    given, now = dict(reader), datetime.now(timezone.utc)
    if location:
        try:
            kept = [json.loads(r.value) for r in spark.read.text(location).collect()]
        except AnalysisException:
            kept = []
        for known in sorted(kept, key=lambda k: k["since"]):
            names = set(record.fieldNames())
            record = T.StructType(record.fields + [f for f in T.StructType.fromJson(known["schema"]).fields if f.name not in names])
            given["modifiedAfter"] = known["since"]
    lines = spark.read.format("text").options(**{k: v for k, v in given.items() if k in _FILE_CHOICE}).load(path)
    record = widened_schema(lines, "value", record)
    if location:
        since = (now - timedelta(days=1)).strftime("%Y-%m-%dT%H:%M:%S")
        line = json.dumps({"since": since, "schema": record.jsonValue()})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(location)
    return record


#: Reader options that choose files; the others concern their contents.
_FILE_CHOICE = ("recursiveFileLookup", "pathGlobFilter", "modifiedAfter", "modifiedBefore")
_BATCH_SIZE = ("maxFilesPerTrigger", "maxBytesPerTrigger")


def refreshed(spark: SparkSession, *tables: str) -> None:
    """Micro-batches write in a session of their own; the caller's must list the files of these tables anew."""
    for table in tables:
        if table and spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)


def triggered(writer, parsed: StreamOptions):
    # ``once`` is the older name of a single run over what is there.
    return writer.trigger(availableNow=True) if parsed.once or parsed.available_now else writer


def land_stream(
    frame: DataFrame,
    table: str,
    checkpoint: str,
    system: str,
    entity: str,
    load_id: str,
    options: Mapping[str, Any] | None = None,
    path: str | None = None,
    keys: Sequence[str] = (),
) -> StreamingQuery:
    """Write the stream to the landing table; the checkpoint tracks files exactly once.

    *append* adds the rows. The other modes are for streams that aggregate, by the columns ``keys``: after each
    micro-batch the table holds, with *complete*, the result as a new snapshot, and with *update* the
    changed groups upserted into those before. A batch that is repeated ends the same way.
    """
    if not str(table or "").strip():
        raise ConfigError("landing_table is required")
    parsed = stream_options(options)
    if parsed.output_mode != "append":
        return _land_result(frame, table, checkpoint, (system, entity, load_id), parsed, path, keys)
    landed = add_metadata(frame, system, entity, load_id)
    spark = frame.sparkSession
    if spark.catalog.tableExists(table):
        if parsed.merge_schema:
            widen(spark, table, landed)
        else:
            landed = landed.select(*[c for c in spark.table(table).columns if c in landed.columns])
    writer = landed.writeStream.outputMode(parsed.output_mode).option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    if parsed.query_name:
        writer = writer.queryName(parsed.query_name)
    query = triggered(writer, parsed).toTable(table)
    query.awaitTermination()
    return query


def _land_result(
    frame: DataFrame, table: str, checkpoint: str, names: tuple[str, str, str], parsed: StreamOptions, path: str | None, keys: Sequence[str]
) -> StreamingQuery:
    if parsed.output_mode == "update" and not keys:
        raise ConfigError("output mode update needs the grouping keys")

    def batch(rows: DataFrame, _: int) -> None:
        landed = add_metadata(rows, *names)
        if parsed.output_mode == "complete":
            publish.replace(landed, table, path)
        else:
            publish.replace_groups(landed, table, keys, path)

    writer = frame.writeStream.outputMode(parsed.output_mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
    if parsed.query_name:
        writer = writer.queryName(parsed.query_name)
    query = triggered(writer, parsed).start()
    query.awaitTermination()
    refreshed(frame.sparkSession, table)
    return query


def query_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps as long as its checkpoint exists, shortened to twelve digits."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()
    return hashlib.sha256(json.loads(row.value)["id"].encode()).hexdigest()[:12]


def run_stream(
    frame: DataFrame,
    spec: SourceSpec,
    checkpoint: str,
    tables: AuditTables = AuditTables(),
    options: Mapping[str, Any] | None = None,
    on_result: Callable[[RunResult], None] | None = None,
) -> StreamingQuery:
    """The whole flow, micro-batch by micro-batch.

    The load id names tenant, product, source, the query that the checkpoint belongs to, and the batch.
    A batch that is repeated after a failure finds its finished run in the audit table and is skipped,
    or reuses what had already landed. Another source or a new checkpoint never finds these.
    """
    parsed = stream_options(options)

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        names = [spec.tenant, spec.product, spec.source_system, spec.source_entity]
        load_id = "-".join([*[n for n in names if n], query_identity(spark, checkpoint), str(number)])
        if tables.pipeline_runs and spark.catalog.tableExists(tables.pipeline_runs):
            done = spark.table(tables.pipeline_runs).filter(
                (F.col("run_id") == load_id) & (F.col("status") == "SUCCESS")
            )
            if not done.isEmpty():
                return
        part = replace(spec, read=lambda _: rows)
        result = run_source(spark, part, tables, load_id=load_id, resume=True)
        if on_result:
            on_result(result)

    writer = frame.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if parsed.query_name:
        writer = writer.queryName(parsed.query_name)
    query = triggered(writer, parsed).start()
    query.awaitTermination()
    written = [getattr(tables, name) for name in tables.__dataclass_fields__]
    refreshed(frame.sparkSession, spec.landing_table, spec.conformance_table, spec.silver_table, spec.archive_table or "", *[t for t in written if t])
    return query
