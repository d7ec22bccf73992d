"""Batch file scans."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.errors import ConfigError
from stratiform.operators.keyed import measure
from stratiform.session import is_shared
from stratiform.sources import options as opt
from stratiform.sources.json_values import MAX_VALUE, chunks_of, json_chunks

LOAD_TYPES = ("full", "incremental")


def glob_into_path(path: str, options: dict[str, str]) -> str:
    """``pathGlobFilter`` tests the file name only; a directory glob belongs to the load path."""
    pattern = options.get("pathGlobFilter", "")
    if "/" not in pattern:
        return path
    del options["pathGlobFilter"]
    return posixpath.join(path, pattern)


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    options: Mapping[str, Any] | None = None,
    load_type: str = "incremental",
    since: str | None = None,
    schema: T.StructType | str | None = None,
    default_format: str = opt.DEFAULT_FORMAT,
) -> DataFrame:
    """Lazy scan of files. With ``since``, an incremental load takes only files modified later;
    files are pruned by their metadata, for every format."""
    if not str(path or "").strip():
        raise ConfigError("source path is required")
    if load_type not in LOAD_TYPES:
        raise ConfigError(f"load type must be one of {LOAD_TYPES}, got {load_type!r}")
    opt.reject_unknown(options, opt.READER_OPTIONS + opt.FILE_CONTROL_OPTIONS, "file reader")
    kind = opt.resolve_format(fmt, opt.BATCH_FORMATS, default_format)
    given = opt.chosen(options, opt.READER_OPTIONS)
    where = glob_into_path(path.strip(), given)
    start = since or (options or {}).get("incremental_start_timestamp")
    fixed = kind in ("fixed-width", "fixed_width") and schema is not None
    reader = spark.read.format("text" if fixed else opt.BATCH_FORMATS[kind]).options(**given)
    if schema is not None and not fixed and opt.BATCH_FORMATS[kind] != "binaryFile":
        reader = reader.schema(schema)
    frame = reader.load(where)
    if load_type == "incremental" and start:
        frame = newer_files(frame, start)
    return fixed_width_fields(frame, schema) if fixed else frame


def newer_files(frame: DataFrame, since: str) -> DataFrame:
    """Rows of files modified strictly after ``since``."""
    modified = F.col("_metadata.file_modification_time")
    return frame.filter(modified > F.lit(since).cast("timestamp"))


def read_mixed_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, bad: str | None = None,
    max_value: int = MAX_VALUE, file: str | None = None,
) -> DataFrame:
    """Records of files that hold JSON arrays, objects over any number of lines, or JSON lines, in any mixture.

    Files of any size are read split by split (see ``json_chunks``); only a single value has to fit a task. A
    value that is no object, and text that cannot be parsed, gives a record of NULLs; ``bad`` names a column
    for its text, ``file`` one for the file it is in. A broken value that holds intact objects on lines of
    their own gives these.
    """
    named = [F.col("file").alias(file)] if file else []
    chunks = json_chunks(spark, path, max_value).select(*named, F.struct("text", "is_value").alias("__chunk"))
    return _chunk_records(chunks, F.array("__chunk"), "__chunk", schema, bad)


def mixed_records(
    bodies: DataFrame, body: str, schema: T.StructType | str, bad: str | None = None
) -> DataFrame:
    """Records of whole JSON texts, in all shapes that ``read_mixed_json`` reads, with the other columns."""

    @F.pandas_udf("array<struct<text string, is_value boolean>>")
    def chunked(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda text: [(part.decode("utf-8", "replace"), kind == "value") for kind, part in chunks_of((text or "").encode())]
        )

    return _chunk_records(bodies, chunked(F.col(body)), body, schema, bad)


def _chunk_records(frame: DataFrame, chunks: Column, source: str, schema: T.StructType | str, bad: str | None) -> DataFrame:
    """Records of chunks (text, is_value): values as they are, other texts by those of their lines that are objects."""
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def is_object(text: Column) -> Column:
        return text.startswith("{") & F.try_parse_json(text).isNotNull()

    def parts(chunk: Column) -> Column:
        text = F.btrim(chunk["text"], F.lit(BLANKS))
        trimmed = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS + ",")))
        lines = F.filter(trimmed, lambda line: F.length(line) > 0)
        whole = chunk["is_value"] & is_object(text)
        return F.when(~whole & F.exists(lines, is_object), lines).otherwise(F.array(text))

    others = [c for c in frame.columns if c != source]
    values = frame.select(*others, F.explode(F.flatten(F.transform(chunks, parts))).alias("__value"))
    broken = ~is_object(F.col("__value"))
    kept = [F.when(F.col("__broken"), F.col("__value")).alias(bad)] if bad else []
    parsed = F.when(broken, F.from_json(F.lit("{}"), record)).otherwise(F.from_json("__value", record))
    found = values.select(*others, "__value", broken.alias("__broken"), parsed.alias("__r"))
    return found.select(*others, "__r.*", *kept)


#: Column in which control-driven runs keep the text that cannot be parsed.
CORRUPT = "_corrupt_record"


def without_corrupt(schema: T.StructType | str) -> T.StructType:
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([f for f in record.fields if f.name != CORRUPT])


#: What surrounds values, a mark at the start of a file included.
BLANKS = " \t\r\n\ufeff"


def fixed_width(lines: DataFrame, columns: Sequence[tuple[str, int, int, str]]) -> DataFrame:
    """Cut text lines into (name, start, length, type) columns; starts count from 1."""
    return lines.select(
        *[
            F.trim(F.substring("value", start, length)).try_cast(kind).alias(name)
            for name, start, length, kind in columns
        ]
    )


def fixed_width_fields(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Cut text lines by a schema whose columns carry their place as a comment: ``name type COMMENT
    'start:length'``. Other columns of ``lines`` stay."""
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    cuts = []
    for field in record.fields:
        place = (field.metadata or {}).get("comment", "").split(":")
        if len(place) != 2 or not all(p.strip().isdigit() for p in place):
            raise ConfigError(f"fixed-width column {field.name!r} needs the comment 'start:length'")
        cuts.append((field.name, int(place[0]), int(place[1]), field.dataType.simpleString()))
    others = [c for c in lines.columns if c != "value"]
    cut = [F.trim(F.substring("value", start, length)).try_cast(kind).alias(name) for name, start, length, kind in cuts]
    return lines.select(*others, *cut)


def listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length) of files; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return files.load(path).select("path", "modificationTime", "length")


def log_listing(spark: SparkSession, path: str) -> DataFrame:
    """Entries of table-log folders one level below ``path``; plain listings skip such folders."""
    entries = spark.read.format("binaryFile").load(posixpath.join(path, "*", "_delta_log", "*"))
    return entries.select("path", "modificationTime", "length")


def file_profile(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.min("modificationTime").alias("first_modified"),
        F.max("modificationTime").alias("last_modified"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
    )


def raw_sample(files: DataFrame, count: int = 1000) -> DataFrame:
    """A few file entries to look at; the sample is the feature."""
    return files.limit(count)


def layout(files: DataFrame) -> DataFrame:
    """Per folder: number of files, of snappy parquet files and of table-log entries."""
    parts = files.select(
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
    )
    logs = F.col("folder").rlike(r"/_delta_log(/|$)")
    home = F.when(logs, F.regexp_replace("folder", r"/_delta_log(/.*)?$", "")).otherwise(F.col("folder"))
    return parts.groupBy(home.alias("folder")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("name").endswith(".parquet")).alias("parquet_files"),
        F.count_if(F.col("name").endswith(".snappy.parquet")).alias("snappy_parquet_files"),
        F.count_if(logs).alias("log_entries"),
    )


def layout_summary(folders: DataFrame, expected_folders: int | None = None) -> DataFrame:
    everywhere = F.bool_and(F.col("snappy_parquet_files") > 0)
    as_expected = (
        F.lit(None).cast("boolean")
        if expected_folders is None
        else F.count(F.lit(1)) == expected_folders
    )
    return folders.agg(
        F.count(F.lit(1)).alias("folders"),
        F.sum("snappy_parquet_files").alias("snappy_parquet_files"),
        everywhere.alias("all_folders_match"),
        as_expected.alias("folder_count_as_expected"),
    )


def attachment_refs(df: DataFrame, field: str) -> DataFrame:
    """Distinct non-empty values of a field."""
    if field not in df.columns:
        raise ConfigError(f"attachment field {field!r} is not in the frame")
    ref = F.col(field).cast("string").alias("ref")
    return df.select(ref).filter((F.col("ref").isNotNull()) & (F.trim("ref") != "")).distinct()


#: Bytes of files and number of files for one task that copies, most such tasks, and bytes that a task holds at a time.
COPY_BYTES = 1 << 30
COPY_FILES = 5_000
MOST_COPY_TASKS = 10_000
COPY_CHUNK = 8 << 20


def copy_attachments(
    refs: DataFrame, files: DataFrame, destination: str, fail_on_error: bool = False
) -> DataFrame:
    """Copy referenced files and report (ref, new_path, error) per reference.

    ``files`` is a listing (path, length), as ``listing`` makes it, or ``stores.listing`` where the driver cannot
    hold all files: tasks then read each file from its store in chunks, so that no file has to fit a row, and get
    about ``COPY_BYTES`` of files each, ``COPY_FILES`` at most on average. With a binaryFile scan (path, content)
    contents pass through rows instead, which any store that Spark reads allows, up to 2 GB a file. A list of
    references that is small enough is broadcast; a longer one meets the files by path. ``destination`` is a URL
    of a file system that all executors reach, or lies below the folder of ``spark.checkpoint.dir``, which they
    share; any other local path is for local sessions only.
    """
    session = refs.sparkSession
    is_local = session.sparkContext.master.split("[")[0] == "local"
    on_disk = destination.startswith(("/", "file:")) or "://" not in destination
    if not is_local and on_disk and not is_shared(session, destination):
        raise ConfigError(f"executors do not share {destination!r}: give the URL of a common file system")
    plain = F.regexp_replace(F.col("path"), r"^file:/+", "/")
    wanted = measure(refs.select("ref").distinct(), "attachments")
    side = F.broadcast(wanted.frame) if wanted.fits_broadcast else wanted.frame
    streamed = "content" not in files.columns
    if streamed:
        length = F.col("length") if "length" in files.columns else F.lit(0)
        listed = files.select(plain.alias("__path"), F.col("path").alias("content"), length.alias("length"))
        total = F.coalesce(F.sum("length"), F.lit(0)).alias("total")
        met = measure(listed.join(side, F.col("ref") == F.col("__path")).select("ref", "content", "length"), "attachments-found", total)
        tasks = max(-(-int(met.seen["total"]) // COPY_BYTES), -(-met.rows // COPY_FILES))
        found = met.frame.repartition(max(1, min(MOST_COPY_TASKS, tasks)), "ref")
        lost = wanted.frame.join(met.frame.select("ref"), "ref", "left_anti")
    else:
        found = files.select(plain.alias("__path"), "content").join(side, F.col("ref") == F.col("__path"))
        here = files.select(plain.alias("__path")).join(side, F.col("ref") == F.col("__path"), "left_semi")
        lost = wanted.frame.join(here, F.col("ref") == F.col("__path"), "left_anti")

    def write(batches: Iterator) -> Iterator:
        import hashlib
        import re

        import pandas as pd
        from pyarrow import fs

        def chunks(content):
            """The bytes themselves, or those of the file that is named, some at a time."""
            if not streamed:
                yield content
                return
            if content.startswith(("/", "file:")):
                store, inner = fs.LocalFileSystem(), re.sub("^file:/+", "/", content)
            else:
                store, inner = fs.FileSystem.from_uri(content)
            with store.open_input_stream(inner) as source:
                while block := source.read(COPY_CHUNK):
                    yield block

        system, root = fs.FileSystem.from_uri(destination)
        base = destination[: len(destination) - len(root)] if destination.endswith(root) else ""
        system.create_dir(root, recursive=True)
        for batch in batches:
            rows = []
            for ref, content in zip(batch["ref"], batch["content"]):
                tag = hashlib.sha256(ref.encode()).hexdigest()[:32]
                target = f"{root.rstrip('/')}/{tag}_{posixpath.basename(ref)}"
                try:
                    # A task that runs again replaces its own partial file.
                    with system.open_output_stream(f"{target}.part") as out:
                        for block in chunks(content):
                            out.write(block)
                    system.move(f"{target}.part", target)
                    rows.append((ref, base + target, None))
                except OSError as exc:
                    if fail_on_error:
                        raise
                    rows.append((ref, None, str(exc)))
            yield pd.DataFrame(rows, columns=["ref", "new_path", "error"])

    report = "ref string, new_path string, error string"
    copied = found.select("ref", "content").mapInPandas(write, report)
    text = F.concat(F.lit("file not found: "), F.col("ref"))
    problem = F.raise_error(text).cast("string") if fail_on_error else text
    missing = lost.select("ref", F.lit(None).cast("string").alias("new_path"), problem.alias("error"))
    return copied.unionAll(missing)
