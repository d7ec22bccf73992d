"""Files that tasks list and read themselves, where there are more of them than the driver can hold.

Spark's file source keeps an entry of each file in the driver, and counts each as some MB, so that a task
gets a handful of small files. Here tasks list folders and open files by path, through pyarrow; the driver only
learns how many folders there are.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators.keyed import measure

#: Rows that a task sends on at a time, bytes of contents that it holds, and folders that a task lists when there are many.
BATCH_ROWS = 10_000
BATCH_BYTES = 32 << 20
TASK_FOLDERS = 100


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path on it."""
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def _is_hidden(name: str, is_folder: bool) -> bool:
    """Whether Spark's file source passes over an entry."""
    if is_folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _entries(folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """(name, is_folder, length, milliseconds) of what lies in a folder; a local one is read as a stream."""
    system, inner = opened(folder)
    if not isinstance(system, fs.LocalFileSystem):
        for info in system.get_file_info(fs.FileSelector(inner)):
            yield info.base_name, info.type == fs.FileType.Directory, info.size or 0, (info.mtime_ns or 0) // 1_000_000
        return
    with os.scandir(inner) as found:
        for entry in found:
            try:
                stat = entry.stat()
            except FileNotFoundError:  # a link to nothing, or gone meanwhile
                continue
            yield entry.name, entry.is_dir(), stat.st_size, stat.st_mtime_ns // 1_000_000


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length) of all files below a folder, as ``files.listing`` has them, listed by tasks.

    A task holds a few thousand entries at a time, of local folders of any size; elsewhere one folder has to fit it.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                seen = (x for x in _entries(folder) if not _is_hidden(x[0], x[1]) and (x[1] or x[2]))
                while some := list(itertools.islice(seen, BATCH_ROWS)):
                    names, folders, lengths, times = zip(*some)
                    yield pa.RecordBatch.from_pydict({
                        "path": pa.array([f"{folder.rstrip('/')}/{n}" for n in names], "string"), "is_folder": pa.array(folders, "bool"),
                        "length": pa.array(lengths, "int64"), "millis": pa.array(times, "int64"),
                    })

    kind = "path string, is_folder boolean, length bigint, millis bigint"
    level, files = spark.range(1, numPartitions=1).select(F.lit(root).alias("path")), None
    while level is not None:
        held = measure(level.mapInArrow(entries, kind), "listed", F.count_if("is_folder").alias("folders"))
        own = held.frame.where("NOT is_folder").select("path", F.timestamp_millis("millis").alias("modificationTime"), "length")
        files, folders, level = own if files is None else files.unionAll(own), held.seen["folders"], None
        if folders:
            tasks = min(folders, max(spark.sparkContext.defaultParallelism, -(-folders // TASK_FOLDERS)))
            level = held.frame.where("is_folder").select("path").repartition(tasks, "path")
    return files


def with_contents(frame: DataFrame, path: str) -> DataFrame:
    """``frame`` and the content of the file that the column ``path`` names; NULL where it names none that is there."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(batch: pa.RecordBatch, start: int, contents: list[bytes | None]) -> pa.RecordBatch:
            rows = batch.slice(start, len(contents))
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(contents, "binary")], [*rows.schema.names, "content"])

        for batch in batches:
            start, size, contents = 0, 0, []
            for name in batch.column(path).to_pylist():
                content = None
                if name is not None:
                    system, inner = opened(name)
                    try:
                        with system.open_input_file(inner) as source:
                            content = source.read()
                    except FileNotFoundError:
                        pass
                contents.append(content)
                size += len(content or b"")
                if size >= BATCH_BYTES:
                    yield joined(batch, start, contents)
                    start, size, contents = start + len(contents), 0, []
            if contents:
                yield joined(batch, start, contents)

    return frame.mapInArrow(read, T.StructType([*frame.schema, T.StructField("content", T.BinaryType())]))
