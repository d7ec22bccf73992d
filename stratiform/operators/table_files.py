"""Files of a stored table: added and taken away by a repeatable step, packed, and known by their keys.

Rows are staged below the table's folder under a token. A plan, one small file, then says which staged
file becomes which file of the table and which files go. From then on the step can be repeated from any
point, by whoever works on the table next, and ends the same way; before, nothing has changed. Files
that the plan does not name keep their names and are not read.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratiform.operators import landing

#: Files of at least this part of the wanted size are left as they are by ``compact``.
FULL = 0.5
#: Files that one commit takes away at most; more are packed by further commits.
BATCH_FILES = 10_000
#: How long the plan of a finished step is kept, by which a repeated load knows that it was there.
KEPT_DAYS = 30


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def token_of(name: str) -> str:
    """A token that the same load always gets."""
    return hashlib.sha256(name.encode()).hexdigest()[:32]


class _Folder:
    """The few file-system calls that are needed, on whatever file system the table lies."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._hadoop = root, spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self.fs = self.at(root).getFileSystem(self._conf)

    def at(self, path: str):
        return self._hadoop.Path(path)

    def names(self, prefix: str) -> list[str]:
        if not self.fs.exists(self.at(self.root)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(self.root)) if s.getPath().getName().startswith(prefix))

    def files(self, path: str) -> list[tuple[str, int]]:
        """(path, size) of data files below ``path``, hidden ones and those in hidden folders left out."""
        found, walk = [], self.fs.listFiles(self.at(path), True) if self.fs.exists(self.at(path)) else None
        base = self.fs.makeQualified(self.at(path)).toString().rstrip("/")
        while walk is not None and walk.hasNext():
            status = walk.next()
            name = status.getPath().toString()
            if not any(part.startswith(("_", ".")) for part in name[len(base) :].split("/")):
                found.append((name, status.getLen()))
        return sorted(found)

    def drop_older(self, prefix: str, days: int) -> None:
        if not self.fs.exists(self.at(self.root)):
            return
        bound = (time.time() - days * 86_400) * 1000
        for status in self.fs.listStatus(self.at(self.root)):
            if status.getPath().getName().startswith(prefix) and status.getModificationTime() < bound:
                self.fs.delete(status.getPath(), False)

    def write(self, name: str, text: str) -> None:
        """Appears whole or not at all."""
        part = self.at(f"{self.root}/_part_{uuid.uuid4().hex}")
        out = self.fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.rename(part, self.at(f"{self.root}/{name}"))

    def read(self, name: str) -> str:
        source = self.fs.open(self.at(f"{self.root}/{name}"))
        try:
            return self._io.toString(source, "UTF-8")
        finally:
            source.close()

    def move(self, old: str, new: str) -> None:
        if self.fs.exists(self.at(old)):
            self.fs.mkdirs(self.at(new).getParent())
            self.fs.rename(self.at(old), self.at(new))

    def drop(self, path: str) -> None:
        self.fs.delete(self.at(path), True)


def finish_commits(spark: SparkSession, table: str) -> None:
    """Carry out the plans that are there; earlier attempts may have carried them out in part."""
    folder = _Folder(spark, location(spark, table))
    plans = folder.names("_commit_")
    for name in plans:
        plan = json.loads(folder.read(name))
        for old, new in plan["add"]:
            folder.move(old, new)
        for path in plan["drop"]:
            folder.drop(path)
        for spec in plan["partitions"]:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
        folder.drop(plan["staged"])
        folder.move(f"{folder.root}/{name}", f"{folder.root}/_done_{name.removeprefix('_commit_')}")
    if plans:
        spark.catalog.refreshTable(table)


def finished(spark: SparkSession, table: str, token: str) -> int | None:
    """Rows that a step of this token added before, if it was carried out."""
    folder = _Folder(spark, location(spark, table))
    return json.loads(folder.read(f"_done_{token}"))["rows"] if folder.names(f"_done_{token}") else None


def commit_rows(
    spark: SparkSession, table: str, rows: DataFrame, token: str | None = None, drop: Sequence[str] = (), again: bool = False
) -> int:
    """Add ``rows`` to a table that exists and take the files ``drop`` away, as one repeatable step.

    Returns the number of rows. With ``again`` a step of this token that was carried out before is known
    by its plan, and one that was planned is finished; neither is done twice. Plans that were carried
    out are kept for ``KEPT_DAYS``.
    """
    token = token or uuid.uuid4().hex
    root = location(spark, table)
    folder = _Folder(spark, root)
    finish_commits(spark, table)
    if again and (rows_before := finished(spark, table, token)) is not None:
        return rows_before
    folder.drop_older("_done_", KEPT_DAYS)
    parts = partition_columns(spark, table)
    staged = f"{root}/_staged_{token}"
    seen = Observation(f"commit-{uuid.uuid4().hex}")
    ready = landing.aligned(rows, spark, table).observe(seen, F.count(F.lit(1)).alias("n"))
    # Spark itself hides folders whose names begin like this one from readers of the table.
    writer = ready.write.mode("overwrite")
    (writer.partitionBy(*parts) if parts else writer).parquet(staged)
    written = folder.files(staged)
    base = folder.fs.makeQualified(folder.at(staged)).toString().rstrip("/")
    add = []
    for number, (path, _) in enumerate(written):
        inner = path[len(base) + 1 :].rsplit("/", 1)
        suffix = inner[-1].split(".", 1)[-1]
        add.append([path, "/".join([root, *inner[:-1], f"{token}-{number:05}.{suffix}"])])
    specs = []
    if parts and written:
        kinds = spark.table(table).schema
        values = spark.read.option("basePath", staged).schema(kinds).parquet(staged).select(*parts).distinct()
        specs = [", ".join(f"`{k}` = {landing.partition_literal(v)}" for k, v in r.asDict().items()) for r in values.toLocalIterator()]
    folder.write(f"_commit_{token}", json.dumps({"add": add, "drop": list(drop), "partitions": specs, "staged": staged, "rows": int(seen.get["n"])}))
    finish_commits(spark, table)
    return int(seen.get["n"])


def data_files(spark: SparkSession, table: str) -> list[tuple[str, int]]:
    """(path, size) of the table's files."""
    root = location(spark, table)
    return _Folder(spark, root).files(root)


def read_files_of(spark: SparkSession, table: str, paths: Sequence[str]) -> DataFrame:
    """Rows of some files of the table, with its columns."""
    schema = spark.table(table).schema
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", location(spark, table)).parquet(*paths)


def bins(files: Sequence[tuple[str, int]], target: int, least: int) -> list[list[str]]:
    """Small files dealt to bins of about ``target`` bytes, smallest first, within their folder.

    A folder with fewer than ``least`` small files is left alone, so that a load does not rewrite the one
    before it; so are bins of one file.
    """
    folders: dict[str, list[tuple[int, str]]] = {}
    for path, size in files:
        if size < FULL * target:
            folders.setdefault(path.rsplit("/", 1)[0], []).append((size, path))
    found: list[list[str]] = []
    for small in folders.values():
        if len(small) < least:
            continue
        own: list[list[str]] = [[]]
        held = 0
        for size, path in sorted(small):
            if own[-1] and held + size > target:
                own.append([])
                held = 0
            own[-1].append(path)
            held += size
        found += [b for b in own if len(b) > 1]
    return found


def stored_cells(spark: SparkSession, table: str, columns: Sequence[str]) -> list[list] | None:
    """The cell bounds that earlier writes of the table used for these columns."""
    folder = _Folder(spark, location(spark, table))
    if not folder.names("_cells.json"):
        return None
    known = json.loads(folder.read("_cells.json"))
    return [known[c] for c in columns] if all(c in known for c in columns) else None


def store_cells(spark: SparkSession, table: str, columns: Sequence[str], bounds: Sequence[Sequence]) -> None:
    folder = _Folder(spark, location(spark, table))
    folder.drop(f"{folder.root}/_cells.json")
    folder.write("_cells.json", json.dumps(dict(zip(columns, bounds, strict=True))))


def key_ranges(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Lowest and highest value of each key in each file: path, low_<key>, high_<key>.

    Kept beside the table; only files that are new since the last call are read, and only their key columns.
    """
    root = location(spark, table)
    folder = _Folder(spark, root)
    store = f"{root}/_key_ranges_{token_of(','.join(keys))[:12]}"
    kinds = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields}
    schema = "path string, " + ", ".join(f"`low_{k}` {kinds[k]}, `high_{k}` {kinds[k]}" for k in keys)
    known = spark.read.schema(schema).parquet(store) if folder.fs.exists(folder.at(store)) else spark.createDataFrame([], schema)
    there = spark.createDataFrame([(p,) for p, _ in data_files(spark, table)], "path string")
    fresh = [r.path for r in there.join(known.select("path"), "path", "left_anti").collect()]
    if fresh:
        # File names as the scan gives them are escaped; the last part, the name, is unique in a table.
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        ends = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("low", F.min), ("high", F.max))]
        found = read_files_of(spark, table, fresh).select(*keys, name.alias("name")).groupBy("name").agg(*ends)
        named = spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in fresh], "path string, name string")
        named.join(found, "name").select(*[c.split()[0].strip("`") for c in schema.split(", ")]).coalesce(1).write.mode("append").parquet(store)
        known = spark.read.schema(schema).parquet(store)
    return known.join(there, "path", "left_semi")
