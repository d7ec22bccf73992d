"""Silver layer: append, upsert and ordered deduplication."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.errors import DuplicateKeyError
from stratiform.functions.columns import any_null
from stratiform.operators import cluster, landing, table_files
from stratiform.operators.keyed import (
    COPIES,
    Measured,
    drop_matching,
    keep_matching,
    key_counts,
    latest_per_key,
    measure,
)
from stratiform.session import drop_folder, new_folder

_SNAPSHOT = re.compile(r"_snapshot_[0-9a-f]{32}$")
_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)
#: Column that names a group by all its keys, as JSON.
_GROUP = "group_key"
_PREVIOUS = "stratiform.previous_snapshot"


def append(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    zorder_by: Sequence[str] = (),
    load: str | None = None,
    again: bool = False,
) -> int:
    """Append rows, grouped by table partition and optionally clustered within; how many were written.

    The files are put in place by a step that can be repeated. ``load`` names it: with ``again`` a load that
    is there already, in whole or in part, ends up there once.
    """
    spark = df.sparkSession
    landing.checked_table(table)
    if not spark.catalog.tableExists(table):
        landing.create_table(spark, table, df.schema, path, partition_by)
    parts = table_files.partition_columns(spark, table)
    if zorder_by:
        cells = _cells(spark, table, df, zorder_by)
        rows = cluster.packed(df, list(zorder_by), parts, cells=cells).drop(cluster.Z_COLUMN)
    else:
        rows = landing.rebalanced(df, parts)
    token = table_files.token_of(load) if load else None
    return table_files.commit_rows(spark, table, rows, token, again=again)


def appended(spark: SparkSession, table: str, load: str) -> int | None:
    """Rows that an earlier attempt of a load has appended, if it came to its plan; what it left undone is done."""
    if not spark.catalog.tableExists(landing.checked_table(table)):
        return None
    table_files.finish_commits(spark, table)
    return table_files.finished(spark, table, table_files.token_of(load))


def _cells(spark: SparkSession, table: str, df: DataFrame, columns: Sequence[str]) -> list[list]:
    """Cell bounds of a table: those stored by its first clustered write, else those of ``df``, which are then stored."""
    known = table_files.stored_cells(spark, table, columns)
    if known is None:
        known = cluster.cell_bounds(df, list(columns), cluster.bits_for(columns))
        table_files.store_cells(spark, table, columns, known)
    return known


def latest(df: DataFrame, keys: Sequence[str], sequence: str, ties: Sequence[str] = ()) -> DataFrame:
    """Newest row per key by ``sequence``; rows with a NULL key are all kept.

    Equal sequences are settled by ``ties``, then by the remaining columns.
    """
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in (*keys, sequence, *ties) and f.dataType.typeName() not in ("map", "variant")
    ]
    order = [F.desc_nulls_last(c) for c in (sequence, *ties, *rest)]
    keyed = latest_per_key(df.filter(~any_null(keys)), keys, order)
    return keyed.unionAll(df.filter(any_null(keys)))


def key_side(src: DataFrame, keys: Sequence[str]) -> Measured:
    """Distinct non-NULL keys with their number of rows.

    Lowest and highest values of plain keys are noted, to prune scans of what they are compared with.
    """
    counted = key_counts(src.filter(~any_null(keys)), keys)
    ranges = [
        bound(key).alias(f"{name}_{key}")
        for key in keys
        if isinstance(src.schema[key].dataType, _RANGED)
        for name, bound in (("low", F.min), ("high", F.max))
    ]
    return measure(counted, "upsert-keys", F.max(COPIES).alias("most_copies"), *ranges)


def source_keys(src: DataFrame, keys: Sequence[str]) -> Measured:
    """Keys of an upsert source, as ``key_side`` has them; repeated keys are refused."""
    side = key_side(src, keys)
    if (side.seen.get("most_copies") or 0) > 1:
        raise DuplicateKeyError(f"upsert source repeats keys {list(keys)}: deduplicate it first")
    return side


def _within(target: DataFrame, side: Measured, keys: Sequence[str]) -> DataFrame:
    """Target rows inside the key ranges of the source; scans skip row groups by these constants."""
    for key in keys:
        low, high = side.seen.get(f"low_{key}"), side.seen.get(f"high_{key}")
        if low is not None and high is not None:
            kind = target.schema[key].dataType
            target = target.filter(F.col(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    return target


def upsert(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    sequence: str | None = None,
    soft_delete: Column | None = None,
    deleted_flag: str = "is_deleted",
) -> DataFrame:
    """Target with matching rows replaced and new rows added.

    NULL keys match nothing, so such source rows are added. ``sequence`` first reduces the source
    to its newest row per key. ``soft_delete`` marks source rows that delete their key: the row
    stays, flagged in ``deleted_flag``.
    """
    if sequence:
        src = latest(src, keys, sequence)
    if soft_delete is not None:
        src = src.withColumn(deleted_flag, F.coalesce(soft_delete, F.lit(False)))
        if deleted_flag not in target.columns:
            target = target.withColumn(deleted_flag, F.lit(False))
    kept = drop_matching(target, source_keys(src, keys), keys)
    return landing.evolve(kept, src)


def _switch_snapshot(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Write ``rows`` beside the table's files and point the table there.

    Readers see the old or the new snapshot, never a mix. The one before the last switch is kept
    for readers that are still at work; older ones are removed.
    """
    current = table_files.location(spark, table)
    base = _SNAPSHOT.sub("", current)
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    fresh = f"{base}_snapshot_{uuid.uuid4().hex}"
    rows.write.parquet(fresh)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PREVIOUS}' = '{current}')")
    spark.catalog.refreshTable(table)
    older = properties.get(_PREVIOUS, "")
    if _SNAPSHOT.search(older):
        drop_folder(spark, older)


def merge(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    path: str | None = None,
    sequence: str | None = None,
    zorder_by: Sequence[str] = (),
    soft_delete: Column | None = None,
    deleted_flag: str = "is_deleted",
) -> None:
    """Upsert into a stored table.

    ``zorder_by`` clusters what is rewritten. ``soft_delete`` marks source rows that delete their key:
    the row stays, flagged in ``deleted_flag``. A partitioned table has only those partitions rewritten that hold a matching key or receive
    rows. Of another table only the files that hold a matching key are read and replaced, as one repeatable
    step; readers that list the table meanwhile may see rows of both. If these files are most of the
    table, the new snapshot is written beside the old one and the table then points to it, so readers
    see either all of the change or none.
    """
    spark = df.sparkSession
    landing.checked_table(table)
    for column in (*keys, *zorder_by):
        landing.checked_column(column)
    if soft_delete is not None:
        df = df.withColumn(deleted_flag, F.coalesce(soft_delete, F.lit(False)))
    staged = new_folder(spark, "upsert-source")
    # Its keys, its partitions and its rows are read from one stored copy.
    (latest(df, keys, sequence) if sequence else df).write.parquet(staged)
    src = spark.read.schema(df.schema).parquet(staged)
    side = source_keys(src, keys)
    try:
        _merge_stored(spark, src, side, table, keys, partition_by, path, zorder_by)
    finally:
        side.drop()
        drop_folder(spark, staged)


def _merge_stored(
    spark: SparkSession, src: DataFrame, side: Measured, table: str, keys: Sequence[str],
    partition_by: Sequence[str], path: str | None, zorder_by: Sequence[str],
) -> None:
    if not spark.catalog.tableExists(table):
        append(src, table, partition_by, path, zorder_by)
        return
    table_files.finish_commits(spark, table)
    landing.widen(spark, table, src)
    target = spark.table(table)
    parts = table_files.partition_columns(spark, table)
    # Bounds come from what is stored already: the merged rows are evaluated once, by their write.
    cells = _cells(spark, table, src, zorder_by) if zorder_by else None
    if not parts:
        sizes = dict(table_files.data_files(spark, table))
        hit_files = files_with(spark, table, side, keys, list(sizes))
        most = sum(sizes[f] for f in hit_files) > _SNAPSHOT_SHARE * sum(sizes.values())
        held = target if most else table_files.read_files_of(spark, table, hit_files)
        merged = landing.evolve(drop_matching(held, side, keys), src).select(*target.columns)
        if zorder_by:
            merged = cluster.packed(merged, list(zorder_by), cells=cells).drop(cluster.Z_COLUMN)
        if most:
            _switch_snapshot(spark, merged, table)
        else:
            table_files.commit_rows(spark, table, merged, drop=hit_files)
        return

    old = keep_matching(_within(target, side, keys), side, keys)
    hit = old.select(*parts).unionAll(src.select(*parts)).distinct()
    touched = measure(hit, "touched-partitions")
    # Partition values are catalog entries: as constants they keep other partitions from being listed.
    values = [r.asDict() for r in touched.frame.toLocalIterator()]
    scope = target.filter(_in_partitions(target, values))
    merged = landing.evolve(drop_matching(scope, side, keys), src).select(*target.columns)
    stage = new_folder(spark, "staged")
    if zorder_by:
        merged = cluster.packed(merged, list(zorder_by), parts, cells=cells)
    staged = _replace_partitions(spark, merged, table, stage, [cluster.Z_COLUMN, *zorder_by] if zorder_by else [])
    left = staged.select(*[F.col(p).alias(f"__{p}") for p in parts]).distinct()
    emptied = touched.frame.join(left, _same(parts), "left_anti")
    for row in emptied.toLocalIterator():
        landing.drop_partition(spark, table, row.asDict())
    touched.drop()
    drop_folder(spark, stage)


#: Segments of the source's keys that are compared with the key ranges of files.
_SEGMENTS = 64
#: If more than this part of a table's bytes is to be replaced, it gets a new snapshot.
_SNAPSHOT_SHARE = 0.5


def files_with(spark: SparkSession, table: str, side: Measured, keys: Sequence[str], paths: Sequence[str]) -> list[str]:
    """Files of an unpartitioned table that hold a key of the source.

    Their stored key ranges leave out most files of a table in some order of a key; of the others the key
    columns alone are read.
    """
    ranged = [k for k in keys if side.seen.get(f"low_{k}") is not None]
    candidates = list(paths)
    if ranged:
        first = ranged[0]
        ends = side.frame.repartitionByRange(_SEGMENTS, first).groupBy(F.spark_partition_id()).agg(F.min(first).alias("low"), F.max(first).alias("high"))
        segments = [(r.low, r.high) for r in ends.collect() if r.low is not None]
        meets = F.lit(False)
        for low, high in segments:
            meets = meets | ((F.col(f"high_{first}") >= F.lit(low)) & (F.col(f"low_{first}") <= F.lit(high)))
        candidates = [r.path for r in table_files.key_ranges(spark, table, ranged).where(meets).select("path").collect()]
    if not candidates:
        return []
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("__file")
    rows = table_files.read_files_of(spark, table, candidates).select(*keys, name)
    hit = {r[0] for r in keep_matching(_within(rows, side, keys), side, keys).select("__file").distinct().collect()}
    return [p for p in candidates if p.rsplit("/", 1)[-1] in hit]


def compact(
    spark: SparkSession, table: str, zorder_by: Sequence[str] = (), target: int = 128 << 20, least: int = 4
) -> int:
    """Pack the small files of each folder of a table into files of about ``target`` bytes; how many went.

    Only small files are read and replaced, the others keep their names. With ``zorder_by`` the packed
    rows are clustered in the cells that the table has stored, in which later loads fall as well.
    """
    landing.checked_table(table)
    for column in zorder_by:
        landing.checked_column(column)
    table_files.finish_commits(spark, table)
    parts = table_files.partition_columns(spark, table)
    waiting, gone = table_files.bins(table_files.data_files(spark, table), target, least), 0
    while waiting:
        chosen, names = [], []
        while waiting and len(names) < table_files.BATCH_FILES:
            chosen.append(waiting.pop())
            names += chosen[-1]
        rows = table_files.read_files_of(spark, table, names)
        cells = _cells(spark, table, rows, zorder_by) if zorder_by else None
        packed = cluster.packed(rows, list(zorder_by), parts, len(chosen), cells).drop(cluster.Z_COLUMN)
        table_files.commit_rows(spark, table, packed, drop=names)
        gone += len(names)
    return gone


def replace(df: DataFrame, table: str, path: str | None = None) -> None:
    """Make ``df`` all rows of an unpartitioned table, by a new snapshot."""
    spark = df.sparkSession
    landing.checked_table(table)
    if not spark.catalog.tableExists(table):
        append(df, table, path=path)
        return
    _switch_snapshot(spark, landing.aligned(df, spark, table), table)


def replace_groups(df: DataFrame, table: str, keys: Sequence[str], path: str | None = None) -> None:
    """Upsert groups by their keys, in which NULL is a value like others: a group replaces itself."""
    marked = df.withColumn(_GROUP, F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"}))
    merge(marked, table, [_GROUP], path=path)


def _in_partitions(target: DataFrame, values: Sequence[Mapping[str, Any]]) -> Column:
    """Whether a row lies in one of the partitions, as a condition on constants.

    Values of a column that go with the same values of the columns after it are one membership test.
    """
    if not values:
        return F.lit(False)
    names = list(values[0])

    def member(name: str, wanted: Sequence[Any]) -> Column:
        known = [F.lit(v).cast(target.schema[name].dataType) for v in wanted if v is not None]
        tests = ([F.col(name).isin(known)] if known else []) + ([F.col(name).isNull()] if None in wanted else [])
        return either(tests)

    def either(conditions: list[Column]) -> Column:
        while len(conditions) > 1:  # a balanced tree: a chain of thousands is too deep for the analyser
            conditions = [a | b for a, b in zip(conditions[::2], conditions[1::2])] + conditions[len(conditions) & ~1 :]
        return conditions[0]

    def within(columns: Sequence[str], rows: set[tuple]) -> Column:
        if len(columns) == 1:
            return member(columns[0], [row[0] for row in rows])
        rests: dict[Any, set[tuple]] = {}
        for first, *rest in rows:
            rests.setdefault(first, set()).add(tuple(rest))
        alike: dict[frozenset, list] = {}
        for first, rest in rests.items():
            alike.setdefault(frozenset(rest), []).append(first)
        return either([member(columns[0], firsts) & within(columns[1:], set(rest)) for rest, firsts in alike.items()])

    return within(names, {tuple(row[n] for n in names) for row in values})


def optimize(
    spark: SparkSession, table: str, zorder_by: Sequence[str] = (), files: int | None = None
) -> None:
    """Rewrite a stored table into even files, clustered along a Z-order curve if columns are given."""
    landing.checked_table(table)
    for column in zorder_by:
        landing.checked_column(column)
    table_files.finish_commits(spark, table)
    target = spark.table(table)
    parts = table_files.partition_columns(spark, table)
    cells = cluster.cell_bounds(target, list(zorder_by), cluster.bits_for(zorder_by)) if zorder_by else None
    packed = cluster.packed(target, list(zorder_by), parts, files, cells)
    if parts:
        order = [cluster.Z_COLUMN, *zorder_by] if zorder_by else []
        stage = new_folder(spark, "staged")
        _replace_partitions(spark, packed, table, stage, order)
        drop_folder(spark, stage)
    else:
        _switch_snapshot(spark, packed.select(*target.columns), table)
    if zorder_by:
        table_files.store_cells(spark, table, zorder_by, cells)


def _replace_partitions(
    spark: SparkSession, rows: DataFrame, table: str, path: str, order: Sequence[str] = ()
) -> DataFrame:
    """Stage rows, then replace just the partitions they belong to; returns the staged frame.

    The staged copy allows a repeat when the overwrite itself is interrupted; the caller removes it
    once all is done, so it outlives a failure. ``order``
    names helper columns that sort the rows within a partition and are not stored. A catalog table
    takes the overwrite mode from the session only, so a session of its own carries that setting
    and the caller's stays as it is.
    """
    columns = spark.table(table).columns
    parts = table_files.partition_columns(spark, table)
    rows.write.parquet(path)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    staged = own.read.schema(rows.schema).parquet(path)
    ready = staged.sortWithinPartitions(*parts, *order) if order else landing.rebalanced(staged, parts)
    ready.select(*columns).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    return spark.read.schema(rows.schema).parquet(path)


def _same(parts: Sequence[str]) -> Column:
    cond = F.lit(True)
    for part in parts:
        cond = cond & F.col(part).eqNullSafe(F.col(f"__{part}"))
    return cond
