"""Landing layer: technical columns, column alignment, append and retention."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.errors import ConfigError
from stratiform.functions.columns import as_type_of

# Accepted write modes, table types and external path prefixes.
WRITE_MODES = ("append", "overwrite", "error", "ignore")
TABLE_TYPES = ("managed", "external")
EXTERNAL_PREFIXES = ("abfss://", "s3://", "gs://")

_NAME_PART = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def checked_table(name: str) -> str:
    parts = str(name or "").split(".")
    if len(parts) != 3 or not all(_NAME_PART.match(p) for p in parts):
        raise ConfigError(f"table must be catalog.schema.table, got {name!r}")
    return name


def checked_column(name: str) -> str:
    if not _NAME_PART.match(name):
        raise ConfigError(f"not a plain column name: {name!r}")
    return name


def checked_path(
    table_type: str | None, path: str | None, prefixes: Sequence[str] = EXTERNAL_PREFIXES
) -> str | None:
    """Path of an external table, None for a managed one."""
    kind = (table_type or "managed").strip().lower() or "managed"
    if kind not in TABLE_TYPES:
        raise ConfigError(f"table type must be one of {TABLE_TYPES}, got {table_type!r}")
    if kind == "managed":
        return None
    text = (path or "").strip()
    if not text.lower().startswith(tuple(prefixes)):
        raise ConfigError(f"external path must start with one of {tuple(prefixes)}, got {path!r}")
    return text


def add_metadata(
    df: DataFrame, source_system: str, source_entity: str, load_id: str, ingest_ts: str | None = None
) -> DataFrame:
    """Add source_system, source_entity, load_id and ingest_ts (now unless given)."""
    texts = {"source_system": source_system, "source_entity": source_entity, "load_id": load_id}
    blank = [k for k, v in texts.items() if not str(v or "").strip()]
    if blank:
        raise ConfigError(f"must not be blank: {blank}")
    when = F.current_timestamp() if ingest_ts is None else F.to_timestamp_ntz(F.lit(ingest_ts))
    return df.withColumns({k: F.lit(v.strip()) for k, v in texts.items()} | {"ingest_ts": when})


def evolve(base: DataFrame, added: DataFrame) -> DataFrame:
    """Both frames under the union of their columns; what a side lacks is NULL."""
    return base.unionByName(added, allowMissingColumns=True)


def widen(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Let a stored table learn the columns of ``df`` that it lacks; a catalog change only."""
    known = {f.name.lower() for f in spark.table(table).schema.fields}
    fresh = [f for f in df.schema.fields if f.name.lower() not in known]
    if fresh:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def aligned(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """``df`` in the table's column order, after the table learned its new columns."""
    widen(spark, table, df)
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            F.col(f"`{have[f.name.lower()]}`").alias(f.name)
            if f.name.lower() in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
    )


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows grouped by partition value before a partitioned write.

    Otherwise every task writes a file to every partition it meets. Adaptive execution splits a
    value that holds many rows over several tasks and merges small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "append",
    path: str | None = None,
    partition_by: Sequence[str] = (),
    merge_schema: bool = True,
) -> None:
    """Write a layer table. Appending frames with new columns widens the table's schema only;
    no stored file is rewritten."""
    if mode not in WRITE_MODES:
        raise ConfigError(f"write mode must be one of {WRITE_MODES}, got {mode!r}")
    spark = df.sparkSession
    checked_table(table)
    if mode == "append" and spark.catalog.tableExists(table):
        ready = aligned(df, spark, table) if merge_schema else df.select(*spark.table(table).columns)
        ready.write.insertInto(table)
        return
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """A table without rows or files."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    where = f" LOCATION {partition_literal(path)}" if path else ""
    spark.sql(f"CREATE TABLE {checked_table(table)} ({columns}) USING parquet{parts}{where}")


def replace_load(df: DataFrame, table: str, load_id: str, path: str | None = None) -> None:
    """Make ``df`` the rows of one load, the partition ``load_id`` of the table.

    A repeat replaces that partition, so a load that is resumed after a failure is there once. A table
    that is not partitioned by load is appended to.
    """
    spark = df.sparkSession
    checked_table(table)
    rows = df.drop("load_id")
    if not spark.catalog.tableExists(table):
        # The table first, without rows: a failed first load then leaves nothing that blocks the next.
        # (By its schema: ``df`` may carry metrics, which belong to the write of its rows.)
        create_table(spark, table, T.StructType([*rows.schema.fields, T.StructField("load_id", T.StringType())]), path, ("load_id",))
    if "load_id" not in [c.name for c in spark.catalog.listColumns(table) if c.isPartition]:
        write_table(df, table)
        return
    ready = aligned(rows.withColumn("load_id", F.lit(load_id)), spark, table)
    # A catalog table takes the overwrite mode from the session only, and an observed frame is written by its own session.
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        ready.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)
    spark.catalog.refreshTable(table)


def retention_hours(days: int | None = None, hours: int | None = None) -> int | None:
    """Retention in hours from days or hours; not both, and positive."""
    if days is not None and hours is not None:
        raise ConfigError("give retention in days or in hours, not both")
    value = hours if days is None else days * 24
    if value is not None and value <= 0:
        raise ConfigError("retention must be positive")
    return value


def retain(df: DataFrame, hours: int, as_of: str, column: str = "ingest_ts") -> DataFrame:
    """Rows still inside the retention period; the bound reaches the scan as a constant."""
    bound = as_type_of(df, column, as_of) - F.make_interval(hours=F.lit(hours))
    return df.filter(F.col(column) >= bound)


def archive(
    df: DataFrame, table: str, days: int | None = None, hours: int | None = None, load_id: str | None = None
) -> int | None:
    """Second copy of each load in ``df``; returns the retention in hours that ``purge_loads`` applies."""
    keep = retention_hours(days, hours)
    if load_id is None:
        write_table(df, table, partition_by=("load_id",))
    else:
        replace_load(df, table, load_id)
    return keep


def partition_literal(value: Any) -> str:
    """A partition value as SQL: typed for dates and times, escaped for texts."""
    if value is None:
        return "null"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'" if value.tzinfo else f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (bool, int)):
        return str(value).lower()
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def drop_partition(spark: SparkSession, table: str, values: Mapping[str, Any]) -> None:
    """Remove one partition from the catalog and its files."""
    spec = ", ".join(f"`{name}` = {partition_literal(value)}" for name, value in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def purge_loads(spark: SparkSession, table: str, hours: int, as_of: str) -> list[str]:
    """Drop the load partitions whose newest row is past retention; nothing is rewritten.

    One row per load reaches the driver, as dropping partitions is a catalog command.
    """
    frame = spark.table(checked_table(table))
    newest = frame.groupBy("load_id").agg(F.max("ingest_ts").alias("ingest_ts"))
    bound = as_type_of(newest, "ingest_ts", as_of) - F.make_interval(hours=F.lit(hours))
    old = [r.load_id for r in newest.filter(F.col("ingest_ts") < bound).toLocalIterator()]
    for load_id in old:
        drop_partition(spark, table, {"load_id": load_id})
    return old
