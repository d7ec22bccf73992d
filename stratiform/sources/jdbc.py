"""JDBC scans."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.errors import ConfigError
from stratiform.operators.landing import checked_column
from stratiform.sources import options as opt


def _positive(value: Any, name: str) -> int:
    try:
        number = int(value)
    except (TypeError, ValueError):
        raise ConfigError(f"{name} must be an integer, got {value!r}") from None
    if number <= 0:
        raise ConfigError(f"{name} must be > 0")
    return number


def jdbc_options(
    profile: Mapping[str, Any], table: str, options: Mapping[str, Any] | None = None
) -> dict[str, str]:
    """Reader options from a connection profile. A partitioned read needs all four of its
    options; a query replaces the table, as Spark takes only one of both."""
    missing = [k for k in ("driver", "fetchsize", "url") if not profile.get(k)]
    if missing:
        raise ConfigError(f"missing JDBC profile fields: {missing}")
    opt.reject_unknown(options, opt.JDBC_OPTIONS, "JDBC")
    given = {k: v for k, v in (options or {}).items() if v is not None}
    if not str(table or "").strip() and "query" not in given:
        raise ConfigError("jdbc_table is required")
    partition = [k for k in opt.JDBC_PARTITION_OPTIONS if k in given]
    if partition and len(partition) < len(opt.JDBC_PARTITION_OPTIONS):
        lacking = sorted(set(opt.JDBC_PARTITION_OPTIONS) - set(partition))
        raise ConfigError(f"a partitioned JDBC read also needs {lacking}")
    if partition:
        _positive(given["numPartitions"], "numPartitions")
        checked_column(str(given["partitionColumn"]).strip())

    resolved = {
        "url": str(profile["url"]).strip(),
        "driver": str(profile["driver"]).strip(),
        "fetchsize": str(_positive(profile["fetchsize"], "fetchsize")),
        "dbtable": str(table or "").strip(),
    }
    for name in ("user", "password"):
        variable = str(profile.get(f"{name}_env") or "").strip()
        if variable and os.environ.get(variable):
            resolved[name] = os.environ[variable]
    resolved.update({k: opt.spark_text(v) for k, v in given.items()})
    if "query" in resolved:
        del resolved["dbtable"]
    return resolved


def read_jdbc(
    spark: SparkSession,
    profile: Mapping[str, Any],
    table: str,
    options: Mapping[str, Any] | None = None,
    watermark: tuple[str, Any] | None = None,
) -> DataFrame:
    """Lazy JDBC scan; with a watermark only rows beyond it, filtered in the database."""
    frame = spark.read.format("jdbc").options(**jdbc_options(profile, table, options)).load()
    return frame if watermark is None else beyond(frame, *watermark)


def beyond(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows strictly beyond a watermark, as a predicate that scans push down."""
    checked_column(column)
    if value is None or str(value) == "":
        return df
    return df.filter(F.col(column) > F.lit(value).cast(df.schema[column].dataType))


def next_watermark(df: DataFrame, column: str) -> DataFrame:
    """Highest value of a load, to start the next one from."""
    checked_column(column)
    return df.agg(F.max(column).cast("string").alias("watermark"))
