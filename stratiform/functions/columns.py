"""Small column expressions: labels, hashes, time arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ERROR_TEXT_LIMIT = 500  # fixed value: stored error texts are at most this long


def first_label(labelled: Sequence[tuple[str, Column]]) -> Column:
    """Label of the first condition that holds, else NULL. NULL conditions do not hold."""
    if not labelled:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(cond, F.lit(label)) for label, cond in labelled])


def all_labels(labelled: Sequence[tuple[str, Column]]) -> Column:
    """Comma list of the labels whose condition holds, NULL when none does."""
    if not labelled:
        return F.lit(None).cast("string")
    joined = F.concat_ws(",", *[F.when(cond, F.lit(label)) for label, cond in labelled])
    return F.nullif(joined, F.lit(""))


def any_null(columns: Sequence[str]) -> Column:
    cond = F.lit(False)
    for name in columns:
        cond = cond | F.col(name).isNull()
    return cond


def short_text(col: Column, limit: int = ERROR_TEXT_LIMIT) -> Column:
    """One-line form of an error text, cut to ``limit`` characters."""
    return F.substring(F.trim(F.replace(col, F.lit("\n"), F.lit(" "))), 1, limit)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 over the name-sorted columns, each as ``name:length=text`` or ``name:null``."""
    parts = []
    for name in sorted(columns or df.columns):
        text = F.col(name).cast("string")
        shown = F.concat(F.lit(name + ":"), F.length(text).cast("string"), F.lit("="), text)
        parts.append(F.coalesce(shown, F.lit(name + ":null")))
    return F.sha2(F.concat_ws(",", *parts), 256)


def as_type_of(df: DataFrame, column: str, value: str) -> Column:
    """Literal of the column's own type, so comparing needs no cast on the column."""
    return F.lit(value).cast(df.schema[column].dataType)


def since(df: DataFrame, column: str, as_of: str, days: int = 0, hours: int = 0) -> Column:
    """``column >= as_of - interval``; the bound is a constant, so scans can prune on it."""
    start = as_type_of(df, column, as_of) - F.make_interval(days=F.lit(days), hours=F.lit(hours))
    return F.col(column) >= start


def truncated(df: DataFrame, column: str, unit: str) -> Column:
    """``date_trunc`` that keeps the type of the column (NTZ stays NTZ)."""
    return F.date_trunc(unit, F.col(column)).cast(df.schema[column].dataType)


def few_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], names: Sequence[str]) -> DataFrame:
    """A handful of driver-made text rows as literals of one partition: one task, one file."""
    one = spark.range(1, numPartitions=1)
    if not rows:
        empty = [F.lit(None).cast("string").alias(n) for n in names]
        return one.select(*empty).filter(F.lit(False))
    made = [
        F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, row)]) for row in rows
    ]
    return one.select(F.inline(F.array(*made)))
