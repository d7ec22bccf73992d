"""Layout advice measured in one pass of approximate distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.landing import checked_column, checked_table

# Cardinality range of a partition column, columns per Z-order.
PARTITION_MIN = 2
PARTITION_MAX = 1000
Z_ORDER_COLUMNS = 3
_COMPARABLE = ("map", "variant", "array", "struct")


def cardinalities(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """(position, column_name, distinct_values) rows from a single aggregation."""
    names = columns or [
        f.name for f in df.schema.fields if f.dataType.typeName() not in _COMPARABLE
    ]
    counted = df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(c) for c in names])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.col(f"`{c}`").alias("distinct_values"),
        )
        for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))


def advise(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Partitioning, clustering and statistics advice for a table.

    The counted columns are as few rows as the table has columns, so ordering them is free.
    """
    counted = cardinalities(df, columns)
    value = F.col("distinct_values")
    low = value.between(PARTITION_MIN, PARTITION_MAX)
    pick = counted.agg(
        F.min_by(F.col("column_name"), F.when(low, F.col("position"))).alias("partition_column"),
        F.array_sort(
            F.collect_list(
                F.when(value > PARTITION_MAX, F.struct("position", "column_name"))
            )
        ).alias("high"),
    )
    z_columns = F.array_join(F.slice(F.col("high.column_name"), 1, Z_ORDER_COLUMNS), ",")
    rows = F.array(
        F.when(
            F.col("partition_column").isNotNull(),
            F.struct(
                F.lit("PARTITIONING").alias("recommendation_type"),
                F.col("partition_column").alias("columns"),
                F.lit("HIGH").alias("priority"),
                F.concat(
                    F.lit(f"CREATE TABLE {table}_partitioned USING PARQUET PARTITIONED BY ("),
                    F.col("partition_column"),
                    F.lit(f") AS SELECT * FROM {table}"),
                ).alias("implementation"),
            ),
        ),
        F.when(
            F.size("high") > 0,
            F.struct(
                F.lit("Z_ORDER").alias("recommendation_type"),
                z_columns.alias("columns"),
                F.lit("MEDIUM").alias("priority"),
                F.concat(F.lit("cluster by z-value of "), z_columns).alias("implementation"),
            ),
        ),
        F.struct(
            F.lit("STATISTICS").alias("recommendation_type"),
            F.lit(None).cast("string").alias("columns"),
            F.lit("MEDIUM").alias("priority"),
            F.lit(f"ANALYZE TABLE {table} COMPUTE STATISTICS").alias("implementation"),
        ),
    )
    advice = pick.select(F.explode(rows).alias("advice")).filter("advice is not null")
    return advice.select(F.lit(table).alias("table_name"), "advice.*")


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """Collect table statistics, and column statistics where columns are given."""
    checked_table(table)
    chosen = ", ".join(checked_column(c) for c in columns)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (f" FOR COLUMNS {chosen}" if chosen else ""))
