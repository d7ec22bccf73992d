"""Post-run verification reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELTA_FOLDER = "%/deltaload/%"  # fixed value: default path pattern of the file reports


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per frame."""
    report = None
    for name, frame in frames.items():
        row = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        report = row if report is None else report.unionAll(row)
    return report


def distinct_files(landing: DataFrame, pattern: str = DELTA_FOLDER, column: str = "_source_file") -> DataFrame:
    picked = landing.filter(F.col(column).like(pattern))
    return picked.agg(F.count_distinct(F.col(column)).alias("distinct_files_picked"))


def rows_per_file(landing: DataFrame, pattern: str = DELTA_FOLDER, column: str = "_source_file") -> DataFrame:
    picked = landing.filter(F.col(column).like(pattern))
    return picked.groupBy(column).agg(F.count(F.lit(1)).alias("rows_per_file"))


def newest(df: DataFrame, ts: str, count: int, ties: Sequence[str] = ()) -> DataFrame:
    """Newest ``count`` rows; a top-k, so nothing is sorted as a whole."""
    return df.orderBy(F.desc(ts), *ties).limit(count)


def latest_runs(runs: DataFrame, count: int = 50) -> DataFrame:
    columns = ["run_id", "source_system", "source_entity", "status", "rows_in", "rows_out", "run_ts"]
    return newest(runs.select(*columns), "run_ts", count, ["run_id"])


def latest_rule_results(results: DataFrame, count: int = 100) -> DataFrame:
    return newest(results, "run_ts", count, ["run_id", "dq_status", "dq_failed_rule"])


def latest_lifecycle(log: DataFrame, count: int = 50) -> DataFrame:
    return newest(log.select("entity_id", "event_type", "event_ts"), "event_ts", count, ["entity_id"])


def seed_sample(df: DataFrame, order_by: Sequence[str], count: int, run_id: str, ts: str | None = None) -> DataFrame:
    """First ``count`` rows in key order, marked with the seeding run."""
    when = F.current_timestamp() if ts is None else F.to_timestamp_ntz(F.lit(ts))
    return (
        df.orderBy(*order_by)
        .limit(count)
        .withColumns({"_seed_run_id": F.lit(run_id), "_seed_ts": when})
    )
