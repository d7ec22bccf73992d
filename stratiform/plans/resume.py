"""Where a run stopped, read from append-only stage events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators.keyed import latest_per_key

# Stage states and the number of runs kept.
STATES = ["PENDING", "IN_PROGRESS", "CHECKPOINT_SAVED", "SUCCESS", "FAILED", "ROLLED_BACK"]
DONE = ["CHECKPOINT_SAVED", "SUCCESS"]
KEEP_RUNS = 5


def last_events(events: DataFrame) -> DataFrame:
    """Newest event of every stage of every run (run_id, stage_sequence, event_ts, state)."""
    order = [F.desc("event_ts"), F.desc("state")]
    return latest_per_key(events, ["run_id", "stage_sequence"], order)


def resume_point(events: DataFrame) -> DataFrame:
    """Per run the last stage that was saved or succeeded; 0 when there is none."""
    states = last_events(events)
    done = F.when(F.col("state").isin(DONE), F.col("stage_sequence"))
    return states.groupBy("run_id").agg(
        F.coalesce(F.max(done), F.lit(0)).alias("last_completed_stage"),
        F.count_if(F.col("state") == "FAILED").alias("failed_stages"),
        F.max("event_ts").alias("last_event_ts"),
    )


def newest_runs(points: DataFrame, keep: int = KEEP_RUNS, within: Sequence[str] = ()) -> DataFrame:
    """The newest runs that are kept, over all or per group."""
    if not within:
        return points.orderBy(F.desc("last_event_ts"), "run_id").limit(keep)
    from pyspark.sql import Window

    order = Window.partitionBy(*within).orderBy(F.desc("last_event_ts"), "run_id")
    ranked = points.withColumn("__rank", F.row_number().over(order))
    return ranked.filter(F.col("__rank") <= keep).drop("__rank")
