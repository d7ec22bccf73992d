"""Keys across loads: which keys of a load an earlier load has brought already.

The history is a table of keys, each with the load that brought it first, in files sorted by key. A load reads
the files whose key ranges meet its own keys and no others, and appends what is new as a sorted run; runs
are packed as small files are. A load that is repeated neither finds itself nor is recorded twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions.columns import any_null
from stratiform.operators import landing, publish, table_files
from stratiform.operators.keyed import flag_keys, measure

#: Fixed value: name of the rule in failed rows.
PK_NEW = "primary_key_unique_across_loads"
FIRST_LOAD = "first_load"


def flag_seen(df: DataFrame, keys: Sequence[str], history: str, load_id: str, flag: str = "seen_before") -> DataFrame:
    """``df`` with whether an earlier load brought the row's key. NULL keys are never known."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(landing.checked_table(history)):
        return df.withColumn(flag, F.lit(False))
    own = publish.key_side(df.select(*keys), keys)
    table_files.finish_commits(spark, history)
    paths = [path for path, _ in table_files.data_files(spark, history)]
    held = table_files.read_files_of(spark, history, publish.files_with(spark, history, own, keys, paths))
    earlier = held.where(F.col(FIRST_LOAD) != load_id).select(*keys).distinct()
    return flag_keys(df, measure(own.frame.join(earlier, list(keys), "left_semi"), "seen-keys"), keys, flag)


def record(rows: DataFrame, keys: Sequence[str], history: str, load_id: str) -> int:
    """Add the keys of rows that no earlier load had; how many there were."""
    spark = rows.sparkSession
    fresh = rows.where(~any_null(keys)).select(*keys).distinct().withColumn(FIRST_LOAD, F.lit(load_id))
    ordered = fresh.repartitionByRange(*keys).sortWithinPartitions(*keys)
    count = publish.append(ordered, history, load=f"keys:{load_id}", again=True)
    publish.compact(spark, history, list(keys))
    return count


def fail_seen(checked: DataFrame, keys: Sequence[str], history: str, load_id: str) -> DataFrame:
    """Rows with rule columns, where a key of an earlier load fails as well."""
    flagged = flag_seen(checked, keys, history, load_id, "__seen")
    failed = F.when(F.col("__seen"), F.concat_ws(",", "dq_failed_rule", F.lit(PK_NEW))).otherwise(F.col("dq_failed_rule"))
    return flagged.withColumns({"dq_failed_rule": failed, "dq_status": F.when(F.col("__seen"), "FAIL").otherwise(F.col("dq_status"))}).drop("__seen")
