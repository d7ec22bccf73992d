"""Per-key work that stays even when one key holds a large share of the rows.

Keys are counted with map-side combining, so a hot key costs one row per task. What is then
joined back is first written to the shared folder and measured there. A small side is
broadcast and the wide frame is not shuffled at all; a large one is joined by shuffle, with the
rows of hot keys answered from a bounded broadcast and spread over all tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stratiform.functions.columns import any_null
from stratiform.session import drop_folder, new_folder

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: A key is hot if it holds more than this share of what an even partition would hold. At most
#: ``partitions / HOT_SHARE`` keys can be that large, whatever the data.
HOT_SHARE = 0.25
COPIES = "__copies"
_SALT = "__salt"


@dataclass(frozen=True)
class Measured:
    """A frame stored in the shared folder, with what was seen while writing it."""

    frame: DataFrame
    rows: int
    bytes: int
    path: str
    seen: dict[str, Any] = field(default_factory=dict)

    def drop(self) -> None:
        """Remove the stored rows, once nothing reads them any more."""
        drop_folder(self.frame.sparkSession, self.path)

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def measure(df: DataFrame, label: str, *metrics: Column) -> Measured:
    """Write ``df`` to the shared folder and count rows and bytes in the same job."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    width = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    (
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
            *metrics,
        )
        .write.parquet(path)
    )
    got = seen.get
    return Measured(
        spark.read.schema(df.schema).parquet(path), int(got["rows"]), int(got["bytes"]), path, dict(got)
    )


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its number of rows; NULL keys form groups of their own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))


def distinct_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows and distinct keys, NULLs counting as values."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` lets Spark cut every map task down to one row per key before the
    shuffle, so a hot key never arrives whole in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def _renamed(side: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"__key{i}" for i in range(len(keys))]
    return side.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]), names


def _null_safe(keys: Sequence[str], names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for key, name in zip(keys, names):
        cond = cond & F.col(key).eqNullSafe(F.col(name))
    return cond


def _left_salt(df: DataFrame, spread: Column) -> Column:
    """Salt of the wide side: many values where ``spread`` holds, 0 elsewhere.

    It depends on the input partition only, so a task that runs again after an executor was lost
    sends each row to the same place.
    """
    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    noise = F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(slices))
    return F.when(spread, noise + 1).otherwise(F.lit(0).cast("long"))


def _side_salt(names: Sequence[str]) -> Column:
    # Always 0, but not a literal: a literal would be folded out of the join keys.
    return F.pmod(F.xxhash64(*[F.col(n) for n in names]), F.lit(1).cast("long"))


def flag_keys(df: DataFrame, side: Measured, keys: Sequence[str], flag: str) -> DataFrame:
    """Add boolean ``flag``: whether the row's key (NULLs compare equal) is in ``side``.

    ``side`` has one row per key and its number of rows in ``__copies``.
    """
    if side.rows == 0:
        return df.withColumn(flag, F.lit(False))
    found = F.coalesce(F.col("__found"), F.lit(False))
    if side.fits_broadcast:
        keys_only, names = _renamed(side.frame, keys)
        hit = F.broadcast(keys_only.withColumn("__found", F.lit(True)))
        joined = df.join(hit, _null_safe(keys, names), "left")
        return joined.select(*df.columns, found.alias(flag))

    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = side.frame.agg(F.sum(COPIES)).first()[0]
    hot_keys = measure(side.frame.filter(F.col(COPIES) >= F.lit(HOT_SHARE * total / partitions)), "hot-keys")
    hot, hot_names = _renamed(hot_keys.frame, keys)
    hot = hot.withColumn("__hot", F.lit(True))
    if hot_keys.fits_broadcast:
        hot = F.broadcast(hot)
    with_hot = df.join(hot, _null_safe(keys, hot_names), "left").select(
        *df.columns, F.coalesce(F.col("__hot"), F.lit(False)).alias("__hot")
    )
    salted = with_hot.withColumn(_SALT, _left_salt(df, F.col("__hot")))
    cold, names = _renamed(side.frame, keys)
    cold = cold.withColumn("__found", F.lit(True)).withColumn("__side_salt", _side_salt(names))
    joined = salted.join(
        cold, _null_safe(keys, names) & (F.col(_SALT) == F.col("__side_salt")), "left"
    )
    return joined.select(*df.columns, (F.col("__hot") | found).alias(flag))


def drop_matching(df: DataFrame, side: Measured, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``side``; a NULL key matches nothing."""
    if side.rows == 0:
        return df
    keys_only, names = _renamed(side.frame, keys)
    cond = F.lit(True)
    for key, name in zip(keys, names):
        cond = cond & (F.col(key) == F.col(name))
    if side.fits_broadcast:
        return df.join(F.broadcast(keys_only), cond, "left_anti")
    # Rows with a NULL key would all hash to one task: spread them instead.
    salted = df.withColumn(_SALT, _left_salt(df, any_null(keys)))
    keys_only = keys_only.withColumn("__side_salt", _side_salt(names))
    kept = salted.join(keys_only, cond & (F.col(_SALT) == F.col("__side_salt")), "left_anti")
    return kept.drop(_SALT)


def keep_matching(df: DataFrame, side: Measured, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key (NULLs compare equal) is in ``side``."""
    keys_only, names = _renamed(side.frame, keys)
    if side.fits_broadcast:
        keys_only = F.broadcast(keys_only)
    return df.join(keys_only, _null_safe(keys, names), "left_semi")
