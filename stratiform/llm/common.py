"""What the operators of this package share: staged tables, session values, word shingles."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.session import drop_folder, new_folder

#: Letters and digits in any script; everything else parts words.
WORD = re.compile(r"[^\W_]+")

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def staged(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written below the shared folder and read again, so that its lineage ends there."""
    path = new_folder(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the folder behind a frame made by ``staged``."""
    for path in {p.rsplit("/", 1)[0] for p in frame.inputFiles()}:
        drop_folder(frame.sparkSession, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text is divisible by five."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def smallest_draws(frame: DataFrame, label: str, per_label: int, max_labels: int = 1000, total: int | None = None) -> DataFrame:
    """The rows of smallest ``draw`` (a 64-bit hash) of each label: ``per_label``, or fewer so that ``total`` is kept.

    Labels are counted first, so that only about four times as many rows as are wanted pass a bound on
    ``draw`` and reach the tasks that rank them, however many rows or input partitions there are. If
    too few pass, all rows are ranked. Of more than ``max_labels`` labels the most frequent are taken (ties:
    the smaller); rows without a label are no sample.
    """
    counts = frame.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).limit(max_labels)
    counts = staged(counts, "label-counts")
    labels = counts.count()
    wanted = per_label if total is None else max(1, min(per_label, total // max(1, labels)))
    share = F.least(F.lit(1.0), F.lit(4.0 * wanted + 100) / F.col("count"))
    # At most ``max_labels`` short rows are broadcast.
    bounds = counts.select(F.col(label).alias("__label"), (share * F.lit(2.0**64) - F.lit(2.0**63)).alias("__most"))
    known = frame.join(F.broadcast(bounds), F.col(label) == F.col("__label")).drop("__label")
    order = Window.partitionBy(label).orderBy("draw", *[c for c in frame.columns if c not in (label, "draw")])

    def ranked(rows: DataFrame) -> DataFrame:
        nth = rows.drop("__most").withColumn("__nth", F.row_number().over(order))
        return nth.where(F.col("__nth") <= wanted).drop("__nth")

    some = staged(ranked(known.where(F.col("draw").cast("double") <= F.col("__most"))), "draws")
    found = some.groupBy(label).agg(F.count("*").alias("found"))
    short = counts.join(found, label, "left").where(F.coalesce("found", F.lit(0)) < F.least("count", F.lit(wanted)))
    return some if short.isEmpty() else ranked(known)


def with_own(frame: DataFrame, **own: Column) -> DataFrame:
    """Add columns; an extra column of the input that has the same name gives way."""
    names = {name.lower() for name in own}
    kept = [F.col(f"`{c}`") for c in frame.columns if c.lower() not in names]
    return frame.select(*kept, *[column.alias(name) for name, column in own.items()])


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[0]
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX[1]
    return values ^ (values >> np.uint64(31))


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class WordHashes:
    """64-bit hashes of words, remembered by type; the memory starts anew beyond ``limit``."""

    def __init__(self, limit: int = 400_000):
        self.known: dict[str, int] = {}
        self.limit = limit

    def __call__(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        except KeyError:
            pass
        if len(known) > self.limit:
            known.clear()
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for token in set(tokens).difference(known):
            known[token] = digest(token)
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; a shorter text is one run of all its words."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    total = np.full(count, np.uint64(size))
    for at in range(size):
        total = mix(total * _MULTIPLIER + hashes[at : at + count])
    return total


def minhash_seeds(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1)


def minhashes(values: np.ndarray, seeds: np.ndarray, block: int = 512) -> np.ndarray:
    """Smallest value under each of the multiplicative hash functions of ``seeds``, its upper 32 bits."""
    best = np.full(len(seeds), np.uint64(2**64 - 1))
    for start in range(0, len(values), block):
        np.minimum(best, (values[start : start + block, None] * seeds).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)
